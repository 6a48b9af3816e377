"""Brute-force versions and odd inputs shared by the tests."""

import collections
import zlib


def words(text):
    return (text or "").encode().lower().split()


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def shingles(text):
    w = words(text)
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def jaccard_components(docs):
    """{doc_id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def odd_documents():
    """doc_id, text, lang, source, n_chars: nulls, blanks, a long text, ties,
    repeated rows."""
    long = " ".join(f"word{i % 977} and" for i in range(20_000))
    return [
        (1, None, None, None, None), (None, "a null id has this text with eight words", "en", "s", 1), (2, "", "en", "s", 0),
        (3, " \n\t ", None, "s", 4), (4, long, "en", None, len(long)), (5, "Same text here, twice over again.", "en", "s", 33),
        (5, "Same text here, twice over again.", "en", "s", 33), (6, "Same text here, twice over again.", "en", "s", 33),
        (7, "1234 !!! ***", "de", "s", 12), (8, "über größe straße und mehr", "de", "t", 26),
    ]


ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
