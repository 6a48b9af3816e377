import collections
import random
import re
import zlib

import numpy as np
import pytest

from gapledger.llm import spelling as sp


def brute_force(docs):
    count = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: k for w, k in count.items() if len(w) >= 7 and k >= 2}
    keys = collections.defaultdict(set)
    for w in n:
        keys[w].add(w)
        for i in range(len(w)):
            keys[w[:i] + w[i + 1:]].add(w)
            keys[w[:i] + "*" + w[i + 1:]].add(w)
    near = collections.defaultdict(set)
    for key, ws in keys.items():
        for a in ws:
            near[a] |= {b for b in ws if a != b and ("*" in key or len(a) != len(b))}
    form = {}
    for w in n:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def run(spark, docs):
    got = sp.spelling_variants(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: tuple(r)[1:] for r in got}


def corpus(seed, n=300):
    """Words of few syllables, so that many share grams, with variants at one edit."""
    rng = random.Random(seed)
    syllables = ["tion", "ment", "é", "eau", "ou", "re", "th", "ing", "a", "ß", "st"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 7))) for _ in range(n)]
    for w in words[:n // 2]:
        i = rng.randrange(len(w) + 1)
        words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + "x" + w[i:], w[:i] + "q" + w[i + 1:]]))
    words += ["a" * 40, "a" * 41, "a" * 39 + "b", "a" * 300, "a" * 301]
    docs = []
    for i in range(200):
        text = " ".join(rng.choices(words, weights=[1 + 60 * (k % 37 == 0) for k in range(len(words))], k=60))
        docs.append((rng.randrange(10**6), text.upper() if i % 9 == 0 else text))
    return docs


@pytest.mark.parametrize("grams, least, block, part", [(400_000, 16, 16_384, 1_000_000), (400_000, 1, 3, 500), (30, 2, 5, 2000)])
def test_matches_brute_force(spark, monkeypatch, grams, least, block, part):
    for name, value in (("GRAMS", grams), ("LEAST", least), ("BLOCK", block), ("PART", part), ("SLICE", 90), ("PAIRS", 64)):
        monkeypatch.setattr(sp, name, value)
    docs = corpus(block)
    assert run(spark, docs) == brute_force(docs)


def test_table(spark, base, docs):
    assert run(spark, docs) == brute_force(docs)


def test_no_edit_affects_both_lists():
    """Every word at one edit of a word holds one of its two chosen grams, in
    place or shifted by the difference in length."""
    rng = random.Random(4)
    alphabet = "abc"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(7, 14))) for _ in range(400)]
    for least in (0, 2, 8, 40):
        hashes = np.concatenate([sp.gram_hashes(x, q).ravel() for _, x in sp.by_length(words) for q in range(3, 7)])
        grams, n = np.unique(hashes, return_counts=True)
        lists = sp.Dictionary(grams[n > least], n[n > least], max(1, least))

        def index(word):
            _, x = sp.by_length([word])[0]
            begins, end, code, from_, often = sp.decomposed(x, lists)
            chosen = sp.merged_lists(begins, end, from_, often, len(word))
            return {(int(code[0, i]), int(i)) for i in np.flatnonzero(begins[0])}, [(int(code[0, int(i[0])]), int(i[0])) for i in chosen]

        for w in words[:60]:
            i, c = rng.randrange(len(w)), rng.choice(alphabet + "z")
            for other in {w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w + c, c + w} - {w}:
                held = index(other)[0]
                assert any((g, at) in held or (g, at + len(other) - len(w)) in held for g, at in index(w)[1])


def test_odd_inputs(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sp.spelling_variants(odd.withColumnRenamed("source", "word").withColumnRenamed("lang", "n")).collect()
    assert {r.word: tuple(r)[1:] for r in got} == brute_force(rows)
    assert sp.spelling_variants(empty).collect() == []
