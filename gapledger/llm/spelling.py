"""Spelling variants by an index of variable-length grams.

Words are maximal runs of Latin letters. A gram dictionary is built from all
words: the grams of 3 to 6 letters that occur often; every other gram is pruned,
as its shorter prefix is selective enough. A word (between end marks) is
decomposed into variable grams: at each place the shortest gram that is not
frequent, at most 6 letters, unless an earlier gram covers it.

An edit affects a gram that holds it; one that begins right of the edit is also
affected if a frequent gram, and with it a longer one, could begin at or before
the edit and cover it. A gram left of the edit never is: no longer gram begins
with a rare one, nor with one of full length. So each gram bears an interval of
the edits that can affect it, and two grams whose intervals do not meet cannot
both be lost: every word at one edit keeps one of them, at the same place or
shifted by the difference in length. Each word merges only the two cheapest
such lists of the index (the first and last gram, at the end marks, always are
such a pair, so no word is without), and candidates are verified letter by letter.

Lists live in tasks by the hash of the gram. The list of a gram that more than
``BLOCK`` words have is split into blocks by a hash of the word, and whoever
merges it visits every block.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mix64, slices, written

RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LETTERS = 7
#: One in TYPO occurrences loses a letter.
TYPO = 31
#: A form must occur at least so many times as often as its variant.
TIMES = 10
SHORTEST, LONGEST = 3, 6
PAD = LONGEST - 1
#: Grams of the dictionary, at most: a gram is frequent beyond the number of all grams divided by this.
GRAMS = 400_000
LEAST = 16
#: Distinct words a task counts before it hands them on; words in a slice; index entries in a task, about.
HELD, SLICE, PART = 400_000, 20_000, 1_000_000
BLOCK = 16_384
PAIRS = 1 << 18
WIDTH = 32

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


# -- words ---------------------------------------------------------------------

def counted(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(word, n) of the words of all texts, those with a letter lost included."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for part, found in slices(batch.select([doc, text]), text):
                for ident, t in zip(part.column(doc).to_pylist(), found, strict=True):
                    begun = zlib.crc32(b":", zlib.crc32(b"" if ident is None else str(ident).encode()))
                    words = [w for w in RUN.findall(t.lower()) if len(w) >= LETTERS]
                    held.update(words)
                    for w in words:
                        h = zlib.crc32(w, begun)
                        if not h % TYPO:
                            s = w.decode()
                            k = h % len(s)
                            held[w] -= 1
                            held[(s[:k] + s[k + 1:]).encode()] += 1
                if len(held) > HELD:
                    yield _counts(held)
                    held = Counter()
        yield _counts(held)

    return docs.select(doc, text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(held: Counter) -> pa.RecordBatch:
    pairs = [(w, n) for w, n in held.items() if n > 0 and (len(w) >= 2 * LETTERS or len(w.decode()) >= LETTERS)]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in pairs], pa.binary()).cast(pa.string()), pa.array([n for _, n in pairs], pa.int64())],
                                      names=["word", "n"])


def by_length(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, letters between end marks) of the words of each length."""
    coded = [w.encode("latin-1") for w in words]
    lengths = np.array([len(c) for c in coded], np.int64)
    out = []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        letters = np.full((len(at), n + 2 * PAD), 1, np.uint8)
        letters[:, PAD:PAD + n] = np.frombuffer(b"".join([coded[i] for i in at]), np.uint8).reshape(len(at), n)
        letters[:, PAD + n:] = 2
        out.append((at, letters))
    return out


def gram_hashes(letters: np.ndarray, q: int) -> np.ndarray:
    """Hash of the gram of ``q`` letters that begins at each place."""
    n = letters.shape[1] - q + 1
    h = np.zeros((len(letters), n), _U)
    for k in range(q):
        h = h * _U(257) + letters[:, k:k + n].astype(_U)
    return mix64(h + _STEP * _U(q))


# -- dictionary ----------------------------------------------------------------

def frequent_grams(words: DataFrame, least: int, parts: int) -> DataFrame:
    """(gram, n): hashes of the grams that occur more than ``least`` times in all words."""
    def count(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                hashes = [gram_hashes(x, q).ravel() for _, x in by_length(batch.column("word").slice(a, SLICE).to_pylist())
                          for q in range(SHORTEST, LONGEST + 1)]
                grams, n = np.unique(np.concatenate(hashes), return_counts=True)
                to = (grams >> _U(32)) * _U(parts) >> _U(32)
                cuts = np.searchsorted(to, np.arange(parts + 1, dtype=_U))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(parts, dtype=np.int32)),
                     pa.array([grams[b:c].tobytes() + n[b:c].astype("<u4").tobytes() for b, c in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    names=["part", "blob"])

    def merge(table: pa.Table) -> pa.Table:
        blobs = table.column("blob").to_pylist()
        grams = np.concatenate([np.frombuffer(b, "<u8", len(b) // 12) for b in blobs])
        n = np.concatenate([np.frombuffer(b, "<u4", offset=len(b) // 12 * 8) for b in blobs]).astype(np.int64)
        order = np.argsort(grams)
        grams, n = grams[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        n = np.add.reduceat(n, first) if len(first) else n
        keep = n > least
        return pa.table({"gram": grams[first][keep].view(np.int64), "n": n[keep]})

    return (words.select("word").mapInArrow(count, "part int, blob binary").groupBy("part").applyInArrow(merge, "gram bigint, n bigint"))


class Dictionary:
    """The frequent grams, sorted, and how often each occurs."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, least: int):
        order = np.argsort(grams)
        self.grams, self.n, self.least = grams[order], n[order], least

    def times(self, hashes: np.ndarray) -> np.ndarray:
        """Occurrences of each gram; 0 if it is not frequent."""
        if not len(self.grams):
            return np.zeros(hashes.shape, np.int64)
        at = np.minimum(np.searchsorted(self.grams, hashes.ravel()), len(self.grams) - 1)
        return np.where(self.grams[at] == hashes.ravel(), self.n[at], 0).reshape(hashes.shape)


# -- decomposition -------------------------------------------------------------

def decomposed(letters: np.ndarray, grams: Dictionary) -> tuple[np.ndarray, ...]:
    """Of words of one length, per word and place: whether a gram begins there,
    its end, its hash, the first edit that affects it (the last is its last
    letter) and how often it occurs at most."""
    n = letters.shape[1] - SHORTEST + 1
    hashes, times = {}, {}
    for q in range(SHORTEST, LONGEST + 1):
        h = gram_hashes(letters, q)
        hashes[q] = np.zeros((len(letters), n), _U)
        hashes[q][:, :h.shape[1]] = h
        times[q] = np.zeros((len(letters), n), np.int64)
        times[q][:, :h.shape[1]] = grams.times(h)
    size = np.full((len(letters), n), SHORTEST)
    code, often = hashes[SHORTEST].copy(), times[SHORTEST].copy()
    for q in range(SHORTEST + 1, LONGEST + 1):
        longer = (size == q - 1) & (times[q - 1] > 0) & (np.arange(n) + q <= letters.shape[1])
        size[longer], code[longer], often[longer] = q, hashes[q][longer], times[q][longer]
    end = np.arange(n) + size
    before = np.maximum.accumulate(end, axis=1)
    begins = np.ones(end.shape, bool)
    begins[:, 1:] = end[:, 1:] > before[:, :-1]
    from_ = np.arange(n) - (size < LONGEST)
    back = size < LONGEST
    for k in range(1, LONGEST - SHORTEST):  # one place further left, while a longer gram could begin there
        cover = np.zeros(end.shape, bool)
        for q in range(SHORTEST, LONGEST - k):
            # the letters from k places before the gram up to its last but one
            own = (size == q)
            if q - 1 + k < SHORTEST:
                cover |= own
            elif q - 1 + k < LONGEST:
                cover[:, k:] |= own[:, k:] & (times[q - 1 + k][:, :-k] > 0)
        back &= cover
        from_ = from_ - back
    return begins, end, code, from_, np.where(often > 0, often, grams.least)


def merged_lists(begins: np.ndarray, end: np.ndarray, from_: np.ndarray, often: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word of ``n`` letters the two places whose grams no single edit can
    both affect and whose lists are the shortest together."""
    never = np.iinfo(np.int64).max // 4
    best = np.full(len(begins), never * 2)
    left, right = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
    for edit in range(PAD, PAD + n + 1):  # grams that end at or before it, and grams affected from it on
        a = np.where(begins & (end <= edit), often, never)
        b = np.where(begins & (from_ >= edit), often, never)
        i, j = a.argmin(axis=1), b.argmin(axis=1)
        rows = np.arange(len(a))
        cost = a[rows, i] + b[rows, j]
        better = cost < best
        best[better], left[better], right[better] = cost[better], i[better], j[better]
    if len(best) and best.max() >= never:
        raise AssertionError("a word without two lists")
    return left, right


ENTRY = np.dtype([("gram", "<u8"), ("at", "<u4"), ("word", "<u4"), ("merges", "?")])


def index_rows(words: DataFrame, grams, parts: int) -> DataFrame:
    """(part, blob, words, n): entries of the index and of those who merge its
    lists, dealt by gram and block, with the words they belong to."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                words = part.column("word").to_pylist()
                made = []
                salt = np.array([xxhash.xxh3_64_intdigest(w) for w in words], _U)
                for at, letters in by_length(words):
                    begins, end, code, from_, often = decomposed(letters, grams.value)
                    r, c = np.nonzero(begins)
                    left, right = merged_lists(begins, end, from_, often, letters.shape[1] - 2 * PAD)
                    chosen = np.zeros(begins.shape, bool)
                    chosen[np.arange(len(at)), left] = chosen[np.arange(len(at)), right] = True
                    blocks = -(-often[r, c] // BLOCK)
                    own = salt[at[r]] % blocks.astype(_U)
                    made.append(_entries(code[r, c], own, c, at[r], False))
                    pick = chosen[r, c]
                    r, c, blocks = r[pick], c[pick], blocks[pick]
                    k = np.repeat(np.arange(len(r)), blocks)
                    nth = np.arange(len(k)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    made.append(_entries(code[r, c][k], nth.astype(_U), c[k], at[r][k], True))
                rows = np.concatenate(made)
                to = ((mix64(rows["gram"]) >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                rows, to = rows[order], to[order]
                cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                out = []
                for b, c in zip(cuts, np.append(cuts[1:], len(to)), strict=True):
                    own = rows[b:c].copy()
                    used, own["word"] = np.unique(own["word"], return_inverse=True)
                    taken = part.take(pa.array(used.astype(np.int64)))
                    out.append((int(to[b]), own.tobytes(), taken.column("word").to_pylist(), taken.column("n").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())))],
                    names=["part", "blob", "words", "n"])

    return words.mapInArrow(run, "part int, blob binary, words array<string>, n array<bigint>")


def _entries(gram: np.ndarray, block: np.ndarray, at: np.ndarray, word: np.ndarray, merges: bool) -> np.ndarray:
    out = np.zeros(len(gram), ENTRY)
    out["gram"], out["at"], out["word"], out["merges"] = mix64(gram + block * _STEP), at, word, merges
    return out


class Letters:
    """Letters of many words, from their first and from their last on. Words of
    up to ``WIDTH`` letters lie in one matrix; longer ones are laid out on demand."""

    def __init__(self, words: np.ndarray):
        self.words, self.size = words, np.array([len(w) for w in words], np.int64)
        short = [w if len(w) <= WIDTH else b"" for w in words]
        self.heads, self.tails = _matrix(short, WIDTH), _matrix([w[::-1] for w in short], WIDTH)

    def rows(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width <= WIDTH:
            return self.heads[at, :width], self.tails[at, :width]
        return _matrix(self.words[at], width), _matrix([w[::-1] for w in self.words[at]], width)

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a, and words b of one length, as long or one longer,
        differ by exactly one edit: their common ends cover all but one letter."""
        width = int(self.size[b[0]]) if len(b) else 0
        common = []
        for x, y in zip(self.rows(a, width), self.rows(b, width), strict=True):
            apart = x != y
            common.append(np.where(apart.any(axis=1), apart.argmax(axis=1), width))
        return (common[0] < width) & (common[0] + common[1] >= width - 1)


def _matrix(words, width: int) -> np.ndarray:
    return np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)


def near_words(index: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs of words at one edit, found where ``a`` merges a
    list that holds ``b``; b is longer, or as long and greater."""
    def run(table: pa.Table) -> pa.Table:
        blobs, lists = table.column("blob").to_pylist(), table.column("words").to_pylist()
        rows = np.concatenate([np.frombuffer(b, ENTRY) for b in blobs])
        base = np.cumsum([0, *map(len, lists)])[:-1]
        word = rows["word"].astype(np.int64) + np.repeat(base, [len(b) // ENTRY.itemsize for b in blobs])
        words, ids = np.unique(np.array([w.encode("latin-1") for own in lists for w in own], object), return_inverse=True)
        count = np.zeros(len(words), np.int64)
        count[ids] = np.concatenate([np.array(x, np.int64) for x in table.column("n").to_pylist()])
        letters = Letters(words)
        word, size = ids[word], letters.size
        lengths = size[word]
        _, gram = np.unique(rows["gram"], return_inverse=True)
        key = gram.astype(np.int64) << 32 | lengths
        held = np.flatnonzero(~rows["merges"])
        held = held[np.argsort(key[held], kind="stable")]
        order = key[held]
        merging = np.flatnonzero(rows["merges"])
        low, high = np.searchsorted(order, key[merging]), np.searchsorted(order, key[merging] + 1, "right")
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ends = np.cumsum(high - low)
        start = 0
        while start < len(merging):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
            for a in range(0, int((high - low)[start]) if stop == start + 1 else 1, PAIRS):  # a long list in pieces
                lo = low[start:stop] + a
                n = np.minimum(high[start:stop] - lo, PAIRS) if stop == start + 1 else high[start:stop] - lo
                x = np.repeat(merging[start:stop], n)
                y = held[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                moved = rows["at"][y].astype(np.int64) - rows["at"][x]
                ok = (word[x] != word[y]) & ((moved == 0) | (moved == lengths[y] - lengths[x]))
                x, y = word[x[ok]], word[y[ok]]
                ok = (size[x] < size[y]) | (x < y)  # words are in order
                x, y = x[ok], y[ok]
                for s in range(0, len(x), PAIRS // 4):
                    p, q = x[s:s + PAIRS // 4], y[s:s + PAIRS // 4]
                    for n in np.unique(size[q]):  # by length, so that a long word does not widen the others
                        i = size[q] == n
                        hit = letters.one_edit(p[i], q[i])
                        left.append(p[i][hit])
                        right.append(q[i][hit])
            start = stop
        pairs = np.unique(np.column_stack([np.concatenate(left), np.concatenate(right)]), axis=0)
        text = [w.decode("latin-1") for w in words]
        return pa.table({"a": pa.array([text[i] for i in pairs[:, 0]], pa.string()), "a_n": count[pairs[:, 0]],
                         "b": pa.array([text[i] for i in pairs[:, 1]], pa.string()), "b_n": count[pairs[:, 1]]})

    return index.groupBy("part").applyInArrow(run, "a string, a_n bigint, b string, b_n bigint").distinct()


# -- forms ---------------------------------------------------------------------

def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of the words that have a form: the last one, by pointer
    jumping. A form occurs TIMES as often as its word, so chains are short and
    ``rounds`` is known."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("last"))
        old, now = now, written(now.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root")), "spelling-roots")
        discard(old)
    return now


def spelling_variants(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least LETTERS
    letters that occurs at least twice in ``docs``.

    Null and empty texts have no word; a null id counts as empty text where the
    hash of id and run decides on a lost letter. Rows that repeat an id count
    again; of near words that occur equally often the smallest in code-point
    order is the form. Words of any length and texts of any length are handled
    whole. Other columns are left out. No rows give no word.
    """
    spark = docs.sparkSession
    words = written(counted(docs, doc, text).where("n >= 2"), "spelling-words")
    n, letters, most = words.agg(F.count(F.lit(1)), F.sum(F.length("word")), F.max("n")).first()
    total = (LONGEST - SHORTEST + 1) * ((letters or 0) + n * 2 * PAD)
    least = max(LEAST, -(-total // GRAMS))
    grams = frequent_grams(words, least, total // (4 * PART) + 1).toArrow()
    lists = spark.sparkContext.broadcast(Dictionary(grams.column("gram").to_numpy().view(_U), grams.column("n").to_numpy(), least))
    index = written(index_rows(words, lists, ((letters or 0) + n * PAD) // PART + 1), "spelling-index")
    pairs = written(near_words(index), "spelling-pairs")
    discard(index)
    lists.unpersist()
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    known = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.min("n").alias("own"))
    has = -F.col("best.less") >= TIMES * F.col("own")
    known = written(known.select("word", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")),
                    "spelling-known")
    chain = max(1.0, math.log(max(2, most or 0) / 2, TIMES))
    last = roots(known.where("form IS NOT NULL"), math.ceil(math.log2(chain)) + 1)
    return (words.join(known, "word", "left").join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"))
