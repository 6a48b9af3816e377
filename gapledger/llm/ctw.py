"""LM scoring by context-tree weighting over bytes.

A text is its words (A-Z lower-cased), each followed by a space, and a line
end. A byte is coded as eight binary decisions; for each decision, a context
tree over the bytes before it (spaces before the text's start) holds zero and
one counts. A node's weighted probability is the mean of its
Krichevsky-Trofimov estimate and the product of its children's; so all depths
are mixed, and the tree's posterior gives the share of each depth when a text
is coded. A context without training counts uses the deepest one that has some.

``score_streams`` codes the whole text, so contexts reach across spaces into the
words before. Texts become blocks of bounded size. The distinct (context, byte)
grams and words of a block are dealt to parts as sorted, compressed arrays and
counted there over all blocks; each part notes which of its grams a block has and
sends the figures back in that order, so no gram travels twice.

``score_texts`` cuts contexts at the word's start (spaces before it). The code
length of a word then depends on the word alone: words are counted and coded
once over the whole corpus, and each block joins the figures of its words. It
is cheaper, and a model of isolated words only.

Nothing that grows with the corpus is held in one
place: words and n-grams are shuffled, subtrees are built below the three
nearest context bytes, the levels above them are summed per context, and the
driver only sees the 255 sums of the root and the totals.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Vocabulary, mix64, release, slices, sums, tidy, tidy_group, written

_U = np.uint64
LN2 = float(np.log(2))
#: Word that stands for the end of a text; no word holds it.
END = b"\n"
#: Subtrees are built below contexts of so many nearest bytes.
NEAR = 3
#: What stands before a stream.
PAD = b" " * 7


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0: shifted to 8 and more, then Stirling's series."""
    x = np.array(x, np.float64)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift[low] += np.log(x[low])
        x[low] += 1
    i = 1 / x
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + i / 12 - i ** 3 / 360 + i ** 5 / 1260 - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return _lgamma_of(n0, 0.5) + _lgamma_of(n1, 0.5) - _lgamma_of(n0 + n1, 1.0) - np.log(np.pi)


#: log Gamma of small counts, plus a half and plus one.
_SMALL = {shift: lgamma(np.arange(1 << 12) + shift) for shift in (0.5, 1.0)}


def _lgamma_of(n: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(n + shift) of whole numbers n."""
    small = _SMALL[shift]
    out = small.take(np.minimum(n, len(small) - 1).astype(np.int64))
    large = np.flatnonzero(n >= len(small))
    out[large] = lgamma(n[large] + shift)
    return out


def word_grams(words: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram of each coded byte, first gram of each word and the end). A gram
    packs the context, nearest byte highest, and the coded byte lowest; the
    depth is 7 at most. Tables hold grams as signed numbers of the same bits."""
    pad = b" " * depth
    data = np.frombuffer(b"".join([pad + w + (b"" if w == END else b" ") for w in words]), np.uint8)
    coded = np.fromiter((len(w) + (w != END) for w in words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(coded)])
    at = np.arange(starts[-1]) + np.repeat(np.arange(1, len(words) + 1) * depth, coded)
    gram = np.zeros(len(at), np.uint64)
    for back in range(1, depth + 1):
        gram = gram << _U(8) | data[at - back]
    return gram << _U(8) | data[at], starts


@dataclass
class Level:
    """Nodes of one depth and one decision."""

    nodes: np.ndarray  # sorted: context << decision | bits so far
    of_gram: np.ndarray  # node of each of this depth's grams
    n: np.ndarray
    n1: np.ndarray
    log_pw: np.ndarray
    own: np.ndarray  # posterior share of the node's own estimate


def _levels(gram: np.ndarray, count: np.ndarray, below: list[Level] | None) -> list[Level]:
    out = []
    for j in range(8):
        node = gram >> _U(8 - j)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        of_gram = np.cumsum(np.concatenate([[0], node[1:] != node[:-1]]))
        nodes = node[first]
        n = np.add.reduceat(count, first).astype(np.float64)
        n1 = np.add.reduceat(count * (gram >> _U(7 - j) & _U(1)).astype(np.int64), first).astype(np.float64)
        kt = log_kt(n - n1, n1)
        if below is None:
            log_pw = kt
        else:
            child = below[j].nodes
            parent = (child >> _U(j + 8)) << _U(j) | child & _U((1 << j) - 1)
            children = np.bincount(np.searchsorted(nodes, parent), weights=below[j].log_pw, minlength=len(nodes))
            log_pw = np.logaddexp(kt, children) - LN2
        out.append(Level(nodes, of_gram, n, n1, log_pw, np.exp(np.minimum(kt - LN2 - log_pw, 0.0))))
    return out


def build(gram: np.ndarray, count: np.ndarray, depth: int, to: int = 1) -> list[tuple[np.ndarray, list[Level]]]:
    """Levels from ``depth`` down to ``to``; each with the place of every one
    of the given (sorted, distinct) grams among the depth's own grams."""
    place = np.arange(len(gram))
    out = [(place, _levels(gram, count, None))]
    for d in range(depth - 1, to - 1, -1):
        shorter = (gram >> _U(16)) << _U(8) | gram & _U(255)
        gram, inverse = np.unique(shorter, return_inverse=True)
        count = np.bincount(inverse, weights=count, minlength=len(gram))
        place = inverse[place]
        out.append((place, _levels(gram, count.astype(np.int64), out[-1][1])))
    return out


@dataclass
class Root:
    """Depth zero: per decision node 1..255 counts and posterior share."""

    n: np.ndarray
    n1: np.ndarray
    own: np.ndarray


def make_root(symbols: np.ndarray, children: np.ndarray) -> Root:
    """From counts of the 256 byte values and the sum of the depth-one nodes' log probabilities."""
    n, n1 = np.zeros(256), np.zeros(256)
    for j in range(8):
        for s in range(256):
            node = 1 << j | s >> (8 - j)
            n[node] += symbols[s]
            n1[node] += symbols[s] * (s >> (7 - j) & 1)
    kt = log_kt(n - n1, n1)
    return Root(n, n1, np.exp(np.minimum(kt - np.logaddexp(kt, children), 0.0)))


def log10_probability(gram: np.ndarray, levels: list[tuple[np.ndarray, list[Level]]], root: Root) -> np.ndarray:
    """Of each gram's coded byte, mixed over all depths with training counts."""
    out = np.zeros(len(gram))
    symbol = (gram & _U(255)).astype(np.int64)
    for j in range(8):
        bit = symbol >> (7 - j) & 1
        p, known = np.full(len(gram), 0.5), np.zeros(len(gram), bool)
        steps = []
        for place, depth in levels:
            x = depth[j]
            at = x.of_gram[place]
            steps.append((x.n[at], x.n1[at], x.own[at]))
        at = 1 << j | symbol >> (8 - j)
        steps.append((root.n[at], root.n1[at], root.own[at]))
        for n, n1, own in steps:
            kt = (np.where(bit == 1, n1, n - n1) + 0.5) / (n + 1)
            p = np.where(n > 0, np.where(known, own * kt + (1 - own) * p, kt), p)
            known |= n > 0
        out += np.log10(p)
    return out


# -- blocks of documents ------------------------------------------------------

def pack_ids(ids: np.ndarray) -> bytes:
    """Sorted ids as byte planes of their differences, deflated."""
    ids = np.sort(ids).astype(np.int32)
    planes = np.diff(ids, prepend=np.int32(0)).astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 1)


def unpack_ids(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel())


def blocks(docs: DataFrame, doc: str, text: str, training: str, block_bytes: int) -> DataFrame:
    """Rows of two kinds: a document (doc, training, ids) and a word of a block
    (lid, word, n_train). A block is at most ``block_bytes`` of one task's
    texts, or one text."""
    kind = docs.schema[doc].dataType.simpleString()
    schema = f"block bigint, doc {kind}, training boolean, ids binary, lid int, word binary, n_train bigint"

    def run(batches):
        seq, size, vocab, held, kept_type = TaskContext.get().partitionId() << 24, 0, Vocabulary(), [], None

        def flush():
            if not held:
                return
            n = len(vocab)
            counts = np.zeros(n, np.int64)
            for _, train, ids in held:
                if train:
                    counts += np.bincount(ids, minlength=n) if len(ids) > n // 8 else 0
                    if len(ids) <= n // 8:
                        np.add.at(counts, ids, 1)
            for at in range(0, len(held), 2000):
                part = held[at:at + 2000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seq] * len(part), pa.int64()), pa.array([d for d, _, _ in part], kept_type),
                     pa.array([t for _, t, _ in part], pa.bool_()), pa.array([pack_ids(i) for _, _, i in part], pa.binary()),
                     pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.int64())],
                    names=names)
            words = list(vocab)
            for at in range(0, n, 100_000):
                part = words[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seq] * len(part), pa.int64()), pa.nulls(len(part), kept_type), pa.nulls(len(part), pa.bool_()),
                     pa.nulls(len(part), pa.binary()), pa.array(np.arange(at, at + len(part)), pa.int32()),
                     pa.array(part, pa.binary()), pa.array(counts[at:at + len(part)], pa.int64())], names=names)

        names = ["block", "doc", "training", "ids", "lid", "word", "n_train"]
        for batch in batches:
            kept_type = batch.schema.field(doc).type
            for part, found in slices(batch, text):
                for d, t, x in zip(part.column(doc).to_pylist(), part.column(training).to_pylist(), found, strict=True):
                    if held and size + len(x) > block_bytes:
                        yield from flush()
                        seq, size, vocab, held = seq + 1, 0, Vocabulary(), []
                    words = x.lower().split()
                    words.append(END)
                    held.append((d, bool(t), vocab.ids(words).astype(np.int32)))
                    size += len(x)
        yield from flush()

    return docs.select(doc, text, training).mapInArrow(run, schema)


def cells(words: DataFrame, depth: int, cell_words: int) -> DataFrame:
    """(word, c) rows in cells of at most ``cell_words`` words of one task: the
    rows themselves and, for each cell, its distinct grams with their counts."""
    def run(batches):
        cell, held, counts = TaskContext.get().partitionId() << 24, [], []
        names = ["cell", "word", "c", "gram", "n"]

        def flush():
            c = np.concatenate(counts)
            for at in range(0, len(held), 100_000):
                part = held[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell] * len(part), pa.int64()), pa.array(part, pa.binary()),
                     pa.array(c[at:at + len(part)], pa.int64()), pa.nulls(len(part), pa.int64()),
                     pa.nulls(len(part), pa.int64())], names=names)
            gram, starts = word_grams(held, depth)
            distinct, inverse = np.unique(gram.view(np.int64), return_inverse=True)
            n = np.bincount(inverse, weights=np.repeat(c, np.diff(starts)), minlength=len(distinct)).astype(np.int64)
            for at in range(0, len(distinct), 200_000):
                g = distinct[at:at + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(g), cell), pa.int64()), pa.nulls(len(g), pa.binary()), pa.nulls(len(g), pa.int64()),
                     pa.array(g, pa.int64()), pa.array(n[at:at + len(g)], pa.int64())], names=names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, cell_words - len(held))
                held.extend(part.column("word").to_pylist())
                counts.append(part.column("c").to_numpy(zero_copy_only=False))
                at += part.num_rows
                if len(held) >= cell_words:
                    yield from flush()
                    cell, held, counts = cell + 1, [], []
        if held:
            yield from flush()

    return words.mapInArrow(run, "cell bigint, word binary, c bigint, gram bigint, n bigint")


def _sorted_grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    gram, n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(gram)
    return gram[order], n[order]


def _nodes(levels: list[Level]) -> pa.Table:
    """One row per node of a depth: context, decision node 1..255, counts and log probability."""
    none = pa.schema([("ctx", pa.int64()), ("node", pa.int32()), ("n", pa.float64()), ("n1", pa.float64()), ("pw", pa.float64())])
    return pa.concat_tables(pa.table({
        "ctx": (x.nodes >> _U(j)).view(np.int64), "node": (1 << j | (x.nodes & _U((1 << j) - 1)).astype(np.int32)).astype(np.int32),
        "n": x.n, "n1": x.n1, "pw": x.log_pw}) for j, x in enumerate(levels)) if levels else none.empty_table()


def parents(nodes: DataFrame) -> DataFrame:
    """The nodes one context byte above ``nodes``, with their posterior share."""
    def run(batches):
        for t in batches:
            n, n1, children = (t.column(k).to_numpy() for k in ("n", "n1", "pw"))
            kt = log_kt(n - n1, n1)
            pw = np.logaddexp(kt, children) - LN2
            yield pa.RecordBatch.from_arrays(
                [t.column("ctx"), t.column("node"), t.column("n"), t.column("n1"), pa.array(pw),
                 pa.array(np.exp(np.minimum(kt - LN2 - pw, 0.0)))], names=["ctx", "node", "n", "n1", "pw", "own"])

    above = (nodes.groupBy(F.shiftrightunsigned("ctx", 8).alias("ctx"), "node")
             .agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"), F.sum("pw").alias("pw")))
    return above.mapInArrow(run, "ctx bigint, node int, n double, n1 double, pw double, own double")


def _above(t: pa.Table, gram: np.ndarray, depth: int, d: int) -> tuple[np.ndarray, list[Level]]:
    """The levels of depth ``d`` from rows of ``parents``, as ``build`` gives them."""
    t = t.filter(pa.compute.equal(t.column("d"), d))
    ctx, node, n, n1, own = (t.column(k).to_numpy() for k in ("ctx", "node", "n", "n1", "own"))
    out = []
    for j in range(8):
        here = np.flatnonzero(node >> j == 1)
        key = ctx[here].astype(np.uint64) << _U(j) | (node[here] - (1 << j)).astype(np.uint64)
        order = np.argsort(key)
        key, here = key[order], here[order]
        asked = (gram >> _U(8 * (depth + 1 - d))) << _U(j) | (gram & _U(255)) >> _U(8 - j)
        out.append(Level(key, np.searchsorted(key, asked), n[here], n1[here], np.zeros(0), own[here]))
    return np.arange(len(gram)), out


def _upper(nodes: DataFrame, near: int) -> tuple[DataFrame | None, Root]:
    """From the nodes of the ``near`` nearest bytes with their part: the levels
    above them that each part's contexts lie under, and the root."""
    contexts, above, top = nodes.select("ctx", "part").distinct(), [], nodes.drop("part")
    for d in range(near - 1, 0, -1):
        top = written(parents(top), "ctw-nodes")
        own = contexts.select("part", F.shiftrightunsigned("ctx", 8 * (near - d)).alias("ctx")).distinct()
        above.append(own.join(top, "ctx").select(F.col("part").alias("own_part"), F.lit(d).alias("d"), "ctx", "node", "n", "n1", "own"))

    symbols, children = np.zeros(256), np.zeros(256)
    for r in top.groupBy("node").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"), F.sum("pw").alias("pw")).collect():  # 255 rows
        children[r.node] = r.pw
        if r.node >= 128:  # the last decision tells two symbols apart
            symbols[2 * (r.node - 128)], symbols[2 * (r.node - 128) + 1] = r.n - r.n1, r.n1
    return reduce(DataFrame.union, above) if above else None, make_root(symbols, children)


def gram_scores(grams: DataFrame, depth: int, parts: int = 1) -> DataFrame:
    """(gram, log10 probability) of distinct grams with training counts ``n``.

    Subtrees below the NEAR nearest bytes are dealt by hash to ``parts`` tasks,
    so a task holds its share of the grams, or those of one context of NEAR
    bytes. The few nodes above are summed per context and decision, and each
    task gets those its own contexts lie under; the driver sees the 255 sums of
    the root.
    """
    near = min(NEAR, depth)

    def part(context: Column) -> Column:
        return F.pmod(F.xxhash64(context), F.lit(parts)).alias("part")

    rows = grams.select("gram", "n", part(F.shiftrightunsigned("gram", 8 * (depth + 1 - near))))

    def subtrees(t: pa.Table) -> pa.Table:
        gram, n = _sorted_grams(t)
        return _nodes(build(gram, n, depth, near)[-1][1])

    kind = "ctx bigint, node int, n double, n1 double, pw double"
    nodes = written(rows.groupBy("part").applyInArrow(subtrees, kind), "ctw-nodes")
    above, root = _upper(nodes.withColumn("part", part(F.col("ctx"))), near)

    def scored(t: pa.Table, up: pa.Table | None) -> pa.Table:
        gram, n = _sorted_grams(t)
        levels = build(gram, n, depth, near) + [_above(up, gram, depth, d) for d in range(near - 1, 0, -1)]
        return pa.table({"gram": gram.view(np.int64), "log_p": log10_probability(gram, levels, root)})

    result = "gram bigint, log_p double"
    if above is None:
        return rows.groupBy("part").applyInArrow(lambda t: scored(t, None), result)
    return rows.groupBy("part").cogroup(above.groupBy("own_part")).applyInArrow(scored, result)


def score_texts(docs: DataFrame, training: str = "training", doc: str = "doc_id", text: str = "text", depth: int = 7,
                block_bytes: int = 48 << 20, cell_words: int = 250_000, part_grams: int = 1 << 17) -> DataFrame:
    """Per document: doc, training, n_tokens, n_known, train_tokens, base_score
    and score, learned from the rows where ``training`` holds.

    A null text is empty (its end is its only token); repeated rows stay
    repeated; a null ``training`` counts as false; without training rows every
    decision has probability one half. Other columns of ``docs`` are left out.
    """
    made = written(blocks(docs, doc, text, training, block_bytes), "ctw-blocks")
    in_blocks = made.where("word IS NOT NULL").select("block", "lid", "word", "n_train")
    # the vocabulary grows no faster than the blocks; fewer, fuller cells repeat fewer grams
    tasks = made.agg(F.countDistinct("block")).first()[0] // 2 + 1
    vocabulary = in_blocks.groupBy("word").agg(F.sum("n_train").alias("c")).coalesce(tasks)
    counted = written(cells(vocabulary, depth, cell_words), "ctw-cells")
    words = counted.where("word IS NOT NULL").select("cell", "word", "c")
    in_cells = counted.where("word IS NULL").select("cell", "gram", "n")
    total = counted.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"), F.count("gram").alias("grams")).first()
    n, v = int(total.n or 0), int(total.v)

    scored = gram_scores(in_cells.groupBy("gram").agg(F.sum("n").alias("n")), depth,
                         int(total.grams) // part_grams + 1)
    by_cell = in_cells.select(F.col("cell").alias("own_cell"), "gram").join(scored, "gram").groupBy("own_cell")

    def word_scores(left: pa.Table, right: pa.Table) -> pa.Table:
        gram, log_p = right.column("gram").to_numpy().view(np.uint64), right.column("log_p").to_numpy()
        order = np.argsort(gram)
        gram, log_p = gram[order], log_p[order]
        own, starts = word_grams(left.column("word").to_pylist(), depth)
        p = sums(log_p[np.searchsorted(gram, own)], starts) if len(own) else np.zeros(0)
        return pa.table({"word": left.column("word"), "c": left.column("c"), "log_p": p})

    figures = words.groupBy("cell").cogroup(by_cell).applyInArrow(word_scores, "word binary, c bigint, log_p double")
    by_block = in_blocks.join(figures, "word").select(F.col("block").alias("own_block"), "lid", "c", "log_p").groupBy("own_block")
    kind = docs.schema[doc].dataType.simpleString()
    log_all = float(np.log10(n + 0.5 * (v + 1)))

    def document_scores(left: pa.Table, right: pa.Table) -> pa.Table:
        lid = right.column("lid").to_numpy()
        c, log_p = np.zeros(len(lid)), np.zeros(len(lid))
        c[lid], log_p[lid] = right.column("c").to_numpy(), right.column("log_p").to_numpy()
        log_c = np.log10(c + 0.5)
        rows = np.zeros((left.num_rows, 4))
        for i, x in enumerate(left.column("ids").to_pylist()):
            ids = unpack_ids(x)
            rows[i] = len(ids), np.count_nonzero(c[ids]), log_c[ids].sum() - len(ids) * log_all, log_p[ids].sum()
        return pa.table({"doc": left.column("doc"), "training": left.column("training"),
                         "n_tokens": rows[:, 0].astype(np.int64), "n_known": rows[:, 1].astype(np.int64),
                         "train_tokens": np.full(left.num_rows, n), "base_score": rows[:, 2], "score": rows[:, 3]})

    return (made.where("ids IS NOT NULL").select("block", "doc", "training", "ids").groupBy("block").cogroup(by_block)
            .applyInArrow(document_scores, f"doc {kind}, training boolean, n_tokens bigint, n_known bigint, "
                                           "train_tokens bigint, base_score double, score double")
            .withColumnRenamed("doc", doc).withColumnRenamed("training", training))


#: A block's positions are picked by the two nearest bytes in so many turns (a power of two), so that
#: memory stays a share of the block's, and sorted in as many lots of a turn, by the third: short arrays sort faster.
TURNS = 8
LOTS = TURNS * TURNS


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, kind) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], n * kind.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel()


def pack_grams(grams: np.ndarray) -> bytes:
    """Of sorted grams: contexts repeat, so their differences and the coded bytes are packed apart."""
    context = grams >> _U(8)
    return pack(np.diff(context, prepend=_U(0))) + (grams & _U(255)).astype(np.uint8).tobytes()


def unpack_grams(data: bytes, n: int) -> np.ndarray:
    coded = np.frombuffer(data, np.uint8)[len(data) - n:]
    return np.cumsum(unpack(data[:len(data) - n], np.uint64), dtype=np.uint64) << _U(8) | coded


def stream_blocks(docs: DataFrame, doc: str, text: str, training: str, block_bytes: int) -> DataFrame:
    """One row per block: its documents, whether they train, the bytes of their
    streams and the streams, each after spaces, compressed. A block is at most
    ``block_bytes`` of one task's texts, or one text."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches):
        seq, size, held, kept_type = TaskContext.get().partitionId() << 24, 0, [], None

        def flush():
            sizes = [len(x) for _, _, x in held]
            stream = pa.compress(b"".join(PAD + x for _, _, x in held), "zstd", asbytes=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([seq], pa.int64()), pa.array([[d for d, _, _ in held]], pa.list_(kept_type)),
                 pa.array([[t for _, t, _ in held]], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([stream], pa.binary())], names=["block", "doc", "training", "size", "stream"])

        for batch in batches:
            kept_type = batch.schema.field(doc).type
            for part, found in slices(batch, text):
                for d, t, x in zip(part.column(doc).to_pylist(), part.column(training).to_pylist(), found, strict=True):
                    if held and size + len(x) > block_bytes:
                        yield flush()
                        seq, size, held = seq + 1, 0, []
                    words = x.lower().split()
                    words.append(END)
                    held.append((d, bool(t), b" ".join(words)))
                    size += len(x)
        if held:
            yield flush()

    return docs.select(doc, text, training).mapInArrow(
        tidy(run), f"block bigint, doc array<{kind}>, training array<boolean>, size array<bigint>, stream binary")


class Block:
    """The streams of one block, read from its row."""

    def __init__(self, row: pa.Table | pa.RecordBatch, i: int = 0):
        self.doc = row.column("doc")[i].values
        self.training = np.array(row.column("training")[i].values.to_pylist(), bool)
        self.size = row.column("size")[i].values.to_numpy()
        self.ends = np.cumsum(self.size + len(PAD))
        self.streams = pa.decompress(row.column("stream")[i].as_py(), int(self.ends[-1]), "zstd", asbytes=True)

    def words(self) -> tuple[list[bytes], list[np.ndarray]]:
        """The distinct words, in order of first use, and those of each document."""
        vocabulary = Vocabulary()
        ids = [vocabulary.ids(self.streams[to - n:to].split(b" ")).astype(np.int32)
               for n, to in zip(self.size.tolist(), self.ends.tolist())]
        return list(vocabulary), ids

    def lots(self, depth: int, label: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each lot's positions: the grams, and the labels of their documents."""
        for turn in range(TURNS):
            gram, of = self._turn(turn, depth, label)
            third = (gram >> _U(8 * (depth - 2))).astype(np.uint8) & np.uint8(TURNS - 1) if depth > 2 else np.zeros(len(gram), np.uint8)
            for k in range(TURNS):
                here = np.flatnonzero(third == k)
                yield turn * TURNS + k, gram[here], of[here]

    def _turn(self, turn: int, depth: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pad, ends = len(PAD), self.ends
        data = np.frombuffer(self.streams, np.uint8)
        grams, labels, at = [], [], 0
        while at < len(ends):
            low = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, low + (1 << 20), "right")))
            high, after = int(ends[to - 1]), ends[at:to] - low - pad
            near = data[low + pad - 1:high - 1] + (data[low + pad - 2:high - 2] if depth > 1 else np.uint8(0))
            mine = near & np.uint8(TURNS - 1) == turn
            mine[(after[:-1, None] + np.arange(pad)).ravel()] = False  # spaces before a stream
            here = np.flatnonzero(mine)
            # the eight bytes that end at each position, the coded one highest
            eight = np.ndarray((high - low - pad,), "<u8", self.streams, low, (1,))[here]
            grams.append((eight << _U(8) >> _U(8 * (8 - depth))) << _U(8) | eight >> _U(56))
            labels.append(np.repeat(label[at:to], np.diff(np.searchsorted(here, after), prepend=0)))
            at = to
        return np.concatenate(grams), np.concatenate(labels)


def gram_parts(grams: np.ndarray, depth: int, per_lot: int) -> list[np.ndarray]:
    """Where the grams of each of a lot's parts lie; a part has whole contexts of the nearest bytes."""
    of = (mix64(grams >> _U(8 * (depth + 1 - min(NEAR, depth)))) % _U(per_lot)).astype(np.uint32)
    order = np.argsort(of, kind="stable")
    return np.split(order, np.searchsorted(of[order], np.arange(1, per_lot)))


def word_parts(words: list[bytes], parts: int) -> list[np.ndarray]:
    """Where the words of each part lie."""
    of = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(parts)
    order = np.argsort(of, kind="stable")
    return np.split(order, np.searchsorted(of[order], np.arange(1, parts)))


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted grams and how often each comes."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(grams)), bool), grams[1:] != grams[:-1]]))
    return grams[first], np.diff(first, append=len(grams))


def block_parts(made: DataFrame, depth: int, per_lot: int) -> DataFrame:
    """Rows (part, block): the block's distinct grams and words that belong to
    the part, with training counts."""
    names = ["part", "block", "n", "gram", "gram_n", "word", "word_bytes", "word_n"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                words, ids = block.words()
                known = np.bincount(np.concatenate([x for x, t in zip(ids, block.training) if t] + [np.zeros(0, np.int32)]),
                                    minlength=len(words))
                del ids
                words_of = word_parts(words, LOTS * per_lot)
                for lot, gram, learned in block.lots(depth, block.training):
                    trained, n = _distinct(np.sort(gram[learned]))
                    other, _ = _distinct(np.sort(gram[~learned]))
                    gram, _ = _distinct(np.sort(np.concatenate([trained, other])))
                    count = np.zeros(len(gram), np.int64)
                    count[np.searchsorted(gram, trained)] = n
                    rows = []
                    for p, of in enumerate(gram_parts(gram, depth, per_lot), lot * per_lot):
                        here = words_of[p]
                        if len(of) or len(here):
                            joined = b" ".join(words[k] for k in here.tolist())
                            rows.append((p, batch.column("block")[i].as_py(), len(of), pack_grams(gram[of]), pack(count[of]),
                                         pa.compress(joined, "zstd", asbytes=True) if len(here) else b"", len(joined), pack(known[here])))
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                                                                         pa.binary(), pa.int64(), pa.binary()))],
                            names=names)

    return made.mapInArrow(tidy(run), "part int, block bigint, n bigint, gram binary, gram_n binary, word binary, "
                                      "word_bytes bigint, word_n binary")


def merge_part(t: pa.Table, depth: int) -> pa.Table:
    """A part's grams and words counted over its blocks. Rows of three kinds:
    the part's grams with the words' totals; per block, which of these grams it
    has and the counts of its words; the nodes of the nearest bytes' contexts."""
    part = t.column("part")[0].as_py()
    own = [unpack_grams(g, n) for g, n in zip(t.column("gram").to_pylist(), t.column("n").to_pylist())]
    gram, _ = _distinct(np.sort(np.concatenate(own)))
    count, member = np.zeros(len(gram), np.int64), []
    for g, n in zip(own, t.column("gram_n").to_pylist()):
        at = np.searchsorted(gram, g)
        count[at] += unpack(n, np.int64)
        has = np.zeros(len(gram), bool)
        has[at] = True
        member.append(pa.compress(np.packbits(has).tobytes(), "zstd", asbytes=True))
    known, words = Counter(), []
    for w, size, n in zip(t.column("word").to_pylist(), t.column("word_bytes").to_pylist(), t.column("word_n").to_pylist()):
        words.append(pa.decompress(w, size, "zstd", asbytes=True).split(b" ") if w else [])
        for x, c in zip(words[-1], unpack(n, np.int64).tolist()):
            known[x] += c
    tokens, distinct = sum(known.values()), sum(c > 0 for c in known.values())
    word_n = [pack(np.fromiter(map(known.__getitem__, w), np.int64, len(w))) for w in words]
    nodes = _nodes(build(gram, count, depth, min(NEAR, depth))[-1][1] if len(gram) else [])
    rows = [pa.table({"part": pa.array([part], pa.int32()), "size": [len(gram)], "gram": pa.array([pack_grams(gram)], pa.binary()),
                      "gram_n": pa.array([pack(count)], pa.binary()), "tokens": [tokens], "words": [distinct]}),
            pa.table({"part": pa.array([part] * t.num_rows, pa.int32()), "block": t.column("block"),
                      "member": pa.array(member, pa.binary()), "word_n": pa.array(word_n, pa.binary())}),
            nodes.append_column("part", pa.array(np.full(len(nodes), part, np.int32)))]
    return pa.concat_tables(rows, promote_options="default").select(PART_COLUMNS)


PART_ROWS = ("part int, size bigint, gram binary, gram_n binary, tokens bigint, words bigint, block bigint, member binary, word_n binary, "
             "ctx bigint, node int, n double, n1 double, pw double")
PART_COLUMNS = [x.split()[0] for x in PART_ROWS.split(", ")]


def score_streams(docs: DataFrame, training: str = "training", doc: str = "doc_id", text: str = "text", depth: int = 7,
                  block_bytes: int = 64 << 20, part_bytes: int = 256 << 20) -> DataFrame:
    """Per document the columns of ``score_texts``, the score from contexts that
    reach across words, and ``bits_per_byte``: the code length of the stream by
    its bytes, the line end included. Odd rows as for ``score_texts``."""
    size = int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)
    per_lot = size // part_bytes + 1
    # tasks of nearly a whole block: fuller blocks repeat fewer grams
    made = written(stream_blocks(docs.coalesce(size * 4 // (3 * block_bytes) + 1), doc, text, training, block_bytes), "ctw-streams")
    parts = written(block_parts(made, depth, per_lot).groupBy("part").applyInArrow(
        tidy_group(lambda t: merge_part(t, depth)), PART_ROWS), "ctw-parts")
    total = parts.agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    n, v = int(total.n or 0), int(total.v or 0)
    log_all = float(np.log10(n + 0.5 * (v + 1)))
    above, root = _upper(parts.where("ctx IS NOT NULL").select("ctx", "node", "n", "n1", "pw", "part"), min(NEAR, depth))

    def scored(t: pa.Table, up: pa.Table | None) -> pa.Table:
        whole = t.filter(pa.compute.is_valid(t.column("gram")))
        of_block = t.filter(pa.compute.is_valid(t.column("block")))
        gram, log_p = unpack_grams(whole.column("gram")[0].as_py(), whole.column("size")[0].as_py()), np.zeros(0)
        if len(gram):
            levels = build(gram, unpack(whole.column("gram_n")[0].as_py(), np.int64), depth, min(NEAR, depth))
            levels += [_above(up, gram, depth, d) for d in range(min(NEAR, depth) - 1, 0, -1)]
            log_p = log10_probability(gram, levels, root)
            del levels
        out = []
        for x in of_block.column("member").to_pylist():
            bits = np.frombuffer(pa.decompress(x, (len(gram) + 7) // 8, "zstd", asbytes=True) if len(gram) else b"", np.uint8)
            out.append(pack(log_p[np.unpackbits(bits, count=len(gram)).view(bool)]))
        return pa.table({"own_block": of_block.column("block"), "part": of_block.column("part"),
                         "log_p": pa.array(out, pa.binary()), "word_n": of_block.column("word_n")})

    rows = parts.where("ctx IS NULL").select("part", "size", "gram", "gram_n", "block", "member", "word_n").groupBy("part")
    kind = "own_block bigint, part int, log_p binary, word_n binary"
    figures = (rows.cogroup(above.groupBy("own_part")).applyInArrow(scored, kind) if above is not None
               else rows.applyInArrow(lambda t: scored(t, None), kind))

    def document_scores(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left.combine_chunks())
        own = {p: i for i, p in enumerate(right.column("part").to_pylist())}
        score = np.zeros(len(block.size))
        for lot, gram, of in block.lots(depth, np.arange(len(score), dtype=np.int32)):
            order = np.argsort(gram)
            gram, of = gram[order], of[order]
            del order
            gram, n_gram = _distinct(gram)
            log_p = np.zeros(len(gram))
            for p, at in enumerate(gram_parts(gram, depth, per_lot), lot * per_lot):
                if len(at):
                    log_p[at] = unpack(right.column("log_p")[own[p]].as_py(), np.float64)
            score += np.bincount(of, weights=np.repeat(log_p, n_gram), minlength=len(score))
        words, ids = block.words()
        counts = np.zeros(len(words), np.int64)
        for p, at in enumerate(word_parts(words, LOTS * per_lot)):
            if len(at):
                counts[at] = unpack(right.column("word_n")[own[p]].as_py(), np.int64)
        log_c = np.log10(counts + 0.5)
        rows = np.zeros((len(score), 3))
        for i, x in enumerate(ids):
            rows[i] = len(x), np.count_nonzero(counts[x]), log_c[x].sum() - len(x) * log_all
        del words, ids
        release()
        return pa.table({"doc": block.doc, "training": block.training,
                         "n_tokens": rows[:, 0].astype(np.int64), "n_known": rows[:, 1].astype(np.int64),
                         "train_tokens": np.full(len(score), n), "base_score": rows[:, 2], "score": score,
                         "bits_per_byte": -score * np.log2(10) / block.size})

    kind = docs.schema[doc].dataType.simpleString()
    return (made.groupBy("block").cogroup(figures.groupBy("own_block"))
            .applyInArrow(document_scores, f"doc {kind}, training boolean, n_tokens bigint, n_known bigint, "
                                           "train_tokens bigint, base_score double, score double, bits_per_byte double")
            .withColumnRenamed("doc", doc).withColumnRenamed("training", training))
