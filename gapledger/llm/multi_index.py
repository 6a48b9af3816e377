"""Near-duplicate vectors by an inverted multi-index.

Vectors are split in halves; each half has its own codebook, and the pairs of
nearest codewords form a grid of cells per label. A vector lies in one cell and
visits others in the order of the multi-sequence algorithm: both lists of
codewords are sorted by a lower bound on the squared distance from the vector's
half to the codeword's Voronoi region (the distance to the hyperplane between
it and the nearest codeword), and cells are taken by rising sums of the two
bounds. The traversal ends at the sum ``reach``, fitted so that a pair at the
very limit of similarity is met with the target recall; nearer pairs have
smaller sums. A pair counts once, whether one side or both visit the other's
cell, and is verified by its cosine in double precision.

Only the codebooks and ``reach`` are fitted on a sample; every row is indexed.
Equal vectors of one label are one class with a multiplicity. Work is dealt by
(label, first codeword); the residents of such a unit are held in a task in
chunks of bounded size, and visitors stream past in sorted order, once for each
first codeword within reach. A task returns counts per vector and a spanning set
of links, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fitted_in_task, smallest, written
from .parity_join import components

#: Linked at this cosine and above.
LIMIT = 0.93
#: Vectors that the codebooks and the reach are fitted on.
SAMPLE = 16_384
#: Share of pairs at the limit that the traversal shall meet.
RECALL = 0.995
#: Vectors in a cell of the largest label, about; the grid grows with the data.
CELL = 64
MOST_WORDS = 256
#: Bytes of residents that a task holds at once, and products made at once.
CHUNK = 16 << 20
PRODUCTS = 1 << 21


# -- vectors -------------------------------------------------------------------

def classes_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(id, label, key, vector) of each row; key and vector (the bytes of its
    numbers) are null where the vector links with nothing."""
    keys, found = [], []
    column = batch.column("vector")
    kind = "<f4" if column.type.value_type == pa.float32() else "<f8"
    labels = batch.column("label").to_pylist()
    for label, cell, ident in zip(labels, column, batch.column("id").to_pylist(), strict=True):
        v = None
        if label is not None and ident is not None and cell.is_valid and cell.values.null_count == 0 and len(cell.values):
            x = cell.values.to_numpy(zero_copy_only=False).astype(kind)
            v = (x + x.dtype.type(0)).tobytes() if np.isfinite(x).all() and x.any() else None  # -0.0 becomes 0.0
        found.append(v)
        keys.append(None if v is None else hashlib.blake2b(f"{kind} {len(label)} {label}".encode() + v, digest_size=16).digest())
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(found, pa.binary())],
                                      names=["id", "label", "key", "vector"])


def units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# -- codebooks and reach -------------------------------------------------------

def squared(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances, summed per pair alone: equal in every batch."""
    out = np.empty((len(x), len(words)))
    step = max(1, (4 << 20) // max(1, words.size))
    for a in range(0, len(x), step):
        out[a:a + step] = ((x[a:a + step, None, :] - words[None]) ** 2).sum(axis=2)
    return out


def codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    words = np.unique(x[rng.choice(len(x), min(k, len(x)), replace=False)], axis=0)
    for _ in range(rounds):
        near = (((words ** 2).sum(axis=1) - 2 * x @ words.T)).argmin(axis=1)
        sums, n = np.zeros_like(words), np.bincount(near, minlength=len(words))
        np.add.at(sums, near, x)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return np.unique(words, axis=0)


def split(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Both halves of the first ``size`` numbers, shorter vectors filled up by 0."""
    x = x[:, :size]
    if x.shape[1] < size:
        x = np.column_stack([x, np.zeros((len(x), size - x.shape[1]))])
    return [x[:, :size // 2], x[:, size // 2:]]


class Model:
    """Codebooks of the two halves and the reach of the traversal."""

    def __init__(self, books: list[np.ndarray], size: int, reach: float = 0.0):
        self.books, self.size, self.reach = books, size, reach
        self.apart = [np.sqrt(squared(b, b)) for b in books]

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: nearest codeword, and the squared lower bound to the region of each."""
        out = []
        for part, book, apart in zip(split(x, self.size), self.books, self.apart, strict=True):
            d = squared(part, book)
            near = d.argmin(axis=1)
            gap = np.maximum(2 * apart[near], 1e-300)
            out.append((near, (np.maximum(d - d[np.arange(len(d)), near][:, None], 0) / gap) ** 2))
        return out

    def meets(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The smaller sum of bounds of the two directions of each pair of rows."""
        (i, p), (j, q) = self.bounds(a)
        (k, r), (m, s) = self.bounds(b)
        at = np.arange(len(a))
        return np.minimum(p[at, k] + q[at, m], r[at, i] + s[at, j])


def fitted(x: np.ndarray, k: int, limit: float, recall: float) -> Model:
    """Codebooks of k words and a reach that meets pairs at ``limit`` with
    ``recall``: partners of the sample's vectors are made at exactly that
    cosine, half of them in random directions, half in directions of
    differences within the sample, where real data spread most."""
    rng = np.random.default_rng(20)
    size = max(2, x.shape[1] + x.shape[1] % 2)
    model = Model([codebook(h, k, rng) for h in split(x, size)], size)
    sums = []
    for away in (rng.normal(size=x.shape), x[rng.permutation(len(x))] - x[rng.permutation(len(x))] + 1e-9 * rng.normal(size=x.shape)):
        away -= (away * x).sum(axis=1, keepdims=True) * x
        away /= np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-12)
        sums.append(np.quantile(model.meets(x, limit * x + np.sqrt(1 - limit * limit) * away), recall))
    model.reach = float(min(max(sums) + 1e-9, 2 * (1 - limit) + 1e-9))  # beyond the limit's own distance nothing is linked
    return model


def fit(classes: DataFrame, n: int, largest: int, kind: str, limit: float, recall: float) -> Model | None:
    """The model from a sample of about SAMPLE classes, in one task."""
    share = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.3 * SAMPLE / max(1, n)))
    k = int(min(MOST_WORDS, max(2, np.ceil(np.sqrt(largest / CELL)))))

    def run(table: pa.Table) -> Model:
        rows = table.column("vector").to_pylist()
        size = max(map(len, rows))
        x = units([r.ljust(size, b"\0") for r in rows], kind)
        return fitted(x, k, limit, recall)

    return fitted_in_task(smallest(classes.where(share).select("key", "vector"), "key", SAMPLE), run)


# -- visits --------------------------------------------------------------------

def linked_within(model: Model, kind: str, limit: float):
    """The streaming join of one partition sorted by unit, role (residents
    first) and length: (x, y, n) with links x - y, or n links counted for x."""
    def held(parts: list[pa.RecordBatch]) -> dict:
        t = pa.Table.from_batches(parts)
        x = units(t.column("vector").to_pylist(), kind)
        (i, p), (j, q) = model.bounds(x)
        order = np.argsort(j, kind="stable")
        keys = t.column("key").take(pa.array(order)).to_pylist()
        return {"x": x[order], "i": i[order], "j": j[order], "p": p[order], "q": q[order], "key": keys, "at": {k: a for a, k in enumerate(keys)},
                "m": t.column("times").to_numpy()[order], "n": np.zeros(len(x), np.int64), "group": np.arange(len(x))}

    def visits(res: dict, part: pa.RecordBatch, out: list) -> None:
        x, keys = units(part.column("vector").to_pylist(), kind), part.column("key").to_pylist()
        times, (i, p), (j, q) = part.column("times").to_numpy(), *model.bounds(x)
        first = int(res["i"][0])
        counts = np.zeros(len(x), np.int64)
        self_at = np.array([res["at"].get(k, -1) for k in keys])
        for word in np.unique(res["j"]):
            near = np.flatnonzero(p[:, first] + q[:, word] <= model.reach)
            a, b = np.searchsorted(res["j"], [word, word + 1])
            step = max(1, PRODUCTS // 2048)
            for c in range(a, b, 2048):
                d = min(b, c + 2048)
                for s in range(0, len(near), step):
                    rows = near[s:s + step]
                    cos = x[rows] @ res["x"][c:d].T
                    hit = cos >= limit
                    for u, v in np.argwhere(np.abs(cos - limit) < 1e-9):  # rounding must not depend on the block
                        hit[u, v] = (x[rows[u]] * res["x"][c + v]).sum() >= limit
                    same = np.flatnonzero((self_at[rows] >= c) & (self_at[rows] < d))
                    hit[same, self_at[rows[same]] - c] = False
                    if not hit.any():
                        continue
                    counts[rows] += hit @ res["m"][c:d]
                    u, v = np.nonzero(hit)
                    # a resident that does not visit the visitor's cell would miss the link
                    back = res["p"][c + v, i[rows[u]]] + res["q"][c + v, j[rows[u]]] > model.reach
                    np.add.at(res["n"], c + v[back], times[rows[u[back]]])
                    self_links(res["group"], c, hit, [keys[r] for r in rows], res["key"], out)
        out += [(keys[r], None, int(counts[r])) for r in np.flatnonzero(counts)]

    def self_links(group, c, hit, left, right, out) -> None:
        """Links that span what ``hit`` connects; residents already connected give one."""
        some = np.flatnonzero(hit.any(axis=1))
        at = hit[some].argmax(axis=1)
        out += [(left[r], right[c + v], None) for r, v in zip(some, at, strict=True)]
        here = group[c:c + hit.shape[1]]
        low, high = np.where(hit[some], here, len(group)).min(axis=1), np.where(hit[some], here, -1).max(axis=1)
        for r in some[low != high]:
            v = np.flatnonzero(hit[r])
            found, one = np.unique(group[c + v], return_index=True)
            if len(found) > 1:
                out += [(right[c + v[one[0]]], right[c + v[o]], None) for o in one[1:]]
                group[np.isin(group, found[1:])] = found[0]

    def rows_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int64()))],
                                          names=["x", "y", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts, res, out = None, [], None, []

        def left() -> list:
            return [] if res is None else [(res["key"][k], None, int(res["n"][k])) for k in np.flatnonzero(res["n"])]

        for batch in batches:
            names = list(zip(*[batch.column(c).to_pylist() for c in ("label", "length", "word", "chunk", "visitor")], strict=True))
            cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if names[a][:4] != unit:
                    out += left()
                    unit, parts, res = names[a][:4], [], None
                if not names[a][4]:
                    parts.append(part)
                elif parts:
                    res = res or held(parts)
                    visits(res, part, out)
            if out:
                yield rows_of(out)
                out = []
        yield rows_of(out + left())

    return run


def visitors(classes: DataFrame, model: Model, kind: str) -> DataFrame:
    """Each class as a resident of its unit (label, length, word) and as a
    visitor of every first codeword within reach."""
    def run(batches):
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            lengths = np.array([len(v) for v in vectors], np.int64)
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                for cut in range(0, len(at), 4096):
                    own = at[cut:cut + 4096]
                    (i, p), (j, q) = model.bounds(units([vectors[k] for k in own], kind))
                    # the second half's own codeword has bound 0: the traversal starts there
                    row, word = np.nonzero(p <= model.reach)
                    take = pa.array(np.concatenate([own, own[row]]))
                    part = batch.take(take)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(len(take), size)), pa.array(np.concatenate([i, word]).astype(np.int32)),
                         pa.array(np.arange(len(take)) >= len(own))], names=[*part.schema.names, "length", "word", "visitor"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{kinds}, length bigint, word int, visitor boolean")


def near_duplicates(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label",
                    limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """(ident, n_links, component_id, kept) of every row of ``vectors``.

    Rows are compared within equal labels and equal lengths. A null label or id,
    or a vector that is null, empty, zero or holds null or non-finite numbers,
    links with nothing (0 links, alone; a null id has a null component and is
    not kept). Equal vectors are linked with each other; rows that repeat an id
    are vectors of their own and share its smallest component. Other columns are
    left out.
    """
    rows = vectors.select(F.col(ident).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    idkind = vectors.schema[ident].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield classes_of(batch)

    rows = written(rows.mapInArrow(run, f"id {idkind}, label string, key binary, vector binary"), "multi-rows")
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("times"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = written(classes, "multi-classes")
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    model = fit(classes, sizes[0] or 0, sizes[1] or 0, kind, limit, recall)
    if model is None:
        found = written(rows.sparkSession.createDataFrame([], "x binary, y binary, n bigint"), "multi-links")
    else:
        dealt = visitors(classes.select("key", "times", "label", "vector"), model, kind)
        unit = ["label", "length", "word"]
        chunks = (dealt.where("NOT visitor").groupBy(*unit).agg(F.count(F.lit(1)).alias("residents"))
                  .select(*unit, F.ceil(F.col("residents") * F.col("length") / int(CHUNK)).alias("chunks")))
        own = F.array(F.pmod(F.xxhash64("key", F.lit(2)), F.col("chunks")))
        every = F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)
        dealt = dealt.join(chunks, unit).withColumn("chunk", F.explode(F.when(F.col("visitor"), every).otherwise(own))).drop("chunks")
        order = [*unit, "chunk", "visitor"]
        found = written(dealt.repartition(*unit, "chunk").sortWithinPartitions(*order)
                        .mapInArrow(linked_within(model, kind, limit), "x binary, y binary, n bigint"), "multi-links")
    counts = found.where("n IS NOT NULL").groupBy(F.col("x").alias("key")).agg(F.sum("n").alias("n"))
    groups = components(found.where("y IS NOT NULL").select("x", "y"))
    parts = classes.select("key", "id", "times").join(counts, "key", "left").join(groups.withColumnRenamed("node", "key"), "key", "left")
    parts = written(parts.select("key", "id", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                                 F.coalesce("component", "key").alias("component")), "multi-parts")
    lowest = parts.groupBy("component").agg(F.min("id").alias("component_id"))
    parts = parts.join(lowest, "component").select("key", "n_links", "component_id")
    discard(found)
    out = rows.select("id", "key").join(parts, "key", "left").select(
        F.col("id").alias(ident), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(ident) == F.col("component_id"), F.lit(False)))
