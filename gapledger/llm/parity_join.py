"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct five-word shingles, as 64-bit hashes. Its
parity sketch XORs each hash into one of many segments; a segment differs
between two documents only if a shingle of one and not the other lies in it, so
the number of differing segments (and the Hamming distance of a bit sketch) is
at most the symmetric difference. Documents of similarity 0.8 or more differ in
at most ``d = n // 4`` shingles; so among the ``d + 1`` first of a document's
filled segments, in any order that all documents share, one equals a segment
that the partner has among its own first ``d + 1`` (pigeonhole). The join works
per size band, with the order from rare to frequent: segment contents that
nobody shares come first, and what thousands share (licence lines, passages)
comes last and is hardly ever joined on.

Steps, each between shuffles by a hash: sketch; count each segment's content
over all documents; keep each document's ``d + 1`` rarest; form candidate pairs
per shared content; compare sizes and bit sketches; verify on whole texts.
Small buckets give all pairs. A larger one first pairs all members with one of
them; after the links so far have merged, the members that are still in
different components, and did not meet in an earlier bucket, are compared by
sizes and bit sketches, block by block, and only those that may be linked fetch
their texts, so that no link between them is lost and no task holds a bucket.
Segment contents travel as packed arrays, many per row. A verification is dealt
by the one text of a pair that more pairs have; that text travels once for all
of them, and texts that no pair has are left out before the shuffle.

A doubly hashed shingle, or a document whose shingles fill no more than ``d``
segments (chance below 1e-12), could be missed; otherwise the join is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import WordCache, among, discard, mix64, slices, tidy, tidy_group, worker_cache, written

SHINGLE = 5
#: Linked when PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Buckets up to this size give all pairs.
SMALL = 8
BLOCK = 2048
#: Pairs of one text that one task verifies.
SHARE = 256
#: Segment contents in one task of a shuffle, about.
PART = 1_500_000

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
HEAD = np.dtype([("set", "<u8"), ("band", "<u4"), ("n", "<u4"), ("filled", "<u4"), ("count", "<u4")])


def watched(df: DataFrame, name: str, *figures: Column) -> tuple[DataFrame, tuple]:
    """``df`` as ``written``, and aggregates over its rows that are taken while
    they are written: no query reads them again for that."""
    seen = Observation()
    out = written(df.observe(seen, *[f.alias(f"f{i}") for i, f in enumerate(figures)]), name)
    return out, tuple(seen.get[f"f{i}"] for i in range(len(figures)))


def twofold(first: dict, second: dict) -> Column:
    """Two rows for each, with columns of the same names."""
    return F.inline(F.array(*[F.struct(*[c.alias(k) for k, c in row.items()]) for row in (first, second)]))


# -- shingles and sketches -----------------------------------------------------

def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def shingle_sets(texts: list[bytes], cache: WordCache) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    ids, starts = cache.rows_of([t.lower().split() for t in texts])
    h = cache.rows[ids] if len(ids) else np.zeros(0, np.uint64)
    rolled = np.zeros(len(h), np.uint64)
    padded = np.append(h, np.zeros(SHINGLE, np.uint64))
    for k in range(SHINGLE):
        rolled = rolled * _STEP + padded[k:k + len(h)]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a:b - SHINGLE + 1]))
        elif b > a:
            whole = 0
            for x in h[a:b].tolist():
                whole = (whole * int(_STEP) + x + 1) & 0xFFFFFFFFFFFFFFFF
            out.append(mix64(np.array([whole ^ int(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set of shingles."""
    data = s.tobytes()
    return xxhash.xxh3_64_intdigest(data) ^ len(s), xxhash.xxh64_intdigest(data, seed=17)


def band(n: int) -> int:
    """Sizes from 4 ** band up to the next power of four."""
    return (n.bit_length() - 1) // 2


def bands(n: int) -> list[int]:
    """The size's band, and the one below if a smaller partner can lie there."""
    g = band(n)
    return [g, g - 1] if g and 4 * n < 5 * 4 ** g else [g]


def segments(g: int) -> int:
    """So many that sizes of the band fill more than n // 4 of them."""
    return 65536 if g < 2 else 1024 if g == 2 else 2 * 4 ** g if g == 3 else 3 * 4 ** g // 2


def parity_words(s: np.ndarray, g: int) -> np.ndarray:
    """A 64-bit key for the content of each filled segment."""
    n = _U(segments(g))
    at = ((s >> _U(32)) * n) >> _U(32)  # s is sorted, and so is the place
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    words = np.bitwise_xor.reduceat(mix64(s + _STEP), first)
    return np.unique(mix64(words ^ mix64(at[first] * _STEP + _U(g + 1))))


def sketch_bits(n: int) -> int:
    return max(64, 4 ** (band(n) + 1))


def bit_sketch(s: np.ndarray) -> bytes:
    m = sketch_bits(len(s))
    return np.packbits(np.bincount((s & _U(m - 1)).astype(np.int64), minlength=m) & 1).tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Both halves, quarters, ... XORed into ``size`` bytes; equal bits modulo the size meet."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def may_link(n: np.ndarray, sketches: list[bytes], m: np.ndarray, others: list[bytes]) -> np.ndarray:
    """Whether sizes and bit sketches allow each pair to be linked."""
    out = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    for i in np.flatnonzero(out):
        a, b = np.frombuffer(sketches[i], np.uint8), np.frombuffer(others[i], np.uint8)
        size = min(len(a), len(b))
        apart = np.bitwise_count(folded(a, size) ^ folded(b, size)).sum()
        out[i] = apart <= min(n[i], m[i]) // 4
    return out


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def _cache() -> WordCache:
    return worker_cache("parity_join", lambda: WordCache(word_hashes, 150_000))


def sets_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, n, set, check, sketch) of every row; set and check are digests."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part, found in slices(batch, text):
                sets = shingle_sets(found, _cache())
                ids = np.array([digest(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(doc), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]),
                     pa.array([bit_sketch(s) if len(s) else b"" for s in sets], pa.binary())],
                    names=["doc", "n", "set", "check", "sketch"])

    return docs.select(doc, text).mapInArrow(tidy(run), f"doc {kind}, n bigint, set bigint, check bigint, sketch binary")


# -- rare segment contents -----------------------------------------------------

def _packed(heads: np.ndarray, keys: np.ndarray, extra: np.ndarray | None = None) -> bytes:
    return (len(heads).to_bytes(4, "little") + heads.tobytes() + keys.astype("<u4").tobytes()
            + (b"" if extra is None else extra.astype("<u4").tobytes()))


def _unpacked(blobs: list[bytes], extras: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(heads, keys, extra, head of each key) of all blobs together."""
    heads, keys, extra = [np.zeros(0, HEAD)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    for b in blobs:
        h = np.frombuffer(b, HEAD, int.from_bytes(b[:4], "little"), 4)
        k = np.frombuffer(b, "<u4", offset=4 + h.nbytes)
        if extras:
            k, e = k[:len(k) // 2], k[len(k) // 2:]
            extra.append(e)
        heads.append(h)
        keys.append(k)
    heads, keys, extra = np.concatenate(heads), np.concatenate(keys), np.concatenate(extra)
    return heads, keys, extra, np.repeat(np.arange(len(heads), dtype=np.int32), heads["count"])


def _rows(part: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])


def _dealt(head: np.ndarray, keys: np.ndarray, extra: np.ndarray | None, heads: np.ndarray, part: np.ndarray
           ) -> Iterator[tuple[int, bytes]]:
    """Blobs by ``part`` of each key; keys of one head stay together in each."""
    if not len(part):
        return
    order = np.lexsort((head, part))
    head, keys, part = head[order], keys[order], part[order]
    extra = None if extra is None else extra[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    for a, b in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
        own = head[a:b]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        h = heads[own[first]].copy()
        h["count"] = np.diff(np.append(first, b - a))
        yield int(part[a]), _packed(h, keys[a:b], None if extra is None else extra[a:b])


def segment_rows(docs: DataFrame, text: str, parts: int) -> DataFrame:
    """(part, blob): the contents of all filled segments, dealt by their hash.
    Equal sets of one slice of rows are sketched once."""
    def run(batches):
        for batch in batches:
            for _, found in slices(batch, text, 4 << 20):
                heads, keys, seen = [], [], set()
                for s in shingle_sets(found, _cache()):
                    if len(s) and (own := digest(s)[0]) not in seen:
                        seen.add(own)
                        for g in bands(len(s)):
                            k = parity_words(s, g)
                            heads.append((own, g, len(s), len(k), len(k)))
                            keys.append(k)
                if not heads:
                    continue
                h, k = np.array(heads, HEAD), np.concatenate(keys)
                part = ((k >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
                made = list(_dealt(np.repeat(np.arange(len(h)), h["count"]), (k & _U(0xFFFFFFFF)).astype(np.uint32),
                                   None, h, part))
                yield _rows([p for p, _ in made], [b for _, b in made])

    return docs.select(text).mapInArrow(tidy(run), "part int, blob binary")


def _distinct(keys: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Places of distinct (key, set) pairs in order of key and set."""
    order = np.lexsort((sets, keys))
    k, s = keys[order], sets[order]
    return order[np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])] if len(order) else order


def shared_contents(rows: DataFrame, parts: int) -> DataFrame:
    """(part, blob) dealt by set: contents that at least two sets have, with
    the number of sets that have them."""
    def run(table: pa.Table) -> pa.Table:
        heads, keys, _, head = _unpacked(table.column("blob").to_pylist())
        here = table.column("part")[0].as_py()
        keep = _distinct(keys, heads["set"][head])
        keys, head = keys[keep], head[keep]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(first, len(keys)))
        times = np.repeat(size, size)
        keep = times > 1
        head, keys, times = head[keep], keys[keep], times[keep]

        to = (mix64(heads["set"]) >> _U(32)) * _U(parts) >> _U(32)
        made = list(_dealt(head, keys, np.minimum(times, 0xFFFFFFFF), heads, to.astype(np.int64)[head]))
        return pa.table({"part": pa.array([p for p, _ in made], pa.int32()), "source": pa.array([here] * len(made), pa.int32()),
                         "blob": pa.array([b for _, b in made], pa.binary())})

    return rows.groupBy("part").applyInArrow(tidy_group(run), "part int, source int, blob binary")


def rarest(shared: DataFrame) -> DataFrame:
    """(part, blob) dealt by content again: of each set that can have a partner
    the shared ones among its d + 1 rarest contents, each with a hash of the
    one before it in the common order."""
    def run(table: pa.Table) -> pa.Table:
        blobs, source = table.column("blob").to_pylist(), table.column("source").to_numpy()
        pieces = [_unpacked([b], True) for b in blobs]
        heads = np.concatenate([x[0] for x in pieces])
        keys = np.concatenate([x[1] for x in pieces])
        times = np.concatenate([x[2] for x in pieces])
        origin = np.repeat(source, [len(x[1]) for x in pieces]).astype(np.int64)
        head = np.repeat(np.arange(len(heads)), heads["count"])
        order = np.lexsort((keys, origin, times, heads["band"][head], heads["set"][head]))
        head, keys, origin = head[order], keys[order], origin[order]
        new = np.concatenate([[True], (heads["set"][head][1:] != heads["set"][head][:-1])
                              | (heads["band"][head][1:] != heads["band"][head][:-1])])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(keys)))
        own = heads[head[first]]
        alone = own["filled"].astype(np.int64) - size
        take = np.repeat(own["n"].astype(np.int64) // 4 + 1 - alone, size)
        rank = np.arange(len(keys)) - np.repeat(first, size)
        before = mix64(np.roll(keys, 1).astype(np.uint64) * _STEP + np.roll(origin, 1).astype(np.uint64))
        before = np.where(rank > 0, before | _U(1), mix64(heads["set"][head]) & ~_U(1)) & _U(0xFFFFFFFF)
        keep = rank < take
        made = list(_dealt(head[keep], keys[keep], before[keep].astype(np.uint32), heads, origin[keep]))
        return pa.table({"part": pa.array([p for p, _ in made], pa.int32()), "blob": pa.array([b for _, b in made], pa.binary())})

    return shared.groupBy("part").applyInArrow(tidy_group(run), "part int, blob binary")


def buckets(rare: DataFrame) -> DataFrame:
    """(a, b, bucket, size, before): candidate pairs of sets, with a null bucket,
    and members a of buckets above SMALL, with a name and the size of the
    bucket and a hash of the content before this one in the member's order; b
    is the set that all members are paired with. Two members with one content
    before met in its bucket, so a bucket of such members alone is left out."""
    def run(table: pa.Table) -> pa.Table:
        heads, keys, before, head = _unpacked(table.column("blob").to_pylist(), True)
        sets, band_of = heads["set"][head], heads["band"][head].astype(np.uint64)
        full = keys.astype(np.uint64) << _U(8) | band_of
        keep = _distinct(full, sets)
        full, sets, before = full[keep], sets[keep], before[keep]
        first = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]])) if len(full) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(full)))
        lefts, rights = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for c in range(2, SMALL + 1):
            at = first[size == c]
            for i in range(c):
                for j in range(i + 1, c):
                    fresh = before[at + i] != before[at + j]  # else the pair meets in an earlier bucket
                    lefts.append(sets[at + i][fresh])
                    rights.append(sets[at + j][fresh])
        pair = np.column_stack([np.concatenate(lefts), np.concatenate(rights)])
        pair = np.unique(pair, axis=0) if len(pair) else pair
        changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])]) if len(before) else np.zeros(0, np.int64)
        big = (size > SMALL) & (changes[first + size - 1] > changes[first])
        a, n = first[big], size[big]
        name = mix64(full[a] * _STEP + _U(table.column("part")[0].as_py()))
        place = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        alone = np.arange(len(pair) + len(place)) < len(pair)
        none = np.zeros(len(pair), np.int64)
        return pa.table({
            "a": pa.array(np.concatenate([pair[:, 0], sets[place]]).view(np.int64)),
            "b": pa.array(np.concatenate([pair[:, 1], np.repeat(sets[a], n)]).view(np.int64)),
            "bucket": pa.array(np.concatenate([none, np.repeat(name, n).view(np.int64)]), mask=alone),
            "size": pa.array(np.concatenate([none + 2, np.repeat(n, n)]), pa.int64()),
            "before": pa.array(np.concatenate([none, before[place].astype(np.int64)]), mask=alone)})

    return rare.groupBy("part").applyInArrow(tidy_group(run), "a bigint, b bigint, bucket bigint, size bigint, before bigint")


# -- links ---------------------------------------------------------------------

def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) whose sizes and bit sketches allow a link, as rows
    (x, y) of class representatives."""
    def run(batches):
        for t in batches:
            ok = may_link(t.column("n").to_numpy(), t.column("sketch").to_pylist(),
                          t.column("m").to_numpy(), t.column("other").to_pylist())
            t = t.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([t.column("x"), t.column("y")], names=["x", "y"])

    kind = sets.schema["doc"].dataType.simpleString()
    left = sets.select(F.col("set").alias("a"), F.col("doc").alias("x"), "n", "sketch")
    right = sets.select(F.col("set").alias("b"), F.col("doc").alias("y"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    return (pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(left, "a").join(right, "b").select("x", "y", "n", "sketch", "m", "other")
            .mapInArrow(tidy(run), f"x {kind}, y {kind}").where("x != y"))


def verified(pairs: DataFrame, docs: DataFrame, doc: str, text: str) -> DataFrame:
    """The pairs (x, y) whose whole texts are linked. Pairs are dealt by the end
    that more of them have, SHARE to a group; its text leads the group."""
    kind = docs.schema[doc].dataType.simpleString()
    pairs = written(pairs, "parity-candidates")
    degree = pairs.select(F.explode(F.array("x", "y")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    both = (pairs.join(degree.select(F.col("id").alias("x"), F.col("n").alias("p")).hint("merge"), "x")
            .join(degree.select(F.col("id").alias("y"), F.col("n").alias("q")).hint("merge"), "y"))
    hub = F.when(F.col("q") >= F.col("p"), F.col("y")).otherwise(F.col("x"))
    other = F.when(F.col("q") >= F.col("p"), F.col("x")).otherwise(F.col("y"))
    share = F.pmod(F.xxhash64(other, F.lit(3)), F.ceil(F.greatest("p", "q") / SHARE))
    dealt = both.select(hub.alias("hub"), share.alias("share"), other.alias("other"))
    roles = written(dealt.select("hub", "share", twofold({"id": F.col("other"), "leads": F.lit(False)}, {"id": F.col("hub"), "leads": F.lit(True)})).distinct(),
                    "parity-roles")
    discard(pairs)
    found = among(docs.select(F.col(doc).alias("id"), F.col(text).alias("text")), "id", roles.select("id"))
    rows = (found.join(roles, "id").repartition("hub", "share").sortWithinPartitions("hub", "share", F.desc("leads"))
            .select("hub", "share", "leads", "id", "text"))

    def run(batches):
        now, lead = None, {}
        for batch in batches:
            for part, found in slices(batch, "text", 4 << 20):
                x, y = [], []
                for hub, share, leads, own, s in zip(*[part.column(c).to_pylist() for c in ("hub", "share", "leads", "id")],
                                                     shingle_sets(found, _cache()), strict=True):
                    if (hub, share) != now:
                        now, lead = (hub, share), {}
                    if leads:  # rows that repeat an id may bear several texts
                        lead[digest(s)] = s
                    elif any(linked(s, t) for t in lead.values()):
                        x.append(own)
                        y.append(hub)
                yield pa.RecordBatch.from_arrays([pa.array(c, part.schema.field("id").type) for c in (x, y)], names=["x", "y"])

    out = written(rows.mapInArrow(tidy(run), f"x {kind}, y {kind}").distinct(), "parity-links")
    discard(roles)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (x, y): the smallest node
    reachable. Alternates large and small stars until no edge changes; only
    edges and per-node minima are shuffled, no group is gathered. The joins follow the
    shuffles of their sums; none is broadcast, for the driver would collect and
    keep one side of each join of each round."""
    figures = [F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))]
    e, state = watched(edges.where("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(),
                       "links", *figures)
    while True:
        both = e.select(twofold({"u": F.col("x"), "v": F.col("y")}, {"u": F.col("y"), "v": F.col("x")}))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y")).where("x != y")
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        # the row of the minimum itself gives the node's own edge
        small = (large.join(least.hint("merge"), "x")
                 .select(F.when(F.col("y") == F.col("m"), F.col("x")).otherwise(F.col("y")).alias("x"), F.col("m").alias("y")).distinct())
        old, before = e, state
        e, state = watched(small, "links", *figures)
        discard(old)
        if state == before:
            return e.select(twofold({"node": F.col("x"), "component": F.col("y")}, {"node": F.col("y"), "component": F.col("y")})).distinct()


def residual(members: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, doc: str, text: str) -> DataFrame | None:
    """Links (x, y) within large buckets between members that lie in different
    components so far; None if there are none. Buckets are compared in blocks of about BLOCK x BLOCK
    members: first by sizes and bit sketches; members with a partner that may be
    linked are compared again with their texts. Within a block a link between
    components that an earlier one has joined is left out, so a task gives
    fewer links than it has members."""
    kind = classes.schema["doc"].dataType.simpleString()
    own = classes.select(F.col("set").alias("a"), F.col("doc").alias("x"))
    rows = (members.join(own, "a").join(labels.withColumnRenamed("node", "x").hint("merge"), "x", "left")
            .withColumn("component", F.coalesce("component", "x")))
    rows = written(rows.select("bucket", "size", "before", "x", "component"), "parity-members")
    mixed = (rows.groupBy("bucket").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("component", "before")])
             .where("min_component != max_component AND min_before != max_before").select("bucket"))
    blocks = F.floor((F.col("size") + BLOCK - 1) / BLOCK)
    sketches = classes.select(F.col("doc").alias("x"), "n", "sketch").groupBy("x", "n").agg(F.collect_set("sketch").alias("sketches"))
    mixed = written(rows.join(mixed, "bucket").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("x"), "blocks"))
                    .join(sketches, "x"), "parity-mixed")
    discard(rows)
    dealt = (mixed.withColumn("sketch", F.explode("sketches"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "before", "x", "component", "n", "sketch"))

    def pairs_of(table: pa.Table, n: np.ndarray, sketches: list[bytes]):
        """Row pairs of the block that may be linked; the caller may merge the labels."""
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block, before = table.column("block").to_numpy(), table.column("before").to_numpy()
        size = min(map(len, sketches))
        bits = np.array([folded(np.frombuffer(b, np.uint8), size) for b in sketches]).view(np.uint64)
        _, label = np.unique(np.array(table.column("component").to_pylist()), return_inverse=True)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for a in left:
            b = right[(right > a) | (i != j)]
            b = b[(label[b] != label[a]) & (before[b] != before[a])
                  & (100 * np.minimum(n[b], n[a]) >= PERCENT * np.maximum(n[b], n[a]))]
            apart = np.bitwise_count(bits[b] ^ bits[a]).sum(axis=1, dtype=np.int64)
            b = b[apart <= np.minimum(n[b], n[a]) // 4]
            if len(b):
                yield a, b, label

    def may(table: pa.Table) -> pa.Table:
        near = np.zeros(table.num_rows, bool)
        for a, b, _ in pairs_of(table, table.column("n").to_numpy(), table.column("sketch").to_pylist()):
            near[a] = near[b] = True
        return table.select(["bucket", "i", "j", "block", "before", "x", "component"]).filter(pa.array(near))

    key = f"bucket bigint, i bigint, j bigint, block bigint, before bigint, x {kind}, component {kind}"
    near = written(dealt.groupBy("bucket", "i", "j").applyInArrow(tidy_group(may), key).distinct(), "parity-near")
    discard(mixed)
    found = among(docs.select(F.col(doc).alias("x"), F.col(text).alias("text")), "x", near.select("x"))
    found = found.join(near.select("x").distinct(), "x", "left_semi").groupBy("x").agg(F.collect_set("text").alias("texts"))
    dealt = near.join(found.select("x", F.explode("texts").alias("text")), "x")

    def run(table: pa.Table) -> pa.Table:
        sets = shingle_sets([t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()], _cache())
        n = np.array([len(s) for s in sets])
        out = []
        for a, b, label in pairs_of(table, n, [bit_sketch(s) if len(s) else bytes(8) for s in sets]):
            for c in b:
                if label[c] != label[a] and linked(sets[a], sets[c]):
                    label[label == label[c]] = label[a]
                    out.append((a, c))
        x, pairs = table.column("x"), np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"x": x.take(pa.array(pairs[:, 0])), "y": x.take(pa.array(pairs[:, 1]))})

    out, (n,) = watched(dealt.groupBy("bucket", "i", "j").applyInArrow(tidy_group(run), f"x {kind}, y {kind}").where("x != y").distinct(),
                        "parity-rest", F.count(F.lit(1)))
    discard(near)
    return out if n else None


def jaccard_components(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_shingles, component_id) of every row of ``docs``.

    Null and empty texts have no shingle and stand alone. A row whose id is
    null is not linked and has a null component. Rows that repeat an id stay
    repeated; with one text they are equal, with several each has the component
    of its text. Other columns of ``docs`` are left out.
    """
    docs = docs.select(doc, text)
    sets, (total,) = watched(sets_of(docs, doc, text), "parity-sets", F.sum("n"))
    parts = int(total or 0) // PART + 1
    classes = written(sets.where("n > 0 AND doc IS NOT NULL").groupBy("set", "check")
                      .agg(F.min(F.struct("doc", "n", "sketch")).alias("first")).select("set", "check", "first.*"), "parity-classes")
    known = docs.where(F.col(doc).isNotNull())
    rows = written(buckets(rarest(shared_contents(segment_rows(known, text, parts), parts))), "parity-pairs")
    links = verified(similar(rows.select("a", "b"), classes), known, doc, text)
    first = components(links)
    large = rows.where("bucket IS NOT NULL").select("bucket", "a", "size", "before")
    rest = residual(large, classes, first, known, doc, text)
    discard(rows, links)
    if rest is not None:
        first = components(first.select(F.col("node").alias("x"), F.col("component").alias("y")).union(rest))
    by_class = (classes.select("set", "check", "doc").join(first.withColumnRenamed("node", "doc"), "doc", "left")
                .select("set", "check", F.coalesce("component", "doc").alias("component")))
    ids = sets.where("doc IS NOT NULL").join(by_class, ["set", "check"], "left")
    out = ids.select("doc", "n", F.coalesce("component", "doc").alias("component"))
    return out.unionByName(sets.where("doc IS NULL").select("doc", "n", F.col("doc").alias("component"))).select(
        F.col("doc").alias(doc), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
