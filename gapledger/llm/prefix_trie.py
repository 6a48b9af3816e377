"""Conversation prefix trie with a balanced rollup by centroid decomposition.

Every conversation is rebuilt from the first turns of its base conversation and
its own later turns. A node is a distinct sequence of first ``d`` turns; its
key is the XOR of one 128-bit hash per (position, turn), so a prefix's key is a
running aggregate. Positions and keys are computed in buckets of ``SPAN`` turns
with carries between them, so that no window holds a whole long conversation.
A node is named by its smallest member and its depth: the smallest member's own
path (``paths``) then leads from a node to every ancestor with one equi join.

Sums over subtrees (``rollup``) follow the centroid decomposition of the
parent-edge forest. In each round every component that is too large for one
task finds its centroid, the deepest node that at least half of its nodes lie
below, by bisection on depth (nodes are counted per ancestor at the middle
depth); the total of the centroid's subtree is added to each node on the path
from the centroid to the component's top; the component falls apart into the
subtrees of the centroid's children and the rest above. Components of at most
``LIMIT`` nodes are decomposed in the same way inside a task, many to a task.
A node's sum is the total of the component piece it was the centroid of plus
all that was added to it.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, discard, written

#: Turns in one bucket of a conversation.
SPAN = 1024
#: Nodes of a component that one task decomposes.
LIMIT = 10_000
#: Each conversation takes its first turns from conversation c - c % GROUP.
GROUP = 20
MOST_SHARED = 3

_FIRST = -(1 << 60)  # the bucket of null turns, before all others


def shared_turns(conv: Column) -> Column:
    """Number of first turns that conversation ``conv`` takes from its base."""
    return F.crc32(conv.cast("string").cast("binary")) % (MOST_SHARED + 1)


def carried(rows: DataFrame, keys: list[str], value: dict[str, Column], then) -> DataFrame:
    """(*keys, values): for every bucket but the first of a group, the aggregate
    ``then`` over the buckets before it. ``keys`` ends with the bucket."""
    group, bucket = keys[:-1], keys[-1]
    totals = rows.groupBy(*keys).agg(*[c.alias(k) for k, c in value.items()])
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, *[then(k).over(before).alias(f"before_{k}") for k in value]).where(f"before_{next(iter(value))} IS NOT NULL")


def ranked(turns: DataFrame) -> DataFrame:
    """(conv, r, digest, words): turns by their place r in the conversation, from
    1; null turns first, ties by role and the digest of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(_FIRST)).cast("bigint").alias("bucket"))
    before = carried(rows, ["conv", "bucket"], {"n": F.count(F.lit(1))}, F.sum)
    place = F.row_number().over(Window.partitionBy("conv", "bucket").orderBy(F.asc_nulls_first("turn"), "role", "digest"))
    return (rows.withColumn("place", place).join(before, ["conv", "bucket"], "left")
            .select("conv", (F.col("place") + F.coalesce("before_n", F.lit(0))).cast("bigint").alias("r"), "digest", "words"))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c), and their rebuilt turns (c, d, digest, words)."""
    base = (F.col("c") - F.col("c") % GROUP).alias("base")
    convs = rows.groupBy(F.col("conv").alias("c")).agg(F.count(F.lit(1)).alias("n")).select(
        "c", base, shared_turns(F.col("c")).alias("h"), "n")
    sizes = convs.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(sizes, "base", "left").select("c", "base", "h", F.least(F.coalesce("base_n", F.lit(0)), "h").alias("taken"))
    heads = rows.where(F.col("r") <= MOST_SHARED).select(F.col("conv").alias("base"), F.col("r").alias("d"), "digest", "words")
    first = convs.where("h > 0").join(heads, "base").where("d <= h").select("c", "d", "digest", "words")
    own = (rows.join(convs.select(F.col("c").alias("conv"), "h", "taken"), "conv").where("r > h")
           .select(F.col("conv").alias("c"), (F.col("r") - F.col("h") + F.col("taken")).alias("d"), "digest", "words"))
    return convs.select("c"), first.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(c, d, k1, k2, p1, p2, words): the key of every prefix of every
    conversation and of the prefix before it; d = 0 is the root."""
    convs, rows = rebuilt(written(ranked(turns), "trie-turns"))
    rows = rows.withColumn("bucket", F.floor((F.col("d") - 1) / SPAN)).withColumn(
        "f1", F.xxhash64("d", "digest")).withColumn("f2", F.xxhash64("digest", F.lit(7), "d"))
    before = carried(rows, ["c", "bucket"], {"f1": F.bit_xor("f1"), "f2": F.bit_xor("f2")}, F.bit_xor)
    upto = Window.partitionBy("c", "bucket").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("k1", F.bit_xor("f1").over(upto)).withColumn("k2", F.bit_xor("f2").over(upto))
            .join(before, ["c", "bucket"], "left"))
    for i in "12":
        rows = rows.withColumn(f"k{i}", F.col(f"k{i}").bitwiseXOR(F.coalesce(f"before_f{i}", F.lit(0))))
    rows = rows.select("c", "d", "k1", "k2", *[F.col(f"k{i}").bitwiseXOR(F.col(f"f{i}")).alias(f"p{i}") for i in "12"], "words")
    root = convs.select("c", *[F.lit(0).cast("bigint").alias(x) for x in ("d", "k1", "k2", "p1", "p2", "words")])
    return rows.unionByName(root)


def trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (conv, depth, parent, n_convs, words), and paths (c, d, node,
    parent): the node, by its smallest member, at each depth of each
    conversation, and the smallest member of the node above it."""
    rows = written(prefixes(turns), "trie-prefixes")
    nodes = rows.groupBy("d", "k1", "k2").agg(
        F.min("c").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    nodes = written(nodes, "trie-nodes")
    above = nodes.select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"))
    nodes = nodes.where("d > 0").join(above, ["d", "p1", "p2"]).unionByName(
        nodes.where("d = 0").withColumn("parent", F.lit(None).cast("bigint")))
    nodes = written(nodes, "trie-linked")
    paths = rows.select("c", "d", "k1", "k2").join(nodes.select("d", "k1", "k2", "node", "parent"), ["d", "k1", "k2"])
    paths = written(paths.select("c", "d", "node", "parent"), "trie-paths")
    discard(rows)
    return nodes.select(F.col("node").alias("conv"), F.col("d").alias("depth"), "parent", "n_convs", "words"), paths


# -- sums over subtrees --------------------------------------------------------

def decomposed(parent: list[int], depth: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of one component by centroid decomposition. ``parent`` is an
    index, -1 at the top; any order of nodes."""
    out = [[0] * len(parent) for _ in values]
    work = [sorted(range(len(parent)), key=depth.__getitem__)]  # parents before children
    size = [0] * len(parent)
    branch = [0] * len(parent)  # 0: above the centroid; else 1 + the child of the centroid that leads here, or -1 at the centroid
    while work:
        nodes = work.pop()
        top = nodes[0]
        if len(nodes) == 1:
            for o, v in zip(out, values, strict=True):
                o[top] += v[top]
            continue
        for v in nodes:
            size[v] = 1
        centroid = top
        for v in reversed(nodes):
            if v != top:
                size[parent[v]] += size[v]
        for v in nodes[1:]:  # by depth: the last one is the deepest
            if 2 * size[v] >= len(nodes):
                centroid = v
        above, below = [], {}
        for v in nodes:
            if v == centroid:
                branch[v] = -1
                continue
            p = branch[parent[v]] if v != top else 0
            branch[v] = v + 1 if p == -1 else p
            if branch[v]:
                below.setdefault(branch[v], []).append(v)
            else:
                above.append(v)
        for o, v in zip(out, values, strict=True):
            total = v[centroid] + sum(v[x] for part in below.values() for x in part)
            at = centroid
            while True:
                o[at] += total
                if at == top:
                    break
                at = parent[at]
        work += below.values()
        if above:
            work.append(above)
    return out


def in_tasks(nodes: DataFrame, names: list[str], parts: int) -> DataFrame:
    """(conv, depth, *names): subtree sums within each component, dealt by component."""
    def run(table: pa.Table) -> pa.Table:
        cols = {n: table.column(n).to_pylist() for n in table.schema.names}
        members: dict = {}
        for i, top in enumerate(zip(cols["top"], cols["top_depth"], strict=True)):
            members.setdefault(top, []).append(i)
        out = {n: [0] * table.num_rows for n in names}
        for (top, top_depth), own in members.items():
            depth = [cols["depth"][i] for i in own]
            at = {(cols["conv"][i], d): k for k, (i, d) in enumerate(zip(own, depth, strict=True))}
            parent = [-1 if (cols["conv"][i], d) == (top, top_depth) else at[cols["parent"][i], d - 1]
                      for i, d in zip(own, depth, strict=True)]
            sums = decomposed(parent, depth, [[cols[n][i] for i in own] for n in names])
            for n, s in zip(names, sums, strict=True):
                for i, x in zip(own, s, strict=True):
                    out[n][i] = x
        return pa.table({"conv": table.column("conv"), "depth": table.column("depth"),
                         **{n: pa.array(out[n], pa.int64()) for n in names}})

    part = F.pmod(F.xxhash64("top", "top_depth"), F.lit(parts))
    return nodes.withColumn("part", part).groupBy("part").applyInArrow(
        run, "conv bigint, depth bigint, " + ", ".join(f"{n} bigint" for n in names))


def centroids(work: DataFrame, big: DataFrame, paths: DataFrame) -> DataFrame:
    """(top, top_depth, z, z_depth) of the components in ``big`` (top, top_depth,
    size, low): the deepest node that half of the nodes lie below."""
    top = ["top", "top_depth"]
    state = written(big.select(*top, "size", F.col("top").alias("z"), F.col("top_depth").alias("z_depth"), "low"), "trie-centroids")
    while not (open_ := state.where("z_depth < low").withColumn("mid", F.expr("(z_depth + low + 1) div 2"))).isEmpty():
        counted = (work.select(*top, "conv", "depth").join(open_.select(*top, "mid"), top).where("depth >= mid")
                   .join(paths.select(F.col("c").alias("conv"), F.col("d").alias("mid"), "node"), ["conv", "mid"])
                   .groupBy(*top, "node").agg(F.count(F.lit(1)).alias("n")))
        best = counted.groupBy(*top).agg(F.max(F.struct("n", "node")).alias("best"))
        heavy = F.coalesce(2 * F.col("best.n") >= F.col("size"), F.lit(False))
        tried = open_.join(best, top, "left").select(
            *top, "size", F.when(heavy, F.col("best.node")).otherwise(F.col("z")).alias("z"),
            F.when(heavy, F.col("mid")).otherwise(F.col("z_depth")).alias("z_depth"),
            F.when(heavy, F.col("low")).otherwise(F.col("mid") - 1).alias("low"))
        old, state = state, written(tried.unionByName(state.where("z_depth >= low")), "trie-centroids")
        discard(old)
    return state


def rollup(nodes: DataFrame, paths: DataFrame, names: list[str], limit: int | None = None) -> DataFrame:
    """(conv, depth, *names): the sums of the columns ``names`` over each node's
    subtree, itself included. ``nodes`` has conv, depth, parent (the conv of the
    node above, null at a root); ``paths`` the nodes at each depth of each conv."""
    limit = limit or LIMIT
    top = ["top", "top_depth"]
    root = paths.where("d = 0").select(F.col("c").alias("conv"), F.col("node").alias("top"))
    work = nodes.select("conv", "depth", "parent", *names).join(root, "conv").withColumn("top_depth", F.lit(0).cast("bigint"))
    work = written(work, "trie-work")
    total = work.count()
    small, added = [], []
    while True:
        big = written(work.groupBy(*top).agg(F.count(F.lit(1)).alias("size"), F.max("depth").alias("low"))
                      .where(F.col("size") > limit), "trie-big")
        small.append(work.join(big, top, "left_anti") if small or not big.isEmpty() else work)
        if big.isEmpty():
            break
        rest = work.join(big.select(*top), top)
        found = centroids(rest, big, paths).select(*top, "z", "z_depth")
        below = paths.select(F.col("c").alias("conv"), (F.col("d") - 1).alias("z_depth"), F.col("node").alias("child"), F.col("parent").alias("under"))
        rest = rest.join(found, top).join(below, ["conv", "z_depth"], "left")
        is_z = (F.col("depth") == F.col("z_depth")) & (F.col("conv") == F.col("z"))
        inside = (F.col("depth") > F.col("z_depth")) & F.coalesce(F.col("under") == F.col("z"), F.lit(False))
        rest = written(rest.withColumn("place", F.when(is_z, "z").when(inside, "below").otherwise("above")), "trie-split")
        totals = rest.where("place != 'above'").groupBy(*top, "z", "z_depth").agg(*[F.sum(n).alias(n) for n in names])
        chain = paths.select(F.col("c").alias("z"), F.col("d").alias("depth"), F.col("node").alias("conv"))
        added.append(totals.join(chain, "z").where("depth BETWEEN top_depth AND z_depth").select("conv", "depth", *names))
        lower = F.col("place") == "below"
        work = written(rest.where("place != 'z'").select(
            "conv", "depth", "parent", *names, F.when(lower, F.col("child")).otherwise(F.col("top")).alias("top"),
            F.when(lower, F.col("z_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth")), "trie-work")
    pieces = small[0]
    for s in small[1:]:
        pieces = pieces.unionByName(s)
    out = in_tasks(pieces, names, total // limit + 1)
    for a in added:
        out = out.unionByName(a)
    return out.groupBy("conv", "depth").agg(*[F.sum(n).alias(n) for n in names])


# -- the ids that end at a node ------------------------------------------------

def ends_digest(paths: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) of the nodes at which conversations end. Ids
    are joined in buckets of SPAN consecutive numbers, and a node's buckets are
    hashed one after the other as they stream through a sorted partition."""
    ends = paths.groupBy("c").agg(F.max(F.struct("d", "node")).alias("last")).select(
        "c", F.col("last.node").alias("conv"), F.col("last.d").alias("depth"), F.floor(F.col("c") / SPAN).alias("bucket"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",")
    chunks = ends.groupBy("conv", "depth", "bucket").agg(joined.alias("ids"))

    def run(batches):
        now, sha = None, None
        for batch in batches:
            done = []
            for conv, depth, ids in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (conv, depth) != now:
                    if now:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (conv, depth), hashlib.sha256()
                    sha.update(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _digests(done)
        yield _digests([(*now, sha.hexdigest())] if now else [])

    return (chunks.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "bucket").select("conv", "depth", "ids")
            .mapInArrow(run, "conv bigint, depth bigint, ends_sha256 string"))


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["conv", "depth", "ends_sha256"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of every node, from rows (conv_id, turn, role,
    text).

    Null roles and texts are empty; null turns come first; rows that tie on turn
    are ordered by role and a digest of the text, so repeated rows are repeated
    turns. Rows without a conv_id belong to no conversation and are left out. A
    base that is absent or short gives fewer first turns. Other columns are left
    out. No rows give no node.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    nodes, paths = trie(turns)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, ["conv", "depth"], "left").select(
        "conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("n_children").isNull().cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "trie-forest")
    sums = rollup(nodes, paths, ["n_leaves", "saved_tokens"])
    return (nodes.drop("n_leaves", "saved_tokens").join(sums, ["conv", "depth"]).join(ends_digest(paths), ["conv", "depth"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
