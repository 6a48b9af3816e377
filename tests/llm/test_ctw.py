import collections
import itertools
import math

import helpers
import numpy as np
import pytest

from gapledger.llm import ctw


def brute_tree(words, depth):
    """Sequential definition: nodes keyed by (context, bits so far)."""
    counts = collections.defaultdict(lambda: [0, 0])
    for w, c in words.items():
        data = b" " * depth + w + (b"" if w == ctw.END else b" ")
        for at in range(depth, len(data)):
            for d in range(depth + 1):
                for j in range(8):
                    counts[(data[at - d:at], f"{data[at]:08b}"[:j])][data[at] >> (7 - j) & 1] += c
    children = collections.defaultdict(set)
    for context, bits in counts:
        if context:
            children[(context[1:], bits)].add((context, bits))

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_pw(node):
        kt = log_kt(*counts[node])
        return kt if len(node[0]) == depth else np.logaddexp(kt, sum(log_pw(k) for k in children[node])) - math.log(2)

    def bit(context, bits, b):
        node = (context[len(context):], bits)
        path = [(context[len(context) - d:], bits) for d in range(depth + 1)]
        path = list(itertools.takewhile(lambda x: x in counts, path))
        if not path:
            return 0.5
        p = None
        for node in reversed(path):
            kt = (counts[node][b] + 0.5) / (sum(counts[node]) + 1)
            own = math.exp(log_kt(*counts[node]) - math.log(2) - log_pw(node))
            p = kt if p is None else own * kt + (1 - own) * p
        return p

    def word(w):
        data = b" " * depth + w + (b"" if w == ctw.END else b" ")
        return sum(math.log10(bit(data[at - depth:at], f"{data[at]:08b}"[:j], data[at] >> (7 - j) & 1))
                   for at in range(depth, len(data)) for j in range(8))
    return word


@pytest.mark.parametrize("depth", [1, 3, 7])
def test_scores_match_the_definition(spark, depth):
    rows = [(0, "the cat the Cat sat", True), (1, "a cat é", True), (2, "the dog  catx\n", False), (3, None, None), (4, "", True)]
    train = collections.Counter(w for _, t, keep in rows if keep for w in [*helpers.words(t), ctw.END])
    word = brute_tree(train, depth)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, training boolean")
    got = {r.doc_id: r for r in ctw.score_texts(df, depth=depth).collect()}
    n, v = sum(train.values()), len(train)
    for i, t, _ in rows:
        tokens = [*helpers.words(t), ctw.END]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(train[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(base, rel=1e-12)
        assert r.score == pytest.approx(sum(word(w) for w in tokens), rel=1e-9)


def test_bytes_of_a_context_sum_to_one():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 102, rng.integers(1, 6)).astype(np.uint8)) for _ in range(300)]
    gram, _ = ctw.word_grams(words, 3)
    gram, n = np.unique(gram, return_counts=True)
    context = gram[5] >> np.uint64(8)
    asked = np.unique(np.concatenate([gram, (context << np.uint64(8)) + np.arange(256, dtype=np.uint64)]))
    near = asked >> np.uint64(24) == context >> np.uint64(16)
    counts = np.zeros(len(asked), np.int64)
    counts[np.searchsorted(asked, gram)] = n
    root = ctw.make_root(np.bincount((asked & np.uint64(255)).astype(int), weights=counts, minlength=256), np.zeros(256))
    p = 10 ** ctw.log10_probability(asked[near], ctw.build(asked[near], counts[near], 3), root)
    assert p[asked[near] >> np.uint64(8) == context].sum() == pytest.approx(1, abs=1e-9)


def test_small_blocks_and_cells_give_the_same_scores(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet").selectExpr("doc_id", "text", "doc_id % 3 > 0 AS training")
    one = {r.doc_id: r for r in ctw.score_texts(docs).collect()}
    two = {r.doc_id: r for r in ctw.score_texts(docs.repartition(5), block_bytes=30_000, cell_words=1000).collect()}
    assert one.keys() == two.keys()
    for k, a in one.items():
        b = two[k]
        assert (a.n_tokens, a.n_known, a.train_tokens) == (b.n_tokens, b.n_known, b.train_tokens)
        assert a.score == pytest.approx(b.score, rel=1e-9) and a.base_score == pytest.approx(b.base_score, rel=1e-12)


def test_odd_inputs(spark, odd, empty):
    from pyspark.sql import functions as F

    got = ctw.score_texts(odd.withColumn("training", F.lit(False)).withColumnRenamed("lang", "score")).collect()
    assert len(got) == odd.count() and all(r.n_known == 0 and r.train_tokens == 0 and abs(r.base_score) < 1e-6 for r in got)
    one = next(r for r in got if r.doc_id == 2)
    assert one.n_tokens == 1 and one.score == pytest.approx(8 * math.log10(0.5))
    assert ctw.score_texts(empty.withColumn("training", F.lit(True))).collect() == []


def test_grams_of_one_nearest_byte_are_dealt_to_several_tasks(spark, docs):
    from pyspark.sql import functions as F

    grams, n = np.unique(ctw.word_grams(list({w for _, t in docs for w in helpers.words(t)}), 7)[0], return_counts=True)
    df = spark.createDataFrame([(int(g), int(c)) for g, c in zip(grams.view(np.int64), n)], "gram bigint, n bigint")
    levels, children = ctw.build(grams, n, 7), np.zeros(256)
    for j, x in enumerate(levels[-1][1]):
        np.add.at(children, 1 << j | (x.nodes & np.uint64((1 << j) - 1)).astype(int), x.log_pw)
    root = ctw.make_root(np.bincount((grams & np.uint64(255)).astype(int), weights=n, minlength=256), children)
    want = dict(zip(grams.view(np.int64).tolist(), ctw.log10_probability(grams, levels, root)))
    key, before = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(key, "false")
    try:
        got = ctw.gram_scores(df, 7, 12).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(key, before)
    assert {r.gram: r.log_p for r in got} == pytest.approx(want, rel=1e-9) and len(got) == len(want)
    assert len({r.task for r in got if r.gram >> 56 == ord("e")}) > 1


def brute_stream(trained, text, depth):
    """Log10 probability of a stream under the tree of the trained streams, by the sequential definition."""
    counts, children = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)
    for s in trained:
        data = b" " * depth + s
        for at in range(depth, len(data)):
            for d in range(depth + 1):
                for j in range(8):
                    counts[(data[at - d:at], f"{data[at]:08b}"[:j])][data[at] >> (7 - j) & 1] += 1
    for context, bits in counts:
        if context:
            children[(context[1:], bits)].add((context, bits))

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_pw(node):
        kt = log_kt(*counts[node])
        return kt if len(node[0]) == depth else np.logaddexp(kt, sum(log_pw(k) for k in children[node])) - math.log(2)

    total, data = 0.0, b" " * depth + text
    for at in range(depth, len(data)):
        for j in range(8):
            bits, b = f"{data[at]:08b}"[:j], data[at] >> (7 - j) & 1
            path = list(itertools.takewhile(lambda x: x in counts, [(data[at - d:at], bits) for d in range(depth + 1)]))
            p = None if path else 0.5
            for node in reversed(path):
                kt = (counts[node][b] + 0.5) / (sum(counts[node]) + 1)
                own = math.exp(log_kt(*counts[node]) - math.log(2) - log_pw(node))
                p = kt if p is None else own * kt + (1 - own) * p
            total += math.log10(p)
    return total


@pytest.mark.parametrize("depth", [1, 3, 7])
def test_contexts_reach_across_words(spark, depth):
    rows = [(0, "the cat the Cat sat", True), (1, "a cat é", True), (2, "the dog  catx\n", False), (3, None, None),
            (4, "", True), (5, "cat the sat Cat the", False)]
    streams = {i: b" ".join([*helpers.words(t), ctw.END]) for i, t, _ in rows}
    df = spark.createDataFrame(rows, "doc_id bigint, text string, training boolean")
    got = {r.doc_id: r for r in ctw.score_streams(df, depth=depth, block_bytes=20).collect()}
    old = {r.doc_id: r for r in ctw.score_texts(df, depth=depth).collect()}
    for i, s in streams.items():
        want = brute_stream([streams[k] for k, _, t in rows if t], s, depth)
        assert got[i].score == pytest.approx(want, rel=1e-9)
        assert got[i].bits_per_byte == pytest.approx(-want * math.log2(10) / len(s), rel=1e-9)
        assert got[i][:5] == old[i][:5] and got[i].base_score == pytest.approx(old[i].base_score, rel=1e-12)
    assert depth == 1 or got[0].score > got[5].score + 0.1  # the same words, shuffled


def test_streams_of_odd_inputs(spark, odd, empty):
    from pyspark.sql import functions as F

    got = ctw.score_streams(odd.withColumn("training", F.lit(False)).withColumnRenamed("lang", "score")).collect()
    assert len(got) == odd.count() and all(r.n_known == 0 and r.bits_per_byte == pytest.approx(8) for r in got)
    assert ctw.score_streams(empty.withColumn("training", F.lit(True))).collect() == []


def test_grams_of_streams_travel_packed(spark, docs, monkeypatch):
    """Rows grow with blocks and parts, not with grams; how texts are dealt changes no score."""
    tables = {}
    made = ctw.written

    def kept(df, name):
        tables[name] = made(df, name)
        return tables[name]

    monkeypatch.setattr(ctw, "written", kept)
    df = spark.createDataFrame([(i, t, i % 3 > 0) for i, t in docs], "doc_id bigint, text string, training boolean")
    one = {r.doc_id: r for r in ctw.score_streams(df).collect()}
    assert tables["ctw-streams"].count() <= len(docs)
    monkeypatch.setattr(ctw, "written", made)
    size = sum(len((t or "").encode()) for _, t in docs)
    two = {r.doc_id: r for r in ctw.score_streams(df.repartition(3), block_bytes=size // 5, part_bytes=size // 3).collect()}
    assert one.keys() == two.keys()
    for k, a in one.items():
        assert a[:5] == two[k][:5] and list(a[5:]) == pytest.approx(list(two[k][5:]), rel=1e-9)


def test_packed_grams_are_read_back():
    for grams in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.array([3, 3 << 8, 2**63 + 5, 2**64 - 1], np.uint64)):
        assert ctw.unpack_grams(ctw.pack_grams(grams), len(grams)).tolist() == grams.tolist()
