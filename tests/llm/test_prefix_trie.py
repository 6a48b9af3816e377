import hashlib
import random
import re
import zlib

import pytest

from gapledger.llm import prefix_trie as pt
from gapledger.llm.queries import op11_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, digest, text))
    convs = {c: [(r[2], r[4]) for r in sorted(v)] for c, v in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(built) + 1):
            members.setdefault(built[:d], []).append(c)
        ends.setdefault(built, []).append(c)
    out = {}
    for node, cs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        inner = {n[:-1] for n in members if n}
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        out[min(cs), len(node)] = (
            min(members[node[:-1]]) if node else None, len(cs), sum(n[:-1] == node and n != () for n in members),
            sum(n not in inner for n in below), saved,
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
    return out


def run(spark, rows):
    got = pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({(r.conv_id, r.depth) for r in got}) == len(got)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in got}


def conversations(seed, n, longest=9):
    """Few texts, so that prefixes are shared; a first turn that a third have."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(40 * n), n):
        same = rng.random() < 0.3
        for t in range(rng.randrange(1, longest)):
            text = "hello there" if same and t < 3 else " ".join(rng.choice(["a", "b c"]) for _ in range(rng.randrange(3)))
            rows.append((c, t, rng.choice(["user", "assistant"]) if not same else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [3, 10_000])
def test_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(pt, "LIMIT", limit)
    rows = conversations(5, 60)
    assert run(spark, rows) == brute_force(rows)


def test_buckets_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(pt, "SPAN", 4)
    monkeypatch.setattr(pt, "LIMIT", 16)
    rows = conversations(6, 12, 20) + [(40, t, "user", "same") for t in range(30)] + [(41, t, "user", "same") for t in range(25)]
    rows += [(40 + 3 * k, None, "user", f"x{k}") for k in range(3)]
    assert run(spark, rows) == brute_force(rows)


def test_odd_inputs(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 5, "a", "tie"), (2, 5, "a", "eit"), (None, 0, "user", "lost"),
            (20, 1, "user", "one"), (23, 1, "user", "one"), (-7, 0, "user", "minus"), (39, 0, "", " \n"), (4, 0, "user", "w " * 50_000)]
    expected = {k: v for k, v in brute_force([r for r in rows if (r[0] or 0) >= 0]).items()}
    assert run(spark, [r for r in rows if r[0] != -7]) == expected
    assert len(run(spark, rows)) >= len(expected)
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    extra = spark.createDataFrame([(*r, 1, "x") for r in rows if r[0] != -7], SCHEMA + ", depth int, node string")
    assert {(r.conv_id, r.depth) for r in pt.prefix_trie(extra).collect()} == set(expected)


def test_decomposition_of_paths_stars_and_random_trees():
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 200):
        for parent in ([-1, *range(n - 1)], [-1] + [0] * (n - 1), [-1, *(rng.randrange(i) for i in range(1, n))]):
            depth = [0] * n
            for i in range(1, n):
                depth[i] = depth[parent[i]] + 1
            v = [rng.randrange(100) for _ in range(n)]
            want = list(v)
            for i in sorted(range(1, n), key=lambda i: -depth[i]):
                want[parent[i]] += want[i]
            assert pt.decomposed(parent, depth, [v, [1] * n])[0] == want


def test_query(spark, base):
    rows = [tuple(r) for r in spark.read.parquet(f"{base}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in op11_prefix_trie(spark, base).collect()}
    assert got == brute_force(rows)
