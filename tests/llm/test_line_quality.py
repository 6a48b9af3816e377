import collections
import re

import helpers
import pytest

from gapledger.llm import line_quality as lq


def brute(text):
    text = text or ""
    w = text.encode().split()
    windows = collections.defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i:i + 5])].append(i)
    covered = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts_match_brute_force(spark, odd, docs):
    extra = [(1000 + i, t, None, "s", 0) for i, t in enumerate(
        ["a b c d e a b c d e", "x " * 40, "a b c d\n\na b c d\na b c d\n", "a b c d e f a b c d e g a b c d e", "é é #|# <>"])]
    df = odd.unionByName(spark.createDataFrame(extra, helpers.ODD_SCHEMA)).unionByName(
        spark.createDataFrame([(i, t, None, None, 0) for i, t in docs], helpers.ODD_SCHEMA))
    got = lq.quality_rules(df).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_frequent_lines_deplete_documents(spark):
    def own(i):
        return f"some words of document {'abcdefghij'[i % 10] * (1 + i // 10)} that no other document holds at all"
    rows = [(i, f"SHARED  line 7 of the site with many more words in it to remove now\nonly {own(i)[23:40]}", None, "hot", 0)
            for i in range(30)]
    rows += [(100 + i, own(i), None, "hot", 0) for i in range(30)]  # clean
    rows += [(200 + i, "copies of one text count one by one unless they are folded into one document of the host", None, "hot", 0) for i in range(30)]
    rows += [(400, "rows that repeat an id and its text are one document and stay with all their words", None, "hot", 0)] * 30
    rows += [(300, "shared line 9 of the site with many more words in it to remove now\n", None, "other", 0)]
    df = spark.createDataFrame(rows, helpers.ODD_SCHEMA)
    for fold in (False, True):
        got = {r.doc_id: r for r in lq.quality_rules(df, max_docs=20, fold_copies=fold).collect()}
        assert all(not got[i].kept and got[i].removed_words == 15 for i in range(30))
        assert all(got[i].kept for i in [*range(100, 130), 300, 400])
        assert all(got[i].kept == fold for i in range(200, 230))


def test_lines_of_documents_against_brute_force(spark, base):
    """The given documents three times under other ids, limit of two documents."""
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "source", "text")
    rows = [(r.doc_id * 3 + k, r.source, r.text) for r in docs.collect() for k in range(3 if r.doc_id % 2 else 1)]
    df = spark.createDataFrame(rows, docs.schema)

    def norm(line):
        return " ".join(w.decode() for w in re.sub(rb"[0-9]+", b"0", line.encode().lower()).split())

    lines = {(d, s): [x for x in map(norm, (t or "").split("\n")) if x] for d, s, t in rows}
    holders = collections.Counter((s, x) for (_, s), held in lines.items() for x in set(held))
    for r in lq.quality_rules(df, max_docs=2).collect():
        held = [(len(x.split(" ")), holders[(r.source, x)] > 2) for x in lines[(r.doc_id, r.source)]]
        assert r.kept == (not r.base_failed and 100 * sum(n for n, hot in held if hot) <= 50 * sum(n for n, _ in held)), r.doc_id


def test_empty_table_and_repeated_rows(spark, odd, empty):
    assert lq.quality_rules(empty).collect() == []
    got = [r for r in lq.quality_rules(odd.withColumnRenamed("n_chars", "kept")).collect() if r.doc_id == 5]
    assert len(got) == 2 and got[0] == got[1]


def test_native_plan(spark, base):
    from gapledger.llm.queries import QUERIES

    for name in ("op1_chat_format", "op3_line_quality", "op7_decontamination", "op9_url_rules"):
        plan = QUERIES[name](spark, base)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop") if x in plan], name


@pytest.mark.parametrize("text", [None, ""])
def test_null_text_is_empty(spark, text):
    r = lq.quality_rules(spark.createDataFrame([(1, text, None, None, 0)], helpers.ODD_SCHEMA)).first()
    assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
