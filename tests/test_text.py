"""F6 clean-up and the log slicing helpers."""

import random

import pytest
from pyspark.sql import functions as F

from gapledger.functions.text import clean_text, cleanup_map, find_pos, most_rounds, slice_between, value_after


def _fixed_point(text, strip_chars=(), extras=None):
    """Brute-force oracle: apply every replacement until nothing changes,
    trimming whitespace and strip characters at both ends each round."""
    mapping = cleanup_map(extras)
    ws = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    chars = "".join(strip_chars) + ws
    prev = None
    while prev != text:
        prev = text
        text = text.strip(chars)
        for k, v in mapping.items():
            text = text.replace(k, v)
    return text.strip(chars)


def _one(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(clean_text("t", **kw).alias("c")).first()["c"]


def test_docstring_examples(spark):
    src = '       ,  ,      , .,.,.,.,,,......test, \t  this\n.is.a\n.test...,,,         , .'
    assert _one(spark, src, strip_chars=[",", "."]) == "test this .is.a .test"
    assert _one(spark, " this is one test\n!\n", replace_extras={"\n": "", "one": "1"}) == "this is 1 test!"


@pytest.mark.parametrize("text", [
    "", "   ", "a  b", 'say "hi", then\r\n\tbye  ', "\x0b lead and trail \xa0",
    "a , b", '" , "', "x　y", "  multiple     spaces\n\n\nand lines ",
])
def test_matches_fixed_point(spark, text):
    assert _one(spark, text) == _fixed_point(text)


def test_documents_match_fixed_point(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.c for r in docs.select("doc_id", clean_text("text").alias("c")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == _fixed_point(r.text), r.doc_id


@pytest.mark.parametrize("extras", [
    {"aa": "a"}, {"aaa": "a"}, {"aaaa": "aa"}, {"b2": "z", "1": "2"}, {"ab": ""}, {"ab": "b"}, {"one": "1", "\n": ""},
    {"x": "yy", "yyy": "q"}, {"  ": "", "ab": "c"}])
@pytest.mark.parametrize("text", [
    "xaaaax", "aaa", "aaaaaaaa a aaa", "b1", "b11 bb12", "aabbab", "aaabbbab ab", "this is one test\n!\n", "xx x xxx", "a,b a\"b", ", a ,", ""])
def test_extra_pairs_reach_the_fixed_point(spark, extras, text):
    def loops(t):  # every pair until it is gone, all pairs until nothing changes
        mapping, old = cleanup_map(extras), None
        while old != t:
            old = t = t.strip()
            for k, v in mapping.items():
                while k in t:
                    t = t.replace(k, v)
        return t.strip()

    assert _one(spark, text, replace_extras=extras) == loops(text)


def test_a_map_that_never_settles_is_an_error(spark):
    with pytest.raises(Exception, match="not settled"):
        _one(spark, "a", replace_extras={"a": "b", "b": "aa"})


def test_self_containing_replacement_is_refused():
    with pytest.raises(ValueError):
        cleanup_map({"a": "aa"})


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(clean_text("t").alias("c")).first()["c"] is None


def test_find_and_slice(spark):
    df = spark.createDataFrame([("ab exception boom records: 1 id: 2",), ("no marker",), ("exception tail",)], "v string")
    out = df.select(find_pos("v", "exception").alias("p"), slice_between("v", "exception", "id:").alias("s")).collect()
    assert [r.p for r in out] == [3, -1, 0]
    assert [r.s for r in out] == ["exception boom records: 1 ", None, "exception tail"]


def test_value_after_by_pattern(spark):
    df = spark.createDataFrame([('{"event_name"=>"a_very_long_event_name_over_19"}',), ("nothing",)], "v string")
    out = df.select(value_after("v", "event_name").alias("e")).collect()
    assert out[0].e == "a_very_long_event_name_over_19"
    assert out[1].e is None


@pytest.mark.parametrize("extras, text, want", [
    ({"ab": ""}, "a" * 70 + "b" * 70, ""), ({"ab": "", "cd": "a"}, "x" + "ab" * 3 + "c" * 90 + "d" * 90, "x" + "c" * 89 + "a" + "d" * 89),
    ({"bb": "a", "aa": "b"}, "a" * 4099, None), ({"ab": "ba"}, "a" * 90 + "b" * 90, "b" * 90 + "a" * 90)])
def test_long_chains_of_extra_pairs_settle(spark, extras, text, want):
    t, old = text, None
    while old != t:
        old = t
        for k, v in cleanup_map(extras).items():
            while k in t:
                t = t.replace(k, v)
    assert want is None or want == t
    assert _one(spark, text, replace_extras=extras) == t


def test_chains_that_lengthen_the_text_settle(spark):
    """Each pair feeds the next one: no circle, so every text settles, in any map order."""
    letters = "abcdefghijkl"
    chain = {a: 2 * b for a, b in zip(letters, letters[1:])}
    for extras in (chain, dict(reversed(chain.items()))):
        assert _one(spark, "a", replace_extras=extras) == "l" * 2048
        assert _one(spark, "xaxbx", replace_extras=extras) == _loops("xaxbx", extras)


def _loops(t, extras):
    mapping, old = cleanup_map(extras), None
    while old != t:
        old = t = t.strip()
        for k, v in mapping.items():
            while k in t:
                t = t.replace(k, v)
    return t.strip()


def test_rounds_that_a_map_needs():
    assert most_rounds({"a": "bb", "b": "cc"}) == 3 and most_rounds({"a": "b"}) == 2
    assert most_rounds({"a": "b", "b": "aa"}) is None and most_rounds({"xx": "", "ab": "c"}) == 3
    assert most_rounds({"": "x"} | {"ab": "b", "bc": "a"}) is None


def test_random_maps_reach_the_fixed_point(spark):
    """Maps that cannot run for ever, on texts of their letters."""
    rng = random.Random(8)
    for _ in range(8):
        extras = {}
        while len(extras) < 3:
            k = "".join(rng.choice("abc|") for _ in range(rng.randrange(1, 4)))
            v = "".join(rng.choice("abcT") for _ in range(rng.randrange(0, len(k))))
            if k not in v:
                extras[k] = v
        texts = ["".join(rng.choice("aabbc| ,") for _ in range(rng.randrange(40))) for _ in range(12)]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r.c for r in df.select("t", clean_text("t", replace_extras=extras).alias("c")).collect()]
        assert got == [_loops(t, extras) for t in texts], extras
