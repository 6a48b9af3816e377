"""Quality rules: base counts of a text, and cross-document line frequency.

Lines are normalised (A-Z lower-cased, digit runs to ``0``, white space to one
space) and hashed. Per host, the documents that hold a line are counted; a
line above the limit is removed, and a document that loses too much of its
words by that is rejected. Copies of one text count as one document, so that
a duplicated document is not mistaken for boilerplate (duplicates are other
operators' work). Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, lower_ascii

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Windows of five words are hashed and sorted with their places; equal
    neighbours mark repeats, and what the marked windows cover is summed from
    the gaps between their places.
    """
    df = df.withColumn("_words", words(F.col(text)))
    n = F.size("_words")
    parts = [F.when(n >= WINDOW, F.slice("_words", k + 1, n - (WINDOW - 1))).otherwise(F.array().cast("array<string>"))
             for k in range(WINDOW)]
    df = df.withColumn("_windows", F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)]))
    df = df.withColumn("_sorted", F.sort_array(F.transform("_windows", lambda w, i: F.struct(
        F.xxhash64(w).alias("h"), i.alias("at")))))
    m = F.size("_sorted")
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    df = df.withColumns({
        "_before": F.when(m > 0, F.concat(F.array(F.lit(None).cast("struct<h:bigint,at:int>")),
                                          F.slice("_sorted", 1, m - 1))).otherwise(none),
        "_after": F.when(m > 0, F.concat(F.slice("_sorted", 2, m),
                                         F.array(F.lit(None).cast("struct<h:bigint,at:int>")))).otherwise(none)})
    df = df.withColumn("_marked", F.filter(F.arrays_zip(
        F.col("_sorted").alias("x"), F.col("_before").alias("b"), F.col("_after").alias("a")),
        lambda z: z["x"]["h"].eqNullSafe(z["b"]["h"]) | z["x"]["h"].eqNullSafe(z["a"]["h"])))
    df = df.withColumn("_places", F.sort_array(F.transform("_marked", lambda z: z["x"]["at"])))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")))["n"]
    df = df.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0))
    symbols = "[^" + SYMBOLS + "]+"
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, symbols, "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered.cast("long"),
    }).drop("_words", "_windows", "_sorted", "_before", "_after", "_marked", "_places", "_lines")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(lower_ascii(line), r"[0-9]+", "0"), SPACE, " "))


def document_key(doc: str, text: str, fold_copies: bool) -> Column:
    """Hash that tells documents of a host apart: of id and text, or of the text alone."""
    return F.xxhash64(text) if fold_copies else F.xxhash64(doc, text)


def text_lines(docs: DataFrame, host: str, text: str, key: Column) -> DataFrame:
    """(host, key, line, n_words, times): each distinct normalised line of each
    distinct document of a host, with its words and how often it occurs. Host,
    document and line are hashes; rows of one document fold into one."""
    rows = docs.select(F.xxhash64(host).alias("host"), key.alias("key"), F.explode(F.split(text, "\n")).alias("raw"))
    rows = (rows.where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))
            .select("host", "key", normalised(F.col("raw")).alias("raw")))
    return (rows.select("host", "key", F.xxhash64("raw").alias("line"),
                        (F.length("raw") - F.length(F.replace("raw", F.lit(" "), F.lit(""))) + 1).alias("n_words"))
            .groupBy("host", "key", "line")
            .agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("times")))


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(host, line): lines that more than ``max_docs`` distinct documents of
    the host hold. It reads all columns of ``lines``, so that its shuffle is the
    one that the words are joined from, and the texts are split into lines once."""
    return (lines.groupBy("host", "line").agg(F.sum(F.least(F.col("times"), F.col("n_words"), F.lit(1))).alias("docs"))
            .where(F.col("docs") > max_docs).select("host", "line"))


def line_verdicts(docs: DataFrame, host: str, text: str, key: Column, max_docs: int) -> DataFrame:
    """(host, key, removed, total): words on removed lines and on all lines, of
    each document of a host that has a removed line."""
    lines = text_lines(docs, host, text, key)
    frequent = frequent_lines(lines, max_docs).withColumn("frequent", F.lit(True))
    size = F.col("times") * F.col("n_words")
    return (lines.join(frequent, ["host", "line"], "left").groupBy("host", "key")
            .agg(F.sum(F.when(F.col("frequent"), size).otherwise(0)).alias("removed"), F.sum(size).alias("total"))
            .where("removed > 0"))


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text",
                  max_docs: int = 200, max_removed_percent: int = 50, min_words: int = 10,
                  max_repeat_percent: int = 20, doc: str = "doc_id", fold_copies: bool = False) -> DataFrame:
    """``docs`` with base counts, base_failed, removed_words and kept.

    A document is depleted if its removed lines hold more than
    ``max_removed_percent`` of its words. A null text is empty (no words, so
    base_failed); null hosts form one host. Rows that repeat host, id and text are
    one document, get the same verdict and stay repeated; rows that repeat an id
    with another text, or a text with another id (null is one id), are further
    documents. Other columns of ``docs`` stay unless they bear a result's name.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept")
    keep = [c for c in docs.columns if c not in made]
    whole = docs.select(*keep).withColumn(text, F.coalesce(text, F.lit("")))
    key = document_key(doc, text, fold_copies)
    verdicts = line_verdicts(whole, host, text, key, max_docs).withColumnsRenamed({"host": "_host", "key": "_key"})
    counted = base_counts(whole.withColumns({"_host": F.xxhash64(host), "_key": key}), text)
    joined = counted.join(verdicts, ["_host", "_key"], "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    removed = F.coalesce(F.col("removed"), F.lit(0))
    depleted = 100 * removed > max_removed_percent * F.coalesce(F.col("total"), F.lit(0))
    return joined.select(
        *keep, *made[:5], failed.alias("base_failed"),
        F.coalesce(F.floor(removed * F.col("n_words") / F.col("total")), F.lit(0)).cast("long").alias("removed_words"),
        (~failed & ~depleted).alias("kept"))
