"""Benchmark decontamination by template canonicalisation.

Numbers, units after a number, and names become typed placeholders; what is
left are lower-case words. Windows of this template are hashed and joined
between documents and benchmark items, so a question asked again with other
numbers or names still meets its item. The values behind the placeholders then
have to be consistent: each value of the item must stand for one value of the
document. That is judged per alignment (the distance of the document's window
from the item's), so that an item that repeats a template, or a document that
holds an item twice, is not compared crosswise; also over alignments a few
tokens apart, for copies with words put in or left out, and over all windows.
One passing alignment is enough. So is a run of consecutive windows of a fixed
length, whatever part of a long item it is. Items without a usable window
(short ones, or mostly placeholders) are matched as a whole, by words and
values.

Only DataFrame functions. Before the join, a document's windows pass a Bloom
filter of the benchmark's window hashes, of a fixed size (``BITS`` bits, in a
scalar subquery), so few leave their row whatever the size of the corpus; a
benchmark that fills the filter makes the join larger, not wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Sentence marks, words, numbers.
TOKEN = r"[.!?\n]|\p{L}+|[0-9]+(?:[.,][0-9]+)*"
MARKS = ".", "!", "?", "\n"
UNITS = ("kg", "g", "mg", "lb", "oz", "km", "m", "cm", "mm", "mi", "ft", "l", "ml", "h", "hr", "min", "s", "sec", "ms",
         "usd", "eur", "dollars", "euros", "cents", "percent", "degrees", "years", "months", "weeks", "days", "hours",
         "minutes", "seconds", "miles", "metres", "meters", "kilometres", "kilometers", "grams", "kilograms", "pounds",
         "litres", "liters")
NUMBER, UNIT, NAME = "<num>", "<unit>", "<name>"
WINDOW = 8
#: Of a window at most so many tokens may be placeholders.
MOST_SLOTS = WINDOW // 2
#: Alignments less than this apart are also judged together, if they share one of two shifted ranges.
DRIFT = WINDOW
#: A run of so many consecutive windows (13 template tokens) is a leak by itself.
RUN = 6
RUNS = 4
#: Scripts without spaces; an exact match takes each of their letters as a token, of half a word's weight.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
EXACT_TOKEN = rf"[.!?\n。！？]|[{UNSPACED}]|[\p{{L}}&&[^{UNSPACED}]]+|[0-9]+(?:[.,][0-9]+)*"
EXACT_MARKS = *MARKS, "。", "！", "？"
#: An item matched as a whole has the least weight; below the other one, or without words, it must stand between sentence marks.
EXACT_LEAST, EXACT_FREE = 3, 5
#: 64-bit words of the filter.
FILTER_WORDS = 4096
BITS = 64 * FILTER_WORDS


def templates(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: array<struct<c, v>> of the text's tokens; ``c`` is the word
    or placeholder and ``v`` the value behind a placeholder. Null: empty."""
    df = df.withColumn("_t", F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn("_z", F.filter(F.arrays_zip(
        F.col("_t").alias("t"), F.concat(F.array(F.lit(".")), F.slice("_t", 1, F.greatest(F.size("_t") - 1, F.lit(0)))).alias("p"),
        F.transform("_t", F.lower).alias("l")), lambda z: (z["t"] >= "A") | _numeric(z["t"])))  # letters sort after all marks

    def one(z: Column) -> Column:
        def slot(kind: str, value: Column) -> Column:
            return F.struct(F.lit(kind).alias("c"), value.alias("v"))

        t, before, low = z["t"], z["p"], z["l"]
        titled = (t != low) & (F.length(t) > 1) & (F.concat(F.substring(t, 1, 1), F.substring(low, 2, 1 << 30)) == t)
        return (F.when(_numeric(t), slot(NUMBER, t))
                .when(_numeric(before) & low.isin(*UNITS), slot(UNIT, low))
                .when(titled & ~before.isin(*MARKS), slot(NAME, low))
                .otherwise(F.struct(low.alias("c"), F.lit(None).cast("string").alias("v"))))

    return df.withColumn(out, F.transform("_z", one)).drop("_t", "_z")


def _numeric(token: Column) -> Column:
    return (token < ":") & (token >= "0")


def windows(df: DataFrame, tokens: str, at: str, out: str) -> DataFrame:
    """One row per window of WINDOW template tokens: its place ``at`` and its
    hash ``out``. Words are hashed once each, not once per window; windows are
    rows before they are hashed, so Spark compiles what is done for each."""
    df = df.withColumn("_words", F.transform(tokens, lambda t: F.xxhash64(t["c"])))
    last = F.size("_words") - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    df = df.select("*", F.explode(places).alias(at))
    return df.withColumn(out, F.xxhash64(F.slice("_words", F.col(at) + 1, WINDOW))).drop("_words")


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item, item_windows, at, nth, hash, slots) of the windows of all items that
    have enough words beside their placeholders; ``nth`` numbers an item's
    windows without gaps."""
    b = templates(benchmark.select(F.col(item).alias("item"), F.col(text).alias("_text")), "_text", "_tokens").drop("_text")
    b = windows(b, "_tokens", "at", "hash")
    b = b.select("item", "at", "hash", F.slice(F.col("_tokens")["v"], F.col("at") + 1, WINDOW).alias("slots"))
    b = b.where(F.size(F.filter("slots", lambda v: v.isNotNull())) <= MOST_SLOTS).dropDuplicates(["item", "at", "hash", "slots"])
    n = b.groupBy("item").agg(F.countDistinct("at").alias("item_windows"))
    return b.join(n, "item").withColumn("nth", F.dense_rank().over(Window.partitionBy("item").orderBy("at")))


def whole_items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item, words, free, n_slots, anchor, hash) of the items without a usable
    window: their exact tokens, whether they are found within a sentence too,
    and the length and hash of their first tokens."""
    b = templates(benchmark.select(F.col(item).alias("item"), F.col(text).alias("_text")), "_text", "_tokens")
    values = F.col("_tokens")["v"]
    n = F.size(values) - (WINDOW - 1)
    usable = F.when(n > 0, F.exists(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.size(
        F.filter(F.slice(values, i + 1, WINDOW), lambda v: v.isNotNull())) <= MOST_SLOTS)).otherwise(False)
    slots = F.size(F.array_distinct(F.filter(values, lambda v: v.isNotNull()))).cast("bigint")
    b = exact_tokens(b.where(~usable).withColumn("n_slots", slots), "_text", "_exact").withColumn("words", F.col("_exact")["t"])
    weight = F.size("words") - F.size(F.filter("words", lambda w: w.rlike(f"^[{UNSPACED}]"))) / 2
    free = (weight >= EXACT_FREE) & F.exists("words", lambda w: ~w.rlike("^[0-9]"))
    return (b.where(weight >= EXACT_LEAST).select("item", "words", free.alias("free"), "n_slots").distinct()
            .withColumn("anchor", F.least(F.size("words"), F.lit(WINDOW)))
            .withColumn("hash", F.xxhash64(F.slice("words", 1, F.col("anchor")))))


def exact_tokens(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: array<struct<t, s, e>> of the text's lower-case words,
    letters of scripts without spaces, and numbers, and whether a sentence
    starts and ends with each. Null: empty."""
    df = df.withColumn("_t", F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(EXACT_TOKEN), F.lit(0)))
    stop = F.array(F.lit("."))
    df = df.withColumn("_z", F.filter(F.arrays_zip(
        F.col("_t").alias("t"), F.concat(stop, F.col("_t")).alias("p"),
        F.concat(F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0))), stop).alias("q")),
        lambda z: z["t"].isNotNull() & ~z["t"].isin(*EXACT_MARKS)))
    return df.withColumn(out, F.transform("_z", lambda z: F.struct(
        F.lower(z["t"]).alias("t"), z["p"].isin(*EXACT_MARKS).alias("s"), z["q"].isin(*EXACT_MARKS).alias("e")))).drop("_t", "_z")


def _bit(hash_: Column, k: int) -> tuple[Column, Column]:
    """(word, bit) of the filter for a window's hash."""
    h = F.shiftrightunsigned(hash_, 24 * k)
    return F.pmod(h, F.lit(FILTER_WORDS)).cast("int"), F.pmod(F.shiftrightunsigned(h, 13), F.lit(64)).cast("int")


def bloom(hashes: DataFrame) -> DataFrame:
    """One row, one array of FILTER_WORDS words with two bits set per hash."""
    places = F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in (_bit(F.col("hash"), k) for k in (0, 1))]))
    words = (hashes.select(places.alias("x")).groupBy(F.col("x.w").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, x.b)")).alias("bits")))
    every = hashes.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("bits"))
    full = words.unionByName(every).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    return full.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("filter"))


def matches(docs: DataFrame, doc: str, text: str, items: DataFrame) -> DataFrame:
    """(doc, copy, shift, item, item_windows, at, nth, slots, item_slots): windows of
    documents whose template is an item's. ``copy`` tells texts of one id apart,
    ``shift`` is the window's place less its place ``at`` in the item."""
    d = docs.select(F.col(doc).alias("doc"), F.col(text).alias("_text"))
    d = templates(d.withColumn("copy", F.xxhash64("_text")), "_text", "_tokens").drop("_text")
    d = windows(d, "_tokens", "i", "hash")
    d = d.withColumn("_filter", bloom(items.select("hash")).scalar()).where(_passes(F.col("hash")))
    d = d.select("doc", "copy", "hash", "i", F.slice(F.col("_tokens")["v"], F.col("i") + 1, WINDOW).alias("slots"))
    return d.join(items.withColumnRenamed("slots", "item_slots"), "hash").withColumn("shift", F.col("i") - F.col("at")).drop("hash", "i")


def whole_matches(docs: DataFrame, doc: str, text: str, items: DataFrame) -> DataFrame | None:
    """(doc, item, n_slots): documents that hold an item's exact tokens; None if
    there are no such items. Found by the item's first tokens, then compared."""
    anchors = {r.anchor: r.longest for r in items.groupBy("anchor").agg(F.max(F.size("words")).alias("longest")).collect()}
    if not anchors:
        return None
    d = exact_tokens(docs.select(F.col(doc).alias("doc"), F.col(text).alias("_text")), "_text", "_tokens").drop("_text")
    d = d.withColumn("_words", F.col("_tokens")["t"]).withColumn("_filter", bloom(items.select("hash")).scalar())
    d = d.withColumn("_found", F.filter(F.flatten(F.transform("_words", lambda _, i: F.array(*[F.struct(
        F.xxhash64(F.slice("_words", i + 1, k)).alias("hash"), i.alias("i")) for k in sorted(anchors)]))), lambda x: _passes(x["hash"])))
    d = d.select("doc", F.explode(F.transform("_found", lambda x: F.struct(
        x["hash"].alias("hash"), F.slice("_tokens", x["i"] + 1, max(anchors.values())).alias("said")))).alias("w"))
    said, n = F.col("said"), F.size("words")
    whole = (F.size(said) >= n) & (F.slice(said["t"], 1, n) == F.col("words"))
    return (d.select("doc", "w.hash", "w.said").join(items, "hash")
            .where(whole & (F.col("free") | (F.get(said["s"], F.lit(0)) & F.get(said["e"], n - 1))))
            .select("doc", "item", "n_slots").distinct())


def _passes(hash_: Column) -> Column:
    out = None
    for k in (0, 1):
        word, bit = _bit(hash_, k)
        test = F.getbit(F.element_at(F.col("_filter"), word + 1), bit) == 1
        out = test if out is None else out & test
    return out


def aligned(found: DataFrame) -> DataFrame:
    """``found`` once for each group that a match is judged in, with ``group``:
    its alignment, two ranges of alignments, all matches, and its run, the
    consecutive matches of an alignment."""
    def group(copy: Column, kind: int, at: Column, run: Column) -> Column:
        return F.struct(copy.alias("copy"), F.lit(kind).alias("kind"), at.cast("bigint").alias("at"), run.alias("run"))

    copy, shift, none = F.col("copy"), F.col("shift"), F.lit(0).cast("bigint")
    near = [F.floor((shift + k) / DRIFT) for k in (0, DRIFT // 2)]
    line = Window.partitionBy("doc", "copy", "item", "shift").orderBy("at")
    # rows of one place (items or documents that share an id) are equal in the order and share a run
    place = F.dense_rank().over(line)
    return found.withColumn("run", (F.col("nth") - place).cast("bigint")).withColumn("group", F.explode(F.array(
        group(none, 0, none, none), group(copy, 1, shift, none), group(copy, 2, near[0], none), group(copy, 3, near[1], none),
        group(copy, RUNS, shift, F.col("run")))))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", min_coverage: float = 0.4, min_consistent: float = 0.8) -> DataFrame:
    """(doc, item, matched_windows, item_windows, n_slots, n_consistent) of the
    documents that hold at least ``min_coverage`` of an item's windows, or RUN
    consecutive ones, with at least ``min_consistent`` of the item's slot values
    standing for one value. Of several alignments that pass, the one with the
    most windows is given.

    Items with fewer than WINDOW tokens, or with placeholders in most of each
    window, count as one window of exact words and values. Those of fewer than
    EXACT_FREE words, or of numbers alone, cannot be told from chance within a
    sentence and match only between sentence marks; below EXACT_LEAST nothing
    matches. Null and empty texts match nothing; repeated rows count once; other
    columns are left out.
    """
    items = item_windows(benchmark, item, item_text)
    found = aligned(written(matches(docs, doc, text, items), "decontam-matches"))
    key = ["doc", "item", "group"]
    covered = (found.groupBy(*key, "at").agg(F.max("item_windows").alias("item_windows"))
               .groupBy(*key).agg(F.count(F.lit(1)).alias("matched_windows"), F.max("item_windows").alias("item_windows"))
               .where(F.when(F.col("group.kind") == RUNS, F.col("matched_windows") >= RUN)
                   .otherwise(F.col("matched_windows") >= min_coverage * F.col("item_windows"))))
    slots = (found.select(*key, F.explode(F.arrays_zip(F.col("slots").alias("d"), F.col("item_slots").alias("b"))).alias("s"))
             .where("s.b IS NOT NULL").groupBy(*key, F.col("s.b").alias("b"))
             .agg((F.min("s.d") == F.max("s.d")).cast("bigint").alias("consistent"))
             .groupBy(*key).agg(F.count(F.lit(1)).alias("n_slots"), F.sum("consistent").alias("n_consistent")))
    same_key = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in ("doc", "item", "group")]
    joined = covered.alias("c").join(slots.alias("s"), same_key[0] & same_key[1] & same_key[2], "left")
    n, same = F.coalesce("s.n_slots", F.lit(0)), F.coalesce("s.n_consistent", F.lit(0))
    passed = joined.where(same >= min_consistent * n).select(
        F.col("c.doc").alias("doc"), F.col("c.item").alias("item"),
        F.struct("matched_windows", n.alias("n_slots"), same.alias("n_consistent"), "item_windows").alias("x"))
    whole = whole_matches(docs, doc, text, written(whole_items(benchmark, item, item_text), "decontam-whole"))
    if whole is not None:
        one = F.lit(1).cast("bigint")
        passed = passed.union(whole.select("doc", "item", F.struct(one, "n_slots", "n_slots", one)))
    best = passed.groupBy("doc", "item").agg(F.max("x").alias("x"))
    return best.select(F.col("doc").alias(doc), F.col("item").alias(item), "x.matched_windows", "x.item_windows",
                       "x.n_slots", "x.n_consistent")
