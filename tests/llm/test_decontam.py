from gapledger.llm import decontam

DOCS = "doc_id bigint, text string, item_id string"
ITEMS = "item_id bigint, text string, source string"
QUESTION = "A farmer named Anna sells 12 apples for 3 dollars each and then Anna buys 5 kg of corn for the horses"


def found(spark, docs, items=((1, QUESTION, "x"),), **kw):
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(items), ITEMS)
    return {r.doc_id: r for r in decontam.contaminated(d, b, **kw).collect()}


def test_new_numbers_and_names_are_caught_if_consistent(spark):
    other = "A farmer named Maria sells 40 apples for 7 dollars each and then Maria buys 9 kg of corn for the horses"
    mixed = "A farmer named Maria sells 40 apples for 7 dollars each and then Peter buys 9 kg of corn for the horses"
    clean = "A farmer who has apples and horses told us that the price of corn rose by 3 percent in the last two years"
    got = found(spark, [(1, "before it. " + QUESTION + ". After it", "a"), (2, other.replace("sells", "SELLS"), None), (3, mixed, "a"),
                        (4, clean, "a"), (5, None, None), (6, "", None), (None, QUESTION, None), (7, QUESTION + "\n" + QUESTION, "q")], min_consistent=0.9)
    assert set(got) == {1, 2, 7, None} and got[1].n_consistent == got[1].n_slots == 6
    assert got[1].item_windows == got[7].matched_windows


def test_empty_tables_short_items_and_slots(spark):
    assert found(spark, []) == {} and found(spark, [(1, QUESTION, "")], []) == {}
    items = [(1, "too short an item", None), (2, None, None), (3, "1 2 3 4 5 6 7 8 9 10 11", None)]
    assert found(spark, [(1, "too short an item " * 3 + " 1 2 3 4 5 6 7 8 9 10 11", "")], items) == {}


def test_planted_items_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    whole = {(d, r.item_id) for r in items.collect() for d, t in texts.items()
             if " ".join(r.text.split()[1:-1]) in " ".join(t)}
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert whole <= got and len(got) <= len(whole) + 2


TWICE = ("Tom has 3 apples in the red basket today. Ann has 5 apples in the red basket today. "
         "Who of the two has more fruit in a basket?")


def test_an_item_that_repeats_a_template_is_found(spark):
    other = TWICE.replace("3", "8").replace("5", "6")
    got = found(spark, [(1, "Before it. " + TWICE + " After it", None), (2, other, None)], [(1, TWICE, "")])
    assert set(got) == {1, 2} and all(r.matched_windows == r.item_windows for r in got.values())
    assert got[1].n_consistent == got[1].n_slots == 2


def test_an_item_held_twice_with_other_values_is_found(spark):
    other = QUESTION.replace("Anna", "Maria").replace("12", "40").replace("3", "7").replace("5", "9")
    inserted = [q.replace("apples for", "ripe apples for") for q in (QUESTION, other)]
    mixed = other.replace("then Maria", "then Peter")
    got = found(spark, [(1, QUESTION + ". " + other, None), (2, ". ".join(inserted), None), (None, QUESTION, None),
                        (None, other, None), (3, mixed, None)], min_consistent=0.9)
    assert set(got) == {1, 2, None} and got[1].matched_windows == got[1].item_windows


LONG = " ".join(f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha") for b in ("lor", "min", "nat", "pek", "ros", "sut", "tav", "vil", "wex", "zum"))


def test_a_passage_of_a_long_item_is_found(spark):
    w = LONG.split()
    got = found(spark, [(1, "xx yy " + " ".join(w[20:45]) + " zz", None), (2, " ".join(w[20:33]), None), (3, " ".join(w[20:32]), None),
                        (4, " ".join(w[20:28] + ["xx"] + w[28:36]), None), (5, " ".join([*w[40:52], "xx"] + w[10:22]), None)], [(1, LONG, "")])
    assert {k: r.matched_windows for k, r in got.items()} == {1: 18, 2: 6}


def test_items_without_a_window_are_found_whole(spark):
    items = [(1, "What is the capital of Peru?", ""), (2, "Add 12 34 56 78 91 11 13 17 to 19 23 29", ""), (3, "What is 12 + 30?", ""),
             (4, "北京是哪个国家的首都？请回答。", ""), (5, "Yes.", ""), (6, "7 8 9 10", "")]
    docs = [(1, "They asked: what is the CAPITAL of Peru, again", None), (2, "Now add 12 34 56 78 91 11 13 17 to 19 23 29 at once", None),
            (3, "Sums\nWhat is 12 + 30?", None), (4, "他问，北京是哪个国家的首都？请回答。好", None), (5, "Yes. No.", None), (6, "first. 7 8 9 10", None),
            (11, "What is the capital of Chile?", None), (12, "add 12 34 56 78 91 11 13 17 to 19 23 28", None),
            (13, "tell me what is 12 + 30 of them", None), (14, "北京是哪个国家的城市？请回答。", None), (16, "6 7 8 9 10", None), (17, None, None)]
    got = found(spark, docs, items)
    assert {k: r.item_id for k, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 6: 6}
    assert all(r.matched_windows == r.item_windows and r.n_slots == r.n_consistent for r in got.values())


def test_windows_are_rows_with_the_place_and_hash_of_their_words(spark):
    texts = ["a b c d e f g h i", "x a b c d e f g h", "a b c d e f g", "", None, "a b c d e f g 7 9"]
    d = decontam.templates(spark.createDataFrame(list(enumerate(texts)), "id bigint, t string"), "t", "tokens")
    got = {(r.id, r.at): r.hash for r in decontam.windows(d, "tokens", "at", "hash").collect()}
    assert set(got) == {(0, 0), (0, 1), (1, 0), (1, 1), (5, 0), (5, 1)}
    assert got[0, 0] == got[1, 1] and len(set(got.values())) == 5
    plan = d.sparkSession._jvm.PythonSQLUtils.explainString(decontam.windows(d, "tokens", "at", "hash")._jdf.queryExecution(), "simple")
    hashed = [x for x in plan.split("\n") if "xxhash64(slice(" in x]
    assert hashed and all("*(" in x and "lambda" not in x.split("xxhash64(slice(")[1] for x in hashed)  # compiled, not a lambda
