import helpers
import numpy as np

from gapledger.llm import language


def test_kneser_ney_sums_to_one_over_the_next_character():
    words = ["abab", "abba", "bab", "ca"]
    model = language.fit_char_model(words, np.array([3, 1, 2, 1]), 3)
    letters = "abc" + language.END
    for before in ("", "a", "ab", "ba", "bab"):
        total = 0.0
        for c in letters:
            text = before + (c if c != language.END else "")
            grams, contexts, _ = language.gram_hashes([text], 3)
            at = len(before)
            total += 2 ** model.log2_probability([g[at:at + 1] for g in grams], [x[at:at + 1] for x in contexts])[0]
        assert 0.75 < total <= 1 + 1e-9  # the rest is kept for characters never seen


def test_held_out_accuracy_and_und(spark, base, odd, empty):
    docs = spark.read.parquet(f"{base}/documents.parquet")
    from gapledger.llm.queries import op2_language

    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = op2_language(spark, base).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (helpers.crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert np.mean(held) > 0.9
    model = language.fit(docs)
    got = {(r.doc_id, r.n_chars): r for r in language.identify(odd.withColumnRenamed("source", "score"), model).collect()}
    assert got[(1, None)].lang_pred == got[(2, 0)].lang_pred == got[(3, 4)].lang_pred == got[(7, 12)].lang_pred == "und"
    assert got[(8, 26)].lang_pred == "de" and got[(4, len(helpers.odd_documents()[4][1]))].lang_pred in truth.values()
    assert language.identify(empty, model).collect() == []
    assert language.fit(empty) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}


def test_many_rows_of_one_id_are_one_row_of_the_fit(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fitted_in_task", lambda rows, fit: seen.append(rows.count()))
    language.fit(spark.range(10_000).selectExpr("id % 2 AS doc_id", "concat('text ', id) AS text", "'en' AS lang"))
    assert seen == [2]
