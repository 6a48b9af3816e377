"""The SQL of op7 states the whole rule: alignments, runs and whole items."""

import duckdb

from gapledger.llm import decontam
from gapledger.llm.oracle import SQL

TWICE = "Tom has 3 apples in the red basket today. Ann has 5 apples in the red basket today. How many apples do they have together"
LONG = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)).replace("w", "word")
ITEMS = [(1, TWICE), (2, LONG), (3, "what makes a leaf green"), (4, "name the sum"), (5, "1 2 3 4 5 6"), (6, "最も高い山は何ですか"),
         (7, ""), (8, None), (9, "so be"), (3, "what makes a leaf green")]
DOCS = [(1, f"Here. {TWICE}. The end"), (2, f"intro text {' '.join(LONG.split()[10:35])} and more of it"),
        (3, "he asked what makes a leaf green and left"), (4, "Well. Name the sum! Thanks"), (5, "he can name the sum of it"),
        (6, "1 2 3 4 5 6"), (7, "a list 1 2 3 4 5 6 of it"), (8, "問題。最も高い山は何ですか？答え"),
        (9, TWICE.replace("Tom", "Bob").replace("3", "8")), (10, TWICE.replace("3", "8") + ". " + TWICE), (11, None), (12, ""),
        (13, "so be. So be it"), (1, f"Other. {TWICE}"), (14, f"{' '.join(LONG.split()[:12])} other words {' '.join(LONG.split()[30:40])}"),
        (15, TWICE.replace("in the red", "in the very red"))]


def test_sql_equals_the_operator_on_planted_documents(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(tuple(r) for r in decontam.contaminated(docs, items).collect())
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", DOCS), ("benchmark", "item_id", ITEMS)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    want = sorted(con.execute(SQL["op7_decontamination"]).fetchall())
    assert got == want
    assert {(1, 1), (2, 2), (3, 3), (4, 4), (6, 5), (8, 6), (9, 1), (10, 1)} <= {r[:2] for r in got}
    assert not {5, 7, 11, 12, 13, 14} & {r[0] for r in got}
