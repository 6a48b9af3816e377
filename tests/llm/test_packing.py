import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gapledger.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, limits=packing.Limits()):
    """Every id in one piece, sequences gapless and within limits, no padding."""
    tokenizer = Tokenizer.from_file(PATH)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    assert {k for k, _ in pieces} == {k for k, _ in texts}
    for doc_id, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        own = sorted(pieces[(doc_id, len(ids))], key=lambda r: (r.start, r.sequence_id))
        times = len([1 for t in texts if t == (doc_id, text)])
        assert sum(r.length for r in own) == len(ids) * times
        for r in own:
            assert r.length > 0 and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == limits.tokens or at & (at - 1) == 0
        assert at <= limits.tokens and len(s) <= limits.segments and sum(r.loss_tokens for r in s) <= limits.loss


def test_whole_table(spark, base, docs):
    from gapledger.llm.queries import op5_packing

    check(op5_packing(spark, base).collect(), docs)


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 64), packing.Limits(256, 100, 40)])
def test_odd_inputs_and_limits(spark, odd, empty, limits):
    odd = odd.unionByName(spark.createDataFrame(
        [(50, "a<|endoftext|>b <|ENDOFTEXT|> Don't ΟΔΟΣ\x1c x\x85y", None, None, 0)], odd.schema))
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    check(packing.pack_texts(odd.withColumnRenamed("lang", "length"), PATH, limits=limits).collect(), texts, limits)
    assert packing.pack_texts(empty, PATH).collect() == []


def test_prompts_bear_no_loss_and_ids_come_back(spark):
    rows = [(i, "answer " * (i % 40 + 1), "question " * (i % 13) if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, prompt string")
    limits = packing.Limits(128, 6, 60)
    got = packing.pack_texts(df, PATH, prompt="prompt", limits=limits, with_ids=True, group_items=50).collect()
    answer, question = (Tokenizer.from_file(PATH).encode(w, add_special_tokens=False).ids for w in ("answer", "question"))
    by_doc = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.start):
        by_doc[r.doc_id] += r.ids
    for i, text, prompt in rows:
        assert by_doc[i] == question * len((prompt or "").split()) + answer * len(text.split()) + [2]
    loss = collections.Counter()
    for r in got:
        loss[r.doc_id] += r.loss_tokens
    assert all(loss[i] == len(answer) * len(t.split()) + 1 for i, t, _ in rows)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for s in sequences.values():
        n = sum(r.length for r in s)
        assert len(s) <= 6 and sum(r.loss_tokens for r in s) <= 60 and n <= 128 and (n == 128 or n & (n - 1) == 0)
