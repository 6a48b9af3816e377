"""Packing by vector bins: sequences under limits on tokens, segments and
loss-bearing tokens at once.

A sequence is filled with the open item whose demand has the largest dot
product with what the sequence has left, over the three limits. When no item
fits whole, one is cut to the size of the gap and its rest stays open, so a
sequence is only short when its segments or loss tokens ran out; it is then cut
back to a power of two, which needs no padding, and what was cut off stays
open. What is open when a task ends closes as sequences of powers of two.

Each task packs its own rows, group by group of bounded size, carrying over
what is open: nothing is shuffled, and no limit depends on the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import Vocabulary, slices, texts, tidy, worker_cache


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 128
    loss: int = 4096


@dataclass
class Piece:
    doc: int
    start: int
    length: int
    loss: int  # loss-bearing tokens in it: its last ones


class WordTokens:
    """Token ids of whole texts by a tokenizer whose tokens never span ASCII
    white space: each distinct word is tokenized once per Python worker, which
    keeps up to ``limit`` words (some 80 MB)."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.clear()

    def clear(self) -> None:
        self.vocab, self.ids, self.ends = Vocabulary(), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        from itertools import islice

        words = [w.decode("utf-8", "replace") for w in islice(self.vocab, len(self.ends) - 1, None)]
        if not words:
            return
        ids, counts = [self.ids], []
        for at in range(0, len(words), 256):
            part = words[at:at + 256]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            own = found.ids
            starts = np.cumsum([0] + [len(w) + 1 for w in part[:-1]])
            first = [found.char_to_token(x) for x in starts.tolist()]
            if None in first:  # a word that begins with a character without a token
                place = np.searchsorted(starts, np.array([a for a, _ in found.offsets], np.int64), "right") - 1
                counts.append(np.bincount(place, minlength=len(part)))
            else:
                counts.append(np.diff(np.array([*first, len(own)])))
            ids.append(np.array(own, np.uint32))
        self.ids = np.concatenate(ids)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(counts))])

    def encode(self, documents: list[bytes]) -> list[np.ndarray]:
        if len(self.vocab) > self.limit:
            self.clear()
        words = [self.vocab.ids(d.split()) for d in documents]
        self._learn()
        out = []
        for w in words:
            first, n = self.ends[w], self.ends[w + 1] - self.ends[w]
            out.append(self.ids[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())])
        return out


def word_tokens(path: str) -> WordTokens:
    return worker_cache(f"tokens {path}", lambda: WordTokens(path))


def cut(doc: int, n: int, loss_from: int, limits: Limits) -> Iterator[Piece]:
    """Pieces of a document that each fit an empty sequence."""
    start = 0
    while start < n:
        length = min(limits.tokens, n - start, max(0, loss_from - start) + limits.loss)
        yield Piece(doc, start, length, max(0, start + length - max(start, loss_from)))
        start += length


def _split(p: Piece, length: int) -> tuple[Piece, Piece]:
    """The first ``length`` tokens and the rest; loss-bearing tokens are last."""
    rest = p.length - length
    loss = min(p.loss, rest)
    return Piece(p.doc, p.start, length, p.loss - loss), Piece(p.doc, p.start + length, rest, loss)


def _take(sequence: list[Piece], tokens: int) -> tuple[list[Piece], list[Piece]]:
    """The sequence's first ``tokens`` tokens, and what is left."""
    kept, left = [], []
    for p in sequence:
        if tokens >= p.length:
            kept.append(p)
            tokens -= p.length
        elif tokens:
            a, b = _split(p, tokens)
            kept.append(a)
            left.append(b)
            tokens = 0
        else:
            left.append(p)
    return kept, left


def pack(items: list[Piece], limits: Limits, final: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """(full sequences, open items). With ``final`` nothing stays open."""
    done, pool = [], []
    for p in items:
        if p.length == limits.tokens:
            done.append([p])
        elif p.length:
            pool.append(p)
    while pool:
        size = np.array([p.length for p in pool], np.float64)
        loss = np.array([p.loss for p in pool], np.float64)
        if not final and size.sum() < 8 * limits.tokens:
            break
        free = np.ones(len(pool), bool)
        extra: list[Piece] = []  # rests of cut items; they wait for the next round
        while True:
            left = size[free].sum()
            if not free.any() or (left < limits.tokens and not (final and not extra)):
                break
            sequence, tokens, bears = [], float(limits.tokens), float(limits.loss)
            while tokens and len(sequence) < limits.segments:
                fits = free & (size <= tokens) & (loss <= bears)
                if fits.any():
                    room = (tokens / limits.tokens / limits.tokens, bears / limits.loss / limits.loss)
                    at = int(np.argmax(np.where(fits, size * room[0] + loss * room[1], -1.0)))
                    p = pool[at]
                else:
                    open_ = np.flatnonzero(free)
                    if not len(open_):
                        break
                    prompt = size[open_] - loss[open_]
                    most = np.minimum(np.minimum(prompt + bears, tokens), size[open_])
                    best = int(np.argmax(most))
                    if most[best] < 1:
                        break
                    at = int(open_[best])
                    p, rest = _split(pool[at], int(most[best]))
                    if rest.length:
                        extra.append(rest)
                free[at] = False
                sequence.append(p)
                tokens -= p.length
                bears -= p.loss
            used = limits.tokens - int(tokens)
            if tokens:
                sequence, over = _take(sequence, 1 << (used.bit_length() - 1))
                extra.extend(over)
            done.append(sequence)
        pool = extra + [pool[i] for i in np.flatnonzero(free)]
        if not final:
            break
    return done, pool


def pack_texts(docs: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", prompt: str | None = None,
               end_id: int = 2, limits: Limits = Limits(), with_ids: bool = False, group_items: int = 2048,
               group_tokens: int = 4 << 20) -> DataFrame:
    """One row per piece: doc, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, loss_tokens, and ids if asked for.

    A row's ids are those of ``prompt`` (if given; these bear no loss), of
    ``text`` and ``end_id``; null texts are empty. Every id of every row lies in
    one piece; repeated rows are packed each for itself. Other columns of
    ``docs`` are left out.
    """
    kind = docs.schema[doc].dataType.simpleString()
    schema = (f"`{doc}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint, loss_tokens bigint" + (", ids array<int>" if with_ids else ""))

    def run(batches):
        encoder = word_tokens(tokenizer)
        at, kept, held, items, doc_type = TaskContext.get().partitionId() << 32, {}, 0, [], None
        new = 0  # documents in ``items`` since the last packing

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal at
            out = []
            for s in sequences:
                offset = 0
                for p in s:
                    key, ids = kept[p.doc]
                    own = ids[p.start:p.start + p.length]
                    out.append((key, p.start, p.length, zlib.crc32(own.astype("<u4").tobytes()), len(ids), at, offset,
                                p.loss, own.astype(np.int32) if with_ids else None))
                    offset += p.length
                at += 1
            cols = list(zip(*out, strict=True)) if out else [[] for _ in range(9)]
            arrays = [pa.array(cols[0], doc_type)] + [pa.array(c, pa.int64()) for c in cols[1:8]]
            names = [doc, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
            if with_ids:
                arrays.append(pa.array(list(cols[8]), pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal items, kept, held, new
            done, items = pack(items, limits, final)
            for i in range(0, len(done), 2000):
                yield rows(done[i:i + 2000])
            open_ = {p.doc for p in items}
            kept = {k: v for k, v in kept.items() if k in open_}
            held, new = 0, 0

        n = 0
        for batch in batches:
            doc_type = batch.schema.field(doc).type
            for part, found in slices(batch, text):
                prompts = encoder.encode(texts(part, prompt)) if prompt else [np.zeros(0, np.uint32)] * len(found)
                for key, before, own in zip(part.column(doc).to_pylist(), prompts, encoder.encode(found), strict=True):
                    ids = np.concatenate([before, own, np.array([end_id], np.uint32)])
                    kept[n] = (key, ids)
                    items.extend(cut(n, len(ids), len(before), limits))
                    n, held, new = n + 1, held + len(ids), new + 1
                    if new >= group_items or held >= group_tokens:
                        yield from flush(False)
        if items:
            yield from flush(True)

    columns = [doc, text] + ([prompt] if prompt else [])
    return docs.select(*dict.fromkeys(columns)).mapInArrow(tidy(run), schema)
