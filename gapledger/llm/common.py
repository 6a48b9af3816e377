"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def crc_remainder(column: str, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod``; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def lower_ascii(c: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, UPPER.lower())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: work that
    several consumers need runs once and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` whose last reader is done."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def among(rows: DataFrame, column: str, ids: DataFrame, bits: int = 1 << 25) -> DataFrame:
    """The rows whose ``column`` may be among the only column of ``ids``, by one
    bitmap of ``bits`` bits that is broadcast (4 MB): what surely is not is
    left out before a join has to shuffle it. An exact join must follow."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    maps = ids.select(place(ids.columns[0]).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    at = F.bitmap_bit_position(place(column))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("_bucket", F.bitmap_bucket_number(place(column))).join(F.broadcast(maps), "_bucket")
            .where(F.getbit(byte, (at % 8).cast("int")) == 1).select(rows.columns))


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in runs of rows of about ``max_bytes`` of text (one row at
    least), so that memory does not grow with the batch."""
    size = np.array([0 if x is None else x for x in _binary_length(batch, column)], np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
        part = batch.slice(at, to - at)
        yield part, texts(part, column)
        at = to


def _binary_length(batch: pa.RecordBatch, column: str) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(batch.column(column).cast(pa.binary())).to_pylist()


class Vocabulary(dict):
    """Dense ids in order of first use; C-speed through ``map(v.__getitem__, words)``."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def word_bytes(words: list[bytes], left: bytes = b"", right: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All words in one byte array, each between ``left`` and ``right``, and
    the length of each."""
    joined = left + (right + left).join(words) + right if words else b""
    extra = len(left) + len(right)
    return np.frombuffer(joined, np.uint8), np.fromiter(map(len, words), np.int64, len(words)) + extra


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), for uint64 arrays."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordCache:
    """Rows of numbers that depend on a word alone, computed once per distinct
    word and kept while the Python worker lives; emptied beyond ``limit``
    words, so its memory is bounded whatever the corpus holds."""

    def __init__(self, compute, limit: int = 200_000):
        self.compute, self.limit = compute, limit
        self.clear()

    def clear(self) -> None:
        self.vocab, self.rows = Vocabulary(), None

    def rows_of(self, documents: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each word of all documents, first word of each document and
        the end): rows[starts[i]:starts[i + 1]] belong to document i."""
        if len(self.vocab) > self.limit:
            self.clear()
        ids = [self.vocab.ids(ws) for ws in documents]
        starts = np.zeros(len(ids) + 1, np.int64)
        np.cumsum([len(x) for x in ids], out=starts[1:])
        have = 0 if self.rows is None else len(self.rows)
        if len(self.vocab) > have or self.rows is None:
            from itertools import islice

            new = self.compute(list(islice(self.vocab, have, None)))
            self.rows = new if self.rows is None else np.concatenate([self.rows, new])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        return flat, starts


def release() -> None:
    """Give memory that this Python worker no longer uses back to the system.
    Workers serve many stages: what one stage's arrays took and the allocators
    keep would stay beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that releases memory when its task is done."""
    def batches_of(batches):
        yield from run(batches)
        release()

    return batches_of


def tidy_group(run: Callable, large: int = 1 << 20) -> Callable:
    """A function for ``applyInArrow`` that releases memory after each group of
    over ``large`` bytes."""
    def group_of(table: pa.Table) -> pa.Table:
        size, out = table.nbytes, run(table)
        if size > large:
            release()
        return out

    return group_of


_CACHES: dict = {}


def worker_cache(key: str, make):
    """The cache of this Python worker for a model or tokenizer. Workers serve
    many stages; only the last one's cache stays."""
    if key not in _CACHES:
        if _CACHES:
            _CACHES.clear()
            release()
        _CACHES[key] = make()
    return _CACHES[key]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (rows) between consecutive ``starts``; empty runs are 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def output_columns(df: DataFrame, made: dict[str, str], drop: tuple[str, ...] = ()) -> str:
    """Schema of ``df`` without columns that bear a result's name, then ``made``."""
    kept = [f for f in df.schema.fields if f.name not in made and f.name not in drop]
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{k} {v}" for k, v in made.items()])


def with_columns(part: pa.RecordBatch, made: dict[str, np.ndarray], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    names = [n for n in part.schema.names if n not in made and n not in drop]
    return pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(v) for v in made.values()],
                                      names=names + list(made))


def smallest(df: DataFrame, column: str, n: int) -> DataFrame:
    """``n`` rows, those with the smallest hash of ``column``: a bounded sample
    that does not depend on the order of the rows."""
    return df.orderBy(F.xxhash64(column), column).limit(n)


def fitted_in_task(rows: DataFrame, fit):
    """``fit(table)`` of the whole of ``rows``, run in one task and returned to
    the driver; None without rows. For samples of bounded size whose fitting
    needs more memory than a driver should spend."""
    import pickle

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([pickle.dumps(fit(table))], pa.binary())})

    got = rows.withColumn("_all", F.lit(1)).groupBy("_all").applyInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else None


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights (last: bias) of a lightly regularised logistic regression, by Newton."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(min(steps, 50)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
