"""Helpers shared by the operators: table scans, Arrow batches, byte-level numpy."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmart.session import materialize, scratch_path  # noqa: F401  (re-exported)

# Rows and bytes of one Arrow batch handed to a Python worker. A batch is the
# unit of memory of every operator here; one row may exceed it, never a group.
BATCH_ROWS = 2048
BATCH_BYTES = 4 << 20
HASHED = 1 << 18

U = np.uint64

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: bounded Arrow batches, UTC, and
    this package on the Python path of the workers (a cluster without a shared
    install gets it with ``--py-files``)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with a null text as the empty text; other columns are dropped."""
    prepare(df.sparkSession)
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` that also removes the write's own shuffle files when it is done.

    The table takes their place, so a chain of steps holds one step's shuffle at a time.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return materialize(df, label)
    finally:
        conf.set(name, before)


def hashed_window(text: str, chars: int) -> Column:
    """``chars`` characters of a text from a place drawn by its hash: all of it counts alike."""
    return F.expr(f"substring({text}, cast(1 + pmod(xxhash64({text}, 'window'), greatest(length({text}) - {chars}, 0) + 1)"
                  f" as int), {chars})")


# A key is hot beyond 1/HOT of all rows, so there are fewer than HOT hot keys: the driver can hold them.
HOT, HOT_LEAST, SALTS = 4096, 64, 16


def hot_join(rows: DataFrame, other: DataFrame, on: list[str], sizes: DataFrame, total: int, spread: list[str],
             how: str = "inner") -> DataFrame:
    """``rows`` joined with ``other``; the rows of hot keys are dealt over SALTS tasks by the hash of
    ``spread``, and those keys' rows of ``other`` are repeated for each.

    ``sizes`` is a written table with the number of ``rows`` a key has (``n``), ``total`` their number.
    """
    keys = F.xxhash64(*on)
    found = sizes.where(F.col("n") > max(total // HOT, HOT_LEAST)).select(keys.alias("h")).distinct().collect()
    if not found:
        return rows.join(other, on, how)
    hot = F.expr(f"xxhash64({', '.join(on)}) IN ({', '.join(f'{r.h}L' for r in found)})")
    salt = F.when(hot, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left, right = rows.withColumn("_salt", salt), other.withColumn("_salt", F.explode(salts))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch; it returns the output columns as a dict."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield to_batch(out, target)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for f in schema:
        v = columns[f.name]
        if isinstance(v, pa.ChunkedArray):
            v = v.combine_chunks()
        arrays.append(v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, type=f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([pa.field(f.name, f.type) for f in schema]))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as one byte array and int64 offsets (nulls are empty)."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    kind = np.int64 if large else np.int32
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: One random 64-bit word per byte value.
BYTE_WORDS = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


def kgram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from every position (``len(data) - k + 1`` values).

    Polynomial hash modulo 2**64, doubled: the hash of 2h bytes is the hash of
    the first h times A**h plus that of the next h.
    """
    n = len(data)
    if n < k:
        return np.empty(0, U)
    a = pow(0xD6E8FEB86659FD93, 1, 1 << 64)
    level, width, out, done = BYTE_WORDS[data], 1, None, 0
    while True:
        if k & width:
            m = n - (done + width) + 1
            part = level[done:done + m]
            out = part.copy() if out is None else out[:m] * U(pow(a, width, 1 << 64)) + part
            done += width
        if done == k:
            return out
        level = level[:-width] * U(pow(a, width, 1 << 64)) + level[width:]
        width *= 2


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes 0x20 and 0x09 to 0x0D; no byte of a longer UTF-8 code point is one."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all texts; no word crosses texts."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~is_space(data)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a text begins here
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word given by byte spans (spans ascend, none is empty)."""
    if not len(starts):
        return np.empty(0, U)
    # some HASHED bytes at a time, or one longer word: a word needs several numbers a byte
    total = np.cumsum(ends - starts)
    cuts = np.flatnonzero(np.diff(total // HASHED, prepend=0)).tolist()
    edges = sorted({0, *cuts, len(starts)})
    parts = [_word_hashes(data, starts[lo:hi], ends[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    return np.concatenate(parts)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    longest = int(lengths.max())
    powers = np.ones(longest, U)
    if longest > 1:
        powers[1:] = np.cumprod(np.full(longest - 1, 0xD6E8FEB86659FD93, U))
    at = np.arange(int(lengths.sum()), dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    inside = at - np.repeat(first, lengths)
    values = BYTE_WORDS[data[inside + np.repeat(starts, lengths)]] * powers[inside]
    return mix(np.add.reduceat(values, first) + lengths.astype(U))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
