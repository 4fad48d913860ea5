"""Run the daily load once per arriving pipe file, with Structured Streaming.

The source system runs its load scripts once per file. Here a file-source
stream over an incoming folder hands each new file (``maxFilesPerTrigger=1``)
to ``foreachBatch``, which runs the same batch job (:func:`daily_load`) on it.
The stream's checkpoint (``<store>/_stream_checkpoint/<name>``) records which files were handed out, so a
restart resumes with the next file; ``trigger(availableNow=True)`` drains what is there and stops, which suits
a scheduled job.

What counts as loaded is decided by the store: a load is named after its files (path, size and time), which
its commit notes in the ledger. A micro-batch replayed after a crash, a lost checkpoint or a second
stream over the same folder therefore loads no file twice, and no file is skipped because
another stream or an earlier checkpoint used its epoch number.

A streaming file source needs its schema up front, so the header is checked
against the expected column list (by position, names case-insensitive).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightmart.plans.daily_load import LoadOptions, daily_load
from flightmart.schemas import RAW_COLUMNS
from flightmart.sources.pipe_file import CSV_OPTIONS, MALFORMED, refuse_long_rows
from flightmart.sources.store import FILE_FIELDS, TableStore


FILE_COLUMNS = {"_file_path": "file_path", "_file_size": "file_size", "_file_time": "file_modification_time"}


def files_digest(files: list) -> str:
    """A name for a set of files (path, size and time)."""
    text = "\n".join(sorted(f"{f.path}|{f.size}|{f.modified.isoformat()}" for f in files))
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def start_file_loader(spark: SparkSession, store: TableStore, incoming: str,
                      as_of: Callable[[int], dt.date], *, columns: tuple[str, ...] = RAW_COLUMNS,
                      checkpoint: str | None = None, opts: LoadOptions = LoadOptions(),
                      available_now: bool = True, name: str = "files") -> StreamingQuery:
    """Start the stream. ``as_of(epoch_id)`` gives each load's date; it must not depend on the
    clock, so that a replay gets the same one. ``name`` and the batch's files name the load. Streams of
    other folders take other names, as a name has one checkpoint."""
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], MALFORMED])
    files = (
        spark.readStream.options(**CSV_OPTIONS)
        .option("enforceSchema", "false")
        .option("maxFilesPerTrigger", 1)
        .schema(schema)
        .csv(incoming)
        .select("*", *[F.col(f"_metadata.{m}").alias(c) for c, m in FILE_COLUMNS.items()])
    )
    opts = replace(opts, new_files_only=True)

    def load(batch: DataFrame, epoch_id: int) -> None:
        # as many rows as the batch has files
        files = batch.select(*FILE_COLUMNS).distinct().toDF(*[f.name for f in FILE_FIELDS]).collect()
        if not files:
            return
        session = batch.sparkSession
        daily_load(session, store, refuse_long_rows(batch.drop(*FILE_COLUMNS)), as_of(epoch_id), opts,
                   load_id=f"{name}-{files_digest(files)}",
                   files=session.createDataFrame(files, T.StructType(FILE_FIELDS)))

    writer = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint or f"{store.root}/_stream_checkpoint/{name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
