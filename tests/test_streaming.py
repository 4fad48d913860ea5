import datetime as dt

from pyspark.sql import functions as F

from flightmart.schemas import RAW_COLUMNS
from flightmart.session import scratch_path
from flightmart.sources.feed import batch_feed
from flightmart.sources.pipe_file import write_pipe_file
from flightmart.sources.store import TableStore
from flightmart.streaming import start_file_loader

SF = "/root/testdata/sf0.001"
DATES = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def _raw_file(spark, b, path):
    df = batch_feed(spark, SF, b)
    full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS])
    write_pipe_file(full.coalesce(1), path)


def test_each_new_file_is_one_load(spark):
    root = scratch_path(spark, "t-stream")
    store = TableStore(spark, root)
    incoming = f"{root}/_incoming"
    _raw_file(spark, 0, f"{incoming}/day1")
    q = start_file_loader(spark, store, f"{incoming}/*", as_of=lambda epoch: DATES[epoch])
    q.awaitTermination(300)
    after_first = TableStore(spark, root).read("fact_flights").groupBy("load_date").count().collect()
    assert [r.load_date for r in after_first] == [DATES[0]]
    # a second file arrives: a restart picks up only the new one
    _raw_file(spark, 1, f"{incoming}/day2")
    q = start_file_loader(spark, TableStore(spark, root), f"{incoming}/*", as_of=lambda epoch: DATES[epoch])
    q.awaitTermination(300)
    days = {r.load_date for r in TableStore(spark, root).read("fact_flights").select("load_date").distinct().collect()}
    assert days == set(DATES)
    assert TableStore(spark, root).version("dim_airplane") == 3  # empty table + two loads


def _small_file(spark, path, *ids):
    from test_cleaning import frame, row

    full = frame(spark, [row(i) for i in ids])
    cols = [F.col(c) if c in full.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    write_pipe_file(full.select(*cols).coalesce(1), path)


def _loaded(spark, root):
    return sorted(r.transactionid for r in TableStore(spark, root).read("fact_flights").collect())


def test_streams_over_two_folders_load_every_file(spark):
    root = scratch_path(spark, "t-two")
    _small_file(spark, f"{root}/in-a/1", "A1")
    _small_file(spark, f"{root}/in-b/1", "B1")
    for folder in ("in-a", "in-b"):   # same store and name, checkpoints of their own: both start at epoch 0
        q = start_file_loader(spark, TableStore(spark, f"{root}/wh"), f"{root}/{folder}/*", as_of=lambda e: DATES[0],
                              checkpoint=f"{root}/ck-{folder}")
        q.awaitTermination(300)
    assert _loaded(spark, f"{root}/wh") == ["A1", "B1"]


def test_a_lost_checkpoint_loads_no_file_twice(spark):
    root = scratch_path(spark, "t-lost")
    _small_file(spark, f"{root}/in/1", "A1")
    q = start_file_loader(spark, TableStore(spark, f"{root}/wh"), f"{root}/in/*", as_of=lambda e: DATES[0])
    q.awaitTermination(300)
    _small_file(spark, f"{root}/in/2", "A2", "A3")
    q = start_file_loader(spark, TableStore(spark, f"{root}/wh"), f"{root}/in/*", as_of=lambda e: DATES[1],
                          checkpoint=f"{root}/new-checkpoint")
    q.awaitTermination(300)
    assert _loaded(spark, f"{root}/wh") == ["A1", "A2", "A3"]
