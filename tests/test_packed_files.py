"""Compressed pipe files: the same rows, in files that many tasks can read."""

import gzip
import os
from collections import Counter

import pytest

from flightmart.plans import scenario, scenario_options
from flightmart.session import scratch_path
from flightmart.sources import pipe_file
from flightmart.sources.pipe_file import read_pipe_file, write_pipe_file
from test_feed import both_loads, by_spark, by_sql  # noqa: F401 (fixture)


def _files(path):
    local = path.removeprefix("file:")
    return [os.path.join(d, f) for d, _, names in os.walk(local) for f in names if f.startswith("part-")]


def test_compressed_files_hold_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(pipe_file, "PACKED_ROWS", 10)
    values = ["a", None, "x|y", 'say "hi"', "é", "b c"]
    df = spark.createDataFrame([(str(i), values[i % 6], values[i % 5]) for i in range(95)], "id string, one string, two string")
    root = scratch_path(spark, "t-packed")
    write_pipe_file(df.coalesce(1), f"{root}/plain")
    write_pipe_file(df.coalesce(1), f"{root}/packed", compression="gzip")
    rows = Counter(tuple(r) for r in df.collect())
    for kind in ("plain", "packed"):
        assert Counter(tuple(r) for r in read_pipe_file(spark, f"{root}/{kind}").collect()) == rows
    packed = _files(f"{root}/packed")
    assert len(packed) == 10 and len(_files(f"{root}/plain")) == 1
    for f in packed:
        with gzip.open(f, "rt") as lines:
            assert next(lines) == "id|one|two\n" and len(list(lines)) <= 10


@pytest.mark.parametrize(("module", "name"), [(scenario_options, "load_each_file_once"), (scenario, "two_batch_load")])
def test_loads_read_compressed_files(spark, both_loads, monkeypatch, module, name):  # noqa: F811
    roots = []
    scratch = module.scratch_path
    monkeypatch.setattr(module, "scratch_path", lambda s, label: roots.append(scratch(s, label)) or roots[-1])
    monkeypatch.setattr(pipe_file, "PACKED_ROWS", 5)
    assert by_spark(spark, both_loads, name) == by_sql(both_loads, name)
    incoming = _files(f"{roots[0]}/_incoming")
    assert len(incoming) >= 20 and all(f.endswith(".csv.gz") for f in incoming)
