"""How records are staged and which of them is the first: what a task holds does not grow with its rows."""

import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from landfall.operators.infer import infer_with_heads
from landfall.plans import flow
from landfall.sources import LANDING_SCHEMA

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _landing(spark, bodies):
    rows = [("many", None, i, json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, LANDING_SCHEMA).coalesce(1)


def test_staging_opens_the_files_of_all_tables_and_does_not_sort(spark, monkeypatch):
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(spark.conf.get(WRITERS))), write(self, *a, **k))[1])
    before = spark.conf.get(WRITERS)
    staged = flow.stage(_landing(spark, [{"a": [{"x": 1}], "b": [{"y": 2}]}]))
    assert seen[0] >= 2
    assert spark.conf.get(WRITERS) == before
    assert staged.tables == ["a", "b"]


def test_writers_are_as_before_after_a_failed_write(spark, tmp_path):
    before = spark.conf.get(WRITERS)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"), F.lit("t").alias("table_name"))
    with pytest.raises(Exception, match="no"):
        flow._write_by_table(bad, str(tmp_path / "out"))
    assert spark.conf.get(WRITERS) == before


def test_staged_files_have_small_row_groups(spark, monkeypatch):
    monkeypatch.setattr(flow, "_STAGED_GROUP", 1 << 16)
    record = lambda i: {"id": i, "text": f"{i * 7919 % 10007} {i * 104729 % 1299709}"}
    staged = flow.stage(_landing(spark, [{"lines": [record(i * 100 + j) for j in range(100)]} for i in range(300)]))
    groups = [pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{staged.path}/table_name=lines/*.parquet")]
    assert max(groups) > 1
    assert staged.records.count() == 30_000


def test_more_tables_in_a_task_than_open_files(spark, store):
    # Each response has records of 40 tables, beyond those that one task keeps open, and all are stored.
    bodies = [{f"t{n}": [{"id": 100 * i + n, "v": i}] for n in range(40)} for i in range(5)]
    staged = flow.stage(_landing(spark, bodies))
    found = {(r["table_name"], r["n"], r["least"]) for r in staged.records.groupBy("table_name").agg(
        F.count("*").alias("n"), F.min(F.variant_get("record", "$.id", "int")).alias("least")).collect()}
    assert found == {(f"t{n}", 5, n) for n in range(40)}


@pytest.mark.parametrize("seqs", [
    [-(2**63), -(2**51) - 1, -(2**51), -5, 0, 7, 2**51 - 1, 2**51, 2**63 - 1],
    [2**51 - 1, 2**51], [-(2**51) - 1, -(2**51)], [10**12, 3 * 10**12],
])
@pytest.mark.parametrize("pos", [[0, 4095, 4096, 2**31 - 1], [4095, 4096], [1, 2]])
def test_the_first_type_is_that_of_the_first_record_wherever_seq_and_pos_lie(spark, seqs, pos):
    # Every record has a field of its own type: the first one in order by seq, then pos, gives it.
    places = [(s, p) for s in seqs for p in pos]
    types = {0: ("1", "int"), 1: ('"a"', "str"), 2: ("true", "bool"), 3: ("1.5", "float")}
    for first in (0, 1):
        rows = [("e", None, s, p, "t", f'{{"a":{types[0 if (s, p) == sorted(places)[0] and not first else 1 + (i + first) % 3][0]}}}')
                for i, (s, p) in enumerate(reversed(places))]
        want = types[next(k for k, (text, _) in types.items() if min(rows, key=lambda r: (r[2], r[3]))[5] == f'{{"a":{text}}}')][1]
        records = spark.createDataFrame(rows, "endpoint string, entity_id long, seq long, pos int, table_name string, body string")
        records = records.withColumn("record", F.parse_json("body")).drop("body")
        assert [r["type"] for r in infer_with_heads(records, union_keys=True).collect()] == [want]
