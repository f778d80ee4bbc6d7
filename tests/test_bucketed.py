"""Merges into bucketed tables: plans, and results against the general merge operators."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableload.errors import ContractError
from tableload.operators import merge as M
from tableload.operators.bucketed import merge_bucketed, open_bucketed, save_bucketed
from tableload.sources.relation import arrow_chunks, iter_arrow, read_chunk
from tests.conftest import SF


def operators_of(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")  # noqa: SLF001


def depth(line: str) -> int:
    return len(re.match(r"[ :+\-|*()\d]*", line).group())


def above(lines: list[str], at: int) -> list[str]:
    """The plan lines from line ``at`` up to the root."""
    out, d = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < d:
            out.append(line)
            d = depth(line)
    return out


def test_target_is_read_once_and_crosses_no_exchange(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    target = save_bucketed(orders, str(tmp_path / "t"), "o_orderkey", 16)
    merged = merge_bucketed(target, orders, "o_orderkey", 16, "o_orderdate", ["o_totalprice"], partial=True)
    lines = operators_of(merged)
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x]
    assert len(scans) == 1 and "SelectedBucketsCount: 16 out of 16" in lines[scans[0]]
    assert not any("Exchange" in x for x in above(lines, scans[0]))
    staged = [i for i, x in enumerate(lines) if "FileScan" in x and i != scans[0]]
    assert any("Exchange" in x for i in staged for x in above(lines, i))  # what the test would see
    save_bucketed(merged, str(tmp_path / "u"), "o_orderkey", 16)
    files = [p.name for p in (tmp_path / "u").iterdir() if p.name.endswith(".parquet")]
    assert 0 < len(files) <= 16  # one task a bucket, one file a task


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("partial", [False, True])
def test_equals_the_general_merge(spark, tmp_path, seed, partial):
    rng = random.Random(seed)
    stored = [(k, rng.choice([None, 1, 2, 3]), f"a{k}", k * 1.5) for k in range(40)]
    staged = [(rng.randrange(60), rng.choice([None, 1, 2, 3, 4]), f"b{i}", rng.random() < 0.3) for i in range(80)]
    staged += [(7, 9, f"hot{i}", False) for i in range(200)]
    t = spark.createDataFrame(stored, "id long, cur int, v string, w double")
    s = spark.createDataFrame(staged, "id int, cur int, v string, gone boolean")
    got = merge_bucketed(save_bucketed(t, str(tmp_path / "t"), "id", 4), s, "id", 4, "cur", ["v"], partial=partial, hard_delete="gone")
    live = M.drop_stale(M.dedup_latest(s, "id", "cur", ["v"]), t, "id", "cur")
    stays = live.filter(~M.deleted_flag(live, "gone")).drop("gone")
    base = t.join(live.select("id"), "id", "left_anti").unionByName(t.join(stays.select("id"), "id", "left_semi"))
    want = M.upsert(base, stays if partial else stays.withColumn("w", F.lit(None).cast("double")), "id", partial=partial)
    assert got.columns == t.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*t.columns).collect()))


def test_empty_sides_null_keys_odd_names_and_another_session(spark, tmp_path):
    schema = "`the key` long, `a``b` string, n int"
    path = str(tmp_path / "it's")
    t = spark.createDataFrame([(1, "x", 1), (None, "y", 2), (None, "z", 3)], schema)
    save_bucketed(t, path, "the key", 3)
    again = open_bucketed(spark.newSession(), path, t.schema, "the key", 3)
    assert sorted(map(str, again.collect())) == sorted(map(str, t.collect()))
    again = open_bucketed(spark, path, t.schema, "the key", 3)
    none = spark.createDataFrame([], schema)
    assert merge_bucketed(again, none, "the key", 3).count() == 3
    fresh = merge_bucketed(save_bucketed(none, str(tmp_path / "none"), "the key", 3), t, "the key", 3)
    assert sorted(r[0] is None for r in fresh.collect()) == [False, True]  # staged rows without a key are one key's
    more = spark.createDataFrame([(1, "q", 5), (None, "n", 6)], schema)
    assert sorted(r.n for r in merge_bucketed(again, more, "the key", 3).collect()) == [2, 3, 5, 6]
    with pytest.raises(ContractError):
        merge_bucketed(again, spark.createDataFrame([(1, 2.5)], "`the key` long, n double"), "the key", 3)


def test_two_column_keys(spark, tmp_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").dropDuplicates(["l_orderkey", "l_linenumber"])
    key = ["l_orderkey", "l_linenumber"]
    t = save_bucketed(li, str(tmp_path / "t"), key, 5)
    m = merge_bucketed(t, li.filter("l_returnflag = 'R'").withColumn("l_tax", F.lit(9.0)), key, 5)
    assert m.count() == li.count()
    assert m.filter("l_tax = 9.0").count() == li.filter("l_returnflag = 'R'").count()


def test_chunks_are_cut_on_the_executors(spark):
    df = spark.range(0, 1003, 1, 4).select("id", F.col("id").cast("string").alias("id"), F.array("id").alias("xs"))
    sizes = [r.n_rows for r in arrow_chunks(df, 100).orderBy("part").collect()]
    assert sorted(sizes) == [50, 50, 51, 51] + [100] * 8 or sum(sizes) == 1003
    assert all(len(read_chunk(bytes(r.chunk))) == r.n_rows for r in arrow_chunks(df, 100).collect())
    chunks = list(iter_arrow(df, 100))
    assert [len(c) for c in chunks] == [100] * 10 + [3]
    whole = pa.concat_tables(chunks)
    assert whole.column(0).to_pylist() == list(range(1003)) and whole.column_names == ["id", "id", "xs"]
    assert whole.column(2)[7].as_py() == [7]
    with pytest.raises(ValueError):
        arrow_chunks(df, 0)


def test_chunk_types_are_those_of_the_frame(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(12,3)) AS d, TIMESTAMP'2024-01-01 00:00:00' AS t, named_struct('a', 1, 'b', map('k', 2)) AS s, "
                   "CAST(NULL AS STRING) AS n, X'01' AS b, DATE'2024-02-03' AS e, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS z")
    got = pa.concat_tables(list(iter_arrow(df, 10)))
    assert got.schema == df.toArrow().schema and got.to_pylist() == df.toArrow().to_pylist()
    assert list(iter_arrow(df.filter("false"), 10)) == []
