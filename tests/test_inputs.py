import os
import stat

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tableload.contract import TableContract
from tableload.errors import ContractError
from tableload.functions.partition import identity
from tableload.plans.load import load
from tableload.plans.maintenance import preflight, set_layout
from tableload.sources.dataset import Dataset
from tableload.sources.inputs import check_format, dataset_name, frame, read_files, route


def test_jsonl_refused():
    with pytest.raises(ContractError):
        check_format("jsonl")
    check_format("parquet")


def test_arrow_and_records_load_alike(spark, dataset_path):
    c = TableContract("t", "append")
    tbl = pa.table({"id": pa.array([2**53 + 1, None], pa.int64()), "kind": ["a", None]})
    load(spark, dataset_path, {"t": frame(spark, tbl, "id long, kind string")}, [c], "L1")
    load(spark, dataset_path, {"t": frame(spark, [{"id": 3, "kind": "b"}])}, [c], "L2")
    got = sorted((r["id"] or 0, r["kind"] or "") for r in Dataset(spark, dataset_path).table("t").collect())
    assert got == [(0, ""), (3, "b"), (2**53 + 1, "a")]


def test_parquet_files_narrow_ints_and_nanoseconds(spark, tmp_path, dataset_path):
    f = str(tmp_path / "in.parquet")
    pq.write_table(pa.table({"id": pa.array([1, 2], pa.int16()),
                             "ts": pa.array([1_000_000_001, 5], pa.timestamp("ns"))}), f)
    df = read_files(spark, [f])
    assert df.schema["ts"].dataType.simpleString() == "bigint"  # epoch ns kept exactly
    load(spark, dataset_path, {"t": df}, [TableContract("t", "append")], "L1")
    t = Dataset(spark, dataset_path).table("t")
    assert t.schema["id"].dataType.simpleString() == "bigint"
    assert sorted(r["ts"] for r in t.collect()) == [5, 1_000_000_001]


def test_dynamic_routing(spark, dataset_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "eventTime long, grp string")
    routes = route(df, "concat('events_', grp)")
    assert sorted(routes) == ["events_a", "events_b"]
    cs = [TableContract(n, "append") for n in routes]
    load(spark, dataset_path, routes, cs, "L1")
    ds = Dataset(spark, dataset_path)
    assert ds.table("events_a").count() == 2 and ds.table("events_b").count() == 1


def test_layout_set_reset_and_noop(spark, dataset_path):
    c = TableContract("t", "append", partition=[identity("k")])
    load(spark, dataset_path, {"t": spark.createDataFrame([(1, "x")], "id long, k string")}, [c], "L1")
    ds = Dataset(spark, dataset_path)
    seq = ds.ledger.latest_seq()
    for _ in range(3):
        assert set_layout(spark, dataset_path, "t", [identity("k")]) is False
    assert ds.ledger.latest_seq() == seq
    assert set_layout(spark, dataset_path, "t", []) is True
    load(spark, dataset_path, {"t": spark.createDataFrame([(2, "y")], "id long, k string")},
         [TableContract("t", "append")], "L2")
    segs = ds.snapshot().tables["t"]["segments"]
    assert segs[0]["layout"] and not segs[1]["layout"]
    assert sorted(r["k"] for r in ds.table("t").collect()) == ["x", "y"]


def test_preflight(spark, tmp_path):
    assert preflight(spark, str(tmp_path / "ok")) == []
    ro = tmp_path / "ro"
    ro.mkdir()
    os.chmod(ro, stat.S_IRUSR | stat.S_IXUSR)
    if os.geteuid() != 0:  # root ignores permissions
        assert preflight(spark, str(ro / "x"))


def test_dataset_names():
    assert dataset_name("selected_data", "first", "first") == "selected_data"
    assert dataset_name("selected_data", "second", "first") == "selected_data_second"


def test_compact_bounds_segments(spark, dataset_path):
    from tableload.plans.maintenance import compact
    c = TableContract("t", "append")
    for i in range(3):
        load(spark, dataset_path, {"t": spark.createDataFrame([(i, i), (0, 100 + i)], "id long, v long")}, [c],
             f"L{i}")
    ds = Dataset(spark, dataset_path)
    before = sorted(tuple(r) for r in ds.table("t").select("id", "v").collect())
    assert compact(spark, dataset_path, "t")
    assert len(ds.snapshot().tables["t"]["segments"]) == 1
    assert sorted(tuple(r) for r in ds.table("t").select("id", "v").collect()) == before
    assert before == [(0, 0), (0, 100), (0, 101), (0, 102), (1, 1), (2, 2)]
    assert not compact(spark, dataset_path, "t")


def test_vacuum_respects_age_and_live_segments(spark, dataset_path):
    from tableload.plans.maintenance import compact
    c = TableContract("t", "append")
    for i in range(2):
        load(spark, dataset_path, {"t": spark.createDataFrame([(i, i), (0, 10 + i)], "id long, v long")}, [c],
             f"L{i}")
    compact(spark, dataset_path, "t")
    ds = Dataset(spark, dataset_path)
    before = sorted(tuple(r) for r in ds.table("t").select("id", "v").collect())
    assert ds.vacuum() == []  # everything is younger than a week
    gone = ds.vacuum(older_than_seconds=0)
    assert len(gone) >= 2
    assert sorted(tuple(r) for r in ds.table("t").select("id", "v").collect()) == before
    assert len(os.listdir(f"{dataset_path}/t")) == 1


def test_routing_reads_one_directory_per_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "id long, grp string")
    with pytest.raises(ContractError):
        route(df, "grp", staging_path=str(tmp_path / "r1"))
    routes = route(df.filter("grp IS NOT NULL"), "concat('t_', grp)", staging_path=str(tmp_path / "r2"))
    assert sorted(routes) == ["t_a b", "t_c"]
    assert [r["id"] for r in routes["t_a b"].collect()] == [1]
    p = routes["t_c"]._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "PartitionFilters: [isnotnull(__route" in p
