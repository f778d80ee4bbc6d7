"""Cases off the common path: mixed types, frames that differ, layouts that change, writers
that meet, damaged and archived bookkeeping."""

import random
from collections import Counter
from datetime import date
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.contract import TableContract
from tableload.errors import ContractError, DamagedLedgerError
from tableload.functions.lineage import key_id
from tableload.functions.partition import bucket, day, year
from tableload.operators import merge as M
from tableload.plans import load as L
from tableload.plans.incremental import incremental_load, last_cursor
from tableload.plans.load import load
from tableload.plans.maintenance import set_layout
from tableload.session import shared_dir
from tableload.sources.dataset import Dataset
from tableload.sources.inputs import frame


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("first,second,buckets", [("int", "int", 8), ("bigint", "decimal(20,0)", 64), ("bigint", "int", 8)])
def test_bucketed_keys_meet_whatever_their_type(spark, dataset_path, first, second, buckets):
    c = TableContract("t", "merge", ("k",), partition=[bucket(buckets, "k")])
    make = lambda n, dt, v: spark.range(n).select(F.col("id").cast(dt).alias("k"), F.lit(v).alias("v"))
    load(spark, dataset_path, {"t": make(20, first, "old")}, [c], "L1")
    load(spark, dataset_path, {"t": make(10, second, "new")}, [c], "L2")
    got = [(int(k), v) for k, v in rows(Dataset(spark, dataset_path).table("t"), "k", "v")]
    assert got == [(k, "new" if k < 10 else "old") for k in range(20)]


@pytest.mark.parametrize("disposition", ["append", "replace", "merge"])
def test_frames_are_matched_by_name(spark, dataset_path, disposition):
    c = TableContract("t", disposition, ("id",) if disposition == "merge" else ())
    a = spark.createDataFrame([(1, ["i1"], ["t1"])], "id int, items array<string>, tags array<string>")
    b = spark.createDataFrame([(2, ["t2"], ["i2"])], "id int, tags array<string>, items array<string>")
    d = spark.createDataFrame([(3, {"x": 1})], "id int, s struct<x:int>")
    load(spark, dataset_path, {"t": [d, a, b]}, [c], "L1", max_nesting=1)
    ds = Dataset(spark, dataset_path)
    assert rows(ds.table("t__items"), "value") == [("i1",), ("i2",)]
    assert rows(ds.table("t__tags"), "value") == [("t1",), ("t2",)]
    assert ds.table("t").count() == 3 and rows(ds.table("t").filter("id = 3"), "s__x") == [(1,)]


def test_frames_that_do_not_fit_together_stop_the_load(spark, dataset_path):
    bad = [spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([([1],)], "id array<int>")]
    with pytest.raises(ContractError):
        load(spark, dataset_path, {"t": bad}, [TableContract("t", "append")], "L1")
    assert not Dataset(spark, dataset_path).exists()


def test_row_ids_differ_between_frames(spark, dataset_path):
    parts = [spark.range(10).coalesce(1), spark.range(10).coalesce(1)]
    load(spark, dataset_path, {"t": parts}, [TableContract("t", "append")], "L1")
    assert Dataset(spark, dataset_path).table("t").select("_row_id").distinct().count() == 20


def test_key_ids_tell_all_keys_apart(spark):
    keys = [("x|y", "z"), ("x", "y|z"), (None, "z"), ("", "z"), ("z", None), ("-", "z"), ("1:a", ""), ("1", ":a"), (None, None)]
    df = spark.createDataFrame(keys, "a string, b string").select(key_id(["a", "b"]).alias("k"))
    assert df.distinct().count() == len(keys)


def test_each_table_of_a_pipeline_keeps_its_cursor(spark, dataset_path):
    run = lambda n, table, lid: incremental_load(spark, dataset_path, spark.range(n), TableContract(table, "append"), "id",
                                                 "pipe", lid, initial=-1)
    run(2, "a", "L1")
    run(5, "b", "L2")
    run(3, "a", "L3")
    ds = Dataset(spark, dataset_path)
    assert rows(ds.table("a"), "id") == [(0,), (1,), (2,)] and ds.table("b").count() == 5
    assert (last_cursor(spark, dataset_path, "pipe", "a"), last_cursor(spark, dataset_path, "pipe", "b")) == ("2", "4")


def test_refresh_loads_again_from_the_start(spark, dataset_path):
    c = TableContract("t", "append")
    incremental_load(spark, dataset_path, spark.range(5), c, "id", "pipe", "L1", initial=-1)
    incremental_load(spark, dataset_path, spark.range(7), c, "id", "pipe", "L2", initial=-1, refresh="drop_data",
                     allow_destructive=True)
    ds = Dataset(spark, dataset_path)
    assert ds.table("t").count() == 7 and last_cursor(spark, dataset_path, "pipe", "t") == "6"
    assert ds.states().filter("_load_id = 'L2'").count() == 1


def test_late_rows_at_the_cursor_and_without_one_are_loaded_once(spark, dataset_path):
    c = TableContract("t", "append")
    run = lambda data, lid: incremental_load(spark, dataset_path, spark.createDataFrame(data, "at int, v string"), c, "at",
                                             "pipe", lid, initial=0)
    one = [(1, "a"), (2, "b"), (2, "b")]
    run(one, "L1")
    run([*one, (2, "late"), (2, "b"), (None, "none"), (3, "c")], "L2")
    run([*one, (2, "late"), (2, "b"), (None, "none"), (3, "c")], "L3")
    got = sorted((r["at"] or 0, r["v"]) for r in Dataset(spark, dataset_path).table("t").collect())
    assert got == [(0, "none"), (1, "a"), (2, "b"), (2, "b"), (2, "b"), (2, "late"), (3, "c")]


@pytest.mark.parametrize("mode", ["plain", "snake_case", "nested", "merge"])
def test_late_rows_whatever_the_table_looks_like(spark, dataset_path, mode):
    naming = "snake_case" if mode == "snake_case" else "direct"
    c = TableContract("Ev", "merge" if mode == "merge" else "append", ("Id",) if mode == "merge" else ())
    name = "ev" if mode == "snake_case" else "Ev"

    def run(data, lid, extra=False, **kw):
        df = spark.createDataFrame(data, "Id int, AtTime date, xs array<string>" + (", More string" if extra else ""))
        df = df if mode == "nested" else df.drop("xs")
        return incremental_load(spark, dataset_path, df, c, "AtTime", "p", lid, naming=naming, max_nesting=1, **kw)

    d = lambda n: date(2026, 5, n)
    one = [(1, d(1), ["a"]), (2, d(2), ["b", "c"]), (3, d(2), []), (7, None, ["n"])]
    run(one, "L1")
    more = [(*r, "x") for r in one] + [(4, d(2), ["late"], "y"), (8, None, ["n"], None), (5, d(3), ["e"], None)]
    run(more, "L2", extra=True)
    run(more, "L3", extra=True)
    run([*one, (9, None, ["n"])], "L4")  # the column is gone again; nothing is doubled that had no value in it
    t = Dataset(spark, dataset_path).table(name)
    assert rows(t, t.columns[0]) == [(i,) for i in (1, 2, 3, 4, 5, 7, 8, 9)]
    if mode == "nested":
        xs = Dataset(spark, dataset_path).table("Ev__xs")
        assert rows(xs, "value") == [(v,) for v in sorted("a b c n late n e n".split())]
    assert last_cursor(spark, dataset_path, "p", name) == "2026-05-03"


def test_a_refresh_clears_cursor_and_boundary_under_the_final_name(spark, dataset_path):
    c = TableContract("Ev", "append")
    run = lambda n, lid, **kw: incremental_load(spark, dataset_path, spark.range(n).toDF("Id"), c, "Id", "p", lid,
                                                naming="snake_case", **kw)
    run(2, "L1")
    assert last_cursor(spark, dataset_path, "p", "ev") == "1"
    load(spark, dataset_path, {}, [c], "L2", naming="snake_case", refresh="drop_data", allow_destructive=True)
    assert last_cursor(spark, dataset_path, "p", "ev") is None
    run(2, "L3")
    ds = Dataset(spark, dataset_path)
    assert rows(ds.table("ev"), "id") == [(0,), (1,)]
    held = ds._boundaries()
    assert len(held) == 1 and len(ds.ledger.fs.list(f"{dataset_path}/_boundary")) == 2
    ds.vacuum(older_than_seconds=-5)
    assert ds.ledger.fs.list(f"{dataset_path}/_boundary") == [held[0]["path"].split("/")[1]]
    run(2, "L4")
    assert rows(ds.table("ev"), "id") == [(0,), (1,)]


def test_a_boundary_is_a_multiset(spark):
    from tableload.operators.boundary import boundary_of, joined, not_loaded
    rng = random.Random(2)
    schema = "at int, a string, m map<string,int>, s struct<x:double>"
    pick = lambda n: [(rng.choice([1, 1, None]), rng.choice("ab"), {"k": rng.randrange(2)}, (rng.choice([0.5, None]),)) for _ in range(n)]
    old, new = pick(40), pick(15)
    frame = lambda data: spark.createDataFrame(data, schema)
    parts = [boundary_of(frame(old[:25]), "at", F.lit(1)), boundary_of(frame(old[25:]), "at", F.lit(1))]
    got = not_loaded(frame(old + new), joined(parts), [sorted(frame(old).columns)])
    count = lambda data: Counter(map(repr, data))
    assert count(tuple(r) for r in got.collect()) == count(tuple(r) for r in frame(new).collect())


def test_layout_set_on_a_filled_table(spark, dataset_path):
    make = lambda lo, hi: spark.range(lo, hi).select("id", F.expr("timestamp_ntz'2026-03-01 00:00:00' + make_dt_interval(int(id))").alias("ts"))
    load(spark, dataset_path, {"t": make(0, 5)}, [TableContract("t", "append")], "L1")
    assert set_layout(spark, dataset_path, "t", [year("ts"), day("ts")])
    ds = Dataset(spark, dataset_path)
    between = lambda lo, hi: rows(ds.between("t", "ts", lo, hi), "id")
    assert between("2026-03-02 00:00:00", "2026-03-04 00:00:00") == [(1,), (2,), (3,)]
    load(spark, dataset_path, {"t": make(5, 10)}, [TableContract("t", "append")], "L2")
    assert between("2026-03-04 00:00:00", "2026-03-08 00:00:00") == [(i,) for i in range(3, 8)]
    load(spark, dataset_path, {"t": make(4, 12)}, [TableContract("t", "merge", ("id",))], "L3")
    assert between(None, "2026-04-01 00:00:00") == [(i,) for i in range(12)]
    assert between("2026-03-10 12:00:00", None) == [(10,), (11,)]


def test_bounds_follow_the_session_time_zone(spark, dataset_path):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP '2026-01-01 00:30:00 UTC' AS ts UNION ALL SELECT 2, TIMESTAMP '2025-12-31 23:30:00 UTC'")
    load(spark, dataset_path, {"t": df}, [TableContract("t", "append", partition=[year("ts")])], "L1")
    got = Dataset(spark, dataset_path).between("t", "ts", "2026-01-01 01:00:00+01:00", "2026-01-01 02:00:00+01:00")
    assert rows(got, "id") == [(1,)]


@pytest.mark.parametrize("first,second", [("id bigint", "id double"), ("id decimal(12,2)", "id decimal(12,3)")])
def test_lossy_types_are_refused(spark, dataset_path, first, second):
    from decimal import Decimal
    c = TableContract("t", "append")
    value = lambda s: (1.5,) if "double" in s else (Decimal("1.238"),) if "12,3" in s else (Decimal(1),) if "dec" in s else (1,)
    load(spark, dataset_path, {"t": spark.createDataFrame([value(first)], first)}, [c], "L1")
    with pytest.raises(ContractError):
        load(spark, dataset_path, {"t": spark.createDataFrame([value(second)], second)}, [c], "L2")
    assert Dataset(spark, dataset_path).table("t").count() == 1


def test_arrow_tables_keep_their_types(spark):
    table = pa.table({"n": pa.array([2**53 + 1, None], pa.int64()), "d": pa.array([None, None], pa.decimal128(12, 3))})
    df = frame(spark, table)
    assert [f.dataType for f in df.schema.fields] == [T.LongType(), T.DecimalType(12, 3)]
    assert [r.n for r in df.collect()] == [2**53 + 1, None]


def test_a_damaged_commit_is_an_error_and_hides_nothing(spark, dataset_path):
    c = TableContract("t", "append")
    load(spark, dataset_path, {"t": spark.range(3)}, [c], "L1")
    load(spark, dataset_path, {"t": spark.range(2)}, [c], "L2")
    ds = Dataset(spark, dataset_path)
    name = ds.ledger._name(ds.ledger.latest_seq())
    whole = ds.ledger.fs.read(name)
    ds.ledger.fs.delete(name)
    assert ds.ledger.fs.create_exclusive(name, whole[:len(whole) // 2])
    for use in (lambda: ds.table("t"), lambda: load(spark, dataset_path, {"t": spark.range(2)}, [c], "L3")):
        with pytest.raises(DamagedLedgerError):
            use()
    ds.ledger.fs.delete(name)
    assert ds.ledger.fs.create_exclusive(name, whole)
    assert ds.table("t").count() == 5


def test_a_commit_in_progress_is_not_seen(spark, dataset_path):
    c = TableContract("t", "append")
    load(spark, dataset_path, {"t": spark.range(3)}, [c], "L1")
    ds = Dataset(spark, dataset_path)
    assert ds.ledger.fs.create_exclusive(f"{ds.ledger._name(ds.ledger.latest_seq() + 1)}.abc.tmp", b"{")
    load(spark, dataset_path, {"t": spark.range(2)}, [c], "L2")
    assert ds.table("t").count() == 5


def test_merge_of_a_file_without_the_cursor(spark, dataset_path):
    c = TableContract("t", "merge", ("id",), cursor="at")
    load(spark, dataset_path, {"t": spark.createDataFrame([(1, "a", 5)], "id int, v string, at int")}, [c], "L1")
    no_cursor = spark.createDataFrame([(1, "lost"), (2, "b")], "id int, v string")
    load(spark, dataset_path, {"t": no_cursor}, [c], "L2")
    assert rows(Dataset(spark, dataset_path).table("t"), "id", "v") == [(1, "a"), (2, "b")]


def test_lineage_columns_in_the_input_are_refused(spark, dataset_path):
    for name in ("_row_id", "_Load_ID"):
        with pytest.raises(ContractError):
            load(spark, dataset_path, {"t": spark.range(1).withColumn(name, F.lit("x"))}, [TableContract("t", "append")], "L1")


def test_sql_names_are_quoted_and_kept_apart(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    load(spark, a, {"my table": spark.range(2)}, [TableContract("my table", "append")], "L1")
    load(spark, b, {"my table": spark.range(5)}, [TableContract("my table", "append")], "L1")
    one, two = Dataset(spark, a), Dataset(spark, b)
    first = one.sql("SELECT count(*) AS n FROM `my table`")
    assert two.sql("SELECT count(*) AS n FROM `my table`").first().n == 5
    assert first.first().n == 2 and one.sql("SELECT count(*) AS n FROM `my table`").first().n == 2


def test_drop_resources_reaches_archived_versions(spark, dataset_path, monkeypatch):
    from tableload.sources import ledger as LG
    monkeypatch.setattr(LG, "ARCHIVE_AFTER", 2)
    monkeypatch.setattr(LG, "KEEP_INLINE", 1)
    for i in range(5):
        load(spark, dataset_path, {"t": spark.range(1).withColumn(f"c{i}", F.lit(1))}, [TableContract("t", "append")], f"L{i}")
    ds = Dataset(spark, dataset_path)
    assert ds.schema_versions().count() == 5 and ds.snapshot().archives.get("schemas")
    load(spark, dataset_path, {"t": spark.range(1)}, [TableContract("t", "append")], "L9", refresh="drop_resources",
         allow_destructive=True)
    assert ds.schema_versions().count() == 1


def test_a_lost_race_keeps_the_work_unless_its_tables_changed(spark, dataset_path, monkeypatch):
    merge = TableContract("t", "merge", ("id",))
    load(spark, dataset_path, {"t": spark.range(5).withColumn("v", F.lit(0))}, [merge], "L1")
    ledger, real, prepared = type(Dataset(spark, dataset_path).ledger), L._merge, []
    monkeypatch.setattr(L, "_merge", lambda *a, **k: prepared.append(1) or real(*a, **k))
    commit, others = ledger.commit, iter(["other", "t"])

    def racing(self, base, new):
        other = next(others, None)
        if other:
            monkeypatch.setattr(ledger, "commit", commit)
            load(spark, dataset_path, {other: spark.createDataFrame([(90, 9)], "id long, v int")},
                 [TableContract(other, "append")], f"rival-{other}")
            monkeypatch.setattr(ledger, "commit", racing)
            return False
        return commit(self, base, new)

    monkeypatch.setattr(ledger, "commit", racing)
    load(spark, dataset_path, {"t": spark.createDataFrame([(1, 7)], "id long, v int")}, [merge], "L2")
    assert len(prepared) == 2  # first, and again after the rival wrote the same table
    assert rows(Dataset(spark, dataset_path).table("t"), "id", "v") == [(0, 0), (1, 7), (2, 0), (3, 0), (4, 0), (90, 9)]


def test_merging_one_key_again_leaves_no_trail(spark, dataset_path):
    c = TableContract("t", "merge", ("id",))
    sizes = []
    for i in range(6):
        load(spark, dataset_path, {"t": spark.createDataFrame([(1, i)], "id int, v int")}, [c], f"L{i}")
        sizes.append(len(Dataset(spark, dataset_path).snapshot().tables["t"]["segments"]))
    assert sizes == [1] * 6


def test_folded_groups_equal_one_merge_after_another(spark):
    rng = random.Random(8)
    schema = T.StructType.fromDDL("id int, at int, a int, b int")
    for _ in range(4):
        stored = {i: (rng.choice([None, 1, 2, 3]), rng.randrange(9), rng.randrange(9)) for i in range(6)}
        groups = []
        for _ in range(4):
            cols = rng.sample(["a", "b"], rng.randrange(3))
            keys = rng.sample(range(9), 5)
            groups.append((cols, [(k, rng.choice([None, 1, 2, 3, 4]), *[rng.choice([None, 50 + k]) for _ in cols]) for k in keys]))
        want = dict(stored)
        for cols, data in groups:
            for k, at, *vs in data:
                old = want.get(k)
                if old is None or (at is not None and (old[0] is None or at > old[0])):
                    new = dict(zip(cols, vs, strict=True))
                    a, b = (old[1], old[2]) if old else (None, None)
                    want[k] = (at, new.get("a", a), new.get("b", b))
        target = spark.createDataFrame([(k, *v) for k, v in stored.items()], schema)
        frames = [spark.createDataFrame(data, T.StructType([schema[c] for c in ("id", "at", *cols)])) for cols, data in groups]
        out = M.upsert_folded(target, M.fold_groups(frames, target, "id", schema, "at"), "id")
        assert {r.id: (r["at"], r.a, r.b) for r in out.collect()} == want


def test_a_cluster_without_a_shared_folder_is_refused():
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        shared_dir(session)
