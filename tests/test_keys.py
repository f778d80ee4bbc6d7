"""Key codes, keys that change their type between loads, and partition folders made of values."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.contract import TableContract
from tableload.functions.keycode import directory_code, key_code
from tableload.functions.lineage import key_id
from tableload.functions.partition import PartitionKey, bucket, day, hour, identity, month, year
from tableload.operators.layout import prune
from tableload.plans.load import load
from tableload.sources.dataset import Dataset

VALUES = {
    "bigint": [0, 1, -1, 9, 10, -9, -10, 99, 100, 2**63 - 1, -2**63],
    "tinyint": [-128, -1, 0, 127],
    "decimal(20,0)": [D(0), D(1), D(-1), D(10), D(-10), D(2**64 - 1)],
    "decimal(12,3)": [D("0"), D("0.001"), D("-0.001"), D("1.5"), D("1.05"), D("-1.5"), D("999999999.999"), D("10")],
    "decimal(38,9)": [D("0"), D("0.000000001"), D("-0.000000001"), D("1E20"), D("-12345678901234567890123456789.5")],
    "decimal(38,38)": [D("0"), D("0.5"), D("1E-38"), D("-1E-38"), D("0.05"), D("-0.5")],
    "double": [0.0, 1.0, -1.0, 1e-308, 5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), float("nan"), 0.1, 0.1 + 0.2, 0.3],
    "float": [0.0, 1.5, -1.5, 3e38, 1e-45],
    "date": [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(9999, 12, 31)],
    "timestamp_ntz": [dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
                      dt.datetime(2024, 2, 29, 1, 2, 3, 4), dt.datetime(2024, 2, 29, 1, 2, 3), dt.datetime(9999, 12, 31, 23)],
    "timestamp": [dt.datetime(1960, 1, 1), dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29, 1, 2, 3, 4)],
    "time(6)": [dt.time(0), dt.time(1, 2, 3), dt.time(1, 2, 3, 5), dt.time(23, 59)],
    "string": ["", "a", "b", "aa", "ab", " ", "a b", "é", "日", "\x00", "\x01", "0", "1"],
    "binary": [b"", b"\x00", b"a", b"ab", b"\xff"],
    "boolean": [True, False],
}


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", VALUES)
def test_codes_are_different_and_in_order(spark, name):
    dtype = T._parse_datatype_string(name)
    df = spark.createDataFrame([(v,) for v in VALUES[name]] + [(None,)], T.StructType([T.StructField("c", dtype)]))
    got = df.coalesce(1).sort("c").select(key_code([F.col("c")], [dtype]).alias("k"), directory_code(F.col("c"), dtype).alias("d")).collect()
    keys, folders = [r.k.encode() for r in got], [r.d.encode() for r in got]
    assert keys == sorted(set(keys)) and len(keys) == len(VALUES[name]) + 1
    assert folders == sorted(folders) and all(folders)


def test_codes_of_several_columns_keep_apart(spark):
    keys = [("x|y", "z"), ("x", "y|z"), (None, "z"), ("", "z"), ("z", None), ("z", ""), ("1:a", ""), ("1", ":a"), (None, None), ("", "")]
    df = spark.createDataFrame(keys, "a string, b string")
    code = key_code([F.col("a"), F.col("b")], [T.StringType()] * 2)
    got = [(r.a, r.b) for r in df.coalesce(1).select("a", "b", code.alias("k")).sort("k").collect()]
    assert got == [(r.a, r.b) for r in df.sort("a", "b").collect()] and df.select(code).distinct().count() == len(keys)


def test_equal_numbers_of_different_width_have_one_code(spark):
    df = spark.createDataFrame([(v,) for v in (0, 7, -7, 127)], "v tinyint")
    for other in ("int", "bigint", "decimal(20,0)"):
        a, b = key_code([F.col("v")], [T.ByteType()]), key_code([F.col("v").cast(other)], [T._parse_datatype_string(other)])
        assert df.filter(a != b).count() == 0


def test_ids_do_not_depend_on_the_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-10-27 00:30:00Z' AS a, TIMESTAMP_NTZ '2024-10-27 02:30:00' AS b UNION ALL "
                   "SELECT TIMESTAMP '2024-10-27 01:30:00Z', TIMESTAMP_NTZ '1900-01-01 00:00:00.5'")
    seen = set()
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):  # both times are 02:30 in Berlin
            spark.conf.set("spark.sql.session.timeZone", zone)
            ids = df.select(key_id(["a", "b"], [f.dataType for f in df.schema.fields]).alias("k"))
            seen.add(tuple(sorted(r.k for r in ids.collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1 and len(set(seen.pop())) == 2


CHANGES = [("timestamp_ntz", "date"), ("timestamp", "date"), ("timestamp", "timestamp_ntz"), ("string", "int"), ("string", "bigint"),
           ("bigint", "int"), ("bigint", "decimal(20,0)"), ("double", "float"), ("double", "int"), ("decimal(12,2)", "int")]


def keyed(spark, n, dtype, v, lists=False):
    day0 = F.date_add(F.lit("2024-03-29").cast("date"), F.col("id").cast("int"))
    k = day0.cast(dtype) if dtype in ("date", "timestamp", "timestamp_ntz") else F.col("id").cast(dtype)
    df = spark.range(n).select(k.alias("k"), F.lit(v).alias("v"))
    return df.withColumn("xs", F.array(F.lit(v), F.lit("both"))) if lists else df


@pytest.mark.parametrize("stored,arriving", CHANGES)
def test_keys_meet_in_the_stored_type(spark, dataset_path, stored, arriving):
    c = TableContract("t", "merge", ("k",), partition=[bucket(8, "k")])
    load(spark, dataset_path, {"t": keyed(spark, 20, stored, "old")}, [c], "L1")
    load(spark, dataset_path, {"t": keyed(spark, 8, arriving, "new")}, [c], "L2")
    t = Dataset(spark, dataset_path).table("t")
    assert t.count() == 20 and t.select("k").distinct().count() == 20
    assert t.filter("v = 'new'").count() == 8


@pytest.mark.parametrize("stored,arriving", CHANGES[1:5:3])
def test_children_follow_a_key_of_another_type(spark, dataset_path, stored, arriving):
    c = TableContract("t", "merge", ("k",), partition=[bucket(4, "k")])
    load(spark, dataset_path, {"t": keyed(spark, 6, stored, "old", True)}, [c], "L1", max_nesting=1)
    load(spark, dataset_path, {"t": keyed(spark, 2, arriving, "new", True)}, [c], "L2", max_nesting=1)
    ds = Dataset(spark, dataset_path)
    xs = ds.table("t__xs")
    assert xs.count() == 12 and xs.filter("value = 'new'").count() == 2 and xs.select("_root_id").distinct().count() == 6
    assert xs.join(ds.table("t").select(F.col("_row_id").alias("_root_id")), "_root_id").count() == 12


def test_cursors_compare_in_the_stored_type(spark, dataset_path):
    c = TableContract("t", "merge", ("id",), cursor="at")
    make = lambda at, v: spark.createDataFrame([(1, v)], "id int, v string").withColumn("at", F.expr(at))
    load(spark, dataset_path, {"t": make("TIMESTAMP_NTZ '2024-01-02 08:00:00'", "a")}, [c], "L1")
    load(spark, dataset_path, {"t": make("DATE '2024-01-02'", "stale")}, [c], "L2")
    assert rows(Dataset(spark, dataset_path).table("t"), "v") == [("a",)]
    load(spark, dataset_path, {"t": make("DATE '2024-01-03'", "b")}, [c], "L3")
    assert rows(Dataset(spark, dataset_path).table("t"), "v") == [("b",)]


def test_composite_and_text_keys_skip_files_out_of_range(spark, dataset_path):
    from tableload.plans.load import _touched
    c = TableContract("t", "merge", ("a", "b"))
    for i in range(3):
        df = spark.range(i * 100, i * 100 + 100).select(F.format_string("k%05d", "id").alias("a"), F.col("id").alias("b"))
        load(spark, dataset_path, {"t": df}, [c], f"L{i}")
    ds = Dataset(spark, dataset_path)
    keys = spark.createDataFrame([("k00250", 250), ("k00251", 251)], "a string, b long")
    assert all("=L2-" in f for f in _touched(ds, ds.snapshot(), "t", keys, ["a", "b"]))
    assert _touched(ds, ds.snapshot(), "t", spark.createDataFrame([(None, 1)], "a string, b long"), ["a", "b"]) == []


@pytest.mark.parametrize("name", ["string", "double", "date"])
def test_partition_values_read_back_as_they_were(spark, dataset_path, name):
    dtype = T._parse_datatype_string(name)
    values = [*VALUES[name], None] + (["__HIVE_DEFAULT_PARTITION__", "a/b", "x=y", "%2F", "..", "z" * 300] if name == "string" else [])
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("p", dtype)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    load(spark, dataset_path, {"t": df}, [TableContract("t", "append", partition=[identity("p")])], "L1")
    ds = Dataset(spark, dataset_path)
    same = lambda a: a.join(df.withColumnRenamed("p", "q"), "i").filter("NOT (p <=> q)").count()
    assert same(ds.table("t")) == 0 and ds.table("t").count() == len(values)
    load(spark, dataset_path, {"t": df.filter("i % 2 = 0")}, [TableContract("t", "merge", ("i",), partition=[identity("p")])], "L2")
    assert same(ds.table("t")) == 0 and ds.table("t").count() == len(values)
    bound = [str(v) if name == "date" else v for v in values]
    for lo, hi in ((bound[0], bound[2]), (bound[1], None), (None, bound[0])):
        want = df.filter(F.lit(True) if lo is None else F.col("p") >= F.lit(lo).cast(dtype)).filter(
            F.lit(True) if hi is None else F.col("p") <= F.lit(hi).cast(dtype))
        got = ds.between("t", "p", lo, hi)
        assert rows(got, "i") == rows(want, "i")
        assert "_p_p_value" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[-1]  # noqa: SLF001


def test_folders_written_before_values_were_coded_are_still_read(spark, dataset_path):
    c = TableContract("t", "merge", ("i",), partition=[identity("p"), bucket(4, "i")])
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(8)], "i long, p string")
    load(spark, dataset_path, {"t": df}, [c], "L1")
    ds = Dataset(spark, dataset_path)
    snap = ds.snapshot()
    seg = snap.tables["t"]["segments"][0]
    old = seg["path"] + "-old"
    ds.table("t").withColumn("_p_i_bucket4", F.pmod(F.hash(F.col("i").cast("string")), F.lit(4))).write.partitionBy("p", "_p_i_bucket4").parquet(old)
    new = snap.copy()
    layout = [{k: v for k, v in key.items() if k != "coded"} for key in seg["layout"]]
    new.tables["t"]["segments"] = [{"path": old, "layout": layout, "removed": []}]
    new.tables["t"]["layout"] = layout
    assert ds.ledger.commit(snap, new)
    assert rows(ds.between("t", "p", "b", "b"), "i") == [(1,), (3,), (5,), (7,)]
    load(spark, dataset_path, {"t": spark.createDataFrame([(3, "c")], "i long, p string")}, [TableContract("t", "merge", ("i",))], "L2")
    assert rows(ds.table("t"), "i", "p") == [(i, "c" if i == 3 else "ab"[i % 2]) for i in range(8)]


@pytest.mark.parametrize("keys", [[year, month], [year, month, day], [year, month, day, hour], [year], [month], [day, hour], [year, day]])
def test_calendar_cover_of_ranges(spark, keys):
    start, n = dt.datetime(2023, 11, 28), 24 * 70
    df = spark.range(n).select(F.expr(f"TIMESTAMP_NTZ '{start}' + make_dt_interval(0, int(id))").alias("ts"))
    layout = [k("ts") for k in keys]
    from tableload.operators.layout import layout_columns
    parted, names = layout_columns(df.union(spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ)")), layout)
    parted = parted.coalesce(1).cache()
    every = [start + dt.timedelta(hours=i) for i in range(n)]
    for lo, hi in [(every[5], every[9]), (dt.datetime(2023, 12, 31, 22), dt.datetime(2024, 1, 1, 3)), (dt.datetime(2024, 1, 31, 5), dt.datetime(2024, 2, 2)),
                   (dt.datetime(2023, 12, 30), None), (None, dt.datetime(2023, 12, 1, 12)), (None, None)]:
        texts = [str(b) if b else None for b in (lo, hi)]
        folders = parted.filter(prune(layout, "ts", T.TimestampNTZType(), *texts)).select("ts", *names)
        want = [t for t in every if (lo is None or t >= lo) and (hi is None or t <= hi)]
        got = {r.ts for r in folders.collect()}
        assert set(want) <= got
        if keys[0] is year and keys != [year, day] and (lo or hi):  # exactly the folders that hold a wanted row
            part = {year: lambda t: t.year, month: lambda t: t.month, day: lambda t: t.day, hour: lambda t: t.hour}
            folder = lambda t: tuple(part[k](t) for k in keys)
            assert {folder(t) for t in got} == {folder(t) for t in want}
    parted.unpersist()


def test_directories_read_for_a_range_over_the_end_of_a_month(spark, dataset_path):
    df = spark.range(90).select("id", F.expr("TIMESTAMP_NTZ '2024-01-01 12:00:00' + make_dt_interval(int(id))").alias("ts"))
    load(spark, dataset_path, {"t": df}, [TableContract("t", "append", partition=[year("ts"), month("ts"), day("ts")])], "L1")
    got = Dataset(spark, dataset_path).table("t", with_file=True, where=lambda keys: prune(
        keys, "ts", T.TimestampNTZType(), "2024-01-31 00:00:00", "2024-02-02 23:00:00"))
    assert got.select(F.regexp_extract("__file", "month=[0-9]+/_p_ts_day=[0-9]+", 0).alias("d")).distinct().count() == 3


def test_a_column_of_nulls_takes_the_first_type_it_gets(spark, dataset_path):
    c = TableContract("t", "append")
    load(spark, dataset_path, {"t": spark.sql("SELECT 1 AS id, NULL AS v")}, [c], "L1")
    ds = Dataset(spark, dataset_path)
    assert rows(ds.table("t"), "id", "v") == [(1, None)]
    load(spark, dataset_path, {"t": spark.sql("SELECT 2 AS id, NULL AS v")}, [c], "L2")
    load(spark, dataset_path, {"t": spark.sql("SELECT 3 AS id, 'x' AS v")}, [c], "L3")
    load(spark, dataset_path, {"t": spark.sql("SELECT 4 AS id, NULL AS v, ARRAY() AS xs")}, [c], "L4", max_nesting=1)
    got = ds.table("t")
    assert got.schema["v"].dataType == T.StringType()
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, None), (2, None), (3, "x"), (4, None)]
    m = TableContract("m", "merge", ("id",), partition=[identity("v")])
    load(spark, dataset_path, {"m": spark.sql("SELECT 1 AS id, NULL AS v UNION ALL SELECT 2, NULL")}, [m], "L5")
    load(spark, dataset_path, {"m": spark.sql("SELECT 1 AS id, 7 AS v")}, [m], "L6")
    assert sorted((r.id, r.v) for r in ds.table("m").collect()) == [(1, 7), (2, None)]


def test_a_key_dict_names_no_internal_field():
    with pytest.raises(ValueError):
        PartitionKey.of({"column": "a", "coded": False})
