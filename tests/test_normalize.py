from pyspark.sql import functions as F

from tableload.operators.normalize import align_to_schema, nested_as_json, normalize, one_pass

TRIPS = "id long, boat struct<hull:string>, stops array<struct<pier:string,crew:array<string>>>"


def trips(spark):
    return spark.createDataFrame([(1, {"hull": "oak"}, [{"pier": "N", "crew": ["x", "y"]}, {"pier": "S", "crew": ["z"]}]),
                                  (2, {"hull": "elm"}, [])], TRIPS)


def by_name(tables):
    return {t.name: t for t in tables}


def test_nesting_zero_keeps_json(spark):
    (root,) = normalize(trips(spark), "trips", primary_key=["id"], max_nesting=0)
    got = {r["id"]: r for r in root.frame.collect()}
    assert got[1]["boat"] == '{"hull":"oak"}'
    assert got[2]["stops"] == "[]"


def test_levels_and_links(spark):
    t = by_name(normalize(trips(spark), "trips", primary_key=["id"], max_nesting=2))
    assert set(t) == {"trips", "trips__stops", "trips__stops__crew"}
    assert "boat__hull" in t["trips"].frame.columns
    stops = t["trips__stops"].frame.collect()
    roots = {r["id"]: r["_row_id"] for r in t["trips"].frame.collect()}
    assert sorted((r["pier"], r["_list_idx"]) for r in stops) == [("N", 0), ("S", 1)]
    assert all(r["_parent_id"] == roots[1] and r["_root_id"] == roots[1] for r in stops)
    crew = t["trips__stops__crew"].frame.collect()
    stop_ids = {r["pier"]: r["_row_id"] for r in stops}
    assert sorted((r["value"], r["_parent_id"] == stop_ids["N"]) for r in crew) == [
        ("x", True), ("y", True), ("z", False)]
    assert all(r["_root_id"] == roots[1] for r in crew)


def test_depth_bound_turns_deeper_lists_into_json(spark):
    t = by_name(normalize(trips(spark), "trips", primary_key=["id"], max_nesting=1))
    assert set(t) == {"trips", "trips__stops"}
    assert sorted(r["crew"] for r in t["trips__stops"].frame.collect()) == ['["x","y"]', '["z"]']


def test_ids_are_deterministic(spark):
    a = normalize(trips(spark), "trips", primary_key=["id"], max_nesting=None)
    b = normalize(trips(spark), "trips", primary_key=["id"], max_nesting=None)
    for x, y in zip(a, b):
        assert sorted(x.frame.select("_row_id").collect()) == sorted(y.frame.select("_row_id").collect())


def test_snake_case_naming(spark):
    df = spark.createDataFrame([(1, {"hullType": "x"})], "tripId long, Boat struct<hullType:string>")
    (root,) = normalize(df, "Trips", primary_key=["trip_id"], max_nesting=1, naming="snake_case")
    assert root.name == "trips"
    assert root.frame.columns == ["trip_id", "boat__hull_type", "_row_id"]


def test_align_pads_and_orders(spark):
    target = spark.createDataFrame([], "a long, b string, c double").schema
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    out = align_to_schema(df, target)
    assert out.columns == ["a", "b", "c"]
    assert out.schema["a"].dataType.simpleString() == "bigint"
    assert out.collect()[0]["c"] is None
    same = spark.createDataFrame([(1, "x", 1.0)], target)
    assert align_to_schema(same, target) is same


def test_nested_as_json(spark):
    out = nested_as_json(trips(spark).filter(F.col("id") == 2))
    assert out.collect()[0]["boat"] == '{"hull":"elm"}'


def test_one_pass_gives_the_rows_of_every_table(spark):
    schema = "id long, p struct<n:string>, xs array<struct<s:string,ts:array<string>,q:struct<z:array<int>>>>, us array<string>, e array<void>"
    df = spark.createDataFrame([
        (1, ("a",), [("A", ["x", "y"], ([1, 2],)), ("B", None, None), None], ["u"], []), (2, ("b",), [], None, [None]),
        (3, None, None, ["w", None], None)], schema)
    for depth in (0, 1, 2, 3, None):
        rows, tables = one_pass(df, "t", primary_key=["id"], max_nesting=depth, load_id="L")
        for i, t in enumerate(tables):
            kept = [f.name for f in rows.schema[f"t{i}"].dataType.fields]
            got = rows.filter(f"__t = {i}").select(f"t{i}.*")
            assert sorted(map(repr, got.collect())) == sorted(map(repr, t.frame.select(*kept).collect())), (depth, t.name)
        assert rows.count() == sum(t.frame.count() for t in tables)
