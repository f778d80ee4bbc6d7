import pytest
from pyspark.sql import types as T

from tableload.contract import DISPOSITIONS, REFUSED_STRATEGIES, TableContract, validate
from tableload.errors import ContractError, DestructiveRefreshRefused
from tableload.functions.naming import check_collisions, normalize_name
from tableload.functions.partition import bucket, parse_layout, year
from tableload.functions.types import UINT64_DECIMAL, logical_type, widen


SENSOR = {"station": {"data_type": "bigint"}, "reading": {"data_type": "double"}, "gone": {"data_type": "bool"}}


def sensor(**changes):
    """A merge contract that is valid but for ``changes``."""
    columns = SENSOR | changes.pop("columns", {})
    return TableContract("sensors", **({"disposition": "merge", "primary_key": ("station",), "columns": columns} | changes))


# rule -> contracts that break it and nothing else
BROKEN = {
    "an upsert has a key": [sensor(primary_key=())],
    "key columns are never null": [sensor(columns={"station": {"data_type": "text", "nullable": True}})],
    "upsert is the only strategy": [sensor(strategy=s) for s in REFUSED_STRATEGIES],
    "keys are primary keys": [sensor(merge_key=("reading",))],
    "newest first": [sensor(cursor="reading", cursor_order="asc")],
    "one tombstone column": [sensor(hard_delete=("gone", "reading"))],
    "decimals have at most 38 digits": [sensor(columns={"sum": {"data_type": "decimal", "precision": p}}) for p in (39, 76)],
    "no 256-bit integers": [sensor(disposition=d, columns={"sum": {"data_type": "wei"}}) for d in DISPOSITIONS],
    "filters and skipping need the staged route": [sensor(source_filter="reading > 0"), sensor(skip_unchanged=True)],
    "names differ by more than case": [sensor(columns={"Station": {"data_type": "text"}})],
    "dispositions are known": [sensor(disposition="upsert")],
}


@pytest.mark.parametrize("rule,contract", [(rule, c) for rule, broken in BROKEN.items() for c in broken])
def test_each_broken_rule_stops_the_load(rule, contract):
    with pytest.raises(ContractError):
        validate([contract])


def test_the_unchanged_contract_is_valid():
    validate([sensor()])


def test_one_bad_table_stops_all():
    good = TableContract("ok", "append")
    with pytest.raises(ContractError):
        validate([good, sensor(strategy="cdc")])


def test_filter_and_skip_allowed_with_hard_delete_or_children():
    validate([sensor(hard_delete="gone", source_filter="reading > 0", skip_unchanged=True)])
    validate([sensor(source_filter="reading > 0"), TableContract("sensors__notes", "merge", parent="sensors")])


def test_destructive_refresh_needs_literal_true():
    for flag in (None, False, 1, "true"):
        with pytest.raises(DestructiveRefreshRefused):
            validate([], allow_destructive=flag, refresh="drop_data")
    validate([], allow_destructive=True, refresh="drop_resources")


def test_logical_types():
    assert logical_type("text") == T.StringType()
    assert logical_type("bigint") == T.LongType()
    assert logical_type({"data_type": "bigint", "unsigned": True}) == UINT64_DECIMAL
    assert logical_type("decimal") == T.DecimalType(38, 9)
    assert logical_type({"data_type": "decimal", "precision": 12}) == T.DecimalType(12, 0)
    assert logical_type({"data_type": "decimal", "precision": 12, "scale": 3}) == T.DecimalType(12, 3)
    assert logical_type({"data_type": "timestamp", "timezone": False}) == T.TimestampNTZType()
    assert logical_type({"data_type": "timestamp", "timezone": False, "precision": 9}) == T.LongType()
    assert logical_type("timestamp") == T.TimestampType()
    assert logical_type("json") == T.StringType()
    assert logical_type("binary") == T.BinaryType()
    for bad in ({"data_type": "decimal", "precision": 0}, {"data_type": "decimal", "precision": 5, "scale": 6},
                "wei"):
        with pytest.raises(ContractError):
            logical_type(bad)


def test_columns_widen_or_refuse_but_never_lose_values():
    assert widen(T.LongType(), UINT64_DECIMAL) == UINT64_DECIMAL
    assert widen(T.StringType(), T.LongType()) == T.StringType()
    assert widen(UINT64_DECIMAL, T.LongType()) == UINT64_DECIMAL
    assert widen(T.DecimalType(12, 3), T.DecimalType(10, 2)) == T.DecimalType(12, 3)
    assert widen(T.TimestampType(), T.DateType()) == T.TimestampType()
    lossy = [(T.LongType(), T.DoubleType()), (T.DecimalType(12, 2), T.DecimalType(10, 3)), (T.DateType(), T.TimestampType()),
             (T.LongType(), T.StringType()), (T.DoubleType(), T.LongType()), (T.BooleanType(), T.LongType())]
    for stored, incoming in lossy:
        with pytest.raises(ContractError):
            widen(stored, incoming)


def test_naming():
    assert normalize_name("eventTime", "snake_case") == "event_time"
    assert normalize_name("Deals", "snake_case") == "deals"
    assert normalize_name('event"time') == "event_time"
    assert normalize_name("with space") == "with space"
    with pytest.raises(ContractError):
        check_collisions(["Id", "id"])


def test_layout_parsing():
    keys = parse_layout(["category", year("event time"), {"column": "event time", "transform": "month"},
                         bucket(8, "category")])
    assert [k.transform for k in keys] == ["identity", "year", "month", "bucket"]
    assert parse_layout([]) == []


@pytest.mark.parametrize("bad", [
    {"column": ""},
    [{"column": "a\x00b"}],
    [{"column": "c", "transform": "truncate"}],
    [{"column": "c", "transform": "bucket"}],
    [{"column": "c", "transform": "bucket", "buckets": 0}],
    [{"column": "c", "transform": "bucket", "buckets": 2**31}],
    [{"column": "c", "transform": "bucket", "buckets": True}],
    [{"column": "c", "buckets": 4}],
    [{"column": "c", "name": "custom"}],
    ["c", "c"],
    42,
])
def test_invalid_layouts(bad):
    with pytest.raises(ContractError):
        parse_layout(bad)


def test_layout_rules_against_contract():
    cols = {"ts": {"data_type": "timestamp"}, "d": {"data_type": "date"}, "c": {"data_type": "text"}}
    ok = TableContract("e", "append", columns=cols, partition=[year("ts"), {"column": "d", "transform": "day"}])
    validate([ok])
    for part in ([{"column": "d", "transform": "hour"}], [year("c")], ["missing"]):
        with pytest.raises(ContractError):
            validate([TableContract("e", "append", columns=cols, partition=part)])
    with pytest.raises(ContractError):
        validate([TableContract("e", "replace", columns=cols, partition=["c"])])
    with pytest.raises(ContractError):
        validate([TableContract("e", "append", columns=cols, sort=("c",))])
