import datetime
import random
from collections import Counter
from decimal import Decimal

import pyarrow as pa
import pytest

from tableload.contract import TableContract
from tableload.sources.dataset import Dataset
from tableload.streaming.newest import KEY, ORDER, _newest_of_batches, stream_merge_newest

SCHEMA = "id long, cur timestamp, n int, price decimal(12,2), v string"


def at(day):
    return None if day is None else datetime.datetime(2024, 1, day)


def run(spark, tmp_path, batches, contract, schema=SCHEMA, name="in", **options):
    """Every batch arrives while the query is down: it is started again from its checkpoint for each."""
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(str(tmp_path / name))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / name))
        stream_merge_newest(stream, str(tmp_path / "lake"), contract, name, checkpoint=str(tmp_path / f"cp-{name}"),
                            **options).awaitTermination()
    return Dataset(spark, str(tmp_path / "lake"))


def folded(batches):
    """The same by plain Python: newest of a batch, then against what is stored; NULL is lowest and ties lose."""
    stored = {}
    def order(row):
        return [(x is not None, x if x is not None else 0) for x in row[1:]]
    for rows in batches:
        for key in {r[0] for r in rows}:
            row = max((r for r in rows if r[0] == key), key=order)
            if key not in stored or order(row)[0] > order(stored[key])[0]:
                stored[key] = row
    return Counter(r for r in stored.values() if r[0] is not None)


def test_late_stale_tied_and_repeated_rows_over_restarts(spark, tmp_path):
    rng = random.Random(3)
    batches = [[(rng.choice([1, 1, 1, *range(30)]), at(rng.choice([None, *range(1, 9)])), rng.choice([None, -3, 2, 40]),
                 rng.choice([None, Decimal("-1.50"), Decimal("10.00"), Decimal("9.25")]), rng.choice([None, "", "a", "b"]))
                for _ in range(200)] for _ in range(3)]
    batches[1] += batches[0]  # replayed by the source
    ds = run(spark, tmp_path, batches, TableContract("t", "merge", ("id",), cursor="cur", tie_break=("n", "price", "v")))
    got = Counter((r.id, r.cur, r.n, r.price, r.v) for r in ds.table("t").collect())
    assert got == folded(batches)
    assert ds.loads().count() == 3


def test_a_batch_of_stale_rows_writes_nothing(spark, tmp_path):
    first = [(1, at(5), 1, None, "a"), (2, at(5), 1, None, "a")]
    ds = run(spark, tmp_path, [first, [(1, at(4), 2, None, "old"), (2, at(5), 2, None, "tie"), (2, None, 2, None, "null")]],
             TableContract("t", "merge", ("id",), cursor="cur"))
    assert {(r.id, r.v, r._load_id[-1]) for r in ds.table("t").collect()} == {(1, "a", "0"), (2, "a", "0")}


def test_a_new_checkpoint_takes_its_state_from_the_target(spark, tmp_path):
    c = TableContract("t", "merge", ("id",), cursor="cur")
    ds = run(spark, tmp_path, [[(1, at(5), 1, None, "a"), (2, at(5), 1, None, "a")]], c)
    ds = run(spark, tmp_path, [[(1, at(4), 2, None, "old"), (2, at(6), 2, None, "new"), (3, None, 2, None, "first")]], c, name="again",
             known=ds.table("t"))
    assert {(r.id, r.v) for r in ds.table("t").collect()} == {(1, "a"), (2, "new"), (3, "first")}


def test_arrow_batches_pass_on_one_row_of_a_key():
    batch = pa.record_batch({KEY: ["b", "a", "b", "c", "b"], ORDER: ["1", "1", "3", "9", "2"], "v": [1, 2, 3, 4, 5]})
    single, empty = batch.slice(0, 1), batch.slice(0, 0)
    out = [b.to_pydict()["v"] for b in _newest_of_batches(iter([batch, single, empty]))]
    assert out == [[2, 3, 4], [1], []]


@pytest.mark.parametrize("contract", [TableContract("t", "append"), TableContract("t", "merge", ("id",))])
def test_needs_a_merge_with_a_cursor(spark, tmp_path, contract):
    with pytest.raises(ValueError):
        stream_merge_newest(spark.range(1).toDF("id"), str(tmp_path), contract, "q")
