import os

from pyspark.sql import functions as F

from tableload.contract import TableContract
from tableload.sources.dataset import Dataset
from tableload.streaming.stream_merge import batch_load_id, checkpoint_id, stream_merge


def test_stream_merge_batches_and_replay(spark, tmp_path):
    src_dir = str(tmp_path / "in")
    lake = str(tmp_path / "lake")
    cp = str(tmp_path / "cp")
    schema = "id long, cur long, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.parquet(f"{src_dir}/f1")
    c = TableContract("items", "merge", ("id",), cursor="cur")
    stream = spark.readStream.schema(schema).parquet(f"{src_dir}/*")
    q = stream_merge(stream, lake, [c], "items", checkpoint=cp)
    q.awaitTermination()
    spark.createDataFrame([(1, 2, "a2"), (2, 0, "stale"), (3, 1, "c")], schema).write.parquet(f"{src_dir}/f2")
    q = stream_merge(spark.readStream.schema(schema).parquet(f"{src_dir}/*"), lake, [c], "items", checkpoint=cp)
    q.awaitTermination()
    ds = Dataset(spark, lake)
    got = sorted((r["id"], r["v"]) for r in ds.table("items").collect())
    assert got == [(1, "a2"), (2, "b"), (3, "c")]
    ids = [r["load_id"] for r in ds.loads().orderBy("load_id").collect()]
    own = checkpoint_id(spark, cp)
    assert ids == [batch_load_id("items", own, 0), batch_load_id("items", own, 1)]
    # a replayed micro-batch (lost checkpoint commit) republishes nothing
    from tableload.plans.load import load
    again = load(spark, lake, {"items": spark.createDataFrame([(9, 9, "x")], schema)}, [c],
                 batch_load_id("items", own, 1))
    assert not again.published
    assert ds.table("items").filter(F.col("id") == 9).count() == 0
    assert os.path.isdir(cp)


def test_new_checkpoint_loses_no_batch(spark, tmp_path):
    schema = "id long, v string"
    lake = str(tmp_path / "lake")
    c = TableContract("seen", "append")
    for n, rows in enumerate([[(1, "a"), (2, "b"), (3, "c")], [(4, "d"), (5, "e"), (6, "f"), (7, "g"), (8, "h")]]):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"in{n}" / "f"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / f"in{n}" / "*"))
        stream_merge(stream, lake, [c], "seen", checkpoint=str(tmp_path / f"cp{n}")).awaitTermination()
    assert sorted(r.id for r in Dataset(spark, lake).table("seen").collect()) == list(range(1, 9))
