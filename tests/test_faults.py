"""Fault injection: failed task attempts, a crash between staging and commit."""

import os
import subprocess
import sys
import textwrap

import pytest

from tableload.contract import TableContract
from tableload.plans import load as L
from tableload.plans.load import load
from tableload.sources.dataset import Dataset

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RETRY_SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, {repo!r})
    from pyspark.sql import SparkSession, functions as F
    from pyspark import TaskContext
    from tableload.session import SESSION_SETTINGS
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.sources.dataset import Dataset
    b = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
    for k, v in SESSION_SETTINGS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    fail = sys.argv[2] == "fail"

    def flaky(batches):
        ctx = TaskContext.get()
        if fail and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        for pdf in batches:
            yield pdf

    src = spark.range(0, 200, numPartitions=4).select(
        F.col("id"), F.array(F.lit("a"), F.col("id").cast("string")).alias("tags"))
    src = src.mapInPandas(flaky, src.schema)
    for name, c in (("keyless", TableContract("keyless", "append")),
                    ("keyed", TableContract("keyed", "merge", ("id",)))):
        load(spark, sys.argv[1] + "/" + name, {{name: src}}, [c], "L1", max_nesting=1)
    out = {{}}
    for name in ("keyless", "keyed"):
        ds = Dataset(spark, sys.argv[1] + "/" + name)
        out[name] = sorted(r[0] + "|" + r[1] for r in ds.table(name + "__tags").select("_row_id", "value").collect())
        out[name + "_roots"] = ds.table(name).count()
    print("RESULT" + json.dumps(out))
""")


def _run(path, mode):
    script = RETRY_SCRIPT.format(repo=REPO)
    res = subprocess.run([sys.executable, "-c", script, path, mode], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in res.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, res.stderr[-3000:]
    import json
    return json.loads(lines[-1][len("RESULT"):])


def test_task_retries_keep_ids_stable(tmp_path):
    clean = _run(str(tmp_path / "clean"), "ok")
    retried = _run(str(tmp_path / "retried"), "fail")
    assert clean["keyed_roots"] == retried["keyed_roots"] == 200
    assert clean["keyless_roots"] == retried["keyless_roots"] == 200
    assert clean["keyed"] == retried["keyed"]
    assert len(retried["keyless"]) == 400


def test_crash_before_commit_resumes_without_restaging(spark, dataset_path, monkeypatch):
    c = TableContract("deals", "merge", ("id",))
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "id long, items array<string>")

    def crash(self, base, new):
        raise RuntimeError("driver lost before the commit")

    monkeypatch.setattr(type(Dataset(spark, dataset_path).ledger), "commit", crash)
    with pytest.raises(RuntimeError):
        load(spark, dataset_path, {"deals": df}, [c], "L1", max_nesting=1)
    monkeypatch.undo()
    assert not Dataset(spark, dataset_path).exists()  # nothing visible
    staged = []
    real_stage_write = L.stage

    def spy(ds, load_id, table, frames):
        before = [ds.ledger.fs.exists(p) for p in [f"{ds.path}/_staging/{load_id}/{table}"]]
        staged.append(before[0])
        return real_stage_write(ds, load_id, table, frames)

    monkeypatch.setattr(L, "stage", spy)
    assert load(spark, dataset_path, {"deals": df}, [c], "L1", max_nesting=1).published
    assert staged == [True]  # the staging of the crashed attempt was found and reused
    ds = Dataset(spark, dataset_path)
    assert ds.table("deals").count() == 2 and ds.table("deals__items").count() == 3
    assert not load(spark, dataset_path, {"deals": df}, [c], "L1", max_nesting=1).published
