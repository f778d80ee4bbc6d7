"""Layout changes and preflight checks outside a load."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession

from tableload.functions.partition import parse_layout
from tableload.sources.dataset import Dataset, layout_json


def _attempts(seconds: float = 600.0) -> Iterator[int]:
    """Attempts with growing pauses, until a time limit."""
    end, n = time.monotonic() + seconds, 0
    while n == 0 or time.monotonic() < end:
        yield n
        n += 1
        time.sleep(min(5.0, 0.05 * 2**min(n, 10)) * random.uniform(0.5, 1.5))


def set_layout(spark: SparkSession, path: str, table: str, keys: Any) -> bool:
    """Set a table's layout for files written from now on.  ``[]`` resets to
    unpartitioned; an unchanged layout writes no new snapshot (returns False)."""
    ds = Dataset(spark, path)
    for _ in _attempts():
        base = ds.snapshot()
        entry = base.tables[table]
        want = layout_json(parse_layout(keys)) or []
        if (entry.get("layout") or []) == want:
            return False
        new = base.copy()
        new.tables[table]["layout"] = want
        if ds.ledger.commit(base, new):
            return True
    raise RuntimeError("could not commit the layout change")


def preflight(spark: SparkSession, path: str) -> list[str]:
    """V15 re-aimed: problems that would stop a load into ``path`` -- the catalog
    must be listed and the dataset folder writable."""
    problems = []
    try:
        spark.catalog.listCatalogs()
    except Exception as e:  # noqa: BLE001
        problems.append(f"catalogs cannot be listed: {e}")
    ds = Dataset(spark, path)
    probe = f"{ds.path}/_probe-{uuid.uuid4().hex[:8]}"
    try:
        if not ds.ledger.fs.create_exclusive(probe, b"probe"):
            problems.append(f"{path}: probe file already exists")
        ds.ledger.fs.delete(probe)
    except Exception as e:  # noqa: BLE001
        problems.append(f"{path} is not writable: {str(e).splitlines()[0]}")
    return problems


def compact(spark: SparkSession, path: str, table: str, max_records_per_file: int | None = None) -> bool:
    """Rewrite a table's current rows as one segment in the table's layout, as an
    ordinary commit.  Keeps the number of scans a read unions over bounded after
    many loads; readers of older snapshots keep their files until ``vacuum``."""
    from tableload.plans.load import write_segment
    ds = Dataset(spark, path)
    for _ in _attempts():
        base = ds.snapshot()
        entry = base.tables[table]
        if len(entry["segments"]) <= 1 and not any(s.get("removed") for s in entry["segments"]):
            return False
        seg = write_segment(ds, table, ds.table(table, base), entry.get("layout") or [],
                            f"compact-{base.seq + 1}", max_records_per_file)
        new = base.copy()
        new.tables[table]["segments"] = [seg]
        if ds.ledger.commit(base, new):
            return True
    raise RuntimeError("could not commit the compaction")
