"""A dataset on a Hadoop-compatible path: tables read back through the ledger
(R1-R8, C11, C12)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.errors import TableNotFound
from tableload.functions.partition import PartitionKey
from tableload.operators.layout import CALENDAR, derived_type, prune
from tableload.sources.ledger import Ledger, Snapshot

FILE_COL = "__file"
SEGMENT_COL = "_seg"
BOUNDARY_DIR = "_boundary"  # boundaries of incremental loads, named by the pipelines' states


def uri_path(p: str, encoded: bool = False) -> str:
    path = urlparse(p).path if "://" in p or p.startswith("file:") else p
    return unquote(path) if encoded else path


def keys_of(layout: Iterable[dict]) -> list[PartitionKey]:
    return [PartitionKey(k["column"], k["transform"], k.get("buckets"), _is_coded(k)) for k in layout]


def _is_coded(k: dict) -> bool:
    return k["transform"] in CALENDAR or bool(k.get("coded"))


def layout_json(keys: Iterable[PartitionKey] | None) -> list[dict] | None:
    if keys is None:
        return None
    return [{"column": k.column, "transform": k.transform, **({"buckets": k.buckets} if k.buckets else {}),
             **({} if k.transform in CALENDAR else {"coded": True})}
            for k in keys]


class Dataset:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.ledger = Ledger(spark, self.path)
        self._own: Dataset | None = None

    # ------------------------------------------------------------ catalog
    def snapshot(self) -> Snapshot:
        return self.ledger.snapshot()

    def exists(self) -> bool:
        """C12 ``has_dataset``: absent is False, not an error."""
        return self.ledger.exists()

    def has_table(self, name: str, snapshot: Snapshot | None = None) -> bool:
        return name in (snapshot or self.snapshot()).tables

    def table_names(self) -> list[str]:
        return sorted(self.snapshot().tables)

    # ------------------------------------------------------------ reading
    def table(self, name: str, snapshot: Snapshot | None = None, *, with_file: bool = False,
              keep_layout: bool = False, files: Iterable[str] | None = None,
              where: Callable[[list[PartitionKey]], Column] | None = None) -> DataFrame:
        """The table's current rows (R1).  Each segment is one Parquet scan with the
        table schema supplied, so older segments read with added columns as NULL
        and BIGINT widened to DECIMAL(20,0); derived layout columns are dropped
        unless ``keep_layout``.  ``files`` restricts the read to those data files, and
        ``where`` gives each layout's rows a filter that may use its derived columns."""
        snap = snapshot or self.snapshot()
        if name not in snap.tables:
            raise TableNotFound(f"table {name!r} does not exist in {self.path}")
        entry = snap.tables[name]
        schema = T.StructType.fromJson(entry["schema"])
        only = {uri_path(f) for f in files} if files is not None else None
        groups: dict[str, list[dict]] = {}
        for seg in entry["segments"]:
            groups.setdefault(json.dumps(seg.get("layout") or [], sort_keys=True), []).append(seg)
        frames = []
        for segs in groups.values():
            df = self._scan(segs, schema, only, with_file, keep_layout, where)
            if df is not None:
                frames.append(df)
        if not frames:
            empty = schema
            if with_file:
                empty = T.StructType(schema.fields + [T.StructField(FILE_COL, T.StringType())])
            return self.spark.createDataFrame([], empty)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def _scan(self, segs: list[dict], schema: T.StructType, only: set[str] | None, with_file: bool,
              keep_layout: bool, where=None) -> DataFrame | None:
        """One Parquet scan over all segments sharing a layout: the table folder is
        the base path, the segment id and derived layout columns are partitions."""
        keys = keys_of(segs[0].get("layout") or [])
        derived = {k.derived_name: derived_type(k) for k in keys if k.derived_name != k.column}
        void = {f.name for f in schema.fields if isinstance(f.dataType, T.NullType)}  # in no file
        read_schema = T.StructType([f for f in schema.fields if f.name not in void] + [T.StructField(d, t) for d, t in derived.items()
                                                    if d not in schema.fieldNames()]
                                   + [T.StructField(SEGMENT_COL, T.StringType())])
        base = segs[0]["path"].rsplit("/", 1)[0]
        paths: list[str] = []
        for seg in segs:
            removed = set(seg.get("removed") or [])
            if removed or only is not None:
                files = [f for f in self.ledger.fs.list_files(seg["path"]) if uri_path(f) not in removed]
                if only is not None:
                    files = [f for f in files if uri_path(f) in only]
                paths += files
            else:
                paths.append(seg["path"])
        if not paths:
            return None
        df = self.spark.read.schema(read_schema).option("basePath", base).parquet(*paths)
        if where is not None:
            df = df.filter(where(keys))
        cols = [F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in schema.fieldNames()]
        if keep_layout:
            cols += [F.col(f"`{d}`") for d in derived]
        if with_file:
            cols.append(F.col("_metadata.file_path").alias(FILE_COL))
        return df.select(*cols)

    def layout_groups(self, name: str, snapshot: Snapshot) -> list[tuple[list[PartitionKey], DataFrame]]:
        """For every layout the table's segments were written in: its keys and their rows,
        with the file of each row and the derived columns."""
        entry = snapshot.tables[name]
        schema = T.StructType.fromJson(entry["schema"])
        groups: dict[str, list[dict]] = {}
        for seg in entry["segments"]:
            groups.setdefault(json.dumps(seg.get("layout") or [], sort_keys=True), []).append(seg)
        scans = [(keys_of(segs[0].get("layout") or []), self._scan(segs, schema, None, True, True)) for segs in groups.values()]
        return [(keys, df) for keys, df in scans if df is not None]

    def between(self, name: str, column: str, lo=None, hi=None) -> DataFrame:
        """Rows with ``lo <= column <= hi``, with partition filters derived from the
        layout so Spark skips directories (transforms are not pruned by Catalyst)."""
        snap = self.snapshot()
        if name not in snap.tables:
            raise TableNotFound(f"table {name!r} does not exist in {self.path}")
        dtype = T.StructType.fromJson(snap.tables[name]["schema"])[column].dataType

        def where(keys: list[PartitionKey]) -> Column:
            # a segment is pruned by the layout it was written in
            pred = prune(keys, column, dtype, lo, hi)
            if lo is not None:
                pred = pred & (F.col(f"`{column}`") >= F.lit(lo).cast(dtype))
            if hi is not None:
                pred = pred & (F.col(f"`{column}`") <= F.lit(hi).cast(dtype))
            return pred

        return self.table(name, snap, where=where)

    def register(self, snapshot: Snapshot | None = None) -> list[str]:
        """Temp views for every table in this session, under the tables' names."""
        snap = snapshot or self.snapshot()
        for name in snap.tables:
            self.table(name, snap).createOrReplaceTempView("`" + name.replace("`", "``") + "`")
        return sorted(snap.tables)

    def sql(self, text: str, **kwargs) -> DataFrame:
        """SQL over the tables by unqualified name (R3).  The views live in a session
        of the dataset's own, so datasets with equal table names do not meet."""
        if self._own is None:
            own = self.spark.newSession()
            for key, value in self.spark.conf.getAll.items():
                if own.conf.isModifiable(key):
                    own.conf.set(key, value)
            self._own = Dataset(own, self.path)
        self._own.register()
        return self._own.spark.sql(text, **kwargs)

    # ----------------------------------------------------- bookkeeping
    def loads(self) -> DataFrame:
        """Load receipts (C1): archived and inline, one row per committed load."""
        return self.ledger.history(self.snapshot(), "loads").drop("counts", "tables", "hints")

    def schema_versions(self) -> DataFrame:
        return self.ledger.history(self.snapshot(), "schemas")

    def states(self) -> DataFrame:
        return self.ledger.history(self.snapshot(), "states")

    def _boundaries(self) -> list[dict]:
        """Boundaries that the newest state of a pipeline names (pipelines are few)."""
        from tableload.operators.state import latest_state_per_pipeline
        out = []
        for row in latest_state_per_pipeline(self.states(), self.loads()).select("state").collect():
            try:
                held = json.loads(row["state"])
            except (TypeError, ValueError):
                continue
            out += held.get("boundaries", {}).values() if isinstance(held, dict) else []
        return out

    # ----------------------------------------------------- maintenance
    def drop(self, *, dry_run: bool = True) -> list[str]:
        """C11: delete the whole dataset; only when ``dry_run`` is literally False."""
        if dry_run is not False:
            return [f"dry run: would delete {self.path}"]
        self.ledger.fs.delete(self.path)
        return [f"deleted {self.path}"]

    def vacuum(self, older_than_seconds: float = 7 * 24 * 3600) -> list[str]:
        """Delete what the newest snapshot no longer names and that is older than
        ``older_than_seconds``: segment folders of superseded or lost commits,
        files a merge rewrote, and staging folders of abandoned loads.  The age
        guard protects readers of older snapshots and loads still running."""
        import time as _time
        fs = self.ledger.fs
        cutoff = _time.time() - older_than_seconds
        snap = self.snapshot()
        live = {uri_path(s["path"]) for t in snap.tables.values() for s in t["segments"]}
        gone = []
        for name in fs.list(self.path):
            if name.startswith("_") and name != "_staging":
                continue
            tdir = f"{self.path}/{name}"
            for seg in fs.list(tdir):
                p = f"{tdir}/{seg}"
                if name != "_staging" and uri_path(fs.qualify(p)) in live:
                    continue
                if fs.mtime(p) < cutoff:
                    fs.delete(p)
                    gone.append(p)
        named = {b["path"] for b in self._boundaries()}
        for name in fs.list(f"{self.path}/{BOUNDARY_DIR}"):
            p = f"{self.path}/{BOUNDARY_DIR}/{name}"
            if f"{BOUNDARY_DIR}/{name}" not in named and fs.mtime(p) < cutoff:
                fs.delete(p)
                gone.append(p)
        for t in snap.tables.values():
            for s in t["segments"]:
                for f in s.get("removed") or []:
                    if fs.exists(f) and fs.mtime(f) < cutoff:
                        fs.delete(f)
                        gone.append(f)
        return gone
