"""One load = validate -> stage -> normalize -> merge -> write -> one commit.

* Validation of every contract happens before any Spark action (U15).
* Each input frame is staged once under ``<dataset>/_staging/<load_id>/`` in
  overwrite mode; a resumed load finds the ``_SUCCESS`` marker and skips it (S8),
  and nothing is published unless every staged frame is complete (S9).  Everything
  after staging reads the staged Parquet, so lineage is cut there and row ids
  derived from file name and row index are stable across task retries.
* Append and replace write one new segment per table.  Merge is copy-on-write:
  only data files holding a staged key are read, merged and rewritten; every
  other file stays in place (7.3 of the survey).  The touched-file list is the
  only thing collected, and it is bounded by the number of files.
* All tables, the receipt, schema version and state land in one ledger commit;
  re-running a committed load id is a no-op (C2).
"""

from __future__ import annotations

import copy
import hashlib
import json
import random
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.contract import TableContract, is_staged_route, validate
from tableload.errors import ContractError, DuplicateRootError, IncompleteStagingError
from tableload.functions.lineage import LINEAGE, ROOT_ID, ROW_ID, key_id
from tableload.functions.naming import normalize_name
from tableload.functions.partition import parse_layout
from tableload.functions.types import promote, widen
from tableload.operators import merge as M
from tableload.operators.layout import key_expr, layout_columns
from tableload.operators.normalize import TAG, NormalizedTable, align_to_schema, normalize, one_pass
from tableload.plans.refresh import children_of
from tableload.sources.dataset import FILE_COL, SEGMENT_COL, Dataset, keys_of, layout_json, uri_path
from tableload.sources.ledger import Snapshot, now

ENGINE_VERSION = 1
# A load that keeps losing the commit race gives up after so long.
COMMIT_SECONDS = 3600.0
# Fixed value: the recommended data file size.
TARGET_FILE_BYTES = 128 * 1024 * 1024
# Write position of staged merge rows: input frame, staged file, row in file.
ORDER_COLS = ("__w_frame", "__w_file", "__w_row")
# Parts of a pipeline's state that hold one entry a table, under its name in the dataset.
PER_TABLE = ("cursors", "boundaries")
# Types of a directly written row's place: load id, frame, task partition, row.
ROW_AT = (T.StringType(), T.IntegerType(), T.IntegerType(), T.LongType())


@dataclass
class Receipt:
    load_id: str
    published: bool
    counts: dict[str, int] = field(default_factory=dict)
    tables: list[str] = field(default_factory=list)


# ------------------------------------------------------------------ schema
def evolve(stored: T.StructType | None, incoming: T.StructType) -> T.StructType:
    """Keep stored columns (widened where lossless), append new ones in
    incoming order; nothing is dropped or narrowed."""
    if stored is None:
        return T.StructType([T.StructField(f.name, promote(f.dataType), True, f.metadata) for f in incoming.fields])
    fields = []
    inc = {f.name.casefold(): f for f in incoming.fields}
    for f in stored.fields:
        other = inc.get(f.name.casefold())
        dt = promote(widen(f.dataType, other.dataType, f"column {f.name}: ")) if other is not None else f.dataType
        meta = dict(f.metadata)
        if other is not None and other.metadata.get("comment"):
            meta["comment"] = other.metadata["comment"]
        fields.append(T.StructField(f.name, dt, True, meta))
    known = {f.name.casefold() for f in stored.fields}
    fields += [T.StructField(f.name, promote(f.dataType), True, f.metadata)
               for f in incoming.fields if f.name.casefold() not in known]
    return T.StructType(fields)


def _declared(df: DataFrame, contract: TableContract) -> DataFrame:
    """Cast the root frame to the contract's declared column types."""
    declared = contract.declared_schema()
    if declared is None:
        return df
    return align_to_schema(df, declared)


def schema_hash(tables: dict[str, Any]) -> str:
    text = json.dumps({n: t["schema"] for n, t in sorted(tables.items())}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


# ----------------------------------------------------------------- staging
def _frames_of(value: DataFrame | Sequence[DataFrame]) -> list[DataFrame]:
    return [value] if isinstance(value, DataFrame) else list(value)


def stage(ds: Dataset, load_id: str, table: str, frames: Sequence[DataFrame]) -> list[str]:
    """Write each input frame of ``table`` to its own staging folder, once.  Staged folders are counted
    from their footers (``_staged_rows``)."""
    base = f"{ds.path}/_staging/{_safe(load_id)}/{table}"
    paths = []
    for i, df in enumerate(frames):
        path = f"{base}/{hashlib.sha256(f'{table}/{i}'.encode()).hexdigest()[:32]}"
        if not ds.ledger.fs.exists(f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        paths.append(path)
    return paths


def require_complete(ds: Dataset, paths: Sequence[str]) -> None:
    missing = [p for p in paths if not ds.ledger.fs.exists(f"{p}/_SUCCESS")]
    if missing:
        raise IncompleteStagingError(f"staged frames are not whole, nothing was published: {missing}")


def _safe(load_id: str) -> str:
    return "".join(ch if ch.isalnum() or ch in "-_." else "_" for ch in load_id)


# --------------------------------------------------------------- writing
def write_segment(ds: Dataset, table: str, df: DataFrame, layout, load_id: str,
                  max_records_per_file: int | None = None) -> dict:
    """Write ``df`` as a new segment of ``table`` (partitioned by the layout's
    derived columns); return its ledger entry."""
    keys = [replace(k, coded=True) for k in keys_of(layout or [])]
    # Parquet has no type for a column of NULLs only: it stays in the schema and out of the files
    out, parts = layout_columns(df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]), keys)
    # segments are ``_seg=<id>`` folders, so every segment of one layout is a
    # partition of a single scan rooted at the table folder
    path = ds.ledger.fs.qualify(f"{ds.path}/{table}/{SEGMENT_COL}={_safe(load_id)}-{uuid.uuid4().hex[:8]}")
    if parts:
        # cluster rows by partition value so each directory gets few files; the
        # rebalance hint lets AQE split a value that holds a large share of the rows
        out = out.hint("rebalance", *parts)
    # counted in the write's last stage, whose tasks count once however often they run
    counted = Observation()
    writer = out.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("errorifexists")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    return {"path": path, "layout": layout_json(keys) or [], "removed": [], "rows": int(counted.get.get("n", 0))}


# ------------------------------------------------------------------- load
def load(
    spark: SparkSession,
    path: str,
    frames: dict[str, DataFrame | Sequence[DataFrame]],
    contracts: Sequence[TableContract],
    load_id: str,
    *,
    schema_name: str = "default",
    max_nesting: int | None = 0,
    naming: str = "direct",
    refresh: str | None = None,
    allow_destructive: Any = None,
    state: dict[str, Any] | None = None,
    max_records_per_file: int | None = None,
    target_file_bytes: int | None = TARGET_FILE_BYTES,
) -> Receipt:
    """Load ``frames`` (root table name -> DataFrame or list of DataFrames, one per
    input file) into the dataset at ``path`` under ``load_id``.

    Output files are capped near ``target_file_bytes`` (S11): rows per file come
    from the staged Parquet's bytes per root row, unless ``max_records_per_file``
    is given."""
    ds = Dataset(spark, path)
    # declared types apply to the raw frame, so they keep the frame's original names
    declared = {normalize_name(c.name, naming): c for c in contracts if c.parent is None}
    if naming != "direct":
        contracts = [rename_contract(c, naming) for c in contracts]
        frames = {normalize_name(k, naming): v for k, v in frames.items()}
    roots = {c.name: c for c in contracts if c.parent is None}
    unknown = set(frames) - set(roots)
    if unknown:
        raise ContractError(f"frames without a contract: {sorted(unknown)}")
    if refresh is not None:  # the opt-in guard runs before anything else (C10)
        validate([], allow_destructive=allow_destructive, refresh=refresh)

    base = ds.snapshot()
    done = ds.ledger.receipt(base, load_id)
    if done is not None:
        return Receipt(load_id, False, done.get("counts", {}), done.get("tables", []))

    # plan normalization on the union of all frames' schemas, then validate the full
    # chains before any write
    raw_schemas = {name: _frames_schema(spark, name, _frames_of(v)) for name, v in frames.items() if _frames_of(v)}
    chain_contracts: list[TableContract] = []
    direct: set[str] = set()
    padded: dict[str, T.StructType | None] = {}
    keyed: dict[str, T.StructType] = {}  # root columns of merges, as their frames bring them
    for name, root in roots.items():
        chain_contracts.append(root)
        if name not in raw_schemas:
            continue
        probe_df = spark.createDataFrame([], raw_schemas[name])
        tables = normalize(probe_df, name, primary_key=root.primary_key, max_nesting=max_nesting,
                           naming=naming, load_id=load_id)
        chain_contracts += [TableContract(t.name, root.disposition, parent=t.parent) for t in tables[1:]]
        if root.disposition in ("append", "replace") and len(tables) == 1:
            direct.add(name)  # no ids link tables: write the segment straight from the input
        # a flat merge keeps absent columns absent; everywhere else they are NULL, so that
        # every frame has the same chain of tables
        flat = root.disposition == "merge" and not is_staged_route(root, len(tables))
        padded[name] = None if flat else raw_schemas[name]
        if root.disposition == "merge":
            typed = normalize(_declared(probe_df, declared[name]), name, primary_key=root.primary_key,
                              max_nesting=max_nesting, naming=naming, load_id=load_id)
            keyed[name] = typed[0].frame.schema
    validate(chain_contracts, allow_destructive=allow_destructive, refresh=refresh)

    staged_paths: dict[str, list[str]] = {}
    for name, value in frames.items():
        if name in direct:
            continue
        fr = _frames_of(value)
        staged_paths[name] = stage(ds, load_id, name, [_declared(f, declared[name]) for f in fr])
    require_complete(ds, [p for ps in staged_paths.values() for p in ps])

    def prepare(base: Snapshot) -> _Prepared:
        """The tables' new content, written next to ``base``'s."""
        new = base.copy()
        out = _Prepared(base, new)
        if refresh in ("drop_data", "drop_resources"):
            out.cleared = _apply_refresh(new, refresh, [c.name for c in contracts if c.parent is None])
        for name, root in sorted(roots.items()):
            if name in direct:
                tables = [_direct(f, declared[name], root, load_id, naming, name, max_nesting, i)
                          for i, f in enumerate(_frames_of(frames[name]))]
                if not tables:
                    continue
                write = _append if root.disposition == "append" else _replace
                tname = tables[0][0].name
                cap = max_records_per_file or _direct_records(base.tables.get(tname), target_file_bytes)
                segs = write(ds, new, root, tables, load_id, cap)
                out.counts[tname] = sum(seg["rows"] for seg in segs)
                for seg in segs:
                    seg["bytes"] = ds.ledger.fs.size(seg["path"])
                if cap is None and target_file_bytes:
                    _split_large(ds, new, tname, segs, load_id, target_file_bytes)
                out.tables.append(tname)
                out.hints[tname] = _hints(root, tables[0][0], root.disposition)
                continue
            paths = staged_paths.get(name, [])
            if not paths:
                continue
            types = _key_types(base, root, keyed[name]) if name in keyed else {}
            inputs = [_staged_input(spark, p, root, load_id, max_nesting, naming, name, i, padded[name], types)
                      for i, p in enumerate(paths)]
            chain = normalize(inputs[0][0], **inputs[0][1])
            chain_names = [t.name for t in chain]
            if len(chain) > 1:
                tables, table_counts = _chain_tables(ds, load_id, f"chain-{base.seq + 1}", name, inputs)
                staged_files = [tables]
            else:
                staged_files = [normalize(raw, **options) for raw, options in inputs]
                table_counts = {name: sum(_staged_rows(ds, p) for p in paths)}
            out.counts.update(table_counts)
            mrpf = max_records_per_file or _records_per_file(ds, paths, table_counts[name], target_file_bytes)
            for i, tname in enumerate(chain_names):
                out.tables.append(tname)
                out.hints[tname] = _hints(root if i == 0 else None, staged_files[0][i], root.disposition)
            if root.disposition == "append":
                _append(ds, new, root, staged_files, load_id, mrpf)
            elif root.disposition == "replace":
                _replace(ds, new, root, staged_files, load_id, mrpf)
            else:
                _merge(ds, spark, base, new, root, staged_files, load_id, mrpf)
        return out

    deadline, pause, done_work = time.monotonic() + COMMIT_SECONDS, 0.05, None
    while True:
        base = ds.snapshot()
        done = ds.ledger.receipt(base, load_id)
        if done is not None:
            return Receipt(load_id, False, done.get("counts", {}), done.get("tables", []))
        if done_work is None or not done_work.holds(base):
            done_work = prepare(base)
        new = done_work.onto(base)
        if refresh == "drop_resources":
            ds.ledger.forget_schemas(new, done_work.cleared)
        version_hash = schema_hash(new.tables)
        if not ds.ledger.has_schema(new, version_hash):
            new.versions[schema_name] = new.versions.get(schema_name, 0) + 1
            new.schemas.append({"version_hash": version_hash, "schema_name": schema_name,
                                "version": new.versions[schema_name],
                                "engine_version": ENGINE_VERSION, "inserted_at": now(),
                                "schema": json.dumps({n: t["schema"] for n, t in new.tables.items()})})
        _write_states(ds, base, new, done_work.cleared, state, load_id)
        new.loads.append({"load_id": load_id, "schema_name": schema_name, "status": 0, "inserted_at": now(),
                          "schema_version_hash": version_hash, "counts": done_work.counts,
                          "tables": done_work.tables, "hints": done_work.hints})
        if ds.ledger.commit(base, new):
            ds.ledger.fs.delete(f"{ds.path}/_staging/{_safe(load_id)}")
            return Receipt(load_id, True, done_work.counts, done_work.tables)
        if time.monotonic() > deadline:
            raise RuntimeError(f"load {load_id}: other writers kept committing first for {COMMIT_SECONDS:.0f} s")
        time.sleep(pause * random.uniform(0.5, 1.5))
        pause = min(5.0, 2 * pause)


@dataclass
class _Prepared:
    """Tables written by a load but not committed yet, and the snapshot they came from."""

    base: Snapshot
    new: Snapshot
    counts: dict[str, int] = field(default_factory=dict)
    tables: list[str] = field(default_factory=list)
    hints: dict[str, dict] = field(default_factory=dict)
    cleared: list[str] = field(default_factory=list)

    def _changed(self) -> set[str]:
        names = set(self.base.tables) | set(self.new.tables)
        return {n for n in names if self.base.tables.get(n) != self.new.tables.get(n)} | set(self.tables) | set(self.cleared)

    def holds(self, base: Snapshot) -> bool:
        """Whether no table the load touched has changed since; then the work stands."""
        return all(base.tables.get(n) == self.base.tables.get(n) for n in self._changed())

    def onto(self, base: Snapshot) -> Snapshot:
        out = base.copy()
        for name in self._changed():
            out.tables.pop(name, None)
            if name in self.new.tables:
                out.tables[name] = copy.deepcopy(self.new.tables[name])
        return out


def _frames_schema(spark: SparkSession, name: str, frames: Sequence[DataFrame]) -> T.StructType:
    """All columns (and struct fields) that any frame of the table has."""
    union = spark.createDataFrame([], frames[0].schema)
    for f in frames[1:]:
        try:
            union = union.unionByName(spark.createDataFrame([], f.schema), allowMissingColumns=True)
        except AnalysisException as e:
            raise ContractError(f"{name}: the frames of one load do not fit together: {str(e).splitlines()[0]}") from None
    return union.schema


def _direct(df: DataFrame, declared: TableContract, root: TableContract, load_id: str, naming: str,
            name: str, max_nesting: int | None, frame: int) -> list[NormalizedTable]:
    """A flat append/replace input normalized without staging.  Its row ids only
    need to be unique: (load id, frame, task partition, row position) -- a retried task
    rewrites its whole file, so ids inside the committed files stay consistent."""
    rid = key_id([F.lit(load_id), F.lit(frame), F.spark_partition_id(), F.monotonically_increasing_id()], ROW_AT)
    return normalize(_declared(df, declared), name, max_nesting=max_nesting, naming=naming, load_id=load_id,
                     row_id=rid)


def _direct_records(entry: dict | None, target: int | None) -> int | None:
    """Rows per file from the bytes per row of the table's last measured segment (None
    while nothing of the table is measured)."""
    measured = [s for s in (entry or {}).get("segments", []) if s.get("rows") and s.get("bytes")]
    if not target or not measured:
        return None
    return max(1, int(target * measured[-1]["rows"] / measured[-1]["bytes"]))


def _split_large(ds: Dataset, new: Snapshot, table: str, segs: list[dict], load_id: str, target: int) -> None:
    """Write segments anew whose files are far above the target, now that their bytes
    per row are known; later loads of the table are capped from the start."""
    schema = new.schema_of(table)
    for s in segs:
        files = ds.ledger.fs.list_files(s["path"])
        if not s["rows"] or s["bytes"] <= 2 * target * len(files):
            continue
        cap = max(1, int(target * s["rows"] / s["bytes"]))
        again = write_segment(ds, table, ds._scan([s], schema, None, False, False), s["layout"], load_id, cap)
        ds.ledger.fs.delete(s["path"])
        s.update(again, bytes=ds.ledger.fs.size(again["path"]))


def _records_per_file(ds: Dataset, paths: Sequence[str], rows: int, target: int | None) -> int | None:
    """Rows per output file so that files land near ``target`` bytes, estimated
    from the staged Parquet (same format and compression as the output).  Child
    rows are narrower than roots, so their files stay at or under the target."""
    if not target or rows <= 0:
        return None
    staged_bytes = sum(ds.ledger.fs.size(p) for p in paths)
    if staged_bytes <= 0:
        return None
    return max(1, int(target * rows / staged_bytes))


def _staged_rows(ds: Dataset, path: str) -> int:
    """Rows of a staged frame, from its Parquet footers."""
    files = ds.ledger.fs.list_files(path)
    return ds.spark.read.parquet(*files).count() if files else 0


def _chain_tables(ds: Dataset, load_id: str, name: str, root: str, inputs: list[tuple[DataFrame, dict]]) -> tuple[list[NormalizedTable], dict[str, int]]:
    """The tables of a chain, written in one job that reads the staged frames once, each
    table under a folder of its own; the row counts (V12) are observed on that write."""
    passes = [one_pass(raw, **options) for raw, options in inputs]
    tables = passes[0][1]
    rows = M.union_staged([p[0] for p in passes])
    path = f"{ds.path}/_staging/{_safe(load_id)}/{root}/_work/{name}"
    counted = Observation()
    rows.observe(counted, *[F.count_if(F.col(TAG) == i).alias(f"n{i}") for i in range(len(tables))]) \
        .write.mode("overwrite").partitionBy(TAG).parquet(path)
    counts = {t.name: int(counted.get.get(f"n{i}", 0)) for i, t in enumerate(tables)}
    out = []
    for i, t in enumerate(tables):
        schema = t.frame.schema
        if counts[t.name]:
            stored = rows.schema[f"t{i}"]
            frame = ds.spark.read.schema(T.StructType([stored])).parquet(f"{path}/{TAG}={i}")
            frame = frame.select(*[F.col(f"t{i}")[f.name].alias(f.name) if f.name in stored.dataType.names else F.lit(None).alias(f.name)
                                   for f in schema.fields])
        else:
            frame = ds.spark.createDataFrame([], schema)
        out.append(NormalizedTable(t.name, t.parent, frame, t.path))
    return out, counts


def rename_contract(c: TableContract, naming: str) -> TableContract:
    """Table, key, cursor, flag and layout column names follow the naming
    convention of the data."""
    n = lambda x: normalize_name(x, naming) if x else x
    part = c.partition
    if part:
        part = [replace(k, column=n(k.column)) for k in parse_layout(part)]
    hard = tuple(n(h) for h in c.hard_delete) if isinstance(c.hard_delete, tuple) else n(c.hard_delete)
    return replace(c, name=n(c.name), primary_key=tuple(n(k) for k in c.primary_key), cursor=n(c.cursor),
                   tie_break=tuple(n(k) for k in c.tie_break), hard_delete=hard, parent=n(c.parent),
                   partition=part, columns={n(k): v for k, v in c.columns.items()})


def _hints(root: TableContract | None, t: NormalizedTable, disposition: str) -> dict:
    if root is None:
        return {"disposition": disposition, "parent": t.parent, "primary_key": [], "row_key": [ROW_ID]}
    return {"disposition": disposition, "parent": None, "primary_key": list(root.primary_key),
            "cursor": root.cursor, "hard_delete": root.hard_delete_column,
            "skip_unchanged": root.skip_unchanged, "source_filter": root.source_filter}


def _apply_refresh(new: Snapshot, mode: str, names: Sequence[str]) -> list[str]:
    parents = {n: t.get("parent") for n, t in new.tables.items()}
    affected = children_of([n for n in names if n in new.tables], parents)
    for n in affected:
        if mode == "drop_data":
            new.tables[n]["segments"] = []
        else:
            del new.tables[n]
    return affected


def _write_states(ds: Dataset, base: Snapshot, new: Snapshot, cleared: Sequence[str], state: dict | None,
                  load_id: str) -> None:
    """At most one new state per pipeline and load, on top of its newest committed
    one.  Cursors and boundaries of cleared tables go from every pipeline's state; ``state`` is
    stored as given, except that its cursors and boundaries join the other tables'."""
    newest: dict[str, Any] = {}
    if (cleared or state) and (base.states or base.archives.get("states")):
        from tableload.operators.state import latest_state_per_pipeline
        rows = latest_state_per_pipeline(ds.ledger.history(base, "states"), ds.ledger.history(base, "loads")).collect()
        newest = {r["pipeline_name"]: r for r in rows}  # pipelines are few
    wanted: dict[str, tuple[int, Any, str]] = {}
    for name, row in newest.items():
        held = _json_or_none(row["state"])
        kept = {k: held[k] for k in PER_TABLE if isinstance(held.get(k), dict)} if isinstance(held, dict) else {}
        if any(t in v for v in kept.values() for t in cleared):
            held = held | {k: {t: x for t, x in v.items() if t not in cleared} for k, v in kept.items()}
            wanted[name] = (row["version"] + 1, held, "")
    if state is not None:
        name, value = state["pipeline_name"], state.get("state")
        if isinstance(value, dict) and "cursors" in value:
            held = wanted[name][1] if name in wanted else _json_or_none(newest[name]["state"]) if name in newest else None
            before = held if isinstance(held, dict) else {}
            value = value | {k: before.get(k, {}) | value[k] for k in PER_TABLE if k in value}
        wanted[name] = (state.get("version", 1), value, state.get("version_hash", ""))
    for name, (version, value, version_hash) in wanted.items():
        new.states.append({"version": version, "engine_version": ENGINE_VERSION, "pipeline_name": name,
                           "state": json.dumps(value), "created_at": now(), "version_hash": version_hash,
                           "_load_id": load_id})


def _json_or_none(text: str | None) -> Any:
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return None


def _staged_input(spark: SparkSession, path: str, root: TableContract, load_id: str,
                 max_nesting: int | None, naming: str, name: str, seq: int = 0,
                 pad: T.StructType | None = None, key_types: dict[str, T.DataType] | None = None) -> tuple[DataFrame, dict]:
    """One staged frame and the arguments it is normalized with.  Keyless roots get ids from (load id, file name,
    row index) of the staged Parquet, stable across retries.  The keys of merge roots are
    cast to the types the table stores, before any id is made.  Merge roots carry
    their write position (input frame, file, row) so that among duplicates with
    equal cursors the last written row wins."""
    at = [F.col("_metadata.file_name").alias(ORDER_COLS[1]), F.col("_metadata.row_index").alias(ORDER_COLS[2])]
    raw = spark.read.parquet(path).select("*", *at)
    if pad is not None:  # columns and struct fields only other frames have, as NULL
        whole = T.StructType(pad.fields + raw.schema.fields[-2:])
        raw = spark.createDataFrame([], whole).unionByName(raw, allowMissingColumns=True)
    keyed = root.disposition == "merge"  # append/replace ignore key hints for row ids
    file, row = F.col(ORDER_COLS[1]), F.col(ORDER_COLS[2])
    rid = None if keyed else key_id([F.lit(load_id), file, row], [T.StringType(), T.StringType(), T.LongType()])
    extra = dict(zip(ORDER_COLS, (F.lit(seq), file, row), strict=True)) if keyed else None
    return raw, {"table": name, "primary_key": root.primary_key if keyed else (), "max_nesting": max_nesting,
                 "naming": naming, "load_id": load_id, "row_id": rid, "extra": extra, "hidden": ORDER_COLS, "types": key_types}


def _key_types(base: Snapshot, root: TableContract, incoming: T.StructType) -> dict[str, T.DataType]:
    """Types that key, cursor and tie-break columns of a merge have in the table after this load."""
    names = {*root.primary_key, *root.tie_break, *([root.cursor] if root.cursor else [])}
    stored = base.schema_of(root.name)
    evolved = evolve(stored, T.StructType([f for f in incoming.fields if f.name in names]))
    return {f.name: f.dataType for f in evolved.fields if f.name in names and not isinstance(f.dataType, T.NullType)}


def with_comments(schema: T.StructType, contract: TableContract | None) -> T.StructType:
    """E5: column descriptions of the contract become ``comment`` metadata; a
    column without a description keeps the comment it had."""
    if contract is None:
        return schema
    fields = []
    for f in schema.fields:
        text = contract.columns.get(f.name, {}).get("description")
        meta = dict(f.metadata)
        if text is not None:
            meta["comment"] = text
        fields.append(T.StructField(f.name, f.dataType, f.nullable, meta))
    return T.StructType(fields)


def _entry(new: Snapshot, name: str, schema: T.StructType, layout, parent: str | None,
           contract: TableContract | None) -> dict:
    schema = with_comments(schema, contract)
    entry = new.tables.get(name)
    if entry is None:
        entry = {"schema": schema.jsonValue(), "layout": [], "segments": [], "parent": parent}
        new.tables[name] = entry
    entry["schema"] = schema.jsonValue()
    if layout is not None:
        entry["layout"] = layout_json(parse_layout(layout))
    if contract is not None and contract.description is not None:
        entry["description"] = contract.description
    return entry


def _union(files: list[list[NormalizedTable]], i: int) -> DataFrame:
    return M.union_staged([f[i].frame for f in files])


def _append(ds, new, root, files, load_id, mrpf) -> list[dict]:
    segs = []
    for i, t in enumerate(files[0]):
        df = _union(files, i)
        stored = new.schema_of(t.name)
        schema = evolve(stored, df.schema)
        entry = _entry(new, t.name, schema, root.partition if i == 0 else None, t.parent, root if i == 0 else None)
        seg = write_segment(ds, t.name, align_to_schema(df, schema), entry["layout"], load_id, mrpf)
        entry["segments"].append(seg)
        segs.append(seg)
    return segs


def _replace(ds, new, root, files, load_id, mrpf) -> list[dict]:
    staged = {t.name for t in files[0]}
    for name in _descendants(new, root.name):
        if name not in staged:  # a child table with nothing staged is replaced by nothing
            new.tables[name]["segments"] = []
    segs = []
    for i, t in enumerate(files[0]):
        df = _union(files, i)
        schema = evolve(None, df.schema)
        new.tables.pop(t.name, None)
        entry = _entry(new, t.name, schema, [], t.parent, root if i == 0 else None)
        seg = write_segment(ds, t.name, align_to_schema(df, schema), [], load_id, mrpf)
        entry["segments"] = [seg]
        segs.append(seg)
    return segs


def _touched(ds: Dataset, snap: Snapshot, table: str, keys: DataFrame, on: list[str],
             key_cols: list[str] | None = None) -> list[str]:
    """Data files of ``table`` holding any of ``keys`` (semi join on the key columns
    plus the file path; only distinct paths reach the driver).  Segments laid out by
    ``bucket(n, key)`` also join on the bucket, their partition column."""
    if table not in snap.tables:
        return []
    cols = key_cols or on
    keys = keys.select(*[F.col(o).alias(c) for o, c in zip(on, cols, strict=True)])
    within = _key_range(keys)
    hits = []
    for layout, stored in ds.layout_groups(table, snap):
        stored = stored.filter(within)
        buckets = [k for k in layout if k.transform == "bucket" and k.column in cols and k.coded]
        wanted = keys.select(*cols, *[key_expr(k, keys.schema[k.column].dataType).alias(k.derived_name) for k in buckets])
        names = cols + [k.derived_name for k in buckets]
        hits.append(stored.select(*names, FILE_COL).join(wanted, names, "left_semi").select(FILE_COL))
    if not hits:
        return []
    return sorted({uri_path(r[0], encoded=True) for r in M.union_staged(hits).distinct().collect()})


# Key types whose statistics in the Parquet files show where a key can be.
_RANGED = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.StringType)


def _key_range(keys: DataFrame) -> Column:
    """``key BETWEEN min AND max`` of every column of the staged keys (one small aggregate).
    Pushed into the Parquet scan, it lets row groups and files whose key statistics miss
    the range be skipped -- large savings when keys follow write order.  Ids of the library are
    digests, spread over all files, and have no useful range."""
    ranged = [f.name for f in keys.schema.fields if isinstance(f.dataType, _RANGED) and f.name not in LINEAGE]
    if not ranged:
        return F.lit(True)
    carry = {c: _carried(keys.schema[c].dataType) for c in ranged}
    bounds = keys.agg(*[carry[c][0](f(F.col(f"`{c}`"))).alias(f"{n}_{i}") for i, c in enumerate(ranged)
                        for n, f in (("lo", F.min), ("hi", F.max))]).first()
    within = F.lit(True)
    for i, c in enumerate(ranged):
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        if lo is None:  # a NULL key meets nothing
            return F.lit(False)
        within = within & F.col(f"`{c}`").between(carry[c][1](F.lit(lo)), carry[c][1](F.lit(hi)))
    return within


def _carried(dtype: T.DataType) -> tuple:
    """How a bound passes through the driver and back: times as numbers or text, as Python's
    are bound to years 1 to 9999 and to the driver's time zone."""
    if isinstance(dtype, T.DateType):
        return F.unix_date, F.date_from_unix_date
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros, F.timestamp_micros
    if isinstance(dtype, T.TimestampNTZType):
        return (lambda c: c.cast("string")), (lambda c: c.cast(dtype))
    return (lambda c: c), (lambda c: c.cast(dtype))


def _remove_files(ds: Dataset, entry: dict, files: Sequence[str]) -> None:
    """Note the rewritten files; a segment of which none is left goes."""
    gone = set(files)
    left = []
    for seg in entry["segments"]:
        root = uri_path(seg["path"])
        mine = [f for f in gone if f.startswith(root.rstrip("/") + "/")]
        if mine:
            seg["removed"] = sorted(set(seg.get("removed") or []) | set(mine))
            rest = [f for f in ds.ledger.fs.list_files(seg["path"]) if uri_path(f, encoded=True) not in seg["removed"]]
            if not rest or ds.spark.read.parquet(*rest).isEmpty():  # writers leave empty files too
                continue
        left.append(seg)
    entry["segments"] = left


def _merge(ds: Dataset, spark: SparkSession, base: Snapshot, new: Snapshot, root: TableContract,
           files: list[list[NormalizedTable]], load_id: str, mrpf) -> None:
    chain = files[0]
    pk = list(root.primary_key)
    # the chain is the schema's: stored child tables this load has no rows for still
    # lose the children of replaced and deleted roots
    extra = [n for n in _descendants(base, root.name) if n not in {t.name for t in chain}]
    staged_route = is_staged_route(root, len(chain) + len(extra))
    # staged root rows: one relation (staged route) or per-file column groups (flat)
    if staged_route:
        s_root = _union(files, 0)
        # a chain takes one row per key: the guard's job fails otherwise
        s_root = _latest(s_root, pk, root) if len(chain) + len(extra) == 1 else s_root
        groups = [s_root.drop(*ORDER_COLS)]
    else:
        groups = _column_groups([f[0].frame for f in files])
        groups = [_latest(g, pk, root).drop(*ORDER_COLS) for g in groups]
    # dedup keeps the key set, so touched files come from the raw staged keys
    all_keys = M.union_staged([f[0].frame.select(*pk) for f in files])
    stored_schema = base.schema_of(root.name)
    touched = _touched(ds, base, root.name, all_keys, pk)
    if stored_schema is not None:
        t_root = ds.table(root.name, base, files=touched) if touched else _empty(spark, stored_schema)
    else:
        t_root = None
    incoming = groups[0].schema
    for g in groups[1:]:
        incoming = evolve(incoming, g.schema)
    schema = evolve(stored_schema, incoming)
    t_cur = align_to_schema(t_root, schema) if t_root is not None else _empty(spark, schema)
    passing = up = live = None
    if staged_route:
        if len(chain) + len(extra) > 1:
            _require_unique(root.name, groups[0], pk)
        live = M.drop_stale(groups[0], t_cur, pk, root.cursor) if root.cursor else groups[0]
        # written once where rows were dropped: the upsert, the child replacement and the touched-file
        # search all read it, instead of re-running dedup and the stale filter per consumer.  All roots of
        # a chain are on disk already
        if root.cursor or len(chain) == 1:
            live = _materialize(ds, spark, load_id, root.name, f"live-{base.seq + 1}", live)
        passing, up = M.surviving_roots(live, root)
        t_cur = M.merge_root(t_cur, live, root)
    elif len(groups) == 1:
        live = M.drop_stale(groups[0], t_cur, pk, root.cursor) if root.cursor else groups[0]
        live = _materialize(ds, spark, load_id, root.name, f"live-{base.seq + 1}", live)
        t_cur = M.upsert(t_cur, align_to_schema(live, _sub(schema, live.columns)), pk, partial=True)
    else:
        folded = M.fold_groups(groups, t_cur, pk, schema, root.cursor)
        t_cur = M.upsert_folded(t_cur, _materialize(ds, spark, load_id, root.name, f"live-{base.seq + 1}", folded), pk)
    t_cur = align_to_schema(t_cur, schema)
    entry = _entry(new, root.name, schema, root.partition, None, root)
    seg = write_segment(ds, root.name, t_cur, entry["layout"], load_id, mrpf)
    _remove_files(ds, entry, touched)
    entry["segments"].append(seg)
    # children: replaced for every passing root, by root id
    children = [(t.name, t.parent, _union(files, i)) for i, t in enumerate(chain[1:], start=1)]
    children += [(n, base.tables[n].get("parent"), spark.createDataFrame([], base.schema_of(n))) for n in extra]
    for name, parent, s_child in children:
        c_schema = evolve(base.schema_of(name), s_child.schema)
        c_touched = _touched(ds, base, name, passing.select(F.col(ROW_ID).alias(ROOT_ID)), [ROOT_ID])
        t_child = ds.table(name, base, files=c_touched) if c_touched else _empty(spark, c_schema)
        come = (None, passing, None) if M.keeps_all_roots(root) else (passing, passing, up)
        merged = M.merge_child(align_to_schema(t_child, c_schema), align_to_schema(s_child, c_schema), *come)
        c_entry = _entry(new, name, c_schema, _child_layout(entry, new.tables.get(name)), parent, None)
        c_seg = write_segment(ds, name, align_to_schema(merged, c_schema), c_entry["layout"], load_id, mrpf)
        _remove_files(ds, c_entry, c_touched)
        c_entry["segments"].append(c_seg)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, which the optimizer knows: joins with them vanish from the plan, and with them their shuffles."""
    return spark.createDataFrame([], schema).limit(0)


def _require_unique(table: str, roots: DataFrame, pk: list[str]) -> None:
    """Runs the guard over the keys alone; no row is written or shuffled for it."""
    try:
        M.unique_keys(roots.select(*pk), pk).write.format("noop").mode("overwrite").save()
    except Exception as e:
        if M.DUPLICATE_KEY in str(e):
            raise DuplicateRootError(f"{table}: {M.DUPLICATE_KEY}; a table with children takes one row per key") from None
        raise


def _latest(df: DataFrame, pk: list[str], root: TableContract) -> DataFrame:
    """Highest cursor per key; ties (or no cursor) go to the last written row."""
    return M.dedup_latest(df, pk, root.cursor, list(root.tie_break) + list(ORDER_COLS))


def _descendants(snap: Snapshot, root: str) -> list[str]:
    parents = {n: t.get("parent") for n, t in snap.tables.items()}
    return [n for n in children_of([root], parents) if n != root]


def _materialize(ds: Dataset, spark: SparkSession, load_id: str, table: str, name: str,
                 df: DataFrame) -> DataFrame:
    """Write an intermediate result under the load's staging folder (shared
    storage) and read it back: a lineage cut that survives executor loss."""
    path = f"{ds.path}/_staging/{_safe(load_id)}/{table}/_work/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _child_layout(root_entry: dict, child_entry: dict | None):
    """Children of a root bucketed on its key are bucketed on ``_root_id`` with the
    same count, so replacing a root's children rewrites few child files and the
    touched-file search prunes to the staged roots' buckets.  An explicit child
    layout is kept."""
    if child_entry is not None and child_entry.get("layout"):
        return None
    buckets = [k["buckets"] for k in root_entry.get("layout") or [] if k["transform"] == "bucket"]
    if not buckets:
        return None
    return [{"column": ROOT_ID, "transform": "bucket", "buckets": buckets[0]}]


def _sub(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    keep = set(names)
    return T.StructType([f for f in schema.fields if f.name in keep])


def _column_groups(frames: list[DataFrame]) -> list[DataFrame]:
    """Flat merges apply files with different column sets one after another, in
    file order; consecutive files with the same columns are unioned."""
    groups: list[DataFrame] = []
    cols: list[tuple[str, ...]] = []
    for f in frames:
        key = tuple(sorted(f.columns))
        if cols and cols[-1] == key:
            groups[-1] = groups[-1].unionByName(f)
        else:
            groups.append(f)
            cols.append(key)
    return groups
