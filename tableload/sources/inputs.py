"""Load inputs (S1, S2, S13, S14): Parquet files, Arrow tables or records become
DataFrames; rows can be routed to tables by a function of the row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.errors import ContractError

# Fixed value: the only file format a load accepts.
ACCEPTED_FORMATS = ("parquet",)


def check_format(fmt: str) -> None:
    """Anything but Parquet (e.g. JSONL) is refused before reading."""
    if fmt.lower() not in ACCEPTED_FORMATS:
        raise ContractError(f"file format {fmt!r} is not accepted; write Parquet")


def read_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """One scan over all files of a table; with ``schema`` the files are read
    as that schema (missing columns NULL, int32 read as bigint)."""
    check_format(fmt)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def frame(spark: SparkSession, data: Any, schema: T.StructType | str | None = None) -> DataFrame:
    """Arrow tables, pandas frames and Python records load alike."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, pa.Table):
        return spark.createDataFrame(data, schema)
    if isinstance(data, Iterable) and not isinstance(data, (str, bytes)):
        rows = list(data)
        if rows and isinstance(rows[0], dict) and schema is None:
            return spark.createDataFrame(rows)
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame(data, schema)


def route(df: DataFrame, by: Column | str, staging_path: str | None = None) -> dict[str, DataFrame]:
    """Split rows into tables named by ``by`` (e.g. ``concat('events_', kind)``).

    The input is written once, partitioned by route value, under the shared
    folder (``staging_path`` or a fresh folder under ``spark.checkpoint.dir``); each
    table is then a partition-pruned read of its directory, so routing costs one
    pass however many routes there are.  A route holding a large share of the
    rows is split across writers by the ``rebalance`` hint.  The route names come
    from the directory listing."""
    from urllib.parse import unquote

    from tableload.session import scratch_path
    from tableload.sources.fs import FS
    spark = df.sparkSession
    col = F.expr(by) if isinstance(by, str) else by
    path = staging_path or scratch_path(spark, "route")
    df.withColumn("__route", col).hint("rebalance", "__route").write.partitionBy("__route").parquet(path)
    dirs = [d for d in FS(spark, path).list(path) if d.startswith("__route=")]
    names = [unquote(d.split("=", 1)[1]) for d in dirs]
    if "__HIVE_DEFAULT_PARTITION__" in names:
        raise ContractError("route expression returned NULL for some rows")
    staged = spark.read.schema(df.schema.add("__route", T.StringType())).parquet(path)
    return {n: staged.filter(F.col("__route") == n).drop("__route") for n in sorted(names)}


def dataset_name(base: str, schema_name: str, default_schema: str | None = None) -> str:
    """The default schema loads into ``base``; another source schema into
    ``<base>_<schema>``."""
    if default_schema is None or schema_name == default_schema:
        return base
    return f"{base}_{schema_name}"
