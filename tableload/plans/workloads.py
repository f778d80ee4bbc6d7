"""Workloads over the driver tables: one DataFrame plan per operator, each paired
with DuckDB SQL that computes the same result independently.

Every workload reads whole tables.  Target and staged sides of a merge are
derived from the same table through data attributes (order priority, status,
market segment ...), so the work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableload.operators import merge as M


@dataclass(frozen=True)
class Workload:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Workload] = {}


def workload(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Workload(name, fn, sql)
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _days(col: str, n: int):
    return F.col(col) + F.expr(f"INTERVAL {n} DAYS") if n else F.col(col)


# ----------------------------------------------------------------- merge family
def orders_partial_staged(orders: DataFrame) -> DataFrame:
    """Partial-column staged orders: two versions of urgent orders, newer versions
    of high ones, ties for medium, older ones for unspecified, new keys for F."""
    def v(cond, days, bump, key=F.col("o_orderkey")):
        return orders.filter(cond).select(
            key.alias("o_orderkey"), _days("o_orderdate", days).alias("o_orderdate"),
            (F.col("o_totalprice") + bump).alias("o_totalprice"))
    p = F.col("o_orderpriority")
    return (v(p.isin("1-URGENT", "2-HIGH"), 1, 100)
            .unionByName(v(p == "1-URGENT", 2, 200))
            .unionByName(v(p == "3-MEDIUM", 0, 300))
            .unionByName(v(p == "4-NOT SPECIFIED", -1, 400))
            .unionByName(v(F.col("o_orderstatus") == "F", 0, 0, -F.col("o_orderkey") - 1)))


ORDERS_PARTIAL_STAGED_SQL = """
  SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS o_orderdate, o_totalprice + 100 AS o_totalprice
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL 2 DAY, o_totalprice + 200
    FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice + 300
    FROM orders WHERE o_orderpriority = '3-MEDIUM'
  UNION ALL SELECT o_orderkey, o_orderdate - INTERVAL 1 DAY, o_totalprice + 400
    FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
  UNION ALL SELECT -o_orderkey - 1, o_orderdate, o_totalprice + 0
    FROM orders WHERE o_orderstatus = 'F'
"""


@workload("upsert_cursor_partial", f"""
WITH s AS ({ORDERS_PARTIAL_STAGED_SQL}),
d AS (SELECT * FROM s QUALIFY row_number() OVER (
        PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST) = 1),
live AS (SELECT * FROM d WHERE NOT EXISTS (
        SELECT 1 FROM orders t WHERE t.o_orderkey = d.o_orderkey
        AND NOT coalesce(d.o_orderdate > t.o_orderdate
                         OR (t.o_orderdate IS NULL AND d.o_orderdate IS NOT NULL), false)))
SELECT t.* FROM orders t ANTI JOIN live l ON t.o_orderkey = l.o_orderkey
UNION ALL
SELECT l.o_orderkey, t.o_custkey, t.o_orderstatus, l.o_totalprice, l.o_orderdate, t.o_orderpriority
FROM live l LEFT JOIN orders t ON t.o_orderkey = l.o_orderkey
""")
def upsert_cursor_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat merge (U2 U4 U5): latest staged version per key, stale versions
    dropped, only the staged columns overwrite the stored row."""
    orders = read(spark, sf_dir, "orders")
    staged = M.dedup_latest(orders_partial_staged(orders), "o_orderkey", "o_orderdate")
    live = M.drop_stale(staged, orders, "o_orderkey", "o_orderdate")
    return M.upsert(orders, live, "o_orderkey", partial=True)


@workload("upsert_full_record", """
WITH s AS (
  SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 1000 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, 'NEW'
    FROM customer WHERE c_mktsegment = 'HOUSEHOLD')
SELECT t.* FROM customer t ANTI JOIN s ON s.c_custkey = t.c_custkey
UNION ALL SELECT * FROM s
""")
def upsert_full_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-record upsert (U5): matched customers replaced, new keys inserted."""
    c = read(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    staged = c.filter(seg.isin("BUILDING", "MACHINERY")).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") + 1000).alias("c_acctbal"), "c_mktsegment",
    ).unionByName(c.filter(seg == "HOUSEHOLD").select(
        (-F.col("c_custkey") - 1).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal",
        F.lit("NEW").alias("c_mktsegment")))
    return M.upsert(c, staged, "c_custkey")


@workload("dedup_latest", """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""")
def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user (U2) with an explicit tie-break."""
    return M.dedup_latest(read(spark, sf_dir, "events"), "user_id", "ts", ["event_id"])


LINEITEM_VALUE_ORDER = ", ".join(
    f"{c} DESC NULLS LAST" for c in
    "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
)


@workload("dedup_composite_key", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC NULLS LAST, {LINEITEM_VALUE_ORDER}) = 1
""")
def dedup_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per composite key (U2 U11); exact cursor ties resolved by the row values."""
    return M.dedup_latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@workload("upsert_composite_key", f"""
WITH t AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC NULLS LAST, {LINEITEM_VALUE_ORDER}) = 1),
s0 AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate + INTERVAL 1 DAY AS l_shipdate
    FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber + 100, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
s AS (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC NULLS LAST, {LINEITEM_VALUE_ORDER}) = 1),
live AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey
         AND t.l_linenumber = s.l_linenumber
         AND NOT coalesce(s.l_shipdate > t.l_shipdate OR (t.l_shipdate IS NULL AND s.l_shipdate IS NOT NULL), false)))
SELECT t.* FROM t ANTI JOIN live l ON t.l_orderkey = l.l_orderkey AND t.l_linenumber = l.l_linenumber
UNION ALL SELECT * FROM live
""")
def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor upsert on a two-column key (U11): newer returns replace, new line numbers insert."""
    li = read(spark, sf_dir, "lineitem")
    pk = ["l_orderkey", "l_linenumber"]
    target = M.dedup_latest(li, pk, "l_shipdate")
    bumped = li.filter(F.col("l_returnflag") == "R").withColumn(
        "l_quantity", F.col("l_quantity") + 1).withColumn("l_shipdate", _days("l_shipdate", 1))
    added = li.filter((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).withColumn(
        "l_linenumber", F.col("l_linenumber") + 100)
    staged = M.dedup_latest(bumped.unionByName(added), pk, "l_shipdate")
    live = M.drop_stale(staged, target, pk, "l_shipdate")
    return M.upsert(target, live, pk, partial=True)


STALE_T = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS o_orderdate
             FROM orders"""
STALE_S = """SELECT o_orderkey,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
            WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY
            WHEN o_orderstatus = 'O' THEN o_orderdate
            ELSE o_orderdate - INTERVAL 1 DAY END AS o_orderdate, o_totalprice FROM orders
  UNION ALL SELECT -o_orderkey - 1, NULL, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'"""


@workload("drop_stale_truth_table", f"""
WITH t AS ({STALE_T}), s AS ({STALE_S})
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey
  AND NOT coalesce(s.o_orderdate > t.o_orderdate OR (t.o_orderdate IS NULL AND s.o_orderdate IS NOT NULL), false))
""")
def drop_stale_truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the stale test (U4): newer, tie, older, NULL on either side, unknown key."""
    o = read(spark, sf_dir, "orders")
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    target = o.select("o_orderkey", F.when(prio == "5-LOW", None).otherwise(F.col("o_orderdate")).alias("o_orderdate"))
    cur = (F.when(prio == "2-HIGH", None)
           .when(status == "F", _days("o_orderdate", 1))
           .when(status == "O", F.col("o_orderdate"))
           .otherwise(_days("o_orderdate", -1)))
    staged = o.select("o_orderkey", cur.alias("o_orderdate"), "o_totalprice").unionByName(
        o.filter(prio == "1-URGENT").select((-F.col("o_orderkey") - 1).alias("o_orderkey"),
                                            F.lit(None).cast("timestamp_ntz").alias("o_orderdate"), "o_totalprice"))
    return M.drop_stale(staged, target, "o_orderkey", "o_orderdate")


@workload("hard_delete_bool", """
WITH t AS (SELECT *, false AS deleted FROM orders),
s AS (SELECT *, o_orderpriority IN ('1-URGENT', '2-HIGH') AS deleted FROM orders WHERE o_orderstatus = 'F'
      UNION ALL
      SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             o_orderpriority = '5-LOW' FROM orders WHERE o_orderstatus = 'O')
SELECT t.* FROM t ANTI JOIN s ON s.o_orderkey = t.o_orderkey
UNION ALL SELECT * FROM s WHERE NOT coalesce(deleted, false)
""")
def hard_delete_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean tombstones (U6): TRUE deletes, tombstones for unknown keys leave nothing."""
    o = read(spark, sf_dir, "orders")
    target = o.withColumn("deleted", F.lit(False))
    prio = F.col("o_orderpriority")
    staged = o.filter(F.col("o_orderstatus") == "F").withColumn(
        "deleted", prio.isin("1-URGENT", "2-HIGH")).unionByName(
        o.filter(F.col("o_orderstatus") == "O").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
        .withColumn("deleted", prio == "5-LOW"))
    return M.upsert(target, staged, "o_orderkey", deleted="deleted")


@workload("hard_delete_timestamp", """
WITH t AS (SELECT *, CAST(NULL AS TIMESTAMP) AS deleted_at FROM orders),
s AS (SELECT *, CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderdate END AS deleted_at
        FROM orders WHERE o_orderstatus = 'P'
      UNION ALL
      SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderdate END
        FROM orders WHERE o_orderstatus = 'O')
SELECT t.* FROM t ANTI JOIN s ON s.o_orderkey = t.o_orderkey
UNION ALL SELECT * FROM s WHERE deleted_at IS NULL
""")
def hard_delete_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-boolean tombstone (U6): NOT NULL deletes; staged single-table route."""
    from tableload.contract import TableContract
    o = read(spark, sf_dir, "orders")
    target = o.withColumn("deleted_at", F.lit(None).cast("timestamp_ntz"))
    prio = F.col("o_orderpriority")
    staged = o.filter(F.col("o_orderstatus") == "P").withColumn(
        "deleted_at", F.when(prio == "3-MEDIUM", F.col("o_orderdate"))).unionByName(
        o.filter(F.col("o_orderstatus") == "O").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
        .withColumn("deleted_at", F.when(prio == "4-NOT SPECIFIED", F.col("o_orderdate"))))
    contract = TableContract("orders", "merge", ("o_orderkey",), hard_delete="deleted_at")
    return M.merge_chain({"orders": target}, {"orders": staged}, [contract])["orders"]


@workload("source_filter_merge", """
WITH t AS (SELECT *, false AS deleted FROM customer),
s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 10 AS c_acctbal, c_mktsegment, c_acctbal < 0 AS deleted
        FROM customer
      UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment, false
        FROM customer WHERE c_mktsegment = 'FURNITURE'),
p AS (SELECT * FROM s WHERE c_mktsegment IN ('BUILDING', 'FURNITURE'))
SELECT t.* FROM t ANTI JOIN p ON t.c_custkey = p.c_custkey
UNION ALL SELECT * FROM p WHERE NOT coalesce(deleted, false)
""")
def source_filter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered merge (P13): rows failing the filter neither insert, update nor delete."""
    from tableload.contract import TableContract
    c = read(spark, sf_dir, "customer")
    target = c.withColumn("deleted", F.lit(False))
    staged = c.select("c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 10).alias("c_acctbal"),
                      "c_mktsegment", (F.col("c_acctbal") < 0).alias("deleted")).unionByName(
        c.filter(F.col("c_mktsegment") == "FURNITURE").select(
            (-F.col("c_custkey") - 1).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal",
            "c_mktsegment", F.lit(False).alias("deleted")))
    contract = TableContract("customer", "merge", ("c_custkey",), hard_delete="deleted",
                             source_filter="c_mktsegment IN ('BUILDING', 'FURNITURE')")
    return M.merge_chain({"customer": target}, {"customer": staged}, [contract])["customer"]


@workload("skip_unchanged", """
WITH t AS (SELECT *, false AS deleted, 'load-1' AS _load_id FROM supplier),
s AS (SELECT s_suppkey, s_name, s_nationkey,
             CASE WHEN s_acctbal > 5000 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal,
             false AS deleted, 'load-2' AS _load_id FROM supplier)
SELECT s.s_suppkey, s.s_name, s.s_nationkey, s.s_acctbal, s.deleted,
       CASE WHEN s.s_name IS NOT DISTINCT FROM t.s_name AND s.s_nationkey IS NOT DISTINCT FROM t.s_nationkey
             AND s.s_acctbal IS NOT DISTINCT FROM t.s_acctbal THEN t._load_id ELSE s._load_id END AS _load_id
FROM s JOIN t ON s.s_suppkey = t.s_suppkey
""")
def skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchanged rows keep their stored load id."""
    from tableload.contract import TableContract
    s0 = read(spark, sf_dir, "supplier")
    target = s0.withColumn("deleted", F.lit(False)).withColumn("_load_id", F.lit("load-1"))
    staged = s0.withColumn("s_acctbal", F.when(F.col("s_acctbal") > 5000, F.col("s_acctbal") + 1)
                           .otherwise(F.col("s_acctbal"))).withColumn(
        "deleted", F.lit(False)).withColumn("_load_id", F.lit("load-2"))
    contract = TableContract("supplier", "merge", ("s_suppkey",), hard_delete="deleted", skip_unchanged=True)
    return M.merge_chain({"supplier": target}, {"supplier": staged}, [contract])["supplier"]


@workload("unique_root_guard", """
SELECT count(*) AS n_rows, count(DISTINCT {'k1': l_orderkey, 'k2': l_linenumber}) AS n_keys FROM lineitem
""")
def unique_root_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness guard of nested upserts (U3) on a key the data does not keep unique."""
    return M.key_guard(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@workload("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offending keys behind a failed guard."""
    return M.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------- normalization
def _rid(expr: str) -> str:
    return f"md5({expr})"


def _kid(*exprs: str) -> str:
    """SQL of a keyed root's id from integer keys that are not negative."""
    return _rid(" || ".join(f"'1p' || lpad(CAST(length(CAST({e} AS VARCHAR)) AS VARCHAR), 2, '0') || CAST({e} AS VARCHAR)" for e in exprs))


def _kid_text(*exprs: str) -> str:
    """SQL of a keyed root's id from text keys."""
    return _rid(" || ".join(f"'1' || hex({e}) || ' '" for e in exprs))


def _kid_time(micros: str, *exprs: str) -> str:
    """SQL of a keyed root's id from a time after 1970 (in microseconds) and integer keys."""
    return _kid(f"({micros})", *exprs)


def _docs_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.struct("lang", "source").alias("meta"), F.split("text", "\n", -1).alias("lines"))


@workload("nested_json_default", f"""
SELECT doc_id, to_json({{'lang': lang, 'source': source}}) AS meta,
       to_json(string_split(text, chr(10))) AS lines, {_kid("doc_id")} AS _row_id
FROM documents
""")
def nested_json_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nesting off (P2): struct and list columns stored as JSON text in the parent."""
    from tableload.operators.normalize import normalize
    return normalize(_docs_nested(spark, sf_dir), "documents", primary_key=["doc_id"], max_nesting=0)[0].frame


@workload("nested_children", f"""
WITH r AS (SELECT {_kid("conv_id", "turn")} AS rid,
                  string_split(text, chr(10)) AS arr FROM conversations),
e AS (SELECT rid, unnest(arr) AS value, unnest(range(len(arr))) AS i FROM r)
SELECT value, {_rid("concat_ws('|', rid, 'conversations__lines', CAST(i AS VARCHAR))")} AS _row_id,
       rid AS _parent_id, rid AS _root_id, i AS _list_idx FROM e
""")
def nested_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List -> child table (P4 P6): one row per element, scalar in ``value``,
    position in ``_list_idx``, deterministic ids linking back to the root."""
    from tableload.operators.normalize import normalize
    c = read(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.split("text", "\n", -1).alias("lines"))
    return normalize(c, "conversations", primary_key=["conv_id", "turn"], max_nesting=1)[1].frame


@workload("nested_two_levels", f"""
WITH d AS (SELECT {_kid("doc_id")} AS rid, string_split(text, chr(10)) AS arr FROM documents),
l AS (SELECT rid, unnest(arr) AS line, unnest(range(len(arr))) AS i FROM d),
l2 AS (SELECT rid, {_rid("concat_ws('|', rid, 'documents__lines', CAST(i AS VARCHAR))")} AS lid,
              string_split(line, ' ') AS words FROM l),
w AS (SELECT rid, lid, unnest(words) AS value, unnest(range(len(words))) AS j FROM l2)
SELECT value, {_rid("concat_ws('|', lid, 'documents__lines__words', CAST(j AS VARCHAR))")} AS _row_id,
       lid AS _parent_id, rid AS _root_id, j AS _list_idx FROM w
""")
def nested_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two list levels (P3-P5): documents -> lines -> words; the grandchild table
    links to its line (parent) and its document (root)."""
    from tableload.operators.normalize import normalize
    d = read(spark, sf_dir, "documents").select(
        "doc_id", F.transform(F.split("text", "\n", -1),
                              lambda l: F.struct(l.alias("text"), F.split(l, " ", -1).alias("words"))).alias("lines"))
    return normalize(d, "documents", primary_key=["doc_id"], max_nesting=2)[2].frame


@workload("nested_lines_table", f"""
WITH d AS (SELECT {_kid("doc_id")} AS rid, string_split(text, chr(10)) AS arr FROM documents),
l AS (SELECT rid, unnest(arr) AS line, unnest(range(len(arr))) AS i FROM d)
SELECT line AS text, to_json(string_split(line, ' ')) AS words,
       {_rid("concat_ws('|', rid, 'documents__lines', CAST(i AS VARCHAR))")} AS _row_id,
       rid AS _parent_id, rid AS _root_id, i AS _list_idx FROM l
""")
def nested_lines_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth bound (P5): with ``max_nesting=1`` the line table keeps its word list as JSON."""
    from tableload.operators.normalize import normalize
    d = read(spark, sf_dir, "documents").select(
        "doc_id", F.transform(F.split("text", "\n", -1),
                              lambda l: F.struct(l.alias("text"), F.split(l, " ", -1).alias("words"))).alias("lines"))
    return normalize(d, "documents", primary_key=["doc_id"], max_nesting=1)[1].frame


@workload("nested_embedding_children", f"""
WITH r AS (SELECT {_kid("vec_id")} AS rid, embedding FROM embeddings),
e AS (SELECT rid, unnest(embedding) AS value, unnest(range(len(embedding))) AS i FROM r)
SELECT value, {_rid("concat_ws('|', rid, 'embeddings__embedding', CAST(i AS VARCHAR))")} AS _row_id,
       rid AS _parent_id, rid AS _root_id, i AS _list_idx FROM e
""")
def nested_embedding_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric list column -> child table of floats."""
    from tableload.operators.normalize import normalize
    return normalize(read(spark, sf_dir, "embeddings"), "embeddings", primary_key=["vec_id"],
                     max_nesting=1)[1].frame


@workload("flatten_struct_snake_case", f"""
SELECT event_id, ts AS event_time, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props__k,
       {_kid("event_id")} AS _row_id
FROM events
""")
def flatten_struct_snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struct -> ``parent__child`` columns (P3) with ``snake_case`` naming."""
    from tableload.operators.normalize import normalize
    e = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("eventId"), F.col("ts").alias("eventTime"), F.col("user_id").alias("userId"),
        F.col("event_type").alias("EventType"), "value", F.from_json("props", "k BIGINT").alias("Props"))
    return normalize(e, "Events", primary_key=["event_id"], max_nesting=1, naming="snake_case")[0].frame


@workload("union_by_name_pad", """
SELECT p_partkey, p_name, p_brand, CAST(NULL AS VARCHAR) AS p_type, CAST(NULL AS INTEGER) AS p_size,
       CAST(NULL AS DOUBLE) AS p_retailprice FROM part WHERE p_size <= 25
UNION ALL
SELECT p_partkey, p_name, NULL, p_type, p_size, p_retailprice FROM part WHERE p_size > 25
""")
def union_by_name_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged files of different widths (U1) unioned by name and aligned to the
    contract's column order with typed NULLs (P1)."""
    from tableload.operators.normalize import align_to_schema
    p = read(spark, sf_dir, "part")
    narrow = p.filter(F.col("p_size") <= 25).select("p_brand", "p_partkey", "p_name")
    wide = p.filter(F.col("p_size") > 25).select("p_type", "p_size", "p_retailprice", "p_name", "p_partkey")
    return align_to_schema(M.union_staged([narrow, wide]), p.schema)


@workload("widen_uint64", """
SELECT CAST(c_custkey AS DECIMAL(20,0)) AS c_custkey, c_name FROM customer
UNION ALL
SELECT CAST(c_custkey AS DECIMAL(20,0)) + CAST(18446744073709000000 AS DECIMAL(20,0)), c_name FROM customer
""")
def widen_uint64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BIGINT column widened to DECIMAL(20,0) once unsigned 64-bit values arrive (P10);
    stored BIGINT rows are read with the widened type, exactly."""
    from pyspark.sql import types as T

    from tableload.functions.types import UINT64_DECIMAL, widen
    from tableload.operators.normalize import align_to_schema
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    big = c.select((F.col("c_custkey").cast(UINT64_DECIMAL) + F.expr("CAST('18446744073709000000' AS DECIMAL(20,0))"))
                   .cast(UINT64_DECIMAL).alias("c_custkey"), "c_name")
    stored = T.StructType([T.StructField("c_custkey", widen(T.LongType(), big.schema["c_custkey"].dataType)),
                           T.StructField("c_name", T.StringType())])
    return align_to_schema(c, stored).unionByName(align_to_schema(big, stored))


# -------------------------------------------------------------------- layout
@workload("partition_year_month", """
SELECT year(o_orderdate) AS _p_o_orderdate_year, month(o_orderdate) AS _p_o_orderdate_month, count(*) AS n,
       sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS total_cents
FROM orders GROUP BY 1, 2
""")
def partition_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year and month transforms (L2 L5): rows and value per derived partition."""
    from tableload.functions.partition import month, year
    from tableload.operators.layout import layout_columns
    df, parts = layout_columns(read(spark, sf_dir, "orders"), [year("o_orderdate"), month("o_orderdate")])
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")  # exact integer sums in any order
    return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("total_cents"))


@workload("partition_day_hour", """
SELECT day(ts) AS _p_ts_day, hour(ts) AS _p_ts_hour, 'v' || event_type AS _p_event_type_value, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def partition_day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day and hour transforms plus an identity key."""
    from tableload.functions.partition import day, hour, identity
    from tableload.operators.layout import layout_columns
    df, parts = layout_columns(read(spark, sf_dir, "events"), [day("ts"), hour("ts"), identity("event_type")])
    return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))


@workload("partition_bucket", """
SELECT o_custkey, count(*) AS n_rows, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS total_cents, 1 AS n_buckets
FROM orders GROUP BY 1
""")
def partition_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket transform (L4): orders loaded with ``bucket(16, o_custkey)`` and read back;
    no row is lost and every customer lies in one bucket directory."""
    from tableload.contract import TableContract
    from tableload.functions.partition import bucket
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "orders-bucket")
    c = TableContract("orders", "append", partition=[bucket(16, "o_custkey")])
    load(spark, path, {"orders": read(spark, sf_dir, "orders")}, [c], "L1")
    return Dataset(spark, path).table("orders", keep_layout=True).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total_cents"),
        F.count_distinct("_p_o_custkey_bucket16").cast("int").alias("n_buckets"))


# --------------------------------------------------------------- chain merge
CHAIN_FILTER = "source <> 'src1'"


def _docs_chain(spark: SparkSession, sf_dir: str):
    """Stored and staged documents chains: stored = every document at version 1
    with all its lines; staged = English documents re-sent at version 2 with fewer
    lines, French ones at the same version (stale), German ones as tombstones."""
    from tableload.contract import TableContract
    from tableload.operators.normalize import normalize
    d = read(spark, sf_dir, "documents")
    lines = F.split("text", "\n", -1)
    stored_rec = d.select("doc_id", "lang", "source", F.lit(1).cast("bigint").alias("version"),
                          F.lit(False).alias("deleted"), lines.alias("lines"))
    staged_rec = d.filter(F.col("lang").isin("en", "fr", "de")).select(
        "doc_id", "lang", "source",
        F.when(F.col("lang") == "fr", 1).otherwise(2).cast("bigint").alias("version"),
        (F.col("lang") == "de").alias("deleted"),
        F.filter(lines, lambda x: F.length(x) > 40).alias("lines"))
    st = normalize(stored_rec, "documents", primary_key=["doc_id"], max_nesting=1, load_id="L1")
    sg = normalize(staged_rec, "documents", primary_key=["doc_id"], max_nesting=1, load_id="L2")
    chain = [TableContract("documents", "merge", ("doc_id",), cursor="version", hard_delete="deleted",
                           source_filter=CHAIN_FILTER),
             TableContract("documents__lines", "merge", parent="documents")]
    return ({t.name: t.frame for t in st}, {t.name: t.frame for t in sg}, chain)


CHAIN_SQL = f"""
WITH t AS (SELECT doc_id, lang, source, CAST(1 AS BIGINT) AS version, false AS deleted, 'L1' AS _load_id,
                  {_kid("doc_id")} AS _row_id FROM documents),
s AS (SELECT doc_id, lang, source, CAST(CASE WHEN lang = 'fr' THEN 1 ELSE 2 END AS BIGINT) AS version,
             lang = 'de' AS deleted, 'L2' AS _load_id, {_kid("doc_id")} AS _row_id
      FROM documents WHERE lang IN ('en', 'fr', 'de')),
live AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = s.doc_id
         AND NOT coalesce(s.version > t.version OR (t.version IS NULL AND s.version IS NOT NULL), false))),
p AS (SELECT * FROM live WHERE {CHAIN_FILTER}),
tl AS (SELECT {_kid("doc_id")} AS rid, string_split(text, chr(10)) AS arr FROM documents),
tc0 AS (SELECT rid, unnest(arr) AS value, unnest(range(len(arr))) AS i FROM tl),
tc AS (SELECT value, {_rid("concat_ws('|', rid, 'documents__lines', CAST(i AS VARCHAR))")} AS _row_id,
              rid AS _parent_id, rid AS _root_id, i AS _list_idx FROM tc0),
sl AS (SELECT {_kid("doc_id")} AS rid,
              list_filter(string_split(text, chr(10)), lambda x: length(x) > 40) AS arr
       FROM documents WHERE lang IN ('en', 'fr', 'de')),
sc0 AS (SELECT rid, unnest(arr) AS value, unnest(range(len(arr))) AS i FROM sl),
sc AS (SELECT value, {_rid("concat_ws('|', rid, 'documents__lines', CAST(i AS VARCHAR))")} AS _row_id,
              rid AS _parent_id, rid AS _root_id, i AS _list_idx FROM sc0)
"""


@workload("chain_merge_roots", CHAIN_SQL + """
SELECT t.* FROM t ANTI JOIN p ON t.doc_id = p.doc_id
UNION ALL SELECT * FROM p WHERE NOT deleted
""")
def chain_merge_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested upsert, root table (S7 U7): stale filter, source filter and tombstones
    applied in order; roots failing the filter keep their stored version."""
    stored, staged, chain = _docs_chain(spark, sf_dir)
    return M.merge_chain(stored, staged, chain)["documents"]


@workload("replace_children", CHAIN_SQL + """
SELECT * FROM tc WHERE _root_id NOT IN (SELECT _row_id FROM p)
UNION ALL SELECT * FROM sc WHERE _root_id IN (SELECT _row_id FROM p WHERE NOT deleted)
""")
def replace_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child replacement (U9): children of passing roots are replaced by the staged
    set, deleted roots lose theirs, everyone else's stay."""
    stored, staged, chain = _docs_chain(spark, sf_dir)
    return M.merge_chain(stored, staged, chain)["documents__lines"]


@workload("orphan_children", CHAIN_SQL + """
SELECT * FROM sc WHERE _root_id IN (SELECT _row_id FROM live)
""")
def orphan_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan filter (U8): staged children of stale roots are discarded."""
    stored, staged, chain = _docs_chain(spark, sf_dir)
    root = chain[0]
    live = M.drop_stale(staged[root.name], stored[root.name], list(root.primary_key), root.cursor)
    return M.drop_orphans(staged["documents__lines"], live)


# -------------------------------------------------------------- verification
def _events_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events tagged with a synthetic load id per day of ``ts``."""
    return read(spark, sf_dir, "events").withColumn(
        "_load_id", F.concat(F.lit("load-"), F.date_format("ts", "yyyyMMdd")))


@workload("verify_append", """
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'L1' ELSE 'L2' END AS load_id, count(*) AS n_rows
FROM events GROUP BY 1
""")
def verify_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append row counts (V3) of two committed loads, each counted as ``verify_load`` does."""
    from tableload.operators.verify import key_counts, loaded_predicate
    from tableload.sources.dataset import Dataset
    events = Dataset(spark, _events_dataset(spark, sf_dir, "append")).table("events")
    one = lambda lid: key_counts(events, "append", [], loaded_predicate([lid])).select(
        F.lit(lid).alias("load_id"), "n_rows")
    return one("L1").unionByName(one("L2"))


@workload("verify_replace_keys", """
SELECT count(*) AS n_rows,
       count(DISTINCT {'k': o_custkey}) FILTER (WHERE o_custkey IS NOT NULL) AS n_keys
FROM orders
""")
def verify_replace_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key integrity of a replaced table (V4 V5) on a non-unique key."""
    from tableload.operators.verify import key_counts
    return key_counts(read(spark, sf_dir, "orders"), "replace", ["o_custkey"], None)


@workload("verify_merge_keys", """
SELECT count(*) AS n_rows,
       count(DISTINCT {'a': loaded.l_orderkey, 'b': loaded.l_linenumber})
         FILTER (WHERE loaded.l_orderkey IS NOT NULL AND loaded.l_linenumber IS NOT NULL) AS n_keys
FROM lineitem AS loaded SEMI JOIN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O') AS cur
  ON loaded.l_orderkey IS NOT DISTINCT FROM cur.l_orderkey AND loaded.l_linenumber IS NOT DISTINCT FROM cur.l_linenumber
""")
def verify_merge_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge-scope key integrity (V6): rows sharing a key with this load's rows,
    matched NULL-safely, so older duplicates of the loaded keys are found."""
    from tableload.operators.verify import key_counts
    li = read(spark, sf_dir, "lineitem").withColumn(
        "_load_id", F.concat(F.lit("load-"), F.col("l_linestatus")))
    return key_counts(li, "merge", ["l_orderkey", "l_linenumber"], F.col("_load_id") == "load-O")


@workload("verify_child_scope", f"""
WITH r AS (SELECT {_kid("conv_id", "turn")} AS rid, role,
                  string_split(text, chr(10)) AS arr FROM conversations),
c AS (SELECT rid, unnest(range(len(arr))) AS i FROM r)
SELECT count(*) AS n_rows,
       count(DISTINCT {_rid("concat_ws('|', rid, 'conversations__lines', CAST(i AS VARCHAR))")}) AS n_keys
FROM c WHERE rid IN (SELECT rid FROM r WHERE role = 'user')
""")
def verify_child_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows of a load (V8): a child table has no load id, so its rows belong
    to the load through their parent's loaded row ids."""
    from tableload.operators.normalize import normalize
    from tableload.operators.verify import key_counts, loaded_rows
    c = read(spark, sf_dir, "conversations")
    tables = normalize(c.select("conv_id", "turn", "role", F.split("text", "\n", -1).alias("lines")),
                       "conversations", primary_key=["conv_id", "turn"], max_nesting=1,
                       load_id=F.concat(F.lit("load-"), F.col("role")))
    frames = {t.name: t.frame for t in tables}
    parents = {t.name: t.parent for t in tables}
    rows = loaded_rows(frames, parents, "conversations__lines", ["load-user"])
    return key_counts(rows, "replace", ["_row_id"], None)


@workload("verify_problems", """
WITH li AS (SELECT count(*) AS n_rows,
                   count(DISTINCT {'a': l_orderkey, 'b': l_linenumber})
                     FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) AS n_keys FROM lineitem),
od AS (SELECT count(*) AS n_rows, count(DISTINCT {'k': o_orderkey}) FILTER (WHERE o_orderkey IS NOT NULL) AS n_keys
       FROM orders),
ev AS (SELECT count(*) AS n_rows FROM events)
SELECT 'lineitem' AS "table", 'key_integrity' AS "check", n_keys AS expected, n_rows AS actual,
       'lineitem (replace): ' || n_rows || ' rows share ' || n_keys || ' complete keys'
         AS detail FROM li WHERE n_rows <> n_keys
UNION ALL
SELECT 'orders', 'key_integrity', n_keys, n_rows,
       'orders (replace): ' || n_rows || ' rows share ' || n_keys || ' complete keys'
  FROM od WHERE n_rows <> n_keys
UNION ALL
SELECT 'events', 'row_count', (SELECT count(*) FROM events WHERE event_type <> 'error'), n_rows,
       'events (append): ' || (SELECT count(*) FROM events WHERE event_type <> 'error') || ' rows prepared, '
         || n_rows || ' found' FROM ev
""")
def verify_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem report (V1 V5 V3/V4): replaced ``lineitem`` keyed on a non-unique key,
    replaced ``orders`` (clean), appended ``events`` whose normalized count (rows
    other than errors) differs from what landed.  One aggregate per table."""
    from tableload.operators.verify import key_counts, table_problems
    li = read(spark, sf_dir, "lineitem")
    od = read(spark, sf_dir, "orders")
    ev = read(spark, sf_dir, "events")
    normalized = ev.filter(F.col("event_type") != "error").count()
    out = table_problems(spark, "lineitem", "replace", ["l_orderkey", "l_linenumber"],
                         key_counts(li, "replace", ["l_orderkey", "l_linenumber"], None), None, False)
    out = out.unionByName(table_problems(spark, "orders", "replace", ["o_orderkey"],
                                         key_counts(od, "replace", ["o_orderkey"], None), None, False))
    return out.unionByName(table_problems(spark, "events", "append", [],
                                          key_counts(ev, "replace", [], None), normalized, False))


# ------------------------------------------------------------ state / history
def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pipeline states and load receipts derived from orders: one state per order,
    pipeline = priority, fixed-width load ids; loads of pending orders never
    committed (no receipt), loads of open orders failed (status 1)."""
    o = read(spark, sf_dir, "orders")
    lid = F.concat(F.lit("L"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    states = o.select(F.col("o_orderkey").alias("version"), F.col("o_orderpriority").alias("pipeline_name"),
                      F.concat_ws(":", "o_orderstatus", F.col("o_custkey").cast("string")).alias("state"),
                      F.col("o_orderdate").alias("created_at"), lid.alias("_load_id"))
    loads = o.filter(F.col("o_orderstatus") != "P").select(
        lid.alias("load_id"), F.col("o_orderpriority").alias("schema_name"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("status"),
        F.col("o_orderdate").alias("inserted_at"))
    return states, loads


STATES_SQL = """
WITH states AS (SELECT o_orderkey AS version, o_orderpriority AS pipeline_name,
                       concat_ws(':', o_orderstatus, CAST(o_custkey AS VARCHAR)) AS state,
                       o_orderdate AS created_at, 'L' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _load_id
                FROM orders),
loads AS (SELECT 'L' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS load_id,
                 CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS status FROM orders WHERE o_orderstatus <> 'P')
"""


@workload("state_latest", STATES_SQL + """
SELECT s.* FROM states s JOIN loads l ON s._load_id = l.load_id WHERE l.status = 0
QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY _load_id DESC) = 1
""")
def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest committed state of every pipeline (C6): join with receipts, status 0."""
    from tableload.operators.state import latest_state_per_pipeline
    states, loads = _states(spark, sf_dir)
    return latest_state_per_pipeline(states, loads)


@workload("state_one_pipeline", STATES_SQL + """
SELECT s.* FROM states s JOIN loads l ON s._load_id = l.load_id
WHERE l.status = 0 AND s.pipeline_name = '3-MEDIUM' ORDER BY s._load_id DESC LIMIT 1
""")
def state_one_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The restore query of one pipeline (C6): join, filter, top-1 by load id."""
    from tableload.operators.state import latest_state
    states, loads = _states(spark, sf_dir)
    return latest_state(states, loads, "3-MEDIUM")


@workload("schema_latest", """
SELECT * FROM (SELECT 'h' || CAST(o_orderkey AS VARCHAR) AS version_hash, o_orderpriority AS schema_name,
                      o_orderkey AS version, o_orderdate AS inserted_at, o_orderstatus AS schema FROM orders)
QUALIFY row_number() OVER (PARTITION BY schema_name ORDER BY inserted_at DESC NULLS LAST,
                                                            version DESC NULLS LAST) = 1
""")
def schema_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest stored schema of every schema name (C5), ties broken by version."""
    from tableload.operators.state import latest_schema_per_name
    o = read(spark, sf_dir, "orders")
    versions = o.select(F.concat(F.lit("h"), F.col("o_orderkey").cast("string")).alias("version_hash"),
                        F.col("o_orderpriority").alias("schema_name"), F.col("o_orderkey").alias("version"),
                        F.col("o_orderdate").alias("inserted_at"), F.col("o_orderstatus").alias("schema"))
    return latest_schema_per_name(versions)


@workload("schema_insert_if_absent", """
SELECT 'h' || CAST(o_orderkey AS VARCHAR) AS version_hash, o_orderpriority AS schema_name FROM orders
WHERE o_orderstatus <> 'F'
  AND 'h' || CAST(o_orderkey AS VARCHAR) NOT IN (SELECT 'h' || CAST(o_orderkey AS VARCHAR) FROM orders
                                                 WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT')
""")
def schema_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema versions are stored once per hash (C4): incoming versions already
    present are skipped."""
    from tableload.operators.state import new_schema_versions
    o = read(spark, sf_dir, "orders")
    h = F.concat(F.lit("h"), F.col("o_orderkey").cast("string")).alias("version_hash")
    stored = o.filter((F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")).select(h)
    incoming = o.filter(F.col("o_orderstatus") != "F").select(h, F.col("o_orderpriority").alias("schema_name"))
    return new_schema_versions(stored, incoming)


@workload("incremental_window", """
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')
""")
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental cursor (C7): the previous run committed the cursor max of the
    first half of January; this run reads only newer rows."""
    from tableload.operators.state import incremental, max_cursor
    ev = read(spark, sf_dir, "events")
    last = max_cursor(ev.filter(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")), "ts")
    return incremental(ev, "ts", last)


@workload("refresh_drop_data", """
SELECT 'customer' AS table_name, count(*) AS n_rows, count(DISTINCT c_nationkey) AS n_keys FROM customer
WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey) FROM orders
""")
def refresh_drop_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``drop_data`` refresh through a load (C8): customers are cleared and one segment of
    them loaded anew in the same commit; orders stay."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "refresh")
    cu, od = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    c, o = TableContract("customer", "append"), TableContract("orders", "append")
    load(spark, path, {"customer": cu, "orders": od}, [c, o], "L1")
    load(spark, path, {"customer": cu.filter("c_mktsegment = 'BUILDING'")}, [c], "L2", refresh="drop_data",
         allow_destructive=True)
    return _table_counts(Dataset(spark, path), {"customer": "c_nationkey", "orders": "o_custkey"})


def _table_counts(ds, keys: dict[str, str]) -> DataFrame:
    """Rows and distinct values of one column for every named table."""
    return M.union_staged([
        ds.table(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(k).alias("n_keys"))
        for t, k in keys.items()])


@workload("readback_select", """
SELECT event_id, user_id, value FROM events WHERE value >= 50 ORDER BY value DESC, event_id DESC LIMIT 25
""")
def readback_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained read-back (R2): select, ``where(col, "gte", v)``, order, top-25."""
    from tableload.sources.relation import where
    ev = read(spark, sf_dir, "events")
    return (where(ev, "value", "gte", 50).select("event_id", "user_id", "value")
            .orderBy(F.col("value").desc(), F.col("event_id").desc()).limit(25))


# ---------------------------------------------------------- load / stream
def _chain_dataset(spark: SparkSession, sf_dir: str) -> str:
    """Load the documents chain twice through ``plans.load`` into a fresh dataset
    under the cluster's shared folder: all documents at version 1, then the staged
    English / French / German versions with the source filter set.  The second
    load is copy-on-write."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    path = scratch_path(spark, "docs-chain")
    d = read(spark, sf_dir, "documents")
    lines = F.split("text", "\n", -1)
    root = TableContract("documents", "merge", ("doc_id",), cursor="version", hard_delete="deleted",
                         source_filter=CHAIN_FILTER)
    first = d.select("doc_id", "lang", "source", F.lit(1).cast("bigint").alias("version"),
                     F.lit(False).alias("deleted"), lines.alias("lines"))
    second = d.filter(F.col("lang").isin("en", "fr", "de")).select(
        "doc_id", "lang", "source", F.when(F.col("lang") == "fr", 1).otherwise(2).cast("bigint").alias("version"),
        (F.col("lang") == "de").alias("deleted"), F.filter(lines, lambda x: F.length(x) > 40).alias("lines"))
    plain = TableContract("documents", "merge", ("doc_id",), cursor="version", hard_delete="deleted")
    load(spark, path, {"documents": first}, [plain], "L1", max_nesting=1)
    load(spark, path, {"documents": second}, [root], "L2", max_nesting=1)
    load(spark, path, {"documents": second}, [root], "L2", max_nesting=1)  # replay: no-op
    return path


@workload("load_chain_roots", CHAIN_SQL + """
SELECT t.* FROM t ANTI JOIN p ON t.doc_id = p.doc_id
UNION ALL SELECT * FROM p WHERE NOT deleted
""")
def load_chain_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End-to-end nested merge on disk (S7 U13 C2): staged, merged copy-on-write,
    committed once, replay ignored; read back through the ledger."""
    from tableload.sources.dataset import Dataset
    return Dataset(spark, _chain_dataset(spark, sf_dir)).table("documents")


@workload("load_chain_children", CHAIN_SQL + """
SELECT * FROM tc WHERE _root_id NOT IN (SELECT _row_id FROM p)
UNION ALL SELECT * FROM sc WHERE _root_id IN (SELECT _row_id FROM p WHERE NOT deleted)
""")
def load_chain_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The child table after the same two loads (U9 on disk)."""
    from tableload.sources.dataset import Dataset
    return Dataset(spark, _chain_dataset(spark, sf_dir)).table("documents__lines")


@workload("stream_merge", f"""
SELECT *, 'events-000000000000' AS _load_id, {_kid("user_id")} AS _row_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""")
def stream_merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming merge (X1): the events file read as a stream, each
    micro-batch upserted by user with cursor ``ts``; read back after the stream
    has drained (``availableNow``)."""
    from tableload.contract import TableContract
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    from tableload.streaming.stream_merge import stream_merge
    schema = read(spark, sf_dir, "events").schema
    # the file source needs a directory or a glob, not a single file
    src = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    path = scratch_path(spark, "events-stream")
    c = TableContract("events", "merge", ("user_id",), cursor="ts", tie_break=("event_id",))
    q = stream_merge(src, path, [c], "events", checkpoint=f"{path}/_checkpoint")
    q.awaitTermination()
    # the load id also holds the id of the checkpoint, which differs from run to run
    return Dataset(spark, path).table("events").withColumn(
        "_load_id", F.regexp_replace("_load_id", "-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}-", "-"))


@workload("stream_merge_newest", f"""
WITH e AS (SELECT *, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS b FROM events)
SELECT * EXCLUDE (b), 'newest-00000000000' || b AS _load_id, {_kid("user_id")} AS _row_id FROM e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, b, event_id DESC) = 1
""")
def stream_merge_newest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful stream merge (X1 U2 U4): views, then clicks, then all other events arrive, and the stream is
    started again from its checkpoint for each; state keeps the newest cursor of a user, so events older than
    those stored, and ties with them, are dropped without a read of the target."""
    from tableload.contract import TableContract
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    from tableload.streaming.newest import stream_merge_newest
    path = scratch_path(spark, "newest-stream")
    events = read(spark, sf_dir, "events")
    c = TableContract("events", "merge", ("user_id",), cursor="ts", tie_break=("event_id",))
    kind = F.col("event_type")
    for arrived in (kind == "view", kind == "click", ~F.coalesce(kind.isin("view", "click"), F.lit(False))):
        events.filter(arrived).write.mode("append").parquet(f"{path}/_in")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/_in")
        stream_merge_newest(stream, f"{path}/lake", c, "newest", checkpoint=f"{path}/_checkpoint").awaitTermination()
    return Dataset(spark, f"{path}/lake").table("events").withColumn(
        "_load_id", F.regexp_replace("_load_id", "-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}-", "-"))


@workload("labels_partial_update", """
WITH t AS (SELECT doc_id, lang, source, n_chars, CAST(NULL AS INTEGER) AS quality,
                  CAST(NULL AS INTEGER) AS toxic FROM documents)
SELECT t.* FROM t ANTI JOIN labels l ON t.doc_id = l.doc_id
UNION ALL
SELECT l.doc_id, t.lang, t.source, t.n_chars, l.quality, l.toxic FROM labels l LEFT JOIN t ON t.doc_id = l.doc_id
""")
def labels_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial-column upsert (S6 U5): label columns land on the labelled documents,
    every other stored column keeps its value."""
    d = read(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.lit(None).cast("int").alias("quality"),
        F.lit(None).cast("int").alias("toxic"))
    return M.upsert(d, read(spark, sf_dir, "labels"), "doc_id", partial=True)


def _events_dataset(spark: SparkSession, sf_dir: str, disposition: str, layout=None) -> str:
    """Two loads of events into a fresh dataset: views and clicks first, the
    remaining event types second."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    path = scratch_path(spark, f"events-{disposition}")
    ev = read(spark, sf_dir, "events")
    first = F.col("event_type").isin("view", "click")
    c = TableContract("events", disposition, partition=layout)
    load(spark, path, {"events": ev.filter(first)}, [c], "L1")
    load(spark, path, {"events": ev.filter(~first)}, [c], "L2")
    return path


@workload("load_append_events", """
SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'L1' ELSE 'L2' END AS _load_id FROM events
""")
def load_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append on disk (S3): both loads' rows, each under its load id."""
    from tableload.sources.dataset import Dataset
    return Dataset(spark, _events_dataset(spark, sf_dir, "append")).table("events").drop("_row_id")


@workload("load_replace_events", """
SELECT *, 'L2' AS _load_id FROM events WHERE event_type NOT IN ('view', 'click')
""")
def load_replace_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace on disk (S4): only the latest load's rows remain."""
    from tableload.sources.dataset import Dataset
    return Dataset(spark, _events_dataset(spark, sf_dir, "replace")).table("events").drop("_row_id")


@workload("load_layout_between", """
SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'L1' ELSE 'L2' END AS _load_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-10 18:00:00'
""")
def load_layout_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned append (L2 L5) read back with partition pruning: a range on
    ``ts`` within one day becomes a filter on the derived day directories."""
    from tableload.functions.partition import day
    from tableload.sources.dataset import Dataset
    path = _events_dataset(spark, sf_dir, "append", [day("ts")])
    return Dataset(spark, path).between("events", "ts", "2024-01-10 06:00:00", "2024-01-10 18:00:00").drop(
        "_row_id")


@workload("load_verify_problems", """
SELECT 'lineitem' AS "table", 'key_integrity' AS "check",
       count(DISTINCT {'a': l_orderkey, 'b': l_linenumber}) AS expected, count(*) AS actual,
       'lineitem (replace): ' || count(*) || ' rows share '
         || count(DISTINCT {'a': l_orderkey, 'b': l_linenumber}) || ' complete keys' AS detail
FROM lineitem
""")
def load_verify_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``verify_load`` on disk (V1-V5 V12): a replace of ``lineitem`` and an append of
    ``orders`` in one load; the replace keyed on (order, line number) reports its
    duplicate keys, the append reconciles."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.plans.verify_load import verify_load
    from tableload.session import scratch_path
    path = scratch_path(spark, "verify")
    load(spark, path, {"lineitem": read(spark, sf_dir, "lineitem"), "orders": read(spark, sf_dir, "orders")},
         [TableContract("lineitem", "replace", ("l_orderkey", "l_linenumber")), TableContract("orders", "append")],
         "L1")
    return verify_load(spark, path)


@workload("load_bucket_int_key", """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CASE WHEN c_nationkey IN (3, 11) THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_nationkey IN (3, 11) THEN 'L2' ELSE 'L1' END AS _load_id FROM customer
""")
def load_bucket_int_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge into a table bucketed on a key that arrives as INT and is stored as BIGINT
    (L4 P11 U5): two nations' customers are sent again, which touches few buckets."""
    from tableload.functions.partition import bucket
    cu = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    again = cu.filter(F.col("c_nationkey").isin(3, 11)).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return _merged_twice(spark, "customer", ("c_nationkey", "c_custkey"), [bucket(8, "c_nationkey")], cu, again)


@workload("load_bucket_widened", """
SELECT CAST(c_custkey AS DECIMAL(20,0)) AS c_custkey, c_mktsegment,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'L2' ELSE 'L1' END AS _load_id FROM customer
""")
def load_bucket_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed key widened from BIGINT to DECIMAL(20,0) by the second load."""
    from tableload.functions.partition import bucket
    from tableload.functions.types import UINT64_DECIMAL
    cu = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    again = cu.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast(UINT64_DECIMAL).alias("c_custkey"), "c_mktsegment", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return _merged_twice(spark, "customer", ("c_custkey",), [bucket(64, "c_custkey")], cu, again)


@workload("load_bucket_date_key", """
SELECT o_orderdate, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'L2' ELSE 'L1' END AS _load_id FROM orders
""")
def load_bucket_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed TIMESTAMP key that arrives again as DATE (L4 P6 U5): urgent orders are sent once
    more and meet their stored rows."""
    from tableload.functions.partition import bucket
    od = read(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_totalprice", "o_orderpriority")
    again = od.filter("o_orderpriority = '1-URGENT'").select(
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return _merged_twice(spark, "orders", ("o_orderdate", "o_orderkey"), [bucket(8, "o_orderdate")], od.drop("o_orderpriority"), again)


@workload("load_chain_date_key", f"""
WITH o AS (SELECT {_kid_time("epoch_us(o_orderdate)", "o_orderkey")} AS rid, CASE WHEN o_orderpriority = '1-URGENT'
           THEN ['again', o_orderstatus] ELSE string_split(o_orderpriority, '-') END AS arr FROM orders),
e AS (SELECT rid, unnest(arr) AS value, unnest(range(len(arr))) AS i FROM o)
SELECT value, {_rid("concat_ws('|', rid, 'orders__notes', CAST(i AS VARCHAR))")} AS _row_id, rid AS _root_id, i AS _list_idx FROM e
""")
def load_chain_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain whose TIMESTAMP key arrives again as DATE (P6 U9): the urgent orders' children are
    replaced, none is doubled."""
    od = read(spark, sf_dir, "orders")
    first = od.select("o_orderdate", "o_orderkey", F.split("o_orderpriority", "-").alias("notes"))
    again = od.filter("o_orderpriority = '1-URGENT'").select(
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey", F.array(F.lit("again"), "o_orderstatus").alias("notes"))
    return _chain_twice(spark, "orders", ("o_orderdate", "o_orderkey"), first, again).table("orders__notes").drop("_parent_id")


@workload("load_chain_text_key", f"""
WITH c AS (SELECT {_kid_text("CAST(c_custkey AS VARCHAR)")} AS rid, c_mktsegment AS seg, c_custkey AS k,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN ['x', c_mktsegment] ELSE [c_mktsegment] END AS arr FROM customer),
e AS (SELECT rid, k, unnest(arr) AS value, unnest(range(len(arr))) AS i FROM c)
SELECT CAST(k AS VARCHAR) AS c_custkey, value, i AS _list_idx, rid AS _root_id FROM e
""")
def load_chain_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored TEXT key that arrives as INT (S6 P6 U11): one row a key, with one set of children."""
    cu = read(spark, sf_dir, "customer")
    first = cu.select(F.col("c_custkey").cast("string").alias("c_custkey"), F.array("c_mktsegment").alias("segs"))
    again = cu.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.array(F.lit("x"), "c_mktsegment").alias("segs"))
    ds = _chain_twice(spark, "customer", ("c_custkey",), first, again)
    roots = ds.table("customer").select("c_custkey", F.col("_row_id").alias("_root_id"))
    return ds.table("customer__segs").join(roots, "_root_id").select("c_custkey", "value", "_list_idx", "_root_id")


def _chain_twice(spark: SparkSession, table: str, key: tuple[str, ...], first: DataFrame, second: DataFrame):
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, f"{table}-chain")
    c = TableContract(table, "merge", key)
    load(spark, path, {table: first}, [c], "L1", max_nesting=1)
    load(spark, path, {table: second}, [c], "L2", max_nesting=1)
    return Dataset(spark, path)


PARTITION_TEXT = {"BUILDING": "", "MACHINERY": None, "FURNITURE": "__HIVE_DEFAULT_PARTITION__", "AUTOMOBILE": "a/b=c %"}


@workload("load_partition_empty_text", """
WITH c AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL
             WHEN 'FURNITURE' THEN '__HIVE_DEFAULT_PARTITION__' WHEN 'AUTOMOBILE' THEN 'a/b=c %' ELSE c_mktsegment END AS seg,
             c_acctbal + CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS c_acctbal FROM customer)
SELECT 'all' AS part, * FROM c UNION ALL SELECT 'range', * FROM c WHERE seg BETWEEN '' AND '`'
""")
def load_partition_empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity partitions of empty text, NULL and names that mean something to a path (L1 L5 L10): every value
    reads back as it was, after an append and after a merge, and a range reads its folders."""
    from tableload.contract import TableContract
    from tableload.functions.partition import identity
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    seg = F.col("c_mktsegment")
    for name, text in PARTITION_TEXT.items():
        seg = F.when(F.col("c_mktsegment") == name, F.lit(text).cast("string")).otherwise(seg)
    cu = read(spark, sf_dir, "customer").select("c_custkey", seg.alias("seg"), "c_acctbal", "c_nationkey")
    path = scratch_path(spark, "partition-text")
    layout = [identity("seg")]
    load(spark, path, {"customer": cu.drop("c_nationkey")}, [TableContract("customer", "append", partition=layout)], "L1")
    again = cu.filter("c_nationkey = 3").select("c_custkey", "seg", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    load(spark, path, {"customer": again}, [TableContract("customer", "merge", ("c_custkey",), partition=layout)], "L2")
    ds = Dataset(spark, path)
    parts = {"all": ds.table("customer"), "range": ds.between("customer", "seg", "", "`")}
    return M.union_staged([df.select(F.lit(p).alias("part"), "c_custkey", "seg", "c_acctbal") for p, df in parts.items()])


@workload("load_layout_cover", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-12-15 00:00:00' AND TIMESTAMP '1996-01-31 00:00:00'
""")
def load_layout_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range over the end of a year in a year and month layout (L2 L3 R2): two months are read."""
    from tableload.contract import TableContract
    from tableload.functions.partition import month, year
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "cover")
    c = TableContract("orders", "append", partition=[year("o_orderdate"), month("o_orderdate")])
    load(spark, path, {"orders": read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")}, [c], "L1")
    return Dataset(spark, path).between("orders", "o_orderdate", "1995-12-15 00:00:00", "1996-01-31 00:00:00").drop("_load_id", "_row_id")


def _merged_twice(spark: SparkSession, table: str, key: tuple[str, ...], layout, first: DataFrame, second: DataFrame) -> DataFrame:
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, f"{table}-merged")
    c = TableContract(table, "merge", key, partition=layout)
    load(spark, path, {table: first}, [c], "L1")
    load(spark, path, {table: second}, [c], "L2")
    return Dataset(spark, path).table(table).drop("_row_id")


@workload("load_two_frames_nested", f"""
WITH d AS (SELECT {_kid("doc_id")} AS rid, lang, string_split(text, chr(10)) AS ls, string_split(source, 'r') AS ps FROM documents),
e AS (SELECT rid, 'lines' AS child, unnest(ls) AS value, unnest(range(len(ls))) AS i FROM d
      UNION ALL SELECT rid, 'parts', unnest(ps), unnest(range(len(ps))) FROM d WHERE lang <> 'en')
SELECT child, value, {_rid("concat_ws('|', rid, 'documents__' || child, CAST(i AS VARCHAR))")} AS _row_id, rid AS _root_id,
       i AS _list_idx FROM e
""")
def load_two_frames_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two frames of one load whose list columns differ in number and order (S7 U1): child
    tables are matched by name, and a list that one frame lacks is empty for its rows."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    d = read(spark, sf_dir, "documents")
    lines, parts = F.split("text", "\n", -1).alias("lines"), F.split("source", "r", -1).alias("parts")
    frames = [d.filter("lang = 'en'").select("doc_id", lines), d.filter("lang <> 'en'").select(parts, "lang", lines, "doc_id")]
    path = scratch_path(spark, "two-frames")
    load(spark, path, {"documents": frames}, [TableContract("documents", "merge", ("doc_id",))], "L1", max_nesting=1)
    ds = Dataset(spark, path)
    return M.union_staged([ds.table(f"documents__{c}").select(F.lit(c).alias("child"), "value", "_row_id", "_root_id", "_list_idx")
                           for c in ("lines", "parts")])


@workload("load_two_frames_ids", """
SELECT p_brand, count(*) AS n_rows, count(*) AS n_ids FROM part GROUP BY 1
""")
def load_two_frames_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two flat frames in one append (S3): every row has an id of its own."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    p = read(spark, sf_dir, "part")
    path = scratch_path(spark, "frame-ids")
    load(spark, path, {"part": [p.filter("p_size <= 25"), p.filter("p_size > 25").drop("p_type")]}, [TableContract("part", "append")], "L1")
    ids = Dataset(spark, path).table("part")
    once = ids.groupBy("_row_id").agg(F.min("p_brand").alias("p_brand"), F.count(F.lit(1)).alias("n"))
    return once.groupBy("p_brand").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"))


@workload("load_composite_text_key", f"""
WITH d AS (SELECT {_kid_text("concat(lang, '|', source)", "concat(doc_id, '|x')")} AS rid, lang, string_split(text, chr(10)) AS arr FROM documents),
k AS (SELECT rid, CASE WHEN lang = 'de' THEN list_filter(arr, lambda x: length(x) > 40) ELSE arr END AS arr FROM d),
e AS (SELECT rid, unnest(arr) AS value, unnest(range(len(arr))) AS i FROM k)
SELECT value, {_rid("concat_ws('|', rid, 'docs__lines', CAST(i AS VARCHAR))")} AS _row_id, rid AS _parent_id, rid AS _root_id,
       i AS _list_idx FROM e
""")
def load_composite_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain on a two-column text key whose values hold separators (P6 U9 U11): the German
    documents' children are replaced, all others stay."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    lines = F.split("text", "\n", -1)
    d = read(spark, sf_dir, "documents").select(
        F.concat("lang", F.lit("|"), "source").alias("a"), F.concat(F.col("doc_id").cast("string"), F.lit("|x")).alias("b"),
        "lang", lines.alias("lines"))
    again = d.filter("lang = 'de'").withColumn("lines", F.filter("lines", lambda x: F.length(x) > 40))
    path = scratch_path(spark, "text-key")
    c = TableContract("docs", "merge", ("a", "b"))
    load(spark, path, {"docs": d}, [c], "L1", max_nesting=1)
    load(spark, path, {"docs": again}, [c], "L2", max_nesting=1)
    return Dataset(spark, path).table("docs__lines")


@workload("load_drop_resources", """
SELECT 'customer' AS table_name, count(*) AS n_rows, count(DISTINCT c_name) AS n_keys, 1 AS n_versions FROM customer
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), 1 FROM orders
""")
def load_drop_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``drop_resources`` refresh (C9): customers are dropped with all schema versions that
    name them and loaded anew with another schema; orders stay."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "drop-resources")
    cu, od = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    c, o = TableContract("customer", "append"), TableContract("orders", "append")
    load(spark, path, {"customer": cu.select("c_custkey")}, [c], "L1")
    load(spark, path, {"customer": cu.select("c_custkey", "c_acctbal"), "orders": od}, [c, o], "L2")
    load(spark, path, {"customer": cu.select("c_name")}, [c], "L3", refresh="drop_resources", allow_destructive=True)
    ds = Dataset(spark, path)
    named = ds.schema_versions().select(F.explode(F.json_object_keys("schema")).alias("table_name")).groupBy("table_name").agg(
        F.count(F.lit(1)).cast("int").alias("n_versions"))
    return _table_counts(ds, {"customer": "c_name", "orders": "o_orderkey"}).join(named, "table_name")


@workload("load_incremental_two_tables", """
SELECT 'events' AS table_name, count(*) AS n_rows, count(DISTINCT event_id) AS n_keys FROM events
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders
""")
def load_incremental_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of one pipeline loaded incrementally in turns (C6 C7), the second run of
    each from its own committed cursor, then a refresh of one of them (C8)."""
    from tableload.contract import TableContract
    from tableload.plans.incremental import incremental_load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "incremental-two")
    ev, od = read(spark, sf_dir, "events"), read(spark, sf_dir, "orders")
    e, o = TableContract("events", "append"), TableContract("orders", "append")
    run = lambda src, c, cur, lid, **kw: incremental_load(spark, path, src, c, cur, "pipe", lid, **kw)
    run(ev.filter("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"), e, "ts", "L001")
    run(od.filter("o_orderdate < TIMESTAMP_NTZ '1997-01-01 00:00:00'"), o, "o_orderdate", "L002")
    run(ev, e, "ts", "L003")
    run(od, o, "o_orderdate", "L004")
    run(ev, e, "ts", "L005", refresh="drop_data", allow_destructive=True)
    run(od, o, "o_orderdate", "L006")
    return _table_counts(Dataset(spark, path), {"events": "event_id", "orders": "o_orderkey"})


@workload("load_incremental_late", """
WITH ev AS (SELECT *, CASE WHEN event_type = 'click' AND user_id % 3 = 0 THEN NULL ELSE date_trunc('day', ts) END AS event_day FROM events)
SELECT mode, event_day, event_type, count(*) AS n_rows, count(DISTINCT event_id) AS n_keys, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS n_views
FROM ev, (VALUES ('plain'), ('snake'), ('nested')) AS m(mode) GROUP BY ALL
""")
def load_incremental_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends that resume from a cursor of whole days (C7 C8 P8): of the last day loaded, and of the events without a
    cursor, only views come with the first run, clicks with the second (whose source has a column more), all others with
    the third; a fourth finds nothing new.  Plain, with renamed columns and table, and with nested lists."""
    from tableload.contract import TableContract
    from tableload.plans.incremental import incremental_load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    at = F.when((F.col("event_type") == "click") & (F.col("user_id") % 3 == 0), F.lit(None)).otherwise(F.date_trunc("day", "ts"))
    ev = read(spark, sf_dir, "events").select(at.cast("timestamp_ntz").alias("eventDay"), F.col("event_id").alias("eventId"), "event_type")
    day = F.lit("2024-01-16").cast("timestamp_ntz")
    c = F.col("eventDay")
    first = ev.filter((c < day) | (F.coalesce(c <= day, F.lit(True)) & (F.col("event_type") == "view")))
    wider = ev.withColumn("added", F.when(F.col("event_type") != "view", F.col("event_type")))
    second = wider.filter((c < day) | (F.coalesce(c <= day, F.lit(True)) & F.col("event_type").isin("view", "click")))
    out = []
    for mode, table, naming, nesting in (("plain", "Ev", "direct", 0), ("snake", "Ev", "snake_case", 0), ("nested", "ev", "snake_case", 1)):
        path = scratch_path(spark, f"late-{mode}")
        listed = (lambda df: df.withColumn("xs", F.array("event_type", "event_type"))) if nesting else (lambda df: df)
        for i, source in enumerate((first, second, wider, wider)):
            incremental_load(spark, path, listed(source), TableContract(table, "append"), "eventDay", "pipe", f"L{i}",
                             naming=naming, max_nesting=nesting)
        ds = Dataset(spark, path)
        t = ds.table("Ev" if naming == "direct" else "ev")
        t = t.select(*[F.col(x).alias(y) for x, y in zip(t.columns, ("event_day", "event_id", "event_type"))], "_row_id")
        if nesting:  # every event has its two list entries
            t = t.join(ds.table("ev__xs").filter("_list_idx = 1").select(F.col("_root_id").alias("_row_id")), "_row_id")
        out.append(t.groupBy(F.lit(mode).alias("mode"), "event_day", "event_type").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_keys"),
            F.sum(F.when(F.col("event_type") == "view", 1).otherwise(0)).alias("n_views")))
    return M.union_staged(out)


@workload("load_layout_changed", """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'
""")
def load_layout_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout set on a filled table (L6): append, set layout, append, merge, range read;
    rows written before and after the change are all found."""
    from tableload.contract import TableContract
    from tableload.functions.partition import day, month, year
    from tableload.plans.load import load
    from tableload.plans.maintenance import set_layout
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "layout-changed")
    ev = read(spark, sf_dir, "events").drop("props")
    first = F.col("event_type").isin("view", "click")
    plain, merge = TableContract("events", "append"), TableContract("events", "merge", ("event_id",))
    load(spark, path, {"events": ev.filter(first)}, [plain], "L1")
    set_layout(spark, path, "events", [year("ts"), month("ts"), day("ts")])
    load(spark, path, {"events": ev.filter(~first)}, [plain], "L2")
    load(spark, path, {"events": ev.filter("event_type = 'click'").withColumn("value", F.col("value") + 1)}, [merge], "L3")
    return Dataset(spark, path).between("events", "ts", "2024-01-10 06:00:00", "2024-01-12 18:00:00").drop("_load_id", "_row_id")


@workload("load_routed_events", """
SELECT 'events_' || event_type AS table_name, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys FROM events GROUP BY 1
""")
def load_routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows routed to one table for each event type (S13) and loaded together."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    from tableload.sources.inputs import route
    routed = route(read(spark, sf_dir, "events"), "concat('events_', event_type)")
    path = scratch_path(spark, "routed")
    load(spark, path, routed, [TableContract(t, "append") for t in routed], "L1")
    return _table_counts(Dataset(spark, path), {t: "user_id" for t in routed})


@workload("load_evolved_part", """
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CASE WHEN p_size > 25 THEN p_name END AS p_name,
       CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice FROM part
""")
def load_evolved_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load brings new columns (E2 E3 P11): earlier rows read them as NULL, and
    INT is stored as BIGINT."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    p = read(spark, sf_dir, "part")
    path = scratch_path(spark, "evolved")
    c = TableContract("part", "append")
    load(spark, path, {"part": p.filter("p_size <= 25").select("p_partkey", "p_size")}, [c], "L1")
    load(spark, path, {"part": p.filter("p_size > 25").select("p_name", "p_retailprice", "p_size", "p_partkey")}, [c], "L2")
    return Dataset(spark, path).table("part").drop("_load_id", "_row_id")


@workload("load_partition_move", """
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, count(*) AS n_rows,
       count(DISTINCT c_custkey) AS n_keys FROM customer GROUP BY 1
""")
def load_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge that changes the partition value of a segment's customers (L1 L10): the rows
    leave their old directory."""
    from tableload.contract import TableContract
    from tableload.functions.partition import identity
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    cu = read(spark, sf_dir, "customer")
    path = scratch_path(spark, "moved")
    c = TableContract("customer", "merge", ("c_custkey",), partition=[identity("c_mktsegment")])
    load(spark, path, {"customer": cu}, [c], "L1")
    load(spark, path, {"customer": cu.filter("c_mktsegment = 'BUILDING'").withColumn("c_mktsegment", F.lit("MOVED"))}, [c], "L2")
    return Dataset(spark, path).table("customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("c_custkey").alias("n_keys"))


@workload("load_receipts", """
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'L1' ELSE 'L2' END AS load_id, 0 AS status, count(*) AS n_rows
FROM events GROUP BY 1
""")
def load_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of two loads (C1 V12) with the row counts taken while loading."""
    from tableload.sources.dataset import Dataset
    ds = Dataset(spark, _events_dataset(spark, sf_dir, "append"))
    return ds.ledger.history(ds.snapshot(), "loads").select(
        "load_id", "status", F.get_json_object("counts", "$.events").cast("long").alias("n_rows"))


@workload("upsert_null_keys", """
WITH t AS (SELECT CASE WHEN c_nationkey <> 3 THEN c_custkey END AS k, c_acctbal AS v FROM customer),
s AS (SELECT CASE WHEN c_nationkey <> 4 THEN c_custkey END AS k, c_acctbal + 1 AS v FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT * FROM t WHERE k IS NULL OR k NOT IN (SELECT k FROM s WHERE k IS NOT NULL)
UNION ALL SELECT * FROM s
""")
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys never match (U12): stored rows without a key stay, staged ones are inserted."""
    cu = read(spark, sf_dir, "customer")
    keyed = lambda n: F.when(F.col("c_nationkey") != n, F.col("c_custkey")).alias("k")
    staged = cu.filter("c_mktsegment = 'BUILDING'").select(keyed(4), (F.col("c_acctbal") + 1).alias("v"))
    return M.upsert(cu.select(keyed(3), F.col("c_acctbal").alias("v")), staged, "k")


@workload("merge_bucketed_orders", f"""
WITH s AS ({ORDERS_PARTIAL_STAGED_SQL}),
d AS (SELECT * FROM s QUALIFY row_number() OVER (
        PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST) = 1),
live AS (SELECT * FROM d WHERE NOT EXISTS (
        SELECT 1 FROM orders t WHERE t.o_orderkey = d.o_orderkey
        AND NOT coalesce(d.o_orderdate > t.o_orderdate
                         OR (t.o_orderdate IS NULL AND d.o_orderdate IS NOT NULL), false))),
m AS (SELECT t.* FROM orders t ANTI JOIN live l ON t.o_orderkey = l.o_orderkey
      UNION ALL
      SELECT l.o_orderkey, t.o_custkey, t.o_orderstatus, l.o_totalprice, l.o_orderdate, t.o_orderpriority
      FROM live l LEFT JOIN orders t ON t.o_orderkey = l.o_orderkey),
again AS (SELECT o_orderkey, o_custkey % 2 = 0 AS gone FROM orders WHERE o_orderstatus = 'P'
          UNION ALL SELECT NULL, false)
SELECT m.*, CASE WHEN a.o_orderkey IS NOT NULL THEN 'kept' END AS note FROM m LEFT JOIN again a ON m.o_orderkey = a.o_orderkey
WHERE a.gone IS NOT TRUE
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'kept'
""")
def merge_bucketed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges into a bucketed table that is never shuffled (L4 U2 U4 U5 U6 U12): partial columns with a cursor, then
    deletes and a new column under keys of another type; a row without a key is inserted."""
    from tableload.operators.bucketed import merge_bucketed, open_bucketed, save_bucketed
    from tableload.session import scratch_path
    orders, buckets, key = read(spark, sf_dir, "orders"), 8, "o_orderkey"
    first = save_bucketed(orders, scratch_path(spark, "bucketed"), key, buckets)
    merged = merge_bucketed(first, orders_partial_staged(orders), key, buckets, "o_orderdate", partial=True)
    path = scratch_path(spark, "bucketed")
    save_bucketed(merged, path, key, buckets)
    second = open_bucketed(spark, path, merged.schema, key, buckets)
    again = orders.filter("o_orderstatus = 'P'").select(
        F.col(key).cast("int").alias(key), (F.col("o_custkey") % 2 == 0).alias("gone"), F.lit("kept").alias("note"))
    # one row without a key, whatever the table holds
    keyless = orders.agg(F.lit(None).cast("int").alias(key), F.lit(False).alias("gone"), F.lit("kept").alias("note"))
    return merge_bucketed(second, again.unionByName(keyless), key, buckets, partial=True, hard_delete="gone")


@workload("readback_arrow_chunks", """
SELECT event_type, count(*) AS n_rows, sum(event_id) AS id_sum, count(value) AS n_values, max(ts) AS last_ts FROM events GROUP BY 1
""")
def readback_arrow_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunked Arrow read-back (R5 R6 R7): chunks of 1000 rows made on the executors hold every row once, with its types."""
    import pyarrow as pa

    from tableload.sources.relation import arrow_chunks, read_chunk

    def rows(batches):
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                table = read_chunk(chunk)
                assert len(table) <= 1000
                yield from table.rename_columns(["event_id", "ts", "event_type", "value"]).to_batches()
        yield pa.RecordBatch.from_pylist([], schema=pa.schema([
            ("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("event_type", pa.string()), ("value", pa.float64())]))

    ev = read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    back = arrow_chunks(ev, 1000).select("chunk").mapInArrow(rows, ev.schema)
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"), F.count("value").alias("n_values"),
        F.max("ts").alias("last_ts"))


@workload("load_replace_empty", """
SELECT 'customer' AS table_name, count(*) AS n_rows, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns FROM customer WHERE false
UNION ALL SELECT 'nation', count(*), 'n_nationkey,n_name,n_regionkey' FROM nation
""")
def load_replace_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replace with no rows empties the table and keeps its columns (S5); the other table of the load is filled."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "replace-empty")
    cu, na = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    contracts = [TableContract("customer", "replace"), TableContract("nation", "replace")]
    load(spark, path, {"customer": cu, "nation": na}, contracts, "L1")
    load(spark, path, {"customer": cu.filter(F.lit(False)), "nation": na}, contracts, "L2")
    ds = Dataset(spark, path)
    out = []
    for t in ("customer", "nation"):
        df = ds.table(t).drop("_load_id", "_row_id")
        out.append(df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(",".join(df.columns)).alias("columns")))
    return M.union_staged(out)


@workload("load_refused_whole", """
SELECT step, t.table_name, t.n_rows, t.n_keys
FROM (VALUES ('bad contract'), ('guard')) AS s(step),
     (SELECT 'customer' AS table_name, count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys FROM customer
      UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders) AS t
""")
def load_refused_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table with a broken contract stops the whole load (U14 U15 L8), and a refresh without the opt-in is refused (C10):
    both leave all tables as they were."""
    from tableload.contract import TableContract
    from tableload.errors import ContractError, DestructiveRefreshRefused
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    path = scratch_path(spark, "refused")
    cu, od = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    good = [TableContract("customer", "append"), TableContract("orders", "append")]
    load(spark, path, {"customer": cu, "orders": od}, good, "L1")
    out = []
    for step, contracts, more in (("bad contract", [good[0], TableContract("orders", "merge")], {}),
                                  ("guard", good, {"refresh": "drop_data"})):
        try:
            load(spark, path, {"customer": cu, "orders": od}, contracts, "L2", **more)
            refused = False
        except (ContractError, DestructiveRefreshRefused):
            refused = True
        out.append(_table_counts(Dataset(spark, path), {"customer": "c_custkey", "orders": "o_orderkey"}).withColumn(
            "step", F.lit(step if refused else "published")))
    return M.union_staged(out)


@workload("readback_sql", """
SELECT c_mktsegment, count(*) AS n_orders, sum(o_totalprice) AS total FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1
""")
def readback_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over two loaded tables by their plain names (R3), whose files were read as one input."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    from tableload.sources.inputs import read_files
    path = scratch_path(spark, "readback-sql")
    frames = {t: read_files(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet"]) for t in ("customer", "orders")}
    load(spark, path, frames, [TableContract(t, "append") for t in frames], "L1")
    return Dataset(spark, path).sql("SELECT c_mktsegment, count(*) AS n_orders, sum(o_totalprice) AS total "
                                    "FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment")


@workload("load_typed_values", """
SELECT CASE WHEN o_custkey % 5 > 0 THEN o_orderkey + 9007199254740993 END AS big, CAST(o_totalprice AS DECIMAL(12, 3)) AS price,
       CAST(o_orderdate AS DATE) AS day, o_orderdate AS "At Time", o_orderkey % 2 = 0 AS even, epoch_us(o_orderdate) * 1000 + o_orderkey % 1000 AS nanos
FROM orders
""")
def load_typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values beyond 2^53, decimals, dates, times, nanoseconds as a long and NULLs come back as they were (R7 E1 P12), under
    verbatim names (P7)."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.session import scratch_path
    from tableload.sources.dataset import Dataset
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    typed = read(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 5 > 0, k + F.lit(9007199254740993)).alias("big"), F.col("o_totalprice").cast("decimal(12,3)").alias("price"),
        at.cast("date").alias("day"), at.alias("At Time"), (k % 2 == 0).alias("even"),
        (F.unix_micros(at.cast("timestamp")) * 1000 + k % 1000).alias("nanos"))
    path = scratch_path(spark, "typed")
    load(spark, path, {"typed": typed}, [TableContract("typed", "append")], "L1", naming="direct")
    return Dataset(spark, path).table("typed").drop("_load_id", "_row_id")


@workload("verify_landed", """
SELECT 'cursor' AS mode, 0 AS n_problems, 0 AS n_checks UNION ALL SELECT 'plain', 0, 0
UNION ALL SELECT 'twice', (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)), 1
UNION ALL SELECT 'append', 0, 0
""")
def verify_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``verify_load`` over four loads (V2 V4 V7): a merge whose rows are all stale may land nothing, a plain merge and an append
    reconcile, a replace on a key that repeats does not."""
    from tableload.contract import TableContract
    from tableload.plans.load import load
    from tableload.plans.verify_load import verify_load
    from tableload.session import scratch_path
    od = read(spark, sf_dir, "orders")
    older = od.withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
    key = ("o_orderkey",)
    out = []
    for mode, contract, frames in (
            ("cursor", TableContract("orders", "merge", key, cursor="o_orderdate"), (od, older)),
            ("plain", TableContract("orders", "merge", key), (od,)),
            ("twice", TableContract("orders", "replace", ("o_custkey",)), (od,)),
            ("append", TableContract("orders", "append", key), (od, od))):
        path = scratch_path(spark, f"landed-{mode}")
        for i, f in enumerate(frames):
            load(spark, path, {"orders": f}, [contract], f"L{i}")
        out.append(verify_load(spark, path).agg(
            F.lit(mode).alias("mode"), F.count(F.lit(1)).cast("int").alias("n_problems"), F.count_distinct("check").cast("int").alias("n_checks")))
    return M.union_staged(out)
