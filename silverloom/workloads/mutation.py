"""Table mutation on customers, parts, suppliers and orders.

Sources get keys by doubling the part key, so that some match the target, some exceed it and
some target keys (the odd ones) stay unmatched, with every row of both tables in use.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from silverloom.operators import (
    Insert,
    Update,
    cascade_delete,
    delete_where,
    insert_if_absent,
    merge,
    scd2_apply,
    scd2_chain,
    scd2_stage,
    update_where,
)
from silverloom.workloads.inputs import table


def _target(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("branch"),
        F.col("c_acctbal").alias("balance"),
    )


def _source(spark, sf):
    return table(spark, sf, "part").select(
        (F.col("p_partkey") * 2).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("branch"),
        F.col("p_retailprice").alias("balance"),
    )


def q_merge_upsert_all(spark, sf):
    return merge(_target(spark, sf), _source(spark, sf), "id")


def q_merge_mixed_keys(spark, sf):
    """The target's keys are narrower integers than the source's."""
    target = _target(spark, sf).withColumn("id", F.col("id").cast("int"))
    return merge(target, _source(spark, sf), "id")


def q_merge_on_conjunct(spark, sf):
    return merge(
        _target(spark, sf), _source(spark, sf), "id", source_condition="s.branch >= 'Brand#2'"
    )


def q_merge_clauses(spark, sf):
    source = _source(spark, sf).withColumnRenamed("id", "source_id")
    return merge(
        _target(spark, sf),
        source,
        {"id": "source_id"},
        matched=[
            Update({"balance": "s.balance", "branch": "'raised'"}, "s.balance > t.balance"),
            Update({"name": "concat(t.name, '/', s.name)"}, "t.branch = 'BUILDING'"),
        ],
        not_matched=[
            Insert({"id": "s.source_id", "name": "s.name", "branch": "'new'", "balance": "null"})
        ],
    )


_TRACKED = ["segment", "zone"]


def _dimension(spark, sf):
    closed = F.col("c_acctbal") < 0
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("string")).alias("zone"),
        (~closed).alias("is_current"),
        F.lit("2020-01-01").alias("valid_from"),
        F.when(closed, "2021-06-30").alias("valid_to"),
    )


def _updates(spark, sf):
    """Customers move to a zone named after their region (some are there already), and
    parts become new members under negative keys."""
    nations = table(spark, sf, "nation")
    moved = (
        table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("title"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_regionkey").cast("string").alias("zone"),
            F.lit("2024-05-01").alias("valid_from"),
        )
    )
    joined = table(spark, sf, "part").select(
        (-1 - F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("segment"),
        F.col("p_type").alias("zone"),
        F.lit("2024-04-01").alias("valid_from"),
    )
    return moved.unionByName(joined)


def q_scd2_apply(spark, sf):
    return scd2_apply(_dimension(spark, sf), _updates(spark, sf), "id", _TRACKED)


def q_scd2_mixed_keys(spark, sf):
    updates = _updates(spark, sf).withColumn("id", F.col("id").cast("decimal(12,2)"))
    return scd2_apply(_dimension(spark, sf), updates, "id", _TRACKED)


def q_scd2_version_chain(spark, sf):
    """Every order moves its customer to a zone on its day: many updates per key, some of them
    before the version that the dimension holds, some on one day, some without effect."""
    dim = _dimension(spark, sf).withColumn("valid_from", F.lit("1995-03-01")).withColumn(
        "valid_to", F.when(~F.col("is_current"), F.lit("1996-09-01"))
    )
    moves = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("title"),
        F.col("o_orderstatus").alias("segment"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.substring("o_orderpriority", 1, 1)).alias("zone"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("valid_from"),
    )
    return scd2_chain(dim, moves, "id", _TRACKED)


def q_merge_ambiguous_free(spark, sf):
    """The source repeats each key; at most one of its rows acts on the target row."""
    source = _source(spark, sf)
    raised = source.withColumn("balance", F.col("balance") + 1e6)
    idle = source.withColumn("balance", F.lit(None).cast("double"))
    return merge(
        _target(spark, sf),
        raised.unionByName(idle).unionByName(idle),
        "id",
        matched=[Update(None, "s.balance > t.balance")],
    )


def q_scd2_null_safe_reopen(spark, sf):
    return scd2_apply(
        _dimension(spark, sf),
        _updates(spark, sf),
        "id",
        _TRACKED,
        null_safe=True,
        reopen_closed=True,
    )


def q_scd2_staged_merge(spark, sf):
    """The same result in two steps: staged rows, then MERGE on the staged key."""
    dim, updates = _dimension(spark, sf), _updates(spark, sf)
    differs = " OR ".join(f"s.{c} <> t.{c}" for c in _TRACKED)
    new_version = {c: f"s.{c}" for c in updates.columns}
    return merge(
        dim,
        scd2_stage(dim, updates, "id", _TRACKED),
        {"id": "merge_key"},
        matched=[
            Update(
                {"is_current": "false", "valid_to": "s.valid_from"},
                f"t.is_current AND ({differs})",
            )
        ],
        not_matched=[Insert(new_version | {"is_current": "true", "valid_to": "null"})],
    )


def q_update_where(spark, sf):
    return update_where(
        table(spark, sf, "part"),
        "nullif(p_size, 30) > 25",
        {"p_retailprice": "p_retailprice * 2", "p_brand": "concat('New', p_brand)"},
    )


def q_delete_where(spark, sf):
    return delete_where(table(spark, sf, "part"), "nullif(p_size, 10) < 20")


def q_cascade_mixed_keys(spark, sf):
    return q_cascade_delete(spark, sf, "int")


def q_cascade_delete(spark, sf, key_type="bigint"):
    orders = table(spark, sf, "orders").withColumn(
        "customer_ref", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast(key_type))
    )
    _, children = cascade_delete(
        table(spark, sf, "customer"),
        "c_custkey",
        "c_mktsegment = 'BUILDING'",
        {"orders": (orders, "customer_ref")},
    )
    return children["orders"].select("o_orderkey", "customer_ref", "o_totalprice")


def q_insert_if_absent(spark, sf):
    existing = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("bigint").alias("first_order"),
    )
    batch = table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").alias("first_order"),
        "o_orderdate",
    )
    return insert_if_absent(existing, batch, "id", ["o_orderdate", "first_order"])


QUERIES = {
    "merge_upsert_all": q_merge_upsert_all,
    "merge_mixed_keys": q_merge_mixed_keys,
    "merge_on_conjunct": q_merge_on_conjunct,
    "scd2_mixed_keys": q_scd2_mixed_keys,
    "cascade_mixed_keys": q_cascade_mixed_keys,
    "merge_clauses": q_merge_clauses,
    "scd2_apply": q_scd2_apply,
    "scd2_null_safe_reopen": q_scd2_null_safe_reopen,
    "scd2_version_chain": q_scd2_version_chain,
    "merge_ambiguous_free": q_merge_ambiguous_free,
    "scd2_staged_merge": q_scd2_staged_merge,
    "update_where": q_update_where,
    "delete_where": q_delete_where,
    "cascade_delete": q_cascade_delete,
    "insert_if_absent": q_insert_if_absent,
}

_FRAMES = """
WITH t AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS branch, c_acctbal AS balance FROM customer),
s AS (
  SELECT p_partkey * 2 AS id, p_name AS name, p_brand AS branch, p_retailprice AS balance FROM part)
"""

_SCD_FRAMES = """
WITH dim AS (
  SELECT c_custkey AS id, c_name AS title, c_mktsegment AS segment,
         CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS VARCHAR) END AS zone,
         NOT (c_acctbal < 0) AS is_current, '2020-01-01' AS valid_from,
         CASE WHEN c_acctbal < 0 THEN '2021-06-30' END AS valid_to
  FROM customer),
upd AS (
  SELECT c_custkey AS id, c_name AS title, c_mktsegment AS segment,
         CAST(n_regionkey AS VARCHAR) AS zone, '2024-05-01' AS valid_from
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT -1 - p_partkey, p_name, p_brand, p_type, '2024-04-01' FROM part),
hit AS (
  SELECT dim.id, upd.title, upd.segment, upd.zone, upd.valid_from
  FROM dim JOIN upd ON dim.id = upd.id WHERE dim.is_current AND ({changed}))
SELECT dim.id, dim.title, dim.segment, dim.zone,
       CASE WHEN hit.id IS NULL THEN dim.is_current ELSE false END AS is_current, dim.valid_from,
       CASE WHEN hit.id IS NULL THEN dim.valid_to ELSE hit.valid_from END AS valid_to
FROM dim LEFT JOIN hit ON dim.id = hit.id
UNION ALL
SELECT id, title, segment, zone, true, valid_from, NULL FROM hit
UNION ALL
SELECT id, title, segment, zone, true, valid_from, NULL FROM upd
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.id = upd.id AND {blocking})
"""

_THREE_VALUED = "upd.segment <> dim.segment OR upd.zone <> dim.zone"

SQL = {
    "merge_upsert_all": _FRAMES
    + """
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)
UNION ALL SELECT s.* FROM s""",
    "merge_on_conjunct": _FRAMES
    + """
SELECT t.id, CASE WHEN s.id IS NULL THEN t.name ELSE s.name END AS name,
       CASE WHEN s.id IS NULL THEN t.branch ELSE s.branch END AS branch,
       CASE WHEN s.id IS NULL THEN t.balance ELSE s.balance END AS balance
FROM t LEFT JOIN s ON t.id = s.id AND s.branch >= 'Brand#2'
UNION ALL
SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id AND s.branch >= 'Brand#2')""",
    "merge_clauses": _FRAMES
    + """
SELECT t.id,
       CASE WHEN NOT s.balance > t.balance AND t.branch = 'BUILDING'
            THEN t.name || '/' || s.name ELSE t.name END AS name,
       CASE WHEN s.balance > t.balance THEN 'raised' ELSE t.branch END AS branch,
       CASE WHEN s.balance > t.balance THEN s.balance ELSE t.balance END AS balance
FROM t LEFT JOIN s ON t.id = s.id
UNION ALL
SELECT s.id, s.name, 'new', NULL FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id)""",
    "scd2_apply": _SCD_FRAMES.format(changed=_THREE_VALUED, blocking="true"),
    "scd2_staged_merge": _SCD_FRAMES.format(changed=_THREE_VALUED, blocking="true"),
    "scd2_null_safe_reopen": _SCD_FRAMES.format(
        changed="upd.segment IS DISTINCT FROM dim.segment OR upd.zone IS DISTINCT FROM dim.zone",
        blocking="dim.is_current",
    ),
    "merge_ambiguous_free": _FRAMES
    + """,
r AS (SELECT id, name, branch, balance + 1e6::DOUBLE AS balance FROM s
      UNION ALL SELECT id, name, branch, NULL FROM s UNION ALL SELECT id, name, branch, NULL FROM s)
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.id = t.id AND r.balance > t.balance)
UNION ALL SELECT r.* FROM r JOIN t ON r.id = t.id AND r.balance > t.balance
UNION ALL SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = r.id)""",
    # Days of a key on which its state is another than on the day before; a closed version ends
    # on its own day unless an order comes first, and the next order after that begins anew.
    "scd2_version_chain": """
WITH dim AS (
  SELECT c_custkey AS id, c_name AS title, c_mktsegment AS segment,
         CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS VARCHAR) END AS zone,
         '1995-03-01' AS valid_from, CASE WHEN c_acctbal < 0 THEN '1996-09-01' END AS ends
  FROM customer),
moves AS (
  SELECT o_custkey AS id, 'Customer ' || o_custkey AS title, o_orderstatus AS segment,
         CASE WHEN o_orderpriority <> '5-LOW' THEN left(o_orderpriority, 1) END AS zone,
         strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS valid_from FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, valid_from
                             ORDER BY title DESC, segment DESC, zone DESC NULLS LAST) = 1),
-- The end of a closed version is a day on which its key has no state.
days AS (
  SELECT *, NULL AS ends, true AS state, 1 AS o FROM moves
  UNION ALL SELECT id, title, segment, zone, valid_from, ends, true, 1 FROM dim
    WHERE NOT EXISTS (SELECT 1 FROM moves m WHERE m.id = dim.id AND m.valid_from = dim.valid_from)
  UNION ALL SELECT id, NULL, NULL, NULL, ends, NULL, false, 0 FROM dim d
    WHERE ends IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM moves m WHERE m.id = d.id AND m.valid_from = d.valid_from)
      AND NOT EXISTS (SELECT 1 FROM moves m WHERE m.id = d.id AND m.valid_from > d.valid_from
                      AND m.valid_from < d.ends
                      AND (m.segment IS DISTINCT FROM d.segment OR m.zone IS DISTINCT FROM d.zone))),
marked AS (
  SELECT *, lag(id) OVER w IS NULL OR (segment, zone, state) IS DISTINCT FROM
              lag((segment, zone, state)) OVER w OR (valid_from = '1995-03-01' AND ends IS NOT NULL)
              AS begins FROM days WINDOW w AS (PARTITION BY id ORDER BY valid_from, o)),
versions AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from, o) AS valid_to FROM marked
  WHERE begins OR EXISTS (SELECT 1 FROM dim WHERE dim.id = marked.id AND dim.title = marked.title
                          AND dim.valid_from = marked.valid_from AND dim.segment = marked.segment))
SELECT id, title, segment, zone, valid_to IS NULL AS is_current, valid_from, valid_to
FROM versions WHERE state""",
    "update_where": """
        SELECT p_partkey, p_name,
               CASE WHEN p_size > 25 AND p_size <> 30 THEN 'New' || p_brand ELSE p_brand END AS p_brand,
               p_type, p_size,
               CASE WHEN p_size > 25 AND p_size <> 30 THEN p_retailprice * 2 ELSE p_retailprice END
                 AS p_retailprice
        FROM part""",
    "delete_where": "SELECT * FROM part WHERE p_size >= 20 OR p_size = 10",
    "cascade_delete": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_ref,
               o_totalprice
        FROM orders
        WHERE o_orderstatus = 'P'
           OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "insert_if_absent": """
        SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS BIGINT) AS first_order FROM supplier
        UNION ALL
        SELECT id, name, first_order FROM (
          SELECT o_custkey AS id, o_orderpriority AS name, o_orderkey AS first_order,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
          FROM orders WHERE o_orderpriority <> '5-LOW')
        WHERE rn = 1 AND id NOT IN (SELECT s_suppkey FROM supplier)""",
}

# The same rows, with the target's narrower key.
SQL["merge_mixed_keys"] = f"""
    SELECT CAST(id AS INTEGER) AS id, * EXCLUDE (id) FROM ({SQL['merge_upsert_all']})"""
SQL["scd2_mixed_keys"] = SQL["scd2_apply"]
SQL["cascade_mixed_keys"] = f"""
    SELECT * REPLACE (CAST(customer_ref AS INTEGER) AS customer_ref)
    FROM ({SQL['cascade_delete']})"""
