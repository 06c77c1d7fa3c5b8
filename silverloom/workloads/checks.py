"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverloom.operators import (
    fk_orphans,
    length_violations,
    pk_violations,
    profile,
    run_suite,
)
from silverloom.sources import read_table
from silverloom.workloads.answers import TABLES
from silverloom.workloads.inputs import table


def q_pk_violations(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "l_linenumber", F.expr("nullif(l_linenumber, 7)")
    )
    return pk_violations(lines, ["l_orderkey", "l_linenumber"])


def q_sentinel_collisions(spark, sf):
    """Rows imputed with one sentinel collide on the key they are meant to fill."""
    parts = table(spark, sf, "part").select(
        F.when(F.col("p_size") > 25, F.concat(F.lit("c"), F.col("p_partkey"))).alias("credit_id")
    )
    return pk_violations(parts.fillna({"credit_id": "0000000000"}), ["credit_id"])


def q_fk_orphans_mixed(spark, sf):
    """References that are narrower integers than the keys they refer to."""
    return q_fk_orphans(spark, sf, "int")


def q_fk_orphans(spark, sf, key_type="bigint"):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(f"CAST(nullif(l_partkey, 1999) AS {key_type})").alias("member_ref")
    )
    return fk_orphans(lines, table(spark, sf, "customer"), {"member_ref": "c_custkey"})


def q_length_violations(spark, sf):
    return length_violations(
        table(spark, sf, "part"), {"p_name": 9, "p_brand": 7}, keys=["p_partkey"]
    )


def q_profile(spark, sf):
    tables = {name: (lambda n=name: table(spark, sf, n)) for name in (*TABLES, "missing")}
    return profile(spark, tables).select(
        "table_name", "status", "row_count", F.col("error").isNotNull().alias("has_error")
    )


def q_profile_content(spark, sf):
    """Schema and sample of two tables, each a single row so that the sample is fixed."""
    first = {
        "nation": lambda: table(spark, sf, "nation").orderBy("n_nationkey").limit(1),
        "supplier": lambda: table(spark, sf, "supplier")
        .agg(F.max("s_suppkey").alias("last"), F.count(F.lit(1)).alias("suppliers")),
    }
    return profile(spark, first).select("table_name", "row_count", "table_schema", "sample")


def q_query_suite(spark, sf):
    orders = f"parquet.`{sf.rstrip('/')}/orders.parquet`"
    report = run_suite(
        spark,
        {
            "by_status": f"SELECT o_orderstatus, count(*) AS n FROM {orders}"
            " GROUP BY o_orderstatus ORDER BY o_orderstatus",
            "broken": f"SELECT no_such_column FROM {orders}",
            "many": f"SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey",
        },
    )
    # The answer itself is compared where its order is fixed.
    result = F.when(F.col("query") == "by_status", F.col("result"))
    return report.select("query", "status", "rows_shown", "truncated", result.alias("result"))


def q_open_table(spark, sf):
    customers = read_table(spark, f"{sf.rstrip('/')}/customer.parquet")
    return customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


QUERIES = {
    "pk_violations": q_pk_violations,
    "sentinel_collisions": q_sentinel_collisions,
    "fk_orphans": q_fk_orphans,
    "fk_orphans_mixed": q_fk_orphans_mixed,
    "length_violations": q_length_violations,
    "profile": q_profile,
    "profile_content": q_profile_content,
    "query_suite": q_query_suite,
    "open_table": q_open_table,
}

SQL = {
    "pk_violations": """
        SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber,
               CASE WHEN nullif(l_linenumber, 7) IS NULL THEN 'null' ELSE 'duplicate' END AS violation,
               count(*) AS row_count
        FROM lineitem GROUP BY ALL
        HAVING count(*) > 1 OR nullif(l_linenumber, 7) IS NULL""",
    "sentinel_collisions": """
        SELECT '0000000000' AS credit_id, 'duplicate' AS violation, count(*) AS row_count
        FROM part WHERE p_size <= 25 HAVING count(*) > 1""",
    "fk_orphans": """
        SELECT l_orderkey, l_linenumber, l_partkey AS member_ref FROM lineitem
        WHERE l_partkey <> 1999 AND l_partkey NOT IN (SELECT c_custkey FROM customer)""",
    "length_violations": """
        SELECT p_partkey, 'p_name' AS column_name, 9 AS max_length,
               CAST(length(p_name) AS INTEGER) AS length FROM part WHERE length(p_name) > 9
        UNION ALL
        SELECT p_partkey, 'p_brand', 7, CAST(length(p_brand) AS INTEGER) FROM part
        WHERE length(p_brand) > 7""",
    "profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'success' AS status, count(*) AS row_count,"
        f" false AS has_error FROM {t}"
        for t in TABLES
    )
    + " UNION ALL SELECT 'missing', 'error', NULL, true",
    "profile_content": """
        SELECT 'nation' AS table_name, 1::BIGINT AS row_count,
               'struct<n_nationkey:' || CASE typeof(n_nationkey) WHEN 'INTEGER' THEN 'int' ELSE 'bigint' END
               || ',n_name:string,n_regionkey:'
               || CASE typeof(n_regionkey) WHEN 'INTEGER' THEN 'int' ELSE 'bigint' END || '>' AS table_schema,
               '[{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":'
               || n_regionkey || '}]' AS sample
        FROM (SELECT * FROM nation ORDER BY n_nationkey LIMIT 1)
        UNION ALL SELECT 'supplier', 1, 'struct<last:bigint,suppliers:bigint>',
               '[{"last":' || max(s_suppkey) || ',"suppliers":' || count(*) || '}]' FROM supplier""",
    "query_suite": """
        WITH n AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)
        SELECT 'by_status' AS query, 'success' AS status,
               CAST(least(20, count(*)) AS INTEGER) AS rows_shown, count(*) > 20 AS truncated,
               '[' || string_agg('{"o_orderstatus":"' || s || '","n":' || n || '}', ',' ORDER BY s)
               || ']' AS result FROM n
        UNION ALL SELECT 'broken', 'error', NULL, NULL, NULL
        UNION ALL SELECT 'many', 'success', CAST(least(20, count(DISTINCT o_custkey)) AS INTEGER),
                         count(DISTINCT o_custkey) > 20, NULL FROM orders""",
    "open_table": """
        SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment""",
}
SQL["fk_orphans_mixed"] = f"""
    SELECT * REPLACE (CAST(member_ref AS INTEGER) AS member_ref) FROM ({SQL['fk_orphans']})"""
