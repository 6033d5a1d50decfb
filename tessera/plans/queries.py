"""Registry of checked queries: name -> (spark, sf_dir) -> DataFrame, and the
matching DuckDB oracle SQL.  ``insert_date`` (a run timestamp) is never part
of a compared output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS as _CONTRACTS
from tessera.operators import incremental as inc
from tessera.operators import quality as dq
from tessera.plans import bronze as _bronze
from tessera.plans import landing_queries as lq
from tessera.plans import oracle_sql as osql
from tessera.plans.layers import Layers
from tessera.sources.testdata import raw_orders_revision, raw_tables

QueryFn = Callable[[SparkSession, str], DataFrame]


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(raw_tables(spark, sf_dir))


def _model(name: str, columns: list[str] | None = None) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = layers(spark, sf_dir).model(name)
        if "avg_delivery_time" in df.columns:  # the published interval, in microseconds
            seconds = F.col("avg_delivery_time").cast("interval second").cast("decimal(38,6)")
            df = df.withColumn("avg_delivery_micros", (seconds * 1_000_000).cast("bigint"))
        return df.select(*columns) if columns else df.drop("insert_date")
    run.__name__ = f"q_{name}"
    return run


# query key -> (model, columns or None for "all but insert_date")
MODEL_QUERIES: dict[str, tuple[str, list[str] | None]] = {
    "bronze_orders": ("base_orders", None),
    "bronze_order_items": ("base_orders_items", None),
    "bronze_order_status": ("base_order_status", None),
    "bronze_members": ("base_members", None),
    "bronze_marketing": ("base_marketing", None),
    "bronze_preferences": ("base_preferences", None),
    "silver_dedup_orders": ("stg_orders", None),
    "silver_dedup_members": ("stg_members", None),
    "silver_dedup_campaigns": ("stg_marketing", None),
    "silver_dedup_status": ("stg_order_status", None),
    "silver_filter_items": ("stg_orders_items", None),
    "silver_filter_preferences": ("stg_preferences", None),
    "gold_orders": ("build_orders", None),
    "gold_order_items": ("build_order_items", None),
    "gold_order_status": ("build_order_status", None),
    "gold_member_preferences": ("build_member_preferences", None),
    "mart_gross_revenue": ("mart_gross_revenue", None),
    "mart_popular_items": ("mart_popular_items", None),
    "mart_spending_members": ("mart_spending_members", None),
    "mart_order_processing_times": ("mart_order_processing_times",
                                    ["storeid", "avg_delivery_seconds", "avg_delivery_micros"]),
}




# ---------------------------------------------------------------- data quality


def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.unique(layers(spark, sf_dir).base_members, "memberid")


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.not_null(layers(spark, sf_dir).base_members, "joindate").drop("insert_date")


def q_dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = layers(spark, sf_dir)
    return dq.relationships(L.stg_orders, "memberid", L.stg_members, "memberid").drop("insert_date")


def q_dq_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.non_negative(layers(spark, sf_dir).stg_orders_items, "price").drop("insert_date")


def q_dq_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.after(layers(spark, sf_dir).stg_orders, "orderdate", "'2000-01-01'").drop("insert_date")


def q_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_checks(layers(spark, sf_dir).model)


def _check_sql(c: dq.Check) -> str:
    m, col = c.model, c.column
    if c.test == "unique":
        n = (f"SELECT COUNT(*) FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING COUNT(*) > 1)")
    elif c.test == "not_null":
        n = f"SELECT COUNT(*) FROM {m} WHERE {col} IS NULL"
    elif c.test == "relationships":
        to, fld = c.args["to"], c.args["field"]
        n = (f"SELECT COUNT(*) FROM {m} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {to} pa WHERE pa.{fld} = ch.{col})")
    elif c.test == "positive":
        n = f"SELECT COUNT(*) FROM {m} WHERE {col} < 0"
    else:
        n = f"SELECT COUNT(*) FROM {m} WHERE {col} < CAST({c.args['min']} AS DATE)"
    return (f"SELECT '{c.layer}' AS layer, '{m}' AS model, '{c.test}' AS test_name, "
            f"'{col}' AS column_name, '{c.severity}' AS severity, ({n}) AS failures")


DQ_QUERIES = {
    "dq_unique": (q_dq_unique, osql.with_models(
        "SELECT memberid AS unique_field, COUNT(*) AS n_records FROM base_members "
        "WHERE memberid IS NOT NULL GROUP BY memberid HAVING COUNT(*) > 1")),
    "dq_not_null": (q_dq_not_null, osql.with_models(
        "SELECT * FROM base_members WHERE joindate IS NULL")),
    "dq_relationships": (q_dq_relationships, osql.with_models(
        "SELECT * FROM stg_orders o WHERE o.memberid IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM stg_members m WHERE m.memberid = o.memberid)")),
    "dq_non_negative": (q_dq_non_negative, osql.with_models(
        "SELECT * FROM stg_orders_items WHERE price < 0")),
    "dq_after": (q_dq_after, osql.with_models(
        "SELECT * FROM stg_orders WHERE orderdate < CAST('2000-01-01' AS DATE)")),
    "dq_summary": (q_dq_summary, osql.with_models(
        "\nUNION ALL\n".join(_check_sql(c) for c in dq.DECLARED_CHECKS))),
}


# ---------------------------------------------------------------- incremental

INCREMENTAL_CUTOFF = "2000-01-01"


def _incremental_inputs(spark: SparkSession, sf_dir: str):
    """Target = orders delivered before the cutoff; source = the next delivery."""
    target = layers(spark, sf_dir).base_orders.where(F.col("orderdate") < F.lit(INCREMENTAL_CUTOFF).cast("date"))
    source = _bronze.base_orders(raw_orders_revision(spark, sf_dir))
    return target, source, inc.high_water(target, "orderdate")


def q_incremental_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    _target, source, hw = _incremental_inputs(spark, sf_dir)
    return inc.since(source, "orderdate", hw).drop("insert_date")


def q_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source, hw = _incremental_inputs(spark, sf_dir)
    merged = inc.upsert(target, inc.since(source, "orderdate", hw), "orderid", "orderdate")
    return merged.drop("insert_date")


def q_incremental_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _target, source, hw = _incremental_inputs(spark, sf_dir)
    return inc.load_metrics(source, "orderdate", hw)


_ORDER_COLS = "orderid, memberid, storeid, campaignid, orderdate, subtotal, total, source_name"

INCREMENTAL_QUERIES = {
    "incremental_high_water": (q_incremental_high_water, osql.with_models(
        f"SELECT {_ORDER_COLS} FROM inc_new")),
    "incremental_upsert": (q_incremental_upsert, osql.with_models(
        f"SELECT {_ORDER_COLS} FROM inc_target t WHERE NOT EXISTS "
        f"(SELECT 1 FROM inc_changes c WHERE c.orderid = t.orderid) "
        f"UNION ALL SELECT {_ORDER_COLS} FROM inc_changes")),
    "incremental_late_rows": (q_incremental_late_rows, osql.with_models(
        "SELECT (SELECT MAX(orderdate) FROM inc_target) AS high_water, COUNT(*) AS source_rows, "
        "COUNT(*) FILTER (WHERE orderdate >= (SELECT MAX(orderdate) FROM inc_target)) AS loaded_rows, "
        "COUNT(*) FILTER (WHERE orderdate < (SELECT MAX(orderdate) FROM inc_target)) AS late_rows, "
        "COUNT(*) FILTER (WHERE orderdate IS NULL) AS undated_rows "
        "FROM base_orders_revision")),
}


# ---------------------------------------------------------------- landing


def _profile_sql() -> str:
    parts = []
    for name, c in _CONTRACTS.items():
        for col in c.columns:
            n = col.name
            if col.max_length and col.type == "string":
                long_ = f"COUNT(*) FILTER (WHERE length({n}) > {col.max_length})"
            else:
                long_ = "CAST(0 AS BIGINT)"
            if col.format and col.type == "string":
                fmt = col.format.replace("DD", "%d").replace("MM", "%m").replace("YYYY", "%Y") \
                    .replace("HH24", "%H").replace("MI", "%M").replace("SS", "%S")
                bad = f"COUNT(*) FILTER (WHERE {n} IS NOT NULL AND try_strptime({n}, '{fmt}') IS NULL)"
            elif col.cast_to:
                bad = f"COUNT(*) FILTER (WHERE {n} IS NOT NULL AND TRY_CAST({n} AS {col.cast_to.upper()}) IS NULL)"
            else:
                bad = "CAST(0 AS BIGINT)"
            req = "TRUE" if col.not_null else "FALSE"
            parts.append(
                f"SELECT '{name}' AS table_name, '{n}' AS column_name, COUNT(*) AS row_count, "
                f"COUNT(*) FILTER (WHERE {n} IS NULL) AS null_count, {long_} AS over_length_count, "
                f"{bad} AS bad_value_count, {req} AS req FROM {name}")
    body = "\nUNION ALL\n".join(parts)
    return osql.with_models(
        "SELECT table_name, column_name, row_count, null_count, over_length_count, bad_value_count, "
        "CASE WHEN req AND null_count > 0 THEN 'null in required column' "
        "WHEN over_length_count > 0 THEN 'too long' WHEN bad_value_count > 0 THEN 'bad values' "
        f"ELSE 'ok' END AS status FROM ({body})")


_STREAM_UPSERT_SQL = osql.with_models(
    "SELECT * FROM stream_day1 t WHERE NOT EXISTS (SELECT 1 FROM stream_day2 c WHERE c.orderid = t.orderid) "
    "UNION ALL SELECT * FROM stream_day2")

_REASON = ("CASE WHEN orderid IS NULL THEN 'orderid: required value missing' "
           "ELSE 'orderdate: not a DD/MM/YYYY value' END")

LANDING_QUERIES = {
    "ingest_csv": (lq.q_ingest_csv, osql.with_models(
        "SELECT orderid, memberid, storeid, campaignid, orderdate, subtotal, total "
        "FROM delivered_orders WHERE o_orderstatus <> 'P'")),
    "ingest_csv_split": (lq.q_ingest_csv_split,
                         "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, text, CAST(NULL AS VARCHAR) AS _corrupt_record FROM documents"),
    "ingest_quarantine": (lq.q_ingest_quarantine, osql.with_models(
        "SELECT orderid, memberid, storeid, campaignid, strftime(orderdate, '%Y-%m-%d') AS orderdate, "
        "subtotal, total, " + _REASON + " AS reject_reason FROM delivered_orders WHERE o_orderstatus = 'P'")),
    "ingest_manifest": (lq.q_ingest_manifest, """
SELECT * FROM (VALUES
  ('orders_raw', 'orderid,memberid,storeid,campaignid,orderdate,subtotal,total', TRUE, 'accepted'),
  ('orders_raw', 'total,subtotal,orderdate,campaignid,storeid,memberid,orderid', TRUE, 'accepted'),
  ('preferences_raw', 'orderid,status,statustimestamp', FALSE,
   'columns mismatch: missing [''memberid'', ''preference''], unexpected [''orderid'', ''status'', ''statustimestamp'']'),
  ('members_raw', '', FALSE, 'empty file'), ('stores_raw', 'storeid', FALSE, 'no contract for table stores_raw')
) v(table_name, columns, accepted, reason)"""),
    "bronze_rejects": (lq.q_bronze_rejects, osql.with_models("""
SELECT 'order_status_raw' AS table_name, 'statustimestamp' AS column_name,
       replace(statustimestamp, '/', '.') AS cell, source_name
FROM order_status_raw WHERE status = 'click' AND statustimestamp IS NOT NULL
UNION ALL
SELECT 'members_raw', 'expirationdate',
       strftime(strptime(expirationdate, '%d/%m/%Y'), '%Y-%m-%d'), source_name
FROM members_raw WHERE membershiptype = 'SUSPENDED' AND expirationdate IS NOT NULL
UNION ALL
SELECT 'marketing_raw', 'campaignstartdate', '31/02/2023', source_name
FROM marketing_raw WHERE targetaudience = 'Gold'""")),
    "stream_quarantine": (lq.q_stream_quarantine, osql.with_models(
        "SELECT orderid, memberid, storeid, campaignid, strftime(orderdate, '%Y-%m-%d') AS orderdate, subtotal, total, "
        + _REASON + " AS reject_reason FROM delivered_orders "
        "WHERE o_orderstatus = 'P' AND orderdate < DATE '2000-01-01' "
        "UNION ALL SELECT orderid, memberid, storeid, campaignid, strftime(orderdate + 1, '%Y-%m-%d'), subtotal, "
        "CAST(CAST(subtotal AS DECIMAL(12,2)) + 1 AS VARCHAR), " + _REASON +
        " FROM delivered_orders WHERE o_orderstatus = 'P' "
        "UNION ALL SELECT orderid, memberid, storeid, campaignid, strftime(orderdate, '%Y-%m-%d'), subtotal, "
        "CAST(CAST(subtotal AS DECIMAL(12,2)) + 1 AS VARCHAR), 'late' FROM delivered_orders "
        "WHERE o_orderstatus <> 'P' AND orderdate < (SELECT MAX(orderdate) FROM stream_day1)")),
    "stream_ingest": (lq.q_stream_ingest, osql.with_models(
        "SELECT orderid, status, statustimestamp FROM order_status_raw")),
    "stream_upsert": (lq.q_stream_upsert, _STREAM_UPSERT_SQL),
    "stream_dedup_status": (lq.q_stream_dedup_status, osql.with_models(
        "SELECT orderid, status, statustimestamp FROM stg_order_status")),
    "contract_profile": (lq.q_contract_profile, _profile_sql()),
    "normalize_dates": (lq.q_normalize_dates, """
SELECT orderid, date_format, date_text,
       CASE date_format
         WHEN 'DD/MM/YYYY' THEN strftime(try_strptime(date_text, '%d/%m/%Y'), '%Y-%m-%d')
         WHEN 'MM/DD/YYYY' THEN strftime(try_strptime(date_text, '%m/%d/%Y'), '%Y-%m-%d')
         WHEN 'YYYY-MM-DD' THEN strftime(try_strptime(date_text, '%Y-%m-%d'), '%Y-%m-%d')
       END AS iso_date
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS orderid,
             CASE WHEN o_orderstatus = 'F' THEN 'DD/MM/YYYY' WHEN o_orderstatus = 'O' THEN 'YYYY-MM-DD'
                  ELSE 'MM/DD/YYYY' END AS date_format,
             CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text
      FROM orders)"""),
    "pipeline_incremental_orders": (lq.q_pipeline_incremental_orders, osql.with_models("""
SELECT o.orderid, o.storeid, o.campaignid, o.orderdate, o.subtotal, o.total, o.source_name,
       m.membername, m.membershiptype, m.joindate, m.expirationdate,
       mk.targetaudience, mk.campaignstartdate, mk.campaignenddate
FROM (SELECT * FROM inc_target_stg t WHERE NOT EXISTS (SELECT 1 FROM inc_changes c WHERE c.orderid = t.orderid)
      UNION ALL SELECT * FROM inc_changes) o
LEFT JOIN stg_members m ON o.memberid = m.memberid
LEFT JOIN stg_marketing mk ON o.campaignid = mk.campaignid""")),
    "partition_prune": (lq.q_partition_prune, osql.with_models(
        "SELECT * FROM base_orders WHERE orderdate >= DATE '2000-01-01'")),
}


INCREMENTAL_MARTS = {
    "mart_incremental_revenue": (lq.incremental_mart("mart_gross_revenue"), osql.after_deliveries("mart_gross_revenue")),
    "mart_incremental_items": (lq.incremental_mart("mart_popular_items"), osql.after_deliveries("mart_popular_items")),
    "mart_incremental_spending": (lq.incremental_mart("mart_spending_members"), osql.after_deliveries("mart_spending_members")),
    "mart_incremental_times": (lq.incremental_mart("mart_order_processing_times", ["storeid", "avg_delivery_seconds"]),
                               osql.after_deliveries("mart_order_processing_times", "storeid, avg_delivery_seconds")),
}


# ---------------------------------------------------------------- registry
def _extra_registries() -> list[dict]:
    return [DQ_QUERIES, INCREMENTAL_QUERIES, INCREMENTAL_MARTS, LANDING_QUERIES]


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {k: _model(m, cols) for k, (m, cols) in MODEL_QUERIES.items()}
    for reg in _extra_registries():
        out.update({k: fn for k, (fn, _sql) in reg.items()})
    return out


def oracle() -> dict[str, str]:
    out = {key: osql.model_select(model, ", ".join(cols) if cols else "*")
           for key, (model, cols) in MODEL_QUERIES.items()}
    for reg in _extra_registries():
        out.update({k: sql for k, (_fn, sql) in reg.items() if sql is not None})
    return out
