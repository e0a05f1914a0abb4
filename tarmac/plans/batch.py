"""Batch analytics queries on ``lineitem`` (AGG1-AGG9, AGG12-AGG14, FLT1-FLT5, PRJ9-PRJ10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import metrics as M
from tarmac.operators.profile import missing_audit, profile
from tarmac.plans.registry import register, sql_round, sql_unit
from tarmac.plans.tables import LINEITEM_MEASURES, events, lineitem, returned, ship_month, with_nullable_tax

# Parameters of the registered queries (the reference's CLI defaults map to these).
MONTH = 3
SUPPLIER = 1
TOP_N = 10


def _li_month(spark, sf_dir):
    return lineitem(spark, sf_dir).withColumn("month", ship_month())


@register("delays_by_month", "AGG1", headline=True, sql="""
SELECT month(l_shipdate)::INTEGER AS month, count(*) AS DelayedFlightsNum
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY 1
""")
def delays_by_month(spark, sf_dir):
    return M.count_by(_li_month(spark, sf_dir), "month", returned())


@register("delays_by_supplier", ("AGG1", "FLT1", "SRT1"), headline=True, sql="""
SELECT l_suppkey, count(*) AS DelayedFlightsNum
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY 1
""")
def delays_by_supplier(spark, sf_dir):
    return M.count_by(lineitem(spark, sf_dir), "l_suppkey", returned())


@register("delays_by_dimension", ("AGG1", "FLT1"), headline=True, sql="""
SELECT CASE WHEN grouping(month) = 0 THEN 'month' WHEN grouping(l_suppkey) = 0 THEN 'l_suppkey'
            ELSE 'l_linestatus' END AS dimension,
       CASE WHEN grouping(month) = 0 THEN month::VARCHAR WHEN grouping(l_suppkey) = 0 THEN l_suppkey::VARCHAR
            ELSE l_linestatus END AS value,
       count(*) AS DelayedFlightsNum
FROM (SELECT month(l_shipdate)::INTEGER AS month, l_suppkey, l_linestatus FROM lineitem WHERE l_returnflag = 'R')
GROUP BY GROUPING SETS ((month), (l_suppkey), (l_linestatus))
""")
def delays_by_dimension(spark, sf_dir):
    return M.count_by_dimensions(_li_month(spark, sf_dir), ["month", "l_suppkey", "l_linestatus"], returned())


@register("top_parts_by_delays", ("AGG2", "SRT2", "SRT3"), headline=True, sql=f"""
SELECT l_partkey, count(*) AS DelayedFlightsNum
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
ORDER BY DelayedFlightsNum DESC, l_partkey LIMIT {TOP_N}
""")
def top_parts_by_delays(spark, sf_dir):
    return M.top_n_by(lineitem(spark, sf_dir), "l_partkey", returned(), n=TOP_N)


@register("delays_in_month", ("AGG3", "FLT2"), sql=f"""
SELECT month(l_shipdate)::INTEGER AS month, count(*) AS DelayedFlightsNum
FROM lineitem WHERE l_returnflag = 'R' AND month(l_shipdate) = {MONTH} GROUP BY 1 ORDER BY 1
""")
def delays_in_month(spark, sf_dir):
    return M.count_by(_li_month(spark, sf_dir), "month", returned(), where=[F.col("month") == MONTH])


@register("supplier_delays_in_month", ("AGG3", "FLT2"), sql=f"""
SELECT l_suppkey, count(*) AS DelayedFlightsNum
FROM lineitem WHERE l_returnflag = 'R' AND month(l_shipdate) = {MONTH} GROUP BY 1 ORDER BY 1
""")
def supplier_delays_in_month(spark, sf_dir):
    return M.count_by(_li_month(spark, sf_dir), "l_suppkey", returned(), where=[F.col("month") == MONTH])


@register("monthly_delays_of_supplier", ("AGG4", "FLT3"), sql=f"""
SELECT month(l_shipdate)::INTEGER AS month, count(*) AS DelayedFlightsNum
FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey = {SUPPLIER} GROUP BY 1 ORDER BY 1
""")
def monthly_delays_of_supplier(spark, sf_dir):
    return M.count_by(_li_month(spark, sf_dir), "month", returned(), where=[f"l_suppkey = {SUPPLIER}"])


@register("delayed_rows", ("FLT5", "FLT4"), sql=f"""
SELECT *, month(l_shipdate)::INTEGER AS month FROM lineitem
WHERE l_returnflag = 'R' AND month(l_shipdate) = {MONTH} AND l_suppkey = {SUPPLIER}
""")
def delayed_rows(spark, sf_dir):
    return M.count_by(_li_month(spark, sf_dir), None, returned(),
                      where=[f"month = {MONTH}", f"l_suppkey = {SUPPLIER}"])


@register("quantity_stats_by_supplier", ("AGG5", "PRJ11"), headline=True, sql=f"""
SELECT l_suppkey,
       {sql_round('avg(l_quantity)')} AS average_l_quantity,
       {sql_round('min(l_quantity)')} AS min_l_quantity,
       {sql_round('max(l_quantity)')} AS max_l_quantity,
       {sql_round('stddev_samp(l_quantity)')} AS stddev_l_quantity,
       count(*) AS total_records
FROM lineitem GROUP BY 1 ORDER BY total_records DESC, l_suppkey
""")
def quantity_stats_by_supplier(spark, sf_dir):
    return M.group_stats(lineitem(spark, sf_dir), "l_suppkey", "l_quantity")


@register("price_summary", "AGG6", sql=f"""
SELECT {sql_round('min(l_extendedprice)', 6)} AS min_l_extendedprice,
       {sql_round('max(l_extendedprice)', 6)} AS max_l_extendedprice,
       {sql_round('avg(l_extendedprice)', 6)} AS mean_l_extendedprice,
       {sql_round('stddev_samp(l_extendedprice)', 6)} AS stddev_l_extendedprice
FROM lineitem
""")
def price_summary(spark, sf_dir):
    # Rounded to 6 places so that the last bit of a double sum, which depends
    # on summation order, cannot make two engines disagree.
    return M.summary(lineitem(spark, sf_dir), "l_extendedprice", scale=6)


@register("labelled_means_by_month", "AGG7", sql=f"""
SELECT month(l_shipdate)::INTEGER AS month,
       {sql_round('avg(l_quantity)')} AS avg_l_quantity,
       {sql_round('avg(l_discount)')} AS avg_l_discount
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY 1
""")
def labelled_means_by_month(spark, sf_dir):
    return M.avg_by_period(_li_month(spark, sf_dir), "month", ["l_quantity", "l_discount"], returned())


@register("top_price_by_supplier_status", "AGG8", sql=f"""
SELECT l_suppkey, l_linestatus, {sql_round('avg(l_extendedprice)')} AS avg_l_extendedprice
FROM lineitem GROUP BY 1, 2 ORDER BY avg_l_extendedprice DESC, l_suppkey, l_linestatus LIMIT {TOP_N}
""")
def top_price_by_supplier_status(spark, sf_dir):
    return M.avg_by_keys(lineitem(spark, sf_dir), ["l_suppkey", "l_linestatus"], "l_extendedprice", n=TOP_N)


def _contrast_sql() -> str:
    cols = []
    for m in LINEITEM_MEASURES:
        cols.append(f"{sql_round(f'avg(CASE WHEN l_returnflag = {chr(39)}R{chr(39)} THEN {m} END)')} AS avg_{m}_delayed")
        cols.append(f"{sql_round(f'avg(CASE WHEN l_returnflag <> {chr(39)}R{chr(39)} THEN {m} END)')} AS avg_{m}_on_time")
    return "SELECT " + ",\n       ".join(cols) + "\nFROM lineitem"


@register("label_contrast", "AGG9", headline=True, sql=_contrast_sql())
def label_contrast(spark, sf_dir):
    return M.contrast(lineitem(spark, sf_dir), returned(), LINEITEM_MEASURES)


def _audit_sql() -> str:
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    parts = []
    for c in cols:
        target = "nullif(l_tax, 0.0)" if c == "l_tax" else c
        parts.append(f"count(*) FILTER (WHERE {target} IS NULL) AS {c}")
    return "SELECT " + ", ".join(parts) + " FROM lineitem"


@register("missing_audit", "PRJ9", headline=True, sql=_audit_sql())
def missing_values(spark, sf_dir):
    return missing_audit(with_nullable_tax(lineitem(spark, sf_dir)))


@register("table_profile", "PRJ10", sql="""
SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem
""")
def table_profile(spark, sf_dir):
    return profile(lineitem(spark, sf_dir))


@register("class_balance", "AGG12", sql="""
SELECT n_positive, n_negative, n_positive + n_negative AS n_labelled,
       CASE WHEN n_negative > 0 THEN least(1.0, 3.0 * n_positive / n_negative) END AS sample_fraction,
       n_negative::double / n_positive AS imbalance
FROM (SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS n_positive,
             count(*) FILTER (WHERE l_returnflag <> 'R') AS n_negative FROM lineitem)
""")
def class_balance(spark, sf_dir):
    return M.class_balance(lineitem(spark, sf_dir), returned(), ratio=3.0)


@register("distinct_users", "AGG13", sql="""
SELECT count(DISTINCT user_id) AS n_distinct FROM events
""")
def distinct_users(spark, sf_dir):
    return M.distinct_count(events(spark, sf_dir), "user_id")


@register("user_list", ("AGG13", "SRT1"), sql="""
SELECT DISTINCT user_id FROM events ORDER BY user_id
""")
def user_list(spark, sf_dir):
    return M.distinct_values(events(spark, sf_dir), "user_id")


@register("event_preview", "AGG14", sql=f"""
SELECT * FROM events ORDER BY {sql_unit('event_id', 42)}, event_id LIMIT 5
""")
def event_preview(spark, sf_dir):
    return M.preview(events(spark, sf_dir), 5, "event_id", seed=42, method="md5")
