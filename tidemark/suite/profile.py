"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.suite import inputs
from tidemark.suite.inputs import CATALOG_SQL
from tidemark.suite.registry import query


@query("profile_value_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def value_counts(spark, sf):
    return profile.value_counts(inputs.table(spark, sf, "lineitem"), "l_returnflag")


@query("profile_topn", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 15")
def topn(spark, sf):
    return profile.value_counts(inputs.table(spark, sf, "lineitem"), "l_partkey", top=15)


@query("profile_year_trend", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def year_trend(spark, sf):
    years = inputs.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return profile.value_counts(years, "year", by_value=True)


@query("profile_percent", """SELECT event_type, count(*) AS n,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM events), 9) AS percent FROM events GROUP BY 1""")
def percent(spark, sf):
    return profile.shares(inputs.table(spark, sf, "events"), "event_type", 100.0, "percent").withColumn(
        "percent", F.round("percent", 9))


@query("profile_relative_frequency", f"""WITH {CATALOG_SQL}
SELECT season, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(season) FROM catalog), 12) AS share
FROM catalog WHERE season IS NOT NULL GROUP BY 1""")
def relative_frequency(spark, sf):
    return profile.shares(inputs.catalog(spark, sf), "season").withColumn("share", F.round("share", 12))


@query("profile_crosstab", """SELECT l_shipmonth, CAST(count_if(l_returnflag = 'A') AS BIGINT) AS A, CAST(count_if(l_returnflag = 'N') AS BIGINT) AS N,
  CAST(count_if(l_returnflag = 'R') AS BIGINT) AS R
FROM (SELECT CAST(month(l_shipdate) AS INTEGER) AS l_shipmonth, l_returnflag FROM lineitem) GROUP BY 1""")
def crosstab(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(F.month("l_shipdate").alias("l_shipmonth"), "l_returnflag")
    return profile.cross_table(lines, "l_shipmonth", "l_returnflag")


@query("profile_crosstab_long", "SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2")
def crosstab_long(spark, sf):
    """Any number of levels on both sides."""
    return profile.cross_counts(inputs.table(spark, sf, "lineitem"), "l_partkey", "l_returnflag")


@query("profile_summary", f"""WITH {CATALOG_SQL}
SELECT 'total' AS metric, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM catalog UNION ALL
SELECT 'unique_articleType', NULL, count(DISTINCT articleType) FROM catalog UNION ALL
SELECT 'unique_baseColour', NULL, count(DISTINCT baseColour) FROM catalog UNION ALL
SELECT 'min_year', NULL, CAST(min(year) AS BIGINT) FROM catalog UNION ALL
SELECT 'max_year', NULL, CAST(max(year) AS BIGINT) FROM catalog UNION ALL
SELECT 'masterCategory', masterCategory, count(*) FROM catalog GROUP BY masterCategory UNION ALL
SELECT 'gender', gender, count(*) FROM catalog GROUP BY gender UNION ALL
SELECT 'usage', usage, count(*) FROM catalog WHERE usage IS NOT NULL GROUP BY usage""")
def summary(spark, sf):
    return profile.summary_rows(inputs.catalog(spark, sf), ["articleType", "baseColour"],
                                ["masterCategory", "gender", "usage"], "year")


@query("profile_summary_maps", """SELECT count(*) AS total, count(DISTINCT user_id) AS unique_user_id,
  min(value) AS min_value, max(value) AS max_value,
  (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM (SELECT event_type, count(*) AS n FROM events
    WHERE event_type IS NOT NULL GROUP BY 1)) AS counts FROM events""")
def summary_maps(spark, sf):
    row = profile.summary(inputs.table(spark, sf, "events"), ["user_id"], ["event_type"], "value")
    entries = F.array_sort(F.transform(F.map_entries("event_type_counts"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return row.select("total", "unique_user_id", "min_value", "max_value", F.array_join(entries, ",").alias("counts"))


@query("profile_null_counts", f"""WITH {CATALOG_SQL}
SELECT * FROM (SELECT 'baseColour' AS column_name, count(*) - count(baseColour) AS nulls FROM catalog UNION ALL
SELECT 'season', count(*) - count(season) FROM catalog UNION ALL
SELECT 'year', count(*) - count(year) FROM catalog UNION ALL
SELECT 'usage', count(*) - count(usage) FROM catalog UNION ALL
SELECT 'productDisplayName', count(*) - count(productDisplayName) FROM catalog UNION ALL
SELECT 'id', count(*) - count(id) FROM catalog UNION ALL
SELECT 'gender', count(*) - count(gender) FROM catalog UNION ALL
SELECT 'masterCategory', count(*) - count(masterCategory) FROM catalog UNION ALL
SELECT 'subCategory', count(*) - count(subCategory) FROM catalog UNION ALL
SELECT 'articleType', count(*) - count(articleType) FROM catalog) WHERE nulls > 0""")
def null_counts(spark, sf):
    return profile.null_counts(inputs.catalog(spark, sf), only_present=True)


@query("profile_distinct_count", """SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
  count(DISTINCT l_shipdate) AS l_shipdate FROM lineitem""")
def distinct_count(spark, sf):
    return profile.distinct_count(inputs.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_shipdate"])


@query("profile_range", "SELECT min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value FROM lineitem")
def value_range(spark, sf):
    return profile.value_range(inputs.table(spark, sf, "lineitem"), "l_extendedprice")


@query("profile_median", "SELECT median(l_extendedprice) AS median FROM lineitem")
def median(spark, sf):
    return profile.exact_median(inputs.table(spark, sf, "lineitem"), "l_extendedprice")


@query("profile_conditional_counts", """SELECT CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases,
  CAST(count_if(value > 50) AS BIGINT) AS high_values FROM events""")
def conditional_counts(spark, sf):
    return profile.conditional_counts(inputs.table(spark, sf, "events"), {
        "purchases": F.col("event_type") == "purchase", "high_values": F.col("value") > 50})
