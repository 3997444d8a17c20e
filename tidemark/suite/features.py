"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.operators.clean import clean_catalog
from tidemark.suite import inputs
from tidemark.suite.inputs import CATALOG_SQL, CLEAN_SQL
from tidemark.suite.registry import query

_SEASON = "CASE season WHEN 'Spring' THEN 0 WHEN 'Summer' THEN 1 WHEN 'Fall' THEN 2 WHEN 'Winter' THEN 3 ELSE -1 END"
# runs of characters that are not white space in the Unicode sense
_WORDS = r"len(regexp_extract_all({0}, '[^\t-\r \x{{85}}\p{{Z}}]+'))"


@query("features_catalog", f"""WITH {CLEAN_SQL}
SELECT id, gender, masterCategory, subCategory, articleType, baseColour, season, usage, productDisplayName,
  2026 - year AS product_age_years, CAST(length(productDisplayName) AS INTEGER) AS name_length,
  CAST({_WORDS.format('productDisplayName')} AS INTEGER) AS name_word_count, {_SEASON} AS season_code,
  round(count(*) OVER (PARTITION BY articleType)::DOUBLE / count(*) OVER (), 12) AS articleType_freq_encoded,
  gender = 'Boys' AS gender_Boys, gender = 'Girls' AS gender_Girls, gender = 'Men' AS gender_Men,
  gender = 'Unisex' AS gender_Unisex, gender = 'Women' AS gender_Women
FROM clean""")
def features_catalog(spark, sf):
    cleaned = clean_catalog(inputs.raw_catalog(spark, sf), ["delivery"])
    levels = ["Boys", "Girls", "Men", "Unisex", "Women"]
    return features.engineer_catalog(cleaned, gender_levels=levels).withColumn(
        "articleType_freq_encoded", F.round("articleType_freq_encoded", 12))


@query("frequency_encode", """SELECT l_orderkey, l_linenumber, l_partkey,
  round(count(*) OVER (PARTITION BY l_partkey)::DOUBLE / count(*) OVER (), 12) AS part_frequency FROM lineitem""")
def frequency_encode(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return features.frequency_encode(lines, "l_partkey", "part_frequency").withColumn(
        "part_frequency", F.round("part_frequency", 12))


@query("one_hot", """SELECT l_orderkey, l_linenumber, l_returnflag, l_returnflag = 'A' AS l_returnflag_A,
  l_returnflag = 'N' AS l_returnflag_N, l_returnflag = 'R' AS l_returnflag_R FROM lineitem""")
def one_hot(spark, sf):
    return features.one_hot(inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag")


@query("one_hot_sparse", """SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_orderkey) - 1 AS INTEGER) AS index, 1.0::DOUBLE AS value,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS size FROM lineitem""")
def one_hot_sparse(spark, sf):
    """As many levels as there are orders."""
    lines = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    encoded = features.one_hot_sparse(lines, "l_orderkey", "order")
    return features.vector_entries(encoded.rows, "order", ["l_orderkey", "l_linenumber"]).withColumn("size", F.lit(encoded.size).cast("long"))


@query("ordinal_encode", f"WITH {CATALOG_SQL} SELECT id, season, {_SEASON} AS season_code FROM catalog")
def ordinal_encode(spark, sf):
    return inputs.catalog(spark, sf).select(
        "id", "season", features.ordinal_code("season", features.SEASON_CODES).alias("season_code"))


@query("text_features", f"""SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length,
  CAST({_WORDS.format('text')} AS INTEGER) AS text_word_count FROM documents""")
def text_features(spark, sf):
    documents = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return features.text_features(documents, "text", "text").drop("text")


@query("age_from_year", "SELECT o_orderkey, CAST(2026 - year(o_orderdate) AS INTEGER) AS order_age_years FROM orders")
def age_from_year(spark, sf):
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", (F.lit(2026) - F.year("o_orderdate")).alias("order_age_years"))
