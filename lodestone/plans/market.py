"""Queries of listings and attributes over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import attributes, listings
from lodestone.plans.catalog import register, t

_DECIMAL = "trim(regexp_replace(lower({0}), '[^a-z0-9.]+', ' ', 'g'))"


@register(
    "excluded_listings",
    f"""SELECT conv_id, turn, n = '' OR regexp_matches(n, '\\bx\\s?[0-9]+\\b') OR len(list_filter({listings.EXCLUDED}, lambda x: contains(n, x))) > 0 AS excluded
FROM (SELECT conv_id, turn, coalesce({_DECIMAL.format('text')}, '') AS n FROM conversations)""",
)
def excluded_listings(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "conversations").select("conv_id", "turn", listings.excluded(F.col("text")).alias("excluded"))


@register(
    "title_aggregate",
    f"""WITH x AS (SELECT conv_id, turn, list_filter(string_split(trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), ' '),
 lambda w: w <> '' AND NOT list_contains({listings.NOISE}, w) AND NOT regexp_full_match(w, 'x[0-9]{{1,3}}|[0-9]{{1,3}}x')) AS w FROM conversations),
m AS (SELECT conv_id, count(*) AS titles FROM x WHERE len(w) > 0 GROUP BY conv_id),
v AS (SELECT conv_id, token, count(DISTINCT turn) AS c, min({{'t': turn, 'p': p}}) AS spot FROM (SELECT conv_id, turn, unnest(w) AS token, unnest(range(len(w))) AS p FROM x) GROUP BY conv_id, token),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY spot) AS r FROM v JOIN m USING (conv_id) WHERE 2 * c >= titles)
SELECT conv_id, string_agg(token, ' ' ORDER BY r) AS aggregate FROM k WHERE r <= {listings.MOST_TOKENS} GROUP BY conv_id""",
)
def title_aggregate(s: SparkSession, d: str) -> DataFrame:
    return listings.aggregate_titles(t(s, d, "conversations"), "conv_id", "text", "turn")


@register(
    "attribute_rows",
    """SELECT p_partkey, 'Brand' AS name, trim(p_brand) AS value, 0 AS position FROM part WHERE trim(p_brand) <> ''
UNION ALL SELECT p_partkey, 'Size', p_size::varchar, 2 FROM part WHERE p_size IS NOT NULL
UNION ALL SELECT p_partkey, 'Type', trim(p_type), 4 FROM part WHERE trim(p_type) <> ''""",
)
def attribute_rows(s: SparkSession, d: str) -> DataFrame:
    entry = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    markup = F.concat(F.lit("<p>"), F.col("p_type"), F.lit("&nbsp;</p>"))
    entries = F.array(entry("Brand", F.col("p_brand")), entry("Flavor Text", F.col("p_name")), entry("Size", F.col("p_size")), entry("Size", F.lit("again")), entry("Type", markup), entry("@own.key", F.lit("no")))
    return attributes.extract(t(s, d, "part").select("p_partkey", entries.alias("e")), "p_partkey", "e")
