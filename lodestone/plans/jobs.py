"""Queries of whole jobs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import jobs
from lodestone.plans.catalog import register, t
from lodestone.plans.resolution import _cards

_BASE = "https://m.example"


def _images(s: SparkSession, d: str) -> DataFrame:
    """A third of the parts have a mirrored image, another third an address only."""
    key, third = F.col("p_partkey"), F.col("p_partkey") % 3
    rows = t(s, d, "part").filter(third < 2)
    return rows.select(key.alias("product_id"), F.when(third == 1, F.concat(F.lit("https://a.example/"), key.cast("string"))).alias("source_url"), F.lit(None).cast("string").alias("source"), F.when(third == 0, F.concat(F.lit(f"{_BASE}/cards/"), key.cast("string"), F.lit(".jpg"))).alias("mirror_url"), F.when(key % 2 == 0, F.col("p_size")).cast("long").alias("attempts"), F.lit(None).cast("long").alias("last_attempt_at"))


@register(
    "job_url_backfill",
    """SELECT p_partkey AS product_id, CASE WHEN p_partkey % 3 = 0 THEN 'https://m.example/cards/' || p_partkey || '.jpg' WHEN p_partkey % 10 = 0 THEN 'https://m.example/cards/' || p_partkey || '.jpg'
 WHEN p_partkey % 5 = 0 THEN 'https://m.example/cards/' || p_partkey || '.png' END AS mirror_url FROM part WHERE p_partkey % 3 < 2 OR p_partkey % 5 = 0""",
)
def job_url_backfill(s: SparkSession, d: str) -> DataFrame:
    p = t(s, d, "part")
    key = F.col("p_partkey").cast("string")
    objects = p.filter("p_partkey % 5 = 0").select(F.explode(F.array(F.concat(F.lit("cards/"), key, F.lit(".webp")), F.concat(F.lit("cards/"), key, F.lit(".png")), F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("cards/"), key, F.lit(".jpg"))))).alias("key"))
    after, _ = jobs.url_backfill(_images(s, d), p.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("game")), objects.filter("key is not null"), _BASE)
    return after.select("product_id", "mirror_url")


@register(
    "job_url_backfill_summary",
    "SELECT p_brand AS game, count(*) AS checked, count_if(p_partkey % 5 = 0) AS updated, count_if(p_partkey % 5 <> 0) AS skipped FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_brand",
)
def job_url_backfill_summary(s: SparkSession, d: str) -> DataFrame:
    p = t(s, d, "part")
    objects = p.filter("p_partkey % 5 = 0").select(F.concat(F.lit("cards/"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("key"))
    return jobs.url_backfill(_images(s, d), p.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("game")), objects, _BASE)[1]


@register(
    "job_dead_urls",
    """SELECT p_partkey AS product_id, CASE WHEN p_partkey % 3 = 1 AND p_partkey % 4 = 0 THEN 'https://p.example/' || p_partkey || '_in_1000x1000.jpg' WHEN p_partkey % 3 = 1 THEN 'https://a.example/' || p_partkey END AS source_url,
 CASE WHEN p_partkey % 3 = 1 AND p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 3 = 1 AND p_partkey % 4 = 1 THEN 1 WHEN p_partkey % 3 = 1 AND p_partkey % 4 = 2 THEN p_size WHEN p_partkey % 2 = 0 THEN p_size END::bigint AS attempts,
 CASE WHEN p_partkey % 3 = 1 AND p_partkey % 4 = 1 THEN 99 END::bigint AS last_attempt_at FROM part WHERE p_partkey % 3 < 2""",
)
def job_dead_urls(s: SparkSession, d: str) -> DataFrame:
    """Of four addresses one is a placeholder, one dead and two alive."""
    rest = F.col("p_partkey") % 4
    probes = t(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.when(rest == 0, "placeholder").when(rest == 1, "dead").otherwise("alive").alias("verdict"))
    return jobs.dead_urls(_images(s, d), probes, "https://p.example", F.lit(99).cast("long"))[0].select("product_id", "source_url", "attempts", "last_attempt_at")


@register(
    "job_seed_conflicts",
    """SELECT p_partkey::varchar AS card_id, 'foil' AS variant, p_partkey + 1 AS market_id FROM part WHERE p_partkey % 2 = 0 AND p_partkey + 1 IN (SELECT p_partkey FROM part)
UNION ALL SELECT p_partkey::varchar, 'normal', p_partkey FROM part WHERE p_partkey % 2 = 1 AND p_partkey - 1 IN (SELECT p_partkey FROM part)""",
)
def job_seed_conflicts(s: SparkSession, d: str) -> DataFrame:
    """Ids that two cards claim, of a first seeding."""
    cards = _cards(s, d).select(F.lit("g").alias("game"), F.lit("e").alias("expansion"), "card")
    products = s.createDataFrame([], "external_id long, game string, set_id long, name string, number string, rarity string, kind string, card_id string, variant string")
    fresh = s.createDataFrame([], "key string, kind string, updated_at long")
    return jobs.seed_variants(cards, products, fresh, F.lit(1).cast("long"))["conflicts"]


@register(
    "job_graded_comps",
    """WITH x AS (SELECT l_partkey AS slab, l_extendedprice::double AS price, l_shipdate >= DATE '1996-01-01' AS near FROM lineitem WHERE l_linenumber % 3 = 1),
n AS (SELECT slab, count(*) AS n FROM x WHERE near GROUP BY slab), w AS (SELECT slab, count(*) AS n FROM x GROUP BY slab),
u AS (SELECT w.slab, coalesce(n.n, 0) < 5 AND w.n > coalesce(n.n, 0) AS wide FROM w LEFT JOIN n ON n.slab = w.slab),
k AS (SELECT x.slab, price FROM x JOIN u ON u.slab = x.slab WHERE wide OR near), m AS (SELECT slab, median(price) AS m, count(*) AS n FROM k GROUP BY slab),
s AS (SELECT k.slab, median(abs(price - m)) AS d FROM k JOIN m ON m.slab = k.slab GROUP BY k.slab)
SELECT k.slab, count(*) AS n, min(price) AS low, max(price) AS high FROM k JOIN m ON m.slab = k.slab JOIN s ON s.slab = k.slab WHERE n < 10 OR d = 0 OR abs(price - m) <= 3.5 * 1.4826 * d GROUP BY k.slab""",
)
def job_graded_comps(s: SparkSession, d: str) -> DataFrame:
    """Summaries of lines whose titles name the item; others name another one or a lot."""
    kind = F.col("l_linenumber") % 3
    title = F.when(kind == 1, "Red Fox 5 PSA 9").when(kind == 2, "Lot of Red Fox 5 PSA 9").otherwise("Blue Owl 5 PSA 9")
    items = t(s, d, "lineitem").select(F.col("l_partkey").alias("slab"), *[F.lit(v).alias(k) for k, v in (("name", "Red Fox"), ("number", "5"), ("company", "PSA"), ("grade", "9"))], title.alias("title"), F.col("l_extendedprice").cast("double").alias("price"), F.unix_date(F.to_date("l_shipdate")).alias("sold_at"))
    return jobs.graded_comps(items, 9496).select("slab", "n", "low", "high")  # days up to 1996
