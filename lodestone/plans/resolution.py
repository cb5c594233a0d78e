"""Queries of matching, nested records, table merges and the drain's states over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import catalogue, text
from lodestone.operators import control, matching, records, tables
from lodestone.plans.catalog import register, t
from lodestone.streaming import drain

_NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_WORDS = "list_filter(string_split({0}, ' '), lambda k: length(k) >= 3 AND NOT regexp_full_match(k, '[0-9]+'))"
_BACKS = "(len(list_filter(string_split({0}, ' '), lambda k: length(k) >= 3 AND contains({1}, k))) > 0 OR len(list_filter(string_split({1}, ' '), lambda k: length(k) >= 3 AND contains({0}, k))) > 0)"


@register(
    "id_validation",
    f"""WITH x AS (SELECT p_partkey, {_NORM.format('p_name')} AS b, {_NORM.format('p_type')} AS q, {_NORM.format("CASE p_partkey % 3 WHEN 0 THEN p_name || ' ' || p_type WHEN 1 THEN p_name || ' box' ELSE 'some ' || p_type END")} AS hay FROM part)
SELECT p_partkey, len(list_filter(string_split(b, ' '), lambda k: length(k) >= 3 AND NOT contains(hay, k))) = 0
 AND 2 * len(list_filter(string_split(q, ' '), lambda k: length(k) >= 3 AND contains(hay, k))) >= len(list_filter(string_split(q, ' '), lambda k: length(k) >= 3)) AS ok FROM x""",
)
def id_validation(s: SparkSession, d: str) -> DataFrame:
    third = F.col("p_partkey") % 3
    listed = F.when(third == 0, F.concat_ws(" ", "p_name", "p_type")).when(third == 1, F.concat("p_name", F.lit(" box"))).otherwise(F.concat(F.lit("some "), "p_type"))
    return t(s, d, "part").select("p_partkey", matching.validates(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")")), listed).alias("ok"))


@register(
    "ladder_match",
    f"""WITH r AS (SELECT p_partkey AS row_id, p_name || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE ' #' || p_size END AS name, 'Set of ' || p_type || CASE WHEN p_partkey % 7 = 0 THEN ' Japanese' ELSE '' END AS console,
 CASE p_partkey % 5 WHEN 0 THEN ' ' || p_partkey WHEN 1 THEN '' ELSE '-3' END AS ext, p_partkey % 8 = 0 AS sealed FROM part),
c AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size::varchar END AS number, p_type AS set_name FROM part WHERE p_partkey % 2 = 0),
rn AS (SELECT *, {_NORM.format('name')} AS n, {_NORM.format('console')} AS k, ltrim(regexp_extract(name, '[0-9]+'), '0') AS num FROM r), cn AS (SELECT *, {_NORM.format('name')} AS n, {_NORM.format('set_name')} AS k FROM c),
m0 AS (SELECT row_id, row_id + 1 AS id FROM r WHERE row_id % 50 = 0),
m1 AS (SELECT row_id, id FROM rn JOIN cn ON id = try_cast(trim(ext) AS bigint) WHERE id > 0 AND len(list_filter(string_split(cn.n, ' '), lambda w: length(w) >= 3 AND NOT contains(rn.n || ' ' || rn.k, w))) = 0),
gate AS (SELECT row_id, id, rn.n AS rn, cn.n AS cn, rn.k AS rk, cn.k AS ck, num, number, sealed FROM rn JOIN cn ON NOT contains(rn.k, 'japanese') AND {_BACKS.format('rn.k', 'cn.k')}),
m2 AS (SELECT row_id, min(id) AS id FROM gate WHERE num <> '' AND num = number AND len({_WORDS.format('rn')}) > 0 AND len(list_filter({_WORDS.format('rn')}, lambda w: NOT contains(cn, w))) = 0 GROUP BY row_id),
m3 AS (SELECT row_id, min(id) AS id FROM gate WHERE num = '' AND NOT sealed AND number IS NULL AND len({_WORDS.format('cn')}) > 0 AND len(list_filter({_WORDS.format('cn')}, lambda w: NOT contains(rn || ' ' || rk, w))) = 0 GROUP BY row_id HAVING min(id) = max(id))
SELECT row_id, coalesce(m0.id, m1.id, m2.id, m3.id) AS id, CASE WHEN m0.id IS NOT NULL THEN 'stamped' WHEN m1.id IS NOT NULL THEN 'tcg-id' WHEN m2.id IS NOT NULL THEN 'fuzzy' WHEN m3.id IS NOT NULL THEN 'numberless' END AS rung
FROM r LEFT JOIN m0 USING (row_id) LEFT JOIN m1 USING (row_id) LEFT JOIN m2 USING (row_id) LEFT JOIN m3 USING (row_id)""",
)
def ladder_match(s: SparkSession, d: str) -> DataFrame:
    p, k = t(s, d, "part"), F.col("p_partkey")
    name = F.concat("p_name", F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(" #"), F.col("p_size").cast("string"))))
    console = F.concat(F.lit("Set of "), "p_type", F.when(k % 7 == 0, F.lit(" Japanese")).otherwise(F.lit("")))
    ext = F.when(k % 5 == 0, F.concat(F.lit(" "), k.cast("string"))).when(k % 5 == 1, F.lit("")).otherwise(F.lit("-3"))
    rows = p.select(k.alias("row_id"), name.alias("name"), console.alias("console"), ext.alias("ext_id"), (k % 8 == 0).alias("sealed"))
    number = F.when(k % 4 != 0, F.col("p_size").cast("string"))
    candidates = p.filter(k % 2 == 0).select(k.alias("id"), k.cast("string").alias("ext_id"), F.col("p_name").alias("name"), number.alias("number"), F.col("p_type").alias("set_name"), F.lit("card").alias("kind"))
    stamped = p.filter(k % 50 == 0).select(k.alias("row_id"), (k + 1).alias("id"))
    return matching.ladder(rows, stamped, candidates).select("row_id", "id", "rung")


@register(
    "vendor_match",
    """WITH c AS (SELECT p_partkey AS card_id, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 1 WHEN p_partkey % 3 = 1 THEN -1 END AS m, p_brand AS number, p_type AS e FROM part), p AS (SELECT p_partkey AS id, p_partkey AS ext, lower(p_brand) AS n, p_type AS e FROM part WHERE p_partkey % 4 <> 1),
a AS (SELECT card_id, min(id) AS id FROM c JOIN p ON m = ext GROUP BY card_id), b AS (SELECT card_id, min(id) AS id FROM c JOIN p ON lower(number) = n AND c.e = p.e WHERE card_id NOT IN (SELECT card_id FROM a) GROUP BY card_id)
SELECT card_id, coalesce(a.id, b.id) AS id FROM c LEFT JOIN a USING (card_id) LEFT JOIN b USING (card_id)""",
)
def vendor_match(s: SparkSession, d: str) -> DataFrame:
    p, k = t(s, d, "part"), F.col("p_partkey")
    market = F.when(k % 3 == 0, F.array(k + 1)).when(k % 3 == 1, F.array(F.lit(-1).cast("long"))).otherwise(F.array().cast("array<long>"))
    cards = p.select(k.alias("card_id"), market.alias("market_ids"), F.col("p_brand").alias("number"), F.col("p_type").alias("expansion"))
    products = p.filter(k % 4 != 1).select(k.alias("id"), k.alias("ext_id"), F.lower("p_brand").alias("number"), F.col("p_type").alias("expansion"))
    return matching.vendor_match(cards, products)


@register(
    "variant_conflicts",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id // 2 * (event_id % 3) END AS k, 'u' || user_id AS card FROM events), n AS (SELECT k, count(*) AS c FROM e WHERE k IS NOT NULL GROUP BY k),
o AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'u' || p_size WHEN p_partkey % 5 = 0 THEN '' END AS owner FROM part)
SELECT event_id, coalesce(n.c, 0) >= 2 OR (coalesce(owner, '') <> '' AND owner <> card) AS conflict FROM e LEFT JOIN n ON e.k = n.k LEFT JOIN o ON e.k = o.k""",
)
def variant_conflicts(s: SparkSession, d: str) -> DataFrame:
    i, k = F.col("event_id"), F.col("p_partkey")
    entries = t(s, d, "events").select("event_id", F.when(i % 9 != 0, F.floor(i / 2) * (i % 3)).alias("market_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("card_id"))
    owners = t(s, d, "part").select(k.alias("market_id"), F.when(k % 2 == 0, F.concat(F.lit("u"), F.col("p_size").cast("string"))).when(k % 5 == 0, F.lit("")).alias("card_id"))
    return matching.routed(entries, owners, "market_id", "card_id").select("event_id", "conflict")


@register(
    "set_mapping",
    """WITH s AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) END AS code, CASE WHEN p_partkey % 3 = 0 THEN 'x' || p_size END AS had FROM part),
e AS (SELECT p_partkey AS pos, 'x' || p_size AS e, p_brand AS code, CASE WHEN p_partkey % 6 = 0 THEN 'Brand#1' END AS other, p_name AS name FROM part WHERE p_partkey % 10 = 0),
codes AS (SELECT lower(code) AS k, e, pos * 2 AS p FROM e UNION ALL SELECT lower(other), e, pos * 2 + 1 FROM e WHERE other IS NOT NULL),
bc AS (SELECT k, arg_max(e, p) AS e FROM codes GROUP BY k), bn AS (SELECT regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS k, arg_max(e, pos) AS e FROM e GROUP BY 1),
m AS (SELECT id, had, coalesce(bc.e, bn.e) AS new FROM s LEFT JOIN bc ON lower(code) = bc.k LEFT JOIN bn ON regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') = bn.k)
SELECT id, coalesce(new, had) AS expansion, CASE WHEN new IS NULL THEN 'missing' WHEN new IS NOT DISTINCT FROM had THEN 'same' WHEN had IS NOT NULL THEN 'updated' ELSE 'mapped' END AS outcome FROM m""",
)
def set_mapping(s: SparkSession, d: str) -> DataFrame:
    p, k = t(s, d, "part"), F.col("p_partkey")
    x = F.concat(F.lit("x"), F.col("p_size").cast("string"))
    sets = p.select(k.alias("id"), F.col("p_name").alias("name"), F.when(k % 2 == 0, F.upper("p_brand")).alias("code"), F.when(k % 3 == 0, x).alias("expansion"))
    expansions = p.filter(k % 10 == 0).select(x.alias("id"), F.col("p_brand").alias("code"), F.when(k % 6 == 0, "Brand#1").alias("other_code"), F.col("p_name").alias("name"), k.alias("pos"))
    return matching.mapped_sets(sets, expansions)


BEST, WORST = "img.best.example", "cdn.worst.example"


@register(
    "source_precedence",
    f"""WITH t AS (SELECT p_partkey AS product_id, CASE p_partkey % 4 WHEN 1 THEN '' WHEN 2 THEN 'https://{WORST}/' || p_partkey WHEN 3 THEN 'https://other.example/' || p_partkey END AS u FROM part),
i AS (SELECT event_id % 700 AS product_id, list('https://' || CASE user_id % 5 WHEN 0 THEN '{BEST.upper()}' WHEN 1 THEN 'other.example' ELSE '{WORST}' END || '/' || event_id ORDER BY event_id) AS l FROM events GROUP BY 1)
SELECT product_id, CASE WHEN l IS NULL THEN u ELSE list_reduce(list_concat([coalesce(u, '')], l), lambda a, x: CASE WHEN contains(lower(x), '{BEST}') THEN x WHEN a = '' THEN x WHEN contains(lower(a), '{WORST}') THEN x ELSE a END) END AS source_url
FROM t FULL JOIN i USING (product_id)""",
)
def source_precedence(s: SparkSession, d: str) -> DataFrame:
    k, i, u = F.col("p_partkey"), F.col("event_id"), F.col("user_id")
    own = F.when(k % 4 == 1, F.lit("")).when(k % 4 == 2, F.concat(F.lit(f"https://{WORST}/"), k.cast("string"))).when(k % 4 == 3, F.concat(F.lit("https://other.example/"), k.cast("string")))
    target = t(s, d, "part").select(k.alias("product_id"), own.alias("source_url"), F.lit(None).cast("string").alias("source"))
    host = F.when(u % 5 == 0, F.lit(BEST.upper())).when(u % 5 == 1, "other.example").otherwise(WORST)
    incoming = t(s, d, "events").select((i % 700).alias("product_id"), F.concat(F.lit("https://"), host, F.lit("/"), i.cast("string")).alias("source_url"), F.lit("x").alias("source"), "event_id")
    return tables.upsert_source(target, incoming, "event_id", BEST, WORST).select("product_id", "source_url")


def _halves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = t(s, d, "events").select("event_id", "user_id", "event_type", "value")
    return e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1")


@register(
    "upsert_match_map",
    """WITH a AS (SELECT user_id::varchar AS row_id, max(event_id) FILTER (WHERE event_type = 'click') AS id, arg_max(event_type, event_id) AS method, min(event_id) FILTER (WHERE event_type = 'error') AS matched_at, max(event_id) AS last_seen_at FROM events WHERE event_id % 2 = 0 AND user_id % 3 <> 0 GROUP BY 1),
b AS (SELECT user_id::varchar AS row_id, arg_max(event_id, event_id) FILTER (WHERE event_type = 'view') AS id, arg_max(event_type, event_id) FILTER (WHERE event_type <> 'view') AS method, min(event_id) FILTER (WHERE event_type = 'view') AS matched_at, max(event_id) AS last_seen_at FROM events WHERE event_id % 2 = 1 GROUP BY 1)
SELECT row_id, coalesce(b.id, a.id) AS id, coalesce(b.method, a.method) AS method, coalesce(a.matched_at, b.matched_at) AS matched_at, coalesce(b.last_seen_at, a.last_seen_at) AS last_seen_at FROM a FULL JOIN b USING (row_id)""",
)
def upsert_match_map(s: SparkSession, d: str) -> DataFrame:
    old, new = _halves(s, d)
    at = lambda kind: F.when(F.col("event_type") == kind, F.col("event_id"))
    row = F.col("user_id").cast("string").alias("row_id")
    target = old.filter("user_id % 3 <> 0").groupBy(row).agg(F.max(at("click")).alias("id"), F.max_by("event_type", "event_id").alias("method"), F.min(at("error")).alias("matched_at"), F.max("event_id").alias("last_seen_at"))
    incoming = new.select(row, at("view").alias("id"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("method"), at("view").alias("matched_at"), F.col("event_id").alias("last_seen_at"), "event_id")
    return tables.TABLES["match_map"].upsert(target, incoming, "event_id")


@register(
    "upsert_repair_and_conflict",
    """WITH a AS (SELECT user_id AS product_id, arg_max(event_type, event_id) AS source_url, count(*) AS attempts FROM events WHERE event_id % 2 = 0 GROUP BY 1), b AS (SELECT user_id AS product_id, arg_max(event_type, event_id) AS source_url FROM events WHERE event_id % 2 = 1 AND user_id % 4 = 0 GROUP BY 1)
SELECT product_id, coalesce(b.source_url, a.source_url) AS source_url, CASE WHEN b.source_url IS NULL THEN a.attempts END AS attempts FROM a FULL JOIN b USING (product_id)""",
)
def upsert_repair_and_conflict(s: SparkSession, d: str) -> DataFrame:
    old, new = _halves(s, d)
    target = old.groupBy(F.col("user_id").alias("product_id")).agg(F.max_by("event_type", "event_id").alias("source_url"), F.count("*").alias("attempts")).withColumns({"mirror_url": F.lit("m"), "last_attempt_at": F.lit(1)})
    incoming = new.filter("user_id % 4 = 0").select(F.col("user_id").alias("product_id"), F.col("event_type").alias("source_url"), "event_id")
    return tables.TABLES["image_repair"].upsert(target, incoming, "event_id").select("product_id", "source_url", "attempts")


@register(
    "replace_name_space",
    """WITH a AS (SELECT p_partkey AS k, 'brand' AS name, p_brand AS value FROM part UNION ALL SELECT p_partkey, '@src.type', p_type FROM part), b AS (SELECT p_partkey AS k, '@src.size' AS name, p_size::varchar AS value FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'other', 'x' FROM part WHERE p_partkey % 3 = 0)
SELECT * FROM a WHERE NOT (starts_with(name, '@src.') AND k % 3 = 0) UNION ALL SELECT * FROM b WHERE starts_with(name, '@src.')""",
)
def replace_name_space(s: SparkSession, d: str) -> DataFrame:
    p = t(s, d, "part").withColumnRenamed("p_partkey", "k")
    rows = lambda df, name, value: df.select("k", F.lit(name).alias("name"), F.col(value).cast("string").alias("value"))
    target = rows(p, "brand", "p_brand").unionByName(rows(p, "@src.type", "p_type"))
    some = p.filter("k % 3 = 0").withColumn("x", F.lit("x"))
    return tables.replaced_groups(target, rows(some, "@src.size", "p_size").unionByName(rows(some, "other", "x")), "k", "name", "src")


def _cards(s: SparkSession, d: str) -> DataFrame:
    """A card for each part: two variants, each with a raw dollar price, a raw yen price and a graded one."""
    money = F.format_string("$%.2f", F.col("p_retailprice"))
    price = lambda kind, cur, company, grade, cond: F.struct(F.lit(kind).alias("type"), F.lit(cond).alias("condition"), F.lit(company).alias("company"), grade.cast("string").alias("grade"), cur.alias("currency"), money.alias("market"), F.create_map(F.lit("days_7"), F.struct(F.col("p_size").cast("double").alias("percent_change"))).alias("trends"))
    cur = F.when(F.col("p_partkey") % 3 == 0, "JPY").when(F.col("p_partkey") % 3 == 1, "EUR").otherwise("usd ")
    many = F.array(price("raw", F.lit(None).cast("string"), None, F.lit(None), " nm"), price("raw", cur, None, F.lit(None), "lp"), price("graded", F.lit(""), "cgs", F.when(F.col("p_size") > 10, 10), None))
    report = F.array(F.struct(F.lit("psa ").alias("company"), F.col("p_size").cast("string").alias("total"), F.array(F.struct(F.lit("10").alias("grade"), F.lit("3").alias("count")), F.struct(F.lit(" ").alias("grade"), F.lit("4").alias("count")), F.struct(F.lit("auth").alias("grade"), F.col("p_size").cast("string").alias("count"))).alias("grades")))
    market = lambda n: F.array(F.struct(F.lit("else").alias("name"), F.lit("1").alias("product_id")), F.struct(F.lit("tcgplayer").alias("name"), n.cast("string").alias("product_id")))
    variant = lambda name, n: F.struct(F.lit(name).alias("name"), market(n).alias("marketplaces"), many.alias("prices"), report.alias("pop_reports"))
    k = F.col("p_partkey")
    body = F.to_json(F.struct(k.cast("string").alias("id"), F.col("p_brand").alias("number"), F.array(variant("normal", k), variant("foil", F.when(k % 2 == 0, k + 1))).alias("variants")))
    return t(s, d, "part").select("p_partkey", F.from_json(body, records.CARD).alias("card"))


_V = "(SELECT 'normal' AS variant, p_partkey AS m, * FROM part UNION ALL SELECT 'foil', CASE WHEN p_partkey % 2 = 0 THEN p_partkey + 1 END, * FROM part)"


@register(
    "card_prices",
    f"""WITH v AS {_V}, x AS (SELECT *, unnest(['raw', 'yen', 'graded']) AS kind FROM v), y AS (SELECT *, CASE WHEN kind <> 'yen' OR p_partkey % 3 = 2 THEN 1.0::double WHEN p_partkey % 3 = 0 THEN 1.0::double / 150 END AS f FROM x WHERE kind <> 'graded' OR p_size > 10)
SELECT p_partkey, m AS market_id, variant, CASE kind WHEN 'raw' THEN 'NM' WHEN 'yen' THEN 'LP' END AS condition, CASE kind WHEN 'graded' THEN 'CGC 10' END AS grade, (kind = 'graded')::int AS is_graded, floor(p_retailprice * f * 100 + 0.5)::bigint AS cents, p_size::double AS trend_7d, CASE WHEN f IS NULL THEN 'unsupported' END AS skipped FROM y""",
)
def card_prices(s: SparkSession, d: str) -> DataFrame:
    found = records.card_prices(_cards(s, d), ["p_partkey"], F.lit(150.0))
    return found.select("p_partkey", "market_id", "variant", "condition", "grade", "is_graded", F.round(F.col("value") * 100).cast("long").alias("cents"), "trend_7d", "skipped")


@register("population_reports", f"WITH v AS {_V} SELECT p_partkey, variant, 'PSA ' || g AS grade, CASE g WHEN '10' THEN 3.0::double ELSE p_size::double END AS count, p_size::double AS total FROM (SELECT *, unnest(['10', 'auth']) AS g FROM v)")
def population_reports(s: SparkSession, d: str) -> DataFrame:
    return records.population(_cards(s, d), ["p_partkey"]).select("p_partkey", "variant", "grade", "count", "total")


@register("variant_entries", f"SELECT p_partkey, p_partkey::varchar AS card_id, p_brand AS number, variant, m AS market_id FROM {_V} WHERE m IS NOT NULL")
def variant_entries(s: SparkSession, d: str) -> DataFrame:
    return records.variant_entries(_cards(s, d), ["p_partkey"]).select("p_partkey", "card_id", "number", "variant", "market_id")


@register(
    "sold_listings",
    """SELECT user_id, CASE WHEN event_id % 2 = 0 THEN 'e' || event_id ELSE user_id || ':' || CASE WHEN event_id % 5 = 0 THEN 'BGS 9.5' ELSE '' END || ':' || (1700000000 + event_id) || ':' || event_id || '.5:0' END AS listing_id, event_type AS title,
CASE WHEN event_id % 5 = 0 THEN 'BGS 9.5' END AS grade, event_id + 0.5::double AS price, (1700000000 + event_id)::bigint AS sold_at FROM events""",
)
def sold_listings(s: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    item = F.struct(F.when(i % 2 == 0, F.concat(F.lit("e"), i.cast("string"))).alias("id"), F.col("event_type").alias("name"), F.when(i % 5 == 0, "bgs").alias("company"), F.when(i % 5 == 0, "9.5").alias("grade"), F.concat(F.lit("$"), i.cast("string"), F.lit(".50")).alias("amount"), ((i + 1700000000) * F.when(i % 3 == 0, 1000).otherwise(1)).cast("string").alias("end_time"))
    body = F.when(i % 3 == 0, F.to_json(F.array(item))).when(i % 3 == 1, F.to_json(F.struct(F.array(item).alias("listings")))).otherwise(F.to_json(F.struct(F.array(item).alias("data"))))
    return records.sold_listings(t(s, d, "events").select("user_id", body.alias("body")), "user_id", "body").select("user_id", "listing_id", "title", "grade", "price", "sold_at")


@register(
    "price_history",
    """SELECT event_id, '2026-01-0' || (event_id % 9 + 1) AS date, 'NM' AS condition, NULL AS grade, event_id::double AS market FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, '2026-01-0' || (event_id % 9 + 1), NULL, 'PSA 9', 2.0 FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, '2026-01-0' || (event_id % 9 + 1), NULL, NULL, 7.0 FROM events WHERE event_id % 2 = 1""",
)
def price_history(s: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    none = F.lit(None).cast("string")
    point = lambda cond, co, g, m: F.struct(cond.alias("condition"), co.alias("company"), g.alias("grade"), m.cast("string").alias("market"))
    points = F.when(i % 2 == 0, F.array(point(F.lit("nm"), none, none, i), point(F.lit("x"), F.lit("psa"), F.lit("9"), F.lit(2))))
    date = F.concat(F.lit("2026/01/0"), (i % 9 + 1).cast("string"), F.lit("T00"))
    body = F.to_json(F.struct(F.array(F.struct(date.alias("date"), F.when(i % 2 == 1, "7").alias("value"), points.alias("prices"))).alias("data")))
    return records.history(t(s, d, "events").select("event_id", body.alias("body")), "event_id", "body").select("event_id", "date", "condition", "grade", "market")


@register(
    "field_census",
    """WITH p AS (SELECT unnest(json_keys(props)) AS name, props FROM events), v AS (SELECT name, json_extract_string(props, '$."' || name || '"') AS v FROM p)
SELECT name, count(*) AS present, min(v) AS sample FROM v WHERE v IS NOT NULL AND v <> '' GROUP BY name""",
)
def field_census(s: SparkSession, d: str) -> DataFrame:
    return records.field_census(t(s, d, "events"), "props").select("name", "present", "sample")


@register(
    "graded_keys",
    """WITH x AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'PSA' WHEN 1 THEN 'BGS' WHEN 2 THEN 'TAG' WHEN 3 THEN 'SGC' ELSE '' END AS co, (p_size % 9 + 12) / 2.0 AS g FROM part)
SELECT p_partkey, CASE WHEN co IN ('', 'TAG') THEN NULL WHEN g = 10 THEN CASE co WHEN 'PSA' THEN 'manual-only-price' WHEN 'BGS' THEN 'bgs-10-price' ELSE 'condition-18-price' END WHEN g = 9.5 THEN 'box-only-price' WHEN g = 9 THEN 'graded-price' WHEN g IN (8, 8.5) THEN 'new-price' WHEN g IN (7, 7.5) THEN 'cib-price' END AS key FROM x""",
)
def graded_keys(s: SparkSession, d: str) -> DataFrame:
    fifth = F.col("p_partkey") % 5
    code = F.when(fifth == 0, " psa").when(fifth == 1, "BGS").when(fifth == 2, "TAG").when(fifth == 3, "SGC").otherwise("")
    return t(s, d, "part").select("p_partkey", catalogue.graded_key(code, ((F.col("p_size") % 9 + 12) / 2).cast("string")).alias("key"))


@register("mint_names", "SELECT p_partkey, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' [Holo]' ELSE '' END AS name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size::varchar END AS number, p_partkey % 7 = 0 AS sealed FROM part")
def mint_names(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    raw = F.concat("p_name", F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" #"), F.col("p_size").cast("string"))), F.when(k % 2 == 0, F.lit(" [Holo]")).otherwise(F.lit("")))
    sealed = F.concat("p_name", F.when(k % 7 == 0, F.lit(" Booster  Box")).otherwise(F.lit(" boosters box")))
    return t(s, d, "part").select(k, catalogue.mint_name(raw).alias("x"), catalogue.is_sealed_mint(sealed, F.lit(0)).alias("sealed")).select(k, "x.name", "x.number", "sealed")


@register("html_sanitise", r"SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'), '<[^>]*>', ' ', 'g'), '[\s\x{00a0}]+', ' ', 'g')) AS plain FROM pages")
def html_sanitise(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "pages").select("page_id", text.plain_text(F.col("html")).alias("plain"))


@register(
    "fetch_outcomes",
    "SELECT event_id, CASE WHEN event_id % 8 = 0 OR event_id % 600 >= 500 THEN 'transient' WHEN event_id % 600 >= 400 OR user_id * 9 < 512 THEN 'permanent' ELSE 'bytes' END AS outcome, event_id % 600 IN (402, 403) AS refused FROM events WHERE event_id % 8 <> 0 UNION ALL SELECT event_id, 'transient', NULL FROM events WHERE event_id % 8 = 0",
)
def fetch_outcomes(s: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_id") % 8 != 0, F.col("event_id") % 600)
    return t(s, d, "events").select("event_id", catalogue.fetch_outcome(status, F.col("user_id") * 9).alias("outcome"), catalogue.is_refusal(status).alias("refused"))


@register(
    "stream_drain",
    """WITH r AS (SELECT event_id AS id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ['k' || user_id % 20, 'j' || event_id % 7] END AS keys, CASE WHEN event_id % 4 = 0 THEN 'pending' WHEN event_id % 4 = 1 THEN 'error' WHEN event_id % 4 = 2 THEN 'processing' ELSE 'complete' END AS status, event_id % 6 AS attempts, 1000000 - event_id * 10 AS last FROM events),
c AS (SELECT * FROM r WHERE status = 'pending' OR (status = 'processing' AND 1000000 - last >= 21600) OR (status = 'error' AND attempts < 5 AND 1000000 - last >= 7200 * (1::bigint << attempts))),
o AS (SELECT id, keys, attempts, CASE WHEN keys IS NULL THEN NULL ELSE list_transform(keys, lambda k: CASE WHEN k IN ('k1', 'k2', 'j3') THEN 3 WHEN k IN ('k3', 'j4') THEN 2 WHEN k IN ('j5', 'k9') THEN 1 ELSE 0 END) END AS w FROM c)
SELECT id, CASE WHEN keys IS NULL THEN 'failed' WHEN list_max(w) = 0 THEN 'complete' WHEN list_contains(w, 3) THEN 'error' WHEN list_contains(w, 2) THEN CASE WHEN attempts + 1 >= 5 THEN 'failed' ELSE 'error' END ELSE 'pending' END AS status,
CASE WHEN keys IS NOT NULL AND list_contains(w, 2) AND NOT list_contains(w, 3) THEN attempts + 1 ELSE attempts END AS attempts FROM o""",
)
def stream_drain(s: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    keys = F.to_json(F.array(F.concat(F.lit("k"), (F.col("user_id") % 20).cast("string")), F.concat(F.lit("j"), (i % 7).cast("string"))))
    status = F.when(i % 4 == 0, "pending").when(i % 4 == 1, "error").when(i % 4 == 2, "processing").otherwise("complete")
    state = t(s, d, "events").select(i.alias("id"), F.col("event_type").alias("event"), F.when(i % 11 == 0, "{broken").otherwise(keys).alias("keys_json"), status.alias("status"), (i % 6).alias("attempts"), i.alias("received_at"), (1000000 - i * 10).alias("last_attempt_at"), F.lit(None).cast("long").alias("completed_at"))
    now = F.lit(1000000)
    taken = drain.claimed(state, now, most=1 << 30)
    everything = [f"k{n}" for n in range(20)] + [f"j{n}" for n in range(7)]
    told = [(k, "refused" if k in ("k1", "k2", "j3") else "transient" if k in ("k3", "j4") else "ok") for k in everything if k not in ("j5", "k9", "k0", "j0")]
    results = s.createDataFrame(told, "key string, outcome string")
    return drain.settled(taken, results, s.createDataFrame([("k0",), ("j0",)], "key string"), now).select("id", "status", "attempts")


@register("month_credits_paid", "SELECT coalesce(sum(CASE WHEN event_type NOT IN ('error', 'view') THEN value END), 0) > 0 AS any_paid, count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS calls FROM events WHERE date_trunc('month', ts) = TIMESTAMP '2024-01-01'")
def month_credits_paid(s: SparkSession, d: str) -> DataFrame:
    e = t(s, d, "events").select(F.col("ts").alias("at"), F.col("value").alias("credits"), (F.col("event_type") == "error").alias("blocked"), (F.col("event_type") != "view").alias("ok"))
    now = F.lit("2024-01-15").cast("timestamp_ntz")
    n = control.month_credits(e.withColumn("credits", F.lit(1).cast("long")), now).select(F.col("used").alias("calls"))
    return n.select((F.col("calls") > 0).alias("any_paid"), "calls")


@register(
    "external_attributes",
    "SELECT p_partkey, '@src.brand' AS name, p_brand AS value FROM part UNION ALL SELECT p_partkey, '@src.both', p_type || ';' || p_size FROM part UNION ALL SELECT p_partkey, '@src.some', 'x' FROM part WHERE p_partkey % 2 = 0",
)
def external_attributes(s: SparkSession, d: str) -> DataFrame:
    some = F.when(F.col("p_partkey") % 2 == 0, " x ").otherwise(" ")
    df = t(s, d, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.array(F.col("p_type"), F.lit(" "), F.col("p_size").cast("string")).alias("both"), some.alias("some"))
    return records.external_attributes(df, "p_partkey", "src", ["brand", "both", "some"])
