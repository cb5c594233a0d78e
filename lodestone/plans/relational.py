"""Relational queries of the catalogue engine over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import money, text
from lodestone.operators import matching, stats
from lodestone.operators.merge import merge
from lodestone.plans.catalog import register, t


def newest(events: DataFrame) -> Column:
    """The latest time as a literal, so that filters by it reach the scan."""
    return F.lit(events.agg(F.max("ts").cast("string")).first()[0]).cast("timestamp_ntz")


@register("orphan_filter_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def orphan_filter_semi(s: SparkSession, d: str) -> DataFrame:
    returned = t(s, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")
    o = t(s, d, "orders")
    return o.join(returned, o["o_orderkey"] == returned["l_orderkey"], "left_semi").select("o_orderkey", "o_custkey")


@register("unhashed_anti", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def unhashed_anti(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "documents").join(t(s, d, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id", "lang")


@register(
    "not_exists_fresh",
    """SELECT DISTINCT user_id, event_type FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type
AND f.ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY)""",
)
def not_exists_fresh(s: SparkSession, d: str) -> DataFrame:
    e = t(s, d, "events").select("user_id", "event_type", "ts")
    fresh = e.filter(F.col("ts") > newest(e) - F.expr("interval 7 days")).select("user_id", "event_type")
    return e.select("user_id", "event_type").distinct().join(fresh, ["user_id", "event_type"], "left_anti")


@register("watched_distinct", "SELECT DISTINCT n_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT'")
def watched_distinct(s: SparkSession, d: str) -> DataFrame:
    urgent = t(s, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    who = t(s, d, "customer").join(urgent, "c_custkey", "left_semi").select("c_nationkey", "c_mktsegment").distinct()
    return who.join(t(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_mktsegment").distinct()


@register("fk_scalar_lookup", "SELECT o_orderkey, (SELECT c_custkey FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) AS customer FROM orders")
def fk_scalar_lookup(s: SparkSession, d: str) -> DataFrame:
    c = t(s, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("customer"))
    return t(s, d, "orders").join(c, F.col("o_custkey") == F.col("customer"), "left").select("o_orderkey", "customer")


@register("lowest_id_match", "SELECT a.p_partkey, min(b.p_partkey) AS match FROM part a JOIN part b ON lower(a.p_name) = lower(b.p_name) AND a.p_size = b.p_size GROUP BY a.p_partkey")
def lowest_id_match(s: SparkSession, d: str) -> DataFrame:
    p = t(s, d, "part").select("p_partkey", F.lower("p_name").alias("k"), "p_size").filter("k is not null and p_size is not null")
    return p.join(p.groupBy("k", "p_size").agg(F.min("p_partkey").alias("match")), ["k", "p_size"]).select("p_partkey", "match")


TERMS = ["STANDARD", "STAND", "ECONOMY", "PROMO", "LARGE", "MEDIUM", "SMALL", "A", "O"]


@register(
    "longest_term_pref",
    f"SELECT p_partkey, (SELECT term FROM (SELECT unnest({TERMS}) AS term) WHERE contains(upper(p_type), term) ORDER BY length(term) DESC, term LIMIT 1) AS term FROM part",
)
def longest_term_pref(s: SparkSession, d: str) -> DataFrame:
    up = F.upper("p_type")
    ranked = sorted(TERMS, key=lambda x: (-len(x), x))
    return t(s, d, "part").select("p_partkey", F.coalesce(*[F.when(F.contains(up, F.lit(x)), F.lit(x)) for x in ranked]).alias("term"))


@register("first_term_category", "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'blue') THEN 'blue' WHEN contains(lower(p_name), 'red') THEN 'red' WHEN contains(lower(p_name), 'e') THEN 'e' END AS category FROM part")
def first_term_category(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "part").select("p_partkey", F.coalesce(*[F.when(F.contains(F.lower("p_name"), F.lit(x)), F.lit(x)) for x in ("blue", "red", "e")]).alias("category"))


@register(
    "multi_variant_audit",
    "SELECT l_orderkey, l_linenumber, n, sum(n) OVER ()::bigint AS total FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 2)",
)
def multi_variant_audit(s: SparkSession, d: str) -> DataFrame:
    many = t(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 2")
    return many.withColumn("total", F.lit(many.agg(F.sum("n")).first()[0]).cast("long"))


@register("newest_per_group", "SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY o_custkey")
def newest_per_group(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"))


@register(
    "coverage_ratio",
    "SELECT lang, count(*) AS docs, count(l.doc_id) AS labelled, count(l.doc_id) * 1.0::double / count(*) AS share FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY lang",
)
def coverage_ratio(s: SparkSession, d: str) -> DataFrame:
    l = t(s, d, "labels").select("doc_id").distinct().withColumn("y", F.lit(1))  # noqa: E741
    g = t(s, d, "documents").select("doc_id", "lang").join(l, "doc_id", "left").groupBy("lang").agg(F.count("*").alias("docs"), F.count("y").alias("labelled"))
    return g.withColumn("share", F.col("labelled") / F.col("docs"))


@register(
    "month_credit_sum",
    "SELECT event_type, sum(cast(floor(value * 100 + 0.5) AS bigint))::bigint AS cents FROM events WHERE event_type <> 'error' AND date_trunc('month', ts) = (SELECT date_trunc('month', max(ts)) FROM events) GROUP BY event_type",
)
def month_credit_sum(s: SparkSession, d: str) -> DataFrame:
    e = t(s, d, "events")
    return e.filter("event_type <> 'error'").filter(F.col("ts") >= F.date_trunc("month", newest(e))).groupBy("event_type").agg(F.sum(money.cents(F.col("value"))).alias("cents"))


@register("id_range", "SELECT p_brand, min(p_partkey) AS lo, max(p_partkey) AS hi FROM part GROUP BY p_brand")
def id_range(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi"))


@register("median_price", "SELECT l_returnflag, median(l_extendedprice) AS median FROM lineitem GROUP BY l_returnflag")
def median_price(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "lineitem").groupBy("l_returnflag").agg(F.median("l_extendedprice").alias("median"))


@register(
    "mad_fence",
    """WITH m AS (SELECT *, median(value) OVER (PARTITION BY event_type) AS m, count(*) OVER (PARTITION BY event_type) AS n FROM events),
d AS (SELECT *, median(abs(value - m)) OVER (PARTITION BY event_type) AS dev FROM m) SELECT event_id, event_type FROM d WHERE n < 4 OR dev = 0 OR abs(value - m) <= 3.5 * 1.4826 * dev""",
)
def mad_fence(s: SparkSession, d: str) -> DataFrame:
    return stats.fence(t(s, d, "events").select("event_id", "event_type", "value"), "value", ["event_type"]).select("event_id", "event_type")


@register(
    "robust_comp",
    """WITH m AS (SELECT l_partkey, l_quantity AS v, median(l_quantity) OVER w AS m, count(*) OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY l_partkey)),
d AS (SELECT *, median(abs(v - m)) OVER (PARTITION BY l_partkey) AS dev FROM m)
SELECT l_partkey, count(*) AS n, median(v) AS median, min(v) AS low, max(v) AS high, count(*) < 3 OR max(v) - min(v) > 1.5 * median(v) AS low_confidence
FROM d WHERE n < 10 OR dev = 0 OR abs(v - m) <= 3.5 * 1.4826 * dev GROUP BY l_partkey""",
)
def robust_comp(s: SparkSession, d: str) -> DataFrame:
    return stats.robust_summary(t(s, d, "lineitem").select("l_partkey", F.col("l_quantity").alias("v")), "v", ["l_partkey"])


_NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@register(
    "doc_majority_tokens",
    f"""WITH x AS (SELECT DISTINCT conv_id, turn, unnest(string_split({_NORM.format('text')}, ' ')) AS token FROM conversations),
n AS (SELECT conv_id, count(DISTINCT turn) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, token FROM x JOIN n USING (conv_id) WHERE token <> '' GROUP BY conv_id, token, n HAVING count(DISTINCT turn) >= ceil(n / 2.0)""",
)
def doc_majority_tokens(s: SparkSession, d: str) -> DataFrame:
    c = t(s, d, "conversations").select("conv_id", "turn", text.tokens(F.col("text")).alias("tokens"))
    return stats.majority_tokens(c, F.col("tokens"), ["conv_id"], "turn")


@register("contested_keys", "SELECT l_orderkey, l_linenumber, l_partkey, min(l_partkey) OVER w <> max(l_partkey) OVER w AS contested FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber)")
def contested_keys(s: SparkSession, d: str) -> DataFrame:
    l = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.struct("l_orderkey", "l_linenumber").alias("k"))  # noqa: E741
    return matching.conflicts(l, "k", "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "contested")


@register("dedupe_work_items", "SELECT user_id, event_type, cast(ts AS date) AS day, min(event_id) AS owner, count(*) AS n FROM events GROUP BY ALL")
def dedupe_work_items(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.min("event_id").alias("owner"), F.count("*").alias("n"))


@register("row_completion", "SELECT l_orderkey, bool_and(l_linestatus = 'F') AS complete FROM lineitem GROUP BY l_orderkey")
def row_completion(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "lineitem").groupBy("l_orderkey").agg(F.bool_and(F.col("l_linestatus") == "F").alias("complete"))


@register(
    "key_profile",
    """WITH k AS (SELECT unnest(json_keys(props)) AS key, props FROM events), v AS (SELECT key, json_extract_string(props, '$."' || key || '"') AS v FROM k)
SELECT key, count(*) AS present, count(DISTINCT v) AS n_distinct, max(length(v)) AS longest, count(*) FILTER (WHERE regexp_matches(v, '^-?[0-9]+([.][0-9]+)?$')) AS n_numeric FROM v GROUP BY key""",
)
def key_profile(s: SparkSession, d: str) -> DataFrame:
    v = t(s, d, "events").select(F.explode(F.from_json("props", "map<string,string>")).alias("key", "v"))
    return v.groupBy("key").agg(F.count("*").alias("present"), F.countDistinct("v").alias("n_distinct"), F.max(F.length("v")).cast("long").alias("longest"), F.count_if(F.col("v").rlike(r"^-?[0-9]+([.][0-9]+)?$")).alias("n_numeric"))


@register(
    "preferred_subtype",
    """SELECT l_orderkey, l_partkey, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY coalesce(list_position(['R', 'A'], l_returnflag), 999), l_partkey, l_suppkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""",
)
def preferred_subtype(s: SparkSession, d: str) -> DataFrame:
    rank = F.coalesce(F.nullif(F.array_position(F.array(F.lit("R"), F.lit("A")), F.col("l_returnflag")), F.lit(0)), F.lit(999))
    best = t(s, d, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct(rank.alias("r"), "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")).alias("x"))
    return best.select("l_orderkey", "x.l_partkey", "x.l_returnflag")


@register("best_score", "SELECT l_partkey, arg_max(l_suppkey, {'s': c, 'k': -l_suppkey}) AS supplier FROM (SELECT l_partkey, l_suppkey, count(*) AS c FROM lineitem GROUP BY ALL) GROUP BY l_partkey")
def best_score(s: SparkSession, d: str) -> DataFrame:
    c = t(s, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("c"))
    return c.groupBy("l_partkey").agg(F.max_by("l_suppkey", F.struct("c", (-F.col("l_suppkey")).alias("k"))).alias("supplier"))


@register("unique_accept", "SELECT l_orderkey, min(l_suppkey) AS supplier FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1")
def unique_accept(s: SparkSession, d: str) -> DataFrame:
    return stats.unique_accept(t(s, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("supplier")), ["l_orderkey"], "supplier")


@register("first_wins_dedupe", f"SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY {_NORM.format('text')}")
def first_wins_dedupe(s: SparkSession, d: str) -> DataFrame:
    key = F.sha2(text.norm(F.col("text")), 256)
    return t(s, d, "documents").groupBy(key.alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("k")


@register("keyset_page", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(s: SparkSession, d: str) -> DataFrame:
    return stats.keyset_page(t(s, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100, 50)


@register("topk_case_order", "SELECT p_partkey, p_size FROM part ORDER BY CASE WHEN p_size > 40 THEN 0 WHEN p_size > 20 THEN 1 ELSE 2 END, p_partkey DESC LIMIT 250")
def topk_case_order(s: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("p_size") > 40, 0).when(F.col("p_size") > 20, 1).otherwise(2)
    return t(s, d, "part").orderBy(rank, F.col("p_partkey").desc()).limit(250).select("p_partkey", "p_size")


@register(
    "price_unpivot",
    """SELECT l_orderkey, l_linenumber, kind, cast(floor(v * 100 + 0.5) AS bigint) AS cents FROM
(UNPIVOT (SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_extendedprice, l_discount, l_tax INTO NAME kind VALUE v) WHERE v > 0""",
)
def price_unpivot(s: SparkSession, d: str) -> DataFrame:
    l = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")  # noqa: E741
    return l.unpivot(["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_discount", "l_tax"], "kind", "v").filter("v > 0").select("l_orderkey", "l_linenumber", "kind", money.cents(F.col("v")).alias("cents"))


@register("normalise_tokens", f"SELECT p_partkey, {_NORM.format('p_name')} AS norm, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS compact, trim(lower(regexp_replace(split_part(p_brand, '/', 1), '^0+', ''))) AS number FROM part")
def normalise_tokens(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "part").select("p_partkey", text.norm(F.col("p_name")).alias("norm"), text.compact(F.col("p_name")).alias("compact"), text.clean_number(F.col("p_brand")).alias("number"))


@register(
    "language_marker",
    f"""WITH x AS (SELECT doc_id, lang, string_split({_NORM.format('text')}, ' ') AS k FROM documents), m AS (SELECT doc_id, lang, CASE WHEN list_contains(k, 'der') THEN 'der'
WHEN list_contains(k, 'les') THEN 'les' WHEN list_contains(k, 'los') THEN 'los' ELSE 'english' END AS marker FROM x) SELECT doc_id, marker, marker <> coalesce(map {{'de': 'der', 'fr': 'les', 'es': 'los', 'en': 'english'}}[lang], '') AS differs FROM m""",
)
def language_marker(s: SparkSession, d: str) -> DataFrame:
    m = t(s, d, "documents").select("doc_id", "lang", text.language(F.col("text"), ["der", "les", "los"]).alias("marker"))
    want = F.when(F.col("lang") == "de", "der").when(F.col("lang") == "fr", "les").when(F.col("lang") == "es", "los").when(F.col("lang") == "en", "english").otherwise("")
    return m.select("doc_id", "marker", (F.col("marker") != want).alias("differs"))


@register("url_host_class", "SELECT page_id, contains(lower(url), 'example.com') AS ours, nullif(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)?', 1), '^/+', ''), '') AS key FROM pages")
def url_host_class(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "pages").select("page_id", F.contains(F.lower("url"), F.lit("example.com")).alias("ours"), text.url_path_key(F.col("url")).alias("key"))


@register("dollars_to_cents", "SELECT event_id, CASE WHEN floor(value * 100 + 0.5) > 0 THEN cast(floor(value * 100 + 0.5) AS bigint) END AS cents FROM events")
def dollars_to_cents(s: SparkSession, d: str) -> DataFrame:
    c = F.floor(F.col("value") * 100 + 0.5).cast("long")
    shown = F.concat(F.lit("$"), F.format_number((c / 100).cast("decimal(20,2)"), 2), F.lit(" "))
    return t(s, d, "events").select("event_id", money.dollars_to_cents(shown).alias("cents"))


@register(
    "currency_gate",
    """SELECT n_name, count(*) AS n, sum(CASE WHEN n_name = 'JAPAN' THEN cast(floor(c_acctbal * (1.0::double / 150) * 100 + 0.5) AS bigint) WHEN n_regionkey <> 3 THEN cast(floor(c_acctbal * 1.0::double * 100 + 0.5) AS bigint) END)::bigint AS cents,
count(*) FILTER (WHERE n_name <> 'JAPAN' AND n_regionkey = 3) AS skipped FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def currency_gate(s: SparkSession, d: str) -> DataFrame:
    code = F.when(F.col("n_name") == "JAPAN", "JPY").when(F.col("n_regionkey") == 3, "EUR").otherwise("")
    x = t(s, d, "customer").join(t(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("f", money.currency_factor(code, F.lit(150.0)))
    c = F.floor(F.col("c_acctbal") * F.col("f.factor") * 100 + 0.5).cast("long")
    return x.groupBy("n_name").agg(F.count("*").alias("n"), F.sum(c).alias("cents"), F.count_if(F.col("f.reason") == "unsupported").alias("skipped"))


@register("json_tolerant", "SELECT event_id, coalesce(len(json_keys(CASE WHEN event_id % 7 = 0 THEN NULL ELSE props END)), 0)::bigint AS n_keys FROM events")
def json_tolerant(s: SparkSession, d: str) -> DataFrame:
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props"))
    return t(s, d, "events").select("event_id", F.coalesce(F.size(F.map_keys(F.from_json(broken, "map<string,string>"))), F.lit(0)).cast("long").alias("n_keys"))


@register(
    "backoff_due",
    """WITH w AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS attempts, max(epoch(ts))::bigint AS last FROM events GROUP BY user_id), n AS (SELECT max(epoch(ts))::bigint AS now FROM events)
SELECT user_id, attempts, attempts < 5 AND now - last >= 7200 * (1::bigint << least(attempts, 40)::bigint) AS due FROM w, n""",
)
def backoff_due(s: SparkSession, d: str) -> DataFrame:
    e = t(s, d, "events").withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")))
    w = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("attempts"), F.max("sec").alias("last"))
    now = F.lit(e.agg(F.max("sec")).first()[0]).cast("long")
    return w.select("user_id", "attempts", money.backoff_due(F.lit("error"), F.col("attempts"), F.col("last"), now).alias("due"))


@register(
    "upsert_fold",
    """WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events), seed AS (SELECT user_id, event_type, arg_max(value, event_id) AS a, min(value) AS b, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY ALL),
inc AS (SELECT user_id, event_type, arg_max(coalesce(v, -1), event_id) AS last, arg_max(v, event_id) FILTER (WHERE v IS NOT NULL) AS newest, arg_min(v, event_id) FILTER (WHERE v IS NOT NULL) AS oldest, count(*) AS c FROM e WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT user_id, event_type, CASE WHEN inc.c IS NULL THEN a ELSE coalesce(newest, a) END AS a, coalesce(b, oldest) AS b, coalesce(n, 0) + coalesce(c, 0) AS n FROM seed FULL JOIN inc USING (user_id, event_type)""",
)
def upsert_fold(s: SparkSession, d: str) -> DataFrame:
    e = t(s, d, "events").select("event_id", "user_id", "event_type", "value")
    seed = e.filter("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("a"), F.min("value").alias("b"), F.count("*").alias("n"))
    v = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    incoming = e.filter("event_id % 2 = 1").select("user_id", "event_type", "event_id", v.alias("a"), v.alias("b"))
    return merge(seed, incoming, ["user_id", "event_type"], {"a": "new_if_set", "b": "keep_if_set", "n": "counter"}, "event_id")


@register("retention_window", "SELECT event_id, user_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 14 DAY")
def retention_window(s: SparkSession, d: str) -> DataFrame:
    e = t(s, d, "events").select("event_id", "user_id", "ts")
    return e.filter(F.col("ts") > newest(e) - F.expr("interval 14 days")).select("event_id", "user_id")


@register(
    "eav_change_guard",
    """WITH a AS (SELECT p_partkey, md5(p_brand || chr(31) || p_type || chr(31) || p_size) AS h, md5(p_brand || chr(31) || p_type || chr(31) || CASE WHEN p_partkey % 10 = 0 THEN p_size + 1 ELSE p_size END) AS g, * FROM part)
SELECT p_partkey, 'brand' AS name, p_brand AS value FROM a WHERE h <> g UNION ALL SELECT p_partkey, 'type', p_type FROM a WHERE h <> g UNION ALL SELECT p_partkey, 'size', p_size::varchar FROM a WHERE h <> g""",
)
def eav_change_guard(s: SparkSession, d: str) -> DataFrame:
    sep = chr(31)
    p = t(s, d, "part")
    stored = p.select("p_partkey", F.sha2(F.concat_ws(sep, "p_brand", "p_type", F.when(F.col("p_partkey") % 10 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))), 256).alias("old"))
    now = p.withColumn("new", F.sha2(F.concat_ws(sep, "p_brand", "p_type", "p_size"), 256)).join(stored, "p_partkey").filter("not (old <=> new)")
    return now.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").cast("string").alias("size")).unpivot(["p_partkey"], ["brand", "type", "size"], "name", "value")


@register(
    "days_of_order_asof",
    "SELECT o_orderkey, max(event_id) AS event_id FROM orders o LEFT JOIN events e ON e.user_id = o.o_custkey AND e.ts <= o.o_orderdate GROUP BY o_orderkey",
)
def days_of_order_asof(s: SparkSession, d: str) -> DataFrame:
    o = t(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    e = t(s, d, "events").select("event_id", "user_id", "ts")
    return o.join(e, (F.col("user_id") == F.col("o_custkey")) & (F.col("ts") <= F.col("o_orderdate")), "left").groupBy("o_orderkey").agg(F.max("event_id").alias("event_id"))


@register("rank_frame", "SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer")
def rank_frame(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "customer").select("c_custkey", F.rank().over(Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), "c_custkey")).cast("long").alias("place"))


@register("cube_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
