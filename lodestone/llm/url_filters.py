"""URL filters: pattern rules indexed by their rarest literal token; a URL's tokens fetch the few rules worth running.

A rule of several literals is as many rules, so each of the list below has a token. Given rules without one run on every URL.

Two kinds of rule share one index. A site rule (host, path) fits the host and its subdomains where the path starts with
the rule's; of the fitting ones the longest decides. Where none fits, pattern rules decide: a block pattern that matches
blocks unless an allow pattern matches too. Every rule becomes a regular expression over ``host + path`` (site rules) or
over the lower-cased URL (patterns), and is filed under that one of its literal tokens which the fewest URLs hold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm.common import lower_ascii, small_batches, table

TOKEN = r"[a-z0-9]+"
#: Rules up to this many travel with the tasks (about 200 bytes each); beyond, URLs meet rules by an equi-join on the token.
CARRIED_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    action: str  #: allow or block
    pattern: str  #: regular expression; of a site rule over host + path
    tokens: tuple[str, ...]  #: whole tokens that every match holds
    label: str | None = None  #: of a site rule: host + path
    length: int = 0


def site_rule(action: str, host: str, path: str) -> Rule:
    whole = re.findall(r"[a-z0-9]+", host.lower())
    inner = re.findall(r"(?<![A-Za-z0-9])[A-Za-z0-9]+(?![A-Za-z0-9]|$)", path)
    return Rule(action, rf"^(?:[^/]*\.)?{re.escape(host.lower())}{re.escape(path)}", tuple(dict.fromkeys([*whole, *(x.lower() for x in inner)])), host.lower() + path, len(host) + len(path))


def pattern_rule(action: str, pattern: str, *tokens: str) -> Rule:
    """tokens: literal tokens bounded by non-alphanumerics in every match; without any, the rule runs on every URL."""
    return Rule(action, pattern, tuple(t.lower() for t in tokens))


SITE_RULES = [
    site_rule("block", "com", "/en/"),
    site_rule("allow", "example.com", "/en/7"),
    site_rule("allow", "net", "/de/"),
    site_rule("block", "example.net", "/de/8"),
    site_rule("block", "org", "/es/"),
]
#: Pages that are seldom prose: logins, feeds, carts, calendars, media files, adult and gambling hosts.
PATTERN_RULES = [
    pattern_rule("block", r"[/.-]casino[/.-]", "casino"),
    pattern_rule("block", r"[/.-]porn[/.-]", "porn"),
    pattern_rule("block", r"[/.-]xxx[/.-]", "xxx"),
    pattern_rule("block", r"/wp-login\.php(?:$|[?#])", "wp", "login", "php"),
    pattern_rule("block", r"/cgi-bin/", "cgi", "bin"),
    pattern_rule("block", r"/signin(?:$|[/?#])", "signin"),
    pattern_rule("block", r"/sign-in(?:$|[/?#])", "sign", "in"),
    pattern_rule("block", r"/cart(?:$|[/?#])", "cart"),
    pattern_rule("block", r"/calendar/[0-9]{4}(?:$|[/?#-])", "calendar"),
    *[pattern_rule("block", rf"[?&]{name}=", name) for name in ("phpsessid", "jsessionid", "sid")],
    *[pattern_rule("block", rf"\.{end}(?:$|[?#])", end) for end in ("jpg", "jpeg", "png", "gif", "zip", "exe", "mp3", "mp4")],
    pattern_rule("block", r"[?&]page=[0-9]{3,}(?:$|[&#])", "page"),
    pattern_rule("block", r"/feed/?(?:$|[?#])", "feed"),
    pattern_rule("allow", r"^https?://(?:www\.)?example\.org/help/", "example", "org", "help"),
]


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, 2**31 - 1), "/", 1))
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, 2**31 - 1))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each token of the rules occurs; as many rows as the rules have tokens reach the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    spark = urls.sparkSession
    small = spark.createDataFrame([(t,) for t in wanted], "token string")
    seen = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("url")), F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
    if len(wanted) <= CARRIED_RULES:
        small = F.broadcast(small)
    return {r["token"]: r["n"] for r in seen.join(small, "token").groupBy("token").agg(F.count("*").alias("n")).collect()}


def index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by their rarest token, and those of rules without a token."""
    by: dict[str, list[int]] = {}
    free = []
    for i, r in enumerate(rules):
        if r.tokens:
            by.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            free.append(i)
    return by, free


VERDICT = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()), T.StructField("rules_run", T.LongType())])


def _decide(rules: list[Rule], fit: list[int]) -> tuple[str | None, str]:
    sites = [rules[i] for i in fit if rules[i].label]
    if sites:
        best = max(sites, key=lambda r: (r.length, r.label, r.action))
        return best.label, best.action
    actions = {rules[i].action for i in fit}
    return None, "block" if actions == {"block"} else "allow"


def judge(pages: DataFrame, rules: list[Rule] | None = None, carried: int = CARRIED_RULES) -> DataFrame:
    """pages (url, ...) with host, path, rule, verdict and rules_run; all other columns and rows stay, in any number.

    A null URL or one without ``://`` has an empty host and path and no site rule; no pattern matches null, so the
    verdict is allow. Columns of pages that bear one of the added names are replaced. An empty table gives an empty one.
    """
    rules = SITE_RULES + PATTERN_RULES if rules is None else rules
    spark = pages.sparkSession
    small_batches(spark, 4096)
    base = pages.drop("rule", "verdict", "rules_run").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    by, free = index(rules, token_counts(pages, rules))
    if len(rules) > carried:
        return _joined(base, rules, by, free)
    find, compiled = re.compile(TOKEN).findall, [re.compile(r.pattern) for r in rules]

    @F.pandas_udf(VERDICT)
    def run(url: pd.Series, site: pd.Series) -> pd.DataFrame:
        out = []
        for u, s in zip(url, site, strict=True):
            if u is None:
                out.append((None, "allow", 0))
                continue
            picked = [i for t in dict.fromkeys(find(u)) for i in by.get(t, ())] + free
            fit = [i for i in picked if compiled[i].search(s if rules[i].label else u)]
            out.append((*_decide(rules, fit), len(picked)))
        return pd.DataFrame(out, columns=["rule", "verdict", "rules_run"])

    judged = base.withColumn("_v", run(lower_ascii(F.col("url")), F.concat("host", "path")))
    return judged.select(*base.columns, "_v.rule", "_v.verdict", "_v.rules_run")


def _joined(base: DataFrame, rules: list[Rule], by: dict[str, list[int]], free: list[int]) -> DataFrame:
    """For rule lists of any length: distinct URLs meet the rules by an equi-join on the token, and the verdict comes back by URL."""
    spark = base.sparkSession
    rows = [(t, i) for t, ids in by.items() for i in ids]
    table_ = spark.createDataFrame([(t, i, rules[i].pattern, rules[i].label, rules[i].length, rules[i].action) for t, i in rows], "token string, i long, pattern string, label string, length long, action string")
    urls = base.select("url", F.concat("host", "path").alias("site"), lower_ascii(F.col("url")).alias("low")).filter("url is not null").distinct()
    tokens = urls.withColumn("token", F.explode(F.array_distinct(F.regexp_extract_all("low", F.lit(f"({TOKEN})"), F.lit(1)))))
    hits = tokens.join(table_, "token").select("url", "site", "low", "i", "pattern", "label", "length", "action")
    for i in free:
        r = rules[i]
        hits = hits.union(urls.select("url", "site", "low", *(F.lit(x).cast(k) for x, k in ((i, "long"), (r.pattern, "string"), (r.label, "string"), (r.length, "long"), (r.action, "string")))))
    fit = F.when(F.col("label").isNotNull(), F.expr("rlike(site, pattern)")).otherwise(F.expr("rlike(low, pattern)"))
    best = hits.withColumn("fit", fit).groupBy("url").agg(
        F.max(F.when(F.col("fit") & F.col("label").isNotNull(), F.struct("length", "label", "action"))).alias("s"),
        F.bool_or(F.col("fit") & (F.col("action") == "block")).alias("b"),
        F.bool_or(F.col("fit") & (F.col("action") == "allow")).alias("a"),
        F.count("*").alias("rules_run"),
    )
    out = base.join(best, "url", "left")
    verdict = F.coalesce(F.col("s.action"), F.when(F.coalesce(F.col("b"), F.lit(False)) & ~F.coalesce(F.col("a"), F.lit(False)), "block").otherwise("allow"))
    return out.select(*base.columns, F.col("s.label").alias("rule"), verdict.alias("verdict"), F.coalesce("rules_run", F.lit(0)).alias("rules_run"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    fits = ", ".join(f"CASE WHEN regexp_matches(host || path, {quoted(r.pattern)}) THEN {{'n': {r.length}, 'label': {quoted(r.label)}, 'action': '{r.action}'}} END" for r in SITE_RULES)
    hit = {a: " OR ".join(f"regexp_matches(low, {quoted(r.pattern)})" for r in PATTERN_RULES if r.action == a) for a in ("block", "allow")}
    lower = f"translate(%s, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"
    return f"""
WITH a AS (SELECT page_id, {lower % 'url'} AS low, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
b AS (SELECT page_id, low, coalesce({lower % "regexp_extract(rest, '^[^/?#]*')"}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1), '') AS path FROM a),
c AS (SELECT *, list_max(list_filter([{fits}], lambda x: x IS NOT NULL)) AS best FROM b)
SELECT page_id, host, path, best.label AS rule, coalesce(best.action, CASE WHEN ({hit['block']}) AND NOT ({hit['allow']}) THEN 'block' ELSE 'allow' END) AS verdict FROM c"""


QUERIES = {"op6_url_filters": op6_url_filters}
ORACLE = {"op6_url_filters": _sql()}
