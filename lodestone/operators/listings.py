"""Market listings: what is no single item, which item a title names, and matching the titles of a barcode to the catalogue."""

from __future__ import annotations

import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import compact, corroborates, language, let, norm, norm_decimal

# Terms of listings that are no single item.
EXCLUDED = [
    "lot", "lots", "bundle", "bulk", "playset", "set of", "joblot", "job lot",
    "proxy", "custom", "reprint", "reproduction", "repack", "fake", "orica",
    "read description", "parts", "damaged", "creased", "choose", "choice",
    "you pick", "u pick", "pick a card", "digital", "pdf", "sticker", "token",
]
# Words of listings that say nothing of the item.
NOISE = [
    "new", "sealed", "unopened", "nib", "mint", "authentic", "genuine", "official", "oem",
    "brand", "hand", "stock", "ready", "fast", "free", "ship", "ships", "shipped", "shipping",
    "presale", "preorder", "sale", "hot", "rare", "htf", "qty", "pcs", "count", "usa",
    "english", "eng", "edition", "from", "with", "the", "and", "for", "in", "on", "of", "to",
]
# Words that too many items share to search by.
GENERIC = [
    "box", "pack", "packs", "booster", "bundle", "case", "card", "cards", "tcg", "trading",
    "game", "games", "collection", "premium", "deck", "tin", "blister", "display", "factory",
    "elite", "trainer", "starter", "set", "mini", "japanese", "japan",
    "pokemon", "magic", "gathering", "yugioh", "yu", "gi", "oh", "one", "piece", "lorcana",
]
#: The terms that no shorter one lies in.
_TERMS = [x for x in EXCLUDED if not any(y in x for y in EXCLUDED if y != x)]
MOST_TOKENS = 24
SEARCHED = 3
FEWEST = 2
#: Latin letters with marks and the letters without, by Unicode's decomposition.
_MARKED = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in range(0xC0, 0x250) if unicodedata.normalize("NFD", chr(c))[0].isascii()}


def fold_marks(c: Column) -> Column:
    """Latin letters without diacritics; free combining marks go."""
    return F.regexp_replace(F.translate(c, "".join(_MARKED), "".join(_MARKED.values())), r"\p{M}", "")


def excluded(title: Column) -> Column:
    """Whether a title, null and empty included, is of no single item."""
    hit = lambda t: reduce(or_, [F.contains(t, F.lit(x)) for x in _TERMS], (t == "") | t.rlike(r"\bx\s?\d+\b"))
    return let(F.coalesce(norm_decimal(title), F.lit("")), hit)


def names_item(title: Column, name: Column, number: Column, company: Column, grade: Column) -> Column:
    """Whether a title holds all longer tokens of the name, the number, the company, and the grade as a number of its own."""
    tokens = F.filter(F.split(norm_decimal(name), " "), lambda x: F.length(x) >= 3)
    num = compact(F.split(F.trim(F.coalesce(number, F.lit(""))), "/")[0])
    firm, mark = norm_decimal(F.coalesce(company, F.lit(""))), F.trim(F.coalesce(grade, F.lit("")))
    pattern = F.concat(F.lit(r"(?:^|[^0-9.])\Q"), mark, F.lit(r"\E(?:$|[^0-9.])"))
    alone = lambda t: F.expr("true") if grade is None else (mark == "") | F.regexp_like(t, pattern)
    every = lambda t: let(tokens, lambda k: (F.size(k) > 0) & F.forall(k, lambda x: F.contains(t, x)))
    holds = lambda t: (t != "") & every(t) & ((firm == "") | F.contains(t, firm)) & alone(t)
    fits = ((num == "") | F.contains(compact(title), num)) & let(norm_decimal(title), holds)
    return F.coalesce(fits, F.lit(False))


def title_tokens(title: Column) -> Column:
    """A title's words, without marks, noise and quantities."""
    noise = F.array(*[F.lit(x) for x in NOISE])
    return F.filter(F.split(norm(fold_marks(F.coalesce(title, F.lit("")))), " "), lambda x: (x != "") & ~F.array_contains(noise, x) & ~x.rlike(r"^(x\d{1,3}|\d{1,3}x)$"))


def aggregate_titles(df: DataFrame, key: str, title: str, order: str) -> DataFrame:
    """(key, aggregate): tokens in at least half of a key's titles that have any, in order of first sight, 24 at most.

    Each title is one vote per token; counts are combined before the shuffle. Keys without such a token are absent.
    """
    t = df.select(key, order, title_tokens(F.col(title)).alias("_t")).filter("size(_t) > 0")
    total = t.groupBy(key).agg(F.count("*").alias("_n"))
    seen = t.select(key, order, F.posexplode("_t").alias("_p", "_x")).groupBy(key, order, "_x").agg(F.min("_p").alias("_p"))
    votes = seen.groupBy(key, "_x").agg(F.count("*").alias("_c"), F.min(F.struct(order, "_p")).alias("_at"))
    kept = votes.join(total, key).filter("2 * _c >= _n")
    tokens = F.transform(F.slice(F.sort_array(F.collect_list(F.struct("_at", "_x"))), 1, MOST_TOKENS), lambda x: x["_x"])
    return kept.groupBy(key).agg(F.array_join(tokens, " ").alias("aggregate"))


def distinctive(aggregate: Column, most: int = SEARCHED) -> Column:
    """The longest tokens, first of equals first, that are no generic words."""
    generic = F.array(*[F.lit(x) for x in GENERIC])
    found = F.array_distinct(F.filter(F.split(aggregate, " "), lambda x: (F.length(x) >= 3) & ~F.array_contains(generic, x)))
    ranked = F.sort_array(F.transform(found, lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("x"))))
    return F.slice(F.transform(ranked, lambda x: x["x"]), 1, most)


def _trigrams(c: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))


def match_aggregates(keys: DataFrame, candidates: DataFrame, markers: list[str] | None = None) -> DataFrame:
    """(key, id, used) of keys (key, aggregate) that name exactly one of candidates (id, name, set_name).

    All searched tokens occur in a candidate's name and set; where no candidate has all, the last token is left off once.
    Of those found, one must have all its longer words in the aggregate, its language, and a set that the aggregate
    corroborates. Substrings are found by an equi-join of the first token's first three letters to candidates' trigrams.
    """
    markers = markers or ["japanese", "chinese", "korean"]
    want = keys.select("key", "aggregate", distinctive(F.col("aggregate")).alias("want")).filter("size(want) > 0")
    c = candidates.select("id", "name", "set_name", F.lower(F.concat_ws(" ", "name", "set_name")).alias("hay"))
    filed = c.select("*", F.explode(_trigrams(F.col("hay"))).alias("g"))
    met = want.withColumn("g", F.substring(F.get("want", F.lit(0)), 1, 3)).join(filed, "g")
    size = F.size("want")
    hold = lambda n: F.forall(F.slice("want", F.lit(1), n), lambda x: F.contains(F.col("hay"), x))
    less = F.greatest(size - 1, F.least(F.lit(FEWEST), size))
    pool = met.withColumn("used", F.when(hold(size), size).when(hold(less), less)).filter("used is not null")
    best = pool.groupBy("key").agg(F.max("used").alias("used"))
    pool = pool.join(best, ["key", "used"])
    words = F.filter(F.split(norm(F.col("name")), " "), lambda x: (F.length(x) >= 3) & ~x.rlike(r"^\d+$"))
    fits = (F.size(words) > 0) & F.forall(words, lambda x: F.contains(F.col("aggregate"), x)) & (language(F.col("aggregate"), markers) == language(F.col("set_name"), markers)) & corroborates(F.col("aggregate"), F.col("set_name"))
    return pool.filter(fits).groupBy("key").agg(F.min("id").alias("id"), F.max("id").alias("_hi"), F.min("used").alias("used")).filter("id = _hi").select("key", "id", "used")
