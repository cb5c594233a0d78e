"""Entity resolution by precision: stamped id, validated id, number with name and set, unique containment; doubt means no match.

Columns: rows (row_id, name, console, ext_id, sealed), candidates (id, ext_id, name, number, set_name, kind).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import MARKERS, clean_number, compact, corroborates, digit_token, language, norm, trigrams

#: A rung's least score: 2 for the name and 3 for the number.
ACCEPT = 5


def longer_words(c: Column) -> Column:
    """Words of three characters or more that aren't numbers."""
    return F.filter(F.split(norm(c), " "), lambda x: (F.length(x) >= 3) & ~x.rlike(r"^\d+$"))


def validates(candidate: Column, listed: Column) -> Column:
    """Whether a listing's text confirms a candidate's name: all tokens outside of parentheses lie in it, and half of those inside.

    Tokens have three characters or more. A name without any is confirmed; an empty name is not.
    """
    longer = lambda c: F.filter(F.split(norm(c), " "), lambda x: F.length(x) >= 3)
    base = longer(F.regexp_replace(candidate, r"\([^)]*\)", " "))
    aside = longer(F.array_join(F.regexp_extract_all(candidate, F.lit(r"\(([^)]*)\)"), F.lit(1)), " "))
    hay = norm(listed)
    inside = lambda tokens: F.size(F.filter(tokens, lambda x: F.contains(hay, x)))
    return F.coalesce((norm(candidate) != "") & (inside(base) == F.size(base)) & (inside(aside) * 2 >= F.size(aside)), F.lit(False))


def same_print(console: Column, set_name: Column) -> Column:
    """Whether a row's console and a candidate's set have one language and back each other; false where either is empty."""
    return F.coalesce((language(console, MARKERS) == language(set_name, MARKERS)) & corroborates(console, set_name), F.lit(False))


def print_of(text: Column, side: str) -> list[Column]:
    """What backs needs of a text, worked out once a text and not once a pair: <side>_lang, <side>_text."""
    return [language(text, MARKERS).alias(f"{side}_lang"), norm(text).alias(f"{side}_text")]


def backs() -> Column:
    """same_print over the columns that print_of gives for the sides "a" and "b"."""
    within = lambda x, y: F.exists(F.split(x, " "), lambda k: (F.length(k) >= 3) & F.contains(y, k))
    a, b = F.col("a_text"), F.col("b_text")
    return F.coalesce((F.col("a_lang") == F.col("b_lang")) & (a != "") & (b != "") & (within(a, b) | within(b, a)), F.lit(False))


def external_number(c: Column) -> Column:
    """An id that is a whole number above zero; null otherwise, so that blanks never meet."""
    n = F.trim(c.cast("string")).try_cast("double")
    return F.when((n == F.floor(n)) & (n > 0), n.cast("long"))


def validated_match(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(row_id, id) by external id, where the row's name and console confirm the candidate's name; of candidates with one external id the last."""
    left = rows.withColumn("ext", external_number(F.col("ext_id"))).filter("ext is not null")
    by_ext = candidates.withColumn("ext", external_number(F.col("ext_id"))).filter("ext is not null").groupBy("ext").agg(F.max_by(F.struct("id", "name"), "id").alias("c"))
    return left.join(by_ext, "ext").filter(validates(F.col("c.name"), F.concat_ws(" ", "name", "console"))).select("row_id", F.col("c.id").alias("id"))


def row_number_key(name: Column) -> Column:
    """The cleaned number in a row's name; empty without one."""
    return F.coalesce(clean_number(digit_token(name)), F.lit(""))


def numbered_match(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(row_id, id) by number: an equi-join on the cleaned number, then language, set, name and number must all agree; lowest id of the best.

    Texts are judged, not rows: equal rows are one, and of equal candidates the lowest id counts. All of a row's longer
    words lie in the candidate's name, so the first three letters of its longest one are among that name's trigrams.
    """
    left = rows.withColumn("num", row_number_key(F.col("name"))).filter("num <> ''").select("row_id", "name", "console", "num")
    right = candidates.groupBy(F.col("name").alias("c_name"), "number", "set_name").agg(F.min("id").alias("id")).withColumn("num", clean_number(F.col("number"))).filter("num <> ''")
    texts = left.select("name", "console", "num").distinct().select("*", longer_words(F.col("name")).alias("want"), *print_of(F.col("console"), "a")).filter((F.size("want") > 0) & (F.col("a_text") != ""))
    longest = F.element_at(F.array_sort(F.transform("want", lambda x: F.struct((-F.length(x)).alias("l"), x.alias("x")))), 1)["x"]
    digits = F.array_join(F.filter(F.split(norm(F.col("name")), " "), lambda x: x.rlike(r"\d")), "")
    texts = texts.select("name", "console", "num", "want", "a_lang", "a_text", digits.alias("digits"), F.substring(longest, 1, 3).alias("g"))
    hay = F.concat(compact(F.col("c_name")), compact(clean_number(F.col("number"))))
    filed = right.select("id", "num", norm(F.col("c_name")).alias("c_norm"), hay.alias("hay"), *print_of(F.col("set_name"), "b")).filter("b_text <> ''")
    filed = filed.select("*", F.explode(trigrams(F.col("c_norm"))).alias("g"))
    score = F.lit(2) + F.when((F.col("digits") != "") & F.contains(F.col("hay"), F.col("digits")), 3).otherwise(0)
    on = (texts["num"] == filed["num"]) & (texts["g"] == filed["g"]) & (F.col("a_lang") == F.col("b_lang"))
    met = texts.join(filed, on).filter((score >= ACCEPT) & F.forall("want", lambda x: F.contains(F.col("c_norm"), x)) & backs())
    best = met.groupBy("name", "console").agg(F.min("id").alias("id"))
    return left.join(best, ["name", "console"]).groupBy("row_id").agg(F.min("id").alias("id"))


def contained_match(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(row_id, id) of rows without a number whose name and console hold all longer words of exactly one candidate of its language and set.

    Words are held as substrings. A candidate is filed under the rarest of its words' first three letters; rows bring
    their trigrams, so an equi-join finds what the test then verifies. Equal rows are one there, and so are candidates
    with equal words and set, of which the lowest and the highest id tell whether there is one only.
    """
    need = candidates.select("id", "set_name", longer_words(F.col("name")).alias("need")).filter("size(need) > 0").groupBy("need", "set_name").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    heads = need.select("*", F.explode(F.array_distinct(F.transform("need", lambda x: F.substring(x, 1, 3)))).alias("g"))
    rarest = heads.join(heads.groupBy("g").agg(F.count("*").alias("f")), "g").groupBy("need", "set_name", "lo", "hi").agg(F.min(F.struct("f", "g")).alias("k"))
    filed = rarest.select("need", "lo", "hi", F.col("k.g").alias("g"), *print_of(F.col("set_name"), "b")).filter("b_text <> ''")
    hay = F.trim(F.concat_ws(" ", norm(F.col("name")), norm(F.col("console"))))
    have = rows.filter(norm(F.col("name")) != "").select("row_id", "console", hay.alias("hay"))
    texts = have.select("hay", "console").distinct().select("*", *print_of(F.col("console"), "a")).filter("a_text <> ''").select("*", F.explode(trigrams(F.col("hay"))).alias("g"))
    met = texts.join(filed, (texts["g"] == filed["g"]) & (F.col("a_lang") == F.col("b_lang")))
    fits = met.filter(F.forall("need", lambda x: F.contains(F.col("hay"), x)) & backs())
    found = fits.groupBy("hay", "console").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return have.join(found, ["hay", "console"]).groupBy("row_id").agg(F.min("lo").alias("id"), F.max("hi").alias("_hi")).filter("id = _hi").select("row_id", "id")


def ladder(rows: DataFrame, stamped: DataFrame, candidates: DataFrame) -> DataFrame:
    """(row_id, id, method, rung): the first rung that gives an id; each works on what those before it left.

    Rungs: stamped (method null, so that a merge keeps the stored one), tcg-id, fuzzy where the name has a number, else
    numberless for rows that aren't sealed, among cards without a number. Rows without a match keep a null id and rung.
    """
    found = stamped.select("row_id", "id").filter("id is not null").withColumn("rung", F.lit("stamped")).join(rows.select("row_id"), "row_id", "left_semi")

    def step(left: DataFrame, got: DataFrame, rung: str) -> tuple[DataFrame, DataFrame]:
        return left.join(got, "row_id", "left_anti"), got.select("row_id", "id", F.lit(rung).alias("rung"))

    left = rows.join(found, "row_id", "left_anti")
    left, one = step(left, validated_match(left, candidates), "tcg-id")
    numbered = row_number_key(F.col("name")) != ""
    _, two = step(left, numbered_match(left, candidates), "fuzzy")
    cards = candidates.filter((F.coalesce(F.trim("number"), F.lit("")) == "") & (F.col("kind") == "card"))
    _, three = step(left, contained_match(left.filter(~numbered & ~F.coalesce(F.col("sealed"), F.lit(False))), cards), "numberless")
    every = found.unionByName(one).unionByName(two).unionByName(three)
    out = rows.select("row_id").join(every, "row_id", "left")
    return out.select("row_id", "id", F.when(F.col("rung") != "stamped", F.col("rung")).alias("method"), "rung")


def rung_counts(matched: DataFrame) -> DataFrame:
    """(rung, n): how many rows each rung settled; unmatched ones under null."""
    return matched.groupBy("rung").agg(F.count("*").alias("n"))


def search_match(items: DataFrame, hits: DataFrame, by: str = "item_id") -> DataFrame:
    """(item_id, hit_id, score): the best of an item's search hits (pos: their order): name 2, number 3, set 2; number or set is needed, and 4 points; first of ties.

    items (item_id, name, number, set_name), hits (item_id, hit_id, pos, name, console).
    """
    h = hits.select(by, "hit_id", "pos", norm(F.col("name")).alias("h_name"), norm(F.col("console")).alias("h_console"))
    met = h.join(items, by)
    words = longer_words(F.col("name"))
    name = (F.size(words) > 0) & F.forall(words, lambda x: F.contains(F.col("h_name"), x))
    digits = compact(clean_number(F.col("number")))
    number = (F.coalesce(digits, F.lit("")) != "") & F.contains(F.regexp_replace("h_name", " ", ""), digits)
    of_set = F.exists(longer_words(F.col("set_name")), lambda x: F.contains(F.col("h_console"), x))
    points = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    scored = met.withColumn("score", points(name, 2) + points(number, 3) + points(of_set, 2)).filter((points(number, 1) + points(of_set, 1) > 0) & (F.col("score") >= 4))
    return scored.groupBy(by).agg(F.min_by("hit_id", F.struct(-F.col("score"), F.col("pos"))).alias("hit_id"), F.max("score").alias("score"))


def vendor_match(cards: DataFrame, products: DataFrame, every: bool = False) -> DataFrame:
    """(card_id, id): by marketplace id, else by lower-cased number and expansion: the lowest id, or with `every` each; cards without a match keep null.

    cards (card_id, market_ids array<long>, number, expansion), products (id, ext_id long, number, expansion).
    """
    coded = products.select("id", "ext_id") if every else products.groupBy("ext_id").agg(F.min("id").alias("id"))
    by_id = cards.select("card_id", F.explode("market_ids").alias("ext_id")).join(coded, "ext_id").select("card_id", "id").distinct()
    rest = cards.join(by_id, "card_id", "left_anti")
    # of many products with one number and expansion only the lowest id meets the cards, so nothing grows with their product
    filed = products.select("id", F.lower("number").alias("_number"), F.col("expansion").alias("_expansion"))
    filed = filed if every else filed.groupBy("_number", "_expansion").agg(F.min("id").alias("id"))
    on = [F.lower("number") == F.col("_number"), F.col("expansion") == F.col("_expansion")]
    by_number = rest.select("card_id", "number", "expansion").join(filed, on).select("card_id", "id").distinct()
    met = by_id.unionByName(by_number)
    if not every:
        met = met.groupBy("card_id").agg(F.min("id").alias("id"))
    return cards.select("card_id").join(met, "card_id", "left")


def barcode_match(codes: DataFrame, stamped: DataFrame, listed: DataFrame, candidates: DataFrame) -> DataFrame:
    """(code, id, rung): the stamped id, else the listing's external id if its title confirms the candidate, else a miss.

    codes (code), stamped (code, id), listed (code, title, ext_id), candidates as above.
    """
    one = codes.join(stamped.select("code", F.col("id").alias("i0")), "code", "left")
    two = validated_match(listed.select(F.col("code").alias("row_id"), F.col("title").alias("name"), F.lit("").alias("console"), "ext_id"), candidates).groupBy("row_id").agg(F.min("id").alias("i1"))
    out = one.join(two, F.col("code") == F.col("row_id"), "left")
    return out.select("code", F.coalesce("i0", "i1").alias("id"), F.when(F.col("i0").isNotNull(), "stamped").when(F.col("i1").isNotNull(), "validated").otherwise("miss").alias("rung"))


def conflicts(df: DataFrame, key: str, owner: str) -> DataFrame:
    """df with contested: whether rows of more than one owner claim the key. Rows without a key are never contested."""
    many = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg((F.min(owner) != F.max(owner)).alias("_c"))
    return df.join(many, df[key] == F.col("_k"), "left").withColumn("contested", F.coalesce("_c", F.lit(False))).drop("_k", "_c")


def routed(entries: DataFrame, owners: DataFrame, key: str, owner: str) -> DataFrame:
    """entries with conflict: their key comes twice in the payload, or belongs to another owner already. owners (key, owner), an owner may be null.

    Counts are combined before the shuffle, so a key of any weight is one row in the join.
    """
    twice = entries.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    held = owners.select(F.col(key).alias("_o"), F.col(owner).alias("_owner"))
    met = entries.join(twice, entries[key] == F.col("_k"), "left").join(held, entries[key] == F.col("_o"), "left")
    other = F.coalesce(F.col("_owner"), F.lit("")) != ""
    conflict = (F.coalesce("_n", F.lit(0)) >= 2) | (other & ~F.col("_owner").eqNullSafe(F.col(owner)))
    return met.withColumn("conflict", conflict).drop("_k", "_n", "_o", "_owner")


def mapped_sets(sets: DataFrame, expansions: DataFrame) -> DataFrame:
    """(id, expansion, outcome) of sets (id, name, code, expansion): by code, else by name; outcome mapped, updated, same or missing.

    expansions (id, code, other_code, name, pos); of equal codes or names the last by pos counts.
    """
    e = expansions.select(F.coalesce("id", "code").alias("e"), "code", "other_code", "name", "pos").filter("e is not null and e <> ''")
    codes = e.select(F.explode(F.array(F.struct("code", (F.col("pos") * 2).alias("p")), F.struct(F.col("other_code").alias("code"), (F.col("pos") * 2 + 1).alias("p")))).alias("x"), "e")
    by_code = codes.filter("x.code <> ''").groupBy(F.lower("x.code").alias("k")).agg(F.max_by("e", "x.p").alias("by_code"))
    by_name = e.filter("name <> ''").groupBy(compact(F.col("name")).alias("k")).agg(F.max_by("e", "pos").alias("by_name"))
    met = sets.join(by_code, F.lower(sets["code"]) == by_code["k"], "left").drop("k").join(by_name, compact(sets["name"]) == by_name["k"], "left").drop("k")
    new = F.coalesce("by_code", "by_name")
    had = F.coalesce(F.col("expansion"), F.lit("")) != ""
    outcome = F.when(new.isNull(), "missing").when(new.eqNullSafe(F.col("expansion")), "same").when(had, "updated").otherwise("mapped")
    return met.select("id", F.coalesce(new, F.col("expansion")).alias("expansion"), outcome.alias("outcome"))


def with_fallback(left: DataFrame, right: DataFrame, first: list[tuple[str, str]], value: str) -> DataFrame:
    """left with `value` from right by the first pair of columns (left's, right's) that finds a row; of rows with equal keys the smallest value."""
    out, found = left, []
    for i, (a, b) in enumerate(first):
        side = right.filter(F.col(b).isNotNull()).groupBy(F.col(b).alias(f"_k{i}")).agg(F.min(value).alias(f"_v{i}"))
        out = out.join(side, left[a] == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    return out.select(*left.columns, F.coalesce(*found).alias(value))


def newest_first(df: DataFrame, by: list[str], order: list, take: int) -> DataFrame:
    """The first `take` rows of each group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= take).drop("_r")


def same_name(a: Column, b: Column) -> Column:
    return compact(a) == compact(b)
