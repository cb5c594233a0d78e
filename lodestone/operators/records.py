"""Nested records as rows: categories, sets, products, prices, population reports, sold listings, price history, variants.

Sources are landed JSON, read with the schemas below; arrays explode, and nothing is shuffled but where a semi join says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import catalogue as c
from lodestone.functions.money import convert, currency_factor, epoch_seconds, flag, tolerant_number

ENTRY = "array<struct<name:string,value:string>>"
PRICE = "struct<type:string,condition:string,company:string,grade:string,currency:string,low:string,mid:string,high:string,market:string,is_signed:string,is_error:string,is_perfect:string,trends:map<string,struct<percent_change:double>>>"
REPORT = "struct<company:string,total:string,grade_total:string,qualified_grade_total:string,half_grade_total:string,grades:array<struct<grade:string,count:string>>>"
VARIANT = f"struct<name:string,images:array<struct<type:string,large:string,medium:string>>,marketplaces:array<struct<name:string,product_id:string>>,printings:array<string>,prices:array<{PRICE}>,pop_reports:array<{REPORT}>>"
CARD = f"struct<id:string,number:string,printings:array<string>,variants:array<{VARIANT}>>"
LISTING = "struct<id:string,listing_id:string,title:string,name:string,variant:string,company:string,grade:string,grade_label:string,is_perfect:string,is_error:string,is_signed:string,url:string,link:string,price:string,sale_price:string,amount:string,currency:string,sold_at:string,sold_date:string,date:string,end_time:string>"
POINT = "struct<variant:string,condition:string,company:string,grade:string,low:string,market:string,price:string,value:string,currency:string>"
DAY = f"struct<date:string,day:string,variant:string,low:string,market:string,price:string,value:string,currency:string,prices:array<{POINT}>,points:array<{POINT}>>"
#: Days of a price's trends.
WINDOWS = (1, 7, 14, 30, 90, 180)


def enveloped(body: Column, item: str, *names: str) -> Column:
    """The array in a JSON body: the body itself, or the first of the named fields; empty where there's none or it's malformed."""
    found = [F.from_json(body, f"struct<{n}:array<{item}>>")[n] for n in (*names, "data", "results")]
    whole = F.when(F.trim(body).startswith("["), F.from_json(body, f"array<{item}>"))
    return F.coalesce(whole, *found, F.from_json(F.lit("[]"), f"array<{item}>"))


def total_pages(body: Column) -> Column:
    """How many pages a body says there are; null where it says nothing."""
    return F.coalesce(*[F.get_json_object(body, p).try_cast("int") for p in ("$.total_pages", "$.totalPages", "$.pagination.total_pages")])


def named_value(entries: Column, name: str) -> Column:
    """The value of the first entry of that name, whatever its case."""
    return F.get(F.filter(entries, lambda x: F.lower(x["name"]) == name.lower()), F.lit(0))["value"]


def is_card(entries: Column) -> Column:
    """Whether an entry is named exactly Rarity or Number."""
    return F.coalesce(F.exists(entries, lambda x: x["name"].isin("Rarity", "Number")), F.lit(False))


def product_kind(number: Column, rarity: Column) -> Column:
    return F.when(number.isNotNull() | rarity.isNotNull(), "card").otherwise("sealed")


def categories(df: DataFrame, now: Column) -> DataFrame:
    return df.select(F.col("categoryId").alias("category_id"), "name", F.col("displayName").alias("display_name"), F.col("modifiedOn").alias("modified_on"), F.col("imageUrl").alias("image_url"), F.col("seoText").alias("seo_text"), F.coalesce(F.col("isDirectBrand").cast("boolean"), F.lit(False)).cast("int").alias("is_direct_brand"), now.alias("synced_at"))


def sets(df: DataFrame, names: DataFrame, now: Column) -> DataFrame:
    """Sets with the vendor's id by name; names (name, vendor_id), of equal names the smallest id."""
    known = names.groupBy(c.set_key(F.col("name")).alias("_k")).agg(F.min("vendor_id").alias("vendor_set_id"))
    out = df.join(known, c.set_key(df["name"]) == F.col("_k"), "left")
    return out.select(F.col("groupId").alias("set_id"), F.col("categoryId").alias("category_id"), "name", "abbreviation", F.try_to_timestamp("publishedOn").alias("published_on"), F.col("modifiedOn").alias("modified_on"), F.coalesce("isSupplemental", F.lit(False)).alias("is_supplemental"), "vendor_set_id", now.alias("synced_at"))


def products(df: DataFrame, now: Column, image_host: str = "cdn.example.com") -> DataFrame:
    """Products with number, rarity and kind from their entries; presale as JSON, null where absent."""
    number, rarity = named_value(F.col("extendedData"), "Number"), named_value(F.col("extendedData"), "Rarity")
    return df.select(
        F.col("productId").alias("product_id"), F.col("groupId").alias("set_id"), F.col("categoryId").alias("category_id"), "name", F.col("cleanName").alias("clean_name"), c.larger_image(F.col("imageUrl"), image_host).alias("image_url"), F.col("url").alias("source_url"),
        F.col("modifiedOn").alias("modified_on"), F.col("imageCount").alias("image_count"), F.to_json("presaleInfo").alias("presale_info"), number.alias("card_number"), rarity.alias("rarity"), product_kind(number, rarity).alias("kind"), is_card(F.col("extendedData")).alias("is_card"), F.col("extendedData").alias("extended_data"), now.alias("synced_at"),
    )


def prices(df: DataFrame, known: DataFrame, now: Column) -> DataFrame:
    """Listing-spread prices of known products (product_id): others go."""
    out = df.select(F.col("productId").alias("product_id"), F.col("subTypeName").alias("sub_type"), F.col("lowPrice").alias("low"), F.col("midPrice").alias("mid"), F.col("highPrice").alias("high"), F.col("marketPrice").alias("market"), F.col("directLowPrice").alias("direct_low"), now.alias("synced_at"))
    return out.join(known.select("product_id"), "product_id", "left_semi")


def market_id(variant: Column, market: str = "tcgplayer") -> Column:
    """A variant's number on a marketplace: the first entry's leading digits."""
    first = F.get(F.filter(variant["marketplaces"], lambda x: x["name"] == market), F.lit(0))["product_id"]
    return F.nullif(F.regexp_extract(first, r"^\s*(-?\d+)", 1), F.lit("")).try_cast("long")


def front_image(variant: Column) -> Column:
    front = F.get(F.filter(variant["images"], lambda x: x["type"] == "front"), F.lit(0))
    return F.coalesce(front["large"], front["medium"])


def joined_printings(printings: Column) -> Column:
    """Printings in one text: strings as they are, objects (as JSON) by code, name or id; null without any."""

    def shown(x: Column) -> Column:
        inner = F.coalesce(*[F.get_json_object(x, f"$.{k}") for k in ("code", "name", "id")], F.lit(""))
        return F.trim(F.when(x.startswith("{"), inner).otherwise(x))

    return F.nullif(F.array_join(F.filter(F.transform(printings, shown), lambda x: x != ""), ", "), F.lit(""))


def trends(t: Column, windows: tuple[int, ...] = WINDOWS) -> list[Column]:
    """Percent changes by window, null where absent."""
    return [F.try_element_at(t, F.lit(f"days_{n}"))["percent_change"].alias(f"trend_{n}d") for n in windows]


def _variants(cards: DataFrame, keys: list[str]) -> DataFrame:
    return cards.select(*keys, "card", F.explode("card.variants").alias("v"))


def card_prices(cards: DataFrame, keys: list[str], yen_per_dollar: Column) -> DataFrame:
    """(keys..., market_id, variant, finish, condition, grade, company, flags, value, low, mid, high, trends..., trends_json, skipped): a row per variant and price.

    cards (keys..., card: CARD). Amounts are dollars: yen are converted, rows in other currencies carry the reason in
    `skipped` and no amounts, so that they can be counted before they go. Graded rows without a label are left out.
    """
    rows = _variants(cards, keys).select(*keys, "v", F.explode("v.prices").alias("p"))
    rows = rows.withColumn("f", currency_factor(F.col("p.currency"), yen_per_dollar))
    graded = F.coalesce(F.col("p.type") == "graded", F.lit(False))
    code = c.company(F.col("p.company"))
    label = c.grade_label(code, F.col("p.grade"), F.nullif(F.col("p.condition"), F.lit("")))
    tier = F.nullif(F.upper(F.trim("p.condition")), F.lit(""))
    mark = lambda n: F.when(graded, flag(F.col(f"p.{n}"))).otherwise(0).alias(n)
    money = lambda n, to: convert(tolerant_number(F.col(f"p.{n}")), F.col("f.factor")).alias(to)
    name = F.coalesce(F.col("v.name"), F.lit("normal"))
    kept = rows.filter(~graded | label.isNotNull())
    return kept.select(
        *keys, market_id(F.col("v")).alias("market_id"), name.alias("variant"), c.finish(name).alias("finish"), F.when(~graded, tier).alias("condition"), F.when(graded, label).alias("grade"), F.when(graded, code).alias("company"),
        graded.cast("int").alias("is_graded"), mark("is_signed"), mark("is_error"), mark("is_perfect"), money("market", "value"), money("low", "low"), money("mid", "mid"), money("high", "high"),
        *trends(F.col("p.trends")), F.when(F.size("p.trends") > 0, F.to_json("p.trends")).alias("trends_json"), F.col("f.reason").alias("skipped"),
    )


def drained_prices(cards: DataFrame, keys: list[str], price_type: str, yen_per_dollar: Column) -> DataFrame:
    """card_prices of one type and of five windows, in dollars only: the rows that the drain writes."""
    every = card_prices(cards, keys, yen_per_dollar).filter("skipped is null").filter(F.col("is_graded") == (1 if price_type == "graded" else 0))
    return every.drop("trend_180d", "trends_json", "skipped")


def skip_counts(priced: DataFrame) -> DataFrame:
    """(skipped, n): rows that the currency gate keeps out, by reason."""
    return priced.filter("skipped is not null").groupBy("skipped").agg(F.count("*").alias("n"))


def population(cards: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., variant, company, grade, count, totals...): a row per variant, company and grade."""
    reports = _variants(cards, keys).select(*keys, F.col("v.name").alias("variant"), F.explode("v.pop_reports").alias("r")).withColumn("company", c.company(F.col("r.company"))).filter("company is not null")
    rows = reports.select("*", F.explode("r.grades").alias("g")).withColumn("grade", c.grade_label(F.col("company"), F.col("g.grade"))).filter("grade is not null")
    number = lambda n: tolerant_number(F.col(f"r.{n}")).alias(n)
    return rows.select(*keys, "variant", "company", "grade", tolerant_number(F.col("g.count")).alias("count"), *[number(n) for n in ("total", "grade_total", "qualified_grade_total", "half_grade_total")])


def sold_listings(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """(key, listing_id, title, variant, company, grade, flags, url, price, currency, sold_at) of bodies in any of three envelopes.

    Listings without an id get one of the key, grade, time, price and place.
    """
    rows = bodies.select(key, F.posexplode(enveloped(F.col(body), LISTING, "listings")).alias("i", "l"))
    first = lambda *names: F.coalesce(*[F.col(f"l.{n}") for n in names])
    code, number = c.company(F.col("l.company")), F.nullif(F.trim("l.grade"), F.lit(""))
    grade = F.coalesce(F.col("l.grade_label"), c.grade_label(code, F.col("l.grade")), number)
    sold, price = epoch_seconds(first("sold_at", "sold_date", "date", "end_time")), tolerant_number(first("price", "sale_price", "amount"))
    blank = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    made = F.concat_ws(":", F.col(key).cast("string"), blank(grade), blank(sold), blank(price), F.col("i").cast("string"))
    return rows.select(key, F.coalesce(first("id", "listing_id"), made).alias("listing_id"), first("title", "name").alias("title"), F.col("l.variant").alias("variant"), code.alias("company"), grade.alias("grade"), *[flag(F.col(f"l.{n}")).alias(n) for n in ("is_perfect", "is_error", "is_signed")], first("url", "link").alias("url"), price.alias("price"), F.coalesce(F.col("l.currency"), F.lit("USD")).alias("currency"), sold.alias("sold_at"))


def history(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """(key, date, variant, condition, grade, company, low, market, currency): a row per day and point; days without points give their own figures."""
    days = bodies.select(key, F.explode(enveloped(F.col(body), DAY, "history")).alias("d"))
    days = days.withColumn("date", F.replace(F.substring(F.coalesce("d.date", "d.day"), 1, 10), F.lit("/"), F.lit("-"))).filter("date <> ''")
    nothing = F.lit(None).cast("string")
    own = F.array(F.struct(F.col("d.variant").alias("variant"), nothing.alias("condition"), nothing.alias("company"), nothing.alias("grade"), F.col("d.low").alias("low"), F.col("d.market").alias("market"), F.col("d.price").alias("price"), F.col("d.value").alias("value"), F.col("d.currency").alias("currency")))
    points = F.coalesce("d.prices", "d.points")
    rows = days.select(key, "date", F.explode(F.when(F.size(points) > 0, points).otherwise(own)).alias("p"))
    code = c.company(F.col("p.company"))
    grade = c.grade_label(code, F.col("p.grade"))
    return rows.select(key, "date", F.col("p.variant").alias("variant"), F.when(grade.isNull(), F.nullif(F.upper(F.trim("p.condition")), F.lit(""))).alias("condition"), grade.alias("grade"), code.alias("company"), tolerant_number(F.col("p.low")).alias("low"), tolerant_number(F.coalesce("p.market", "p.price", "p.value")).alias("market"), F.coalesce(F.col("p.currency"), F.lit("USD")).alias("currency"))


def variant_entries(cards: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., card_id, number, variant, market_id, image, printings) of variants with a marketplace number."""
    rows = _variants(cards, keys)
    printings = F.when(F.col("v.printings").isNotNull(), joined_printings(F.col("v.printings"))).otherwise(joined_printings(F.col("card.printings")))
    return rows.select(*keys, F.col("card.id").alias("card_id"), F.col("card.number").alias("number"), F.coalesce(F.col("v.name"), F.lit("normal")).alias("variant"), market_id(F.col("v")).alias("market_id"), front_image(F.col("v")).alias("image"), printings.alias("printings")).filter("market_id is not null")


def titled_prices(items: DataFrame, key: str, item: str) -> DataFrame:
    """(key, title, price) of JSON items whose fields go by several names; items without a title or a price go."""
    of = lambda *paths: F.coalesce(*[F.nullif(F.trim(F.get_json_object(item, f"$.{p}")), F.lit("")) for p in paths])
    rows = items.select(key, of("title", "name", "itemTitle").alias("title"), c.sale_price(of("soldPrice", "price", "totalPrice", "salePrice")).alias("price"))
    return rows.filter("title is not null and price is not null")


def external_attributes(df: DataFrame, key: str, source: str, fields: list[str], longest: int = 512) -> DataFrame:
    """(key, name, value): fields as rows under the source's names; arrays are joined by semicolons, blank and overlong values go."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    text = lambda f: F.array_join(F.filter(F.transform(f, lambda x: F.trim(x)), lambda x: x != ""), ";") if kinds[f].startswith("array") else F.trim(F.col(f).cast("string"))
    wide = df.select(key, *[text(f).alias(f) for f in fields])
    return wide.unpivot([key], fields, "field", "value").filter((F.col("value") != "") & (F.length("value") <= longest)).select(key, F.concat(F.lit(f"@{source}."), F.col("field")).alias("name"), "value")


def field_census(df: DataFrame, column: str) -> DataFrame:
    """(name, present, kinds, sample): keys of a JSON column's objects: how often they hold something, as what, and the first sample by row; most frequent first."""
    pairs = df.select(F.posexplode(F.map_entries(F.from_json(column, "map<string,string>"))).alias("pos", "e")).select("pos", "e.key", "e.value").filter("value is not null and value <> ''")
    kind = F.when(F.col("value").startswith("{"), "object").when(F.col("value").startswith("["), "array").when(F.col("value").isin("true", "false"), "boolean").when(F.col("value").try_cast("double").isNotNull(), "number").otherwise("string")
    return pairs.groupBy(F.col("key").alias("name")).agg(F.count("*").alias("present"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.min("value").alias("sample")).orderBy(F.col("present").desc(), "name")


def packed_index(df: DataFrame, group: str, number: str, code: str) -> DataFrame:
    """(group, packed): per group, records of a 32-bit little-endian number and its code, by number; rows without a code go.

    A group is one value by the format's nature; partial lists are combined before the shuffle.
    """
    little = F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright(F.col(number), s).bitwiseAND(F.lit(255))), 2, "0") for s in (0, 8, 16, 24)]))
    rows = df.filter(F.length(code) > 0).select(group, F.struct(F.col(number).alias("n"), F.concat(little, F.col(code)).alias("r")).alias("x"))
    return rows.groupBy(group).agg(F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: F.hex(x["r"])), "")).alias("packed"))
