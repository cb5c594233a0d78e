"""Jobs: the operators composed to what a run does to the tables.

A job takes tables as they are and gives those it changes, whole; nothing is fetched, so pages, objects and answers of
other services come as landed tables. Writing the results, a table after the ones it refers to, is the caller's.
A product's id is its external one unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import catalogue as c
from lodestone.functions.images import with_fingerprints
from lodestone.functions.text import barcode, url_path_key
from lodestone.operators import attributes, control, listings, matching, records, stats
from lodestone.operators.tables import KEPT_DAYS, TABLES, changed_groups, inserted_new, replaced_groups, resolved, retained, upsert_source
from lodestone.sources.files import feed_items, guide_prices

#: Endings of mirrored objects, the preferred first.
ENDINGS = ("jpg", "png", "webp")
LONGEST_TITLE = 500
NO_MARKS = {"is_signed": 0, "is_error": 0, "is_perfect": 0}


def _constants(**values) -> dict[str, Column]:
    return {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}


def catalogue_sync(categories: DataFrame, groups: DataFrame, terms: DataFrame, names: DataFrame, games: DataFrame, sets: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(games, sets) after landed categories and groups; those no term names are left out. terms (game, term, pos).

    A category is the game of the longest term that its name holds, of equally long ones the first. games (id,
    external_id, name), sets (external_id, game_id, name, code, published_on).
    """
    cats = records.categories(categories, now)
    met = cats.join(F.broadcast(terms), F.contains(F.lower("name"), F.lower("term")))  # terms are a config's rows
    chosen = met.groupBy("category_id").agg(F.max_by("game", F.struct(F.length("term"), -F.col("pos"))).alias("game"), F.max("name").alias("name"))
    after = TABLES["game"].upsert(games, chosen.select(F.col("category_id").alias("external_id"), "name", F.lit(0).alias("_seq")), "_seq")
    rows = records.sets(groups, names, now).join(chosen.select("category_id"), "category_id", "left_semi")
    rows = resolved(rows, games, "category_id", "game_id")
    incoming = rows.select(F.col("set_id").alias("external_id"), "game_id", "name", F.col("abbreviation").alias("code"), "published_on", F.lit(0).alias("_seq"))
    return after, TABLES["set"].upsert(sets, incoming, "_seq")


def group_processing(items: DataFrame, listed: DataFrame, products: DataFrame, images: DataFrame, attribute_rows: DataFrame, hashes: DataFrame, prices: DataFrame, now: Column, best_host: str, worst_host: str) -> dict[str, DataFrame]:
    """Products, images, attributes, hashes and prices after a group's landed products and prices.

    Only products whose attributes' hash changed have them replaced; prices of products that the payload lacks go.
    hashes (product_id, hash), attribute_rows (product_id, name, value).
    """
    rows = records.products(items, now)
    incoming = rows.select(F.col("product_id").alias("external_id"), "set_id", "name", F.col("card_number").alias("number"), "rarity", "kind", "image_count", F.lit(0).alias("_seq"))
    urls = rows.filter("image_url <> ''").select("product_id", F.col("image_url").alias("source_url"), F.lit(None).cast("string").alias("source"), F.lit(0).alias("_seq"))
    pairs = rows.select("product_id", F.posexplode("extended_data").alias("position", "e")).select("product_id", "position", F.col("e.name").alias("name"), attributes.attribute_value(F.col("e.value")).alias("value")).filter("name <> '' and value <> ''")
    changed = changed_groups(pairs, hashes, "product_id")
    fresh = pairs.join(changed.select("product_id"), "product_id", "left_semi").select("product_id", "name", "value")
    spread = records.prices(listed, rows, now)
    told = spread.select("product_id", F.col("sub_type").alias("variant"), "market", "low", "mid", "high", F.col("synced_at").alias("updated_at")).withColumns(
        _constants(source="listing", finish=c.finish(F.col("variant")), condition="", grade="", company="", _seq=0, **NO_MARKS)
    )
    return {
        "products": TABLES["product"].upsert(products, incoming, "_seq"),
        "images": upsert_source(images, urls, "_seq", best_host, worst_host),
        "attributes": replaced_groups(attribute_rows, fresh, "product_id", "name"),
        "hashes": hashes.join(changed.select("product_id"), "product_id", "left_anti").unionByName(changed.select(*hashes.columns)),
        "prices": TABLES["listing_price"].upsert(prices, told, "_seq"),
    }


def guide_ingest(guide: DataFrame, match_map: DataFrame, candidates: DataFrame, prices: DataFrame, labels: dict[str, str], now: Column, buy_sell: tuple[str, str] = ("retail-loose-buy", "retail-loose-sell")) -> dict[str, DataFrame]:
    """Match map, prices and counts (rung, rows, sealed) after a guide's rows (id, product-name, console-name, tcg-id, genre, upc, price columns).

    Rows without an id go. A matched row's prices are written under the product: the ungraded one with its buy and sell
    prices, others by grade; where rows share a product, the one with the largest id counts.
    """
    rows = guide.withColumn("id", F.trim("id")).filter("id <> ''").dropDuplicates(["id"])
    ladder_rows = rows.select(F.col("id").alias("row_id"), F.col("product-name").alias("name"), F.col("console-name").alias("console"), F.col("tcg-id").alias("ext_id"), (F.trim("genre") == "Sealed Product").alias("sealed"))
    found = matching.ladder(ladder_rows, match_map, candidates)
    met = found.join(rows.select(F.col("id").alias("row_id"), barcode(F.col("upc")).alias("upc")), "row_id")
    entries = met.select("row_id", "id", "method", "upc", F.when(F.col("id").isNotNull(), now).alias("matched_at"), now.alias("last_seen_at"), F.lit(0).alias("_seq"))
    long = guide_prices(rows, "id", labels).withColumnRenamed("id", "row_id")
    cents = lambda name: F.try_divide(F.round(F.regexp_replace(F.col(name), "[$,]", "").try_cast("double") * 100), F.lit(100))
    spread = rows.select(F.col("id").alias("row_id"), *[(cents(n) if n in rows.columns else F.lit(None).cast("double")).alias(k) for n, k in zip(buy_sell, ("buy", "sell"))])
    priced = long.join(found.filter("id is not null").select("row_id", "id"), "row_id").join(spread, "row_id")
    raw = F.col("grade") == "ungraded"
    told = priced.select(
        F.col("id").alias("product_id"), F.when(raw, "normal").otherwise("").alias("finish"), F.when(raw, "").otherwise(F.col("grade")).alias("grade"), (F.col("cents") / 100).alias("market"), F.when(raw, F.col("buy")).alias("buy"), F.when(raw, F.col("sell")).alias("sell"),
        F.when(raw, 0).otherwise(1).alias("is_graded"), now.alias("updated_at"), F.col("row_id").alias("_seq"),
    ).withColumns(_constants(source="guide", variant="", condition="", company="", **NO_MARKS))
    counts = found.join(ladder_rows.select("row_id", "sealed"), "row_id").groupBy(F.coalesce("rung", F.lit("unmatched")).alias("rung")).agg(F.count("*").alias("rows"), F.count_if("sealed").alias("sealed"))
    return {"match_map": TABLES["match_map"].upsert(match_map, entries, "_seq"), "prices": TABLES["guide_price"].upsert(prices, told, "_seq"), "counts": counts}


def set_mapping(sets: DataFrame, expansions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, counts (outcome, n)) after naming each set's expansion."""
    found = matching.mapped_sets(sets, expansions)
    named = found.filter("outcome in ('mapped', 'updated')").select("id", "expansion", F.lit(0).alias("_seq"))
    return TABLES["set_mapping"].upsert(sets, named, "_seq"), found.groupBy("outcome").agg(F.count("*").alias("n"))


def enrichment(cards: DataFrame, sold: DataFrame, days: DataFrame, tables: dict[str, DataFrame], yen_per_dollar: Column, now: int) -> dict[str, DataFrame]:
    """Prices, population, sold listings and history after a card's answers; listings and history beyond their days go.

    cards (product_id, card), sold and days (product_id, body); tables by the names of the result.
    """
    at = F.lit(now)
    priced = records.card_prices(cards, ["product_id"], yen_per_dollar).filter("skipped is null").withColumnRenamed("value", "market")
    told = priced.withColumns(_constants(source="vendor", updated_at=at, _seq=0))
    reports = records.population(cards, ["product_id"]).withColumns(_constants(updated_at=at, _seq=0))
    points = records.history(days, "product_id", "body").withColumns(_constants(_seq=0))
    hits = records.sold_listings(sold, "product_id", "body").withColumns(_constants(_seq=0))
    out = {
        "prices": TABLES["enriched_price"].upsert(tables["prices"], told, "_seq"),
        "population": TABLES["population"].upsert(tables["population"], reports, "_seq"),
        "sold": TABLES["sold_listing"].upsert(tables["sold"], hits, "_seq"),
        "history": TABLES["history"].upsert(tables["history"], points, "_seq"),
    }
    out["sold"] = out["sold"].filter(F.col("sold_at").isNull() | (F.col("sold_at") >= now - KEPT_DAYS["sold_listing"] * 86400))
    out["history"] = out["history"].filter(F.unix_timestamp(F.try_to_timestamp("date")) >= now - KEPT_DAYS["history"] * 86400)
    return out


def news_poll(sources: DataFrame, feeds: DataFrame, items: DataFrame, now: int) -> tuple[DataFrame, DataFrame]:
    """(items, counts (inserted, failed)) after landed feeds; a link that is there stays as it is, and old items go.

    sources (source_id, feed_url, game, is_active, sort_order), feeds (feed_url, xml), items (source_id, title, link,
    game, published_at, fetched_at), times as ISO texts. A source fails without a web address or without a landed feed.
    """
    active = sources.filter("is_active = 1")
    web = active.filter(F.col("feed_url").rlike("(?i)^https?://"))
    landed = web.join(feeds.filter("xml <> ''").dropDuplicates(["feed_url"]), "feed_url")
    found = feed_items(landed.select("source_id", "game", "sort_order", "xml")).filter("title is not null")
    fresh = found.select("source_id", F.substring("title", 1, LONGEST_TITLE).alias("title"), "link", "game", c.feed_time(F.col("published")).alias("published_at"), F.date_format(F.timestamp_seconds(F.lit(now)), "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "sort_order")
    every = inserted_new(items, fresh, "link", F.struct("sort_order", "source_id", "title"))
    inserted = fresh.select("link").distinct().join(items.select("link"), "link", "left_anti").agg(F.count("*").alias("inserted"))
    failed = active.join(landed.select("source_id"), "source_id", "left_anti").agg(F.count("*").alias("failed"))
    seconds = F.unix_timestamp(F.try_to_timestamp(F.coalesce("published_at", "fetched_at")))
    kept = retained(every.withColumn("_s", F.coalesce(seconds, F.lit(now))), "_s", now, KEPT_DAYS["news"]).drop("_s")
    return kept, inserted.join(failed, F.lit(True))  # a row each


def url_backfill(images: DataFrame, products: DataFrame, objects: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """(images, counts (game, checked, updated, skipped)): products without a mirrored image get the address of the object that is there.

    products (product_id, game), objects (key: cards/id.ending); of several endings the preferred one.
    """
    left = products.join(images.filter("mirror_url is not null").select("product_id"), "product_id", "left_anti")
    parts = objects.select("key", F.regexp_extract("key", rf"^cards/(\d+)\.({'|'.join(ENDINGS)})$", 1).try_cast("long").alias("product_id"), F.array_position(F.array(*[F.lit(x) for x in ENDINGS]), F.regexp_extract("key", r"\.(\w+)$", 1)).alias("_p")).filter("product_id is not null")
    best = parts.groupBy("product_id").agg(F.min_by("key", "_p").alias("key"))
    met = left.join(best, "product_id", "left")
    told = met.filter("key is not null").select("product_id", F.concat(F.lit(base.rstrip("/") + "/"), "key").alias("mirror_url"), F.lit(None).cast("string").alias("source"), F.lit(0).alias("_seq"))
    counts = met.groupBy("game").agg(F.count("*").alias("checked"), F.count("key").alias("updated"), F.count_if(F.col("key").isNull()).alias("skipped")).orderBy(F.col("updated").desc(), "game")
    return TABLES["mirror_url"].upsert(images, told, "_seq"), counts


def mirror(images: DataFrame, fetched: DataFrame, base: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(images, objects to store (key, product_id)) after fetches (product_id, status, size, content_type): bytes give an address, permanent failures count an attempt, others change nothing."""
    told = fetched.withColumn("outcome", c.fetch_outcome(F.col("status"), F.col("size")))
    done = told.filter("outcome = 'bytes'").select("product_id", F.concat(F.lit("cards/"), F.col("product_id").cast("string"), F.lit("."), c.extension(F.col("content_type"))).alias("key"))
    urls = done.groupBy("product_id").agg(F.min("key").alias("key")).select("product_id", F.concat(F.lit(base.rstrip("/") + "/"), "key").alias("mirror_url"), F.lit(None).cast("string").alias("source"), F.lit(0).alias("_seq"))
    failed = told.filter("outcome = 'permanent'").select("product_id", now.alias("last_attempt_at"), F.lit(0).alias("_seq"))
    return TABLES["mirror_attempt"].upsert(TABLES["mirror_url"].upsert(images, urls, "_seq"), failed, "_seq"), done.select("key", "product_id")


def placeholder_purge(images: DataFrame, contents: DataFrame, placeholders: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """(images, keys to delete once the images are written): mirrored placeholders go back to the address that the id gives.

    contents (key, content), placeholders (hash: lower-case hex SHA-256). Images without an object are left alone.
    """
    held = images.filter("mirror_url is not null").select("product_id", url_path_key(F.col("mirror_url")).alias("key"))
    shown = contents.select("key", F.sha2("content", 256).alias("hash")).join(placeholders.select("hash").distinct(), "hash", "left_semi")
    bad = held.join(shown.select("key"), "key")
    told = bad.select("product_id", c.full_image(base, F.col("product_id")).alias("source_url"), F.lit(0).alias("_seq"))
    return TABLES["image_repair"].upsert(images, told, "_seq"), bad.select("key").distinct()


def dead_urls(images: DataFrame, probes: DataFrame, base: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(images, counts (verdict, n)) after probes (product_id, verdict: alive, dead or placeholder) of addresses that aren't mirrored."""
    open_ = images.filter("mirror_url is null and source_url <> ''").select("product_id").join(probes, "product_id")
    repaired = open_.filter("verdict = 'placeholder'").select("product_id", c.full_image(base, F.col("product_id")).alias("source_url"), F.lit(0).alias("_seq"))
    dead = open_.filter("verdict = 'dead'").select("product_id", now.alias("last_attempt_at"), F.lit(0).alias("_seq"))
    after = TABLES["mirror_attempt"].upsert(TABLES["image_repair"].upsert(images, repaired, "_seq"), dead, "_seq")
    return after, open_.groupBy("verdict").agg(F.count("*").alias("n"))


def hash_sweep(images: DataFrame, hashes: DataFrame, contents: DataFrame, version: int) -> DataFrame:
    """Hashes (product_id, hash, version) after the mirrored images that have none of this version; an image that can't be decoded gets an empty one and isn't tried again."""
    due = images.filter("mirror_url is not null").join(hashes.filter(F.col("version") == version).select("product_id"), "product_id", "left_anti")
    bodies = due.select("product_id", url_path_key(F.col("mirror_url")).alias("key")).join(contents, "key").select("product_id", "content")
    made = with_fingerprints(bodies, "product_id", "content").select("product_id", F.col("fingerprint").alias("hash"), F.lit(version).alias("version"), F.lit(0).alias("_seq"))
    return TABLES["image_hash"].upsert(hashes, made, "_seq")


def seed_variants(cards: DataFrame, products: DataFrame, freshness: DataFrame, now: Column) -> dict[str, DataFrame]:
    """Products, conflicts, freshness and counts after cards (game, expansion, card) of expansions that weren't seeded yet.

    A variant is cloned from the product of its game whose number is the card's id, else the card's number, whatever
    their case. An id that comes twice, or that another card holds, is a conflict and is not written.
    products (external_id, game, set_id, name, number, rarity, kind, card_id, variant), freshness (key, kind, updated_at).
    """
    due = cards.join(freshness.filter("kind = 'seed'").select(F.col("key").alias("expansion")), "expansion", "left_anti")
    entries = matching.routed(records.variant_entries(due, ["game", "expansion"]), products.select(F.col("external_id").alias("market_id"), "card_id"), "market_id", "card_id")
    bases = products.filter("number <> ''").select("game", F.lower("number").alias("_n"), F.struct("set_id", "name", "number", "rarity").alias("base"), "external_id").groupBy("game", "_n").agg(F.min_by("base", "external_id").alias("base"))
    side = lambda i: bases.select(F.col("game").alias(f"_g{i}"), F.col("_n").alias(f"_n{i}"), F.col("base").alias(f"_b{i}"))
    met = entries.join(side(0), (F.col("game") == F.col("_g0")) & (F.lower("card_id") == F.col("_n0")), "left").join(side(1), (F.col("game") == F.col("_g1")) & (F.lower(entries["number"]) == F.col("_n1")), "left")
    met = met.withColumn("base", F.coalesce("_b0", "_b1")).withColumn("outcome", F.when(F.col("conflict"), "conflict").when(F.col("base").isNull(), "skipped").otherwise("captured"))
    suffix = F.when(F.col("variant") != "normal", F.concat(F.lit(" ("), "variant", F.lit(")"))).otherwise("")
    made = met.filter("outcome = 'captured'").select(F.col("market_id").alias("external_id"), "game", F.col("base.set_id").alias("set_id"), F.concat("base.name", suffix).alias("name"), F.col("base.number").alias("number"), F.col("base.rarity").alias("rarity"), F.lit("card").alias("kind"), "card_id", "variant", "printings", F.lit(0).alias("_seq"))
    after = TABLES["variant_seed"].upsert(products, made, "_seq").join(made.select("external_id", F.col("game").alias("_game"), F.col("rarity").alias("_rarity")).dropDuplicates(["external_id"]), "external_id", "left")
    return {
        "products": after.withColumns({"game": F.coalesce("game", "_game"), "rarity": F.coalesce("rarity", "_rarity")}).select(products.columns),
        "conflicts": met.filter("outcome = 'conflict'").select("card_id", "variant", "market_id").distinct(),
        "freshness": TABLES["freshness"].upsert(freshness, due.select(F.col("expansion").alias("key"), F.lit("seed").alias("kind"), now.alias("updated_at"), F.lit(0).alias("_seq")).distinct(), "_seq"),
        "counts": met.groupBy("outcome").agg(F.count("*").alias("n")),
    }


def attribute_fill(cards: DataFrame, products: DataFrame, attribute_rows: DataFrame, source: str, fields: list[str]) -> DataFrame:
    """attribute_rows (id, name, value) after the vendor's fields of cards (card_id, market_ids, number, expansion, fields...), written to each product that matches."""
    met = matching.vendor_match(cards, products, every=True).filter("id is not null")
    pairs = records.external_attributes(cards, "card_id", source, fields)
    return replaced_groups(attribute_rows, met.join(pairs, "card_id").select("id", "name", "value").distinct(), "id", "name", source)


def graded_comps(items: DataFrame, near_from: int, few: int = 5) -> DataFrame:
    """(slab, n, median, low, high, low_confidence) of sold listings (slab, name, number, company, grade, title, price, sold_at) that name the slab and nothing else; the long window where the short one has few."""
    kept = items.filter((F.col("price") > 0) & ~listings.excluded(F.col("title")) & listings.names_item(F.col("title"), F.col("name"), F.col("number"), F.col("company"), F.col("grade")))
    windows = F.when(F.col("sold_at") >= near_from, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True)))
    both = kept.select("slab", "price", F.explode(windows).alias("_far")).repartition("slab", "_far")  # one shuffle that every later step reads
    return control.wider_of(stats.robust_summary(both, "price", ["slab", "_far"]), ["slab"], "_far", few)


def in_order(steps: list[tuple[str, Callable[[], object]]], log: Callable[[dict], None]) -> dict[str, str]:
    """Runs steps one after the other, each logged; one that fails doesn't stop those after it. Gives each step's status."""
    out = {}
    for name, step in steps:
        try:
            with control.stage(name, log):
                step()
            out[name] = "success"
        except Exception:  # noqa: BLE001  the log has it
            control.LOG.exception("step %s failed", name)
            out[name] = "error"
    return out
