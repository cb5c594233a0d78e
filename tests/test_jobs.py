"""Jobs on small tables, each against rows worked out by hand."""

from hashlib import sha256

from pyspark.sql import functions as F

from lodestone.operators import jobs, records

IMAGE = "product_id long, source_url string, source string, mirror_url string, attempts long, last_attempt_at long"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def images(spark):
    return spark.createDataFrame([(1, "https://a.example/1", "s", "https://m.example/cards/1.jpg", None, None), (2, "https://a.example/2", None, None, 1, 5), (3, None, None, None, None, None), (4, "", None, None, None, None)], IMAGE)


def test_url_backfill(spark):
    products = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h"), (5, "g"), (6, None)], "product_id long, game string")
    objects = spark.createDataFrame([("cards/2.webp",), ("cards/2.png",), ("cards/5.jpg",), ("cards/x.jpg",), ("else/3.jpg",), ("cards/1.png",)], "key string")
    after, counts = jobs.url_backfill(images(spark), products, objects, "https://m.example/")
    assert rows(after, "product_id", "mirror_url") == [(1, "https://m.example/cards/1.jpg"), (2, "https://m.example/cards/2.png"), (3, None), (4, None), (5, "https://m.example/cards/5.jpg")]
    assert [tuple(r) for r in counts.collect()] == [("g", 2, 2, 0), (None, 1, 0, 1), ("h", 1, 0, 1)]


def test_mirror_purge_and_dead(spark):
    fetched = spark.createDataFrame([(2, 200, 900, "image/png"), (3, 404, 0, None), (4, 503, 0, None), (9, 200, 10, "image/png")], "product_id long, status int, size long, content_type string")
    after, keys = jobs.mirror(images(spark), fetched, "https://m.example", F.lit(7))
    assert rows(keys) == [("cards/2.png", 2)]
    assert rows(after, "product_id", "mirror_url", "attempts", "last_attempt_at") == [(1, "https://m.example/cards/1.jpg", None, None), (2, "https://m.example/cards/2.png", 1, 5), (3, None, 1, 7), (4, None, None, None), (9, None, 1, 7)]
    contents = spark.createDataFrame([("cards/1.jpg", b"back"), ("cards/2.png", b"front")], "key string, content binary")
    bad = spark.createDataFrame([(sha256(b"back").hexdigest(),)], "hash string")
    fixed, gone = jobs.placeholder_purge(after, contents, bad, "https://p.example")
    assert rows(gone) == [("cards/1.jpg",)]
    assert rows(fixed.filter("product_id < 3"), "product_id", "source_url", "mirror_url", "attempts") == [(1, "https://p.example/1_in_1000x1000.jpg", None, None), (2, "https://a.example/2", "https://m.example/cards/2.png", 1)]
    probes = spark.createDataFrame([(1, "dead"), (2, "dead"), (3, "placeholder"), (4, "dead")], "product_id long, verdict string")
    left, counts = jobs.dead_urls(images(spark), probes, "https://p.example", F.lit(8))
    assert rows(counts) == [("dead", 1)] and rows(left.filter("product_id = 2"), "attempts", "last_attempt_at") == [(2, 8)]
    hashes = spark.createDataFrame([(1, b"x", 1)], "product_id long, hash binary, version int")
    assert rows(jobs.hash_sweep(after, hashes, contents, 2), "product_id", "hash", "version") == [(1, bytearray(b""), 2), (2, bytearray(b""), 2)]
    assert rows(jobs.hash_sweep(after, hashes, contents, 1), "product_id", "version") == [(1, 1), (2, 1)]


def test_news_poll(spark):
    now = 1_750_000_000
    sources = spark.createDataFrame([(1, "https://a.example/f", "g", 1, 1), (2, "ftp://b.example", "g", 1, 2), (3, "https://c.example/f", "h", 1, 0), (4, "https://d.example", "h", 0, 3)], "source_id long, feed_url string, game string, is_active int, sort_order int")
    item = lambda title, link, at: f"<item><title>{title}</title><link>{link}</link><pubDate>{at}</pubDate></item>"
    feeds = spark.createDataFrame([("https://a.example/f", item("A", "l1", "Tue, 10 Jun 2025 04:00:00 GMT") + item("T" * 600, "l2", "x")), ("https://c.example/f", item("C", "l2", "Tue, 10 Jun 2025 04:00:00 GMT") + item("Old", "l3", "Tue, 10 Jun 2014 04:00:00 GMT"))], "feed_url string, xml string")
    held = spark.createDataFrame([(1, "kept", "l1", "g", "2025-06-01T00:00:00.000Z", "2025-06-01 00:00:00"), (1, "gone", "l0", "g", None, "2020-01-01 00:00:00")], "source_id long, title string, link string, game string, published_at string, fetched_at string")
    after, counts = jobs.news_poll(sources, feeds, held, now)
    assert rows(after, "link", "title", "source_id") == [("l1", "kept", 1), ("l2", "C", 3)]
    assert rows(counts) == [(2, 1)]


def test_guide_ingest(spark):
    guide = spark.createDataFrame(
        [("10", "Red Fox #5", "Deep Sea", "", "Card", "", "1.50", "$20.00", "1.00"), ("11", "Blue Owl #7", "Deep Sea", "2", "Card", "", "2.00", "", ""), ("12", "Nothing #9", "Deep Sea", "", "Card", "", "3.00", "", ""), (" ", "x", "y", "", "", "", "1", "", "")],
        "id string, `product-name` string, `console-name` string, `tcg-id` string, genre string, upc string, `loose-price` string, `graded-price` string, `retail-loose-buy` string",
    )
    candidates = spark.createDataFrame([(101, "1", "Red Fox", "5", "Deep Sea", "card"), (102, "2", "Blue Owl", "7", "Deep Sea", "card")], "id long, ext_id string, name string, number string, set_name string, kind string")
    match_map = spark.createDataFrame([], "row_id string, id long, method string, upc string, matched_at long, last_seen_at long")
    prices = spark.createDataFrame([], "product_id long, source string, variant string, finish string, condition string, grade string, company string, is_signed int, is_error int, is_perfect int, market double, buy double, sell double, is_graded int, updated_at long")
    got = jobs.guide_ingest(guide, match_map, candidates, prices, {"loose-price": "ungraded", "graded-price": "9"}, F.lit(50).cast("long"))
    assert rows(got["match_map"], "row_id", "id", "method", "matched_at", "last_seen_at") == [("10", 101, "fuzzy", 50, 50), ("11", 102, "tcg-id", 50, 50), ("12", None, None, None, 50)]
    assert rows(got["prices"], "product_id", "finish", "grade", "market", "buy", "is_graded") == [(101, "", "9", 20.0, None, 1), (101, "normal", "", 1.5, 1.0, 0), (102, "normal", "", 2.0, None, 0)]
    assert rows(got["counts"]) == [("fuzzy", 1, 0), ("tcg-id", 1, 0), ("unmatched", 1, 0)]
    again = jobs.guide_ingest(guide, got["match_map"], candidates, got["prices"], {"loose-price": "ungraded", "graded-price": "9"}, F.lit(60).cast("long"))
    assert rows(again["match_map"], "row_id", "id", "method", "matched_at") == [("10", 101, "fuzzy", 50), ("11", 102, "tcg-id", 50), ("12", None, None, None)]
    assert again["prices"].count() == 3


def test_seed_variants(spark):
    variant = lambda name, n: f'{{"name":"{name}","marketplaces":[{{"name":"tcgplayer","product_id":"{n}"}}]}}'
    card = lambda i, n, *v: f'{{"id":"{i}","number":"{n}","variants":[{",".join(v)}]}}'
    cards = spark.createDataFrame([("g", "e1", card("GD-1", "1", variant("normal", 50), variant("foil", 51))), ("g", "e1", card("GD-2", "2", variant("foil", 51), variant("gold", 52))), ("g", "e1", card("GD-3", "x", variant("foil", 53))), ("g", "e0", card("GD-9", "1", variant("foil", 59)))], "game string, expansion string, body string")
    cards = cards.select("game", "expansion", F.from_json("body", records.CARD).alias("card"))
    products = spark.createDataFrame([(10, "g", 1, "Base", "gd-1", "R", "card", None, None), (11, "g", 1, "Two", "2", "C", "card", None, None), (52, "g", 1, "Held", "z", "C", "card", "GD-7", "gold")], "external_id long, game string, set_id long, name string, number string, rarity string, kind string, card_id string, variant string")
    fresh = spark.createDataFrame([("e0", "seed", 1)], "key string, kind string, updated_at long")
    got = jobs.seed_variants(cards, products, fresh, F.lit(9).cast("long"))
    assert rows(got["products"].filter("external_id = 50"), "game", "set_id", "name", "number", "rarity", "card_id", "variant") == [("g", 1, "Base", "gd-1", "R", "GD-1", "normal")]
    assert got["products"].count() == 4
    assert rows(got["conflicts"], "card_id", "variant") == [("GD-1", "foil"), ("GD-2", "foil"), ("GD-2", "gold")]
    assert rows(got["counts"]) == [("captured", 1), ("conflict", 3), ("skipped", 1)]
    assert rows(got["freshness"]) == [("e0", "seed", 1), ("e1", "seed", 9)]


def test_set_mapping_comps_and_order(spark):
    sets = spark.createDataFrame([(1, "Deep Sea", "DS", None), (2, "Sky", "", "old"), (3, "None", "", None)], "id long, name string, code string, expansion string")
    exp = spark.createDataFrame([("x1", "ds", None, "other", 0), ("x2", None, None, "sky", 1)], "id string, code string, other_code string, name string, pos int")
    after, counts = jobs.set_mapping(sets, exp)
    assert rows(after, "id", "expansion") == [(1, "x1"), (2, "x2"), (3, None)] and rows(counts) == [("mapped", 1), ("missing", 1), ("updated", 1)]
    sold = [("a", "Red Fox", "5", "PSA", "9", "Red Fox 5 PSA 9", p, t) for p, t in ((10.0, 100), (12.0, 100), (11.0, 1))] + [("a", "Red Fox", "5", "PSA", "9", "lot of Red Fox 5 PSA 9", 99.0, 100), ("a", "Red Fox", "5", "PSA", "9", "Red Fox 5 PSA 9.5", 99.0, 100)]
    comps = jobs.graded_comps(spark.createDataFrame(sold, "slab string, name string, number string, company string, grade string, title string, price double, sold_at long"), 50)
    assert rows(comps, "slab", "n", "median") == [("a", 3, 11.0)]
    ran, log = [], []
    status = jobs.in_order([("a", lambda: ran.append("a")), ("b", lambda: 1 / 0), ("c", lambda: ran.append("c"))], log.append)
    assert ran == ["a", "c"] and status == {"a": "success", "b": "error", "c": "success"} and len(log) == 6


def test_catalogue_and_group(spark):
    now = F.lit(5).cast("long")
    cats = spark.createDataFrame([(3, "Sea Cards Japan", None, None, None, None, None), (4, "Sea Cards", None, None, None, None, True), (9, "Toys", None, None, None, None, None)], "categoryId long, name string, displayName string, modifiedOn string, imageUrl string, seoText string, isDirectBrand boolean")
    terms = spark.createDataFrame([("jp", "sea cards japan", 0), ("en", "sea cards", 0)], "game string, term string, pos int")
    groups = spark.createDataFrame([(30, 3, "Deep", "DP", "2020-01-01T00:00:00", None, None), (90, 9, "Toy", None, None, None, None)], "groupId long, categoryId long, name string, abbreviation string, publishedOn string, modifiedOn string, isSupplemental boolean")
    games = spark.createDataFrame([(1, 3, "old"), (2, 4, "Sea Cards")], "id long, external_id long, name string")
    sets = spark.createDataFrame([], "external_id long, game_id long, name string, code string, published_on timestamp, vendor_expansion string")
    names = spark.createDataFrame([("deep", 7)], "name string, vendor_id long")
    g, s = jobs.catalogue_sync(cats, groups, terms, names, games, sets, now)
    assert rows(g) == [(1, 3, "Sea Cards Japan"), (2, 4, "Sea Cards")] and rows(s, "external_id", "game_id", "name", "code") == [(30, 1, "Deep", "DP")]

    entry = "array<struct<name:string,value:string>>"
    items = spark.createDataFrame([(100, 30, 3, "Fox", "Fox", "https://cdn.example.com/100_200w.jpg", "u", None, 1, None, [("Number", "5"), ("Rarity", "R")]), (101, 30, 3, "Box", "Box", "", "u", None, 1, None, [])], f"productId long, groupId long, categoryId long, name string, cleanName string, imageUrl string, url string, modifiedOn string, imageCount int, presaleInfo struct<a:int>, extendedData {entry}")
    listed = spark.createDataFrame([(100, "Normal", 1.0, 2.0, 3.0, 2.5, None), (999, "Normal", 1.0, 1.0, 1.0, 1.0, None)], "productId long, subTypeName string, lowPrice double, midPrice double, highPrice double, marketPrice double, directLowPrice double")
    products = spark.createDataFrame([(7, 100, 30, "old", None, None, None, 0)], "id long, external_id long, set_id long, name string, number string, rarity string, kind string, image_count int")
    held = spark.createDataFrame([(100, "Old", "x"), (100, "@v.cost", "3")], "product_id long, name string, value string")
    hashes = spark.createDataFrame([(100, "other")], "product_id long, hash string")
    prices = spark.createDataFrame([], "product_id long, source string, variant string, finish string, condition string, grade string, company string, is_signed int, is_error int, is_perfect int, market double, low double, mid double, high double, updated_at long")
    got = jobs.group_processing(items, listed, products, images(spark), held, hashes, prices, now, "best.example", "worst.example")
    assert rows(got["products"], "id", "external_id", "name", "number", "kind") == [(7, 100, "Fox", "5", "card"), (None, 101, "Box", None, "sealed")]
    assert rows(got["attributes"]) == [(100, "@v.cost", "3"), (100, "Number", "5"), (100, "Rarity", "R")]
    assert rows(got["prices"], "product_id", "variant", "market") == [(100, "Normal", 2.5)]
    assert rows(got["images"].filter("product_id = 100"), "source_url") == [("https://cdn.example.com/100_in_1000x1000.jpg",)]
    again = jobs.group_processing(items, listed, got["products"], got["images"], got["attributes"].filter("name <> 'Number'"), got["hashes"], got["prices"], now, "best.example", "worst.example")
    assert rows(again["attributes"]) == [(100, "@v.cost", "3"), (100, "Rarity", "R")]  # an unchanged hash writes nothing


def test_enrichment_and_fill(spark):
    now = 1_750_000_000
    body = '{"id":"c","variants":[{"name":"normal","prices":[{"type":"raw","condition":"nm","currency":"USD","market":"3","low":"2"},{"type":"raw","condition":"lp","currency":"EUR","market":"9"}],"pop_reports":[{"company":"psa","total":"8","grades":[{"grade":"10","count":"3"}]}]}]}'
    cards = spark.createDataFrame([(1, body)], "product_id long, body string").select("product_id", F.from_json("body", records.CARD).alias("card"))
    sold = spark.createDataFrame([(1, '[{"id":"s1","title":"t","price":"4","sold_at":"2025-06-01T00:00:00Z"},{"id":"s2","title":"t","price":"4","sold_at":"2020-06-01T00:00:00Z"}]')], "product_id long, body string")
    days = spark.createDataFrame([(1, '{"history":[{"date":"2025/06/01","market":"3"},{"date":"2019-06-01","market":"3"}]}')], "product_id long, body string")
    key = "product_id long, source string, variant string, finish string, condition string, grade string, company string, is_signed int, is_error int, is_perfect int"
    empty = {
        "prices": key + ", market double, low double, is_graded int, updated_at long", "population": "product_id long, variant string, company string, grade string, count double, total double, updated_at long",
        "sold": "listing_id string, product_id long, title string, price double, sold_at long", "history": "product_id long, variant string, condition string, grade string, company string, date string, low double, market double",
    }
    got = jobs.enrichment(cards, sold, days, {k: spark.createDataFrame([], v) for k, v in empty.items()}, F.lit(150.0), now)
    assert rows(got["prices"], "product_id", "source", "condition", "market", "low") == [(1, "vendor", "NM", 3.0, 2.0)]
    assert rows(got["population"], "company", "count", "total") == [("PSA", 3.0, 8.0)]
    assert rows(got["sold"], "listing_id", "price") == [("s1", 4.0)] and rows(got["history"], "date", "market") == [("2025-06-01", 3.0)]

    vendor = spark.createDataFrame([("c1", [10], "1", "e", "3", ["R", ""]), ("c2", [99], "7", "e", "", None)], "card_id string, market_ids array<long>, number string, expansion string, cost string, colours array<string>")
    products = spark.createDataFrame([(1, 10, "1", "e"), (2, 11, "7", "e")], "id long, ext_id long, number string, expansion string")
    stored = spark.createDataFrame([(1, "@v.cost", "2"), (2, "@v.cost", "4"), (1, "Rarity", "R")], "id long, name string, value string")
    assert rows(jobs.attribute_fill(vendor, products, stored, "v", ["cost", "colours"])) == [(1, "@v.colours", "R"), (1, "@v.cost", "3"), (1, "Rarity", "R"), (2, "@v.cost", "4")]
