"""Scalars, nested records, tables' writes and what runs around jobs."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import catalogue as c
from lodestone.functions import money
from lodestone.operators import control, records, tables
from lodestone.streaming import drain


def values(spark, rows, kind, **columns):
    df = spark.createDataFrame(rows, kind)
    return [tuple(r) for r in df.select(*[f.alias(k) for k, f in columns.items()]).collect()]


def test_scalars(spark):
    got = values(
        spark, [(" cgs ", "9.5", "058/102", "Sv1"), ("", "x", "TG5/30", ""), (None, None, None, None), ("PSA", "10", "000", "a")], "co string, g string, n string, e string",
        co=c.company(F.col("co")), key=c.graded_key(F.col("co"), F.col("g")), card=c.derived_card_id(F.col("e"), F.col("n")), url=c.image_url("https://i.example/x/", F.col("e"), F.col("n")), label=c.grade_label(c.company(F.col("co")), F.col("g")),
    )
    assert got == [("CGC", "box-only-price", "sv1-58", "https://i.example/x/Sv1-58/large", "CGC 9.5"), (None, None, None, None, None), (None, None, None, None, None), ("PSA", "manual-only-price", "a-0", "https://i.example/x/a-0/large", "PSA 10")]
    texts = [("$1,234.56 or 7", "Gengar #307 [Holo]"), ('{"amount": "12"}', "Booster Box"), ("-3", ""), ("free", None)]
    got = values(spark, texts, "p string, n string", p=c.sale_price(F.col("p")), n=c.mint_name(F.col("n")))
    assert [(p, *n) for p, n in got] == [(1234.56, "Gengar [Holo]", "307"), (12.0, "Booster Box", None), (None, "", None), (None, "", None)]
    dates = [("Tue, 10 Jun 2025 04:00:00 GMT",), ("2025-06-10T04:00:00+02:00",), ("soon",), (None,)]
    assert [x[0] for x in values(spark, dates, "d string", d=c.feed_time(F.col("d")))] == ["2025-06-10T04:00:00.000Z", "2025-06-10T02:00:00.000Z", None, None]
    got = values(spark, [("https://h.example/a_200w.jpg_200w.jpg",), ("https://o.example/a_200w.jpg",), ("",), (None,)], "u string", u=c.larger_image(F.col("u"), "h.example"))
    assert [x[0] for x in got] == ["https://h.example/a_in_1000x1000.jpg_200w.jpg", "https://o.example/a_200w.jpg", None, None]
    got = values(spark, [(86400 * 3 + 5,)], "s long", day=c.utc_day(F.col("s")), cat=c.rotated(F.date_from_unix_date(F.lit(5)), list("abcd")), ext=c.extension(F.lit("image/webp")), terms=c.search_terms(F.lit(" a "), F.lit(""), F.lit("b")), at=c.http_url(F.lit("HTTPS://x.example/y?z"), "run"))
    assert got == [("1970-01-04", "b", "webp", "a b", "HTTPS://x.example/run")]
    got = values(spark, [("1700000000",), ("1700000000000",), ("2023-11-14T22:13:20Z",), ("no",)], "x string", s=money.epoch_seconds(F.col("x")))
    assert [x[0] for x in got] == [1700000000, 1700000000, 1700000000, None]
    assert values(spark, [("true", "$2,100.00"), ("1", "x"), ("yes", None)], "f string, n string", f=money.flag(F.col("f")), n=money.tolerant_number(F.col("n"))) == [(1, 2100.0), (1, None), (0, None)]


def test_precedence(spark):
    rows = [(None, "https://worst/x"), ("", "https://o/x"), ("https://worst/y", "https://o/x"), ("https://o/y", "https://worst/x"), ("https://o/y", "https://BEST/x")]
    got = values(spark, rows, "e string, i string", u=c.preferred_url(F.col("e"), F.col("i"), "best", "worst"))
    assert [x[0] for x in got] == ["https://worst/x", "https://o/x", "https://o/x", "https://o/y", "https://BEST/x"]


def test_projections(spark):
    now = F.lit(5)
    entries = "array<struct<name:string,value:string>>"
    df = spark.createDataFrame([(1, 2, 3, "A", None, "https://cdn.example.com/x_200w.png", "u", None, 1, [("number", "7"), ("Rarity", None)]), (2, 2, 3, "B", None, "", "u", None, 1, None)], f"productId long, groupId long, categoryId long, name string, cleanName string, imageUrl string, url string, modifiedOn string, imageCount int, extendedData {entries}").withColumn("presaleInfo", F.lit(None).cast("struct<isPresale:boolean>"))
    got = records.products(df, now).select("card_number", "rarity", "kind", "is_card", "image_url", "presale_info").collect()
    assert [tuple(x) for x in got] == [("7", None, "card", True, "https://cdn.example.com/x_in_1000x1000.png", None), (None, None, "sealed", False, None, None)]
    prices = spark.createDataFrame([(1, "Normal", 1.0, 1.0, 1.0, 1.0, None), (9, "Foil", 1.0, 1.0, 1.0, 1.0, 2.0)], "productId long, subTypeName string, lowPrice double, midPrice double, highPrice double, marketPrice double, directLowPrice double")
    assert [x["product_id"] for x in records.prices(prices, records.products(df, now), now).collect()] == [1]
    groups = spark.createDataFrame([(1, 3, " Pokémon GO", None, "2022-07-01T00:00:00", None, None), (2, 3, "Other", "o", "bad", None, True)], "groupId long, categoryId long, name string, abbreviation string, publishedOn string, modifiedOn string, isSupplemental boolean")
    names = spark.createDataFrame([("pokemon go", "pgo")], "name string, vendor_id string")
    assert sorted((x["set_id"], x["vendor_set_id"], x["published_on"] is None, x["is_supplemental"]) for x in records.sets(groups, names, now).collect()) == [(1, "pgo", False, False), (2, None, True, True)]
    cats = spark.createDataFrame([(1, "a", None, None, None, None, True), (2, "b", None, None, None, None, None)], "categoryId long, name string, displayName string, modifiedOn string, imageUrl string, seoText string, isDirectBrand boolean")
    assert [x["is_direct_brand"] for x in records.categories(cats, now).orderBy("category_id").collect()] == [1, 0]


def test_envelopes_and_index(spark):
    bodies = [('[{"title":"a"}]', 1), ('{"data":[{"title":"a"},{"title":"b"}]}', 2), ('{"results":[{"title":"a"}]}', 1), ("{broken", 0), (None, 0), ('{"cards":[]}', 0)]
    df = spark.createDataFrame(bodies, "b string, n int").select(F.size(records.enveloped(F.col("b"), "struct<title:string>", "cards")).alias("got"), "n")
    assert all(r["got"] == r["n"] for r in df.collect())
    rows = spark.createDataFrame([(1, 258, b"\x01\x02"), (1, 3, b"\xff\x00"), (1, 4, b""), (2, 1, None)], "g int, n long, h binary")
    assert [(r["g"], bytes(r["packed"])) for r in records.packed_index(rows, "g", "n", "h").collect()] == [(1, b"\x03\0\0\0\xff\x00" + b"\x02\x01\0\0\x01\x02")]
    items = spark.createDataFrame([(1, '{"name":"A","soldPrice":"$3.50"}'), (1, '{"title":"B","price":{"value":2}}'), (1, '{"title":"C"}')], "k int, i string")
    assert sorted(tuple(r) for r in records.titled_prices(items, "k", "i").collect()) == [(1, "A", 3.5), (1, "B", 2.0)]


def test_table_writes(spark):
    target = spark.createDataFrame([("a", "old", "e1")], "external_id string, name string, vendor_expansion string")
    incoming = spark.createDataFrame([("a", "new", "e2", 1), ("b", "x", None, 2)], "external_id string, name string, vendor_expansion string, seq int")
    assert sorted(tuple(r) for r in tables.TABLES["set"].upsert(target, incoming, "seq").collect()) == [("a", "new", "e1"), ("b", "x", None)]
    news = spark.createDataFrame([("l1", "t", 1)], "link string, title string, pos int")
    more = spark.createDataFrame([("l1", "u", 1), ("l2", "v", 2), ("l2", "w", 3)], "link string, title string, pos int")
    assert sorted(tuple(r)[:2] for r in tables.inserted_new(news, more, "link", F.col("pos")).collect()) == [("l1", "t"), ("l2", "v")]
    products = spark.createDataFrame([(10, "s", "A")], "id long, set_name string, name string")
    rows = spark.createDataFrame([("r1", None), ("r2", 5), ("r3", None)], "row_id string, id long")
    made = spark.createDataFrame([("s", "A", "r1"), ("s", "B", "r2"), ("s", "B", "r3")], "set_name string, name string, row_id string")
    for _ in range(2):
        products, rows = tables.minted(rows, products, ["set_name", "name"], made)
        assert sorted(tuple(r) for r in products.collect()) == [(10, "s", "A"), (11, "s", "B")]
        assert sorted((r["row_id"], r["id"]) for r in rows.collect()) == [("r1", 10), ("r2", 5), ("r3", 11)]
    attributes = spark.createDataFrame([(1, "a", "x", 0), (1, "b", "y", 1), (2, "a", "x", 0)], "k int, name string, value string, position int")
    hashes = tables.changed_groups(attributes, spark.createDataFrame([], "k int, hash string"), "k")
    assert hashes.count() == 2 and tables.changed_groups(attributes, hashes, "k").count() == 0
    image = spark.createDataFrame([(1, "s", "Foil", "9")], "set_id int, url string, x string, number string")
    known = spark.createDataFrame([(7, 1, "9"), (8, 1, "9"), (9, 2, "9")], "product_id int, set_id int, number string")
    assert sorted(r["product_id"] for r in tables.by_set_and_number(image, known).collect()) == [7, 8]
    assert set(tables.TABLES["listing_price"].keys) > set(tables.TABLES["drained_price"].keys)


def test_control(spark):
    told = []
    with control.stage("s", told.append) as found:
        found["rows"] = 3
    with pytest.raises(ValueError), control.stage("s", lambda row: 1 / 0):
        raise ValueError("own")
    assert [x["status"] for x in told] == ["running", "success"] and told[1]["rows"] == 3
    assert control.unchanged(5, 5) and not control.unchanged(6, 5) and not control.unchanged(None, 5) and not control.unchanged(5, 5, True)
    with pytest.raises(ValueError):
        control.checked_cadence(86400, 86400)
    cache = spark.createDataFrame([("a", "x", 10), ("b", None, 10), ("c", "z", 3), ("p:012345678905", "1", 99), ("q:0012345678905", "2", 99)], "key string, value string, expires_at long")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    hits, ask = control.cached(keys, cache, "key", 5)
    assert sorted(map(tuple, hits.collect())) == [("a", "x"), ("b", None)] and sorted(r["key"] for r in ask.collect()) == ["c", "d"]
    after = control.remembered(cache, spark.createDataFrame([("c", "n", "found"), ("d", None, "missing"), ("e", None, "transient")], "key string, value string, outcome string"), "key", 5, 100, 10)
    assert {r["key"]: (r["value"], r["expires_at"]) for r in after.collect() if r["key"] in "cde"} == {"c": ("n", 105), "d": (None, 15)}
    assert control.forgotten(cache, spark.createDataFrame([("012345678905",)], "code string"), ["p", "q"]).count() == 3
    assert control.may_spend(99, 600) and not control.may_spend(100, 600) and control.clamped(0, 5, 9) == 1 and control.clamped(None, 5, 9) == 5 and control.clamped(99, 5, 9) == 9
    near = spark.createDataFrame([("a", 3, 1.0), ("b", 5, 2.0)], "k string, n int, m double")
    far = spark.createDataFrame([("a", 4, 9.0), ("b", 9, 9.0), ("c", 1, 7.0)], "k string, n int, m double")
    assert sorted(map(tuple, control.wider(near, far, ["k"]).collect())) == [("a", 4, 9.0), ("b", 5, 2.0), ("c", 1, 7.0)]
    rows, about = control.page(spark.range(10), "id", 3, 4)
    assert [r["id"] for r in rows.collect()] == [4, 5, 6, 7] and about == {"cursor": 7, "has_more": True, "remaining": 2}
    rows, about = control.page(spark.createDataFrame([("b",), ("a",)], "id string"), "id", "b", 4)
    assert rows.count() == 0 and about == {"cursor": None, "has_more": False, "remaining": 0}
    config = spark.createDataFrame([("a", "7.9"), ("b", "-1"), ("c", "x")], "key string, value string")
    assert [control.config_int(config, k, 3) for k in "abcd"] == [7, 3, 3, 3]
    breaker = control.Breaker(most=3)
    assert [breaker.told(x) for x in ("transient", "transient", "ok", "transient", "transient", "transient")] == [True] * 5 + [False]
    log = spark.createDataFrame([("j", 1, True), ("j", 1, False), ("j", 2, False)], "job string, group int, ok boolean")
    assert tuple(control.progress(log, 2).first()) == ("j", 1, 1, "success")


def test_drain_states(spark, tmp_path):
    rows = [(1, "s.graded", '["a","b"]', "pending", 0), (2, "s.raw", '["b"]', "error", 4), (3, "t.raw", "{", "pending", 1), (4, "s.raw", '["c"]', "pending", 2), (5, "s.raw", '["d"]', "pending", 2), (6, "s.raw", "[]", "pending", 0), (7, "s.raw", '["b","c"]', "pending", 3)]
    state = spark.createDataFrame([(*r, r[0], 0, None) for r in rows], "id long, event string, keys_json string, status string, attempts int, received_at long, last_attempt_at long, completed_at long")
    taken = drain.claimed(state, F.lit(10_000_000))
    assert taken.filter("status = 'processing'").count() == 7 and drain.claimed(state, F.lit(10_000_000), ["t"]).count() == 1 and drain.claimed(state, F.lit(10_000_000), most=2).agg(F.max("id")).first()[0] == 2
    results = spark.createDataFrame([("a", "ok"), ("b", "transient"), ("c", "refused")], "key string, outcome string")
    got = {r["id"]: (r["status"], r["attempts"]) for r in drain.settled(taken, results, spark.createDataFrame([], "key string"), F.lit(10_000_000)).collect()}
    assert got == {1: ("error", 1), 2: ("failed", 5), 3: ("failed", 1), 4: ("error", 2), 5: ("pending", 2), 6: ("complete", 0), 7: ("error", 3)}
    held = drain.Snapshots(spark, str(tmp_path))
    assert held.read() is None
    for i in range(4):
        held.write(spark.range(i), f"n{i}")
    assert held.read().count() == 3 and held.newest() == (3, "n3")
