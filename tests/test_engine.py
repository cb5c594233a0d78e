import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.functions import money, text
from lodestone.operators import matching, stats
from lodestone.operators.merge import merge
from lodestone.plans import catalog
from lodestone.sources import files
from lodestone.streaming import drain

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw, want", [("$46.47", 4647), ("$1,234.56", 123456), ("12", 1200), ("$0.05", 5), ("", None), ("$0.00", None), ("abc", None), (None, None), ("$2,200.00 ", 220000)])
def test_dollars(spark, raw, want):
    assert one(spark, raw, money.dollars_to_cents) == want


@pytest.mark.parametrize("raw, want", [("058/102", "58"), ("000", ""), (" 07", "07"), ("TG05/30", "tg05")])
def test_clean_number(spark, raw, want):
    assert one(spark, raw, text.clean_number) == want


def test_text(spark):
    assert one(spark, "Pokémon  Box-Set!", text.norm) == "pok mon box set"
    assert one(spark, "<b>A &amp; B</b>&nbsp;\r\n c", text.plain_text) == "A & B c"
    assert one(spark, "Booster Box japanese", lambda c: text.language(c, ["japanese"])) == "japanese"
    assert one(spark, "012345678905", text.barcode_forms) == ["012345678905", "0012345678905"]
    assert one(spark, "Pikachu #58", text.digit_token) == "58"
    assert one(spark, "tg5/30", text.card_number) == "TG05"


def test_currency(spark):
    f = lambda cur, rate: spark.range(1).select(money.currency_factor(F.lit(cur), F.lit(rate)).alias("x")).first()["x"]
    assert f("USD", None)["factor"] == f("", None)["factor"] == 1.0
    assert f("JPY", 150.0)["factor"] == 1 / 150
    assert f("JPY", 5.0)["reason"] == "no-rate" and f("EUR", 150.0)["reason"] == "unsupported"
    assert one(spark, 1.005, lambda c: money.convert(c, F.lit(1.0)), "double") == 1.0


def test_robust(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (100, 102, 98, 101, 99, 5000)] + [("b", 1.0), ("b", 900.0)], "k string, v double")
    assert sorted(r["v"] for r in stats.fence(df, "v", ["k"]).filter("k = 'a'").collect()) == [98, 99, 100, 101, 102]
    s = {r["k"]: r for r in stats.robust_summary(df, "v", ["k"]).collect()}
    assert s["b"]["low_confidence"] and s["b"]["median"] == 450.5


def test_merge_policies(spark):
    target = spark.createDataFrame([("a", 1, 10, None, "open", 2), ("b", 5, None, 7, "open", 1)], "k string, o int, n int, p int, i string, c long")
    rows = [("a", 1, None, 3, 4, "x"), ("a", 2, 8, None, 5, "y"), ("c", 3, 1, 2, 3, "z"), (None, 4, 1, 1, 1, "w")]
    incoming = spark.createDataFrame(rows, "k string, seq int, o int, n int, p int, i string")
    out = {r["k"]: tuple(r)[1:] for r in merge(target, incoming, ["k"], {"o": "overwrite", "n": "new_if_set", "p": "keep_if_set", "i": "insert_only", "c": "counter"}, "seq").collect()}
    assert out == {"a": (8, 3, 4, "open", 4), "b": (5, None, 7, "open", 1), "c": (1, 2, 3, "z", 1), "": (1, 1, 1, "w", 1)}
    assert merge(target, incoming, ["k"], {"o": "overwrite"}, "seq", insert=False).count() == 2


def test_ladder(spark):
    cards = [(7, "12345", "Charizard ex", "125", "Scarlet 151"), (8, "1", "Pikachu", "058/102", "Base Set"), (9, "2", "Gengar", "307", "Gem Pack"), (20, "55555", "DON Card (Dodgers 2026 Promo)", "", "Promotion Cards"), (21, "9", "Trainer Card", "", "Base Set"), (22, "10", "Trainer Card", None, "Base Set")]
    candidates = spark.createDataFrame([(*x, "card") for x in cards], "id long, ext_id string, name string, number string, set_name string, kind string")
    rows = [
        (1, "Charizard ex #125", "Monsters 151", "12345", False), (2, "Pikachu #58", "Monsters Base Set", "", False), (3, "Mewtwo #10", "Base Set", "", False), (4, "DON Card Dodgers", "One Promo", "0", False),
        (5, "Trainer Card", "Base Set", "x", False), (6, "Old", None, None, False), (7, "Gengar #307", "Monsters Chinese Gem Pack", "", False), (8, "Gengar #307", "", "", False), (9, "Gengar #307", "Base Set", "", False),
        (10, "DON Card Dodgers", "Promo", "", True), (11, "", "", "", False), (12, "Charizard ex #125", "Scarlet 151", "99999", False), (13, "Blastoise", "Scarlet 151", "12345", False),
    ]
    stamped = spark.createDataFrame([(6, 99), (5, None)], "row_id long, id long")
    got = {r["row_id"]: (r["id"], r["method"], r["rung"]) for r in matching.ladder(spark.createDataFrame(rows, "row_id long, name string, console string, ext_id string, sealed boolean"), stamped, candidates).collect()}
    none = (None, None, None)
    assert got == {1: (7, "tcg-id", "tcg-id"), 2: (8, "fuzzy", "fuzzy"), 3: none, 4: (20, "numberless", "numberless"), 5: none, 6: (99, None, "stamped"), 7: none, 8: none, 9: none, 10: none, 11: none, 12: (7, "fuzzy", "fuzzy"), 13: none}


def test_validation(spark):
    ok = lambda a, b: spark.range(1).select(matching.validates(F.lit(a), F.lit(b)).alias("x")).first()["x"]
    assert ok("Gengar (Holo Rare)", "Gengar holo #3") and not ok("Gengar", "Haunter") and not ok("", "Gengar") and ok("ex", "") and not ok("Gengar (Holo Rare Gold)", "Gengar gold")


def test_guide(spark, tmp_path):
    (tmp_path / "g.tsv").write_text('Id\t Loose-Price\tmanual-only-price\tgenre\tname\n1\t"$2,200.00 "\t$1,450.50\t\t"a ""b"", c"\n2\t$120.00\t$999.00\tSealed Product\tbox\n3\t\t\t\t\n')
    df = files.read_guide(spark, str(tmp_path / "g.tsv"))
    assert df.columns == ["id", "loose-price", "manual-only-price", "genre", "name"] and df.filter("id = '1'").first()["name"] == 'a "b", c'
    got = sorted(tuple(r) for r in files.guide_prices(df, "id", {"loose-price": "ungraded", "manual-only-price": "PSA 10"}).collect())
    assert got == [("1", "PSA 10", 145050), ("1", "ungraded", 220000), ("2", "ungraded", 12000)]


def test_feed(spark):
    rss = "<rss><channel><item><title><![CDATA[A &amp; B]]></title><link>http://x/1</link><pubDate>d</pubDate></item><item><title>again</title><link>http://x/1</link></item></channel></rss>"
    atom = '<feed><entry><title>T</title><link rel="self" href="http://s"/><link rel="alternate" href="http://y/2"/><updated>u</updated></entry></feed>'
    got = {(r["k"], r["link"], r["title"]) for r in files.feed_items(spark.createDataFrame([(1, rss), (2, atom), (3, None)], "k int, xml string")).collect()}
    assert got == {(1, "http://x/1", "A & B"), (2, "http://y/2", "T")}


def test_drain(spark, tmp_path):
    log = spark.createDataFrame([(1, '["a","b"]'), (2, '["b"]'), (3, "oops")], "id long, keys_json string")
    assert {tuple(r) for r in drain.work_items(log).collect()} == {("a", 1, 1), ("b", 1, 2)}
    done = spark.createDataFrame([("b",)], "key string")
    assert {tuple(r) for r in drain.outcomes(log, done).collect()} == {(1, "error"), (2, "complete"), (3, "failed")}
    rows = spark.createDataFrame([("u", 1, 5.0), ("u", 2, None), ("v", 3, 1.0)], "k string, seq long, x double")
    for i in range(2):
        rows.filter(f"seq % 2 = {i}").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    drain.drain(spark, stream, str(tmp_path / "state"), ["k"], {"x": "new_if_set"}, "seq", str(tmp_path / "cp"))
    assert {tuple(r) for r in drain.latest(spark, str(tmp_path / "state")).collect()} == {("u", 5.0), ("v", 1.0)}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df, rel = catalog.queries()[name](spark, SF), con.sql(catalog.oracle_sql()[name])
    order = [list(rel.columns).index(c) for c in df.columns]
    flat = lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    assert sorted((flat(r) for r in df.collect()), key=repr) == sorted((flat(r[i] for i in order) for r in rel.fetchall()), key=repr)
