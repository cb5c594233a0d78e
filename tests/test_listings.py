import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from lodestone.functions import images
from lodestone.operators import attributes, listings


def test_fingerprints(spark):
    y, x = np.mgrid[0:88, 0:64]
    g = ((x * 3 + y * 2) % 256).astype(np.uint8)
    assert images.fingerprint(images.grey(np.dstack([g, g, g]))).hex() == "0000000103060c18000000000000000000000000000100030006000c0038007000e001c00380"
    y, x = np.mgrid[0:420, 0:300]
    v = np.where((x >= 60) & (x < 240) & (y >= 60) & (y < 360), 150 + (x * 7 + y * 5) % 80, 30).astype(np.uint8)
    assert images.fingerprint(v).hex() == "000303030303230000000000042c005c0a8c02ac040c005c0a8c02ac040c005c0aac00000000"

    def png(rows, kind):
        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        filtered, above = b"", [0] * rows.shape[1]
        for r in rows.tolist():
            p = lambda a, b, c: min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            left = [0, *r[:-1]]
            guess = {0: lambda i: 0, 1: lambda i: left[i], 2: lambda i: above[i], 3: lambda i: (left[i] + above[i]) // 2, 4: lambda i: p(left[i], above[i], above[i - 1] if i else 0)}[kind]
            filtered += bytes([kind, *[(r[i] - guess(i)) % 256 for i in range(len(r))]])
            above = r
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", rows.shape[1], len(rows), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(filtered)) + chunk(b"IEND", b"")

    rows = [(k, bytearray(png(g, k))) for k in range(5)] + [(5, bytearray(b"none")), (6, None)]
    got = {r["k"]: bytes(r["fingerprint"]) for r in images.with_fingerprints(spark.createDataFrame(rows, "k int, c binary"), "k", "c").collect()}
    assert got[5] == got[6] == b"" and {got[k] for k in range(5)} == {images.fingerprint(g)}


def test_attributes(spark):
    e = [("Number", "58/102"), ("Card Type", "<b>Fire</b>&#233;&#x1F600;"), ("Number", "2"), ("@x.y", "z"), ("Attack 1", "t"), ("Flavor Text", "t"), (" ", "t"), ("Empty", "<i>"), ("Long", "x" * 513), (None, "v")]
    df = spark.createDataFrame([(1, e), (2, None), (3, [("a" + str(i), "v") for i in range(70)])], "k int, a array<struct<name:string,value:string>>")
    got = attributes.extract(df, "k", "a").collect()
    assert [tuple(r)[1:] for r in got if r["k"] == 1] == [("Number", "58/102", 0), ("Card Type", "Fire é😀", 1)]
    assert sum(r["k"] == 3 for r in got) == 64 and not any(r["k"] == 2 for r in got)
    assert attributes.external_key("scry", "mana") == "@scry.mana"


def test_listings(spark):
    t = spark.createDataFrame([("Card lot", True), ("Charizard x2", True), (None, True), ("Charizard 4/102 PSA 9", False)], "t string, w boolean")
    assert all(r["x"] == r["w"] for r in t.select(listings.excluded(F.col("t")).alias("x"), "w").collect())
    t = spark.createDataFrame([("Charizard 4/102 PSA 9", True), ("Charizard 4/102 PSA 9.5", False), ("Charizard 4/102 CGC 9", False), ("Mew 4 PSA 9", False), (None, False)], "t string, w boolean")
    assert all(r["x"] == r["w"] for r in t.select(listings.names_item(F.col("t"), F.lit("Charizard"), F.lit("4/102"), F.lit("PSA"), F.lit("9")).alias("x"), "w").collect())


def test_title_match(spark):
    titles = [("a", 1, "NEW Pokémon Stardust Trails Booster Box"), ("a", 2, "stardust trails booster box x2"), ("a", 3, "Trails junk stardust box booster")]
    got = listings.aggregate_titles(spark.createDataFrame(titles, "key string, n int, t string"), "key", "t", "n").collect()
    assert [tuple(r) for r in got] == [("a", "stardust trails booster box")]
    c = spark.createDataFrame([(10, "Stardust Trails Booster Box", "Stardust Trails"), (11, "Stardust Trails Booster Box Case", "Stardust Trails")], "id int, name string, set_name string")
    k = spark.createDataFrame([("a", "pokemon stardust trails booster box"), ("b", "pokemon stardust trails booster box case"), ("c", "pokemon japanese stardust trails booster box"), ("d", "pokemon booster box"), ("e", "stardust trails wonderful booster box"), ("f", "stardust trails rainy booster box")], "key string, aggregate string")
    assert sorted(tuple(r) for r in listings.match_aggregates(k, c).collect()) == [("a", 10, 2), ("f", 10, 2)]  # of e, only the shortest searched word may go
