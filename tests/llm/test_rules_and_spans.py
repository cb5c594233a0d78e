"""URL rules by the thousand against all of them; base spans of secrets against Python's re; the randomness tests against a plain version."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.llm import secret_scans, url_filters


def test_many_rules(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeXY7") for _ in range(r.randrange(1, 4)))
    rules = [url_filters.site_rule(r.choice(["allow", "block"]), ".".join(word().lower() for _ in range(r.randrange(1, 3))), "/" + "/".join(word() for _ in range(r.randrange(3)))) for _ in range(600)]
    for _ in range(600):
        w = word().lower()
        rules.append(url_filters.pattern_rule(r.choice(["allow", "block"]), rf"[/?&.]{w}[/=.?]", w))
    rules += [url_filters.pattern_rule("block", r"ab7$"), url_filters.pattern_rule("allow", r"^https")]
    urls = [f"{r.choice(['http', 'HTTPS'])}://{word()}.{word()}{r.choice(['', '/'])}{word()}/{word()}?{word()}={word()}" for _ in range(80)] + [None, "", "no scheme", "http://", "http://a.b/" + "ab/" * 3000, "http://a.b/x"] * 2
    lower = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x)

    def plain(u):
        if u is None:
            return None, "allow"
        host, path = "", ""
        if "://" in u:
            rest = u.split("://", 1)[1]
            host = lower(re.match(r"[^/?#]*", rest)[0])
            path = re.match(r"(/[^?#]*)?", rest[len(host) :])[0]
        fit = [x for x in rules if re.search(x.pattern, host + path if x.label else lower(u))]
        sites = [x for x in fit if x.label]
        if sites:
            best = max(sites, key=lambda x: (x.length, x.label, x.action))
            return best.label, best.action
        return None, "block" if {x.action for x in fit} == {"block"} else "allow"

    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, verdict int").withColumn("host", F.lit("x"))
    want = {i: plain(u) for i, u in enumerate(urls)}
    for carried in (10**6, 0):
        got = url_filters.judge(df, rules, carried).select("page_id", "rule", "verdict").collect()
        assert {x["page_id"]: (x["rule"], x["verdict"]) for x in got} == want
    assert all(x.tokens for x in url_filters.PATTERN_RULES + url_filters.SITE_RULES)


def test_base_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in secret_scans.scan(docs).collect()}
    found = 0
    for r in docs.collect():
        t = r["text"] or ""
        want = {"assign": [m.span() for m in re.finditer(secret_scans.ASSIGN, t) if len(m[2]) >= 6], "access": [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20], "hex": [m.span() for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]}
        for kind, spans in want.items():
            assert [(x["s"], x["e"]) for x in got[r["doc_id"]][kind]] == spans
            found += len(spans)
    assert found > 10


def tail(z):
    return math.erfc(z / math.sqrt(2)) / 2


def plain_battery(token):
    """For tokens of mixed case with digits: alphabet of 64, no capitals' correction."""
    n, k = len(token), 64
    v = [ord(x) for x in token]
    mean = sum(v) / n
    chi = sum(token.count(x) ** 2 for x in set(token)) * k / n - n
    var = sum((x - mean) ** 2 for x in v)
    serial = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:])) / var * math.sqrt(n)
    high = sum(x > mean for x in v)
    turns = sum((a > mean) != (b > mean) for a, b in zip(v, v[1:])) + 1
    want = 2 * high * (n - high) / n + 1
    runs = (turns - want) / math.sqrt(max((want - 1) * (want - 2) / (n - 1), 1e-9))
    a = -math.log(max(2 * tail(abs(serial)), 1e-30)) - math.log(max(2 * tail(abs(runs)), 1e-30))
    c = max(k * secret_scans.TEXT_MATCH - 1, secret_scans.NUMBER_EXCESS)
    z = ((k - 1) + n * c - chi) / math.sqrt(2 * (k - 1) + 4 * n * c)
    return 1.0 if math.exp(-a) * (1 + a) < secret_scans.NOT_RANDOM else tail(z)


def test_battery(spark):
    r = random.Random(2)
    tokens = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(r.randrange(20, 90))) + "aZ3" for _ in range(120)]
    tokens += ["aaaaaaaaaaBBBBBBBBBB1111111111+aZ", "abcabcabcabcabcABC123123123/"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secret_scans.battery(F.col("t")).alias("p"))
    for x in df.collect():
        assert x["p"] == pytest.approx(plain_battery(x["t"]), rel=1e-3, abs=1e-6)
