"""Plans that must not grow with repeated work, and their results against plain Python."""

import random
import statistics

from lodestone.operators import jobs, matching


def test_graded_comps_reads_listings_once(spark, tmp_path):
    rng, rows = random.Random(5), []
    titles = ["Red Fox 5 PSA 9", "Lot of Red Fox 5 PSA 9", "Blue Owl 5 PSA 9", "Red Fox 5 PSA 9 x3", "", None, "joblot red fox 5 psa 9", "Red Fox 5 PSA 9 psa 9.5"]
    for slab in range(12):
        for _ in range(rng.choice([1, 4, 9, 30])):
            rows.append((slab, "Red Fox", "5", "PSA", "9", rng.choice(titles[:1] * 6 + titles), float(rng.choice([0, 10, 11, 12, 13, 900])), rng.choice([None, 1, 100])))
    kind = "slab long, name string, number string, company string, grade string, title string, price double, sold_at long"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "sold"))
    got = jobs.graded_comps(spark.read.parquet(str(tmp_path / "sold")), 50)

    def summary(prices):
        if not prices:
            return None
        m = statistics.median(prices)
        d = statistics.median(abs(p - m) for p in prices)
        kept = [p for p in prices if len(prices) < 10 or d == 0 or abs(p - m) <= 3.5 * 1.4826 * d]
        return len(kept), statistics.median(kept), min(kept), max(kept)

    want = {}
    for slab in range(12):
        kept = [(r[6], r[7]) for r in rows if r[0] == slab and r[5] in (titles[0], titles[7]) and r[6] > 0]
        near, far = summary([p for p, t in kept if t is not None and t >= 50]), summary([p for p, _ in kept])
        if far:
            want[slab] = far if (near[0] if near else 0) < 5 and far[0] > (near[0] if near else 0) else near
    assert {r["slab"]: (r["n"], r["median"], r["low"], r["high"]) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def joined_rows(df):
    """The most rows that a join of the plan that ran put out."""
    df.collect()
    found, todo = [0], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name != "ReusedExchange":
            if "Join" in name:
                found.append(node.metrics().apply("numOutputRows").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return max(found)


def test_vendor_match_makes_no_pairs_of_a_group(spark):
    cards = spark.range(400).selectExpr("id AS card_id", "array(id + 1000) AS market_ids", "concat('B#', id % 2) AS number", "'e' AS expansion")
    products = spark.range(7, 407).selectExpr("id", "CAST(id + 1390 AS long) AS ext_id", "concat('b#', id % 2) AS number", "'e' AS expansion")
    got = matching.vendor_match(cards, products)
    by_id = {x + 1390: x for x in range(7, 407)}
    assert {r["card_id"]: r["id"] for r in got.collect()} == {c: by_id.get(c + 1000, 8 if c % 2 == 0 else 7) for c in range(400)}
    assert joined_rows(got) <= 400
    assert matching.vendor_match(cards, products, every=True).count() == 3 + 397 * 200


def test_ladder_judges_texts_once(spark):
    rows = spark.range(600).selectExpr("id AS row_id", "CASE WHEN id % 2 = 0 THEN 'Red Fox #7' WHEN id % 3 = 0 THEN 'Blue Owl #7' ELSE 'Red Foxes #7/9' END AS name", "CASE WHEN id % 5 = 0 THEN 'Deep Sea Japanese' WHEN id % 7 = 0 THEN NULL ELSE 'The Deep Sea' END AS console", "'' AS ext_id", "false AS sealed")
    candidates = spark.range(5, 605).selectExpr("id", "CAST(NULL AS string) AS ext_id", "CASE WHEN id % 2 = 0 THEN 'Red Fox 7' ELSE 'Old Owl' END AS name", "'007' AS number", "IF(id % 4 < 2, 'Deep', 'Deep Japanese') AS set_name", "'card' AS kind")
    got = matching.numbered_match(rows, candidates)
    lowest = {True: min(i for i in range(5, 605) if i % 2 == 0 and i % 4 >= 2), False: min(i for i in range(5, 605) if i % 4 == 0)}
    assert {r["row_id"]: r["id"] for r in got.collect()} == {i: lowest[i % 5 == 0] for i in range(0, 600, 2) if i % 5 == 0 or i % 7}
    assert joined_rows(got) <= 600

    plain = rows.selectExpr("row_id", "replace(replace(name, '#7/9', ''), '#7', '') AS name", "console")
    one = candidates.filter("id = 6 OR (id % 2 = 1 AND id > 6)").selectExpr("id", "IF(id = 6, 'Red Fox', 'Owl') AS name", "'Deep' AS set_name")
    met = matching.contained_match(plain, one)
    assert {r["row_id"]: r["id"] for r in met.collect()} == {i: 6 for i in range(600) if i % 5 and i % 7 and (i % 2 == 0 or i % 3)}
    assert joined_rows(met) <= 600
