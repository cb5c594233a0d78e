"""Random keys of letters or of digits only are found; words joined in the usual ways are not."""

import random

from lodestone.llm import secret_scans

LOW = "abcdefghijklmnopqrstuvwxyz"
WORDS = "the quality rules count distinct texts across hosts while documents without common lines stay whole and every reader learns more from original prose".split()


def test_keys_of_one_kind(spark):
    r = random.Random(8)
    key = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    keys = [key(LOW + LOW.upper(), 80), key(LOW, 140), key("0123456789", 80), key(LOW + LOW.upper() + "+/", 80)]
    plain = []
    for join in ("".join, "-".join, "/".join, lambda w: "".join(x.title() for x in w)):
        plain += [join([r.choice(WORDS) for _ in range(n)]) for n in (6, 9, 14, 20) for _ in range(3)]
    plain += ["0" * 40, "a" * 40, "12345678901234567890123456789012345678901234567890"]
    rows = list(enumerate(keys + plain))
    out = {x["doc_id"]: len(x["random"]) for x in secret_scans.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i] for i in range(len(keys))] == [1] * len(keys)
    assert sum(out[i] for i in range(len(keys), len(rows))) == 0
