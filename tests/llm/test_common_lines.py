"""A line's limit does not rise with its host, and texts meet common lines whichever way they are joined."""

import pytest

from lodestone.llm import quality_rules


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_limit_is_the_same_in_large_hosts(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality_rules, "BROADCAST_LINES", broadcast)
    letters = lambda i: "".join("abcdefghij"[int(x)] for x in f"{i:04}")
    own = lambda i: " ".join(f"{letters(i)}{w}" for w in [a + b for a in "pqrstuvw" for b in "pqrstuvw"]) + f" {letters(i)}"
    body = lambda i: own(i) + ("\nall rights reserved here" if i % 60 == 0 else "\nseldom seen words" if i % 90 == 1 else "")
    rows = [(i, body(i), "large") for i in range(400)] + [(1000, body(0), "large"), (1001, body(0), None), (None, "all rights reserved here\n" * 60 + own(999), "large")]
    out = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), texts=6).collect()
    assert len(out) == len(rows)
    for x in out:
        want = 60 if x["doc_id"] is None else int(x["doc_id"] in (0, 60, 120, 180, 240, 300, 360, 1000))
        assert x["n_common_lines"] == want and x["kept"] == (x["doc_id"] is not None)
