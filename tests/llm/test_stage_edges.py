"""Pipeline stages on nulls, repeated rows, clashing names and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm.ngram_join import near_duplicate_stage

GOOD = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80))
OTHER = " ".join(f"v{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80))
ROWS = [(1, GOOD, "s"), (1, GOOD, "s"), (None, GOOD + " end", None), (None, OTHER, "s"), (None, OTHER, "s"), (2, None, "s"), (2, None, "s"), (3, "", "s"), (4, "x" * 20000, None), (5, " \n\t", "s")]
CLASH = ("kept", "removed", "assign", "random", "hex", "node", "n", "t", "d", "root", "n_words", "clean_text", "_text", "_host", "_h", "_r", "_lines", "component_id", "x", "sig")


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumns({c: F.lit(7) for c in CLASH}).withColumn("n_chars", F.length("text"))


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns(spark, frame, k):
    stage = corpus_pipeline.STAGES[k][1]
    got = stage(spark, frame, "")
    assert got.columns == frame.columns and [x.dataType for x in got.schema] == [x.dataType for x in frame.schema]
    rows = got.collect()
    assert rows and all(r[c] == 7 for r in rows for c in CLASH)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
    assert stage(spark, frame.limit(0), "").count() == 0


def test_packing_of_odd_rows(spark, frame):
    got = corpus_pipeline.STAGES[4][1](spark, frame, "").collect()
    assert sum(r["start"] == 0 for r in got) == len(ROWS) and sum(r["length"] for r in got if r["doc_id"] == 2) == 2


def test_near_duplicates_without_ids(spark, frame):
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in near_duplicate_stage(spark, frame, "").collect())
    want = [("1", GOOD), ("None", OTHER), ("2", ""), ("2", ""), ("3", ""), ("4", "x" * 20000), ("5", " \n\t")]
    assert got == sorted(want)
