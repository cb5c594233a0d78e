"""The pipeline's line stage takes exact repeats of short lines with words; the query keeps to its SQL."""

from lodestone.llm import line_dedup


def test_repeats_of_short_lines_go(spark):
    rows = [(1, "Read more\n\nbody of one"), (2, "body of two\nRead more\n \nRead mare\n"), (3, "Read more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["text"] for x in line_dedup.line_stage(spark, docs, "").collect()}
    assert got == {1: rows[0][1], 2: "body of two\n \nRead mare\n"}
    assert all(x["removed"] == [] for x in line_dedup.dedup_lines(docs).collect())
