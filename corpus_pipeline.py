"""The corpus pipeline: quality rules, line dedup, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. run() writes each stage's result as
Parquet in the shared folder and reads it again as the next one's docs, so a lost executor costs no more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.common import table, written
from lodestone.llm.line_dedup import line_stage
from lodestone.llm.ngram_join import near_duplicate_stage
from lodestone.llm.packing import pack
from lodestone.llm.quality_rules import quality_stage
from lodestone.llm.secret_scans import secrets_stage


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, a row each."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]
#: Packing's tokenizer and BM25 order can't be put in SQL; tests/llm/test_pipeline.py holds the stages and run() against plain
#: Python, for packing that each token of each document is there once.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
