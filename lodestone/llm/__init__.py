"""Operations of a large-scale training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from importlib import import_module

MODULES = ("line_dedup", "warc", "lm_trie", "sentencepiece_lattice", "quality_rules", "url_filters", "ngram_join", "secret_scans", "mpeg_audio", "packing")


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"lodestone.llm.{name}").QUERIES
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"lodestone.llm.{name}").ORACLE
    return out
