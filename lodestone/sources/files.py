"""Landed files as DataFrames: guide tables with either separator, feeds, and paged JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.money import dollars_to_cents


def separator(header: str) -> str:
    """Tab where a header line has at least as many tabs as commas, and any."""
    return "\t" if header.count("\t") >= header.count(",") and "\t" in header else ","


def read_guide(spark: SparkSession, path: str) -> DataFrame:
    """A delimited table with a header line: lower-case trimmed names, every value a string, missing ones empty."""
    header = spark.read.text(path).head()
    sep = separator(header[0] if header else "")
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False, quote='"', escape='"', multiLine=True)
    return df.toDF(*[c.strip().lower() for c in df.columns]).fillna("")


def guide_prices(df: DataFrame, key: str, labels: dict[str, str], sealed: str = "genre") -> DataFrame:
    """(key, grade, cents): price columns as rows, by a label each; sealed goods have the ungraded price only."""
    long = df.select(key, sealed, *labels).unpivot([key, sealed], list(labels), "column", "raw")
    names = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    out = long.select(key, sealed, F.element_at(names, F.col("column")).alias("grade"), dollars_to_cents(F.col("raw")).alias("cents"))
    return out.filter("cents is not null").filter((F.trim(sealed) != "Sealed Product") | (F.col("grade") == "ungraded")).select(key, "grade", "cents")


def feed_items(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """feeds with title, link, published of each item or entry; of equal links in a feed the first stays."""
    items = feeds.select("*", F.posexplode(F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<(?:item|entry)[\s>].*?</(?:item|entry)>"), F.lit(0))).alias("pos", "_item"))

    def text(tag: str):
        raw = F.regexp_extract("_item", rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)
        out = F.regexp_replace(raw, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")
        for entity, to in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
            out = F.replace(out, F.lit(entity), F.lit(to))
        return F.nullif(F.trim(out), F.lit(""))

    other = F.nullif(F.regexp_extract("_item", r'<link(?![^>]*rel="self")[^>]*href="([^"]*)"', 1), F.lit(""))
    rows = items.withColumns({"title": text("title"), "link": F.coalesce(text("link"), other), "published": F.coalesce(text("pubDate"), text("published"), text("updated"))}).filter("link is not null")
    keys = [c for c in feeds.columns if c != xml]
    return rows.groupBy(*keys, "link").agg(F.min_by("title", "pos").alias("title"), F.min_by("published", "pos").alias("published"))


def json_pages(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Items of landed pages {"results": [...]}, one row per key; a malformed page gives none."""
    pages = spark.read.text(path, wholetext=True).select(F.from_json("value", f"results array<struct<{schema}>>").alias("p"))
    return pages.select(F.explode("p.results").alias("r")).select("r.*").dropDuplicates([key])
