"""Quality rules over documents, and across them: lines too frequent on their host go, and depleted documents with them.

Native DataFrame functions only. Counted are distinct texts per (host, line), so copies of one text make none of their
lines common. Texts meet common lines by rows of (host, line), so a host may have any number of texts and common lines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import SPACES, WORD_BREAK, let, lower_ascii, table, words, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Percent of words that may lie in repeated 3-word windows.
MAX_REPEATED = 50
#: A line is common if more distinct texts of its host hold it than LINE_TEXTS, however many the host has.
LINE_TEXTS = 50
#: Only ORACLE_SQL asks for this share of the host's texts as well; it is below LINE_TEXTS in hosts of up to 2,500 texts.
LINE_SHARE = 0.02
#: Percent of words that must be left when common lines are gone.
MIN_LEFT = 50
#: Rows of lines (hash, and host or text) up to which their table is broadcast; about 40 bytes each.
BROADCAST_LINES = 200_000


def normal_line(line: Column) -> Column:
    """Lower case (A-Z), digits as 0, runs of whitespace as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(lower_ascii(line), r"[0-9]+", "0"), WORD_BREAK, " "))


def line_hashes(text: Column) -> Column:
    """64-bit hashes of the normalised lines, null for lines without words."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: let(normal_line(x), lambda n: F.when(n != "", F.xxhash64(n))))


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more among w.

    Windows are hashed and sorted with their places; those with an equal neighbour are repeated, and the union of their
    places is summed from the gaps between them.
    """

    def among(s: Column) -> Column:
        at = lambda i: F.get(s, i)
        twice = F.filter(
            F.transform(s, lambda x, i: F.when((at(i - 1)["h"] == x["h"]) | (at(i + 1)["h"] == x["h"]), x["i"])), lambda x: x.isNotNull()
        )
        return let(F.array_sort(twice), lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b))

    def windows(v: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(v) - 3), lambda i: F.struct(F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)).alias("h"), i.alias("i"))))

    return let(w, lambda v: F.when(F.size(v) < 3, F.lit(0)).otherwise(let(windows(v), among))).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    return let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_counts(text: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    return {
        "n_words": F.size(words(text)).cast("long"),
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": repeated_lines(text),
        "n_repeat_words": repeated_words(words(text)),
    }


def line_rows(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(_host, _text, _l): the line hashes of each distinct text of a host."""
    d = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"), F.array_compact(F.array_distinct(line_hashes(F.col(text)))).alias("_l"))
    return d.dropDuplicates(["_host", "_text"])


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_LINES else df


def common_lines(rows: DataFrame, texts: int = LINE_TEXTS) -> DataFrame:
    """(_host, _text, _lines): the hashes of the common lines of each of line_rows' texts that has some."""
    each = rows.select("_host", "_text", F.explode("_l").alias("_line"))
    found = written(each.groupBy("_host", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") > texts).select("_host", "_line"), "common-lines")
    return each.join(small(found, found.count()), ["_host", "_line"]).groupBy("_host", "_text").agg(F.collect_list("_line").alias("_lines"))


def apply_rules(docs: DataFrame, text: str = "text", host: str = "source", **limits: int) -> DataFrame:
    """docs with base counts, n_common_lines, n_words_left, base_failed, kept and clean_text (common lines removed).

    Null text: no words, base_failed. Null host: a host of its own. Repeated rows stay and count as one text. Columns of
    docs that bear an added name are replaced. An empty table gives an empty one.
    """
    found = written(common_lines(written(line_rows(docs, text, host), "lines"), **limits), "text-lines")
    found = small(found, found.agg(F.sum(F.size("_lines"))).first()[0] or 0)
    added = [*base_counts(F.col(text)), "n_common_lines", "n_words_left", "base_failed", "kept", "clean_text"]
    base = docs.drop(*[c for c in added if c not in (text, host)])
    out = base.withColumns(base_counts(F.col(text))).withColumns({"_host": F.coalesce(F.col(host).cast("string"), F.lit("")), "_text": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    out = out.join(found, ["_host", "_text"], "left")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    common = lambda x: let(normal_line(x), lambda n: (n != "") & F.array_contains(F.col("_lines"), F.xxhash64(n)))
    clean = F.when(F.col("_lines").isNull(), F.col(text)).otherwise(F.array_join(F.filter(lines, lambda x: ~common(x)), "\n"))
    out = out.withColumn("clean_text", clean)
    out = out.withColumn("n_common_lines", F.when(F.col("_lines").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(F.split("clean_text", "\n", -1))).cast("long"))
    out = out.withColumn("n_words_left", F.when(F.col("_lines").isNull(), F.col("n_words")).otherwise(F.size(words(F.col("clean_text")))).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    out = out.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_words_left") >= MIN_LEFT * F.col("n_words")))
    return out.drop("_host", "_text", "_lines")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected rows go; the others lose their common lines, and n_chars follows. Null texts go, as they have no words; columns of any name are kept; an empty table stays empty."""
    own = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c not in ("text", "source")}
    out = apply_rules(docs.withColumnsRenamed(own)).filter("kept")
    return out.select(*[F.col("clean_text").alias("text") if c == "text" else F.length("clean_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(own.get(c, c)).alias(c) for c in docs.columns])


_W = r"[\x20\x09-\x0D]+"
_LOW = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = rf"trim(regexp_replace(regexp_replace({_LOW % 'x'}, '[0-9]+', '0', 'g'), '{_W}', ' ', 'g'))"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '{_W}'), lambda x: x <> '') AS w, list_transform(string_split(text, chr(10)), lambda x: {_NORMAL}) AS norm FROM d),
win AS (SELECT doc_id, i, [w[i], w[i+1], w[i+2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
l AS (SELECT DISTINCT host, text, unnest(norm) AS line FROM w),
n AS (SELECT host, line, count(*) AS n FROM l WHERE line <> '' GROUP BY host, line),
h AS (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host),
common AS (SELECT host, list(line) AS lines FROM n JOIN h USING (host) WHERE n > {LINE_TEXTS} AND n > {LINE_SHARE} * docs GROUP BY host),
m AS (SELECT w.doc_id, len(w.w) AS n_words, length(regexp_replace(w.text, '{_W}', '', 'g')) AS word_chars,
 length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
 list_filter(string_split(w.text, chr(10)), lambda x: regexp_replace(x, '{_W}', '', 'g') <> '') AS full_lines,
 coalesce(rep.n, 0) AS n_repeat_words,
 len(string_split_regex(trim(array_to_string(list_filter(norm, lambda x: x <> '' AND NOT list_contains(coalesce(lines, []), x)), ' ')), ' ')) AS words_left,
 len(list_filter(norm, lambda x: x <> '' AND NOT list_contains(coalesce(lines, []), x))) AS lines_left
 FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN common ON w.host = common.host),
o AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND 100 * (CASE WHEN lines_left = 0 THEN 0 ELSE words_left END) >= {MIN_LEFT} * n_words AS kept FROM o"""

QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLE = {"op5_quality_rules": ORACLE_SQL}
