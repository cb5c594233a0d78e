"""Attribute rows from name and value lists: markup goes, prose and reserved keys and overlong values are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import compact, plain_text

# Keys of running text, without spaces and case.
PROSE = ["description", "oracletext", "cardtext", "flavortext", "inheritedeffect", "securityeffect", "disclaimer"]
LONGEST_VALUE, LONGEST_NAME, MOST = 512, 64, 64


def is_prose(name: Column) -> Column:
    key = compact(name)
    return key.isin(PROSE) | key.rlike(r"^attack\d+$")


def decode_numeric(c: Column) -> Column:
    """Numeric character references decoded; those out of range stay."""

    def one(text: Column, ref: Column) -> Column:
        hexa = F.regexp_extract(ref, r"^&#[xX]([0-9a-fA-F]+);$", 1)
        code = F.when(hexa != "", hexa).otherwise(F.conv(F.regexp_extract(ref, r"^&#([0-9]+);$", 1), 10, 16))
        short = F.ltrim(code, F.lit("0"))
        fine = (F.length(short) > 0) & ((F.length(short) < 6) | ((F.length(short) == 6) & short.startswith("10")))
        return F.when(fine, F.replace(text, ref, F.decode(F.unhex(F.lpad(short, 8, "0")), "UTF-32"))).otherwise(text)

    return F.aggregate(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(&#(?:[0-9]+|[xX][0-9a-fA-F]+);)"), F.lit(1))), c, one)


def attribute_value(c: Column) -> Column:
    return plain_text(decode_numeric(F.coalesce(c, F.lit(""))))


def extract(df: DataFrame, key: str, entries: str) -> DataFrame:
    """(key, name, value, position) of entries (array of name, value): the first valid one of a name counts, 64 at most.

    All happens within a row: nothing is shuffled, whatever the number of items. A null array gives no rows.
    """
    trimmed = F.transform(F.col(entries), lambda x, i: F.struct(F.trim(x["name"]).alias("name"), attribute_value(x["value"]).alias("value"), i.alias("position")))
    ok = lambda x: (x["name"] != "") & (F.length(x["name"]) <= LONGEST_NAME) & ~x["name"].startswith("@") & ~is_prose(x["name"]) & (x["value"] != "") & (F.length(x["value"]) <= LONGEST_VALUE)
    valid = df.select(key, F.filter(trimmed, ok).alias("_a"))
    first = valid.select(key, F.slice(F.filter("_a", lambda x, i: F.array_position(F.col("_a.name"), x["name"]) == i + 1), 1, MOST).alias("_a"))
    return first.select(key, F.inline("_a"))


def external_key(source: str, field: str) -> str:
    """The reserved key of another source's field."""
    if not (source and source.isascii() and source.isalnum() and source == source.lower()):
        raise ValueError(f"a source's name has only a-z and 0-9: {source!r}")
    return f"@{source}.{field}"
