"""Text functions as Column expressions: normalisation, tokens, numbers, markup, addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Words that name a print's language; none means English.
MARKERS = ["japanese", "japan", "chinese", "korean", "german", "french", "italian", "spanish", "portuguese", "dutch", "russian", "polish", "thai", "indonesian"]


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where a lambda in body reads it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def norm(c: Column) -> Column:
    """Lower case; every run of other characters than a-z and 0-9 is one space; trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def norm_decimal(c: Column) -> Column:
    """norm that keeps full stops."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9.]+", " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "")


def clean_number(c: Column) -> Column:
    """What stands before the first slash, without leading zeros, lower case, trimmed, in that order."""
    return F.trim(F.lower(F.regexp_replace(F.split(c, "/")[0], r"^0+", "")))


def tokens(c: Column) -> Column:
    return F.filter(F.split(norm(c), " "), lambda x: x != "")


def digit_token(c: Column) -> Column:
    """The first token that bears a digit; null without one."""
    return F.nullif(F.regexp_extract(c, r"(?i)([a-z]*\d[\w-]*)", 1), F.lit(""))


def language(c: Column, markers: list[str], default: str = "english") -> Column:
    """The first marker that is a whole token of the text."""
    found = tokens(c)
    return F.coalesce(*[F.when(F.array_contains(found, m), F.lit(m)) for m in markers], F.lit(default))


def corroborates(a: Column, b: Column) -> Column:
    """Whether a token of either text, of three characters or more, lies in the other; false where a side is empty."""
    na, nb = norm(a), norm(b)
    full = (na != "") & (nb != "")
    within = lambda x, y: F.exists(F.split(x, " "), lambda k: (F.length(k) >= 3) & F.contains(y, k))
    return F.coalesce(full & (within(na, nb) | within(nb, na)), F.lit(False))


def trigrams(c: Column) -> Column:
    """The distinct substrings of three characters; of a shorter text, itself."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))


def barcode(c: Column) -> Column:
    """The digits; null without any."""
    return F.nullif(F.regexp_replace(c, r"\D+", ""), F.lit(""))


def barcode_forms(c: Column) -> Column:
    """A code and its equivalent of 12 or of 13 digits."""
    code = barcode(c)
    return F.when(F.length(code) == 12, F.array(code, F.concat(F.lit("0"), code))).when((F.length(code) == 13) & code.startswith("0"), F.array(code, F.substring(code, 2, 12))).when(code.isNotNull(), F.array(code))


def plain_text(c: Column) -> Column:
    """Markup to text: tags are spaces, common entities are decoded, tags go again, whitespace runs are one space."""
    x = F.regexp_replace(c, r"<[^>]*>", " ")
    for entity, to in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(to))
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"[\s\x{00a0}]+", " "))


def url_path_key(c: Column) -> Column:
    """The object key in an address: its path without leading slashes; null without one."""
    return F.nullif(F.ltrim(F.regexp_replace(F.regexp_extract(c, r"^[a-z]+://[^/?#]*(/[^?#]*)?", 1), r"^/+", "")), F.lit(""))


def card_number(c: Column) -> Column:
    """Upper-case letter prefix and unpadded number of codes such as 058/102 or TG5."""
    head = F.trim(F.split(c, "/")[0])
    prefix, digits = F.upper(F.regexp_extract(head, r"^([A-Za-z]+)0*(\d+)$", 1)), F.regexp_extract(head, r"^([A-Za-z]+)0*(\d+)$", 2)
    padded = F.when(prefix.isin("TG", "GG"), F.concat(prefix, F.lpad(digits, 2, "0"))).otherwise(F.concat(prefix, digits))
    return F.when(head.rlike(r"^[A-Za-z]+0*\d+$"), padded).when(head.rlike(r"^\d+$"), F.coalesce(F.nullif(F.regexp_replace(head, r"^0+", ""), F.lit("")), F.lit("0"))).otherwise(head)
