"""Values of the catalogue's domain as Column expressions: companies, grades, prices, names, addresses, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import card_number, compact

# Which price column holds a grade's value.
TEN = {"PSA": "manual-only-price", "BGS": "bgs-10-price", "CGC": "condition-17-price", "SGC": "condition-18-price"}
BELOW_TEN = {"9.5": "box-only-price", "9": "graded-price", "8": "new-price", "8.5": "new-price", "7": "cib-price", "7.5": "cib-price"}
NOT_COVERED = ["TAG", "ACE"]
REFUSED = (402, 403)
DAY = 86400


def company(c: Column) -> Column:
    """A grading company's code: trimmed, upper case, one known misspelling mended; null where blank."""
    code = F.nullif(F.upper(F.trim(c)), F.lit(""))
    return F.when(code == "CGS", "CGC").otherwise(code)


def grade_label(company_code: Column, grade: Column, otherwise: Column | None = None) -> Column:
    """Company and grade in one label, else the fallback."""
    label = F.when(company_code.isNotNull() & (F.coalesce(F.trim(grade), F.lit("")) != ""), F.concat(company_code, F.lit(" "), F.trim(grade)))
    return label if otherwise is None else F.coalesce(label, otherwise)


def finish(variant: Column) -> Column:
    return F.coalesce(F.nullif(variant, F.lit("")), F.lit("normal"))


def derived_card_id(expansion: Column, number: Column) -> Column:
    """Lower-cased expansion and the number before a slash, without leading zeros where it's digits only; null without either."""
    bare = F.trim(F.split(number, "/")[0])
    plain = F.when(bare.rlike(r"^\d+$"), F.coalesce(F.nullif(F.ltrim(bare, F.lit("0")), F.lit("")), F.lit("0"))).otherwise(bare)
    return F.when((expansion != "") & (bare != ""), F.concat(F.lower(expansion), F.lit("-"), plain))


def image_url(base: str, set_id: Column, number: Column) -> Column:
    """base/set-number/large; null where set or number is missing."""
    return F.when((set_id != "") & (number != ""), F.concat(F.lit(base.rstrip("/") + "/"), set_id, F.lit("-"), card_number(number), F.lit("/large")))


def larger_image(url: Column, host: str) -> Column:
    """Addresses on a host with a 200-pixel file name as those of the 1000-pixel one; others unchanged, empty ones null."""
    wide = F.regexp_replace(url, r"^(.*?)_200w(\.[A-Za-z0-9]+)", "$1_in_1000x1000$2")
    return F.when(F.contains(url, F.lit(host)), wide).otherwise(F.nullif(url, F.lit("")))


def full_image(base: str, number: Column) -> Column:
    return F.when(number.isNotNull(), F.concat(F.lit(base.rstrip("/") + "/"), number.cast("string"), F.lit("_in_1000x1000.jpg")))


def extension(content_type: Column) -> Column:
    """png, webp or gif where the type says so, else jpg."""
    return F.coalesce(*[F.when(F.contains(content_type, F.lit(x)), F.lit(x)) for x in ("png", "webp", "gif")], F.lit("jpg"))


def set_key(name: Column) -> Column:
    """A set's name for lookups: trimmed, lower case, e with acute as e."""
    return F.translate(F.lower(F.trim(name)), "é", "e")


def sale_price(c: Column) -> Column:
    """The first decimal number in a text without its commas; null unless above zero. Objects come as JSON: their value, amount or price."""
    inner = F.when(F.trim(c).startswith("{"), F.coalesce(*[F.get_json_object(c, f"$.{k}") for k in ("value", "amount", "price")])).otherwise(c)
    n = F.nullif(F.regexp_extract(F.replace(inner, F.lit(","), F.lit("")), r"(-?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")
    return F.when(n > 0, n)


def graded_key(company_code: Column, grade: Column) -> Column:
    """The price column of a company's grade; null where none holds it."""
    code, g = F.upper(F.trim(company_code)), F.trim(grade.cast("string")).try_cast("double")
    ten = F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in TEN.items()])
    below = F.coalesce(*[F.when(g == float(k), F.lit(v)) for k, v in BELOW_TEN.items()])
    return F.when((code != "") & ~code.isin(NOT_COVERED), F.when(g == 10, ten).otherwise(below))


def graded_price(prices: Column, company_code: Column, grade: Column) -> Column:
    """Dollars from a map of pennies by price column; null unless above zero."""
    pennies = F.try_element_at(prices, graded_key(company_code, grade)).try_cast("double")
    return F.when(pennies > 0, pennies / 100)


def rotated(day: Column, categories: list[str]) -> Column:
    """The category of a day: one a day, in turn."""
    return F.element_at(F.array(*[F.lit(x) for x in categories]), (F.pmod(F.unix_date(day), F.lit(len(categories))) + 1).cast("int"))


def feed_time(c: Column) -> Column:
    """A feed's date, RFC 822 or ISO 8601, as an ISO time in UTC; null where it's neither."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(bare, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    at = F.coalesce(*[F.try_to_timestamp(zoned, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")], F.try_to_timestamp(F.trim(c)))
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def utc_day(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / DAY).cast("int")).cast("string")


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days between two times."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(DAY * 1_000_000)


def safe_json(value: Column) -> Column:
    return F.to_json(value)


def mint_name(c: Column) -> Column:
    """struct(name, number): the token after # is the number, and leaves the name."""
    raw = F.trim(F.coalesce(c, F.lit("")))
    number = F.nullif(F.regexp_extract(raw, r"#([A-Za-z0-9][\w./-]*)", 1), F.lit(""))
    rest = F.trim(F.regexp_replace(F.regexp_replace(raw, r"^(.*?)#[A-Za-z0-9][\w./-]*", "$1"), r"\s{2,}", " "))
    return F.struct(F.when(number.isNull(), raw).otherwise(rest).alias("name"), number.alias("number"))


def is_sealed_mint(name: Column, flagged: Column) -> Column:
    return (F.coalesce(flagged, F.lit(0)) == 1) | F.coalesce(name, F.lit("")).rlike(r"(?i)\bbooster\s+(box|pack)\b")


def is_english(game: Column, name: str = "pokemon", other: str = "japan") -> Column:
    folded = F.translate(F.lower(game), "é", "e")
    return F.coalesce(F.contains(folded, F.lit(name)) & ~F.contains(folded, F.lit(other)), F.lit(False))


def on_host(url: Column, host: str) -> Column:
    return F.coalesce(F.contains(F.lower(url), F.lit(host)), F.lit(False))


def preferred_url(existing: Column, incoming: Column, best_host: str, worst_host: str, prefer_incoming: bool = False) -> Column:
    """Which of two addresses a record keeps: one of the best host always, any over none or over the worst host's; else what is there."""
    if prefer_incoming:
        return incoming
    return F.when(on_host(incoming, best_host), incoming).when(F.coalesce(existing, F.lit("")) == "", incoming).when(on_host(existing, worst_host), incoming).otherwise(existing)


def is_refusal(status: Column) -> Column:
    return status.isin(*REFUSED)


def fetch_outcome(status: Column, size: Column, least: int = 512) -> Column:
    """bytes, permanent or transient: server errors and no answer may pass, client errors and tiny bodies don't."""
    return F.when(status.isNull() | (status >= 500), "transient").when((status >= 400) | (F.coalesce(size, F.lit(0)) < least), "permanent").otherwise("bytes")


def event_price_type(event: Column) -> Column:
    """struct(type, slug) of an event's name."""
    return F.struct(F.when(F.contains(event, F.lit("graded")), "graded").otherwise("raw").alias("type"), F.substring_index(event, ".", 1).alias("slug"))


def search_terms(*parts: Column) -> Column:
    """The parts that aren't blank, joined by spaces."""
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def http_url(base: Column, path: str) -> Column:
    """base with a path in place of its own; null unless it's http or https."""
    host = F.regexp_extract(base, r"^(?i)(https?://[^/?#]+)", 1)
    return F.when(host != "", F.concat(host, F.lit("/" + path.lstrip("/"))))


def code_from_name(name: Column) -> Column:
    return compact(name)
