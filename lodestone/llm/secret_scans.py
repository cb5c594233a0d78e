"""Secret scans: three base patterns, and a battery of randomness tests over long tokens under false-discovery control.

Native DataFrame functions only. A candidate token's encoding is inferred from its characters. Three tests ask how unlike
natural text it is: chi-squared uniformity over the encoding's alphabet, runs above and below the alphabet's middle, and
lag-one serial correlation. For text each gives a large statistic, for a random string an ordinary one. The evidence of
randomness becomes a p-value under "this is text", and the Benjamini-Hochberg rule picks the level for each length class.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import let, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
#: Rate of false discoveries among the method's spans.
RATE = 0.01
#: Lengths from which the classes of the false-discovery control begin.
CLASSES = (20, 28, 40, 64)
#: Probability that two letters of natural words agree (European languages: 0.065 to 0.08).
TEXT_MATCH = 0.066
NUMBER_EXCESS = 1.5
#: Most capitals, as a share of letters, that words joined as camelCase have.
MOST_CAPITALS = 0.25
#: Combined p-value of the runs and the serial test below which a token isn't random.
NOT_RANDOM = 0.003
#: Logarithmic bins of p-values, ten a decade.
BINS = 400


def spans_of(text: Column, pattern: str, least: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs s, e (code points, end exclusive), v (the match), whose group has `least` characters."""
    ungrouped = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else ungrouped
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def place(v: Column, g: Column, gap: Column) -> Column:
        # Java's split leaves out an empty first piece only for empty matches, so gaps are one more than matches
        sizes = F.zip_with(v, F.slice(gap, 1, F.size(v)), lambda a, b: F.struct(F.length(a).alias("n"), b.alias("gap")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        starts = F.aggregate(sizes, start, lambda s, x: F.struct((s["at"] + x["gap"] + x["n"]).alias("at"), F.concat(s["all"], F.array(s["at"] + x["gap"])).alias("all")))["all"]
        full = F.zip_with(F.arrays_zip(v.alias("v"), g.alias("g")), starts, lambda a, s: F.struct(s.alias("s"), (s + F.length(a["v"])).alias("e"), a["v"].alias("v"), F.length(a["g"]).alias("n")))
        return F.transform(F.filter(full, lambda x: x["n"] >= least), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v")))

    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    return F.when(text.rlike(pattern), let(ungrouped, lambda v: let(held, lambda g: let(gaps, lambda gap: place(v, g, gap))))).otherwise(none)


def _normal_tail(z: Column) -> Column:
    """P(Z > z), by Abramowitz and Stegun 26.2.17 to 8e-8; exact enough to rank and to bin."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = poly * F.exp(-a * a / 2) / math.sqrt(2 * math.pi)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(token: Column) -> Column:
    """p-value of a token under "this is text" from the three tests; 1 for tokens of one character over and over.

    Text is modelled by what letters in words lose against uniform ones: over the encoding's alphabet of k characters a
    token of n has chi-squared about k - 1 + n * c. Two letters of words agree with probability TEXT_MATCH, so c is
    k * TEXT_MATCH - 1 in text; encodings with digits get NUMBER_EXCESS at least. Letters alone have alphabets of 26
    or 52. In camelCase a share u of the letters is of the other case, and two letters agree (1 - u)^2 + u^2 times as often;
    tokens without digits are held against that, with u as found and MOST_CAPITALS at most. (chi-squared - (k - 1) - n * c) / sd is then about normal in
    text and far below for random strings. Runs about the mean and serial correlation are normal for random strings:
    their two-sided p-values under "this is random" are combined by Fisher's method, and where that combination falls
    below NOT_RANDOM the token isn't random, whatever its letters' counts.
    """
    kind = F.when(token.rlike(r"^[0-9]+$"), 10).when(token.rlike(r"^(?:[a-z]+|[A-Z]+)=*$"), 26).when(token.rlike(r"^[A-Za-z]+=*$"), 52).when(token.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"), 16).when(token.rlike(r"^[A-Z2-7]+=*$"), 32).when(token.rlike(r"^(?:[a-z0-9]+|[A-Z0-9]+)$"), 36).otherwise(64)

    def body(both: Column) -> Column:
        chars, k = both["c"], both["k"].cast("double")
        n = F.size(chars).cast("double")
        codes = F.transform(chars, lambda c: F.ascii(c).cast("double"))

        def deviates(x: Column) -> Column:
            v, mean = x["v"], x["mean"]
            chi = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a + F.pow(F.size(F.filter(chars, lambda d: d == c)).cast("double"), F.lit(2.0))) * k / n - n
            var = F.aggregate(v, F.lit(0.0), lambda a, y: a + (y - mean) * (y - mean))
            ahead, after = F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1)
            pairs = F.aggregate(F.zip_with(ahead, after, lambda a, b: (a - mean) * (b - mean)), F.lit(0.0), lambda a, y: a + y)
            high = F.aggregate(v, F.lit(0.0), lambda a, y: a + F.when(y > mean, 1.0).otherwise(0.0))
            turns = F.aggregate(F.zip_with(ahead, after, lambda a, b: F.when((a > mean) != (b > mean), 1.0).otherwise(0.0)), F.lit(0.0), lambda a, y: a + y) + 1
            capitals = F.size(F.filter(chars, lambda d: d.between("A", "Z"))) / n
            digit = F.exists(chars, lambda d: d.between("0", "9"))
            return F.struct(chi.alias("chi"), var.alias("var"), pairs.alias("pairs"), high.alias("high"), turns.alias("turns"), F.least(capitals, 1 - capitals, F.lit(MOST_CAPITALS)).alias("u"), digit.alias("digit"))

        def normal(y: Column) -> Column:
            serial = F.when(y["var"] > 0, y["pairs"] / y["var"]).otherwise(1.0) * F.sqrt(n)
            want = 2 * y["high"] * (n - y["high"]) / n + 1
            sd = F.sqrt(F.greatest((want - 1) * (want - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-9)))
            u = y["u"]
            c = F.when(~y["digit"], k * TEXT_MATCH * ((1 - u) * (1 - u) + u * u) - 1).otherwise(F.greatest(k * TEXT_MATCH - 1, F.lit(NUMBER_EXCESS)))
            return F.struct(F.abs(serial).alias("serial"), F.abs((y["turns"] - want) / sd).alias("runs"), (((k - 1) + n * c - y["chi"]) / F.sqrt(2 * (k - 1) + 4 * n * c)).alias("z"))

        def combined(d: Column) -> Column:
            # minus the logarithm of both p-values' product; Fisher's statistic is twice that, chi-squared with 4 degrees of freedom
            against = -F.log(F.greatest(2 * _normal_tail(d["serial"]), F.lit(1e-30))) - F.log(F.greatest(2 * _normal_tail(d["runs"]), F.lit(1e-30)))
            return let(against, lambda a: F.when(F.exp(-a) * (1 + a) < NOT_RANDOM, F.lit(1.0)).otherwise(_normal_tail(d["z"])))

        # each step's values are bound before the next reads them: an expression is evaluated once, not once a mention
        centred = let(codes, lambda v: F.struct(v.alias("v"), (F.aggregate(v, F.lit(0.0), lambda a, y: a + y) / n).alias("mean")))
        return let(let(let(centred, deviates), normal), combined)

    return F.when(F.length(F.rtrim(token, F.lit("="))) > 1, let(F.struct(F.filter(F.split(F.rtrim(token, F.lit("=")), ""), lambda c: c != "").alias("c"), kind.alias("k")), body)).otherwise(F.lit(1.0))


def length_class(n: Column) -> Column:
    return sum((F.when(n >= c, 1).otherwise(0) for c in CLASSES[1:]), F.lit(0))


def candidates(text: Column) -> Column:
    return F.transform(spans_of(text, CANDIDATE, CLASSES[0]), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), battery(x["v"]).alias("p"), length_class(F.length(x["v"])).alias("k")))


def level(docs: DataFrame, text: str, rate: float = RATE) -> list[float]:
    """The largest p-value accepted in each length class: Benjamini-Hochberg over all candidates of all documents.

    Their p-values are counted in BINS logarithmic bins by class, so BINS times the classes rows reach the driver. A bin
    is taken whole by its upper end: the step-up rule on binned values keeps the rate.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.explode(candidates(t)).alias("x")).select("x.k", F.least(F.lit(BINS - 1), F.floor(-F.log10(F.greatest("x.p", F.lit(1e-40))) * 10)).cast("int").alias("bin"))
    counts = {(r["k"], r["bin"]): r["n"] for r in found.groupBy("k", "bin").agg(F.count("*").alias("n")).collect()}
    out = []
    for k in range(len(CLASSES)):
        total, seen, best = sum(n for (c, _), n in counts.items() if c == k), 0, 0.0
        for b in range(BINS - 1, -1, -1):
            seen += counts.get((k, b), 0)
            upper = 10 ** (-b / 10)
            if seen and upper <= rate * seen / total:
                best = upper
        out.append(best)
    return out


def scan(docs: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """docs with assign, access, hex and random: arrays of spans (s, e), by start. Null text: empty arrays.

    Where a method's span lies in a base one, it stands too: it says what the base pattern can't, that it's random.
    Columns of docs that bear an added name are replaced.
    """
    levels = level(docs, text, rate)
    t = F.coalesce(F.col(text), F.lit(""))
    bare = lambda a: F.transform(a, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    accepted = lambda x: sum((F.when((x["k"] == k) & (x["p"] <= v), 1).otherwise(0) for k, v in enumerate(levels)), F.lit(0)) > 0
    return docs.withColumns({
        "assign": bare(spans_of(t, ASSIGN, 6, 2)), "access": bare(spans_of(t, ACCESS, 20)), "hex": bare(spans_of(t, HEX[:-1] + "{24,}", 24)),
        "random": bare(F.filter(candidates(t), accepted)),
    })


def joined_spans(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by start and then by kind as listed, comma-joined."""

    def numbered(i: int, kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))

    all_ = F.concat(*[numbered(i, k) for i, k in enumerate(kinds)])
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in kinds]), k + 1)
    return F.array_join(F.transform(F.sort_array(all_), lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each maximal run of overlapping spans replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda a, x: F.when(x["s"] < a["at"], F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["out"].alias("out"))).otherwise(
        F.struct(x["e"].alias("at"), F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.lit(mark))).alias("out"))
    )
    whole = F.aggregate(F.sort_array(spans), start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, 2**31 - 1)))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda k: F.size(k).cast("long").alias(f"n_{k}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(joined_spans(KINDS[:3]), 256).alias("base_sha256"), joined_spans(KINDS).alias("spans"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row stays, its secrets replaced by a mark, and n_chars follows. Null texts stay null; columns of any name are kept; an empty table stays empty."""
    own = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c != "text"}
    found = scan(docs.withColumnsRenamed(own))
    text = redacted(F.col("text"), F.concat(*KINDS))
    out = found.withColumn("text", text)
    return out.select(*["text" if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(own[c]).alias(c) for c in docs.columns])


QUERIES = {"op8_secret_scans": op8_secret_scans}
ORACLE: dict[str, str] = {}
