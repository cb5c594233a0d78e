"""Line dedup: lines within a few edits of a line that comes earlier anywhere in the corpus go.

Native DataFrame functions only. Distinct lines are joined by the segment-partition method: of two lines within t edits,
one of the t + 1 even segments of the shorter occurs in the longer unchanged, at one of few places that depend on both
lengths. Segments are hashed with their length class and number, lines probe those of lengths m - t to m at the places
that the multi-match rule leaves. Keys carry the line's counts of 16 letters; where the counts of two lines that meet differ by more than t edits
can make them, the join lets the pair go, so that long lines that share a segment but not their words stay apart. Pairs
that are left are verified by a banded bit-parallel edit distance: the band of 2 t + 1 diagonals is one machine word, and
each character of the shorter line is a step of a few bit operations.

Equal lines are one row before any join, so a line of any frequency costs one row. Texts go through one shuffle, that of
the distinct lines; after it only hashes do, until pairs that met are verified.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import let, table, written

EDITS = 2
#: Shorter lines are not joined: two edits make other words of them. Their exact repeats go where `repeats` asks for it.
MIN_CHARS = 30


#: Letters whose counts bound the edit distance; any others are as right, frequent ones part more lines.
COUNTED = "etaoinsrhlducmpg"


def letter_counts(line: Column) -> Column:
    """A bigint of 16 counts modulo 16, four bits each: how often the line has each letter of COUNTED.

    Letters are taken out one after the other, so that each step reads what the frequent ones before it have left.
    """
    out = F.lit(0).cast("long")
    for k, x in enumerate(COUNTED):
        rest = F.replace(line, F.lit(x))
        count = (F.octet_length(line) - F.octet_length(rest)).cast("long").bitwiseAND(F.lit(15))
        out, line = out.bitwiseOR(F.shiftleft(count, 4 * k)), rest
    return out


def within_counts(a: Column, b: Column, t: int) -> Column:
    """Whether t edits can lead from letter counts a to b: an edit takes one letter, adds one, or both, so counts change by 2 t at most."""
    total = F.lit(0).cast("long")
    for k in range(len(COUNTED)):
        one, two = (F.shiftrightunsigned(x, 4 * k).bitwiseAND(F.lit(15)) for x in (a, b))
        gap = F.abs(one - two)
        total = total + F.least(gap, 16 - gap)
    return total <= 2 * t


def _places(t: int, most_gap: int) -> list[tuple[int, int, int]]:
    """(gap, i, shift): segment i of a line that is gap characters shorter can start shift characters further on in this one."""
    return [(gap, i, shift) for gap in range(most_gap + 1) for i in range(t + 1) for shift in range(max(-i, gap - (t - i)), min(i, gap + (t - i)) + 1)]


def _keys(lines: DataFrame, t: int, places: list[tuple[int, int, int]], name: str) -> DataFrame:
    """(key, name, name + "_counts"): a row for each line (h, line, counts) and place that lies inside the line.

    A line of n characters has t + 1 even segments, the longer ones last. Places are exploded before anything is
    reckoned, so a row takes a few integer operations, one substring and one hash, all in generated code.
    """
    rows = lines.select("h", "line", "counts", F.length("line").alias("m"), F.inline(F.array(*[F.struct(F.lit(g).alias("gap"), F.lit(i).alias("i"), F.lit(x).alias("shift")) for g, i, x in places])))
    rows = rows.select("*", F.expr(f"cast((m - gap) div {t + 1} as int)").alias("base"), F.expr(f"{t + 1} - (m - gap) % {t + 1}").alias("even"))
    rows = rows.select("h", "line", "counts", "m", "gap", "i", F.expr("1 + i * base + greatest(0, i - even) + shift").alias("at"), F.expr("base + if(i >= even, 1, 0)").alias("len"))
    return rows.filter("at >= 1 and at + len - 1 <= m").select(F.expr("xxhash64(m - gap, i, substring(line, at, len))").alias("key"), F.col("h").alias(name), F.col("counts").alias(f"{name}_counts"))


def index_keys(lines: DataFrame, t: int, name: str = "a") -> DataFrame:
    """(key, name, counts) of each line's own segments."""
    return _keys(lines, t, [(0, i, 0) for i in range(t + 1)], name)


def probe_keys(lines: DataFrame, t: int, name: str = "b") -> DataFrame:
    """(key, name, counts) of the substrings that could be a segment of a line no longer than this one and within t edits."""
    return _keys(lines, t, _places(t, t), name)


def trimmed(pair: Column) -> Column:
    """A struct (x, y) of texts without a common head and a common tail, to within a few characters; their edit distance is the same."""

    def head(p: Column, k: int) -> Column:
        same = (F.length(p["x"]) > k) & (F.length(p["y"]) > k) & (F.substring(p["x"], 1, k) == F.substring(p["y"], 1, k))
        cut = lambda c: F.substring(c, F.lit(k + 1), F.length(c))
        return F.when(same, F.struct(cut(p["x"]).alias("x"), cut(p["y"]).alias("y"))).otherwise(p)

    def tail(p: Column, k: int) -> Column:
        same = (F.length(p["x"]) > k) & (F.length(p["y"]) > k) & (F.right(p["x"], F.lit(k)) == F.right(p["y"], F.lit(k)))
        cut = lambda c: F.substring(c, F.lit(1), F.length(c) - k)
        return F.when(same, F.struct(cut(p["x"]).alias("x"), cut(p["y"]).alias("y"))).otherwise(p)

    sizes = (4096, 1024, 256, 128, 64, 32, 16, 8)
    for cut_off in [partial(step, k=k) for step in (head, tail) for k in sizes]:
        pair = let(pair, _of_one(cut_off))
    return pair


def _of_one(f):
    """f as a function of one argument, as Spark's lambdas take it."""
    return lambda p: f(p)


def banded_distance(longer: Column, shorter: Column, t: int) -> Column:
    """The edit distance of two lines, right where it's at most t, and above t elsewhere.

    Bit k of a word stands for row j - t + k of column j, so the band moves down a row a column. The last cell's
    diagonal keeps its bit, and the distance grows where that bit of "equal to the upper left" is clear.
    """
    width = 2 * t + 1
    mask = (1 << width) - 1

    def steps(x: Column) -> Column:
        a, b = x["a"], x["b"]
        gap = F.size(a) - F.size(b)

        def step(s: Column, j: Column) -> Column:
            c = F.get(b, j - 1)
            equal = sum((F.when(F.get(a, j - (t + 1 - k)) == c, F.lit(1 << k)).otherwise(F.lit(0)) for k in range(width)), F.lit(0))

            def words_(y: Column) -> Column:
                d0, vp, vn = y["d0"], y["vp"], y["vn"]
                hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(F.lit(mask))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                return F.struct(
                    hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(F.lit(mask)).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"),
                    (y["d"] + 1 - F.bit_get(d0, gap + t).cast("int")).alias("d"),
                )

            both = let(F.struct(equal.alias("e"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d")), lambda y: F.struct((y["e"].bitwiseAND(y["vp"]) + y["vp"]).bitwiseXOR(y["vp"]).bitwiseOR(y["e"]).bitwiseOR(y["vn"]).bitwiseAND(F.lit(mask)).alias("d0"), y["vp"].alias("vp"), y["vn"].alias("vn"), y["d"].alias("d")))
            return let(both, words_)

        start = F.struct(F.lit(mask & ~((1 << t) - 1)).alias("vp"), F.lit((1 << t) - 1).alias("vn"), gap.alias("d"))
        # the value never falls along a diagonal: above t, the rest of the steps have nothing to add
        walk = F.aggregate(F.sequence(F.lit(1), F.size(b)), start, lambda s, j: F.when(s["d"] > t, s).otherwise(step(s, j)), lambda s: s["d"])
        return F.when(gap > t, F.lit(t + 1)).when(F.size(b) == 0, gap).otherwise(walk)

    short = trimmed(F.struct(longer.alias("x"), shorter.alias("y")))
    return let(short, lambda p: let(F.struct(_chars(p["x"]).alias("a"), _chars(p["y"]).alias("b")), steps))


#: Lines of met pairs up to which their hashes are broadcast to pick the texts; 8 bytes each.
BROADCAST_HASHES = 500_000


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def lines_of(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, text_hash, pos, line, h) of every line of at least `least` characters; equal rows of docs count as one document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("l"))
    return d.select("doc_id", "text_hash", F.posexplode("l").alias("pos", "line")).filter(F.length("line") >= least).withColumn("h", F.xxhash64("line"))


def later_lines(distinct: DataFrame, t: int = EDITS) -> DataFrame:
    """(h) of the distinct lines (h, line, first, counts) that lie within t edits of one whose first place is earlier."""
    met = index_keys(distinct, t).join(probe_keys(distinct, t), "key").filter(F.col("a") != F.col("b")).filter(within_counts(F.col("a_counts"), F.col("b_counts"), t)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    met = written(met, "line-pairs")
    one = distinct.select(F.col("h").alias("a"), F.col("line").alias("x"), F.col("first").alias("fx"))
    two = distinct.select(F.col("h").alias("b"), F.col("line").alias("y"), F.col("first").alias("fy"))
    # only lines that met leave their place with their text
    wanted = met.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    if 2 * met.count() <= BROADCAST_HASHES:
        wanted = F.broadcast(wanted)
        one = one.join(wanted, F.col("a") == F.col("h"), "left_semi")
        two = two.join(wanted, F.col("b") == F.col("h"), "left_semi")
    both = met.join(one, "a").join(two, "b")
    swap = F.length("x") >= F.length("y")
    near = banded_distance(F.when(swap, F.col("x")).otherwise(F.col("y")), F.when(swap, F.col("y")).otherwise(F.col("x")), t) <= t
    # dealt anew, so that the pairs of a few lines are not verified in a few tasks
    dealt = both.select("a", "b", "x", "y", (F.col("fx") < F.col("fy")).alias("in_order")).repartition("a", "b")
    return dealt.filter(near).select(F.when(F.col("in_order"), F.col("b")).otherwise(F.col("a")).alias("h")).distinct()


def removed_lines(docs: DataFrame, t: int = EDITS, least: int = MIN_CHARS, repeats: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, removed): the numbers, from 0, of the lines that go, sorted; documents that lose none are absent.

    A line goes unless its place (doc_id, number) is the first of its text and no distinct line with an earlier first
    place is within t edits. Null doc_ids come before all others. Lines of `repeats` to least - 1 characters with a word
    are never joined, and go unless theirs is the first place of their text.
    """
    lines = lines_of(docs, min(least, repeats)).filter((F.length("line") >= least) | F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    distinct = written(lines.groupBy("h").agg(F.min(F.struct("doc_id", "text_hash", "pos")).alias("first"), F.first("line").alias("line")).withColumn("counts", letter_counts(F.col("line"))), "lines")
    later = later_lines(distinct.filter(F.length("line") >= least), t).withColumn("late", F.lit(True))
    verdict = distinct.select("h", "first").join(later, "h", "left")
    placed = lines.select("doc_id", "text_hash", "pos", "h").join(verdict, "h")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("pos") == F.col("first.pos"))
    gone = placed.filter(F.col("late").isNotNull() | ~same)
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def dedup_lines(docs: DataFrame, t: int = EDITS, least: int = MIN_CHARS, repeats: int = MIN_CHARS) -> DataFrame:
    """docs (doc_id, text, ...) with removed (line numbers) and clean_text, the text without them; null text stays null.

    Other columns and repeated rows stay; columns that bear an added name are replaced. An empty table gives an empty one.
    """
    found = removed_lines(docs, t, least, repeats).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("removed").alias("_r"))
    base = docs.drop(*[c for c in ("removed", "clean_text") if c not in ("doc_id", "text")]).withColumn("_t", F.xxhash64(F.coalesce("text", F.lit(""))))
    out = base.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_h")), "left")
    keep = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col("_r"), i))
    return out.withColumn("removed", F.coalesce("_r", F.array().cast("array<int>"))).withColumn("clean_text", F.when(F.col("_r").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n"))).drop("_t", "_d", "_h", "_r")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = removed_lines(docs).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "removed")
    d = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"), F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    out = d.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_h")), "left")
    return out.select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.concat_ws(",", F.col("removed").cast("array<string>")), F.lit("")).alias("removed"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts lose their later lines, repeats of short ones included; documents without a word left go, as all they had is kept elsewhere.

    Null and empty texts stay, as do columns of any name; n_chars follows. Rows with equal id and text count as one and keep the same lines.
    """
    own = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c not in ("doc_id", "text")}
    out = dedup_lines(docs.withColumnsRenamed(own), repeats=1).filter((F.size("removed") == 0) | (F.col("clean_text").rlike(r"[^\x20\x09-\x0D]")))
    return out.select(*[F.col("clean_text").alias("text") if c == "text" else F.length("clean_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(own.get(c, c)).alias(c) for c in docs.columns])


ORACLE_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
f AS (SELECT line, length(line) AS n, min({{'d': doc_id, 'p': pos}}) AS first FROM l WHERE length(line) >= {MIN_CHARS} GROUP BY line),
late AS (SELECT DISTINCT a.line FROM f a JOIN f b ON b.n BETWEEN a.n - {EDITS} AND a.n + {EDITS} AND b.first < a.first AND levenshtein(a.line, b.line) <= {EDITS}),
g AS (SELECT l.doc_id, l.pos, length(l.line) >= {MIN_CHARS} AND (late.line IS NOT NULL OR f.first.d <> l.doc_id OR f.first.p <> l.pos) AS gone
 FROM l LEFT JOIN f ON l.line = f.line LEFT JOIN late ON l.line = late.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
 coalesce(string_agg(CASE WHEN gone THEN pos::varchar END, ',' ORDER BY pos), '') AS removed FROM g GROUP BY doc_id"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLE = {"op1_line_dedup": ORACLE_SQL}
