"""The catalogue's tables: keys and a policy per column, and the writes that are more than a merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.catalogue import preferred_url
from lodestone.operators.merge import merge


def _all(policy: str, names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), policy)


@dataclass(frozen=True)
class Table:
    """keys: null and empty keys are one. insert: whether rows without a target are added."""

    keys: tuple[str, ...]
    policies: dict[str, str]
    insert: bool = True

    def upsert(self, target: DataFrame, incoming: DataFrame, seq: str) -> DataFrame:
        """The target after the incoming rows, folded in order of seq; columns that incoming lacks are left as they are."""
        there = {k: p for k, p in self.policies.items() if k in incoming.columns or p in ("counter", "clear")}
        return merge(target, incoming, list(self.keys), there, seq, self.insert)


PRICE_KEY = ("product_id", "source", "variant", "finish", "condition", "grade", "company", "is_signed", "is_error", "is_perfect")
TREND = "trend_1d trend_7d trend_14d trend_30d trend_90d"
TABLES = {
    "game": Table(("external_id",), _all("overwrite", "name")),
    "set": Table(("external_id",), _all("overwrite", "game_id name code published_on") | _all("keep_if_set", "vendor_expansion")),
    "product": Table(("external_id",), _all("overwrite", "set_id name number rarity kind image_count")),
    "listing_price": Table(PRICE_KEY, _all("overwrite", "market low mid high updated_at")),
    "guide_price": Table(PRICE_KEY, _all("overwrite", "market buy sell is_graded updated_at")),
    "drained_price": Table(tuple(k for k in PRICE_KEY if k != "variant"), _all("overwrite", f"market is_graded updated_at {TREND}")),
    "enriched_price": Table(PRICE_KEY, _all("overwrite", f"market low mid high is_graded updated_at trend_180d trends_json {TREND}")),
    "population": Table(("product_id", "variant", "company", "grade"), _all("overwrite", "count total grade_total qualified_grade_total half_grade_total updated_at")),
    "sold_listing": Table(("listing_id",), _all("overwrite", "product_id title variant company grade price currency sold_at url")),
    "history": Table(("product_id", "variant", "condition", "grade", "company", "date"), _all("overwrite", "low market currency")),
    "match_map": Table(("row_id",), _all("new_if_set", "id method upc") | _all("keep_if_set", "matched_at") | _all("overwrite", "last_seen_at")),
    "match_map_by_barcode": Table(("row_id",), _all("keep_if_set", "id method matched_at") | _all("new_if_set", "upc") | _all("overwrite", "last_seen_at")),
    "barcode_stamp": Table(("row_id",), _all("overwrite", "upc"), insert=False),
    "mirror_url": Table(("product_id",), _all("overwrite", "mirror_url") | _all("new_if_set", "source")),
    "mirror_attempt": Table(("product_id",), _all("counter", "attempts") | _all("overwrite", "last_attempt_at")),
    "image_repair": Table(("product_id",), _all("overwrite", "source_url") | _all("clear", "mirror_url attempts last_attempt_at")),
    "forced_source": Table(("product_id",), _all("overwrite", "source_url source")),
    "unmatched": Table(("card_id",), _all("counter", "seen_count") | _all("overwrite", "last_seen_at") | _all("new_if_set", "number expansion name")),
    "conflict": Table(("card_id", "variant"), _all("overwrite", "detail updated_at") | _all("insert_only", "status")),
    "capture": Table(("external_id",), _all("new_if_set", "card_id variant printings"), insert=False),
    "variant_seed": Table(("external_id",), _all("insert_only", "set_id name number kind") | _all("new_if_set", "card_id variant printings")),
    "image_hash": Table(("product_id",), _all("overwrite", "hash version")),
    "freshness": Table(("key", "kind"), _all("latest", "updated_at")),
    "set_mapping": Table(("id",), _all("new_if_set", "expansion"), insert=False),
}


def resolved(df: DataFrame, dim: DataFrame, external: str, internal: str) -> DataFrame:
    """df with the internal id that an external one stands for; null where the dimension has none."""
    return df.join(dim.select(F.col("external_id").alias("_e"), F.col("id").alias(internal)), df[external] == F.col("_e"), "left").drop("_e")


def known_only(df: DataFrame, dim: DataFrame, external: str, internal: str) -> DataFrame:
    """Like resolved; rows that the dimension doesn't know go."""
    return df.join(dim.select(F.col("external_id").alias("_e"), F.col("id").alias(internal)), df[external] == F.col("_e")).drop("_e")


def upsert_source(target: DataFrame, incoming: DataFrame, seq: str, best_host: str, worst_host: str, prefer_incoming: bool = False) -> DataFrame:
    """target (product_id, source_url, source, ...) after incoming (product_id, source_url, source, seq) under the hosts' precedence.

    Folded in order, a product's address ends at the last one of the best host; without any, the target's unless empty
    or of the worst host; else the first incoming one that isn't of the worst host, or else the last. So one grouped
    aggregate folds, and no order has to be kept within a task.
    """
    url, best = F.col("source_url"), F.contains(F.lower("source_url"), F.lit(best_host))
    good = ~F.contains(F.lower("source_url"), F.lit(worst_host)) & (url != "")
    folded = incoming.groupBy("product_id").agg(
        F.max_by(url, seq).alias("_last"), F.max_by(F.when(best, url), F.when(best, F.col(seq))).alias("_best"),
        F.min_by(F.when(good, url), F.when(good, F.col(seq))).alias("_good"), F.max_by(F.when(F.col("source").isNotNull(), F.col("source")), F.when(F.col("source").isNotNull(), F.col(seq))).alias("_source"), F.lit(True).alias("_in"),
    )
    one = F.col("_last") if prefer_incoming else F.coalesce("_best", "_good", "_last")
    out = target.join(folded, "product_id", "full")
    new = F.when(F.col("_in").isNull(), F.col("source_url")).otherwise(preferred_url(F.col("source_url"), one, best_host, worst_host, prefer_incoming))
    return out.select(*[new.alias(c) if c == "source_url" else F.coalesce("_source", "source").alias(c) if c == "source" else F.col(c) for c in target.columns])


def by_set_and_number(incoming: DataFrame, products: DataFrame) -> DataFrame:
    """incoming (set_id, number, ...) as a row for each product of that set whose number agrees, whatever its case; products (product_id, set_id, number)."""
    p = products.select("product_id", F.col("set_id").alias("_s"), F.lower("number").alias("_n"))
    return incoming.join(p, (F.col("set_id") == F.col("_s")) & (F.lower("number") == F.col("_n"))).drop("_s", "_n", "set_id", "number")


def replaced_groups(target: DataFrame, incoming: DataFrame, key: str, group: str, source: str | None = None) -> DataFrame:
    """target (key, name, value) where each key in incoming has its rows in one name space replaced: a source's (@source.), or without one all that bear no @."""
    inside = F.col(group).startswith(f"@{source}.") if source else ~F.col(group).startswith("@")
    keys = incoming.select(key).distinct()
    kept = target.filter(~inside).unionByName(target.filter(inside).join(keys, key, "left_anti"))
    return kept.unionByName(incoming.filter(inside).select(target.columns))


def changed_groups(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """(key, hash) of groups of rows (key, name, value, position) whose hash isn't the stored one (key, hash)."""
    now = rows.groupBy(key).agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "name", "value"))), lambda x: F.concat_ws("\x1f", x["name"], x["value"])), "\x1e"), 256).alias("hash"))
    return now.join(stored.select(key, F.col("hash").alias("_h")), key, "left").filter(~F.col("hash").eqNullSafe(F.col("_h"))).drop("_h")


def inserted_new(target: DataFrame, incoming: DataFrame, key: str, order: Column) -> DataFrame:
    """target and those of incoming whose key it lacks, the first of equal ones; nothing is overwritten."""
    fresh = incoming.join(target.select(key), key, "left_anti")
    first = fresh.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_r = 1").select(target.columns)
    return target.unionByName(first)


def retained(df: DataFrame, seconds: str, now: int, days: int) -> DataFrame:
    """Rows not older than so many days."""
    return df.filter(F.col(seconds) >= now - days * 86400)


#: Days that each kind of row is kept.
KEPT_DAYS = {"sold_listing": 180, "history": 365, "api_log": 90, "news": 90}


def minted(map_rows: DataFrame, products: DataFrame, key: list[str], made: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, map rows) after minting: rows of made (key..., row_id) that no product has become products with ids above the largest; only map rows without an id are stamped.

    New ids count up by key within the rows to insert, so running it again with its own result changes nothing. They are
    numbered from a range-partitioned order with per-partition offsets, never in one task.
    """
    fresh = made.select(*key).distinct().join(products.select(*key), key, "left_anti")
    top = products.agg(F.max("id")).first()[0] or 0
    ordered = fresh.repartitionByRange(*key).sortWithinPartitions(*key).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id() % F.lit(1 << 33)})
    sizes = {r["_p"]: r["n"] for r in ordered.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    start, before = top + 1, {}
    for p in sorted(sizes):
        before[p], start = start, start + sizes[p]
    offsets = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if before else F.create_map(F.lit(0), F.lit(1))
    new = ordered.select((F.element_at(offsets, F.col("_p")) + F.col("_i")).cast("long").alias("id"), *key)
    all_products = products.unionByName(new.select(*[c for c in products.columns if c in new.columns]), allowMissingColumns=True)
    ids = made.join(all_products.select("id", *key), key).groupBy("row_id").agg(F.min("id").alias("_id"))
    stamped = map_rows.join(ids, "row_id", "left").select(*[F.coalesce("id", "_id").alias("id") if c == "id" else F.col(c) for c in map_rows.columns])
    return all_products, stamped
