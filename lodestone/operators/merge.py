"""Merge: incoming rows are folded per key in order of a sequence, then joined to the target, each column by its policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: overwrite: the last value, null included. new_if_set / keep_if_set: last non-null over old / old over first non-null.
#: insert_only: the target's where the row exists. counter: rows are added. clear: null. latest: the larger.
POLICIES = ("overwrite", "new_if_set", "keep_if_set", "insert_only", "counter", "clear", "latest")


def _fold(policy: str, c: str, seq: str) -> Column:
    v = F.col(c) if policy not in ("counter", "clear") else F.lit(None)
    if policy == "overwrite":
        return F.max_by(v, seq)
    if policy == "new_if_set":
        return F.max_by(F.when(v.isNotNull(), v), F.when(v.isNotNull(), F.col(seq)))
    if policy in ("keep_if_set",):
        return F.min_by(F.when(v.isNotNull(), v), F.when(v.isNotNull(), F.col(seq)))
    if policy == "insert_only":
        return F.min_by(v, seq)
    if policy == "counter":
        return F.count("*")
    if policy == "latest":
        return F.max(v)
    return F.lit(None)


def merge(target: DataFrame, incoming: DataFrame, keys: list[str], policies: dict[str, str], seq: str, insert: bool = True) -> DataFrame:
    """The target after the incoming rows. Keys that are null count as empty strings where they are strings.

    One shuffle folds the incoming rows, partly before it; one full outer join on the keys combines. With insert False,
    rows without a target are left out.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    key = lambda df: df.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys if kinds[k].simpleString() == "string"})
    folded = key(incoming).groupBy(*keys).agg(*[_fold(p, c, seq).alias(f"_s_{c}") for c, p in policies.items()], F.lit(True).alias("_in"))
    joined = key(target).withColumn("_t", F.lit(True)).join(folded, keys, "full" if insert else "left")
    there = F.col("_t").isNotNull()

    def combined(c: str, p: str) -> Column:
        t, s = F.col(c), F.col(f"_s_{c}").cast(kinds[c])
        new = {
            "overwrite": s, "new_if_set": F.coalesce(s, t), "keep_if_set": F.coalesce(t, s), "insert_only": F.when(there, t).otherwise(s),
            "counter": F.coalesce(t, F.lit(0)) + s, "clear": F.lit(None), "latest": F.greatest(t, s),
        }[p]
        return F.when(F.col("_in").isNull(), t).otherwise(new).cast(kinds[c]).alias(c)

    return joined.select(*[combined(c, policies[c]) if c in policies else F.col(c) for c in target.columns])
