"""The change log drained as a stream: rows explode to work keys, fresh keys are skipped, outcomes move rows between states.

States: pending, processing, complete, error (to be tried again after a doubled delay) and failed (for good). One writer
holds the state, so a claim is a write of its snapshot; a claim that is too old may be taken again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.money import backoff_due
from lodestone.operators.merge import merge

#: Attempts after which a row fails for good, rows that one run takes, seconds after which a claim is stale.
ATTEMPTS, WINDOW, STALE = 5, 5000, 21600


def work_items(rows: DataFrame) -> DataFrame:
    """(key, owner, rows): one per distinct key of the rows' JSON lists, owned by the smallest row id. Malformed lists give none."""
    keys = rows.select("id", F.explode(F.from_json("keys_json", "array<string>")).alias("key"))
    return keys.groupBy("key").agg(F.min("id").alias("owner"), F.countDistinct("id").alias("rows"))


def outcomes(rows: DataFrame, done: DataFrame) -> DataFrame:
    """(id, status): complete where every key is done, failed where the list is malformed, else error."""
    parsed = rows.select("id", F.from_json("keys_json", "array<string>").alias("k"))
    keys = parsed.select("id", F.explode_outer("k").alias("key")).join(done.select("key", F.lit(True).alias("ok")), "key", "left")
    whole = keys.groupBy("id").agg(F.bool_and(F.coalesce("ok", F.lit(False)) | F.col("key").isNull()).alias("all"))
    return parsed.join(whole, "id").select("id", F.when(F.col("k").isNull(), "failed").when(F.col("all"), "complete").otherwise("error").alias("status"))


def claimed(state: DataFrame, now: Column, games: list[str] | None = None, most: int = WINDOW) -> DataFrame:
    """Rows of state (id, event, keys_json, status, attempts, received_at, last_attempt_at, completed_at) that a run takes: oldest first, marked as processing.

    games: what an event's name starts with, before a full stop; None for all.
    """
    due = state.filter(backoff_due(F.col("status"), F.col("attempts"), F.coalesce("last_attempt_at", F.lit(0)), now, most=ATTEMPTS, stale=STALE))
    if games is not None:
        due = due.filter(F.substring_index("event", ".", 1).isin(games))
    first = due.orderBy("received_at", "id").limit(most)
    return first.withColumns({"status": F.lit("processing"), "last_attempt_at": now.cast("long")})


def stale_keys(items: DataFrame, fresh: DataFrame, now: Column, window: int) -> DataFrame:
    """items (key, ...) whose key wasn't updated within the window; fresh (key, updated_at)."""
    return items.join(fresh.filter(F.col("updated_at") > now - window).select("key"), "key", "left_anti")


def settled(rows: DataFrame, results: DataFrame, fresh: DataFrame, now: Column) -> DataFrame:
    """Claimed rows after a run; results (key, outcome): ok, transient or refused. Keys in fresh (key) are done; keys without a result weren't reached.

    All keys done: complete. A malformed list: failed at once. A refusal: error, and no attempt is counted. A failure
    that may pass: error with one more attempt, failed at the last. Unreached: pending again, as if never claimed.
    """
    told = results.select("key", "outcome").unionByName(fresh.select("key", F.lit("ok").alias("outcome")))
    rank = F.when(F.col("outcome") == "ok", 0).when(F.col("outcome") == "transient", 2).otherwise(3)
    by_key = told.groupBy("key").agg(F.min(rank).alias("r"))
    parsed = rows.withColumn("_k", F.from_json("keys_json", "array<string>"))
    each = parsed.select("id", F.explode_outer("_k").alias("key"))
    worst = each.join(by_key, "key", "left").groupBy("id").agg(F.max(F.when(F.col("key").isNull(), 0).otherwise(F.coalesce("r", F.lit(1)))).alias("_w"), F.bool_or(F.col("r") == 2).alias("_t"), F.bool_or(F.col("r") == 3).alias("_x"))
    out = parsed.join(worst, "id")
    refused, passing, poison = F.coalesce("_x", F.lit(False)), F.coalesce("_t", F.lit(False)), F.col("_k").isNull()
    tries = F.col("attempts") + 1
    status = F.when(poison, "failed").when(F.col("_w") == 0, "complete").when(refused, "error").when(passing, F.when(tries >= ATTEMPTS, "failed").otherwise("error")).otherwise("pending")
    attempts = F.when(~poison & ~refused & passing & (F.col("_w") != 0), tries).otherwise(F.col("attempts"))
    done = F.when(~poison & (F.col("_w") == 0), now.cast("long")).otherwise(F.col("completed_at"))
    return out.withColumns({"status": status, "attempts": attempts, "completed_at": done}).select(rows.columns)


class Snapshots:
    """Versions of a table in a folder, each complete before its marker is: readers take the newest marked one."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = lambda name: path(f"{self.folder}/{name}")
        self.fs = self.path("x").getFileSystem(spark._jsc.hadoopConfiguration())

    def newest(self) -> tuple[int, str]:
        """(version, note) of the newest marker; (-1, '') without one."""
        if not self.fs.exists(self.path("marks")):
            return -1, ""
        names = sorted(x.getPath().getName() for x in self.fs.listStatus(self.path("marks")))
        names = [x for x in names if "-" in x and not x.startswith(".")]
        if not names:
            return -1, ""
        version, _, note = names[-1].partition("-")
        return int(version), note

    def read(self, schema=None) -> DataFrame | None:
        version, _ = self.newest()
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.folder}/v{version}") if version >= 0 else None

    def write(self, df: DataFrame, note: str, keep: int = 2) -> None:
        version = self.newest()[0] + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/v{version}")
        self.fs.create(self.path(f"marks/{version:020d}-{note}"), True).close()
        for old in range(max(0, version - keep - 8), version - keep + 1):  # readers of the one before may still be at work
            self.fs.delete(self.path(f"v{old}"), True)


def drain(spark: SparkSession, log: DataFrame, state: str, keys: list[str], policies: dict[str, str], seq: str, checkpoint: str, after: Callable[[DataFrame], None] | None = None) -> None:
    """Fold a stream into the state table in a folder: each batch writes a new snapshot and then its marker, named by checkpoint and batch.

    A batch that is run again after its marker was written is known by it and left out, so nothing counts twice; a new
    checkpoint goes on from the state that is there. after gets the keys of each batch; its errors don't stop the drain.
    """
    held = Snapshots(spark, state)

    def step(batch: DataFrame, number: int) -> None:
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        note = f"{query}-{number}"
        if held.newest()[1] == note:
            return
        schema = batch.select(*keys, *policies).schema
        before = held.read(schema)
        held.write(merge(before if before is not None else spark.createDataFrame([], schema), batch, keys, policies, seq), note)
        if after:
            try:
                after(batch.select(*keys).distinct())
            except Exception as e:  # noqa: BLE001  what follows a drain must not undo it
                print(f"after the drain: {e}")

    log.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, state: str) -> DataFrame:
    """The state as the newest complete snapshot has it."""
    found = Snapshots(spark, state).read()
    if found is None:
        raise FileNotFoundError(f"no snapshot in {state}")
    return found
