"""What runs around jobs: logs of runs, budgets, caches with an end, locks, short cuts. State is small tables, logic is columns."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import barcode_forms

#: Credits that stay unspent in a month.
RESERVE = 500
#: Seconds that a job's lock holds.
COOLDOWN = 660
LOG = logging.getLogger("lodestone")


class JsonLines(logging.Formatter):
    """A log record as one JSON object: time, level, message and what `extra={"fields": ...}` gives."""

    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"ts": self.formatTime(record), "level": record.levelname.lower(), "message": record.getMessage()} | getattr(record, "fields", {}), default=str)


@contextmanager
def stage(name: str, log: Callable[[dict], None], clock: Callable[[], float] = time.time) -> Iterator[dict]:
    """Runs a step: a row when it starts, one when it ends, errors raised on. A log that fails never hides the step's own error."""

    def told(row: dict) -> None:
        try:
            log(row)
        except Exception:  # noqa: BLE001  the step matters more than its log
            LOG.exception("the run log can't be written")

    found: dict = {}
    began = clock()
    told({"stage": name, "status": "running", "started_at": began})
    try:
        yield found
    except BaseException as e:
        told({"stage": name, "status": "error", "started_at": began, "ended_at": clock(), "error": str(e)[:1000]} | found)
        raise
    told({"stage": name, "status": "success", "started_at": began, "ended_at": clock()} | found)


def last_success(runs: DataFrame, job: str) -> float | None:
    """When a job last ended well; runs (stage, status, ended_at)."""
    return runs.filter((F.col("stage") == job) & (F.col("status") == "success")).agg(F.max("ended_at")).first()[0]


def progress(log: DataFrame, total: int) -> DataFrame:
    """(job, done, failed, status) of a log's (job, group, ok): success once so many groups are done; a group counts once."""
    each = log.groupBy("job", "group").agg(F.bool_or("ok").alias("ok"))
    out = each.groupBy("job").agg(F.count_if("ok").alias("done"), F.count_if(~F.col("ok")).alias("failed"))
    return out.withColumn("status", F.when(F.col("done") + F.col("failed") >= total, "success").otherwise("running"))


def unchanged(marker: float | None, last: float | None, forced: bool = False) -> bool:
    """Whether a source has nothing new since the last good run; an unknown marker counts as new."""
    return not forced and marker is not None and last is not None and marker <= last


def checked_cadence(window: float, cadence: float) -> None:
    """A freshness window must end before the next run, or each second run does nothing."""
    if window >= cadence:
        raise ValueError(f"a window of {window} s isn't shorter than its job's cadence of {cadence} s")


def month_credits(calls: DataFrame, now: Column) -> DataFrame:
    """One row (used): credits of this month's calls (at, credits, blocked, ok); blocked and failed calls cost nothing."""
    paid = calls.filter((F.date_trunc("month", "at") == F.date_trunc("month", now)) & ~F.coalesce("blocked", F.lit(False)) & F.coalesce("ok", F.lit(True)))
    return paid.agg(F.coalesce(F.sum("credits"), F.lit(0)).alias("used"))


def may_spend(used: int, limit: int, reserve: int = RESERVE) -> bool:
    return used < limit - reserve


def under_daily_cap(calls: DataFrame, now: Column, cap: int) -> bool:
    """Whether fewer than cap calls (at) were made on the day of now."""
    return calls.filter(F.to_date("at") == F.to_date(now)).count() < cap


def cached(keys: DataFrame, cache: DataFrame, key: str, now: int) -> tuple[DataFrame, DataFrame]:
    """(hits with the cache's value, which may be a stored miss; keys to ask for). cache (key, value, expires_at); of equal keys the one that ends last."""
    live = cache.filter(F.col("expires_at") > now).groupBy(key).agg(F.max_by(F.struct("value"), "expires_at")["value"].alias("value"))
    return keys.join(live, key), keys.join(live, key, "left_anti")


def remembered(cache: DataFrame, answers: DataFrame, key: str, now: int, found_for: int, missing_for: int) -> DataFrame:
    """The cache after answers (key, value, outcome): found ones and misses are kept for their times, failures that may pass are not."""
    kept = answers.filter("outcome in ('found', 'missing')").select(key, F.when(F.col("outcome") == "found", F.col("value")).alias("value"), (F.lit(now) + F.when(F.col("outcome") == "found", found_for).otherwise(missing_for)).cast("long").alias("expires_at"))
    return cache.join(kept.select(key), key, "left_anti").unionByName(kept.dropDuplicates([key]))


def forgotten(cache: DataFrame, codes: DataFrame, providers: list[str]) -> DataFrame:
    """The cache (key: provider:code, ...) without a barcode's equal forms, at every provider."""
    forms = codes.select(F.explode(barcode_forms(F.col("code"))).alias("c"))
    keys = forms.select(F.explode(F.array(*[F.concat(F.lit(f"{p}:"), F.col("c")) for p in providers])).alias("key")).distinct()
    return cache.join(keys, "key", "left_anti")


def locked(locks: DataFrame, name: str, now: int, ttl: int = COOLDOWN) -> bool:
    """Whether a lock (name, taken_at) still holds."""
    return not locks.filter((F.col("name") == name) & (F.col("taken_at") > now - ttl)).isEmpty()


def wider(near: DataFrame, far: DataFrame, by: list[str], few: int = 5) -> DataFrame:
    """Summaries (by..., n, ...) of a short window, or of the long one where the short has fewer than `few` and the long has more."""
    names = [c for c in near.columns if c not in by]
    met = near.withColumnsRenamed({c: f"_a_{c}" for c in names}).join(far.withColumnsRenamed({c: f"_b_{c}" for c in names}), by, "full")
    n = lambda k: F.coalesce(F.col(f"_{k}_n"), F.lit(0))
    use_far = (n("a") < few) & (n("b") > n("a"))
    return met.select(*by, *[F.when(use_far, F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")).alias(c) for c in names])


def wider_of(summaries: DataFrame, by: list[str], far: str, few: int = 5) -> DataFrame:
    """wider for summaries of both windows in one table, the long one's where `far` is true: the table is made and read once."""
    names = [c for c in summaries.columns if c not in (*by, far)]
    row = F.struct(*names)
    met = summaries.groupBy(*by).agg(F.max(F.when(~F.col(far), row)).alias("_a"), F.max(F.when(F.col(far), row)).alias("_b"))
    n = lambda k: F.coalesce(F.col(f"_{k}.n"), F.lit(0))
    use_far = (n("a") < few) & (n("b") > n("a"))
    return met.select(*by, *[F.when(use_far, F.col(f"_b.{c}")).otherwise(F.col(f"_a.{c}")).alias(c) for c in names])


def clamped(value: int | None, default: int, most: int) -> int:
    """A limit between 1 and most."""
    return max(1, min(most, default if value is None else int(value)))


def page(df: DataFrame, key: str, after, limit: int) -> tuple[DataFrame, dict]:
    """(the next rows by key, {cursor, has_more, remaining}); the page is read once for its end and once for its rows, both by key."""
    rest = df if after is None else df.filter(F.col(key) > after)
    rows = rest.orderBy(key).limit(limit)
    end = rows.agg(F.max(key)).first()[0]
    left = rest.filter(F.col(key) > end).count() if end is not None else 0
    return rows, {"cursor": end, "has_more": left > 0, "remaining": left}


def config_int(config: DataFrame, key: str, default: int) -> int:
    """A whole number that isn't negative from config (key, value); the default where it's missing or malformed."""
    found = config.filter(F.col("key") == key).select(F.floor(F.col("value").try_cast("double")).alias("v")).first()
    return int(found["v"]) if found and found["v"] is not None and found["v"] >= 0 else default


def config_terms(config: DataFrame) -> DataFrame:
    """(game, term, pos) of enabled rows (game, enabled, terms as a JSON list); malformed lists give none."""
    return config.filter(F.coalesce("enabled", F.lit(0)) == 1).select("game", F.posexplode(F.from_json("terms", "array<string>")).alias("pos", "term")).select("game", "term", "pos")


def options(kind: type, env: dict[str, str]):
    """A dataclass of whole numbers from an environment's strings: upper-case names, malformed or missing ones keep their default."""
    given = {}
    for f in fields(kind):
        text = env.get(f.name.upper(), "").strip()
        if text.lstrip("-").isdigit() and int(text) >= 0:
            given[f.name] = int(text)
    return kind(**given)


@dataclass
class Breaker:
    """Stops a run at a refusal, or after so many failures in a row that may pass."""

    most: int = 10
    failures: int = 0
    stopped: bool = False

    def told(self, outcome: str) -> bool:
        """outcome ok, refused, transient or permanent; whether the run may go on."""
        self.failures = self.failures + 1 if outcome == "transient" else 0
        self.stopped = self.stopped or outcome == "refused" or self.failures >= self.most
        return not self.stopped
