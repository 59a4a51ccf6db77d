"""Enrichment from outside: snapshot tables, tiers, and fetchers with retries over distinct keys."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import FEW_ROWS, map_back, sized
from .schema import quoted


class Fetcher(Protocol):
    """Looks up a batch of keys: key -> fields. A key without a record is left out. Errors are raised."""

    def __call__(self, keys: Sequence[str]) -> dict[str, dict[str, object]]: ...


class RetryExhausted(RuntimeError):
    """A batch failed in every attempt."""


@dataclass(frozen=True)
class Policy:
    """How a lookup fails.

    on_failure: `raise` ends the job, because an error must not look like an absent value; `status` records that the attempts are
    exhausted; `null` leaves the fields empty, as if nothing were found.
    wait: seconds before the next attempt; growth `double` or `linear`. retryable: the exceptions to try again after; others
    are recorded as error:<type> (`status`) or treated as failures.
    """

    on_failure: str = "raise"
    attempts: int = 3
    wait: float = 5.0
    growth: str = "double"
    most_wait: float = 3600.0
    delay: float = 0.0
    batch: int = 50
    retryable: tuple[type[BaseException], ...] = (OSError,)
    found: str = "found"
    missing: str = "missing"
    exhausted: str = "retry_exhausted"
    error: str = "error"
    sleep: Callable[[float], None] = field(default=time.sleep, compare=False)

    def pause(self, attempt: int) -> float:
        grown = self.wait * (2 ** (attempt - 1) if self.growth == "double" else attempt)
        return min(grown, self.most_wait)


#: Attempts, waits and batches of the known services.
DOCUMENTS = Policy("raise", attempts=3, wait=5.0, growth="double", batch=50)
COMPOUNDS = Policy("status", attempts=3, wait=1.0, growth="linear", delay=0.2, batch=1)
PROTEINS = Policy("null", attempts=1, delay=0.2, batch=1)
GENERATOR = Policy("status", attempts=5, wait=2.0, growth="double", most_wait=60.0, batch=1)


def attempt(fetch: Fetcher, keys: Sequence[str], policy: Policy) -> tuple[dict[str, dict[str, object]], str | None]:
    """The records of a batch, and the status that stands for a failure, if any."""
    last: BaseException | None = None
    for n in range(1, policy.attempts + 1):
        try:
            return fetch(keys), None
        except policy.retryable as e:
            last = e
            if n < policy.attempts:
                policy.sleep(policy.pause(n))
        except Exception as e:
            if policy.on_failure == "raise":
                raise
            return {}, f"{policy.error}:{type(e).__name__}" if policy.on_failure == "status" else policy.missing
    if policy.on_failure == "raise":
        raise RetryExhausted(f"{len(keys)} keys failed in {policy.attempts} attempts") from last
    return {}, policy.exhausted if policy.on_failure == "status" else policy.missing


def fetched(keys: DataFrame, key: str, fetch: Fetcher, fields: Sequence[str], policy: Policy, *, tasks: int = 1) -> DataFrame:
    """(key, fields as text, status) of the distinct non-null keys, each asked for once.

    `tasks` bounds how many batches are under way at once, and with policy.delay the rate of requests. Write the result before
    use: a task that is run again asks again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked = b.column(0).to_pylist()
            for i in range(0, len(asked), policy.batch):
                part = asked[i : i + policy.batch]
                records, failed = attempt(fetch, part, policy)
                rows = [records.get(k) for k in part]
                values = [pa.array([None if r is None or r.get(f) is None else str(r[f]) for r in rows], pa.string()) for f in fields]
                status = [policy.found if r is not None else failed or policy.missing for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *values, pa.array(status, pa.string())], names=["key", *fields, "status"])
                if policy.delay:
                    policy.sleep(policy.delay)

    asked = keys.select(quoted(key).cast("string").alias("key")).where("key IS NOT NULL").distinct().repartition(tasks, "key")
    schema = ", ".join(["key string", *[f"`{f}` string" for f in fields], "status string"])
    out = asked.mapInArrow(run, schema)
    return out.withColumnRenamed("key", key)


def resumed(keys: DataFrame, key: str, store: DataFrame | None, fetch: Fetcher, fields: Sequence[str], policy: Policy, *, tasks: int = 1) -> DataFrame:
    """Results for the keys that a store of earlier results lacks; append them to it. Failures in the store count as done; filter
    them out of it to ask again."""
    todo = keys if store is None else keys.join(store.select(quoted(key)), key, "left_anti")
    return fetched(todo, key, fetch, fields, policy, tasks=tasks)


def stored(keys: DataFrame, key: str, path: str, fetch: Fetcher, fields: Sequence[str], policy: Policy, *, every: int = 50, tasks: int = 1) -> DataFrame:
    """The Parquet store at path, with results for all keys: those that it lacks are looked up about `every` at a time (dealt by
    hash), and each lot is appended before the next one is asked for. A run that fails keeps the lots behind it, and the next
    one goes on from there; the caller deletes the store when it isn't needed any more."""
    spark = keys.sparkSession
    schema = ", ".join([f"`{key}` string", *[f"`{f}` string" for f in fields], "status string"])
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    todo = keys.select(quoted(key).cast("string").alias(key)).where(quoted(key).isNotNull()).distinct()
    if there:
        todo = todo.join(spark.read.schema(schema).parquet(path).select(quoted(key)), key, "left_anti")
    lots = max(1, -(-todo.count() // every))
    for i in range(lots):
        lot = todo.where(F.pmod(F.xxhash64(quoted(key)), F.lit(lots)) == i)
        fetched(lot, key, fetch, fields, policy, tasks=tasks).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard_store(keys: DataFrame, path: str) -> None:
    """Delete the store of stored(), once what was made of it is written."""
    at = keys.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(keys.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: What a service's release is told by, and the message where it can't be had.
RELEASE = ("chembl_db_version", "chembl_release_date", "api_version")
NO_RELEASE = "Could not retrieve ChEMBL status: {}"


def service_status(ask: Callable[[], object], fields: Sequence[str] = RELEASE, failed: str = NO_RELEASE) -> dict:
    """The fields of a service's status (ask() gives it, or a list that begins with it), null where it lacks one; a failure is recorded
    as data, for it must not end a run whose results are there."""
    try:
        answer = ask()
        first = answer[0] if isinstance(answer, list) else answer
        return {f: first.get(f) for f in fields}
    except Exception as e:
        return {"error": failed.format(e)}


def lookup(df: DataFrame, key: str, dim: DataFrame, fields: Sequence[str], *, status: str, found: str, missing: str, no_key: str, limit: int = FEW_ROWS) -> DataFrame:
    """df with the fields of a snapshot table, and a status: found, missing, or no_key for a null key. A later lookup on a field
    that this one brings (chained) sees null keys where nothing was found."""
    hits = dim.where(quoted(key).isNotNull()).select(quoted(key), *[quoted(f) for f in fields], F.lit(found).alias(status))
    out = map_back(df, hits, [key], limit=limit)
    return out.withColumn(status, F.when(quoted(key).isNull(), F.lit(no_key)).otherwise(F.coalesce(status, F.lit(missing))))


def tiered(df: DataFrame, keys: Sequence[str], tiers: Sequence[DataFrame], value: str, rank: str, *, limit: int = FEW_ROWS) -> DataFrame:
    """df with value: the first hit by rank in the first tier that has any, and tier (from 1; null without a hit)."""
    hits = None
    for i, t in enumerate(tiers, 1):
        part = t.groupBy(*[quoted(k) for k in keys]).agg(F.min_by(quoted(value), quoted(rank)).alias(value)).withColumn("tier", F.lit(i))
        hits = part if hits is None else hits.unionByName(part)
    best = hits.groupBy(*[quoted(k) for k in keys]).agg(F.min_by(quoted(value), "tier").alias(value), F.min("tier").alias("tier"))
    there = F.lit(True)
    for k in keys:
        there = there & quoted(k).isNotNull()
    return map_back(df, best.where(there), keys, limit=limit)


def snapshot(dim: DataFrame, key: str, limit: int = FEW_ROWS) -> DataFrame:
    """A dimension table unique on its key, broadcast if it is small."""
    return sized(dim.dropDuplicates([key]), limit)
