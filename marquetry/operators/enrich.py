"""Enrichment by pluggable providers: record x task fan-out, parsing, ledger, cost and batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquetry.functions.jsonx import failure_class, flatten_payloads, salvaged_json, strict_json
from marquetry.operators.curate import keep_first
from marquetry.operators.upsert import merge_ledger, upsert
from marquetry.sources.files import Task
from marquetry.sources.scratch import stored

ANSWER = "key string, task string, raw string, status string, error string, prompt_tokens bigint, completion_tokens bigint, search_calls bigint"


@dataclass
class Answer:
    raw: str | None = None
    status: str = "completed"
    error: str | None = None
    prompt_tokens: int = 0
    completion_tokens: int = 0
    search_calls: int = 0


class Provider(Protocol):
    """Answers a question; opened once per task of the cluster. It may raise RateLimited to be asked again."""

    def ask(self, key: str, task: Task, content: str) -> Answer: ...


class RateLimited(Exception):
    """The provider wants to be asked later."""


@dataclass
class ReplayProvider:
    """Recorded answers by (key, task); a missing one is an error. For offline runs over fixtures of bounded size."""

    answers: dict[tuple[str, str], Answer]

    def ask(self, key: str, task: Task, content: str) -> Answer:
        return self.answers.get((key, task.name), Answer(error="no recorded answer"))


def with_retries(ask: Callable[[], Answer], attempts: int = 8, pause: float = 3.0, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """An answer, asked again after growing pauses when the provider is rate-limited; other failures become errors."""
    for n in range(attempts):
        try:
            return ask()
        except RateLimited as e:
            if n == attempts - 1:
                return Answer(error=f"RateLimited: {e}"[:300])
            sleep(min(longest, pause * 2**n))
        except Exception as e:  # noqa: BLE001 - a failed record must not fail its batch
            return Answer(error=f"{type(e).__name__}: {e}"[:300])
    return Answer(error="not asked")


def ask_all(df: DataFrame, key: str, content: str, tasks: list[Task], provider: Provider, concurrency: int = 4) -> DataFrame:
    """One answer for each record and task. Each executor task asks `concurrency` questions at a time, so the load on the
    provider is bounded by the partitions of `df` times that."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in batches:
                jobs = [(k, t, c) for k, c in zip(pdf["key"], pdf["content"]) for t in tasks]
                answers = pool.map(lambda j: with_retries(lambda: provider.ask(*j)), jobs)
                rows = [(k, t.name, a.raw, a.status, a.error, a.prompt_tokens, a.completion_tokens, a.search_calls) for (k, t, _), a in zip(jobs, answers)]
                yield pd.DataFrame(rows, columns=[f.split()[0] for f in ANSWER.split(", ")])

    return df.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content")).mapInPandas(run, ANSWER)


def parsed(answers: DataFrame, salvage: bool = True) -> DataFrame:
    """`answers` with payload (JSON text or null) and _error: the provider's, or why the text can't be used."""
    payload = salvaged_json("raw") if salvage else strict_json("raw")
    unusable = failure_class(F.col("raw"), F.col("status"), F.lit(None).cast("string")) if salvage else F.when(payload.isNull(), "json_parse_error")
    return answers.withColumns({"payload": payload, "_error": F.coalesce("error", unusable)})


def one_row_per_record(answers: DataFrame, tasks: list[str], keys: list[str]) -> DataFrame:
    """(key, values of `keys`, task__key where tasks differ, _error): parsed answers of all tasks of a record as one row;
    an error of any task is the record's."""
    wide = answers.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("task", F.coalesce("payload", F.lit(""))))).alias("p"), F.min("_error").alias("_error")
    )
    columns = flatten_payloads([(t, F.nullif(F.try_element_at("p", F.lit(t)), F.lit(""))) for t in tasks], keys)
    return wide.select("key", *(v.alias(k) for k, v in columns.items()), "_error")


def usage(answers: DataFrame, price_in: float, price_out: float, price_search: float = 0.0, group: list[str] | None = None) -> DataFrame:
    """Tokens, searches and cost by group; prices are per million tokens and per search, given by the caller."""
    sums = answers.groupBy(*(group or [])).agg(*(F.sum(c).alias(c) for c in ("prompt_tokens", "completion_tokens", "search_calls")))
    cost = (F.col("prompt_tokens") * price_in + F.col("completion_tokens") * price_out) / 1e6 + F.col("search_calls") * price_search
    return sums.withColumn("cost", cost)


def postprocessed(df: DataFrame, column: str, name: str | None, registry: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """A column passed through the registered function of that name; no name or an unknown one leaves it as it is."""
    return df.withColumn(column, registry[name](F.col(column))) if name in registry else df


def enrich(
    spark: SparkSession,
    work: DataFrame,
    checkpoint: DataFrame,
    errors: DataFrame,
    key: str,
    content: str,
    tasks: list[Task],
    provider: Provider,
    keys: list[str],
    batches: int = 1,
    most_cost: float | None = None,
    prices: tuple[float, float, float] = (0.0, 0.0, 0.0),
) -> tuple[DataFrame, DataFrame, float]:
    """(checkpoint, errors, cost) after asking for all records of `work` that the checkpoint lacks, in `batches` of about
    equal size by hash of the key. Good records replace older ones in the checkpoint, failed ones go to the ledger,
    recovered ones leave it. No further batch begins once the cost has reached `most_cost`.
    """
    todo = work.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"))
    todo = stored(spark, keep_first(todo.join(checkpoint.select("key"), "key", "left_anti"), ["key"], [F.col("content")]))
    total = 0.0
    for b in range(batches):
        if most_cost is not None and total >= most_cost:
            break
        part = todo.filter(F.pmod(F.xxhash64("key"), F.lit(batches)) == b)
        answers = stored(spark, parsed(ask_all(part, "key", "content", tasks, provider)))
        rows = one_row_per_record(answers, [t.name for t in tasks], keys)
        good = rows.filter("_error is null").drop("_error")
        raw = answers.filter("_error is not null").groupBy("key").agg(F.min(F.struct("_error", F.substring("raw", 1, 1000).alias("_raw_output"))).alias("e"))
        bad = raw.select("key", F.substring("e._error", 1, 300).alias("_error"), "e._raw_output")
        checkpoint = stored(spark, upsert(checkpoint, good, ["key"], "new_wins"))
        errors = stored(spark, merge_ledger(errors, bad, good, "key"))
        total += float(usage(answers, *prices).first()["cost"] or 0.0)
    return checkpoint, errors, total


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def best_hit(hits: DataFrame, key: str, year: str, hit_year: str, place: str) -> DataFrame:
    """The hit of each key: the first within a year of the wanted one, else the first."""
    off = ~F.coalesce(F.abs(F.col(hit_year) - F.col(year)) <= 1, F.lit(False))
    return hits.groupBy(key).agg(F.min_by(F.struct(*[c for c in hits.columns if c != key]), F.struct(off, place)).alias("h")).select(key, "h.*")


def flag_rereleases(df: DataFrame, lookup: DataFrame, key: str, flag: str = "rerelease_flag") -> DataFrame:
    """`df` with the lookup's flag (0 or 1, the greatest where a key has several); 0 where the lookup lacks the key."""
    known = lookup.groupBy(F.col(key).alias("_k")).agg(F.max(F.col(flag).cast("int")).alias("_f"))
    return df.join(known, df[key] == known["_k"], "left").withColumn(flag, F.coalesce("_f", F.lit(0))).drop("_k", "_f")


def rescored(cache: DataFrame, hits: DataFrame, key: str, hit: str, score: str, days_off: str, manual: str) -> DataFrame:
    """Cached picks after a re-score: each key with its best hit by score, then by the least days between release dates,
    then by the hit; keys marked `manual` keep what they have, as do keys without hits. `changed` tells where the pick
    is another one, so its details must be fetched again."""
    order = F.struct(-F.col(score), F.coalesce(F.col(days_off), F.lit(1 << 30)), F.col(hit))
    best = hits.filter(F.col(score).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(F.col(hit).alias("h"), F.col(score).alias("s")), order).alias("_b"))
    out = cache.join(best, cache[key] == best["_k"], "left")
    free = F.col("_b").isNotNull() & ~F.coalesce(F.col(manual), F.lit(False))
    columns = {"changed": free & ~F.col("_b.h").eqNullSafe(F.col(hit)), hit: F.when(free, F.col("_b.h")).otherwise(F.col(hit)), score: F.when(free, F.col("_b.s")).otherwise(F.col(score))}
    return out.withColumns(columns).drop("_k", "_b")
