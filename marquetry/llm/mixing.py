"""Mixing sources to target shares of tokens by cube-method balanced sampling (problem 9)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.llm.packing import numbered
from marquetry.sources.scratch import Scratch

# Documents of a shard of one source.
SHARD = 8192
# Documents of a shard, of all sizes, that stay undecided for the landing.
RESERVE = 64
TINY = 1e-9


def _undecided(p: np.ndarray) -> np.ndarray:
    return np.flatnonzero((p > TINY) & (p < 1 - TINY))


def _snapped(x: float) -> float:
    return 0.0 if x < TINY else 1.0 if x > 1 - TINY else x


def flight(tokens: np.ndarray, chance: np.ndarray, rng: np.random.Generator, kept: np.ndarray | None = None) -> np.ndarray:
    """Inclusion chances moved to 0 or 1 but for two at most and those `kept`, with the sums of chance x tokens and of
    chance as they were.

    Three undecided documents at a time move along the null space of the two balancing equations, which is the cross
    product of their token counts and of ones, up to the wall of the cube on either side, by the probabilities that
    keep each document's expected inclusion as it was.
    """
    p = chance.astype(float).copy()
    out = np.zeros(len(p), bool)
    out[kept if kept is not None else []] = True
    open_docs = [int(i) for i in _undecided(p) if not out[i]]
    hand: list[int] = []
    while True:
        while len(hand) < 3 and open_docs:
            hand.append(open_docs.pop())
        if len(hand) < 2:
            return p
        if len(hand) == 3:
            a, b, c = (float(tokens[i]) for i in hand)
            u = [b - c, c - a, a - b]
        if len(hand) == 2 or not any(u):
            if tokens[hand[0]] != tokens[hand[1]]:
                return p
            u = [1.0, -1.0, 0.0]  # equal sizes: one for the other
        up = min(((1 - p[i]) / v if v > 0 else -p[i] / v) for i, v in zip(hand, u) if v)
        down = min((p[i] / v if v > 0 else (p[i] - 1) / v) for i, v in zip(hand, u) if v)
        step = up if rng.random() * (up + down) < down else -down
        for i, v in zip(hand, u):
            if v:
                p[i] = _snapped(min(1.0, max(0.0, p[i] + step * v)))
        hand = [i for i in hand if 0.0 < p[i] < 1.0]


def reserve(tokens: np.ndarray, chance: np.ndarray, least: int, room: bool = False) -> np.ndarray:
    """Undecided documents for the landing, evenly over the sizes: `least`, with `room` as many as it takes that they can
    make up for the longest, or all."""
    order = _undecided(chance)
    order = order[np.argsort(tokens[order], kind="stable")]
    slack = tokens * np.minimum(chance, 1 - chance)
    n = least
    while n < len(order):
        some = order[np.linspace(0, len(order) - 1, n).astype(int)]
        if not room or slack[some].sum() >= 2 * tokens[order[-1]]:
            return some
        n *= 2
    return order


def landing(tokens: np.ndarray, chance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """All chances as 0 or 1, each with the chance it had, and the sum of tokens off by less than the last document.

    The number of documents is no longer kept. The longest undecided document moves against all others in proportion
    to their room, up to a wall on either side; so long ones are decided while short ones can still make up for them.
    """
    p = chance.astype(float).copy()
    while len(rest := _undecided(p)) > 1:
        top = rest[tokens[rest].argmax()]
        others = rest[rest != top]
        weight = np.minimum(p[others], 1 - p[others])
        share = tokens[top] * weight / (tokens[others] * weight).sum()
        up, down = min(1 - p[top], (p[others] / share).min()), min(p[top], ((1 - p[others]) / share).min())
        step = up if rng.random() * (up + down) < down else -down
        p[top] += step
        p[others] -= step * share
        p[rest] = [_snapped(x) for x in p[rest]]
    p[rest] = rng.random(len(rest)) < p[rest]
    return np.round(p)


def mixture_plan(docs: DataFrame, targets: DataFrame, total: int | None = None) -> list[dict]:
    """For each listed source: documents, tokens, repeats of each document (a fraction), and the tokens wanted.

    Without `total`, the mixture is the largest in which every source that has tokens gets its share of the whole
    exactly within its repeats; the shares of sources without tokens fall to the others in proportion. With `total`,
    a source that its repeats can't bring to its share gives all it may, and the others share the rest in proportion.
    The number of sources is that of the target table; only sums by source come to the driver.
    """
    sums = docs.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    listed = targets.select("source", F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).filter("source is not null")
    rows = [r.asDict() for r in listed.join(sums, "source", "left").orderBy("source").collect()]
    for r in rows:
        r |= {"docs": r["docs"] or 0, "tokens": int(r["tokens"] or 0), "wanted": 0.0}
        r["most"] = r["tokens"] * max(r["max_repeats"] or 0, 0)
    able = [r for r in rows if r["most"] > 0 and (r["target_share"] or 0) > 0]
    share = sum(r["target_share"] for r in able)
    if able:
        if total is None:
            total = min(r["most"] / (r["target_share"] / share) for r in able)
        rest, free = min(float(total), float(sum(r["most"] for r in able))), list(able)
        while free:
            weight = sum(r["target_share"] for r in free)
            over = [r for r in free if r["target_share"] / weight * rest > r["most"]]
            if not over:
                for r in free:
                    r["wanted"] = r["target_share"] / weight * rest
                break
            for r in over:
                r["wanted"] = float(r["most"])
                rest -= r["most"]
                free.remove(r)
    for r in rows:
        r["repeats"] = r["wanted"] / r["tokens"] if r["tokens"] else 0.0
    return rows


def _flyer(seed: int, turn: int, last: bool, kept: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns=["shards", "shard"]).sort_values(["doc", "tokens", "nth"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, turn, int(key[1]), *map(ord, key[0])])
        mixed = rng.permutation(len(pdf))
        tokens, p = pdf["tokens"].to_numpy(np.int64)[mixed], pdf["chance"].to_numpy(float)[mixed]
        p = flight(tokens, p, rng, reserve(tokens, p, kept, room=last))
        if last:
            p = landing(tokens, p, rng)
        moved = np.empty(len(p))
        moved[mixed] = p
        return pdf.assign(chance=moved, open=(moved > 0) & (moved < 1))

    return run


def mix_sources(spark: SparkSession, docs: DataFrame, targets: DataFrame, total: int | None = None, shard: int = SHARD, seed: int = 42) -> tuple[DataFrame, list[dict]]:
    """((doc, source, tokens, copies) of the mixture, the plan by source).

    docs: (doc, source, tokens); targets: (source, target_share, max_repeats). Every document of a source has the
    same expected copies: the whole part surely, the fraction as a chance. A cube flight in shards of a source
    decides nearly all documents of each while tokens and documents stay balanced; the undecided go on to the next
    round, still with their chances, until a source is one shard. There the last RESERVE or more, of all sizes, land by
    dropping the balance of documents (`landing`), so the tokens are off by less than a short document.
    No document gets more copies than max_repeats. Sources that aren't listed, null sources and documents of no
    tokens stay out. The same input and seed give the same mixture however the input is partitioned.
    """
    s = Scratch(spark)
    plan = mixture_plan(docs, targets, total)
    rates = spark.createDataFrame([(r["source"], r["repeats"]) for r in plan], "source string, repeats double")
    kept = numbered(docs.filter("tokens > 0").join(F.broadcast(rates.filter("repeats > 0").select("source")), "source", "left_semi"), ["doc", "source", "tokens"])
    kept = kept.join(F.broadcast(rates), "source")
    # a rate that is a whole number but for rounding is that number
    whole = F.floor(F.col("repeats") + TINY)
    chance = F.greatest(F.col("repeats") - whole, F.lit(0.0))
    open_docs = s.table(kept.select("doc", "source", "tokens", "nth", whole.cast("int").alias("whole"), chance.alias("chance")))
    doc = docs.schema["doc"].dataType.simpleString()
    schema = f"doc {doc}, source string, tokens bigint, nth int, whole int, chance double, open boolean"
    out, turn, last = None, 0, False
    while not last:
        counts = open_docs.groupBy("source").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / shard)).alias("shards"))
        last = (counts.agg(F.max("shards")).first()[0] or 1) == 1
        lot = F.pmod(F.xxhash64("doc", "nth", F.lit(seed + turn)), F.col("shards"))
        sharded = open_docs.join(F.broadcast(counts), "source").withColumn("shard", lot)
        flyer = _flyer(seed, turn, last, min(RESERVE, max(2, shard // 4)))
        done = s.table(sharded.groupBy("source", "shard").applyInPandas(flyer, schema))
        decided = done.filter("not open")
        out = decided if out is None else out.union(decided)
        open_docs, turn = done.filter("open").drop("open"), turn + 1
    copies = (F.col("whole") + F.round("chance").cast("int")).alias("copies")
    return s.result(out.select("doc", "source", "tokens", copies).filter("copies > 0")), plan


def shares_reached(spark: SparkSession, mixture: DataFrame, plan: list[dict]) -> DataFrame:
    """(source, target_share, max_repeats, docs, tokens, docs_used, copies, tokens_used, share) of each listed source."""
    used = mixture.groupBy("source").agg(
        F.count("*").alias("docs_used"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens_used")
    )
    kind = "source string, target_share double, max_repeats int, docs bigint, tokens bigint"
    listed = spark.createDataFrame([tuple(r[c] for c in ("source", "target_share", "max_repeats", "docs", "tokens")) for r in plan], kind)
    all_used = used.agg(F.sum("tokens_used")).scalar()
    filled = listed.join(used, "source", "left").fillna(0, ["docs_used", "copies", "tokens_used"])
    return filled.withColumn("share", F.col("tokens_used") / all_used)
