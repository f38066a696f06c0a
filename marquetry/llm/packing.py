"""Filling fixed-capacity sequences with whole documents by swap-based local search (problem 8)."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.sources.scratch import Scratch

# Items of a shard; a shard is packed by one task, and its underfull sequences go on to the next round.
SHARD = 8192
# A sequence at least this full is settled: it does not go on to the next round.
SETTLED = 0.995


class Bins:
    """Bins of one shard with the items of the underfull ones in one sorted pool."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.size, self.capacity = sizes.tolist(), capacity
        self.fill: list[int] = []
        self.items: list[list[int]] = []
        self.bin_of = [0] * len(sizes)

    def best_fit(self) -> None:
        """Start: items from the largest on, each into the fullest bin with room."""
        room: list[tuple[int, int]] = []
        for i in sorted(range(len(self.size)), key=self.size.__getitem__, reverse=True):
            s = self.size[i]
            at = bisect_left(room, (s, -1))
            if at < len(room):
                left, b = room.pop(at)
            else:
                left, b = self.capacity, len(self.fill)
                self.fill.append(0)
                self.items.append([])
            self.put(i, b)
            if left > s:
                insort(room, (left - s, b))

    def put(self, i: int, b: int) -> None:
        self.items[b].append(i)
        self.fill[b] += self.size[i]
        self.bin_of[i] = b

    def take(self, i: int) -> None:
        b = self.bin_of[i]
        self.items[b].remove(i)
        self.fill[b] -= self.size[i]

    def search(self) -> None:
        """Moves, one-for-one and two-for-one exchanges between underfull bins until none makes the sum of squared
        fills grow, which ends as that sum is bounded.

        A step gives the fuller bin of the two what fills it most: an item of the other (move), or an item for a
        smaller one of its own (one-for-one), or two items for one of its own. So the emptier bin gets emptier still
        until it is gone. Bins are filled from the fullest on; the pool holds the items of those after it, all of
        which are less full, and no candidate in it is passed over.
        """
        moved = True
        while moved:
            moved = False
            order = sorted((b for b in range(len(self.fill)) if 0 < self.fill[b] < self.capacity), key=lambda b: -self.fill[b])
            pool = sorted((self.size[i], i) for b in order for i in self.items[b])
            for n, b in enumerate(order):
                for i in self.items[b]:
                    del pool[bisect_left(pool, (self.size[i], i))]
                while 0 < self.fill[b] < self.capacity and (step := self._step(b, pool, order[n + 1 :])):
                    gone, come = step
                    other = self.bin_of[come[0]]
                    for i in come:
                        del pool[bisect_left(pool, (self.size[i], i))]
                        self.take(i)
                        self.put(i, b)
                    for i in gone:
                        self.take(i)
                        self.put(i, other)
                        insort(pool, (self.size[i], i))
                    moved = True

    def _step(self, b: int, pool: list[tuple[int, int]], others: list[int]) -> tuple[list[int], list[int]] | None:
        gap, most = self.capacity - self.fill[b], len(self.size)
        best, gain = None, 0
        own = {self.size[j]: j for j in self.items[b]}  # items of one size are alike
        for s, j in [(0, None), *own.items()]:
            at = bisect_right(pool, (s + gap, most))
            if at and pool[at - 1][0] > s + gain:
                best, gain = ([] if j is None else [j], [pool[at - 1][1]]), pool[at - 1][0] - s
                if gain == gap:
                    return best
        if not pool:
            return best
        # two of one other bin for one of this bin
        least = pool[0][0]
        able = {s: j for s, j in own.items() if s + gap >= 2 * least}
        for o in others if able else ():
            sizes = sorted(self.items[o], key=self.size.__getitem__)
            for s, j in able.items():
                low, high = 0, len(sizes) - 1
                while low < high:
                    both = self.size[sizes[low]] + self.size[sizes[high]]
                    if both > s + gap:
                        high -= 1
                        continue
                    if both > s + gain:
                        best, gain = ([j], [sizes[low], sizes[high]]), both - s
                        if gain == gap:
                            return best
                    low += 1
        return best


def pack_shard(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item; no item is larger than the capacity."""
    bins = Bins(sizes, capacity)
    bins.best_fit()
    bins.search()
    used = {b: n for n, b in enumerate(sorted({*bins.bin_of}))}
    return np.array([used[b] for b in bins.bin_of], np.int64)


def _packer(capacity: int, turn: int, last: bool, settled: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="shard").sort_values(["tokens", "doc", "nth", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        where = pack_shard(pdf["tokens"].to_numpy(np.int64), capacity)
        fill = np.bincount(where, pdf["tokens"].to_numpy())
        pos = (pdf.groupby(where).cumcount() + 1).astype("int32")
        sequence = (turn << 50) + (int(key[0]) << 20) + where  # below 2^53 in all
        return pdf.assign(sequence=sequence, pos=pos, full=last | (fill[where] >= settled * capacity))

    return run


def numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the columns with `nth`, which numbers equal ones: they are counted and written out again, so no task holds
    the copies of one, and a hash of them with `nth` is the same however the rows lie."""
    counts = rows.groupBy(*columns).agg(F.count("*").alias("_n"))
    return counts.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("nth"))


def pack_items(spark: SparkSession, items: DataFrame, capacity: int, shard: int = SHARD, settled: float = SETTLED, least_settled: float = 0.1) -> DataFrame:
    """(doc, piece, tokens, sequence, pos): each item of (doc, tokens) in a sequence of at most `capacity` tokens.

    A document larger than the capacity is cut into pieces of the capacity and a rest, others are never cut. Items
    are spread by hash over shards of about `shard` items, each packed by one task; the items of sequences under
    `settled` full go on to the next round with as few shards as they need. Rounds end with the one that has a single
    shard left over, or that settles less than `least_settled` of its items, as items that nothing fits beside stay so.
    Documents of no tokens (null or empty texts) take no room: their sequence and pos are null.
    Repeated ids are items each, spread like any other; in a shard ties are broken by size and id. The same items come
    out the same way however the input is partitioned.
    """
    s = Scratch(spark)
    doc = items.schema["doc"].dataType.simpleString()
    n_pieces = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1))
    pieces = numbered(items, ["doc", "tokens"]).select("doc", "tokens", "nth", F.posexplode(F.sequence(F.lit(1), n_pieces)).alias("at", "piece"))
    size = F.least(F.lit(capacity), F.col("tokens") - F.col("at") * capacity)
    pieces = s.table(pieces.select("doc", "nth", F.col("piece").cast("int"), size.alias("tokens")))
    nothing = pieces.filter("tokens = 0").select("doc", "piece", "tokens", F.lit(None).cast("bigint").alias("sequence"), F.lit(None).cast("int").alias("pos"))
    open_items = pieces.filter("tokens > 0")
    schema = f"doc {doc}, nth int, piece int, tokens bigint, sequence bigint, pos int, full boolean"
    out, number, turn, before = nothing, open_items.count(), 0, None
    while number:
        shards = -(-number // shard)
        last = shards == 1 or (before is not None and number > (1 - least_settled) * before)
        # another hash in each round, so leftovers meet new ones
        lot = F.pmod(F.xxhash64("doc", "piece", "nth", F.lit(turn)), F.lit(shards))
        done = s.table(open_items.withColumn("shard", lot).groupBy("shard").applyInPandas(_packer(capacity, turn, last, settled), schema))
        out = out.union(done.filter("full").select("doc", "piece", "tokens", "sequence", "pos"))
        open_items = done.filter("not full").select("doc", "nth", "piece", "tokens")
        before, number, turn = number, 0 if last else open_items.count(), turn + 1
    return s.result(out)
