"""Variants of one film under several bookings: 3D editions by base title, event bookings by fuzzy match."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.functions.entities import base_title, list_or_empty, synopsis_prefix, variant_title
from marquetry.functions.similarity import Letters, Masks, Texts, token_sort
from marquetry.sources.scratch import stored


def merge_editions(df: DataFrame, key: str, title: str, special: Column, lists: list[str]) -> DataFrame:
    """3D and standard editions of one base title get has_3d_version = 1 and, in each list column, the sorted union of
    all editions' values; other rows get 0. Editions of a base title with only one kind stay as they are.

    One aggregation by base title and a join back. A null title is an edition of nothing.
    """
    marked = df.withColumns({"_base": base_title(title), "_special": F.coalesce(special, F.lit(False))})
    groups = marked.filter(F.col("_base").isNotNull()).groupBy(F.col("_base").alias("_b"))
    merged = groups.agg(
        F.max("_special").alias("_any"), F.min("_special").alias("_all"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_set(list_or_empty(c))))).alias(f"_m_{c}") for c in lists),
    ).filter("_any and not _all")
    out = marked.join(merged, marked["_base"] == merged["_b"], "left")
    has = F.col("_b").isNotNull()
    columns = {"has_3d_version": has.cast("int")} | {c: F.when(has, F.col(f"_m_{c}")).otherwise(F.col(c)) for c in lists}
    return out.withColumns(columns).drop("_base", "_special", "_b", "_any", "_all", *(f"_m_{c}" for c in lists))


# Of a block: distinct synopses for each centre, most centres; synopses that are met at once, pairs of rows and events that are.
MEMBERS, CENTRES, AT_ONCE, PAIRS = 48, 512, 32, 500_000
# Events that one block meets, most rows of a block.
EVENTS, ROWS = 16_384, 65_536
# All rows come last; one in so many before them, for scores to beat.
SHARES = (64, 8, 1)


def _ratio(common: np.ndarray, length: np.ndarray) -> np.ndarray:
    """`indel_ratio` by the letters in common and the sum of both lengths."""
    return np.where(length > 0, 100.0 * 2 * common / np.maximum(length, 1), 100.0)


def _word_vectors(texts: list[str]) -> np.ndarray:
    """Hashed words by the letters in them, so that a product counts the letters of shared words."""
    out = np.zeros((len(texts), 256), np.float32)
    for row, text in zip(out, texts):
        for w in text.split():
            row[crc32(w.encode("utf-8", "surrogatepass")) % 256] = (len(w) + 1) ** 0.5
    return out


class _Block:
    """The distinct synopses of the standard rows of a block, each beside the likest centre, and their titles."""

    def __init__(self, standard: pd.DataFrame):
        self.keys = standard["d"].to_numpy()
        self.titles = [token_sort(t) for t in standard["t"]]
        self.letters = Letters(self.titles)
        code, texts = pd.factorize(standard["s"])
        self.texts = list(texts)
        self.text_letters = Letters(self.texts)
        self.length = self.text_letters.length
        # rows by synopsis
        self.rows = np.argsort(code, kind="stable")
        self.first = np.searchsorted(code[self.rows], np.arange(len(self.texts) + 1))
        vectors = _word_vectors(self.texts)
        n = min(CENTRES, -(-len(self.texts) // MEMBERS))
        self.centres = np.linspace(0, len(self.texts) - 1, n).astype(np.int64)
        own = (vectors[self.centres] ** 2).sum(1)
        near = [(2 * vectors[i : i + 4096] @ vectors[self.centres].T - own).argmax(1) for i in range(0, len(self.texts), 4096)]
        self.centre = np.concatenate(near)
        masks = Masks([self.texts[c] for c in self.centres])
        common = masks.pair_common(masks.codes(self.texts), np.arange(len(self.texts)), self.centre)
        self.away = self.length + masks.length[self.centre] - 2 * common.astype(np.int64)


class _Search:
    """The best standard row of a block for each event, found from `known` scores upwards."""

    def __init__(self, block: _Block, events: pd.DataFrame, least: float):
        self.block = block
        self.best = np.maximum(events["known"].to_numpy() - 1e-9, least)
        self.found: list = [None] * len(events)
        self.titles = [token_sort(t) for t in events["t"]]
        self.letters = Letters(self.titles)
        self.levels = self.letters.levels()
        self.reached, self.rows_reached = self.letters.reached(self.levels), block.letters.reached(self.levels)
        self.masks = Masks(self.titles)
        self.codes = self.masks.codes(block.titles)
        code, texts = pd.factorize(events["s"])
        self.texts, letters = Masks(list(texts)), Letters(list(texts))
        levels = letters.levels()
        self.text_reached, self.block_reached = letters.reached(levels), block.text_letters.reached(levels)
        self.events = np.argsort(code, kind="stable")
        self.first = np.searchsorted(code[self.events], np.arange(len(texts) + 1))

    def run(self) -> None:
        block, every = self.block, np.arange(len(self.texts.length))
        codes = self.texts.codes(block.texts)
        common = self.texts.all_common(codes[block.centres], every)
        total = block.length[block.centres, None] + self.texts.length
        scores = _ratio(common, total)
        for start in range(0, len(block.centres), AT_ONCE):
            self._meet(block.centres[start : start + AT_ONCE], every, scores[start : start + AT_ONCE])
        away = total - 2 * common.astype(np.int64)
        order = np.lexsort((block.away, block.centre))
        order = order[~np.isin(order, block.centres)]
        ends = np.searchsorted(block.centre[order], np.arange(len(block.centres) + 1))
        for centre in range(len(block.centres)):
            for start in range(ends[centre], ends[centre + 1], AT_ONCE):
                at = order[start : min(start + AT_ONCE, ends[centre + 1])]
                # by the triangle inequality, no synopsis of these is nearer than that
                least, longest = np.maximum(away[centre] - block.away[at].max(), 0), block.length[at].max() + self.texts.length
                which = np.flatnonzero(_ratio((longest - least) / 2, longest) >= self._needed() - 1e-6)
                if len(which):
                    total = block.length[at, None] + self.texts.length[which]
                    most = (total - np.maximum(away[centre, which] - block.away[at, None], 0)) / 2
                    common = self.block_reached[at] @ self.text_reached[which].T
                    self._meet(at, which, _ratio(np.minimum(most, common), total), codes[at])

    def _needed(self) -> np.ndarray:
        """The least synopsis score for each of the events' synopses that may still give a best row, if the titles are alike."""
        return (np.minimum.reduceat(self.best[self.events], self.first[:-1]) - 40.0) / 0.6

    def _meet(self, at: np.ndarray, which: np.ndarray, scores: np.ndarray, codes: np.ndarray | None = None) -> None:
        """The rows of the synopses `at` with the events of the synopses `which`. `scores` are those of the synopses, or
        bounds of them, if their `codes` are given."""
        rows, x = _spread(self.block.first, at)
        rows = self.block.rows[rows]
        events, y = _spread(self.first, which)
        events = self.events[events]
        reached, lengths = self.rows_reached[rows], self.block.letters.length[rows].astype(np.float32)[:, None]
        step = max(1, PAIRS // len(rows))
        for start in range(0, len(events), step):
            e, of = events[start : start + step], y[start : start + step]
            met, of = slice(of[0], of[-1] + 1), of - of[0]
            bound, theirs = scores[:, met], which[met]
            # letters that the titles must have in common
            short = ((self.best[e] - 0.6 * bound[:, of]) / 80.0).astype(np.float32)
            least = short[x] * (lengths + self.letters.length[e].astype(np.float32)) - np.float32(0.01)
            common = reached @ self.reached[e].T
            r, c = np.nonzero(common >= least)
            if not len(r):
                continue
            if codes is not None:
                wanted = np.zeros(bound.shape, bool)
                wanted[x[r], of[c]] = True
                i, j = np.nonzero(wanted)
                bound = np.zeros(bound.shape)
                bound[i, j] = _ratio(self.texts.pair_common(codes, i, theirs[j]), self.block.length[at[i]] + self.texts.length[theirs[j]])
            text = bound[x[r], of[c]]
            row, event = rows[r], e[c]
            total = self.block.letters.length[row] + self.letters.length[event]
            hopeful = np.flatnonzero(0.4 * _ratio(common[r, c], total) + 0.6 * text >= self.best[event] - 1e-3)
            row, event, text = row[hopeful], event[hopeful], text[hopeful]
            title = _ratio(self.masks.pair_common(self.codes, row, event), total[hopeful])
            self.take(row, event, 0.4 * title + 0.6 * text)

    def take(self, row: np.ndarray, event: np.ndarray, score: np.ndarray) -> None:
        hit = np.flatnonzero(score >= self.best[event])
        hit = hit[np.lexsort((self.block.keys[row[hit]], -score[hit], event[hit]))]
        for i in hit[np.unique(event[hit], return_index=True)[1]]:
            e, key, now = event[i], self.block.keys[row[i]], score[i]
            if self.found[e] is None or now > self.best[e] or key < self.found[e]:
                self.found[e], self.best[e] = key, now


def _spread(first: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all members of the groups, which begin at `first`, and which of `groups` each belongs to."""
    n = first[groups + 1] - first[groups]
    of = np.repeat(np.arange(len(groups)), n)
    return first[groups][of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), of


def _by_title(block: _Block, texts: Texts, t: str, known: float, least: float):
    """The best row for an event by titles alone: from the highest bound down."""
    t, best, least_key = token_sort(t), max(known - 1e-9, least), None
    bound = texts.bound(t)
    order = np.flatnonzero(bound >= best - 1e-9)
    order = order[np.argsort(-bound[order], kind="stable")]
    for start in [0, *range(64, len(order), 2048)]:
        at = order[start : start + (2048 if start else 64)]
        if not len(at) or bound[at[0]] < best - 1e-9:
            break
        score = texts.ratio(t, at)
        top = score.max(initial=-1.0)
        if top >= best:
            key = block.keys[at[score == top]].min()
            least_key = key if least_key is None or top > best else min(key, least_key)
            best = top
    return least_key, best


def _best_of_cell(least: float):
    """The best standard row of a cell for each of its events that reaches `least` and what is already known of the event.

    With synopses: the cell's distinct synopses stand beside centres, and the distance to a centre tells which of the
    events' synopses can be near enough for the score to beat; these are compared, then the titles of the rest, bounded
    by their letters first. Without: titles alone.
    """

    def run(events: pd.DataFrame, standard: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(events) and len(standard):
            block = _Block(standard)
            alone = events[~events["both"]]
            if len(alone):
                texts = Texts(block.titles)
                for e, t, known in zip(alone["e"], alone["t"], alone["known"]):
                    key, best = _by_title(block, texts, t, known, least)
                    if key is not None:
                        found.append((e, key, best))
            rest = events[events["both"]]
            # the masks take a place for each event and letter
            step = max(256, 4_000_000 // max(1, len(set().union(*rest["s"], *rest["t"]))))
            for start in range(0, len(rest), step):
                part = rest.iloc[start : start + step]
                search = _Search(block, part, least)
                search.run()
                found += [(e, key, best) for e, key, best in zip(part["e"], search.found, search.best) if key is not None]
        return pd.DataFrame(found, columns=["e", "d", "score"])

    return run


def fuzzy_best(df: DataFrame, key: str, title: str, synopsis: str, least: float = 60.0, cell: int = 2048) -> DataFrame:
    """(event_key, standard_key, score): for each event booking ('GC ...') its best standard row of all, if it scores `least`.

    Score: 0.4 x token-sorted Indel ratio of the titles + 0.6 x Indel ratio of the first 80 letters of the synopses, or
    the titles alone where no standard synopsis shares a letter with the event's. Ties go to the least key. Rows alike
    in both count once. The events are a stated query set against all rows, in blocks of at least `cell` distinct rows,
    three times: first against one in 64 and one in 8 rows, which gives each event a score to beat; then against all. Only
    pairs are scored whose upper bound reaches it: for the synopses by the distance of both to a third and by counts of
    letters, for the titles by counts of letters.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(title).isNotNull()).select(
        F.col(key).alias("k"), F.upper(F.col(title)).startswith("GC ").alias("event"), variant_title(title).alias("t"), synopsis_prefix(synopsis).alias("s")
    )
    bookings = stored(spark, rows)
    # rows alike in all that counts score alike, so the least key stands for them
    rows = bookings.groupBy("event", "t", "s").agg(F.min("k").alias("k"))
    letters = lambda c: F.array_remove(F.array_distinct(F.split(c, "")), "")
    standard = stored(spark, rows.filter("not event").select(F.col("k").alias("d"), "t", "s"))
    known = standard.select(F.explode(letters("s")).alias("c")).agg(F.collect_set("c").alias("all"))
    events = rows.filter("event").crossJoin(F.broadcast(known)).select(F.col("k").alias("e"), "t", "s", F.arrays_overlap(letters("s"), "all").alias("both"))
    events = stored(spark, events)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q = max(1, -(-events.count() // EVENTS))
    place = lambda n: F.pmod(F.xxhash64("t", "s"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kind = df.schema[key].dataType.simpleString()
    events = events.withColumn("known", F.lit(0.0))
    for share in SHARES:
        met = standard.filter(F.pmod(F.xxhash64("s", "t"), F.lit(share)) == 0)
        n = met.count()
        p = max(1, min(-(-n // cell), tasks), -(-n // ROWS))
        right = met.withColumn("p", place(p)).withColumn("q", every(q)).repartition(min(tasks, p * q), "p", "q").groupBy("p", "q")
        left = events.withColumn("q", place(q)).withColumn("p", every(p)).repartition(min(tasks, p * q), "p", "q").groupBy("p", "q")
        best = left.cogroup(right).applyInPandas(_best_of_cell(least), f"e {kind}, d {kind}, score double")
        best = stored(spark, best.groupBy("e").agg(F.max_by(F.struct("d", "score"), F.struct("score", -F.col("d"))).alias("b")))
        events = events.drop("known").join(best.select("e", F.col("b.score").alias("known")), "e", "left").fillna(0.0, "known")
    best = best.join(events, "e").select("t", "s", F.col("b.d").alias("standard_key"), F.col("b.score").alias("score"))
    return stored(spark, bookings.filter("event").join(best, ["t", "s"]).select(F.col("k").alias("event_key"), "standard_key", "score"))


def merge_events(df: DataFrame, matches: DataFrame, key: str, synopsis: str, lists: list[str]) -> DataFrame:
    """Matched event bookings folded into their standard rows: the longest synopsis (the standard one on a tie) and the
    sorted union of each list; the event rows go."""
    events = matches.join(df, matches["event_key"] == df[key])
    folded = events.groupBy("standard_key").agg(
        F.max_by(F.coalesce(synopsis, F.lit("")), F.struct(F.char_length(F.coalesce(synopsis, F.lit(""))), -F.col("event_key"))).alias("_text"),
        *(F.array_distinct(F.flatten(F.collect_set(list_or_empty(c)))).alias(f"_m_{c}") for c in lists),
    )
    rest = df.join(matches.select(F.col("event_key").alias(key)), key, "left_anti")
    out = rest.join(folded, rest[key] == folded["standard_key"], "left")
    hit = F.col("standard_key").isNotNull()
    longer = hit & (F.char_length("_text") > F.coalesce(F.char_length(synopsis), F.lit(0)))
    columns = {synopsis: F.when(longer, F.col("_text")).otherwise(F.col(synopsis))}
    columns |= {c: F.when(hit, F.array_sort(F.array_union(list_or_empty(c), f"_m_{c}"))).otherwise(F.col(c)) for c in lists}
    return out.withColumns(columns).drop("standard_key", "_text", *(f"_m_{c}" for c in lists))
