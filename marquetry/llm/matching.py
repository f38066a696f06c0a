"""Entities of two sources matched without a key: sorted neighbourhood, weighted similarities, one-to-one assignment (problem 3).

Both sources are described by one profile: titles with the trust put in each, days, people and companies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.llm.graph import components
from marquetry.llm.names import skeletons
from marquetry.llm.titles import company_key, date_days, folded_keys, people_roots, title_words
from marquetry.sources.scratch import Scratch

PROFILE = (
    "side int, id bigint, titles array<string>, sequels array<string>, trusts array<double>, days array<int>, years array<int>, people array<string>, "
    "companies array<string>, day int, last int, keys array<struct<sort:string,person:bigint,low:bigint,high:bigint>>, firm_bits bigint, people_bits bigint, names bigint, need bigint"
)
FIELDS = ["titles", "sequels", "trusts", "days", "years", "people", "companies"]
WEIGHTS = {"title": 0.5, "people": 0.2, "day": 0.2, "companies": 0.1}
ACCEPT = 0.6
WINDOW = 12
# Rows of a sorted partition on average at least, so that most windows span no more than two.
PART = 2048
# Stands for the pairs of letters that a near name needs where no person is known.
NOBODY = 64


def _hashes(texts: list[str]) -> np.ndarray:
    """FNV-1a of each text, shifted to signed numbers."""
    coded = [t.encode() for t in texts]
    size, letters = np.array([len(t) for t in coded], np.int64), np.frombuffer(b"".join(coded), np.uint8)
    start, longest = np.cumsum(size) - size, np.argsort(-size, kind="stable")
    h = np.full(len(texts), 1469598103934665603, np.uint64)
    for i, n in enumerate(len(size) - np.cumsum(np.bincount(size))[:-1]):
        k = longest[:n]  # those with a letter at i
        h[k] = (h[k] ^ letters[start[k] + i]) * np.uint64(1099511628211)
    return (h - np.uint64(1 << 63)).view(np.int64)


def _letter_pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of neighbouring letters: the text of each, first and second letter."""
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.array([len(t) for t in texts], np.int64))
    within = row[1:] == row[:-1]
    return row[1:][within], letters[:-1][within], letters[1:][within]


def _united(rows: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows, in whose order they come, the bits at the places from 0 to 63; other places count for nothing."""
    out = np.zeros(n, np.uint64)
    if len(rows):
        begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        bits = np.where((place >= 0) & (place < 64), np.left_shift(np.uint64(1), (place & 63).astype(np.uint64)), np.uint64(0))
        out[rows[begin]] = np.bitwise_or.reduceat(bits, begin)
    return out.view(np.int64)


def _signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of letters of each text as 128 bits, in two halves."""
    row, x, y = _letter_pairs(texts)
    a, z = ord("a"), ord("z")
    place = np.where((x >= a) & (x <= z) & (y >= a) & (y <= z), (x * 31 + y * 7) % 128, 0)
    return _united(row, place, len(texts)), _united(row, place - 64, len(texts))


class _Cached:
    """Results of a function of many texts, kept for the task; titles, names, dates and firms recur."""

    def __init__(self, function: Callable[[list[str]], list], most: int = 200_000):
        self.function, self.known, self.most = function, {}, most

    def __call__(self, texts: list[str]) -> list:
        new = [t for t in texts if t not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = texts
        self.known.update(zip(new, self.function(new)))
        return [self.known[t] for t in texts]


def _titles(texts: list[str]) -> list[tuple[str, str, str, int, int] | None]:
    """Of each title the form's text, its sequel marks, its longest word and its signature, or None."""
    found = [title_words(t) for t in texts]
    whole = ["".join(f[0]) for f in found if f]
    spelled = [s or w for s, w in zip(skeletons(whole), whole)]
    made = zip(spelled, *(s.tolist() for s in _signatures(spelled)))
    return [f and ((m := next(made))[0], f[1], max(f[0], key=len), *m[1:]) for f in found]


def _people(texts: list[str]) -> list[list[str]]:
    """The keys of the people that each text names."""
    roots = [people_roots(t) for t in texts]
    raw = list(dict.fromkeys(x for named in roots for whole, family, _ in named for x in (*whole, family)))
    folded = dict(zip(raw, skeletons(raw)))
    return [folded_keys(named, folded.__getitem__) for named in roots]


def _near(keys: list[str], full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of letters of each person's name as bits, and how many of them a name near it by `people_likeness` has
    at least: an edit changes two pairs, full names may have two edits, family names one."""
    row, x, y = _letter_pairs([k[1:] if f else k.partition(".")[2] for k, f in zip(keys, full)])
    bits = _united(row, (x * 31 + y * 7) % 63, len(keys))
    return bits, np.maximum(0, _bits(bits) - np.where(full, 4, 2)).astype(np.int64)


def _companies(texts: list[str]) -> list[tuple[str, int] | None]:
    keys = [company_key(t) for t in texts]
    return [k and (k, 1 << h) for k, h in zip(keys, (_hashes([k or "" for k in keys]) % 63).tolist())]


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list]:
    """Of a list column's values: the row of each, its place among the distinct values (-1 for null), the distinct values."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    coded = column.flatten().dictionary_encode()
    index = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(column)), sizes), index, coded.dictionary.to_pylist()


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    """A list column of n rows from values in order of their rows."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _unique(rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, code) pairs in order of the rows."""
    width = int(codes.max(initial=0)) + 1
    return np.divmod(np.unique(rows * width + codes), width)


def _join(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*parts, "")


class _Coded:
    """Numbers for values, in order of first sight."""

    def __init__(self):
        self.code: dict = {}

    def __call__(self, value) -> int:
        return self.code.setdefault(value, len(self.code))


def _describer(side: int):
    """Profiles of batches: each distinct text of a batch is parsed once, all else runs on whole columns.

    The sort keys: each title forwards, backwards and from its longest word, with family name and year after it; and
    each person with the first day. With each key the person's hash, if it leads the key, and the title's signature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, dates, names, firm = _Cached(_titles), _Cached(lambda texts: [date_days(t) for t in texts]), _Cached(_people), _Cached(_companies)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            _, titles, trusts, when, people, companies = batch.columns

            rows, at, texts = _flat(companies)
            parsed = firm(texts)
            known = np.array([x is not None for x in parsed] or [False])[at] & (at >= 0)
            rows, at = rows[known], at[known]
            firm_list = _lists(rows, n, pa.array([x and x[0] for x in parsed], pa.string()).take(pa.array(at)))
            firm_bits = np.zeros(n, np.int64)
            np.bitwise_or.at(firm_bits, rows, np.array([x[1] if x else 0 for x in parsed] or [0], np.int64)[at])

            rows, at, texts = _flat(when)
            parsed = dates(texts) or [(None, False)]
            number = np.array([0 if d is None else d for d, _ in parsed])
            by_year = np.array([y for _, y in parsed])
            known = np.array([d is not None for d, _ in parsed])[at] & (at >= 0)
            exact, coarse = known & ~by_year[at], known & by_year[at]
            day_rows, days = rows[exact], number[at[exact]]
            year_rows, years = rows[coarse], 1970 + number[at[coarse]] // 365
            first_day, last_day, first_year = np.full(n, 1 << 30), np.full(n, -(1 << 30)), np.full(n, 1 << 30)
            np.minimum.at(first_day, day_rows, days)
            np.maximum.at(last_day, day_rows, days)
            np.minimum.at(first_year, year_rows, years)
            has_day = first_day < 1 << 30
            year = np.where(has_day, 1970 + first_day // 365, np.where(first_year < 1 << 30, first_year, 0))

            rows, at, texts = _flat(people)
            key = _Coded()
            named = names(texts)
            codes = np.array([key(x) for keys in named for x in keys], np.int64)
            size = np.array([len(keys) for keys in named], np.int64)
            start = np.cumsum(size) - size
            known = at >= 0
            rows, at = rows[known], at[known]
            many = size[at]
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            p_rows, p_key = _unique(np.repeat(rows, many), codes[np.repeat(start[at], many) + inner])
            spelled = list(key.code) or [""]
            full = np.array([k[:1] == "=" for k in spelled])
            hashes, (pairs, least) = _hashes(spelled), _near(spelled, full)
            names_bits, need = np.zeros(n, np.int64), np.full(n, NOBODY)
            np.bitwise_or.at(names_bits, p_rows, pairs[p_key])
            np.minimum.at(need, p_rows, least[p_key])
            people_bits = np.zeros(n, np.int64)
            np.bitwise_or.at(people_bits, p_rows, np.where(full, 0, np.left_shift(1, hashes % 63))[p_key])
            families, rank = np.unique(np.array(["", *("" if f else k.partition(".")[2][:6] for k, f in zip(spelled, full))]), return_inverse=True)
            family = np.zeros(n, np.int64)
            np.maximum.at(family, p_rows, rank[1:][p_key])
            has_full = np.zeros(n, bool)
            np.logical_or.at(has_full, p_rows, full[p_key])
            leads = full[p_key] | ~has_full[p_rows]

            rows, at, texts = _flat(titles)
            trust = trusts.flatten().to_numpy(zero_copy_only=False).astype(float)
            code, found = _Coded(), form(texts)
            of = [code(f[:2]) if f else -1 for f in found]
            made = dict(zip(of, found))
            of = np.array(of or [-1])[at]
            known = (at >= 0) & (of >= 0) & ~np.isnan(trust)
            rows, of, trust = rows[known], of[known], trust[known]
            order = np.lexsort((-trust, of, rows))
            rows, of, trust = rows[order], of[order], trust[order]
            new = np.append(True, (rows[1:] != rows[:-1]) | (of[1:] != of[:-1])) if len(rows) else np.zeros(0, bool)
            rows, of, trust = rows[new], of[new], trust[new]
            found = [made[i] for i in range(len(code.code))]
            take = lambda values: pa.array(values, pa.string()).take(pa.array(of))
            text, word = take([f[0] for f in found]), take([f[2] for f in found])
            low, high = (np.array([f[k] for f in found] or [0], np.int64)[of] if len(of) else np.zeros(0, np.int64) for k in (3, 4))
            length = pc.utf8_length(text).to_numpy(zero_copy_only=False)
            row_low, row_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
            by_length = np.lexsort((length, rows))
            row_low[rows[by_length]], row_high[rows[by_length]] = low[by_length], high[by_length]  # the longest comes last

            after = _join("|", pa.array(families).take(pa.array(family)), "|", pa.array(year).cast(pa.string()))
            t_after = after.take(pa.array(rows))
            opened = _join("|", pc.utf8_lpad(pa.array(np.where(has_day, first_day, -99999) + 100000).cast(pa.string()), 6, "0"))
            l_rows, l_key = p_rows[leads], p_key[leads]
            p_text = pa.array(spelled, pa.string()).take(pa.array(p_key))
            keys = pa.concat_arrays(
                [
                    _join("t", text, t_after), _join("r", pc.utf8_reverse(text), t_after), _join("w", word, "|", text, t_after),
                    _join("p", pa.array(spelled, pa.string()).take(pa.array(l_key)), opened.take(pa.array(l_rows))),
                ]
            )
            k_rows = np.concatenate([rows, rows, rows, l_rows])
            order = np.argsort(k_rows, kind="stable")
            k_rows = k_rows[order]
            ordered = lambda *parts: pa.array(np.concatenate(parts)[order])
            none = np.zeros(3 * len(rows), np.int64)
            hints = [ordered(none, hashes[l_key]), ordered(low, low, low, row_low[l_rows]), ordered(high, high, high, row_high[l_rows])]
            keys = pa.StructArray.from_arrays([keys.take(pa.array(order)), *hints], names=["sort", "person", "low", "high"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, side, np.int32)), batch.column(0), _lists(rows, n, text), _lists(rows, n, take([f[1] for f in found])),
                    _lists(rows, n, pa.array(trust)), _lists(day_rows, n, pa.array(days.astype(np.int32))), _lists(year_rows, n, pa.array(years.astype(np.int32))),
                    _lists(p_rows, n, p_text), firm_list, pa.array(first_day.astype(np.int32), mask=~has_day), pa.array(last_day.astype(np.int32), mask=~has_day),
                    _lists(k_rows, n, keys), pa.array(firm_bits), pa.array(people_bits), pa.array(names_bits), pa.array(need),
                ],
                names=[f.split()[0] for f in PROFILE.split(", ")],
            )

    return run


def profiles(df: DataFrame, side: int) -> DataFrame:
    """Profiles of rows (id, titles array<string>, trusts array<double>, dates, people, companies array<string>).

    Null arrays and elements count as absent; a row with nothing known has a profile that matches nothing.
    """

    return df.select("id", "titles", "trusts", "dates", "people", "companies").mapInArrow(_describer(side), PROFILE)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int16)


# Days beyond which two dates can't be one release, see `day_likeness`; the likeness up to so many days.
FAR = 800
BY_DAYS = ((31, 1.0), (200, 0.9), (420, 0.75), (FAR, 0.3))
# The greatest likeness of dates of which one tells only the year.
BY_YEAR = 0.85


ROW = ["side", "id", "day", "last", "firm_bits", "people_bits", "names", "need", "person", "low", "high", "place"]
# Pairs looked at in one go.
CHUNK = 1 << 20


def _bound(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """No less than the `with_confidence` of the pairs of rows i and j whatever their titles, by what their days, people
    (be they near in spelling) and companies can count at most."""
    first, last, firms, people, names, need = (rows[c] for c in ("day", "last", "firm_bits", "people_bits", "names", "need"))
    gap = np.maximum(first[i] - last[j], first[j] - last[i])  # not a number where a day is unknown
    day = np.select([gap <= most for most, _ in BY_DAYS] + [gap > FAR], [like for _, like in BY_DAYS] + [-1.0], BY_YEAR)
    nobody = (need[i] == NOBODY) | (need[j] == NOBODY)
    shared = ((people[i] & people[j]) != 0) | (people[i] == 0) | (people[j] == 0) | (_bits(names[i] & names[j]) >= np.maximum(need[i], need[j]))
    person = np.where(nobody, 0.5, np.where(shared, 1.0, -0.5))
    company = np.where((firms[i] == 0) | (firms[j] == 0), 0.5, np.where((firms[i] & firms[j]) != 0, 1.0, -0.5))
    return WEIGHTS["title"] + WEIGHTS["people"] * person + WEIGHTS["day"] * day + WEIGHTS["companies"] * company


def _likely(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, accept: float) -> np.ndarray:
    """Which of the pairs of rows i and j are worth scoring: their titles share most letter pairs and their days are not
    far apart, or the key's person is the same within two months and they may share a company, as the score asks of
    pairs with other titles; and they can be accepted for their days, people and companies."""
    day, firms, who, a, b = (rows[c] for c in ("day", "firm_bits", "person", "low", "high"))
    size = _bits(a) + _bits(b)
    gap = np.abs(day[i] - day[j])  # not a number where a day is unknown
    shared = _bits(a[i] & a[j]) + _bits(b[i] & b[j])
    alike = (shared >= 0.65 * np.maximum(np.minimum(size[i], size[j]), 1)) & ~(gap > FAR + 31)
    person = (who[i] != 0) & (who[i] == who[j]) & (gap <= 62) & ((firms[i] & firms[j]) != 0)
    found = np.flatnonzero(alike | person)
    return found[_bound(rows, i[found], j[found]) >= accept - 1e-9]


def _compare(rows: dict[str, np.ndarray], window: int, first: int, accept: float) -> Iterator[np.ndarray]:
    """(id, other) of the likely pairs across sides whose keys are at most `window` distinct keys apart and of which the
    later row has index `first` or more. `place` numbers the keys; rows of one key are all compared, however many."""
    side, key, place = rows["side"], rows["id"], rows["place"]
    for s in (0, 1):
        at = np.flatnonzero(side != s)
        later = np.flatnonzero(side == s)
        later = later[later >= first]
        low, high = np.searchsorted(place[at], place[later] - window), np.searchsorted(at, later)
        ends = np.cumsum(high - low)
        total = int(ends[-1]) if len(ends) else 0
        for start in range(0, total, CHUNK):
            pair = np.arange(start, min(total, start + CHUNK))
            k = np.searchsorted(ends, pair, "right")
            i, j = at[high[k] - (ends[k] - pair)], later[k]
            ok = _likely(rows, i, j, accept)
            if len(ok):
                l, r = (key[j], key[i]) if s == 0 else (key[i], key[j])
                yield np.unique(np.stack([l[ok], r[ok]], 1), axis=0)


def _windows(window: int, accept: float):
    """Pairs of a sorted partition, and the rows of its first and last keys for the windows that reach into other partitions."""
    kinds = {"day": float, "last": float, "side": np.int32}
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 5, *[pa.int64()] * 8]
    names = ["id", "other", "part", "place", "side", "day", "last", *ROW[4:-1], "key"]

    def edge(rows: dict[str, np.ndarray], chosen: np.ndarray, part: int) -> pa.RecordBatch:
        rows = {c: v[chosen] for c, v in rows.items()}
        n = len(rows["id"])
        days = (pa.array(np.nan_to_num(rows[c], nan=-1e6).astype(np.int32), mask=np.isnan(rows[c])) for c in ("day", "last"))
        columns = [
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(rows["place"].astype(np.int32)),
            pa.array(rows["side"].astype(np.int32)), *days, *(pa.array(rows[c]) for c in ROW[4:-1]), pa.array(rows["id"]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(kinds.get(c, np.int64)) for c in [*ROW[:-1], "mark"]}
            mark = rows["mark"]
            new = np.append(held is not None and held["mark"][-1] != mark[0], mark[1:] != mark[:-1])
            rows["place"] = np.cumsum(new) + (0 if held is None else held["place"][-1])
            first = 0 if held is None else len(held["id"])
            yield edge(rows, rows["place"] < window, part)
            if held is not None:
                rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
            for pairs in _compare(rows, window, first, accept):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *(pa.nulls(len(pairs), t) for t in types[2:])], names=names)
            recent = rows["place"] > rows["place"][-1] - window
            held = {c: v[recent] for c, v in rows.items()}
        if held is not None:
            yield edge(held, held["place"] >= window, part)  # those before are out already

    schema = "id bigint, other bigint, part int, place int, side int, day int, last int, firm_bits bigint, people_bits bigint, names bigint, need bigint, person bigint, low bigint, high bigint, `key` bigint"
    return run, schema


def _across(window: int, accept: float):
    """Pairs over one border: `place` counts the keys from it, negative before."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", kind="stable")
        rows = {c: pdf["key" if c == "id" else c].to_numpy(float if c in ("day", "last") else None) for c in ROW}
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *_compare(rows, window, int((pdf["place"] < 0).sum()), accept)])
        return pd.DataFrame({"id": pairs[:, 0], "other": pairs[:, 1]})

    return run


def _borders(sizes: dict[int, int], window: int) -> list[tuple[int, int, int]]:
    """(part, border, shift) from the number of keys of each partition: the borders within `window` keys of a partition,
    with what makes its places count from there. A window may span several partitions of few keys."""
    parts = sorted(sizes)
    start = dict(zip(parts, np.cumsum([0, *(sizes[p] for p in parts)]).tolist()))
    found = []
    for k, b in enumerate(parts[1:], 1):
        near = [p for p in parts[k:] if start[p] < start[b] + window]
        for p in reversed(parts[:k]):
            if start[p] + sizes[p] <= start[b] - window:
                break
            near.append(p)
        found += [(p, b, start[p] - start[b]) for p in near]
    return found


def candidate_rows(described: DataFrame, window: int = WINDOW, accept: float = ACCEPT) -> DataFrame:
    """The likely pairs within each partition of all keys in order, and the rows of its first and last keys.

    One range sort of all keys; a window slides over each sorted partition as it streams by.
    """
    spark = described.sparkSession
    rows = described.select("side", "id", "day", "last", "firm_bits", "people_bits", "names", "need", F.inline("keys"))
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), described.count() // PART))
    rows = rows.repartitionByRange(parts, "sort").sortWithinPartitions("sort").select(*ROW[:-1], F.xxhash64("sort").alias("mark"))
    return rows.mapInArrow(*_windows(window, accept))


def sorted_neighbourhood(spark: SparkSession, found: DataFrame, window: int = WINDOW, accept: float = ACCEPT) -> DataFrame:
    """(id, other): pairs of a profile of side 0 and one of side 1 whose keys are within `window` distinct keys of each
    other under some sort key and are likely enough to be scored (see `_likely`).

    found: stored `candidate_rows` of the same window and least confidence. Windows over a border of partitions are made up from the last and first keys on
    either side. All rows of a key stand at one place, so no number of rows of one key pushes others out; pairs grow
    with the rows of either side under near keys.
    """
    inside = found.filter("part is null").select("id", "other")
    edges = found.filter("part is not null").drop("id", "other")
    sizes = {r["part"]: r["n"] + 1 for r in edges.groupBy("part").agg(F.max("place").alias("n")).collect()}
    borders = spark.createDataFrame(_borders(sizes, window), "part int, border int, shift int")
    edges = edges.join(F.broadcast(borders), "part").withColumn("place", F.col("place") + F.col("shift")).filter(F.col("place").between(-window, window - 1))
    across = edges.drop("part", "shift").groupBy("border").applyInPandas(_across(window, accept), "id bigint, other bigint")
    return inside.union(across).distinct()


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def title_likeness(a: str, b: str) -> Column:
    """The best likeness of two profiles' titles: equal ones 1, each edit less; a title cut off 0.8, or 0.7 if the whole
    one has a sequel mark; other sequel marks 0; times the lesser trust."""

    def pair(x: Column, y: Column) -> Column:
        s, t = x["t"], y["t"]
        ls, lt = F.length(s), F.length(t)
        first = ls <= lt
        short, long = F.when(first, s).otherwise(t), F.when(first, t).otherwise(s)
        own, whole = F.when(first, x["q"]).otherwise(y["q"]), F.when(first, y["q"]).otherwise(x["q"])
        n, m = F.least(ls, lt), F.greatest(ls, lt)
        like = _with(1.0 - 2.0 * F.levenshtein(s, t) / m, lambda v: F.when(v >= 0.6, v).otherwise(0.0))
        near = F.when((x["q"] == y["q"]) & (m - n <= 4), like).otherwise(0.0)
        begins = (n >= 9) & (own == "") & (F.levenshtein(F.substring(long, F.lit(1), n), short, 1) >= 0)
        cut_off = F.when(begins, F.when(whole != "", 0.7).otherwise(0.8)).otherwise(0.0)
        value = F.when(s == t, F.when(x["q"] == y["q"], 1.0).otherwise(0.0)).otherwise(F.greatest(near, cut_off))
        return value * F.least(x["w"], y["w"])

    zipped = lambda p: F.arrays_zip(F.col(f"{p}.titles").alias("t"), F.col(f"{p}.sequels").alias("q"), F.col(f"{p}.trusts").alias("w"))
    best = F.array_max(F.flatten(F.transform(zipped(a), lambda x: F.transform(zipped(b), lambda y: pair(x, y)))))
    return F.coalesce(best, F.lit(0.0))


def people_likeness(a: str, b: str) -> Column:
    """1 for a shared person, 0.9 and 0.8 for spellings near each other, -0.5 for different people, null if unknown."""
    x, y = F.col(f"{a}.people"), F.col(f"{b}.people")

    def near(p: Column, q: Column) -> Column:
        full = p.startswith("=") & q.startswith("=")
        short = ~p.startswith("=") & ~q.startswith("=") & (F.substring(p, 1, 1) == F.substring(q, 1, 1))
        return F.when(full & (F.levenshtein(p, q, 2) >= 0), 0.9).when(short & (F.levenshtein(p, q, 1) >= 0), 0.8).otherwise(-0.5)

    best = F.array_max(F.flatten(F.transform(x, lambda p: F.transform(y, lambda q: near(p, q)))))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.when(F.arrays_overlap(x, y), 1.0).otherwise(best))


def day_likeness(a: str, b: str) -> Column:
    """1 within a month down to -1 beyond FAR days; by years where a day is unknown; null if nothing is known."""
    gap = lambda x, y: F.array_min(F.flatten(F.transform(x, lambda p: F.transform(y, lambda q: F.abs(p - q)))))
    days = gap(F.col(f"{a}.days"), F.col(f"{b}.days"))
    years = lambda p: F.concat(F.col(f"{p}.years"), F.transform(F.col(f"{p}.days"), lambda d: (1970 + F.floor(d / 365)).cast("int")))
    off = gap(years(a), years(b))
    by_day = F.coalesce(*(F.when(days <= most, like) for most, like in BY_DAYS), F.lit(-1.0))
    by_year = F.when(off == 0, BY_YEAR).when(off == 1, 0.7).when(off == 2, 0.2).when(off.isNotNull(), -1.0)
    return F.when(days.isNotNull(), by_day).otherwise(by_year)


def with_confidence(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """`pairs` with the weighted likeness of the profiles in the struct columns `a` and `b`; the unknown counts half.

    Pairs with other titles are one work only by the same person, within a month, and with most companies shared.
    """
    firms_a, firms_b = F.col(f"{a}.companies"), F.col(f"{b}.companies")
    scored = pairs.withColumns(
        {
            "title": title_likeness(a, b),
            "person": people_likeness(a, b),
            "when": day_likeness(a, b),
            "firms": F.when((F.size(firms_a) > 0) & (F.size(firms_b) > 0), F.size(F.array_intersect(firms_a, firms_b))),
        }
    )
    n = F.col("firms")
    company = F.when(n > 0, F.least(F.lit(1.0), 0.6 + 0.1 * n)).when(n == 0, -0.5)
    parts = {"title": F.col("title"), "people": F.col("person"), "day": F.col("when"), "companies": company}
    total = sum((F.lit(w) * F.coalesce(parts[k], F.lit(0.5)) for k, w in WEIGHTS.items()), F.lit(0.0))
    namesake = F.arrays_overlap(F.col(f"{a}.titles"), F.col(f"{b}.titles"))
    alias = (F.col("person") == 1) & (F.col("when") == 1) & (n >= F.greatest(F.lit(2.0), 0.5 * F.least(F.size(firms_a), F.size(firms_b)))) & ~namesake
    confidence = F.when(F.col("title") >= 0.5, total).when(alias, 0.62).otherwise(0.0)
    return scored.withColumn("confidence", confidence).drop("title", "person", "when", "firms")


def assign(left: list, right: list, confidence: list[float]) -> list[int]:
    """The edges of the assignment with the greatest total confidence, where staying alone counts 0.

    Shortest augmenting paths with potentials, exact; a row of the matrix for each left, a column for each right and one
    for each left to stay alone.
    """
    rows, columns = {x: i for i, x in enumerate(dict.fromkeys(left))}, {y: j for j, y in enumerate(dict.fromkeys(right))}
    n, m = len(rows), len(columns)
    cost = np.full((n, m + n), 1.0)
    cost[:, m:] = 0.0
    at: dict[tuple[int, int], int] = {}
    for e, (x, y, c) in enumerate(zip(left, right, confidence)):
        i, j = rows[x], columns[y]
        if -c < cost[i, j]:
            cost[i, j], at[i, j] = -c, e
    u, v, owner = np.zeros(n + 1), np.zeros(m + n + 1), np.full(m + n + 1, n)
    for i in range(n):
        owner[-1], j = i, m + n
        gap, way, used = np.full(m + n, np.inf), np.full(m + n, -1), np.zeros(m + n + 1, bool)
        while owner[j] != n:
            used[j] = True
            k = owner[j]
            free = ~used[:-1]
            now = cost[k] - u[k] - v[:-1]
            better = free & (now < gap)
            gap[better], way[better] = now[better], j
            to = int(np.where(free, gap, np.inf).argmin())
            by = gap[to]
            u[owner[used]] += by
            v[used] -= by
            gap[free] -= by
            j = to
        while j != m + n:
            owner[j], j = owner[way[j]], way[j]
        owner[-1] = n
    return [at[int(owner[j]), j] for j in range(m) if owner[j] < n and (int(owner[j]), j) in at]


ASSIGNED = ["label", "left", "right", "confidence"]


def _assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The assignment of each component of edges sorted by label; one that a batch cuts off waits for the next."""
    held = None
    for pdf in batches:
        if held is not None and len(held):
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        done = int(pdf["label"].searchsorted(pdf["label"].iloc[-1]))
        held = pdf.iloc[done:]
        yield _each_assigned(pdf.iloc[:done])
    if held is not None:
        yield _each_assigned(held)


def _each_assigned(pdf: pd.DataFrame) -> pd.DataFrame:
    label, left, right, confidence = (pdf[c].tolist() for c in ASSIGNED)
    ends = [i for i in range(1, len(label)) if label[i] != label[i - 1]] + [len(label)] * bool(label)
    kept, start = [], 0
    for end in ends:
        kept += [start + e for e in assign(left[start:end], right[start:end], confidence[start:end])]
        start = end
    return pdf.iloc[kept][["left", "right", "confidence"]]


def auction(scratch: Scratch, contested: DataFrame, step: float) -> DataFrame:
    """The assignment with the greatest total confidence, up to `step` for each pair, for components too large for a task.

    In each round every unassigned left that still gains bids for its best right, raising the price by its advantage
    over its next best choice (or over staying alone) plus `step`; the highest bid takes the right and frees its former
    holder. Rounds go on until nobody bids, which comes as prices only rise.
    """
    held = contested.select("right", F.lit(0.0).alias("price"), F.lit(None).cast(contested.schema["left"].dataType).alias("left")).filter("false")
    while True:
        gain = contested.join(held.select("left"), "left", "left_anti").join(held.select("right", "price"), "right", "left")
        gain = gain.withColumn("net", F.col("confidence") - F.coalesce("price", F.lit(0.0))).filter("net > 0")
        top = gain.groupBy("left").agg(F.max_by(F.struct("right", "confidence"), F.struct("net", "right")).alias("t"), F.max("net").alias("first"), F.count("*").alias("n"))
        second = gain.join(top.select("left", F.col("t.right").alias("_r")), "left").filter("right <> _r").groupBy("left").agg(F.max("net").alias("second"))
        bids = top.join(second, "left", "left").select("t.right", "left", (F.col("t.confidence") - F.coalesce("second", F.lit(0.0)) + step).alias("bid"))
        won, n = scratch.counted(bids.groupBy("right").agg(F.max("bid").alias("price"), F.max_by("left", F.struct("bid", "left")).alias("left")))
        if not n:
            return contested.join(held.select("left", "right"), ["left", "right"]).select("left", "right", "confidence")
        held = scratch.table(held.join(won, "right", "left_anti").union(won.select("right", "price", "left")))


def one_to_one(scratch: Scratch, edges: DataFrame, step: float = 0.0005, largest: int = 100_000) -> DataFrame:
    """The assignment of `left` to `right` with the greatest total `confidence`.

    edges: (left, right, confidence > 0), each pair once. Pairs that are each other's only choice are taken; the other
    edges fall into components, each of which a task solves exactly (`assign`). Components of over `largest` lefts times
    rights are settled by auction over all tasks, up to `step` for each pair. An empty table gives no rows.
    """
    lone_l, lone_r = edges.groupBy("left").agg(F.count("*").alias("nl")), edges.groupBy("right").agg(F.count("*").alias("nr"))
    marked = scratch.table(edges.select("left", "right", "confidence").join(lone_l, "left").join(lone_r, "right"))
    sure = marked.filter("nl = 1 and nr = 1").select("left", "right", "confidence")
    node = lambda side, c: F.struct(F.lit(side).alias("side"), F.col(c).alias("id"))
    contested = marked.filter("nl > 1 or nr > 1").select("left", "right", "confidence", node(0, "left").alias("a"), node(1, "right").alias("b"))
    labels = components(scratch, contested.select("a", "b"))
    labelled = scratch.table(contested.join(labels.select(F.col("node").alias("a"), F.col("label.id").alias("label")), "a").select(*ASSIGNED))
    size = labelled.groupBy("label").agg(F.count_distinct("left").alias("l"), F.count_distinct("right").alias("r"))
    giant, n = scratch.counted(size.filter(F.col("l") * F.col("r") > largest).select("label"))
    kind = f"left {edges.schema['left'].dataType.simpleString()}, right {edges.schema['right'].dataType.simpleString()}, confidence double"
    small = labelled.join(giant, "label", "left_anti") if n else labelled
    solved = small.repartition("label").sortWithinPartitions("label", "left", "right").mapInPandas(_assigned, kind)
    if n:
        solved = solved.union(auction(scratch, scratch.table(labelled.join(giant, "label").select("left", "right", "confidence")), step))
    return sure.union(solved)


def match_entities(spark: SparkSession, left: DataFrame, right: DataFrame, accept: float = ACCEPT, window: int = WINDOW) -> DataFrame:
    """(id, other, confidence): each row of `left` with the row of `right` that is the same thing, if there is one.

    Inputs as for `profiles`. Candidate pairs come from a sorted neighbourhood over several composite keys and are
    scored by weighted field similarities. Rows of `left` that share a candidate and are one work among themselves (by
    the same score) form groups; groups and rows of `right` are assigned one to one with the greatest total confidence.
    Rows of one id count as one, by the best of their profiles; a null id is dropped.
    """
    s = Scratch(spark)
    both = profiles(left.filter("id is not null"), 0).union(profiles(right.filter("id is not null"), 1))
    described = s.table(both)
    found = s.table(candidate_rows(described, window, accept))
    pairs = s.table(sorted_neighbourhood(s.spark, found, window, accept))
    s.drop(found)
    a = described.filter("side = 0").select("id", F.struct(*FIELDS).alias("f"))
    b = described.filter("side = 1").select(F.col("id").alias("other"), F.struct(*FIELDS).alias("e"))
    scored = with_confidence(pairs.join(a, "id").join(b, "other"), "f", "e").select("id", "other", "confidence")
    # one row a pair, also where an id occurs twice; a filter before the sum would work out every part of the score again
    scored = s.table(scored.groupBy("id", "other").agg(F.max("confidence").alias("confidence")).filter(F.col("confidence") >= accept))
    s.drop(pairs)

    # works: each row with the best row of a shared candidate, if the two are one; groups by the least id
    lead = scored.groupBy("other").agg(F.max_by("id", F.struct("confidence", -F.col("id"))).alias("lead"))
    twins = scored.join(lead, "other").filter("id <> lead").select("id", "lead").distinct()
    twins = with_confidence(twins.join(a, "id").join(a.select(F.col("id").alias("lead"), F.col("f").alias("e")), "lead"), "f", "e")
    twins = twins.groupBy("id", "lead").agg(F.max("confidence").alias("confidence")).filter(F.col("confidence") >= accept)
    twins = s.table(twins.select(F.col("id").alias("a"), F.col("lead").alias("b")))
    s.drop(described)
    labels = components(s, twins).select(F.col("node").alias("id"), F.col("label").alias("work"))
    own = s.table(scored.join(labels, "id", "left").withColumn("work", F.coalesce("work", "id")))
    edges = own.groupBy("work", "other").agg(F.max("confidence").alias("confidence"))
    chosen = one_to_one(s, edges.select(F.col("work").alias("left"), F.col("other").alias("right"), "confidence"))
    chosen = chosen.select(F.col("left").alias("work"), F.col("right").alias("other"), F.col("confidence").alias("of_work"))
    # every row of a work has its entry, also those that were not compared with it themselves
    out = own.select("id", "work").distinct().join(chosen, "work").join(own.select("id", "other", "confidence"), ["id", "other"], "left")
    return s.result(out.select("id", "other", F.coalesce("confidence", "of_work").alias("confidence")))
