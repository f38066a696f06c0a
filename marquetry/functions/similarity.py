"""Indel similarity of texts, as Arrow-batched functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def indel_ratio(a: str, b: str) -> float:
    """100 x twice the longest common subsequence over the sum of lengths; two empty texts are 100. Bit-parallel."""
    if not a and not b:
        return 100.0
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 100.0 * 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def token_sort(text: str) -> str:
    return " ".join(sorted(text.split()))


class Texts:
    """Many texts that one text at a time is compared with: `indel_ratio`, bit-parallel over all, and a bound of it."""

    BINS, BITS = 32, 62

    def __init__(self, texts: list[str]):
        self.length = np.array([len(x) for x in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(texts)), self.length)
        column = np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        letters, code = np.unique(points, return_inverse=True)
        self.code = {chr(c): i for i, c in enumerate(letters.tolist())}
        # one row a place, the code after the last beyond the end
        self.at = np.full((int(self.length.max(initial=0)), len(texts)), len(letters), np.int32)
        self.at[column, row] = code
        self.counts = np.bincount(points % self.BINS * len(texts) + row, minlength=self.BINS * len(texts)).reshape(self.BINS, len(texts)).astype(np.int32)

    def _ratio(self, common: np.ndarray, n: int, length: np.ndarray) -> np.ndarray:
        total = length + n
        return np.where(total > 0, 100.0 * 2 * common / np.maximum(total, 1), 100.0)

    def bound(self, text: str) -> np.ndarray:
        """No less than `indel_ratio` of the text and each of the texts: by the letters they have in common in any order.
        0 where one of the two is empty and the other not."""
        own = np.bincount(np.array([ord(c) % self.BINS for c in text], np.int64), minlength=self.BINS)
        common = np.zeros(len(self.length), np.int32)
        for b in np.flatnonzero(own):
            common += np.minimum(self.counts[b], np.int32(own[b]))
        return self._ratio(common, len(text), self.length)

    def ratio(self, text: str, which: np.ndarray) -> np.ndarray:
        """`indel_ratio` of the text and those of the texts."""
        length = self.length[which]
        at = self.at[: int(length.max(initial=0)), which]
        limbs = range(0, len(text), self.BITS)
        masks, rows, full = [], [], []
        for start in limbs:
            part = text[start : start + self.BITS]
            mask = np.zeros(len(self.code) + 1, np.int64)
            for i, c in enumerate(part):
                if c in self.code:
                    mask[self.code[c]] |= 1 << i
            masks.append(mask)
            full.append((1 << len(part)) - 1)
            rows.append(np.full(len(which), full[-1], np.int64))
        for codes in at:
            carry = 0
            for k, mask in enumerate(masks):
                hit = rows[k] & mask[codes]
                total = rows[k] + hit + carry
                if k + 1 < len(masks):
                    carry = total >> self.BITS
                rows[k] = (total & full[k]) | (rows[k] ^ hit)
        common = len(text) - sum((np.bitwise_count(r).astype(np.int64) for r in rows), np.zeros(len(which), np.int64))
        return self._ratio(common, len(text), length)


class Masks:
    """Many texts, the queries, as bit masks by letter: how many letters in order (`indel_ratio`'s longest common
    subsequence) other texts have in common with them, for all pairs of two sets or pair by pair.
    """

    BITS, PAIRS = 62, 8192

    def __init__(self, texts: list[str]):
        self.length = np.array([len(x) for x in texts], np.int64)
        self.letters = np.array(sorted(map(ord, set().union(*texts))), np.uint32)
        codes = self.codes(texts)
        # by limb, letter and text; the last letter is any that no query has
        self.masks = np.zeros((max(1, -(-codes.shape[1] // self.BITS)), len(self.letters) + 1, len(texts)), np.int64)
        for i, letters in enumerate(codes.T):
            self.masks[i // self.BITS, letters, np.arange(len(texts))] |= 1 << i % self.BITS
        self.masks[:, -1] = 0

    def codes(self, texts: list[str]) -> np.ndarray:
        """A row of letters of the queries for each text, filled up with the letter that no query has."""
        length = np.array([len(x) for x in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(code, len(self.letters) - 1)] == points if len(self.letters) else np.zeros(len(points), bool)
        out = np.full((len(texts), int(length.max(initial=0))), len(self.letters), np.int32)
        out[np.arange(out.shape[1]) < length[:, None]] = np.where(known, code, len(self.letters))
        return out

    def _step(self, rows: list[np.ndarray], masks: list[np.ndarray]) -> None:
        """One more letter for all; rows and masks by limb."""
        carry = None
        for k, (row, mask) in enumerate(zip(rows, masks)):
            np.bitwise_and(row, mask, out=mask)
            total = row + mask
            np.bitwise_xor(row, mask, out=row)
            if carry is not None:
                total += carry
            if k + 1 < len(rows):
                carry = total >> self.BITS
                total &= (1 << self.BITS) - 1
            row |= total

    def _common(self, rows: list[np.ndarray]) -> np.ndarray:
        return sum(self.BITS - np.bitwise_count(r & ((1 << self.BITS) - 1)).astype(np.int32) for r in rows)

    def all_common(self, codes: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Letters in common of each text (rows of `codes`) and each of the queries `which`."""
        out = np.empty((len(codes), len(which)), np.int32)
        for a in range(0, len(which), self.PAIRS // 4):
            masks = [m[:, which[a : a + self.PAIRS // 4]] for m in self.masks]
            n = masks[0].shape[1]
            take = max(1, self.PAIRS // max(n, 1))
            for b in range(0, len(codes), take):
                part = codes[b : b + take]
                rows = [np.full((len(part), n), (1 << self.BITS) - 1, np.int64) for _ in masks]
                for letters in part.T:
                    self._step(rows, [np.take(m, letters, axis=0) for m in masks])
                out[b : b + take, a : a + n] = self._common(rows)
        return out

    def pair_common(self, codes: np.ndarray, row: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Letters in common of the texts `row` of `codes` and the queries `query`, pair by pair."""
        out = np.empty(len(row), np.int32)
        long = self.length[query] > self.BITS
        for which, limbs in ((np.flatnonzero(~long), 1), (np.flatnonzero(long), len(self.masks))):
            flat = [m.ravel() for m in self.masks[:limbs]]
            for a in range(0, len(which), self.PAIRS):
                at = which[a : a + self.PAIRS]
                rows = [np.full(len(at), (1 << self.BITS) - 1, np.int64) for _ in flat]
                places = np.ascontiguousarray(codes[row[at]].T).astype(np.int64)
                places *= len(self.length)
                places += query[at]
                for p in places:
                    self._step(rows, [m[p] for m in flat])
                out[at] = self._common(rows)
        return out


class Letters:
    """Counts of letters of many texts, by a fixed number of bins."""

    BINS = 32

    def __init__(self, texts: list[str]):
        self.length = np.array([len(x) for x in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(texts)), self.length)
        self.counts = np.bincount(row * self.BINS + points % self.BINS, minlength=self.BINS * len(texts)).reshape(len(texts), self.BINS)

    def levels(self) -> list[tuple[int, int]]:
        """Each bin with each count of it that a text reaches."""
        return [(b, n + 1) for b, most in enumerate(self.counts.max(0, initial=0)) for n in range(most)]

    def reached(self, levels: list[tuple[int, int]]) -> np.ndarray:
        """1 where a text reaches the level: the product of two texts' rows is no less than the letters that they have in
        common in any order, if one of them is among those that `levels` is of."""
        bins, counts = np.array(levels, np.int64).reshape(-1, 2).T
        return (self.counts[:, bins] >= counts).astype(np.float32)



@F.pandas_udf(T.DoubleType())
def indel(a: pd.Series, b: pd.Series) -> pd.Series:
    """`indel_ratio` of two columns; null counts as ''."""
    return pd.Series([indel_ratio(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def token_sort_indel(a: pd.Series, b: pd.Series) -> pd.Series:
    """`indel_ratio` of the texts with their words sorted; null counts as ''."""
    return pd.Series([indel_ratio(token_sort(x or ""), token_sort(y or "")) for x, y in zip(a, b)], dtype="float64")
