"""Keys by which words one edit apart meet, and the pairs that do; on whole columns of words, of any length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multipliers of the two rolling hashes, and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
# A mark holds the place left out (WHOLE for none), the letter left out, two flags, and a second hash.
PLACE_BITS, LETTER_BITS, CHECK_BITS = 19, 21, 21
WHOLE = (1 << PLACE_BITS) - 1
SHORT, SOFT = 1 << (PLACE_BITS + LETTER_BITS), 2 << (PLACE_BITS + LETTER_BITS)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Code points as well-mixed 64-bit numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def deletion_keys(words: list[str], spaces: np.ndarray, soft: np.ndarray | None = None, short: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, key, mark) of every word whole and with each letter left out. `soft` and words of at most `short`
    letters are flagged in the mark.

    Two different words are one edit apart (a letter more, less or other, or two neighbours swapped) if and only if they
    have a key in common under marks that `met` accepts. `spaces`: a number by word; only words of one space meet.
    """
    length = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    n, ends = len(codes), np.cumsum(length)
    start = ends - length
    word = np.repeat(np.arange(len(words)), length)
    at = np.arange(n) - start[word]
    value = _mixed(codes)
    whole, without = [], []
    with np.errstate(over="ignore"):
        for base, inverse in zip(BASES, INVERSES):
            power = np.ones(int(length.max(initial=0)) + 1, np.uint64)
            np.multiply.accumulate(np.full(len(power) - 1, base, np.uint64), out=power[1:])
            term = value * power[at]
            running = np.append(np.uint64(0), np.cumsum(term))
            total = running[ends] - running[start]
            before = running[:-1] - running[start][word]
            whole.append(total)
            without.append(before + (total[word] - before - term) * np.uint64(inverse))
    keys = np.concatenate([whole[0], without[0]]) ^ spaces.astype(np.uint64)[np.concatenate([np.arange(len(words)), word])]
    check = np.concatenate([whole[1], without[1]]) >> np.uint64(64 - CHECK_BITS)
    index = np.concatenate([np.arange(len(words)), word])
    place = np.concatenate([np.full(len(words), WHOLE), at % WHOLE])
    letter = np.concatenate([np.zeros(len(words), np.int64), codes.astype(np.int64)])
    flags = np.where(length <= short, SHORT, 0) | (0 if soft is None else np.where(soft, SOFT, 0))
    mark = place | letter << PLACE_BITS | flags[index]
    return index, keys.view(np.int64), mark | check.astype(np.int64) << (PLACE_BITS + LETTER_BITS + 2)


def met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words with these marks under one key are different and one edit apart."""
    check = PLACE_BITS + LETTER_BITS + 2
    i, j = a & WHOLE, b & WHOLE
    letter = lambda m: (m >> PLACE_BITS) & ((1 << LETTER_BITS) - 1)
    other = (i == j) & (i != WHOLE) & (letter(a) != letter(b))
    swapped = (np.abs(i - j) == 1) & (i != WHOLE) & (j != WHOLE) & (letter(a) == letter(b))
    return ((a >> check) == (b >> check)) & (other | swapped | ((i == WHOLE) != (j == WHOLE)))


PAIRS = "m bigint, n bigint, strict boolean, soft boolean"


def close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(m, n, strict, soft) from rows (node, key, mark) sorted by key: nodes m < n one edit apart; strict if a word of
    either is short, soft if one is flagged so.

    A key's rows are words that share all but one letter, so few; those at a batch's end wait for the next one.
    """
    held = [np.zeros(0, np.int64)] * 3

    def pairs(node: np.ndarray, key: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
        found, far = [], np.flatnonzero(key[1:] == key[:-1])
        step = 1
        while len(far):
            ok = met(mark[far], mark[far + step]) & (node[far] != node[far + step])
            x, y = node[far[ok]], node[far[ok] + step]
            flags = mark[far[ok]] | mark[far[ok] + step]
            found.append(np.stack([np.minimum(x, y), np.maximum(x, y), (flags & SHORT) != 0, (flags & SOFT) != 0]))
            step += 1
            far = far[far + step < len(key)]
            far = far[key[far] == key[far + step]]
        m, n, *flags = np.unique(np.concatenate(found, 1), axis=1) if found else np.zeros((4, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(m), pa.array(n), *(pa.array(f.astype(bool)) for f in flags)], names=["m", "n", "strict", "soft"])

    for batch in batches:
        rows = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, ("node", "key", "mark"))]
        if not len(rows[1]):
            continue
        done = int(np.searchsorted(rows[1], rows[1][-1]))
        held = [r[done:] for r in rows]
        if done:
            yield pairs(*(r[:done] for r in rows))
    yield pairs(*held)
