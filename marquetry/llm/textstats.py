"""Length, vocabulary, syntax and cohesion of texts, computed on the code points of a whole batch at once."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

BUCKETS = 1 << 16
# Code points looked at in one go, so long texts take no more memory than many short ones.
CHUNK = 1 << 18
# Frequent short words of English, French and Spanish that tie a sentence together.
FUNCTION_WORDS = (
    "the a an and or but of to in on at by for with from as is are was were be been it its he she they we you i his her their our my this that these those not no so if "
    "le la les un une des et ou mais de du au aux en dans sur par pour avec est sont il elle ils elles on nous vous je son sa ses ce cette ces ne pas que qui "
    "el los las uno una y o pero del al es son por para con sin se su sus este esta no lo mi tu".split()
)
SUBORDINATORS = (
    "which whose whom that although though because while whereas whereby wherein insofar unless since thereby thus hence therefore nevertheless however moreover "
    "dont lequel laquelle lorsque puisque quoique bien tandis ainsi cependant néanmoins toutefois "
    "cuyo cuya cual cuales aunque mientras porque puesto cuando mediante asimismo obstante".split()
)
CONNECTIVES = "and but then so because now next first soon mais puis alors car et pero entonces luego porque y".split()
# Endings of abstract nouns, each with or without a plural s.
NOMINAL = "tion sion ity ism ness ance ence ment ology isation ization ción sión idad ismo encia ancia ité isme logie logía".split()
VOWELS = "aeiouyáéíóúàâäèêëîïôöùûüœæ"
MARKUP = re.compile(r"<[^<>]{1,200}>|&[a-z]{2,8};")
FEATURES = ["words", "sent_mean", "sent_sd", "sent_q10", "sent_q90", "sent_max", "clause_mean", "clause_sd", "clause_q90", "clause_max", "word_mean", "word_sd", "word_q90", "syl_mean", "syl_q90", "mono", "long7", "long10", "long13", "function", "variety", "hapax", "subord", "nominal", "comma", "semicolon", "bracket", "question", "exclaim", "quote", "slash", "digit", "capital", "connect", "overlap", "newword", "stops"]

LETTER, DIGIT, SPACE, VOWEL, UPPER, JOIN, STOP, BREAK, CLAUSE = (1 << k for k in range(9))
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _kind(c: str) -> int:
    low = c.lower()
    out = LETTER * (c.isalnum() and not c.isdecimal()) | DIGIT * c.isdecimal() | SPACE * c.isspace() | VOWEL * (low in VOWELS) | UPPER * c.isupper()
    return out | JOIN * (c in "'’-") | STOP * (c in ".!?…") | BREAK * (c == "\n") | CLAUSE * (c in ",;:—–()[]")


class _Tables:
    """Kinds and lower-case forms of the code points of the first plane, made once for a process."""

    kind: np.ndarray | None = None
    low: np.ndarray

    @classmethod
    def look(cls, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if cls.kind is None:
            chars = [chr(i) for i in range(1 << 16)]
            cls.low = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], np.uint32)
            cls.kind = np.array([_kind(c) for c in chars], np.int16)
        near = np.minimum(codes, 0xFFFF)
        kind, low = cls.kind[near], cls.low[near]
        far = codes > 0xFFFF
        if far.any():
            rare, at = np.unique(codes[far], return_inverse=True)
            kind[far], low[far] = np.array([_kind(chr(c)) for c in rare.tolist()], np.int16)[at], codes[far]
        return kind, low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.multiply.accumulate(np.full(n, base, np.uint64), out=out[1:])
    return out


def _hash(word: str) -> int:
    codes = _mixed(np.frombuffer(word.encode("utf-32-le"), np.uint32))
    with np.errstate(over="ignore"):
        return int((codes * _powers(len(word), BASE)[:-1]).sum(dtype=np.uint64))


def _table(words) -> np.ndarray:
    return np.array(sorted({_hash(w) for w in words}), np.uint64)


FUNCTION_TABLE, SUBORD_TABLE, CONNECT_TABLE = _table(FUNCTION_WORDS), _table(SUBORDINATORS), _table(CONNECTIVES)
ENDINGS = {k: _table(w for n in NOMINAL for w in (n, n + "s") if len(w) == k) for k in range(3, 9)}


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values if len(table) else np.zeros(len(values), bool)


@dataclass
class Segments:
    """Values in groups that lie one after the other; figures of each group, 0 for an empty one."""

    of: np.ndarray  # the group of each value, ascending
    n: int

    def __post_init__(self):
        self.size = np.bincount(self.of, minlength=self.n)
        self.start = np.cumsum(self.size) - self.size

    def sum(self, values) -> np.ndarray:
        return np.bincount(self.of, values, self.n)

    def mean(self, values) -> np.ndarray:
        return self.sum(values) / np.maximum(self.size, 1)

    def sd(self, values) -> np.ndarray:
        return np.sqrt(np.maximum(self.mean(np.square(values, dtype=float)) - self.mean(values) ** 2, 0.0))

    def quantiles(self, values: np.ndarray, *shares: float) -> list[np.ndarray]:
        """Linear quantiles; the last share 1 gives the greatest value."""
        ordered = values[np.lexsort((values, self.of))] if len(values) else np.zeros(1)
        out = []
        for p in shares:
            at = p * np.maximum(self.size - 1, 0)
            low = np.floor(at).astype(np.int64)
            a = np.minimum(self.start + low, len(ordered) - 1)
            b = np.minimum(self.start + np.minimum(low + 1, np.maximum(self.size - 1, 0)), len(ordered) - 1)
            out.append(np.where(self.size > 0, ordered[a] + (ordered[b] - ordered[a]) * (at - low), 0.0))
        return out


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(texts)
    length = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum(length + 1) - length - 1
    kind, low = _Tables.look(codes)
    has = lambda k: (kind & k) != 0
    before = lambda m: np.append(False, m[:-1])
    after = lambda m: np.append(m[1:], False)
    doc_of = lambda at: np.searchsorted(begin, at, "right") - 1

    letter = has(LETTER)
    inside = letter | (has(JOIN) & before(letter) & after(letter))
    first = np.flatnonzero(inside & ~before(inside))
    end = np.flatnonzero(inside & ~after(inside)) + 1
    size = end - first
    doc = doc_of(first)
    words = Segments(doc, n)
    count = np.maximum(words.size, 1)
    word = np.cumsum(inside & ~before(inside)) - 1
    vowel = has(VOWEL) & inside
    syllables = np.maximum(np.bincount(word[vowel & ~before(vowel)], minlength=len(first)), 1)

    # hashes of words and of their endings by running sums
    longest = int(size.max(initial=1))
    power, back = _powers(longest, BASE), _powers(longest, INVERSE)
    place = np.arange(len(codes)) - first[np.maximum(word, 0)] if len(first) else np.zeros(len(codes), np.int64)
    with np.errstate(over="ignore"):
        term = np.where(inside, _mixed(low) * power[np.where(inside, place, 0)], np.uint64(0))
        run = np.append(np.uint64(0), np.cumsum(term))
        hashed = run[end] - run[first]
        nominal = np.zeros(len(first), bool)
        for k, table in ENDINGS.items():
            long = np.flatnonzero((size > 5) & (size >= k))
            nominal[long] |= _among((run[end[long]] - run[end[long] - k]) * back[size[long] - k], table)
    function = _among(hashed, FUNCTION_TABLE)

    # sentences and clauses, those without words left out
    stop = has(STOP)
    ends = (stop & ~after(stop) & after(has(SPACE))) | has(BREAK)
    new = lambda marks: np.append(np.ones(min(1, len(first)), bool), np.diff(np.cumsum(marks)[first]) > 0)
    sentence, clause = np.cumsum(new(ends)) - 1, np.cumsum(new(ends | has(CLAUSE))) - 1
    spans, parts = np.bincount(sentence), np.bincount(clause)
    s_doc, c_doc = doc[np.append(0, np.cumsum(spans)[:-1])] if len(spans) else doc, doc[np.append(0, np.cumsum(parts)[:-1])] if len(parts) else doc
    sentences, clauses = Segments(s_doc, n), Segments(c_doc, n)
    per_sentence = np.maximum(sentences.size, 1)

    # content words shared with the sentence before
    content = np.flatnonzero(~function)
    order = content[np.lexsort((sentence[content], hashed[content]))]
    h, s = hashed[order], sentence[order]
    once = np.append(True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])) if len(h) else np.zeros(0, bool)
    h, s = h[once], s[once]
    kinds = np.bincount(s, minlength=len(spans))
    hit = np.flatnonzero((h[1:] == h[:-1]) & (s[1:] == s[:-1] + 1)) + 1
    shared = np.bincount(s[hit], minlength=len(spans))
    follows = np.flatnonzero(s_doc[1:] == s_doc[:-1]) + 1
    overlap = shared[follows] / np.maximum(1, np.minimum(kinds[follows], kinds[follows - 1]))
    overlaps = Segments(s_doc[follows], n).mean(overlap) if len(follows) else np.zeros(n)

    # distinct words of each text
    with np.errstate(over="ignore"):
        own = hashed ^ (_mixed(doc) * np.uint64(BASE))
    _, at, times = np.unique(own, return_index=True, return_counts=True)
    d_doc = doc[at]
    distinct = np.bincount(d_doc, minlength=n)
    hapax = np.bincount(d_doc[times == 1], minlength=n)
    pairs = np.unique(d_doc * BUCKETS + (hashed[at] >> np.uint64(48)).astype(np.int64))

    def marks(chars: str) -> np.ndarray:
        hit = codes == ord(chars[0])
        for c in chars[1:]:
            hit |= codes == ord(c)
        return np.bincount(doc_of(np.flatnonzero(hit)), minlength=n)

    some = words.size > 0
    share = lambda flags: words.mean(flags)
    s10, s90, s_max = sentences.quantiles(spans, 0.1, 0.9, 1.0)
    c90, c_max = clauses.quantiles(parts, 0.9, 1.0)
    columns = [
        np.log1p(words.size), sentences.mean(spans), sentences.sd(spans), s10, s90, s_max, clauses.mean(parts), clauses.sd(parts), c90, c_max,
        words.mean(size), words.sd(size), *words.quantiles(size, 0.9), words.mean(syllables), *words.quantiles(syllables, 0.9), share(syllables == 1),
        share(size >= 7), share(size >= 10), share(size >= 13),
        share(function), distinct / count**0.8, hapax / count, share(_among(hashed, SUBORD_TABLE)), share(nominal),
        marks(",") / per_sentence, marks(";:—") / per_sentence, marks("([") / per_sentence, marks("?") / per_sentence, marks("!") / per_sentence,
        marks('"“«') / per_sentence, marks("/|") / count, np.bincount(doc_of(np.flatnonzero(has(DIGIT))), minlength=n) / np.maximum(length, 1),
        share(has(UPPER)[first]), share(_among(hashed, CONNECT_TABLE)), overlaps, distinct / count, sentences.size / count,
    ]
    base = np.stack(columns, 1).astype(float)
    base[~some] = 0.0
    return base, pairs // BUCKETS, (pairs % BUCKETS).astype(np.int32)


def text_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by the names in FEATURES, one row a text; text and bucket of each distinct word). Whole texts; null
    counts as empty, and texts without words have zeros."""
    clean = [MARKUP.sub(" ", t) if t and ("<" in t or "&" in t) else t or "" for t in texts]
    base, owner, bucket, start = [], [], [], 0
    while start < len(clean):
        stop, total = start, 0
        while stop < len(clean) and (stop == start or total + len(clean[stop]) <= CHUNK):
            total += len(clean[stop])
            stop += 1
        b, o, w = _features(clean[start:stop])
        base.append(b)
        owner.append(o + start)
        bucket.append(w)
        start = stop
    if not base:
        return np.zeros((0, len(FEATURES))), np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(base), np.concatenate(owner), np.concatenate(bucket)
