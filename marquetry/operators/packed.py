"""Several values packed in one text: one row per value with its place (problem 5).

The kernel works on the bytes of an Arrow string array as a whole: quote parity, escape and delimiter masks over the
buffer give the cuts, the cuts give child offsets, and the children come out as one string array with parent indices.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Texts that stand for nobody, in plain form.
PLACEHOLDERS = ("", "and", "n/a", "na", "n.a.", "none", "null", "nan", "nil", "-", "--", "?", "tba", "tbc", "tbd", "unknown", "various", "various artists", "not available", "not applicable", "no cast", "undisclosed", "&")
# Separators that never occur inside a name; the first class found in a text rules it.
STRONG = "|;\t\n\r\v\f"
BULLETS = ("•", "·", "‣", "▪", "●", "、", "；", "¦")


def _byte_table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


SPACE, STRONG_BYTE, LETTER = _byte_table(" \t\n\r\v\f"), _byte_table(STRONG), np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _shift(a: np.ndarray, by: int, fill=0) -> np.ndarray:
    """Value `by` bytes further on (negative: before)."""
    out = np.full_like(a, fill)
    if abs(by) < len(a):
        out[: len(a) - by if by > 0 else None][-by if by < 0 else 0 :] = a[by:] if by > 0 else a[:by]
    return out


def _find(data: np.ndarray, text: str, fold: bool = False) -> np.ndarray:
    """Mask of the first byte of each occurrence of `text`."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data) if fold else data
    hit = np.ones(len(data), bool)
    for k, b in enumerate(text.encode()):
        hit &= (_shift(low, k) if k else low) == b
    return hit


def split_packed(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces of each text before cleaning, the index of each piece's text, and whether it stood in quotes.

    Manners of writing, decided for each text by its bytes outside quotes:
    bracketed list ([..] with either quote sign): commas between quoted items;
    any strong separator (bar, semicolon, tab, line end, bullet): all of these, commas belong to names;
    slash (but not that of N/A); otherwise comma, and the word 'and' or the sign & between the last two.
    A text whose double quotes don't pair up is read as having none.
    """
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    texts = pc.fill_null(texts, "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(n), lengths)
    at = np.arange(len(data))
    count = lambda mask: np.bincount(row[mask], minlength=n)

    # nearest non-space byte at or after, and at or before, each place; -1 or the length if there is none
    solid = ~SPACE[data]
    after = np.minimum.accumulate(np.where(solid, at, len(data))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(solid, at, -1))
    first = np.full(n, len(data))
    full = lengths > 0
    first[full] = after[starts[full]]
    last = np.full(n, -1)
    last[full] = before[starts[full] + lengths[full] - 1]
    some = full & (first < starts + lengths)
    listed = np.zeros(n, bool)
    listed[some] = (data[first[some]] == ord("[")) & (data[last[some]] == ord("]")) & (last[some] > first[some])

    # escapes: a byte after an odd run of backslashes
    slash = data == ord("\\")
    run_start = np.maximum.accumulate(np.where(~slash, at, -1))
    odd = slash & ((at - run_start) % 2 == 1)
    escaped = _shift(odd, -1, False)

    # quotes: in lists, either sign next to a bracket or comma; elsewhere the double quote
    double, single = (data == ord('"')) & ~escaped, (data == ord("'")) & ~escaped
    prev_at = np.maximum(_shift(before, -1, -1), -1)
    next_at = np.minimum(_shift(after, 1, len(data)), len(data))
    edge = np.append(data, 0)
    prev_byte, next_byte = edge[prev_at], edge[next_at % (len(data) + 1)]
    border = np.isin(prev_byte, np.frombuffer(b"[,", np.uint8)) | np.isin(next_byte, np.frombuffer(b",]", np.uint8))
    in_list = listed[row]
    quote = np.where(in_list, (double | single) & border, double)
    unpaired = count(quote) % 2 == 1
    quote &= ~unpaired[row]
    total = np.cumsum(quote)
    base = np.zeros(n, np.int64)
    base[full] = total[starts[full]] - quote[starts[full]]
    inside = ((total - base[row]) % 2 == 1) & ~quote
    free = ~inside & ~quote

    # separators: a mask for each class, the first class present in a text rules it
    strong = STRONG_BYTE[data] & free & ~in_list
    wide = np.zeros(len(data), np.int64)
    for sign in BULLETS:
        if (hit := _find(data, sign) & free & ~in_list).any():
            wide[hit] = len(sign.encode())
    before_one, before_two = _shift(data, -1), _shift(data, -2)
    same_row = lambda k: _shift(row, k, -1) == row
    low = data | 32
    not_available = (
        (_shift(low, -1) == ord("n"))
        & (_shift(low, 1) == ord("a"))
        & same_row(-1)
        & same_row(1)
        & ~(LETTER[before_two] & same_row(-2))
        & ~(LETTER[_shift(data, 2)] & same_row(2))
    )
    slashes = (data == ord("/")) & free & ~in_list & ~not_available
    commas = (data == ord(",")) & free
    joiner = np.zeros(len(data), np.int64)
    for word in (" & ", " and "):
        joiner[_find(data, word, fold=True) & free & ~in_list & same_row(len(word) - 1)] = len(word)
    has_strong = (count(strong) + count(wide > 0)) > 0
    has_slash = (count(slashes) > 0) & ~has_strong
    by_comma = ~has_strong & ~has_slash
    # one comma with one word on its first side and at most two on the other is a single name, family name first
    words = count(free & solid & (SPACE[before_one] | ~same_row(-1) | (before_one == ord(","))))
    first_comma = np.full(n, -1)
    first_comma[row[commas][::-1]] = at[commas][::-1]
    spaces = (SPACE[data] & _shift(solid, 1, False) & same_row(1)).astype(np.int64)
    running = np.cumsum(spaces)
    has_comma = first_comma >= 0
    head_words = np.full(n, 9)
    head_words[has_comma] = running[np.maximum(first_comma[has_comma] - 1, 0)] - running[np.minimum(first[has_comma], len(data) - 1)]
    lone = by_comma & ~listed & (count(commas) == 1) & (head_words == 0) & (words <= 2) & (count(joiner > 0) == 0) & (count(quote) == 0)

    width = np.zeros(len(data), np.int64)
    width[strong] = 1
    width = np.maximum(width, wide)
    width[slashes & has_slash[row]] = 1
    width[commas & (by_comma & ~lone)[row]] = 1
    joined = (joiner > 0) & by_comma[row] & ~in_list
    width[joined] = joiner[joined]
    width[in_list & ((at == first[row]) | (at == last[row]))] = 1

    # pieces: from each text's start and each cut's end to the next cut or the text's end
    cut = np.flatnonzero(width)
    piece_from = np.concatenate([starts[some], cut + width[cut]])
    piece_row = np.concatenate([np.flatnonzero(some), row[cut]])
    order = np.lexsort((piece_from, piece_row))
    piece_from, piece_row = piece_from[order], piece_row[order]
    stop = np.append(cut, len(data))
    piece_to = np.minimum(stop[np.searchsorted(cut, piece_from)], (starts + lengths)[piece_row])
    keep = piece_from < piece_to
    piece_from, piece_to, piece_row = piece_from[keep], piece_to[keep], piece_row[keep]
    piece_from, piece_to = after[piece_from], before[piece_to - 1] + 1
    keep = piece_from < piece_to
    piece_from, piece_to, piece_row = piece_from[keep], piece_to[keep], piece_row[keep]
    quoted = quote[piece_from] & quote[piece_to - 1] & (piece_to - piece_from >= 2)
    piece_from, piece_to = piece_from + quoted, piece_to - quoted

    size = piece_to - piece_from
    ends = np.cumsum(size)
    gather = np.arange(ends[-1] if len(ends) else 0) + np.repeat(piece_from - (ends - size), size)
    child = np.concatenate([[0], ends]).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(child), pa.py_buffer(np.ascontiguousarray(data[gather])))
    return pieces, piece_row, quoted


def _unescape(text: str) -> str:
    try:
        return json.loads('"' + text.replace("\\'", "'").replace('"', '\\"').replace('\\\\"', '\\"') + '"', strict=False)
    except ValueError:
        return text.replace("\\'", "'").replace('\\"', '"')


def clean_pieces(pieces: pa.Array, quoted: np.ndarray) -> pa.Array:
    """Pieces with escapes undone, white space squeezed and a leading 'AND ' removed; nobody's names are ''."""
    out = pieces.cast(pa.large_string())
    if pc.any(pc.match_substring(out, '""')).as_py():
        out = pc.if_else(pa.array(quoted), pc.replace_substring(out, '""', '"'), out)
    back = pc.and_(pc.match_substring(out, "\\"), pa.array(quoted))
    if pc.any(back).as_py():  # only the few pieces with an escape are looked at one by one
        out = pc.replace_with_mask(out, back, pa.array([_unescape(x) for x in out.filter(back).to_pylist()], pa.large_string()))
    out = pc.utf8_trim_whitespace(pc.replace_substring_regex(out, r"[\s\pZ\x1c-\x1f\x85]+", " "))
    out = pc.replace_substring_regex(out, r"^(?i:and) ", "")
    out = pc.if_else(pc.match_substring_regex(out, r"[\pL\pN]"), out, pa.scalar("", pa.large_string()))
    nobody = pc.is_in(pc.utf8_lower(out), pa.array(PLACEHOLDERS, pa.large_string()))
    return pc.if_else(nobody, pa.scalar("", pa.large_string()), out)


def unpack(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Values, parent indices and 1-based places among the values kept of each text."""
    pieces, parents, quoted = split_packed(texts)
    values = clean_pieces(pieces, quoted)
    here = pc.not_equal(values, "")
    values, parents = values.filter(here), parents[here.to_numpy(zero_copy_only=False)]
    new = np.append(True, parents[1:] != parents[:-1]) if len(parents) else np.zeros(0, bool)
    place = np.arange(len(parents)) - np.maximum.accumulate(np.where(new, np.arange(len(parents)), 0)) + 1
    return values.cast(pa.string()), parents, place


def unpack_rows(df: DataFrame, key: str, packed: str, value: str = "value") -> DataFrame:
    """One row per value of the text column `packed`: (key, pos, value); no shuffle, one pass.

    Null, empty and blank texts and texts of placeholders only give no row; repeated rows each give theirs; a null
    key stays null; other columns are not read. Long texts only make a batch larger.
    """
    schema = T.StructType(
        [T.StructField(key, df.schema[key].dataType), T.StructField("pos", T.IntegerType()), T.StructField(value, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, parents, place = unpack(batch.column(1))
            keys = batch.column(0).take(pa.array(parents))
            yield pa.RecordBatch.from_arrays([keys, pa.array(place.astype(np.int32)), values], names=schema.fieldNames())

    return df.select(key, packed).mapInArrow(run, schema)
