"""Text and list expressions on entity records: names, sentences, prompts, display and comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquetry.functions.text import col, strip

# Name tokens that name nobody.
NOBODY = ["", "AND", "N/A"]


def name_tokens(c: Column | str, separators: str = r"[|,]") -> Column:
    """The pieces of a packed list of names, as written: a JSON list, or a text with separators. Null gives []."""
    t = strip(c)
    listed = F.when(t.startswith("["), F.from_json(t, "array<string>", {"allowSingleQuotes": "false"}))
    return F.coalesce(listed, F.split(t, separators), F.array().cast("array<string>"))


def actor_names(c: Column | str) -> Column:
    """Upper-case actor names of a packed list: a leading AND removed, nobody's names and single letters dropped."""
    cleaned = F.transform(name_tokens(c, r"\|"), lambda n: strip(F.regexp_replace(F.upper(strip(n)), r"^AND\s+", "")))
    return F.filter(cleaned, lambda n: ~n.isin(NOBODY) & (F.char_length(n) > 1))


def director_names(c: Column | str, separators: str = r"[|,]") -> Column:
    """Director names of a packed list, stripped, in their case; empty ones dropped."""
    return F.filter(F.transform(name_tokens(c, separators), strip), lambda n: n != "")


def differing_alternative(main: Column, alternative: Column) -> Column:
    """The alternative text, or null if it equals the main one but for white space (null counting as '')."""
    bare = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", "")
    return F.when(bare(main) != bare(alternative), alternative)


def first_sentence(c: Column | str, least: int = 20, most: int = 250) -> Column:
    """Up to the first sentence end before a capital, if that comes at place `least` or later; else the first `most`
    code points. Null stays null."""
    t = strip(c)
    stop = r"[.!?]\s+(?=[A-Z])"
    at = F.regexp_instr(t, F.lit(stop))  # 1-based, 0 for none
    return F.when(at > least, F.substring(t, F.lit(1), at)).otherwise(F.substring(t, 1, most))


def known_or(c: Column | str, otherwise: str = "unknown") -> Column:
    """The stripped text, or `otherwise` for null and blank."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(otherwise))


def prompt_text(title: Column, released: Column, director: Column, synopsis: Column, alternative: Column | None = None) -> Column:
    """The text a provider is asked about a film; a second synopsis is added if there is one."""
    lines = [
        F.concat(F.lit("Title: "), known_or(title)),
        F.concat(F.lit("Released: "), F.coalesce(F.date_format(released, "yyyy-MM-dd"), F.lit("unknown"))),
        F.concat(F.lit("Director: "), known_or(director)),
        F.concat(F.lit("Synopsis: "), known_or(synopsis)),
    ]
    if alternative is not None:
        other = F.nullif(strip(alternative), F.lit(""))
        lines.append(F.concat(F.lit("Second synopsis: "), other))
    return F.concat_ws("\n", *lines)


def variant_title(c: Column | str) -> Column:
    """Upper case without the first 'GC ' and with AND for &."""
    t = F.upper(col(c))
    at = F.instr(t, "GC ")
    t = F.when(at > 0, F.concat(F.substring(t, F.lit(1), at - 1), F.substring(t, at + 3, F.char_length(t)))).otherwise(t)
    return strip(F.replace(t, F.lit(" & "), F.lit(" AND ")))


def synopsis_prefix(c: Column | str, n: int = 80) -> Column:
    """The first n code points in upper case, '' for null."""
    return F.coalesce(strip(F.upper(F.substring(col(c), 1, n))), F.lit(""))


def base_title(c: Column | str) -> Column:
    """Upper-case title without a leading 3D mark."""
    return F.upper(strip(F.regexp_replace(col(c), r"^3D[\s-]+", "")))


def enum_value(c: Column | str) -> Column:
    """Lower case and stripped; null stays null."""
    return F.lower(strip(c))


def display_list(c: Column | str) -> Column:
    """Sorted values joined by ', '; '' for null."""
    return F.coalesce(F.array_join(F.array_sort(col(c)), ", "), F.lit(""))


def clock(seconds: Column) -> Column:
    """h:mm:ss of a number of seconds."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))


def sheet_name(c: Column | str) -> Column:
    """A spreadsheet-safe name: forbidden signs out, white space single, 31 code points at most."""
    return F.substring(strip(F.regexp_replace(F.regexp_replace(col(c), r"[:\\/?*\[\]]", ""), r"\s+", " ")), 1, 31)


def keyword_class(text: Column, classes: list[tuple[str, list[str]]], otherwise: str | None = None) -> Column:
    """The first class of which a keyword occurs in the text in any case, else `otherwise`."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(otherwise)
    for name, words in reversed(classes):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w.lower()))
        out = F.when(hit, name).otherwise(out)
    return out


def first_class(items: Column, classes: list[tuple[str, list[str]]], otherwise: str) -> Column:
    """The class of the first item that has one."""
    found = F.filter(F.transform(items, lambda i: keyword_class(i, classes)), lambda k: k.isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.lit(otherwise))


# lists


def list_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.array().cast("array<string>"))


def list_union(a: Column, b: Column) -> Column:
    """Sorted distinct values of both lists."""
    return F.array_sort(F.array_union(list_or_empty(a), list_or_empty(b)))


def append_unique(a: Column, b: Column) -> Column:
    """Values of a, then of b, each once, in order."""
    return F.array_union(list_or_empty(a), list_or_empty(b))


def prepend_missing(source: Column, main: Column, also: Column) -> Column:
    """`main` with the values of `source` before it that are in neither `main` nor `also`."""
    known = F.array_union(list_or_empty(main), list_or_empty(also))
    return F.concat(F.filter(list_or_empty(source), lambda x: ~F.array_contains(known, x)), list_or_empty(main))


def lower_set(c: Column | str) -> Column:
    return F.array_distinct(F.filter(F.transform(list_or_empty(c), lambda x: F.lower(strip(x))), lambda x: x.isNotNull() & (x != "")))


def jaccard(a: Column, b: Column, both_empty: float | None = 1.0) -> Column:
    """Shared over all distinct values; `both_empty` is the value for two empty sets (null for undefined)."""
    x, y = lower_set(a), lower_set(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(both_empty).cast("double")).otherwise(F.size(F.array_intersect(x, y)) / union)


def agrees(a: Column, b: Column) -> Column:
    """Equal but for case and outer white space; two nulls agree, one does not."""
    return F.lower(strip(a.cast("string"))).eqNullSafe(F.lower(strip(b.cast("string"))))


def pluck(c: Column | str, field: str) -> Column:
    """A field of every struct of a list."""
    return F.transform(col(c), lambda s: s[field])


def first_or(c: Column | str, otherwise: str = "unknown") -> Column:
    return F.coalesce(F.get(col(c), F.lit(0)), F.lit(otherwise))


def joined_or(c: Column | str, separator: str = "|", otherwise: str = "unknown") -> Column:
    return F.coalesce(F.nullif(F.array_join(col(c), separator), F.lit("")), F.lit(otherwise))
