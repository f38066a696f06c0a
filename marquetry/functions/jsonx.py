"""Model output as JSON: strict and salvaging extraction, failure classes, list columns, flattening of task results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquetry.functions.text import col, strip


def fenced_body(c: Column | str) -> Column:
    """The text inside the first code fence if the text starts with one and it is closed, else the stripped text."""
    t = strip(c)
    parts = F.split(t, "```")
    inner = F.regexp_replace(F.regexp_replace(F.get(parts, F.lit(1)), r"^\s+", ""), r"(?i)^json[\n\r ]*", "")
    return F.when(t.startswith("```") & (F.size(parts) >= 3), strip(inner)).otherwise(t)


def json_object_text(c: Column | str) -> Column:
    """From the first opening to the last closing brace, or null."""
    return F.nullif(F.regexp_extract(fenced_body(c), r"(?s)\{.*\}", 0), F.lit(""))


def strict_json(c: Column | str) -> Column:
    """The JSON object of a model's answer as text, null if there is none or it does not parse."""
    found = json_object_text(c)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def salvaged_json(c: Column | str) -> Column:
    """As `strict_json`, but trailing commas are mended first if need be; an empty object counts as failure."""
    found = json_object_text(c)
    mended = F.regexp_replace(found, r",(\s*[}\]])", "$1")
    good = F.coalesce(F.when(F.try_parse_json(found).isNotNull(), found), F.when(F.try_parse_json(mended).isNotNull(), mended))
    return F.when(F.size(F.json_object_keys(good)) > 0, good)


def failure_class(raw: Column, status: Column, reason: Column) -> Column:
    """Null if the answer can be used; else why not."""
    return F.when(salvaged_json(raw).isNull(), F.when(status == "incomplete", F.concat(F.lit("response_incomplete:"), F.coalesce(reason, F.lit("unknown")))).otherwise("json_parse_failed"))


def error_record(raw: Column, error: Column) -> Column:
    """What the ledger keeps of a failure: the message cut to 300, the raw text to 1000 code points."""
    return F.struct(F.substring(error, 1, 300).alias("_error"), F.substring(raw, 1, 1000).alias("_raw_output"))


def variant_list(c: Column | str) -> Column:
    """A list column that may hold JSON text: null and null words give [], a scalar a list of one, blanks are dropped.

    A text that is no JSON is a scalar."""
    t = strip(c)
    nothing = t.isNull() | F.lower(t).isin("", "nan", "none", "null")
    listed = F.when(t.startswith("["), F.from_json(t, "array<string>"))
    scalar = F.when(t.startswith('"'), F.get_json_object(t, "$")).otherwise(t)
    items = F.coalesce(listed, F.array(scalar))
    return F.when(nothing, F.array().cast("array<string>")).otherwise(F.filter(items, lambda x: x.isNotNull() & (strip(x) != "")))


def list_json(c: Column | str, null_if_empty: bool = False) -> Column:
    """A list as compact JSON text with stripped items and without blanks; null stays null."""
    kept = F.filter(F.transform(col(c), strip), lambda x: x.isNotNull() & (x != ""))
    text = F.to_json(kept)
    return F.when(F.size(kept) > 0, text) if null_if_empty else text


def looks_listed(c: Column | str) -> Column:
    """True for a text in square brackets; its mean over non-null texts tells list columns."""
    t = strip(c)
    return t.startswith("[") & t.endswith("]")


def flatten_payloads(tasks: list[tuple[str, Column]], keys: list[str]) -> dict[str, Column]:
    """Columns of JSON payloads of several tasks: the first task that has a key gives its value, though it be null; a
    later one with another value goes to task__key, or task__key__2 and so on where that name is taken. Payloads that
    are no objects are skipped. Each payload is parsed once."""
    maps = [(name, F.when(F.ltrim(p).startswith("{"), F.from_json(p, "map<string,string>"))) for name, p in tasks]
    out: dict[str, Column] = {k: F.lit(None) for k in keys}
    for k in keys:
        has = [(name, F.coalesce(F.map_contains_key(m, k), F.lit(False)), F.try_element_at(m, F.lit(k))) for name, m in maps]
        value, seen = F.lit(None).cast("string"), F.lit(False)
        for _, present, found in has:
            value = F.when(seen, value).when(present, found).otherwise(value)
            seen = seen | present
        out[k] = value
        before = has[0][1]
        for name, present, found in has[1:]:
            column, n = f"{name}__{k}", 1
            while column in out:
                n += 1
                column = f"{name}__{k}__{n}"
            out[column] = F.when(before & present & ~found.eqNullSafe(value), found)
            before = before | present
    return out


def unwrap(c: Column | str) -> Column:
    """JSON text; a JSON string that itself holds JSON is unwrapped."""
    t = strip(c)
    return F.when(t.startswith('"'), F.get_json_object(t, "$")).otherwise(t)
