"""Merging generations of a table under explicit conflict policies, and the error ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.operators.curate import keep_first


def _first_by_key(df: DataFrame, keys: list[str], order: list[Column] | None) -> DataFrame:
    return keep_first(df, keys, order or [F.to_json(F.struct(*df.columns))])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], policy: str, order: list[Column] | None = None) -> DataFrame:
    """One row per key of both generations; columns of either side are kept, missing ones are null.

    policy: 'new_wins' (new before old, first copy of each), 'existing_wins' (old before new, first copy), or
    'last_wins' (old then new, last copy). `order` is the total order of rows in a generation; without it the
    least by content stays of several copies in one generation. Null keys are one key.
    """
    if policy not in ("new_wins", "existing_wins", "last_wins"):
        raise ValueError(f"unknown policy {policy}")
    if policy == "last_wins" and order:
        order = [_reversed(c) for c in order]
    winner, loser = (old, new) if policy == "existing_wins" else (new, old)
    winner, loser = _first_by_key(winner, keys, order), _first_by_key(loser, keys, order)
    on = [winner[k].eqNullSafe(loser[k]) for k in keys]
    rest = loser.join(winner.select(*keys), on, "left_anti")
    return winner.unionByName(rest, allowMissingColumns=True)


def _reversed(c: Column) -> Column:
    return c.desc_nulls_last()


def merge_by_name(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Matched rows get all columns of the source by name, unmatched source rows are added, in the target's columns.

    Columns that the source lacks keep the target's value. Of several source rows of a key the least by content
    counts; rows with a null key never match.
    """
    s = _first_by_key(source, [key], None).select(*(F.col(c).alias(f"_s_{c}") for c in source.columns))
    joined = target.join(s, target[key] == s[f"_s_{key}"], "full_outer")
    hit = F.col(f"_s_{key}").isNotNull()
    columns = [F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in source.columns else F.col(c) for c in target.columns]
    return joined.select(*columns)


def drop_repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key goes, as do repeated nulls."""
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n")).filter("_n > 1")
    return df.join(counts, df[key].eqNullSafe(counts["_k"]), "left_anti")


def keep_latest(df: DataFrame, key: str, stamp: str, *ties: str) -> DataFrame:
    """The row of each key with the latest stamp; ties by the further columns, ascending."""
    return keep_first(df, [key], [F.col(stamp).desc(), *map(F.col, ties)])


def merge_ledger(errors: DataFrame, batch_errors: DataFrame, recovered: DataFrame, key: str) -> DataFrame:
    """The error ledger after a batch: entries of recovered keys are purged, the batch's errors replace older ones."""
    left = errors.join(recovered.select(key).distinct(), key, "left_anti")
    return upsert(left, batch_errors, [key], "new_wins")


def patch(df: DataFrame, patches: DataFrame, key: str, scalars: list[str] = (), replace: list[str] = (), append: list[str] = ()) -> DataFrame:
    """`df` with hand-made corrections by key: scalars and lists replaced, lists appended to (without repeats, in order).

    A null in the patch leaves the value as it is. The patch table has one row for each key.
    """
    p = patches.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_p_{c}") for c in [*scalars, *replace, *append]))
    out = df.join(p, df[key] == p["_k"], "left")
    for c in [*scalars, *replace]:
        out = out.withColumn(c, F.coalesce(f"_p_{c}", c))
    for c in append:
        none = F.array().cast(df.schema[c].dataType)
        both = F.array_union(F.coalesce(c, none), F.coalesce(f"_p_{c}", none))
        out = out.withColumn(c, F.when(F.col(f"_p_{c}").isNull(), F.col(c)).otherwise(both))
    return out.drop("_k", *(f"_p_{c}" for c in [*scalars, *replace, *append]))
