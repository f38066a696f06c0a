"""Differences between two copies of a table (problem 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquetry.functions.text import plain_form

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DIFFERENCE = "array<struct<field:string,left:string,right:string>>"


def normalised(c: Column, kind: T.DataType) -> Column:
    """The form in which two values are compared.

    Texts in plain form (null as ''), arrays as sorted sets of their non-null normalised elements (null as empty),
    structs field by field, numbers and all else as they are.
    """
    if isinstance(kind, T.StringType):
        return plain_form(c)
    if isinstance(kind, T.ArrayType):
        kept = F.filter(c, lambda e: e.isNotNull())
        items = F.transform(kept, lambda e: normalised(e, kind.elementType))
        return F.coalesce(F.array_sort(F.array_distinct(items)), F.array().cast(kind))
    if isinstance(kind, T.StructType):
        return F.struct(*(normalised(c[f.name], f.dataType).alias(f.name) for f in kind.fields))
    return c


def differs(left: Column, right: Column, kind: T.DataType, tolerance: float) -> Column:
    """Null-safe inequality of normalised values; numbers by more than `tolerance` of the larger."""
    if isinstance(kind, NUMBERS):
        a, b = left.cast("double"), right.cast("double")
        apart = F.abs(a - b) > F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b))
        return ~left.eqNullSafe(right) & F.coalesce(apart, F.lit(True))
    return ~left.eqNullSafe(right)


def _shown(c: Column, kind: T.DataType) -> Column:
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.StructType)) else c.cast("string")


def compare_copies(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ignore: tuple[str, ...] = (),
    tolerance: float = 1e-4,
    text_key: bool = False,
    unique_keys: bool = False,
) -> DataFrame:
    """Rows that are missing on a side or differ, as (row_key, kind, differences).

    The two copies meet in one null-safe full outer join on the key; all fields are compared in that pass into an
    array of (field, left, right). kind is only_left, only_right or differs; equal rows do not come out.
    Only columns that both copies have are compared (but for the key and `ignore`).

    text_key: keys match in plain form and come out upper-cased.
    unique_keys: the caller knows that no key occurs twice, so one shuffle of each side serves the join. Without it
    rows of one key are numbered in the order of their content and paired by that number: copies of a row pair with
    copies, surplus ones are missing on the other side. A null key is a key like any other. An empty table gives
    every row of the other side. A NaN equals a NaN.
    """
    other = {f.name: f.dataType for f in right.schema.fields}
    kinds = {f.name: f.dataType for f in left.schema.fields if f.name in other and f.name not in (key, *ignore)}

    def side(df: DataFrame, tag: str) -> DataFrame:
        k = F.upper(plain_form(key)) if text_key else F.col(f"`{key}`")
        picked = [normalised(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"v{i}") for i, c in enumerate(kinds)]
        out = df.select(k.alias("k"), F.struct(F.lit(True).alias("here"), *picked).alias(tag))
        if unique_keys:
            return out
        order = F.xxhash64(F.to_json(tag)), F.to_json(tag)
        return out.withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy(*order)))

    a, b = side(left, "a"), side(right, "b")
    on = a["k"].eqNullSafe(b["k"])
    if not unique_keys:
        on = on & (a["nth"] == b["nth"])
    entries = [
        F.when(
            differs(F.col(f"a.v{i}"), F.col(f"b.v{i}"), kind, tolerance),
            F.struct(
                F.lit(c).alias("field"),
                _shown(F.col(f"a.v{i}"), kind).alias("left"),
                _shown(F.col(f"b.v{i}"), kind).alias("right"),
            ),
        )
        for i, (c, kind) in enumerate(kinds.items())
    ]
    none = F.array().cast(DIFFERENCE)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    found = F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else none
    kind = F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right")
    return (
        a.join(b, on, "full_outer")
        .select(
            F.coalesce(a["k"], b["k"]).alias("row_key"),
            kind.alias("kind"),
            F.when(both, found).otherwise(none).alias("differences"),
        )
        .filter(F.col("kind").isNotNull() | (F.size("differences") > 0))
        .withColumn("kind", F.coalesce("kind", F.lit("differs")))
    )


def long_form(compared: DataFrame, left_name: str = "only_left", right_name: str = "only_right") -> DataFrame:
    """`compare_copies` with one row per difference: row_key, field ('row' for a missing row), kind, left, right."""
    lone = F.array(F.struct(F.lit("row").alias("field"), F.lit(None).cast("string").alias("left"), F.lit(None).cast("string").alias("right")))
    kind = F.when(F.col("kind") == "only_left", left_name).when(F.col("kind") == "only_right", right_name)
    return compared.select(
        "row_key",
        F.coalesce(kind, F.col("kind")).alias("kind"),
        F.explode(F.when(F.col("kind") == "differs", F.col("differences")).otherwise(lone)).alias("d"),
    ).select("row_key", "d.field", "kind", "d.left", "d.right")
