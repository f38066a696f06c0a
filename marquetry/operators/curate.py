"""Curation: deterministic de-duplication, filters that keep nulls, change detection and key differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by a total order. Null keys form a group of their own.

    The row-number filter becomes a group limit that drops all but one row of a key before the shuffle, so a key
    that holds a third of the rows costs no more than another.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def tagged_union(frames: list[DataFrame], rank: str = "source_rank") -> DataFrame:
    """Union by name of frames with the place of each in the list, for keep-first across sources; columns that a
    frame lacks come out null."""
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn(rank, F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def usable(text: str, least: int = 5) -> Column:
    """Text of at least `least` code points; null is not usable; 0 lets everything pass."""
    return F.lit(True) if least == 0 else F.coalesce(F.char_length(text) >= least, F.lit(False))


def not_among(c: str, values: list) -> Column:
    """Not one of the values; null passes, as it is none of them."""
    return ~F.coalesce(F.col(c).isin(values), F.lit(False))


def text_changed(new: Column, old: Column) -> Column:
    """Different texts, null counting as ''."""
    return F.coalesce(new, F.lit("")) != F.coalesce(old, F.lit(""))


def detect_changes(new: DataFrame, old: DataFrame | None, key: str, text: str) -> DataFrame:
    """Rows of `new` whose key `old` lacks or whose text differs there, with a column `change` ('new' or 'changed').

    One left join to the old keys and texts; with several old rows of a key any that differs counts. Without an old
    table every row is new. Rows with a null key are new.
    """
    if old is None:
        return new.withColumn("change", F.lit("new"))
    past = old.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.collect_set(F.coalesce(text, F.lit(""))).alias("_texts"))
    joined = new.join(past, new[key] == past["_k"], "left")
    same = F.forall("_texts", lambda t: t == F.coalesce(F.col(text), F.lit("")))
    change = F.when(F.col("_k").isNull(), "new").when(~same, "changed")
    return joined.withColumn("change", change).filter("change is not null").drop("_k", "_texts")


def pending(df: DataFrame, done: list[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in none of the `done` tables; rows with a null key stay."""
    for d in done:
        df = df.join(d.select(key).distinct(), key, "left_anti")
    return df


def in_scope(df: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in `scope`."""
    return df.join(scope.select(key), key, "left_semi")


def key_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): non-null keys of only one table, each once; side is 'left_only' or 'right_only'."""
    a, b = (d.filter(F.col(key).isNotNull()).select(key).distinct() for d in (left, right))
    lone = lambda x, y, name: x.join(y, key, "left_anti").select(key, F.lit(name).alias("side"))
    return lone(a, b, "left_only").union(lone(b, a, "right_only"))


def replace_cohort(sample: DataFrame, special: DataFrame, key: str) -> DataFrame:
    """`special`, and of `sample` the rows whose key is not in it."""
    return sample.join(special.select(key), key, "left_anti").unionByName(special, allowMissingColumns=True)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 1, pinned: DataFrame | None = None) -> DataFrame:
    """n rows by hash of key and seed, the same in every run; pinned keys come first and count towards n."""
    hashed = F.xxhash64(F.col(key), F.lit(seed))
    if pinned is None:
        return df.orderBy(hashed, key).limit(n)
    marked = df.join(pinned.select(key, F.lit(True).alias("_pin")).distinct(), key, "left")
    return marked.orderBy(F.col("_pin").isNull(), hashed, key).limit(n).drop("_pin")


def chunked(df: DataFrame, order: list[Column], size: int = 25) -> DataFrame:
    """`df` with the number of the batch of `size` rows that each row falls into.

    Rows are numbered by range partition and place in it, so no task sees all rows. Ties in the order fall as they lie.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    out = ranged.join(F.broadcast(before.select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))), "_part")
    return out.withColumn("batch", F.floor((F.col("_before") + F.col("_at")) / size)).drop("_part", "_at", "_before")
