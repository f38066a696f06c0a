"""Encoders: vocabularies of the most frequent values, multi-hot and one-hot columns, embeddings and PCA."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, HashingTF, StandardScaler, Tokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquetry.functions.text import strip

EMPTY, OTHER = "__EMPTY__", "__OTHER__"


def auto_top_n(df: DataFrame, columns: list[str], least: int = 10, most: int = 400, share: float = 0.1) -> DataFrame:
    """(column, n_unique, top_n) of array columns: the share of their distinct values, within bounds."""
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("items")) for c in columns))
    items = df.select(F.explode(entries).alias("e")).select("e.column", F.explode_outer("e.items").alias("v"))
    n = items.groupBy("column").agg(F.countDistinct("v").alias("n_unique"))
    return n.withColumn("top_n", F.floor(F.greatest(F.lit(float(least)), F.least(F.lit(float(most)), share * F.col("n_unique")))).cast("bigint"))


def row_tokens(c: str, most: int | None = 5) -> Column:
    """Lower-case stripped tokens of an array column without empty ones, the first `most`; [__EMPTY__] if there are none."""
    kept = F.filter(F.transform(F.col(c), lambda x: F.lower(strip(x))), lambda x: x.isNotNull() & (x != ""))
    kept = F.slice(kept, 1, most) if most else kept
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(EMPTY)))


def top_tokens(df: DataFrame, tokens: Column, n: int, keep_empty: bool = False) -> DataFrame:
    """(token, count, rank) of the n most frequent tokens; ties by token."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("count"))
    counts = counts if keep_empty else counts.filter(F.col("token") != EMPTY)
    top = counts.orderBy(F.desc("count"), "token").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "token")))


def map_top_tokens(df: DataFrame, key: str, c: str, n: int, most: int | None = 5) -> DataFrame:
    """`df` with c_mapped: the row's tokens with those outside the n most frequent as __OTHER__.

    The vocabulary has n rows at most and is the side that is broadcast.
    """
    vocabulary = top_tokens(df, row_tokens(c, most), n).agg(F.collect_set("token").alias("_v"))
    tokens = row_tokens(c, most)
    mapped = F.transform(tokens, lambda t: F.when(F.array_contains(F.col("_v"), t) | (t == EMPTY), t).otherwise(OTHER))
    return df.join(F.broadcast(vocabulary)).withColumn(f"{c}_mapped", mapped).drop("_v")


def map_top_value(df: DataFrame, c: str, n: int) -> DataFrame:
    """`df` with c_mapped and c_idx: a single value with __EMPTY__ for null (which is counted) and __OTHER__ outside the
    n most frequent; c_idx is the place of the mapped value among all mapped values in order."""
    value = F.coalesce(F.col(c), F.lit(EMPTY))
    vocabulary = top_tokens(df, F.array(value), n, keep_empty=True).select(F.col("token").alias("_t"))
    mapped = F.when(F.col("_t").isNotNull() | (value == EMPTY), value).otherwise(OTHER)
    out = df.join(F.broadcast(vocabulary), value == F.col("_t"), "left").withColumn(f"{c}_mapped", mapped).drop("_t")
    codes = out.select(f"{c}_mapped").distinct().withColumn(f"{c}_idx", F.row_number().over(Window.orderBy(f"{c}_mapped")) - 1)
    return out.join(F.broadcast(codes), f"{c}_mapped")


def multi_hot(df: DataFrame, c: str, n: int = 32, values: list[str] | None = None) -> DataFrame:
    """`df` with a 0/1 column for each of the n most frequent values of an array column, and one for any other.

    The values become columns, so the n of them (a parameter) come to the driver.
    """
    if values is None:
        values = [r["token"] for r in top_tokens(df, F.col(c), n).orderBy("rank").collect()]
    items = F.coalesce(F.col(c), F.array().cast("array<string>"))
    out: dict[str, Column] = {}
    for v in values:
        name, n = f"{c}_{v}", 1
        while name.lower() in {x.lower() for x in out}:  # values that differ in case only are columns of their own
            n += 1
            name = f"{c}_{v}_{n}"
        out[name] = F.coalesce(F.array_contains(items, v), F.lit(False)).cast("int")
    known = F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")
    out[f"{c}_OTHER"] = F.exists(F.filter(items, lambda x: x.isNotNull()), lambda x: ~F.array_contains(known, x)).cast("int")
    return df.withColumns(out)


def one_hot(df: DataFrame, c: str, categories: list[str]) -> DataFrame:
    """`df` with a 0/1 column for each category; an unknown or null value is 0 everywhere."""
    return df.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == v, F.lit(False)).cast("int") for v in categories})


def hashed_embedding(df: DataFrame, text: str, out: str, dims: int = 256) -> DataFrame:
    """The offline embedding provider: words hashed into a vector."""
    filled = df.withColumn("_text", F.coalesce(F.col(text), F.lit("unknown")))
    stages = [Tokenizer(inputCol="_text", outputCol="_words"), HashingTF(inputCol="_words", outputCol=out, numFeatures=dims)]
    return Pipeline(stages=stages).fit(filled).transform(filled).drop("_text", "_words")


def embed_pca(df: DataFrame, text: str, out: str, components: int = 32, embed: Callable[[DataFrame, str, str], DataFrame] = hashed_embedding) -> DataFrame:
    """`df` with the first principal components of an embedding of the text; vectors are centred before the projection."""
    embedded = embed(df, text, "_e")
    stages = [StandardScaler(inputCol="_e", outputCol="_c", withMean=True, withStd=False), PCA(k=components, inputCol="_c", outputCol=out)]
    return Pipeline(stages=stages).fit(embedded).transform(embedded).drop("_e", "_c")


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise ValueError if a key occurs twice."""
    again = df.groupBy(key).count().filter("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"{key} is not unique: {again[0][0]}")


def boolean_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with text columns of which every known value is true or false, in any case, as booleans; others as they are.

    One aggregation tells which they are; its single row comes to the driver."""
    tests = [F.every(F.coalesce(F.lower(strip(c)).isin("true", "false"), F.lit(True))).alias(c) for c in columns]
    known = [F.count(c).alias(f"n_{c}") for c in columns]
    row = df.agg(*tests, *known).first()
    return df.withColumns({c: (F.lower(strip(c)) == "true") for c in columns if row[c] and row[f"n_{c}"]})


def feature_table(df: DataFrame, keep: list[str], one_hots: dict[str, list[str]], multi_hots: dict[str, list[str]], passed: list[str]) -> DataFrame:
    """One select of `keep`, one-hot, multi-hot and passed-through blocks in this order; booleans become 0 and 1."""
    out = df
    for c, values in one_hots.items():
        out = one_hot(out, c, values)
    for c, values in multi_hots.items():
        out = multi_hot(out, c, values=values)
    made = [c for c in out.columns if c not in df.columns]
    number = [(F.col(c).cast("int") if df.schema[c].dataType.simpleString() == "boolean" else F.col(c)).alias(c) for c in passed]
    return out.select(*keep, *(F.col(f"`{c}`") for c in made), *number)
