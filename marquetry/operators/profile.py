"""Profiles and comparisons: coverage, frequencies, medians, agreement, error histograms, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquetry.functions.entities import agrees, jaccard
from marquetry.functions.text import strip
from marquetry.operators.curate import keep_first


def filled(c: str, kind: T.DataType, unknown: tuple[str, ...] = ()) -> Column:
    """Not null, no blank text (nor one of `unknown`), no empty list."""
    if isinstance(kind, T.StringType):
        text = F.lower(strip(c))
        return F.coalesce((text != "") & ~text.isin(*unknown) if unknown else text != "", F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(F.col(c)) > 0, F.lit(False)) & F.col(c).isNotNull()
    return F.col(c).isNotNull()


def coverage(df: DataFrame, columns: list[str], unknown: tuple[str, ...] = ()) -> DataFrame:
    """(column, n_filled, n_rows, pct) in one pass over the table."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    counts = df.agg(F.count("*").alias("n_rows"), *(F.count_if(filled(c, kinds[c], unknown)).alias(c) for c in columns))
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n_filled")) for c in columns))
    out = counts.select("n_rows", F.explode(entries).alias("e")).select("e.column", "e.n_filled", "n_rows")
    return out.withColumn("pct", F.when(F.col("n_rows") > 0, F.round(100.0 * F.col("n_filled") / F.col("n_rows"), 2)))


def frequency(df: DataFrame, value: Column, k: int | None = None) -> DataFrame:
    """(value, count) by falling count, then value; null is a value. With k the first k."""
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return counts.limit(k) if k else counts


def list_frequency(df: DataFrame, c: str, k: int | None = None) -> DataFrame:
    return frequency(df.select(F.explode(c).alias("_v")), F.col("_v"), k)


def upper_median(df: DataFrame, group: list[str], c: str) -> DataFrame:
    """(group, n, upper_median): the element of place n div 2, counted from 0, of the sorted values, which differs from
    the median for even n. Equal values are counted before the shuffle; running sums over the distinct ones find it."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(*group, c).agg(F.count("*").alias("_c"))
    by = Window.partitionBy(*group)
    upto = F.sum("_c").over(by.orderBy(c).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"_to": upto, "n": F.sum("_c").over(by)})
    half = F.floor(F.col("n") / 2)
    return ranked.filter((F.col("_to") > half) & (F.col("_to") - F.col("_c") <= half)).select(*group, "n", F.col(c).alias("upper_median"))


def top_by(df: DataFrame, derived: Column, k: int, *ties: str) -> DataFrame:
    """The k rows with the greatest derived value, ties by columns; rows for which it is unknown do not count."""
    return df.withColumn("_d", derived).filter("_d is not null").orderBy(F.desc("_d"), *ties).limit(k).drop("_d")


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_unique, avg_len, max_len, pct_empty, is_multivalued): nested values count singly, lengths are those of
    lists or of texts, empty are null, '' and []. One pass for the lengths of all columns, one for their values."""
    many = {c: isinstance(df.schema[c].dataType, T.ArrayType) for c in columns}
    items = {c: F.col(c).cast("array<string>") if m else F.array(F.col(c).cast("string")) for c, m in many.items()}
    length = {c: F.when(F.col(c).isNotNull(), F.size(c)) if m else F.char_length(F.col(c).cast("string")) for c, m in many.items()}
    one = lambda c: F.struct(F.lit(c).alias("column"), items[c].alias("items"))
    values = df.select(F.explode(F.array(*map(one, columns))).alias("e")).select("e.column", F.explode_outer("e.items").alias("v"))
    uniques = values.groupBy("column").agg(F.countDistinct("v").alias("n_unique"))
    sizes = df.agg(*(F.struct(
        F.lit(c).alias("column"), F.round(F.avg(n), 4).alias("avg_len"), F.max(n).cast("bigint").alias("max_len"),
        F.round(100.0 * F.count_if(F.coalesce(n, F.lit(0)) == 0) / F.count("*"), 4).alias("pct_empty"), F.lit(many[c]).alias("is_multivalued"),
    ).alias(c) for c, n in length.items()))
    return uniques.join(F.broadcast(sizes.select(F.explode(F.array(*columns)).alias("e")).select("e.*")), "column")


def error_histogram(df: DataFrame, error: str, cut: int = 40) -> DataFrame:
    """(bucket, count, example): errors by the text before the first colon, cut to `cut` signs; the example is the least."""
    bucket = F.substring(F.split_part(F.col(error), F.lit(":"), F.lit(1)), 1, cut).alias("bucket")
    return df.filter(F.col(error).isNotNull()).groupBy(bucket).agg(F.count("*").alias("count"), F.min(error).alias("example"))


def first_examples(df: DataFrame, group: list[str], value: str, order: list[Column], k: int = 3, separator: str = " | ") -> DataFrame:
    """(group, count, examples): the first k values of each group by a total order, joined."""
    at = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    some = df.withColumn("_at", at).filter(F.col("_at") <= k).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("v")))).alias("_e"))
    some = some.select(*group, F.array_join(F.col("_e.v"), separator).alias("examples"))
    return df.groupBy(*group).agg(F.count("*").alias("count")).join(some, group)


def side_by_side(new: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Each new row with field__new, field__old and field__agree; keys match in upper case. Of several old rows of a key
    the least by the fields counts."""
    o = old.select(F.upper(strip(F.col(key).cast("string"))).alias("_k"), *(F.col(f).alias(f"{f}__old") for f in fields))
    o = keep_first(o, ["_k"], [F.col(f"{f}__old") for f in fields])
    joined = new.join(o, F.upper(strip(F.col(key).cast("string"))) == o["_k"], "left")
    columns = [x for f in fields for x in (F.col(f).alias(f"{f}__new"), F.col(f"{f}__old"), F.when(F.col("_k").isNotNull(), agrees(F.col(f), F.col(f"{f}__old"))).alias(f"{f}__agree"))]
    return joined.select(key, *columns)


def agreement(compared: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n, agree_rate) over the rows in which the old value is known."""
    entries = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}__old").isNotNull().alias("known"), F.col(f"{f}__agree").alias("agree")) for f in fields))
    rows = compared.select(F.explode(entries).alias("e")).filter("e.known").groupBy("e.field")
    return rows.agg(F.count("*").alias("n"), F.round(F.avg(F.col("e.agree").cast("int")), 6).alias("agree_rate"))


def any_disagrees(fields: list[str]) -> Column:
    """True if some field's __agree is false; null counts as agreement."""
    return F.exists(F.array(*(F.col(f"{f}__agree") for f in fields)), lambda x: ~F.coalesce(x, F.lit(True)))


def pairwise_jaccard(df: DataFrame, model: str, key: str, fields: list[str]) -> DataFrame:
    """(model_a, model_b, field, n, mean_jaccard) over the keys that both models have."""
    a = df.select(F.col(model).alias("model_a"), F.col(key).alias("_k"), *(F.col(f).alias(f"a_{f}") for f in fields))
    b = df.select(F.col(model).alias("model_b"), F.col(key).alias("_k"), *(F.col(f).alias(f"b_{f}") for f in fields))
    pairs = a.join(b, "_k").filter("model_a < model_b")
    entries = F.array(*(F.struct(F.lit(f).alias("field"), jaccard(F.col(f"a_{f}"), F.col(f"b_{f}")).alias("j")) for f in fields))
    rows = pairs.select("model_a", "model_b", F.explode(entries).alias("e"))
    return rows.groupBy("model_a", "model_b", F.col("e.field").alias("field")).agg(F.count("*").alias("n"), F.round(F.avg("e.j"), 6).alias("mean_jaccard"))


def run_summary(df: DataFrame, group: list[str], lists: list[str], error: str) -> DataFrame:
    """(group, n, errors, avg_items): rows, failed rows and list items of a row on average; failed rows have none.
    Sums of seconds, tokens or cost come from `enrich.usage`."""
    items = sum((F.coalesce(F.size(F.coalesce(c, F.array().cast("array<string>"))), F.lit(0)) for c in lists), F.lit(0))
    items = F.when(F.col(error).isNull(), items).otherwise(0)
    return df.groupBy(*group).agg(F.count("*").alias("n"), F.count(error).alias("errors"), F.round(F.sum(items) / F.greatest(F.count("*"), F.lit(1)), 4).alias("avg_items"))


def running_total(df: DataFrame, batch: str, amount: str) -> DataFrame:
    """(batch, amount, total) with the running total over batches in order; a row for each batch."""
    sums = df.groupBy(batch).agg(F.sum(amount).alias(amount))
    return sums.withColumn("total", F.sum(amount).over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)))


def unknown_values(df: DataFrame, c: str, unknown: tuple[str, ...] = ("unknown",)) -> DataFrame:
    """Rows in which a column is null, blank or one of the words for unknown."""
    return df.filter(~filled(c, df.schema[c].dataType, unknown))


def drill_down(df: DataFrame, c: str, needle: str) -> DataFrame:
    """Rows whose text holds the needle in any case."""
    return df.filter(F.contains(F.upper(F.col(c)), F.lit(needle.upper())))


def in_order(df: DataFrame, c: str, values: list) -> DataFrame:
    """Rows of the listed values with `place`, their place in the list from 0, by which they are sorted."""
    listed = F.array(*map(F.lit, values))
    return df.filter(F.col(c).isin(values)).withColumn("place", F.array_position(listed, F.col(c)) - 1).orderBy("place")


def row_metrics(df: DataFrame, lists: list[str], error: str, texts: list[str]) -> DataFrame:
    """`df` with n_items (of all lists; 0 on error), failed, and n_texts (known non-blank texts)."""
    size = lambda c: F.size(F.coalesce(F.col(c), F.array().cast("array<string>")))
    items = sum((size(c) for c in lists), F.lit(0))
    known = sum((F.coalesce(strip(c) != "", F.lit(False)).cast("int") for c in texts), F.lit(0))
    return df.withColumns({"n_items": F.when(F.col(error).isNull(), items).otherwise(0), "failed": F.col(error).isNotNull(), "n_texts": known})


def hit_rate(df: DataFrame, cohort: str, c: str) -> DataFrame:
    """(cohort, n, hits, rate): the share of rows in which a column is known."""
    out = df.groupBy(cohort).agg(F.count("*").alias("n"), F.count(c).alias("hits"))
    return out.withColumn("rate", F.round(F.col("hits") / F.col("n"), 6))


def suffixed_join(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Left join in which columns of both sides come apart by a suffix on the right one's; `right` has one row per key."""
    both = set(left.columns) & set(right.columns) - {key}
    return left.join(right.select(key, *(F.col(c).alias(f"{c}{suffix}" if c in both else c) for c in right.columns if c != key)), key, "left")
