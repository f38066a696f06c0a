"""SQL warehouses: bound statements, several results, guarded truncation, staging loads, two-way synchronisation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.operators.curate import key_differences
from marquetry.operators.upsert import keep_latest, merge_by_name
from marquetry.functions.jsonx import list_json, looks_listed, variant_list

IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


def select(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Run a statement with named parameters; a list is bound as an array (use array_contains(:ids, x))."""
    bound = {k: F.array(*map(F.lit, v)) if isinstance(v, (list, tuple)) else v for k, v in (args or {}).items()}
    return spark.sql(sql, args=bound)


def select_many(spark: SparkSession, script: str, args: dict | None = None, labels: list[str] | None = None) -> dict[str | int, DataFrame]:
    """Results of several statements by label or place. Semicolons inside quotes don't part statements."""
    statements = [s.strip() for s in re.split(r";(?=(?:[^']*'[^']*')*[^']*$)", script) if s.strip()]
    return {labels[i] if labels and i < len(labels) else i: select(spark, s, args) for i, s in enumerate(statements)}


def truncate(spark: SparkSession, table: str) -> bool:
    """Empty a table; a name that is no plain identifier, or a failure, gives False."""
    if not IDENTIFIER.match(table):
        return False
    try:
        spark.sql("TRUNCATE TABLE IDENTIFIER(:t)", args={"t": table})
    except Exception:  # noqa: BLE001 - the caller is told, as documented
        return False
    return True


def jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of another database; partition options make the read parallel."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def to_staging(df: DataFrame, drop: tuple[str, ...] = ("synopsis",)) -> DataFrame:
    """Columns as the staging table has them: upper-case names, lists as JSON text, NaN as null, without `drop`."""
    out = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        kind, c = f.dataType.simpleString(), F.col(f.name)
        c = list_json(c) if kind == "array<string>" else F.when(~F.isnan(c), c) if kind in ("double", "float") else c
        out.append(c.alias(f.name.upper()))
    return df.select(*out)


def from_warehouse(df: DataFrame, lists: list[str]) -> DataFrame:
    """Columns as the local table has them: lower-case names, list columns parsed."""
    out = df.toDF(*(c.lower() for c in df.columns))
    return out.withColumns({c: variant_list(c) for c in lists if c in out.columns})


def list_columns(df: DataFrame, threshold: float = 0.2) -> DataFrame:
    """(column, rate): text columns of which at least the share `threshold` of known values look like lists."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    rates = df.agg(*(F.avg(looks_listed(c).cast("int")).alias(c) for c in texts))
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("rate")) for c in texts))
    return rates.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("rate") >= threshold)


def synchronise(local: DataFrame, remote: DataFrame, key: str, stamp: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(local, remote) after both have got the rows that only the other had; copies of a key are reduced to the latest
    where `stamp` names a time."""
    lone = key_differences(local, remote, key)
    send = local.join(lone.filter("side = 'left_only'").select(key), key, "left_semi")
    fetch = remote.join(lone.filter("side = 'right_only'").select(key), key, "left_semi")
    send = keep_latest(send, key, stamp) if stamp else send
    fetch = keep_latest(fetch, key, stamp) if stamp else fetch
    return local.unionByName(fetch, allowMissingColumns=True), merge_by_name(remote, send, key)
