"""File sources and sinks: ordered multi-file scans, whole-file replacement, keyed JSON, workbooks, task files."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquetry.functions.entities import sheet_name


def scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A parquet table, only the named columns of which are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_ordered(spark: SparkSession, groups: list[list[str]], columns: list[str] | None = None) -> DataFrame:
    """Files of several groups as one table that keeps their order: source_rank, source_file and source_row tell the
    group, the path and the place in the file. A group of no paths is skipped."""
    out = None
    for i, paths in enumerate(groups):
        if not paths:
            continue
        df = scan(spark, paths[0], None) if len(paths) == 1 else spark.read.parquet(*sorted(paths))
        order = {"source_rank": F.lit(i), "source_file": F.col("_metadata.file_path"), "source_row": F.col("_metadata.row_index")}
        df = df.select(*(columns or df.columns), *(v.alias(k) for k, v in order.items()))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no files")
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def replace_table(spark: SparkSession, df: DataFrame, path: str, backup: bool = False) -> None:
    """Write a table in full beside the old one, then swap, so the table may be computed from the one it replaces.
    With `backup` the old version stays under a name with a number."""
    fs, p, jvm = _fs(spark, path)
    mark = uuid.uuid4().hex
    df.write.parquet(f"{path}.new-{mark}")
    if fs.exists(p):
        old = jvm.org.apache.hadoop.fs.Path(f"{path}.old-{mark}")
        fs.rename(p, old)
        fs.rename(jvm.org.apache.hadoop.fs.Path(f"{path}.new-{mark}"), p)
        if not backup:
            fs.delete(old, True)
    else:
        fs.rename(jvm.org.apache.hadoop.fs.Path(f"{path}.new-{mark}"), p)


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at `path`, built and written first if it isn't there."""
    if not exists(spark, path):
        replace_table(spark, build(), path)
    return spark.read.parquet(path)


def latest_run(spark: SparkSession, path: str, pinned: str | None = None) -> str:
    """The sub-directory of the last run by name, or the pinned one."""
    if pinned:
        return f"{path}/{pinned}"
    fs, p, _ = _fs(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    if not names:
        raise ValueError(f"no runs in {path}")
    return f"{path}/{names[-1]}"


def with_fallback(spark: SparkSession, primary: Callable[[], DataFrame], path: str, last: int = 3) -> DataFrame:
    """The primary source's table; if it can't be had, the rows of the last `last` dated sub-directories of `path`."""
    try:
        return primary()
    except Exception:  # noqa: BLE001 - any failure of the primary source sends us to the files
        fs, p, _ = _fs(spark, path)
        days = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())[-last:]
        if not days:
            raise
        return spark.read.parquet(*(f"{path}/{d}" for d in days))


def write_keyed_json(df: DataFrame, path: str, key: str) -> None:
    """Records as JSON lines with their key, dates as text; the scalable form of a {key: record} file."""
    rest = [c for c in df.columns if c != key]
    df.select(F.col(key).cast("string").alias("key"), F.struct(*rest).alias("record")).write.mode("overwrite").json(path)


def read_keyed_json(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """(key, fields of the record) of JSON lines, by a declared schema; fields a line lacks are null."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("record", record)])
    return spark.read.schema(schema).json(path).select("key", "record.*")


def keyed_object(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """(key, fields of the record) of files that each hold one JSON object {key: record}."""
    text = spark.read.text(path, wholetext=True)
    objects = F.from_json("value", T.MapType(T.StringType(), record))
    return text.select(F.explode(objects).alias("key", "record")).select("key", "record.*")


def write_workbook(sheets: dict[str, DataFrame], path: str) -> dict[str, str]:
    """One CSV directory per sheet under a safe unique name; the names used by sheet."""
    names = unique_sheet_names(sheets)
    for title, df in sheets.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{names[title]}")
    return names


def read_sheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    return spark.read.option("header", True).csv(f"{path}/{sheet}")


def unique_sheet_names(titles: Iterable[str], most: int = 31) -> dict[str, str]:
    """Safe names of at most `most` signs, told apart by _2, _3 ... in any case."""
    out: dict[str, str] = {}
    used: set[str] = set()
    for title in titles:
        base = re.sub(r"\s+", " ", re.sub(r"[:\\/?*\[\]]", "", title)).strip()[:most] or "Sheet"
        name, n = base, 1
        while name.lower() in used:
            n += 1
            name = f"{base[: most - len(f'_{n}')]}_{n}"
        used.add(name.lower())
        out[title] = name
    return out


def sheet_names(df: DataFrame, title: str) -> DataFrame:
    """`df` with a column `sheet`: a safe name of each row's title, before any are told apart."""
    return df.withColumn("sheet", sheet_name(title))


@dataclass(frozen=True)
class Task:
    """One question to a provider: its prompt, sampling settings and the name of a post-processor."""

    name: str
    system_prompt: str
    temperature: float = 0.0
    top_p: float = 1.0
    max_tokens: int = 256
    repeat_penalty: float = 1.1
    postprocess: str | None = None
    extra: dict = field(default_factory=dict)


def load_tasks(path: str) -> dict[str, Task]:
    """Enabled tasks of a YAML or JSON file {name: settings} or {tasks: [...]}, by name."""
    text = Path(path).read_text()
    try:
        import yaml

        data = yaml.safe_load(text)
    except ImportError:
        data = json.loads(text)
    entries = data.get("tasks", data)
    items = [(e["name"], e) for e in entries] if isinstance(entries, list) else list(entries.items())
    known = set(Task.__dataclass_fields__) - {"extra", "name"}
    out = {}
    for name, settings in items:
        if settings.get("enabled", True):
            used = {k: v for k, v in settings.items() if k in known and v is not None}
            used.setdefault("system_prompt", "")
            out[name] = Task(name, extra={k: v for k, v in settings.items() if k not in known and k not in ("name", "enabled")}, **used)
    return out


def dump_results(df: DataFrame, path: str) -> None:
    """Every row, errors included, as one JSON text per line."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def rename_columns(spark: SparkSession, path: str, names: dict[str, str]) -> None:
    """Rewrite a table with columns renamed."""
    replace_table(spark, spark.read.parquet(path).withColumnsRenamed(names), path)
