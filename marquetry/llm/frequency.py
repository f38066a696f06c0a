"""Frequency of every distinct term over array columns, by last-seen counters (problem 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquetry.functions.text import plain_form

# Tokens of one term are spread over at least so many partitions by record (over all of a larger cluster's), so a hot
# term is never one task's.
SALTS = 32


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal (field, term, record) tokens of a batch as one with their number."""
    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch]).group_by(["field", "term", "record"]).aggregate([("n", "sum")])
            yield from t.rename_columns(["field", "term", "record", "n"]).to_batches()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of tokens that arrive ordered by (field, term, record).

    A term's counter is (occurrences, records, last record seen): a token adds a record only if its record differs
    from the last one seen for the term. Runs of a batch are counted as a whole; the counter of the term at the
    batch's end is carried over, so the state is a single counter however many terms and records there are.
    """
    names = ["field", "term", "occurrences", "records"]
    held: tuple | None = None  # field, term, occurrences, records, last record
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        field, term, record, count = (batch.column(i) for i in range(4))

        def changed(a: pa.Array) -> np.ndarray:
            same = pc.fill_null(pc.equal(a.slice(1), a.slice(0, n - 1)), False)
            both_null = pc.and_(a.slice(1).is_null(), a.slice(0, n - 1).is_null())
            return ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)

        new_term = np.append(True, changed(field) | changed(term)) if n > 1 else np.array([True])
        fresh = new_term | (np.append(True, changed(record)) if n > 1 else True)
        fresh &= record.is_valid().to_numpy(zero_copy_only=False)  # a null record is no record
        begin = np.flatnonzero(new_term)
        occurrences = np.add.reduceat(count.to_numpy(zero_copy_only=False), begin)
        records = np.add.reduceat(fresh.astype(np.int64), begin)
        if held and held[0] == field[0].as_py() and held[1] == term[0].as_py():
            seen = record[0].as_py() is not None and held[4] == record[0].as_py()
            occurrences[0] += held[2]
            records[0] += held[3] - seen
        elif held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held[:4]], names=names)
        tail = begin[-1]
        held = (field[int(tail)].as_py(), term[int(tail)].as_py(), int(occurrences[-1]), int(records[-1]), record[n - 1].as_py())
        if len(begin) > 1:
            at = pa.array(begin[:-1])
            yield pa.RecordBatch.from_arrays([field.take(at), term.take(at), pa.array(occurrences[:-1]), pa.array(records[:-1])], names=names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held[:4]], names=names)


def term_frequencies(df: DataFrame, record: str, fields: list[str], rare: int = 2, common: float = 0.2) -> DataFrame:
    """(field, term, occurrences, records, mark) of every distinct term of the array columns `fields`.

    Terms are in plain form, without ''. records is the number of distinct values of `record` whose field holds the
    term: mark is 'rare' if at most `rare`, 'common' if more than the share `common` of all distinct records, else
    null. Tokens are combined where they are read, hash-partitioned by term and a salt of the record, and ordered by
    record within a term; a term's parts count disjoint records, so they add up. The state of a task is one counter.

    Null and empty arrays, null and blank elements give nothing. A null record adds occurrences but no record.
    Repeated rows and terms each occur; other columns are not read. An empty table gives no rows.
    """
    lists = [F.struct(F.lit(f).alias("field"), F.transform(F.col(f), plain_form).alias("terms")) for f in fields]
    tokens = df.select(F.col(record).alias("record"), F.explode(F.array(*lists)).alias("l")).select(
        "l.field", F.explode("l.terms").alias("term"), "record"
    )
    totals = (
        _counters(tokens.filter("term <> ''"))
        .groupBy("field", "term")
        .agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    )
    # one token of the collection itself in every record: its counter is the number of distinct records
    every = _counters(df.select(F.lit("").alias("field"), F.lit("").alias("term"), F.col(record).alias("record")))
    all_records = every.agg(F.sum("records")).scalar()
    n = F.col("records")
    mark = F.when(n <= rare, "rare").when(n > common * all_records, "common")
    return totals.select("field", "term", "occurrences", "records", mark.alias("mark"))


def _counters(tokens: DataFrame) -> DataFrame:
    """Partial counters (field, term, occurrences, records) of the tokens (field, term, record)."""
    combined = T.StructType(
        [
            T.StructField("field", T.StringType()),
            T.StructField("term", T.StringType()),
            T.StructField("record", tokens.schema["record"].dataType),
            T.StructField("n", T.LongType()),
        ]
    )
    salts = max(SALTS, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        tokens.withColumn("n", F.lit(1).cast("bigint"))
        .mapInArrow(_combine, combined)
        .repartition("field", "term", F.pmod(F.xxhash64("record"), F.lit(salts)))
        .sortWithinPartitions("field", "term", "record")
        .mapInArrow(_count, "field string, term string, occurrences bigint, records bigint")
    )
