import collections
import random

from marquetry.llm import frequency
from marquetry.llm.frequency import term_frequencies

KIND = "id bigint, tags array<string>, field string, term int"


def brute(rows):
    occurrences, records = collections.Counter(), collections.defaultdict(set)
    for rec, tags, *_ in rows:
        for t in tags or []:
            p = " ".join((t or "").lower().split())
            if p:
                occurrences[p] += 1
                if rec is not None:
                    records[p].add(rec)
    n = len({r[0] for r in rows if r[0] is not None})
    mark = lambda k: "rare" if k <= 2 else "common" if k > 0.2 * n else None
    return {t: (c, len(records[t]), mark(len(records[t]))) for t, c in occurrences.items()}


def run(spark, rows, parts=3):
    df = spark.createDataFrame(rows, KIND).repartition(parts)
    return {r["term"]: (r["occurrences"], r["records"], r["mark"]) for r in term_frequencies(df, "id", ["tags"]).collect()}


def test_against_sets(spark):
    random.seed(3)
    words = ["Drama", " drama ", "Sci-Fi", "sci-fi", "DRAMA", "", " ", None, "film  noir", "Film Noir", *"abcdefgh"]
    rows = [(random.choice([None, *range(40)]), random.choice([None, [], [random.choice(words) for _ in range(5)]]), "x", 1) for _ in range(400)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, 1) == brute(rows)


def test_hot_term_and_record(spark):
    rows = [(7, ["hot"] * 3, "x", 1)] * 300 + [(i, ["hot", f"t{i}"], "x", 1) for i in range(50)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, None, None, None)]) == {}


def test_counters_across_batches():
    import pyarrow as pa

    rows = [("f", "a", 1, 1), ("f", "a", 1, 2), ("f", "a", 2, 1), ("f", "b", None, 1), ("f", "b", None, 1), ("f", "b", 5, 1), ("g", "b", 5, 1)]

    def batches(size):
        for i in range(0, len(rows), size):
            yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c) for k, c in enumerate(zip(*rows[i : i + size]))], names=["field", "term", "record", "n"])

    for size in (2, 3, 7):
        out = [tuple(r.values()) for b in frequency._count(batches(size)) for r in b.to_pylist()]
        assert out == [("f", "a", 4, 2), ("f", "b", 3, 1), ("g", "b", 1, 1)]
