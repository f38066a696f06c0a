"""Variant spellings of names linked by merge-and-rematch resolution (problem 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions.text import plain_form
from marquetry.llm.edits import PAIRS, close_pairs, deletion_keys, text_hash
from marquetry.llm.graph import components, relabel
from marquetry.llm.names import SHORT_FORMS, Form, by_short_form, name_form, skeleton
from marquetry.sources.scratch import Scratch

FORM = "spelling string, plain string, keys array<string>, middles array<string>, asks array<string>, offers array<string>, soft array<string>, certain boolean, lone boolean"
FIELDS = [f.split()[0] for f in FORM.split(", ")]
# Texts that say that nothing is known.
UNKNOWN = ("", "unknown", "n/a", "none", "?")
# Names known at a time by a task that parses them.
CACHED = 100_000


def _blocks(f: Form) -> tuple[list[str], list[str]]:
    """(asks, offers): the blocks in which an abbreviated name looks for a full one, and those in which it is found."""
    offers = [f"k|{k}" for k in f.keys if not f.soft]
    if f.spelling and f.family:
        offers += [f"i|{f.family}|{x}" for x in f.letters]
    asks = [f"i|{f.family}|{f.initial}"] if f.initial else sorted({f"k|{skeleton(x)}" for x in f.soft})
    return asks, offers


def _parser(columns: list[str], aliases: dict[str, list[str]]):
    """Batches with the parsed form of the column `name` (last) in its place."""
    kinds = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "boolean": pa.bool_()}
    types = [kinds[f.split()[1]] for f in FORM.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            rows = []
            for name in batch.column(len(columns)).to_pylist():
                if name not in known:
                    if len(known) >= CACHED:
                        known.clear()
                    f = name_form(name, aliases)
                    asks, offers = _blocks(f)
                    known[name] = (f.spelling, f.plain, f.keys, f.middles, asks, offers, f.soft, bool(f.spelling) and not f.soft, bool(f.initial))
                rows.append(known[name])
            fields = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(v, t) for v, t in zip(fields, types))], names=[*columns, *FIELDS])

    return run


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, key, mark) rows of the spellings and of the plain letters of names (g, spelling, plain, soft, node); a null
    spelling is that of the letters."""
    for batch in batches:
        groups, spelling, plain = (batch.column(i).to_pylist() for i in range(3))
        soft, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
        of = {g: (text_hash(f"s{g}"), text_hash(f"p{g}")) for g in set(groups)}
        spelling = [skeleton(p) if s is None else s for s, p in zip(spelling, plain)]
        for k, words in enumerate((spelling, plain)):
            index, key, mark = deletion_keys(words, np.array([of[g][k] for g in groups], np.uint64), soft.astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(node[index]), pa.array(key), pa.array(mark)], names=["node", "key", "mark"])


def _agreement(weights: dict[str, float], a: str, b: str) -> Column:
    """Sum of the weights of attributes that two profiles share, less those in which they have nothing in common."""
    total = F.lit(0.0)
    for i, w in enumerate(weights.values()):
        x, y = F.col(f"{a}.a{i}"), F.col(f"{b}.a{i}")
        known = (F.size(x) > 0) & (F.size(y) > 0)
        total = total + F.when(known & F.arrays_overlap(x, y), w).when(known, -w).otherwise(0.0)
    return total


def _union(c: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)


def _profiles(rows: DataFrame, key: Column, lists: list[str]) -> DataFrame:
    """Profiles `p` with the united lists of their rows."""
    full = [F.max("certain").alias("certain"), F.first("g").alias("g")]
    return rows.groupBy(key.alias("p")).agg(*full, *map(_union, lists))


def _relabelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Close pairs of nodes as pairs of profiles; those now in one profile go."""
    out = relabel(relabel(pairs, "m", labels), "n", labels).filter("m <> n")
    return out.groupBy(F.least("m", "n").alias("m"), F.greatest("m", "n").alias("n")).agg(F.min("strict").alias("strict"), F.min("soft").alias("soft"))


def _agreeing(profile: DataFrame, close: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Close pairs whose attributes do not speak against them, with how far they agree, whether middle names clash, and
    which of the two are abbreviated."""
    traits = [*(f"a{i}" for i in range(len(weights))), "middles", "certain"]
    left, right = profile.select(F.col("p").alias("m"), F.struct(*traits).alias("x")), profile.select(F.col("p").alias("n"), F.struct(*traits).alias("y"))
    met = close.join(left, "m").join(right, "n").withColumn("agree", _agreement(weights, "x", "y")).filter("agree >= 0")
    return met.select("m", "n", "strict", "soft", "agree", _clash().alias("clash"), (~F.col("x.certain")).alias("m_short"), (~F.col("y.certain")).alias("n_short"))


def _clash() -> Column:
    return (F.size("x.middles") > 0) & (F.size("y.middles") > 0) & ~F.arrays_overlap("x.middles", "y.middles")


def _abbreviations(profile: DataFrame, met: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(a, b): abbreviated profiles, with initials or short forms that stand for several names, and the profile each is
    of. That is the only one in its blocks, or one edit from a name it may stand for, whose attributes agree best, as
    long as they do agree; for a short form the only full name there is suffices.

    Profiles of a block that are alike in all that counts here meet the others as one, so a frequent family name
    costs no more pairs than it has combinations of attributes.
    """
    traits = [*(f"a{i}" for i in range(len(weights))), "middles"]
    least = min(weights.values(), default=0.0)
    lone = profile.filter("not certain and size(asks) > 0").select("p", F.struct(*traits).alias("x"), "g", F.explode("asks").alias("block"))
    known = profile.filter("size(offers) > 0").select("p", *traits, "certain", "g", F.explode("offers").alias("block"))
    alike = known.groupBy("g", "block", "certain", *traits).agg(F.min("p").alias("q"), F.count("*").alias("n"))
    alike = alike.select("g", "block", "certain", "q", "n", F.struct(*traits).alias("y"))
    meet = lone.join(alike, ["g", "block"]).filter("p <> q or n > 1").withColumns({"agree": _agreement(weights, "x", "y"), "short": F.col("block").startswith("k|")})
    meet = meet.filter((F.col("agree") >= least) | F.col("short")).select("p", "q", "n", "agree", _clash().alias("clash"), "certain", "short", F.lit(True).alias("exact"))
    ends = F.array(*(F.struct(F.col(f"{p}_short").alias("asks"), F.col(p).alias("p"), F.col(q).alias("q"), (~F.col(f"{q}_short")).alias("certain")) for p, q in ("mn", "nm")))
    near = met.filter("soft").select(F.explode(ends).alias("e"), "agree", "clash").filter("e.asks")
    meet = meet.union(near.select("e.p", "e.q", F.lit(1).cast("bigint"), "agree", "clash", "e.certain", F.lit(True), F.lit(False)))
    # agreement, then a name in full before one edit off, then one that is itself no abbreviation
    rank = F.col("agree") - F.when(F.col("clash"), 0.5).otherwise(0.0) + F.when(F.col("exact"), 0.2).otherwise(0.0) + F.when(F.col("certain"), 0.1).otherwise(0.0)
    meet = meet.withColumn("rank", rank)
    best = meet.groupBy("p").agg(
        F.max(F.struct("rank", "q", "agree", "clash", "certain", "short")).alias("t"), F.max(F.struct("rank", -F.col("q"))).alias("u"), F.max(F.struct("rank", "n")).alias("v"),
        F.count("*").alias("all"), F.count_if("certain").alias("full"),
    )
    only = (F.col("t.q") == -F.col("u.col2")) & (F.col("v.n") == 1)
    single = F.when(F.col("full") > 0, (F.col("full") == 1) & F.col("t.certain")).otherwise(F.col("all") == 1)
    sure = (F.col("t.agree") - F.when(F.col("t.clash"), 0.5).otherwise(0.0) >= least) | (F.col("t.short") & single)
    return best.filter(only & sure).select(F.col("p").alias("a"), F.col("t.q").alias("b"))


def resolve_names(
    spark: SparkSession, df: DataFrame, key: str, name: str, weights: dict[str, float], within: str | None = None, short_forms: dict[str, str] = SHORT_FORMS
) -> DataFrame:
    """(key, entity): the rows of `df` with the entity (least key of it) that their names stand for.

    weights: columns that mostly agree between rows of one entity, and what agreement counts. within: only rows with
    equal values of this column can be one entity. short_forms: full given names with the short forms they go by.
    Written names become forms (see `names`), equal forms one node with the sets of their attributes. (1) A shared full
    key merges nodes into profiles at once. Then profiles meet in blocks, in turn until nothing merges: (2) full
    spellings one edit apart, found by shared deletion keys, merge unless their attributes speak against it (names of
    five letters or fewer, which have many neighbours, only if their attributes speak for it); (3) an initial, or a
    short form of several names, merges with the only profile of the best agreement (`_abbreviations`). A merged
    profile has the union of spellings, initials and attributes and enters the blocks anew. Merges only lower the
    number of profiles, so this ends; no round is left out.

    Blocks of (2) hold distinct spellings that share all but one letter, those of (3) profiles that differ in their
    attributes, so no block grows with the number of rows: copies are one node before any pair is made.
    A null, empty or blank name is an entity of its own; rows with a null key are left out. Repeated keys keep each
    their row. Names of any length are read whole.
    """
    s = Scratch(spark)
    attrs = {f"a{i}": F.array_except(F.array(plain_form(c)), F.array(*map(F.lit, UNKNOWN))) for i, c in enumerate(weights)}
    group = plain_form(within) if within else F.lit("")
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("rec"), group.alias("g"), *(v.alias(k) for k, v in attrs.items()), F.col(name).alias("name"))
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:  # a small file is parsed by all cores
        rows = rows.repartition(cores)
    columns = ["rec", "g", *attrs]
    schema = f"rec {df.schema[key].dataType.simpleString()}, g string, " + ", ".join(f"{a} array<string>" for a in attrs) + (", " if attrs else "") + FORM
    rows = rows.mapInArrow(_parser(columns, by_short_form(short_forms)), schema)
    # an initial alone does not tell two persons apart, so its node also has the attributes
    own = F.when(F.col("lone"), F.to_json(F.struct(*attrs, F.lit("")))).when(F.col("spelling") == "", F.col("rec").cast("string"))
    same = ["g", "spelling", "plain", "keys", "middles", "asks", "offers", "soft", own]
    rows = s.table(rows.withColumns({"h1": F.xxhash64(*same), "h2": F.xxhash64(F.lit("2"), *same)}))
    lists = ["middles", "asks", "offers", *attrs]
    first = [F.first(c).alias(c) for c in ("g", "spelling", "plain", "keys", "middles", "asks", "offers", "soft", "certain")]
    nodes = s.table(rows.groupBy("h1", "h2").agg(F.min("rec").alias("node"), *first, *map(_union, attrs)))

    # (1) nodes of one full key are one profile, as are abbreviated ones alike in two or more known attributes
    told = sum(((F.size(c) > 0).cast("int") for c in attrs), F.lit(0)) >= 2
    alike = F.when(told & ~F.col("certain"), F.transform("asks", lambda b: F.concat(b, F.to_json(F.struct(*attrs, F.lit(""))))))
    keyed = nodes.select("g", "node", F.explode(F.concat("keys", F.coalesce(alike, F.array().cast("array<string>")))).alias("k"))
    shared = keyed.groupBy("g", "k").agg(F.min("node").alias("b"), F.max("node").alias("c")).filter("b <> c").drop("c")
    edges = s.table(keyed.join(shared, ["g", "k"]).filter("node <> b").select(F.col("node").alias("a"), "b"))
    labels = components(s, edges)
    profile = s.table(_profiles(relabel(nodes, "node", labels), F.col("node"), lists))
    named = nodes.filter("spelling <> ''")
    words = named.filter("certain").groupBy("g", "spelling", "plain").agg(F.min("node").alias("node")).select("g", "spelling", "plain", F.lit(False).alias("soft"), "node")
    read = named.select("g", F.lit(None).cast("string"), F.explode("soft").alias("plain"), F.lit(True), "node")
    near = words.union(read).mapInArrow(_edit_rows, "node bigint, key bigint, mark bigint").repartition("key").sortWithinPartitions("key").mapInArrow(close_pairs, PAIRS)
    close = s.table(_relabelled(near, labels))
    entity = relabel(nodes.select("h1", "h2", F.col("node").alias("entity")), "entity", labels)
    while True:
        # (2) full spellings one edit apart, if there are none (3) initials and short forms
        met = s.table(_agreeing(profile, close, weights))
        fits = met.filter("not soft and (agree > 0 or not strict)").select(F.col("m").alias("a"), F.col("n").alias("b"))
        if fits.isEmpty():
            fits, n = s.counted(_abbreviations(profile, met, weights))
            if not n:
                break
        labels = components(s, fits)
        entity = relabel(entity, "entity", labels)
        profile = s.table(_profiles(relabel(profile, "p", labels), F.col("p"), lists))
        close = s.table(_relabelled(close, labels))
    return s.result(rows.select("rec", "h1", "h2").join(entity, ["h1", "h2"]).select(F.col("rec").alias(key), "entity"))


def linked_pairs(resolved: DataFrame, key: str) -> DataFrame:
    """All pairs of rows of one entity: (key_a, key_b) with key_a < key_b."""
    a = resolved.select("entity", F.col(key).alias(f"{key}_a"))
    b = resolved.select("entity", F.col(key).alias(f"{key}_b"))
    return a.join(b, "entity").filter(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b")
