"""The queries of the problems on text collections and names, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions.text import plain_form
from marquetry.llm.frequency import term_frequencies
from marquetry.llm.matching import match_entities
from marquetry.llm.mixing import mix_sources, shares_reached
from marquetry.llm.packing import pack_items
from marquetry.llm.reading import reading_levels, reading_model, reading_report
from marquetry.llm.resolve import linked_pairs, resolve_names
from marquetry.llm.tokens import token_counts
from marquetry.session import table
from marquetry.sources.scratch import stored

ARRAYS = ["genres", "tone", "secondary_audiences"]


def p1_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of the array columns with its occurrences, films and mark."""
    return term_frequencies(table(spark, sf_dir, "synopses_extracted"), "film_id", ARRAYS)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms too rare or too common to serve as a feature."""
    return p1_frequencies(spark, sf_dir).filter("mark is not null").select("field", "term", "mark")


def p8_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text, or piece of a text that exceeds the capacity, in a training sequence of each capacity."""
    sizes = token_counts(table(spark, sf_dir, "documents"), "doc_id", "text")
    items = stored(spark, sizes.select(F.col("doc_id").alias("doc"), "tokens"))
    out = None
    for r in table(spark, sf_dir, "pack_sizes").orderBy("capacity_tokens").collect():  # three rows, of fixed number
        packed = pack_items(spark, items, r["capacity_tokens"]).withColumnRenamed("doc", "doc_id")
        packed = packed.select(F.lit(r["pack_name"]).alias("pack_name"), F.lit(r["capacity_tokens"]).alias("capacity"), "*")
        out = packed if out is None else out.union(packed)
    return out


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each capacity the sequences used, the fewest possible by size, and the share of room filled."""
    bins = p8_sequences(spark, sf_dir).filter("sequence is not null").groupBy("pack_name", "capacity", "sequence").agg(F.sum("tokens").alias("fill"))
    total = bins.groupBy("pack_name", "capacity").agg(F.count("*").alias("sequences"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest"))
    least = F.ceil(F.col("tokens") / F.col("capacity"))
    return total.select("pack_name", "capacity", "sequences", least.alias("least"), "tokens", "fullest", (F.col("tokens") / (F.col("sequences") * F.col("capacity"))).alias("filled"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[dict]]:
    targets = table(spark, sf_dir, "mix_targets")
    docs = table(spark, sf_dir, "documents").join(F.broadcast(targets.select("source")), "source", "left_semi")
    sizes = token_counts(docs, "doc_id", "text", "source").withColumnRenamed("doc_id", "doc")
    return mix_sources(spark, stored(spark, sizes), targets)


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture with their copies."""
    return _mix(spark, sf_dir)[0].withColumnRenamed("doc", "doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of all tokens that each source reaches, beside its target."""
    return shares_reached(spark, *_mix(spark, sf_dir))


def _reading_model(spark: SparkSession, sf_dir: str):
    return reading_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"), "doc_id", "text", "source", "band")


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its calibrated reading grade and band."""
    return reading_levels(table(spark, sf_dir, "documents"), _reading_model(spark, sf_dir), "doc_id", "text")


def p10_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the model grades sources that it has not seen."""
    return reading_report(spark, _reading_model(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the easiest and the hardest band."""
    return p10_levels(spark, sf_dir).filter("band in (1, 5)").select("doc_id", "band")


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus by source and band."""
    levels = p10_levels(spark, sf_dir).filter("band is not null")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(levels, "doc_id").groupBy("source", "band").agg(F.count("*").alias("docs"), F.avg("level").alias("level"))


_TERMS = r"""
with every as (select count(distinct film_id) as n from synopses_extracted),
t as (
  select 'genres' as field, film_id, unnest(genres) as raw from synopses_extracted union all
  select 'tone', film_id, unnest(tone) from synopses_extracted union all
  select 'secondary_audiences', film_id, unnest(secondary_audiences) from synopses_extracted),
p as (select field, film_id, lower(trim(regexp_replace(raw, '\s+', ' ', 'g'))) as term from t),
c as (select field, term, count(*) as occurrences, count(distinct film_id) as records from p where term <> '' group by all),
m as (select field, term, occurrences, records,
  case when records <= 2 then 'rare' when records > 0.2 * every.n then 'common' end as mark from c, every)
"""

# How far a title picked by an earlier run is trusted, by the confidence it was given.
TRUST = {"manual": 1.0, "exact": 0.95, "high": 0.85, "medium": 0.75, "low": 0.6}


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each film of tmdb_cache with its catalogue entry, if there is one, and the confidence of the match."""
    films = table(spark, sf_dir, "films").groupBy("film_id").agg(
        F.collect_set("director").alias("directors"), F.collect_set(F.date_format("rel_at", "yyyy-MM-dd")).alias("rels")
    )
    meta = table(spark, sf_dir, "film_meta").select(
        "film_id", "title", "release_date", F.col("director").alias("meta_director"), F.col("studios.name").alias("meta_studios")
    )
    given = plain_form("match_confidence")
    trust = F.coalesce(*(F.when(given == k, F.lit(v)) for k, v in TRUST.items()))
    none = F.array().cast("array<string>")
    joined = table(spark, sf_dir, "tmdb_cache").join(films, "film_id", "left").join(meta, "film_id", "left")
    left = joined.select(
        F.col("film_id").alias("id"),
        F.array("film", "title", "tmdb_title").alias("titles"),
        F.array(F.lit(1.0), F.lit(1.0), trust).alias("trusts"),
        F.concat(F.coalesce("rels", none), F.array("release_date")).alias("dates"),
        F.concat(F.coalesce("directors", none), F.array("meta_director")).alias("people"),
        F.concat(F.coalesce("studios", none), F.coalesce("meta_studios", none)).alias("companies"),
    )
    right = table(spark, sf_dir, "tmdb_catalog").select(
        F.col("tmdb_id").alias("id"),
        F.array("title", "original_title").alias("titles"),
        F.array(F.lit(1.0), F.lit(1.0)).alias("trusts"),
        F.array("release_date").alias("dates"),
        F.array("director").alias("people"),
        F.col("production_companies").alias("companies"),
    )
    matched = match_entities(spark, left, right)
    return matched.select(F.col("id").alias("film_id"), F.col("other").alias("tmdb_id"), "confidence")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The films and catalogue entries that are the same work."""
    return p3_matches(spark, sf_dir).select("film_id", "tmdb_id")


# What agreement in a column counts for two rows of people being one person.
PEOPLE = {"primary_market": 1.0, "age_range": 1.0, "tier": 0.5}


def p7_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the two tables of people with its entity."""
    cast = table(spark, sf_dir, "cast_enriched").select(
        F.lit("cast").alias("tbl"), "rec_id", F.col("actor_name").alias("name"), "primary_market", "age_range", F.col("fame_tier").alias("tier")
    )
    directors = table(spark, sf_dir, "director_enriched").select(
        F.lit("director").alias("tbl"), "rec_id", F.col("director_name").alias("name"), "primary_market",
        F.lit(None).cast("string").alias("age_range"), F.col("director_tier").alias("tier"),
    )
    return resolve_names(spark, cast.union(directors), "rec_id", "name", PEOPLE, within="tbl")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows of one table that name the same person."""
    return linked_pairs(p7_entities(spark, sf_dir), "rec_id")


def p8_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the sequences: every document is there, none is over its capacity, none cut that would fit."""
    packed = p8_sequences(spark, sf_dir)
    fill = packed.filter("sequence is not null").groupBy("pack_name", "capacity", "sequence").agg(F.sum("tokens").alias("n"))
    over = fill.groupBy("pack_name").agg(F.count_if(F.col("n") > F.col("capacity")).alias("over_full"))
    docs = packed.groupBy("pack_name", "capacity", "doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("n"))
    docs = docs.groupBy("pack_name").agg(F.count("*").alias("docs"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity"))).alias("cut_needlessly"))
    return docs.join(over, "pack_name")


def p9_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the mixture: every listed source is reported, and none is repeated too often. How near a share
    comes depends on the longest document, so it is left to p9_shares."""
    kept = F.col("copies") <= F.col("max_repeats") * F.col("docs")
    return p9_shares(spark, sf_dir).select("source", kept.alias("repeats_kept"))


def p7_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the entities: every row has one, its least row."""
    return p7_entities(spark, sf_dir).agg(F.count("*").alias("rows"), F.count_distinct("rec_id").alias("ids"), F.count_if(F.col("entity") > F.col("rec_id")).alias("not_least"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_frequencies, p3_found, p3_matches, p7_found, p7_entities, p8_sequences, p8_fill, p9_mixture, p9_shares, p10_found, p10_levels, p10_profile, p10_report, p7_kept, p8_kept, p9_kept)
}
SQL = {
    "p1_found": _TERMS + "select field, term, mark from m where mark is not null",
    "p1_frequencies": _TERMS + "select * from m",
    "p7_kept": "select count(*) as rows, count(distinct rec_id) as ids, 0::bigint as not_least from (select rec_id from cast_enriched union all select rec_id from director_enriched)",
    "p8_kept": "select pack_name, (select count(distinct doc_id) from documents) as docs, 0::bigint as over_full, 0::bigint as cut_needlessly from pack_sizes",
    "p9_kept": "select source, true as repeats_kept from mix_targets",
}
