"""Queries of the engine's operators over the project's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquetry.functions import entities as E
from marquetry.functions import jsonx as J
from marquetry.functions import titles as X
from marquetry.functions.text import strip
from marquetry.operators import curate, encode, profile, upsert, variants
from marquetry.session import table
from marquetry.sources import warehouse

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


RANK_SQL = "case snapshot when 'train' then 0 when 'test' then 1 else 2 end"
FIRST_SQL = f"(select * from (select *, row_number() over (partition by film_id order by {RANK_SQL}, record_id) as nth from films) where nth = 1)"
STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"


def rank():
    """The order of the snapshots."""
    return F.expr(RANK_SQL)


def first_films(spark: SparkSession, d: str) -> DataFrame:
    return curate.keep_first(table(spark, d, "films"), ["film_id"], [rank(), F.col("record_id")])


# curation


@query(f"select film_id, record_id, dstbtr, synopsis from {FIRST_SQL} where length(synopsis) >= 5")
def curate_films(spark, d):
    """The first copy of each film over train, test and prediction, kept if its synopsis is usable."""
    return first_films(spark, d).filter(curate.usable("synopsis")).select("film_id", "record_id", "dstbtr", "synopsis")


@query(
    f"""with old as (select film_id, list_distinct(list(coalesce(synopsis, ''))) as texts from synopses_extracted group by 1)
    select f.film_id, case when old.film_id is null then 'new' else 'changed' end as change from {FIRST_SQL} f left join old using (film_id)
    where old.film_id is null or len(list_filter(texts, lambda t: t <> coalesce(f.synopsis, ''))) > 0"""
)
def synopsis_changes(spark, d):
    """Films that are new to the extracted table or whose synopsis changed since."""
    return curate.detect_changes(first_films(spark, d), table(spark, d, "synopses_extracted"), "film_id", "synopsis").select("film_id", "change")


SKIPPED = ["Quillhouse Releasing", "Marrow Film Distributors", "Rookery Film Distributors"]


@query(
    f"""select film_id, dstbtr from {FIRST_SQL} where (dstbtr is null or dstbtr not in ({", ".join(f"'{s}'" for s in SKIPPED)}))
    and film_id not in (select film_id from film_meta)"""
)
def pending_films(spark, d):
    """Films still to be enriched: not of a skipped distributor (an unknown one passes) and not in film_meta."""
    films = first_films(spark, d).filter(curate.not_among("dstbtr", SKIPPED))
    return curate.pending(films, [table(spark, d, "film_meta")], "film_id").select("film_id", "dstbtr")


@query("select doc_id, source, n_chars from documents where doc_id in (select doc_id from reading_labels)")
def documents_in_scope(spark, d):
    return curate.in_scope(table(spark, d, "documents"), table(spark, d, "reading_labels"), "doc_id").select("doc_id", "source", "n_chars")


NAMES_SQL = """list_filter(list_transform(
  case when {0} like '[%' and try_cast({0} as json) is not null then json_extract_string(try_cast({0} as json), '$[*]') else string_split(coalesce({0}, ''), '|') end,
  lambda n: regexp_replace(regexp_replace(regexp_replace(upper(trim(n)), '^AND\\s+', ''), '^\\s+', ''), '\\s+$', '')), lambda n: n not in ('', 'AND', 'N/A') and length(n) > 1)"""
COUNTS_SQL = f"""with once as (select * from (select *, row_number() over (partition by snapshot, film_id order by record_id) as nth from films) where nth = 1),
a as (select snapshot, unnest({NAMES_SQL.format("trim(actor_list)")}) as actor from once),
c as (select snapshot, {RANK_SQL} as source_rank, actor, count(*) as film_count from a group by 1, 2, 3)"""


def _actor_counts(spark, d):
    once = curate.keep_first(table(spark, d, "films"), ["snapshot", "film_id"], [F.col("record_id")])
    actors = once.select("snapshot", rank().alias("source_rank"), F.explode(E.actor_names("actor_list")).alias("actor"))
    return actors.groupBy("snapshot", "source_rank", "actor").agg(F.count("*").alias("film_count"))


@query(COUNTS_SQL + " select actor, sum(film_count)::bigint as film_count from c group by 1 having sum(film_count) >= 2")
def actor_film_counts(spark, d):
    """Films of each actor, added over the snapshots, of two at least."""
    return _actor_counts(spark, d).groupBy("actor").agg(F.sum("film_count").alias("film_count")).filter("film_count >= 2")


@query(COUNTS_SQL + " select actor, film_count, snapshot from (select *, row_number() over (partition by actor order by source_rank) as nth from c) where nth = 1")
def combined_counts(spark, d):
    """Films of each actor by the first snapshot that has the actor."""
    return curate.keep_first(_actor_counts(spark, d), ["actor"], [F.col("source_rank")]).select("actor", "film_count", "snapshot")


@query(
    f"""with a as (select distinct unnest({NAMES_SQL.format("trim(actor_list)")}) as actor from films)
    select actor from a where actor not in (select upper(trim(actor_name)) from cast_enriched)"""
)
def actor_diff(spark, d):
    """Actors of films that the table of actors lacks, in upper case."""
    actors = table(spark, d, "films").select(F.explode(E.actor_names("actor_list")).alias("actor")).distinct()
    return curate.pending(actors, [table(spark, d, "cast_enriched").select(F.upper(strip("actor_name")).alias("actor"))], "actor")


@query(
    """with x as (select distinct trim(unnest(case when trim(director) like '[%' and try_cast(director as json) is not null then json_extract_string(try_cast(director as json), '$[*]')
      else string_split_regex(director, '[|,]') end)) as director from films where director is not null)
    select director from x where director <> '' and director not in (select trim(director_name) from director_enriched where director_name is not null)"""
)
def director_diff(spark, d):
    """Directors of films that the table of directors lacks, in their case."""
    names = table(spark, d, "films").select(F.explode(E.director_names("director")).alias("director")).distinct()
    return curate.pending(names, [table(spark, d, "director_enriched").select(strip("director_name").alias("director"))], "director")


@query(
    """select film_id, 'left_only' as side from film_meta where film_id not in (select film_id from film_meta_wh)
    union all select film_id, 'right_only' from film_meta_wh where film_id not in (select film_id from film_meta)"""
)
def key_sync_diff(spark, d):
    return curate.key_differences(table(spark, d, "film_meta"), table(spark, d, "film_meta_wh"), "film_id")


@query(
    """select film_id, film, 'cache' as cohort from tmdb_cache where film_id not in (select film_id from film_meta)
    union all select film_id, title, 'meta' from film_meta"""
)
def cohort_override(spark, d):
    sample = table(spark, d, "tmdb_cache").select("film_id", "film", F.lit("cache").alias("cohort"))
    return curate.replace_cohort(sample, table(spark, d, "film_meta").select("film_id", F.col("title").alias("film"), F.lit("meta").alias("cohort")), "film_id")


@query()
def seeded_sample(spark, d):
    """A sample is the feature: twenty films, those of the cache's manual picks first."""
    manual = table(spark, d, "tmdb_cache").filter("match_confidence = 'manual'").select("film_id").orderBy("film_id").limit(5)
    return curate.seeded_sample(first_films(spark, d).select("film_id", "film"), "film_id", 20, pinned=manual)


@query("select batch::bigint as batch, count(*) as n, min(doc_id) as first_id from (select doc_id, (row_number() over (order by doc_id) - 1) // 25 as batch from documents) group by 1")
def checkpoint_batches(spark, d):
    """Documents in batches of 25 by id."""
    rows = curate.chunked(table(spark, d, "documents").select("doc_id"), [F.col("doc_id")])
    return rows.groupBy("batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


# merging


def _generations(spark, d):
    films = table(spark, d, "films").select("film_id", "record_id", "dstbtr", "snapshot")
    return films.filter("snapshot = 'train'"), films.filter("snapshot = 'prediction'")


def _upsert_sql(winner: str, order: str) -> str:
    loser = "prediction" if winner == "train" else "train"
    pick = f"select film_id, record_id, dstbtr, snapshot from (select *, row_number() over (partition by film_id order by record_id {order}) as nth from films where snapshot = '{{0}}') where nth = 1"
    return f"with w as ({pick.format(winner)}), l as ({pick.format(loser)}) select * from w union all select * from l where film_id not in (select film_id from w)"


@query(_upsert_sql("prediction", "asc"))
def upsert_new_wins(spark, d):
    return upsert.upsert(*_generations(spark, d), ["film_id"], "new_wins", [F.col("record_id")])


@query(_upsert_sql("train", "asc"))
def upsert_existing_wins(spark, d):
    return upsert.upsert(*_generations(spark, d), ["film_id"], "existing_wins", [F.col("record_id")])


@query(_upsert_sql("prediction", "desc"))
def upsert_last_wins(spark, d):
    return upsert.upsert(*_generations(spark, d), ["film_id"], "last_wins", [F.col("record_id")])


@query(
    """select coalesce(s.film_id, t.film_id) as film_id, case when s.film_id is not null then s.title else t.title end as title, t.director,
    case when s.film_id is not null then s.budget_usd else t.budget_usd end as budget_usd from film_meta_wh t full join film_meta s on s.film_id = t.film_id"""
)
def merge_by_name(spark, d):
    target = table(spark, d, "film_meta_wh").select("film_id", "title", "director", "budget_usd")
    return upsert.merge_by_name(target, table(spark, d, "film_meta").select("film_id", "title", "budget_usd"), "film_id")


@query("select extract_id, film_id from synopses_extracted where film_id in (select film_id from synopses_extracted group by 1 having count(*) = 1)")
def staging_dedupe(spark, d):
    """Rows of films extracted once; all copies of others go."""
    return upsert.drop_repeated_keys(table(spark, d, "synopses_extracted"), "film_id").select("extract_id", "film_id")


@query("select extract_id, film_id from (select *, row_number() over (partition by film_id order by extracted_at desc, extract_id) as nth from synopses_extracted) where nth = 1")
def staging_keep_latest(spark, d):
    return upsert.keep_latest(table(spark, d, "synopses_extracted"), "film_id", "extracted_at", "extract_id").select("extract_id", "film_id")


@query(
    """with e as (select distinct film_id::varchar as key, 'synopsis missing' as _error from films where synopsis is null and film_id not in (select film_id from film_meta)),
    b as (select distinct film_id::varchar as key, 'director missing' as _error from films where director is null)
    select * from b union all select * from e where key not in (select key from b)"""
)
def ledger_merge(spark, d):
    """The ledger of missing synopses without films that film_meta has recovered, and with the batch of missing directors."""
    films = table(spark, d, "films")
    missing = lambda c: films.filter(F.col(c).isNull()).select(F.col("film_id").cast("string").alias("key"), F.lit(f"{c} missing").alias("_error")).distinct()
    recovered = table(spark, d, "film_meta").select(F.col("film_id").cast("string").alias("key"))
    return upsert.merge_ledger(missing("synopsis"), missing("director"), recovered, "key")


@query(
    """select e.extract_id, coalesce(m.title, e.title) as title,
    array_to_string(case when m.genres is null then e.genres else list_concat(list_distinct_keep(coalesce(e.genres, [])), []) end, '|') as genres
    from synopses_extracted e left join film_meta m using (film_id)""".replace("list_concat(list_distinct_keep(coalesce(e.genres, [])), [])", "(select list(x order by i) from (select x, min(i) as i from (select unnest(list_concat(coalesce(e.genres, []), m.genres)) as x, generate_subscripts(list_concat(coalesce(e.genres, []), m.genres), 1) as i) group by x))")
)
def override_patch(spark, d):
    """Extracted films with titles replaced and genres appended from film_meta."""
    patches = table(spark, d, "film_meta").select("film_id", "title", "genres")
    out = upsert.patch(table(spark, d, "synopses_extracted"), patches, "film_id", scalars=["title"], append=["genres"])
    return out.select("extract_id", "title", F.array_join("genres", "|").alias("genres"))


# warehouse statements


STAR = """select distinct o.o_orderkey, coalesce(c.c_name, 'none') as customer, n1.n_name as nation_1, n2.n_name as nation_2, r.r_name as region,
  case when c.c_mktsegment = 'BUILDING' then null else c.c_mktsegment end as other_segment, weekofyear(o.o_orderdate) as week, month(o.o_orderdate) as month,
  {starts}(o.o_orderpriority, '1') as urgent
  from orders o left join customer c on c.c_custkey = o.o_custkey left join nation n1 on n1.n_nationkey = c.c_nationkey
  left join nation n2 on n2.n_nationkey = c.c_nationkey + 1 left join region r on r.r_regionkey = n1.n_regionkey where o.o_orderdate is not null"""


def _views(spark, d, *names):
    return {n: table(spark, d, n) for n in names}


def _run(spark, d, sql, names, **args):
    """A statement over tables given by name as parameters, so no temporary views are left in the session."""
    return spark.sql(sql, args=args, **_views(spark, d, *names)) if args else spark.sql(sql, **_views(spark, d, *names))


def _braced(sql: str, *names: str) -> str:
    import re

    for n in names:
        sql = re.sub(rf"(from|join) {n}\b", rf"\1 {{{n}}}", sql)
    return sql


@query(STAR.format(starts="starts_with"))
def film_details_star(spark, d):
    """A fact with five dimension joins, one dimension twice, distinct."""
    names = ("orders", "customer", "nation", "region")
    return _run(spark, d, _braced(STAR.format(starts="startswith"), *names), names)


TWO_HOP = """select e.extract_id, e.film_id, e.narrative_scope, coalesce(m.title, f.film) as title, coalesce(m.description, f.tmdb_title) as synopsis
  from synopses_extracted e left join tmdb_cache f on f.film_id = e.film_id left join film_meta m on m.film_id = f.film_id"""


@query(TWO_HOP)
def two_hop_titles(spark, d):
    names = ("synopses_extracted", "tmdb_cache", "film_meta")
    return _run(spark, d, _braced(TWO_HOP, *names), names)


WEEKS = [("2026-04-22", "2026-04-29"), ("2026-05-07", "2026-05-13"), ("2026-05-21", "2026-05-27")]


@query(
    f"""with w(first, last) as (values {", ".join(f"('{a}', '{b}')" for a, b in WEEKS)}),
    f as (select distinct w.first as release_date, film_id, film from films join w on rel_at >= w.first::timestamp and rel_at <= w.last::timestamp where not upper(film) like 'GC %')
    select (select count(distinct release_date) from f g where g.release_date <= f.release_date)::int as release_id, release_date,
    (row_number() over (partition by release_date order by film, film_id))::int as film_no, film_id, film from f"""
)
def release_windows(spark, d):
    """Films of several release windows, a table of parameters, numbered within each; windows without films have no number."""
    weeks = spark.createDataFrame(WEEKS, "release_date string, last string")
    films = table(spark, d, "films").select("film_id", "film", "rel_at").join(F.broadcast(weeks), F.col("rel_at").between(F.col("release_date").cast("timestamp"), F.col("last").cast("timestamp")))
    films = films.filter(~F.upper("film").startswith("GC ")).select("release_date", "film_id", "film").distinct()
    # the windows that have films are no more than the parameters
    ids = films.select("release_date").distinct().withColumn("release_id", F.dense_rank().over(Window.orderBy("release_date")))
    number = F.row_number().over(Window.partitionBy("release_date").orderBy("film", "film_id"))
    return films.withColumn("film_no", number).join(F.broadcast(ids), "release_date").select("release_id", "release_date", "film_no", "film_id", "film")


@query("select distinct film_id, film from films where rel_at between timestamp '2025-05-01' and timestamp '2025-05-07' and not film ilike 'GC %'")
def films_by_release(spark, d):
    """Films of the week from a bound date."""
    sql = "select distinct film_id, film from {films} where rel_at between :day and dateadd(day, 6, :day) and not film ilike 'GC %'"
    import datetime

    return spark.sql(sql, args={"day": datetime.datetime(2025, 5, 1)}, films=table(spark, d, "films"))


@query("select film_id, film, dstbtr from tmdb_cache join (select distinct film_id, dstbtr from films) using (film_id) where dstbtr in ('Quillhouse Releasing', 'Marrow Film Distributors')")
def films_of_distributors(spark, d):
    """A list bound as a parameter."""
    films = table(spark, d, "films").select("film_id", "dstbtr").distinct()
    ids = F.array(F.lit("Quillhouse Releasing"), F.lit("Marrow Film Distributors"))
    sql = "select t.film_id, t.film, f.dstbtr from {t} t join {f} f on t.film_id = f.film_id where array_contains(:names, f.dstbtr)"
    return spark.sql(sql, args={"names": ids}, t=table(spark, d, "tmdb_cache"), f=films)


@query(
    """select o_orderkey, o_orderdate from orders where o_orderdate between timestamp '1994-01-01' and timestamp '1995-02-01'
    or o_orderdate between timestamp '1996-12-01' and timestamp '1998-01-01' + interval 28 day"""
)
def boxoffice_window(spark, d):
    """Rows in one of two date ranges that a row of parameters gives."""
    sql = """with params as (select date '1994-01-01' as a, date '1995-02-01' as b, date '1996-12-01' as c, date '1998-01-01' as e)
    select o.o_orderkey, o.o_orderdate from {orders} o where o.o_orderdate between (select a from params) and (select b from params)
    or o.o_orderdate between (select c from params) and (select date_add(e, 28) from params)"""
    return spark.sql(sql, orders=table(spark, d, "orders"))


# titles


def _strip_sql(e: str) -> str:
    return rf"regexp_replace(regexp_replace({e}, '^\s+', ''), '\s+$', '')"


def _quoted(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def _clean_sql() -> str:
    prefix = " ".join(f"when regexp_matches(t, {_quoted(p)}) then {_strip_sql(f'regexp_replace(t, {_quoted(p)}, {_quoted(str())})')}" for p, _ in X.PREFIX_RULES)
    inner = f"select film, n, t as was, case {prefix} else t end as t from p"
    for rule in [*X.BRACKET_RULES, *X.TRAILING_RULES]:
        cut = _strip_sql(f"regexp_replace(t, {_quoted(rule[0])}, '')")
        least = rule[2] if len(rule) == 3 else 0
        cut = f"case when length({cut}) >= {least} then {cut} else t end" if least else cut
        inner = f"select film, n, was, {cut} as t from ({inner})"
    return f"""with recursive p as (select distinct film, {_strip_sql("film")} as t, 0 as n from films where film is not null
    union all select film, t, n + 1 as n from ({inner}) where t <> was) select film, arg_max(t, n) as clean from p group by film"""


def _titles(spark, d):
    return table(spark, d, "films").filter("film is not null").select("film").distinct()


@query(_clean_sql())
def title_clean(spark, d):
    """Every booking title without its noise."""
    return _titles(spark, d).select("film", X.clean_title("film").alias("clean"))


def _tags_sql() -> str:
    parts = []
    t = _strip_sql("film")
    for i, rule in enumerate([*X.PREFIX_RULES, *X.BRACKET_RULES, *X.TRAILING_RULES]):
        hit = f"regexp_matches(t, {_quoted(rule[0])})"
        if len(rule) == 3 and rule[2]:
            hit += f" and length({_strip_sql(f'regexp_replace(t, {_quoted(rule[0])}, {_quoted(str())})')}) >= {rule[2]}"
        parts.append(f"select film, '{rule[1]}' as label, {i} as i, {_strip_sql(f'regexp_extract(t, {_quoted(rule[0])})')} as text from b where {hit}")
    union = " union all ".join(parts)
    return f"""with b as (select distinct film, {t} as t from films where film is not null), x as ({union}),
    y as (select film, label, text from (select *, row_number() over (partition by film, label order by i desc) as nth from x) where nth = 1) select film, label, text from y"""


@query(_tags_sql())
def title_tags(spark, d):
    """The noise marks of every booking title with their text."""
    return _titles(spark, d).select("film", F.explode(X.title_tags("film")).alias("label", "text"))


# The same for the SQL engine's expressions, which know no look-around.
_NO_LOOKING = {r"^[a-z]{2,5}\d{0,2}\s*[-–]\s(?!\s)": r"^[a-z]{2,5}\d{0,2}\s*[-–]\s(?:\S|$)", r"(?<![a-z])iff(?![a-z])": r"(?:^|[^a-z])iff(?:[^a-z]|$)"}


def _hit_sql(pattern: str, value: str = "film") -> str:
    return f"regexp_matches({value}, {_quoted('(?i)' + _NO_LOOKING.get(pattern, pattern))})"


def _flag_sql(tag: str) -> str:
    return "(" + " or ".join(map(_hit_sql, X.KNOWN_PATTERNS[tag])) + ")"


_FLAGS = "select distinct film, " + ", ".join(f"{_flag_sql(t)} as {t}" for t in X.KNOWN_PATTERNS) + " from films where film is not null"
_MATCHED = "case " + " ".join(f"when {_hit_sql(p)} then {_quoted(f'{t}: {p}')}" for t, ps in X.KNOWN_PATTERNS.items() for p in ps) + " else '' end"
_FLAGGED = f"select *, ({' or '.join(X.FESTIVAL_TAGS)}) as is_ff_any, ({' or '.join(X.KNOWN_PATTERNS)}) as any_tag, {' + '.join(f'{t}::bigint' for t in X.KNOWN_PATTERNS)} as n_tags_matched, {_MATCHED} as matched_by from ({_FLAGS})"


def _flagged(spark, d):
    return X.with_title_flags(_titles(spark, d), "film")


@query(_FLAGGED)
def title_flags(spark, d):
    """Every booking title with the known patterns it shows."""
    return _flagged(spark, d)


TAGS = [*X.KNOWN_PATTERNS, "is_ff_any", "any_tag"]


@query(
    f"""with f as ({_FLAGGED}), u as (unpivot (select film, {", ".join(TAGS)} from f) on {", ".join(TAGS)} into name tag value hit), n as (select count(*) as n from f)
    select tag, count(*) filter (hit) as n_matched, round(100.0 * count(*) filter (hit) / any_value(n.n), 2)::double as pct,
    coalesce(array_to_string((list(film order by film) filter (hit))[1:5], ' | '), '') as examples from u, n group by tag"""
)
def title_summary(spark, d):
    """How many titles show each pattern, with the first five. Only hits are numbered, and but five of each shuffled."""
    flags = _flagged(spark, d)
    counts = flags.agg(F.count("*").alias("n"), *(F.count_if(t).alias(t) for t in TAGS))
    entries = F.array(*(F.struct(F.lit(t).alias("tag"), F.col(t).alias("n_matched")) for t in TAGS))
    counts = counts.select("n", F.explode(entries).alias("e")).select("e.tag", "e.n_matched", F.round(100.0 * F.col("e.n_matched") / F.col("n"), 2).alias("pct"))
    shown = F.filter(F.array(*(F.when(F.col(t), t) for t in TAGS)), lambda t: t.isNotNull())
    hits = flags.select("film", F.explode(shown).alias("tag"))
    first = _first_of(hits, "tag", "film", 5).groupBy("tag").agg(F.array_join(F.array_sort(F.collect_list("film")), " | ").alias("examples"))
    return counts.join(F.broadcast(first), "tag", "left").withColumn("examples", F.coalesce("examples", F.lit("")))


def _first_of(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(group).orderBy(value))
    return df.withColumn("_nth", nth).filter(F.col("_nth") <= k).drop("_nth")


@query(f"select film, matched_by from ({_FLAGGED}) where n_tags_matched = 1")
def false_positive_candidates(spark, d):
    """Titles that show one pattern only, which are the most doubtful."""
    return _flagged(spark, d).filter("n_tags_matched = 1").select("film", "matched_by")


def _discovered_sql(token: str) -> str:
    return f"""with t as (select distinct film from films where film is not null), k as (select film, {token} as token from t),
    c as (select token, count(*) as count, array_to_string(list(film order by film)[1:3], ' | ') as examples from k where token is not null group by 1 having count(*) >= 2)
    select * from c"""


_PROSE = "(" + ", ".join(f"'{w}'" for w in X.PROSE) + ")"
_TOKEN = _strip_sql(f"regexp_extract(film, {_quoted(X.PREFIX_TOKEN)}, 1)")
_WORDS = rf"list_transform(list_filter(string_split_regex(lower({_TOKEN}), '[\s:]+'), lambda w: w <> ''), lambda w: regexp_replace(regexp_replace(w, '^[.,!?]+', ''), '[.,!?]+$', ''))"


@query(
    _discovered_sql(
        rf"case when {_TOKEN} <> '' and not regexp_matches({_TOKEN}, '^\d+$') and not (len({_WORDS}) >= 4 or (len({_WORDS}) >= 2 and len(list_filter({_WORDS}, lambda w: w in {_PROSE})) > 0)) then lower({_TOKEN}) end"
    )
)
def discover_prefixes(spark, d):
    """Codes before a dash that occur twice or more, with the first three titles."""
    rows = _titles(spark, d).withColumn("token", X.prefix_token("film")).filter("token is not null")
    return profile.first_examples(rows, ["token"], "film", [F.col("film")]).filter("count >= 2")


_BRACKET = f"lower({_strip_sql(f'regexp_extract(film, {_quoted(X.BRACKET_TOKEN)}, 1)')})"


@query(_discovered_sql(f"nullif({_BRACKET}, '')"))
def discover_brackets(spark, d):
    """Texts in closing brackets that occur twice or more."""
    rows = _titles(spark, d).withColumn("token", X.bracket_token("film")).filter("token is not null")
    return profile.first_examples(rows, ["token"], "film", [F.col("film")]).filter("count >= 2")


_ANY_PATTERN = " or ".join(_hit_sql(p, "x") for patterns in X.KNOWN_PATTERNS.values() for p in patterns)


@query(
    f"""with d as (select 'sep_prefix' as type, * from ({SQL["discover_prefixes"]}) union all select 'bracket_suffix', * from ({SQL["discover_brackets"]})),
    e as (select type, token, bool_or({_ANY_PATTERN}) as already_known from (select type, token, unnest(string_split(examples, ' | ')) as x from d) group by 1, 2)
    select type, token, count, examples, already_known from d join e using (type, token)"""
)
def discovered_known(spark, d):
    """Discovered tokens, and whether a known pattern already catches one of their examples."""
    kinds = {"sep_prefix": discover_prefixes, "bracket_suffix": discover_brackets}
    found = [q(spark, d).withColumn("type", F.lit(k)) for k, q in kinds.items()]
    return found[0].unionByName(found[1]).withColumn("already_known", F.exists(F.split("examples", r" \| "), X.already_known))


# texts


@query(
    rf"""select film_id, case when regexp_replace(coalesce(m.title, ''), '\s+', '', 'g') <> regexp_replace(coalesce(t.film, ''), '\s+', '', 'g') then t.film end as alternative
    from film_meta m join tmdb_cache t using (film_id)"""
)
def alternative_titles(spark, d):
    """The cache's title where it differs from the film's by more than white space."""
    both = table(spark, d, "film_meta").select("film_id", "title").join(table(spark, d, "tmdb_cache").select("film_id", "film"), "film_id")
    return both.select("film_id", E.differing_alternative(F.col("title"), F.col("film")).alias("alternative"))


_STOP = r"(?s)^(.*?)[.!?]\s+[A-Z]"


@query(
    f"""with t as (select doc_id, {_strip_sql("text")} as t from documents), s as (select doc_id, t, case when regexp_matches(t, '{_STOP}') then length(regexp_extract(t, '{_STOP}', 1)) + 1 else 0 end as stop_at from t)
    select doc_id, case when stop_at > 20 then substring(t, 1, stop_at) else substring(t, 1, 250) end as opening from s"""
)
def first_sentence(spark, d):
    """The opening of every document."""
    return table(spark, d, "documents").select("doc_id", E.first_sentence("text").alias("opening"))


@query(
    rf"""with x as (select f.*, m.description from {FIRST_SQL} f left join film_meta m using (film_id))
    select film_id, concat_ws(chr(10), 'Title: ' || coalesce(nullif({_strip_sql("film")}, ''), 'unknown'), 'Released: ' || coalesce(strftime(rel_at, '%Y-%m-%d'), 'unknown'),
    'Director: ' || coalesce(nullif({_strip_sql("director")}, ''), 'unknown'), 'Synopsis: ' || coalesce(nullif({_strip_sql("synopsis")}, ''), 'unknown'),
    'Second synopsis: ' || nullif({_strip_sql("description")}, '')) as prompt from x"""
)
def prompt_text(spark, d):
    """What a provider would be asked about each film."""
    films = first_films(spark, d).join(table(spark, d, "film_meta").select("film_id", "description"), "film_id", "left")
    text = E.prompt_text(F.col("film"), F.col("rel_at"), F.col("director"), F.col("synopsis"), F.col("description"))
    return films.select("film_id", text.alias("prompt"))


@query(
    r"""select film_id, trim(replace(case when instr(upper(film), 'GC ') > 0 then substring(upper(film), 1, instr(upper(film), 'GC ') - 1) || substring(upper(film), instr(upper(film), 'GC ') + 3) else upper(film) end, ' & ', ' AND ')) as variant,
    upper(trim(regexp_replace(film, '^3D[\s-]+', ''))) as base, substring(trim(regexp_replace(regexp_replace(film, '[:\\/?*\[\]]', '', 'g'), '\s+', ' ', 'g')), 1, 31) as sheet from tmdb_cache"""
)
def title_forms(spark, d):
    """Titles as variant keys, as base titles and as sheet names."""
    films = table(spark, d, "tmdb_cache")
    return films.select("film_id", E.variant_title("film").alias("variant"), E.base_title("film").alias("base"), E.sheet_name("film").alias("sheet"))


@query("select rec_id, lower(trim(fame_source)) as fame_source, lower(trim(fame_tier)) as fame_tier, coalesce(array_to_string(list_sort(cross_media), ', '), '') as media from cast_enriched")
def enum_values(spark, d):
    cast = table(spark, d, "cast_enriched")
    return cast.select("rec_id", E.enum_value("fame_source").alias("fame_source"), E.enum_value("fame_tier").alias("fame_tier"), E.display_list("cross_media").alias("media"))


GROUPS = [("english", ["english", "american"]), ("south asian", ["hindi", "tamil", "telugu", "punjabi"]), ("east asian", ["mandarin", "korean", "japan"]), ("european", ["french", "greek", "nordic", "spanish"])]
_CLASS = "case " + " ".join("when " + " or ".join(f"contains(lower(l), '{w}')" for w in ws) + f" then '{g}'" for g, ws in GROUPS) + " end"


@query(f"select extract_id, coalesce(list_filter(list_transform(language_cues, lambda l: {_CLASS}), lambda g: g is not null)[1], 'other') as lang_group from synopses_extracted")
def language_groups(spark, d):
    """The group of the first language cue that belongs to one, by ordered keyword lists."""
    return table(spark, d, "synopses_extracted").select("extract_id", E.first_class(F.coalesce("language_cues", F.array().cast("array<string>")), GROUPS, "other").alias("lang_group"))


# JSON


def _answers(spark, d):
    """Checkpointed records as a model might have sent them: plain, fenced, in prose, with a stray comma, or cut off."""
    r, n = F.col("record"), F.pmod("progress_id", F.lit(5))
    raw = (
        F.when(n == 0, r).when(n == 1, F.concat(F.lit("```json\n"), r, F.lit("\n```"))).when(n == 2, F.concat(F.lit("Here it is: "), r, F.lit(" as asked")))
        .when(n == 3, F.regexp_replace(r, r"\}$", ",}")).otherwise(F.expr("substring(record, 1, length(record) div 2)"))
    )
    return table(spark, d, "meta_progress").select("progress_id", raw.alias("raw"))


_ANSWERS = r"""with a as (select progress_id, case progress_id % 5 when 0 then record when 1 then '```json' || chr(10) || record || chr(10) || '```' when 2 then 'Here it is: ' || record || ' as asked'
  when 3 then regexp_replace(record, '\}$', ',}') else substring(record, 1, length(record) // 2) end as raw from meta_progress),
f as (select progress_id, raw, nullif(regexp_extract(raw, '(?s)\{.*\}'), '') as found from a),
p as (select *, regexp_replace(found, ',(\s*[}\]])', '\1', 'g') as mended from f),
q as (select *, try_cast(found as json) is not null and not regexp_matches(found, ',\s*[}\]]') as strict, try_cast(mended as json) is not null as fixable from p)"""


@query(_ANSWERS + " select progress_id, strict, case when strict or fixable then null else 'json_parse_failed' end as failure from q")
def json_parsing(spark, d):
    """Whether answers parse as they are, and why they fail after mending."""
    a = _answers(spark, d)
    failure = J.failure_class(F.col("raw"), F.lit("completed"), F.lit(None).cast("string"))
    return a.select("progress_id", J.strict_json("raw").isNotNull().alias("strict"), failure.alias("failure"))


@query("select extract_id, to_json(list_filter(list_transform(genres, lambda x: trim(x)), lambda x: x is not null and x <> ''))::varchar as text from synopses_extracted")
def list_json(spark, d):
    """Lists as compact JSON text, as a warehouse takes them."""
    return table(spark, d, "synopses_extracted").select("extract_id", J.list_json("genres").alias("text"))


@query(
    """select extract_id, array_to_string(coalesce(list_filter(list_transform(tone, lambda x: trim(x)), lambda x: x is not null and x <> ''), []), '|') as tone from synopses_extracted"""
)
def variant_parse(spark, d):
    """Lists read back from JSON text; null gives an empty list."""
    text = table(spark, d, "synopses_extracted").select("extract_id", J.list_json("tone").alias("text"))
    return text.select("extract_id", F.array_join(J.variant_list("text"), "|").alias("tone"))


@query(
    """select film_id, a.title as title, case when a.title is distinct from b.title then b.title end as wh__title, a.director as director,
    case when a.director is distinct from b.director then b.director end as wh__director from film_meta a join film_meta_wh b using (film_id)"""
)
def flatten_tasks(spark, d):
    """Two payloads of a film as one row; values that differ come under the second task's name."""
    payload = lambda n: table(spark, d, n).select("film_id", F.to_json(F.struct("title", "director"), {"ignoreNullFields": "false"}).alias(n))
    both = payload("film_meta").join(payload("film_meta_wh"), "film_id")
    columns = J.flatten_payloads([("local", F.col("film_meta")), ("wh", F.col("film_meta_wh"))], ["title", "director"])
    return both.select("film_id", *(v.alias(k) for k, v in columns.items()))


# lists


@query(
    """select e.extract_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(e.genres, []), coalesce(m.genres, [])))), '|') as all_genres
    from synopses_extracted e join film_meta m using (film_id)"""
)
def genre_union(spark, d):
    meta = table(spark, d, "film_meta").select("film_id", F.col("genres").alias("meta_genres"))
    both = table(spark, d, "synopses_extracted").join(meta, "film_id")
    kept = F.filter(E.list_union(F.col("genres"), F.col("meta_genres")), lambda x: x.isNotNull())
    return both.select("extract_id", F.array_join(kept, "|").alias("all_genres"))


@query(
    """select e.extract_id, array_to_string(list_concat(list_filter(coalesce(m.genres, []), lambda x: not list_contains(list_concat(coalesce(e.genres, []), coalesce(e.tone, [])), x)), coalesce(e.genres, [])), '|') as genres
    from synopses_extracted e join film_meta m using (film_id)"""
)
def genre_prepend(spark, d):
    """Genres of film_meta put before those extracted, unless already there."""
    meta = table(spark, d, "film_meta").select("film_id", F.filter("genres", lambda x: x.isNotNull()).alias("source"))
    both = table(spark, d, "synopses_extracted").join(meta, "film_id")
    full = lambda c: F.filter(E.list_or_empty(c), lambda x: x.isNotNull())
    return both.select("extract_id", F.array_join(E.prepend_missing(F.col("source"), full("genres"), full("tone")), "|").alias("genres"))


def _set_sql(c: str) -> str:
    return f"list_distinct(list_filter(list_transform(coalesce({c}, []), lambda x: lower(trim(x))), lambda x: x is not null and x <> ''))"


def _jaccard_sql(a: str, b: str, empty: str) -> str:
    x, y = _set_sql(a), _set_sql(b)
    return f"case when len(list_distinct(list_concat({x}, {y}))) = 0 then {empty} else len(list_intersect({x}, {y})) / len(list_distinct(list_concat({x}, {y})))::double end"


@query(
    f"""select film_id, round({_jaccard_sql("a.genres", "b.genres", "1.0")}, 6) as genres, round({_jaccard_sql("a.writers", "b.writers", "null::double")}, 6) as writers
    from film_meta a join film_meta_wh b using (film_id)"""
)
def jaccard_pairs(spark, d):
    """Likeness of the two copies' lists under both policies for empty sets."""
    b = table(spark, d, "film_meta_wh").select("film_id", F.col("genres").alias("g"), F.col("writers").alias("w"))
    both = table(spark, d, "film_meta").join(b, "film_id")
    return both.select("film_id", F.round(E.jaccard(F.col("genres"), F.col("g")), 6).alias("genres"), F.round(E.jaccard(F.col("writers"), F.col("w"), None), 6).alias("writers"))


@query(
    f"""with j as (select {_jaccard_sql("a.genres", "b.genres", "1.0")} as genres, {_jaccard_sql("a.writers", "b.writers", "1.0")} as writers from film_meta a join film_meta_wh b using (film_id))
    select 'local' as model_a, 'warehouse' as model_b, 'genres' as field, count(*) as n, round(avg(genres), 6) as mean_jaccard from j
    union all select 'local', 'warehouse', 'writers', count(*), round(avg(writers), 6) from j"""
)
def model_jaccard(spark, d):
    one = lambda n, m: table(spark, d, n).select(F.lit(m).alias("model"), "film_id", "genres", "writers")
    return profile.pairwise_jaccard(one("film_meta", "local").union(one("film_meta_wh", "warehouse")), "model", "film_id", ["genres", "writers"])


# comparison and profiles


COMPARED = ["fame_source", "fame_tier", "primary_market", "age_range"]
_SIDES = "with s as (select a.actor_name, " + ", ".join(
    f"a.{f} as {f}__new, b.{f} as {f}__old, case when b.k is not null then lower(trim(a.{f})) is not distinct from lower(trim(b.{f})) end as {f}__agree" for f in COMPARED
) + " from cast_enriched a left join (select *, upper(trim(actor_name)) as k from cast_enriched_wh) b on upper(trim(a.actor_name)) = b.k)"


def _sides(spark, d):
    return profile.side_by_side(table(spark, d, "cast_enriched"), table(spark, d, "cast_enriched_wh"), "actor_name", COMPARED)


@query(_SIDES + " select * from s")
def side_by_side(spark, d):
    return _sides(spark, d)


@query(_SIDES + " " + " union all ".join(f"select '{f}' as field, count(*) as n, round(avg({f}__agree::int), 6) as agree_rate from s where {f}__old is not null" for f in COMPARED))
def field_agreement(spark, d):
    return profile.agreement(_sides(spark, d), COMPARED)


@query(_SIDES + " select actor_name from s where " + " or ".join(f"not coalesce({f}__agree, true)" for f in COMPARED))
def disagreements(spark, d):
    return _sides(spark, d).filter(profile.any_disagrees(COMPARED)).select("actor_name")


_COVERED = {"title": "t", "release_date": "t", "director": "t", "genres": "a", "writers": "a", "budget_usd": "n", "budget_source": "t", "ip_strength": "t"}
_FILLED = {"t": "coalesce(trim({0}) <> '' and lower(trim({0})) <> 'unknown', false)", "a": "coalesce(len({0}) > 0, false)", "n": "{0} is not null"}


@query(" union all ".join(f"select '{c}' as \"column\", count(*) filter ({_FILLED[k].format(c)}) as n_filled, count(*) as n_rows, round(100.0 * count(*) filter ({_FILLED[k].format(c)}) / count(*), 2)::double as pct from film_meta" for c, k in _COVERED.items()))
def coverage(spark, d):
    """How much of each column of film_meta is filled."""
    return profile.coverage(table(spark, d, "film_meta"), list(_COVERED), ("unknown",))


_PROFILED = {"genres": True, "tone": True, "title": False, "narrative_scope": False}


def _profile_sql(c: str, many: bool) -> str:
    length = f"len({c})" if many else f"length({c})"
    unique = f"(select count(distinct v) from (select unnest({c}) as v from synopses_extracted))" if many else f"(select count(distinct {c}) from synopses_extracted)"
    return f"select '{c}' as \"column\", {unique} as n_unique, round(avg({length}), 4) as avg_len, max({length}) as max_len, round(100.0 * count(*) filter (coalesce({length}, 0) = 0) / count(*), 4)::double as pct_empty, {many} as is_multivalued from synopses_extracted"


@query(" union all ".join(_profile_sql(c, m) for c, m in _PROFILED.items()))
def column_profile(spark, d):
    return profile.column_profile(table(spark, d, "synopses_extracted"), list(_PROFILED))


@query("select dstbtr as value, count(*) as count from films group by 1 order by 2 desc, 1 nulls last limit 10")
def frequent_distributors(spark, d):
    """The ten most frequent distributors; null is one."""
    return profile.frequency(table(spark, d, "films"), F.col("dstbtr"), 10)


@query("select snapshot, count(*) as n, round(avg(length(synopsis)), 4) as mean_len, median(length(synopsis)) as median_len, min(length(synopsis)) as least, max(length(synopsis)) as most from films group by 1")
def snapshot_lengths(spark, d):
    n = F.char_length("synopsis")
    return table(spark, d, "films").groupBy("snapshot").agg(
        F.count("*").alias("n"), F.round(F.avg(n), 4).alias("mean_len"), F.median(n).alias("median_len"),
        F.min(n).cast("bigint").alias("least"), F.max(n).cast("bigint").alias("most"),
    )


@query("select primary_market, count(*) as n, list_sort(list(film_count))[count(*) // 2 + 1] as upper_median from cast_enriched where film_count is not null group by 1")
def upper_median(spark, d):
    return profile.upper_median(table(spark, d, "cast_enriched"), ["primary_market"], "film_count")


@query(
    """with r as (select lower(trim(t.match_confidence)) as confidence, m.budget_usd / t.budget as ratio from film_meta m join tmdb_cache t using (film_id) where m.budget_usd > 0 and t.budget > 0)
    select confidence, count(*) as n, count(*) filter (ratio between 0.9 and 1.1) as within_10, count(*) filter (ratio between 0.75 and 1.25) as within_25,
    count(*) filter (not ratio between 0.5 and 2.0) as off_twofold from r group by 1"""
)
def budget_ratios(spark, d):
    """How near the stored budgets of the two tables are, by the cache's confidence; the null group is kept."""
    both = table(spark, d, "film_meta").filter("budget_usd > 0").join(table(spark, d, "tmdb_cache").filter("budget > 0").select("film_id", "budget", "match_confidence"), "film_id")
    r = F.col("budget_usd") / F.col("budget")
    return both.groupBy(E.enum_value("match_confidence").alias("confidence")).agg(
        F.count("*").alias("n"), F.count_if(r.between(0.9, 1.1)).alias("within_10"), F.count_if(r.between(0.75, 1.25)).alias("within_25"), F.count_if(~r.between(0.5, 2.0)).alias("off_twofold")
    )


@query(
    """select film_id, title, budget_usd / budget as ratio from film_meta join tmdb_cache using (film_id)
    where budget_usd > 0 and budget > 0 and (budget_usd / budget > 2 or budget_usd / budget < 0.5) order by abs(budget_usd / budget - 1) desc, film_id limit 20"""
)
def budget_blowups(spark, d):
    """The twenty films whose stored budgets of the two tables are furthest apart, a report of the first k."""
    both = table(spark, d, "film_meta").filter("budget_usd > 0").join(table(spark, d, "tmdb_cache").filter("budget > 0").select("film_id", "budget"), "film_id")
    both = both.select("film_id", "title", (F.col("budget_usd") / F.col("budget")).alias("ratio"))
    return profile.top_by(both.filter("ratio > 2 or ratio < 0.5"), F.abs(F.col("ratio") - 1), 20, "film_id")


@query(
    """with s as (select film_id, list_distinct(list_filter(list_transform(list_transform(coalesce(studios, []), lambda s: s.name), lambda x: lower(trim(x))), lambda x: x is not null and x <> '')) as a from film_meta),
    t as (select film_id, """ + _set_sql("studios") + """ as b from tmdb_cache)
    select film_id, case when len(list_distinct(list_concat(a, b))) = 0 then null else round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::double, 6) end as studio_overlap from s join t using (film_id)"""
)
def studio_overlap(spark, d):
    """Studios named by both tables; undefined where neither names any."""
    meta = table(spark, d, "film_meta").select("film_id", E.pluck("studios", "name").alias("names"))
    both = meta.join(table(spark, d, "tmdb_cache").select("film_id", "studios"), "film_id")
    return both.select("film_id", F.round(E.jaccard(F.col("names"), F.col("studios"), None), 6).alias("studio_overlap"))


_ERRORS = "(select film_id, case when synopsis is null then 'missing: synopsis of ' || film_id when length(synopsis) < 5 then 'too_short: ' || length(synopsis) when director is null then 'missing_director' end as _error from films)"


def _film_errors(spark, d):
    error = (
        F.when(F.col("synopsis").isNull(), F.concat(F.lit("missing: synopsis of "), "film_id")).when(F.char_length("synopsis") < 5, F.concat(F.lit("too_short: "), F.char_length("synopsis")))
        .when(F.col("director").isNull(), "missing_director")
    )
    return table(spark, d, "films").select("film_id", "snapshot", error.alias("_error"))


@query(f"select substring(split_part(_error, ':', 1), 1, 40) as bucket, count(*) as count, min(_error) as example from {_ERRORS} where _error is not null group by 1")
def error_histogram(spark, d):
    return profile.error_histogram(_film_errors(spark, d), "_error")


@query("select primary_audience, count(*) as n, count(case when synopsis is null then 1 end) as errors, round(sum(case when synopsis is not null then coalesce(len(genres), 0) + coalesce(len(tone), 0) else 0 end) / count(*)::double, 4) as avg_items from synopses_extracted group by 1")
def run_summary(spark, d):
    rows = table(spark, d, "synopses_extracted").withColumn("_error", F.when(F.col("synopsis").isNull(), "no synopsis"))
    return profile.run_summary(rows, ["primary_audience"], ["genres", "tone"], "_error")


@query("select day, amount, sum(amount) over (order by day)::bigint as total from (select date_trunc('day', loaded_at)::date as day, sum(length(coalesce(synopsis, '')))::bigint as amount from films group by 1)")
def running_total(spark, d):
    """Letters loaded by day, and up to each day."""
    films = table(spark, d, "films").select(F.to_date("loaded_at").alias("day"), F.char_length(F.coalesce("synopsis", F.lit(""))).cast("bigint").alias("amount"))
    return profile.running_total(films, "day", "amount")


# variants and encoders


@query(
    r"""with b as (select film_id, film, coalesce(studios, []) as studios, upper(trim(regexp_replace(film, '^3D[\s-]+', ''))) as base, film like '3D%' as special, studios as raw from tmdb_cache),
    m as (select base, list_sort(list_distinct(flatten(list(studios)))) as merged from b where base is not null group by 1 having bool_or(special) and not bool_and(special))
    select film_id, case when m.base is not null then 1 else 0 end as has_3d_version, array_to_string(case when m.base is not null then m.merged else b.raw end, '|') as studios from b left join m using (base)"""
)
def merge_3d(spark, d):
    """3D and standard bookings of one title share their studios."""
    films = table(spark, d, "tmdb_cache").select("film_id", "film", F.filter("studios", lambda x: x.isNotNull()).alias("studios"))
    out = variants.merge_editions(films, "film_id", "film", F.col("film").startswith("3D"), ["studios"])
    return out.select("film_id", "has_3d_version", F.array_join("studios", "|").alias("studios"))


@query()
def merge_gc(spark, d):
    """Event bookings folded into the standard film that is most like them."""
    films = first_films(spark, d).select("film_id", "film", "synopsis").join(table(spark, d, "tmdb_cache").select("film_id", "studios"), "film_id", "left")
    matches = variants.fuzzy_best(films, "film_id", "film", "synopsis")
    return variants.merge_events(films, matches, "film_id", "synopsis", ["studios"]).select("film_id", "film", "synopsis", F.array_join("studios", "|").alias("studios"))


@query(
    """with u as (select 'genres' as "column", unnest(genres) as v from synopses_extracted union all select 'tone', unnest(tone) from synopses_extracted)
    select "column", count(distinct v) as n_unique, floor(greatest(10, least(400, 0.1 * count(distinct v))))::bigint as top_n from u group by 1"""
)
def auto_top_n(spark, d):
    return encode.auto_top_n(table(spark, d, "synopses_extracted"), ["genres", "tone"])


_TOKENS = "case when len({0}) > 0 then {0} else ['__EMPTY__'] end".format("coalesce(list_filter(list_transform(genres, lambda x: lower(trim(x))), lambda x: x is not null and x <> '')[1:5], [])")


@query(
    f"""with t as (select extract_id, {_TOKENS} as tokens from synopses_extracted), c as (select unnest(tokens) as token from t),
    v as (select token from c where token <> '__EMPTY__' group by 1 order by count(*) desc, token limit 12), l as (select list(token) as v from v)
    select extract_id, array_to_string(list_transform(tokens, lambda x: case when list_contains(v, x) or x = '__EMPTY__' then x else '__OTHER__' end), '|') as genres from t, l"""
)
def topn_map(spark, d):
    out = encode.map_top_tokens(table(spark, d, "synopses_extracted"), "extract_id", "genres", 12)
    return out.select("extract_id", F.array_join("genres_mapped", "|").alias("genres"))


@query(
    """with t as (select extract_id, coalesce(protagonist_type, '__EMPTY__') as v from synopses_extracted), top as (select v from t group by 1 order by count(*) desc, v limit 4),
    m as (select extract_id, case when v in (select v from top) or v = '__EMPTY__' then v else '__OTHER__' end as mapped from t)
    select extract_id, mapped, dense_rank() over (order by mapped) - 1 as idx from m"""
)
def topn_single(spark, d):
    out = encode.map_top_value(table(spark, d, "synopses_extracted"), "protagonist_type", 4)
    return out.select("extract_id", F.col("protagonist_type_mapped").alias("mapped"), F.col("protagonist_type_idx").cast("bigint").alias("idx"))


@query(
    """with c as (select unnest(genres) as v from synopses_extracted), top as (select v from c where v is not null group by 1 order by count(*) desc, v limit 6), l as (select list(v) as v from top)
    select extract_id, len(list_intersect(list_distinct(coalesce(genres, [])), v)) as hits, (len(list_filter(coalesce(genres, []), lambda x: x is not null and not list_contains(v, x))) > 0)::int as other from synopses_extracted, l"""
)
def multi_hot(spark, d):
    """Genres as 0/1 columns of the six most frequent and the rest, here added up."""
    rows = table(spark, d, "synopses_extracted").withColumn("genres", F.filter("genres", lambda x: x.isNotNull()))
    out = encode.multi_hot(rows.select("extract_id", "genres"), "genres", 6)
    hot = [c for c in out.columns if c.startswith("genres_") and c != "genres_OTHER"]
    return out.select("extract_id", sum((F.col(f"`{c}`") for c in hot), F.lit(0)).cast("bigint").alias("hits"), F.col("genres_OTHER").alias("other"))


SCOPES = ["intimate", "local", "global"]


@query("select extract_id, " + ", ".join(f"coalesce((narrative_scope = '{s}')::int, 0) as narrative_scope_{s}" for s in SCOPES) + " from synopses_extracted")
def one_hot(spark, d):
    return encode.one_hot(table(spark, d, "synopses_extracted").select("extract_id", "narrative_scope"), "narrative_scope", SCOPES).drop("narrative_scope")


@query()
def embed_pca(spark, d):
    """Tones of each film as the first four components of a hashed embedding."""
    rows = table(spark, d, "synopses_extracted").select("extract_id", E.joined_or(F.array_sort("tone"), " ").alias("text"))
    out = encode.embed_pca(rows, "text", "pca", 4)
    from pyspark.ml.functions import vector_to_array

    return out.select("extract_id", vector_to_array("pca").alias("pca"))


# the warehouse, providers and streams


@query(
    """select 'actor_list' as "column", avg((trim(actor_list) like '[%]')::int) as rate from films where actor_list is not null having avg((trim(actor_list) like '[%]')::int) >= 0.05"""
)
def list_columns(spark, d):
    """Text columns of films that often hold lists."""
    return warehouse.list_columns(table(spark, d, "films"), 0.05)


@query("select film_id, title from film_meta union all select film_id, title from film_meta_wh where film_id not in (select film_id from film_meta)")
def synchronised_local(spark, d):
    """The local table after a two-way synchronisation of missing rows."""
    side = lambda n: table(spark, d, n).select("film_id", "title")
    return warehouse.synchronise(side("film_meta"), side("film_meta_wh"), "film_id")[0]


@query("select film_id as FILM_ID, title as TITLE, to_json(list_filter(list_transform(genres, lambda x: trim(x)), lambda x: x is not null and x <> ''))::varchar as GENRES from film_meta")
def staging_rows(spark, d):
    return warehouse.to_staging(table(spark, d, "film_meta").select("film_id", "title", "genres"))


@query()
def enrich_replay(spark, d):
    """Enrichment with recorded answers: the checkpoint of all films of meta_progress, by one title task."""
    from marquetry.operators.enrich import Answer, empty, enrich
    from marquetry.sources.files import Task

    class Echo:
        """A provider that answers with the question."""

        def ask(self, key, task, content):
            return Answer(raw=content, prompt_tokens=len(content))

    work = table(spark, d, "meta_progress").select(F.col("film_key").alias("key"), J.unwrap("record").alias("content"))
    checkpoint, _, _ = enrich(spark, work, empty(spark, "key string, title string"), empty(spark, "key string, _error string, _raw_output string"), "key", "content", [Task("meta", "")], Echo(), ["title"])
    return checkpoint


@query("select date_trunc('day', loaded_at) as start, snapshot, count(*) as n from films group by 1, 2")
def daily_loads(spark, d):
    """The windowed count that also runs on a stream."""
    from marquetry.streaming.incremental import windowed_counts

    return windowed_counts(table(spark, d, "films"), "loaded_at", "snapshot")


# drill-downs and reports


@query("select rec_id, actor_name from cast_enriched where contains(upper(actor_name), 'ANN')")
def drill_down(spark, d):
    return profile.drill_down(table(spark, d, "cast_enriched"), "actor_name", "ann").select("rec_id", "actor_name")


@query("select rec_id, fame_tier from cast_enriched where fame_tier is null or lower(trim(fame_tier)) in ('', 'unknown')")
def unknown_tiers(spark, d):
    return profile.unknown_values(table(spark, d, "cast_enriched"), "fame_tier").select("rec_id", "fame_tier")


@query("select doc_id, source, case source when 'trade_wire' then 0 when 'press_kit' then 1 else 2 end::bigint as place from documents where source in ('trade_wire', 'press_kit', 'school_pack')")
def sources_in_order(spark, d):
    """Documents of listed sources in the order of the list."""
    return profile.in_order(table(spark, d, "documents").select("doc_id", "source"), "source", ["trade_wire", "press_kit", "school_pack"])


@query("select extract_id, case when synopsis is null then 0 else coalesce(len(genres), 0) + coalesce(len(tone), 0) end as n_items, synopsis is null as failed, coalesce((trim(title) <> '')::int, 0) + coalesce((trim(synopsis) <> '')::int, 0) as n_texts from synopses_extracted")
def row_metrics(spark, d):
    rows = table(spark, d, "synopses_extracted").withColumn("_error", F.when(F.col("synopsis").isNull(), "none"))
    return profile.row_metrics(rows, ["genres", "tone"], "_error", ["title", "synopsis"]).select("extract_id", "n_items", "failed", "n_texts")


@query(
    "select case when t.film_id is null then 'not cached' else 'cached' end as cohort, count(*) as n, count(m.budget_usd) as hits, round(count(m.budget_usd) / count(*)::double, 6) as rate from film_meta m left join tmdb_cache t using (film_id) group by 1"
)
def cohort_hit_rate(spark, d):
    """Known budgets of film_meta by whether the cache has the film."""
    cached = table(spark, d, "tmdb_cache").select("film_id", F.lit("cached").alias("cohort"))
    rows = table(spark, d, "film_meta").join(cached, "film_id", "left").withColumn("cohort", F.coalesce("cohort", F.lit("not cached")))
    return profile.hit_rate(rows, "cohort", "budget_usd")


@query("select m.film_id, m.title, t.film, len(m.studios) as n_studios, len(t.studios) as n_studios_tmdb from film_meta m left join tmdb_cache t using (film_id)")
def suffixed_join(spark, d):
    size = F.when(F.col("studios").isNotNull(), F.size("studios")).cast("bigint").alias("n_studios")
    meta = table(spark, d, "film_meta").select("film_id", "title", size)
    return profile.suffixed_join(meta, table(spark, d, "tmdb_cache").select("film_id", "film", size), "film_id", "_tmdb")


@query("select extract_id, " + ", ".join(f"coalesce((narrative_scope = '{s}')::int, 0) as narrative_scope_{s}" for s in SCOPES) + ", (coalesce(list_contains(genres, 'drama'), false))::int as genres_drama, (len(list_filter(coalesce(genres, []), lambda x: x is not null and x <> 'drama')) > 0)::int as \"genres_OTHER\", is_sequel::int as is_sequel from synopses_extracted")
def feature_table(spark, d):
    rows = table(spark, d, "synopses_extracted")
    return encode.feature_table(rows, ["extract_id"], {"narrative_scope": SCOPES}, {"genres": ["drama"]}, ["is_sequel"])


@query("select extract_id, is_franchise, is_sequel, title from synopses_extracted")
def boolean_columns(spark, d):
    """Text columns of true and false read back as booleans."""
    text = [F.initcap(F.col(c).cast("string")).alias(c) for c in ("is_franchise", "is_sequel")]
    rows = table(spark, d, "synopses_extracted").select("extract_id", *text, "title")
    return encode.boolean_columns(rows, ["is_franchise", "is_sequel", "title"])


@query("select d.day, f.film_id from (values (date '2010-05-07'), (date '2015-03-20'), (date '2020-10-02')) d(day) join (select distinct film_id, rel_at from films) f on f.rel_at::date between d.day and d.day + 6")
def films_of_weeks(spark, d):
    """One bound query for several dates: the films of the week from each."""
    days = spark.createDataFrame([("2010-05-07",), ("2015-03-20",), ("2020-10-02",)], "day string").select(F.to_date("day").alias("day"))
    weeks = days.select("day", F.explode(F.sequence("day", F.date_add("day", 6))).alias("on"))
    films = table(spark, d, "films").filter("rel_at is not null").select("film_id", F.to_date("rel_at").alias("on"), "rel_at").distinct()
    return films.join(F.broadcast(weeks), "on").select("day", "film_id")


TIERS = [("major", ["thistledown", "juniper"]), ("mini_major", ["owlery"])]
_TIER = "case when len(list_filter(s, lambda x: contains(lower(x), 'thistledown') or contains(lower(x), 'juniper'))) > 0 then 'major' when len(list_filter(s, lambda x: contains(lower(x), 'owlery'))) > 0 then 'mini_major' when len(s) > 0 then 'indie' else 'unknown' end"


@query(f"select film_id, {_TIER} as tier from (select film_id, list_filter(coalesce(studios, []), lambda x: x is not null) as s from tmdb_cache)")
def studio_tier(spark, d):
    """The first class of which a studio's name holds a keyword; the lists are parameters."""
    names = F.filter(E.list_or_empty("studios"), lambda x: x.isNotNull())
    joined = F.array_join(names, "\n")
    tier = F.coalesce(E.keyword_class(joined, TIERS), F.when(F.size(names) > 0, "indie"), F.lit("unknown"))
    return table(spark, d, "tmdb_cache").select("film_id", tier.alias("tier"))
