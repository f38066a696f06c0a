"""The queries of the general problems over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.operators.diff import compare_copies, long_form
from marquetry.operators.nested import Level, canonical_objects, flatten_tree, unwrap_json
from marquetry.operators.packed import unpack_rows
from marquetry.operators.units import nearest_reading, read_units
from marquetry.session import table

STUDIOS = Level("studio", "studios", "name")
CAST = Level("cast", "cast", "actor")
DEEP_STUDIOS = Level("studio", "studios", "name", (Level("deal", "deals", "territory"),))
DEEP_CAST = Level("cast", "cast", "actor", (Level("voice", "voices", "voice_actor"),))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects of film_meta and of meta_progress.record with their parent links."""
    meta = flatten_tree(table(spark, sf_dir, "film_meta"), "film_id", [STUDIOS, CAST])
    record = unwrap_json(F.col("record"))
    parts = F.from_json(record, "struct<studios string, `cast` string>")
    progress = (
        table(spark, sf_dir, "meta_progress")
        .select("progress_id", parts.alias("r"))
        .select(
            "progress_id",
            canonical_objects(F.col("r.studios"), "name", "deals", "territory").alias("studios"),
            canonical_objects(F.col("r.cast"), "actor", "voices", "voice_actor").alias("cast"),
        )
    )
    deep = flatten_tree(progress, "progress_id", [DEEP_STUDIOS, DEEP_CAST])
    return meta.select(F.lit("film_meta").alias("tbl"), "*").union(deep.select(F.lit("meta_progress").alias("tbl"), "*"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and fields in which the local tables and their warehouse copies differ."""

    def found(name: str, key: str, **how) -> DataFrame:
        pair = table(spark, sf_dir, name), table(spark, sf_dir, f"{name}_wh")
        out = long_form(compare_copies(*pair, key, unique_keys=True, **how), "only_local", "only_warehouse")
        return out.select(F.lit(name).alias("tbl"), F.col("row_key").cast("string"), "field", "kind")

    films = found("film_meta", "film_id")
    return films.union(found("cast_enriched", "actor_name", ignore=("rec_id",), text_key=True))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every actor named in films.actor_list with the place in the list."""
    return unpack_rows(table(spark, sf_dir, "films"), "record_id", "actor_list", "actor")


def p2_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known non-zero budget with the currency and multiplier it is stated in and its whole US dollars."""
    rates = table(spark, sf_dir, "fx_rates")
    meta = table(spark, sf_dir, "film_meta").filter("budget_usd <> 0")
    meta = read_units(spark, meta, rates, "budget_usd", "budget_source", "budget_currency", "budget_local")
    meta = meta.select("film_id", "budget_usd", "r_unit", "r_multiplier", "r_rate", "r_local", "l_rate")
    tmdb = table(spark, sf_dir, "tmdb_cache").filter("budget <> 0").select("film_id", "budget")
    both = meta.join(tmdb, "film_id", "full_outer")

    told = F.col("budget_usd") * F.col("r_multiplier") / F.col("r_rate")
    as_told = F.struct(F.lit(0.0).alias("d"), F.col("r_unit").alias("unit"), F.col("r_multiplier").alias("multiplier"))
    local, rate = F.col("r_local"), F.col("l_rate")
    guess = nearest_reading(F.col("budget_usd"), F.col("budget"), local, rate)
    both = both.withColumns(
        {
            "film_meta": F.when(F.col("budget_usd").isNotNull(), F.when(told.isNotNull(), as_told).otherwise(guess)),
            "tmdb_cache": nearest_reading(F.col("budget"), told, local, rate),
        }
    )
    entry = lambda t, v: F.struct(F.lit(t).alias("tbl"), F.col(v).alias("stated"), F.col(t).alias("r"))
    rows = both.select("film_id", F.explode(F.array(entry("film_meta", "budget_usd"), entry("tmdb_cache", "budget"))).alias("e"))
    rows = rows.filter("e.r is not null").select(
        "e.tbl", "film_id", "e.stated", F.col("e.r.unit").alias("currency"), F.col("e.r.multiplier").alias("multiplier")
    )
    fx = rates.select("currency", F.col("units_per_usd").cast("double").alias("units_per_usd"))
    whole = F.round(F.col("stated") * F.col("multiplier") / F.col("units_per_usd")).cast("bigint")
    return rows.join(F.broadcast(fx), "currency", "left").select("tbl", "film_id", "stated", "currency", "multiplier", whole.alias("usd"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budgets that are not stated in whole US dollars."""
    off = (F.col("currency") != "USD") | (F.col("multiplier") != 1)
    return p2_dollars(spark, sf_dir).filter(off).select("tbl", "film_id", "currency", "multiplier")


def _plain(e: str) -> str:
    return rf"lower(trim(regexp_replace(coalesce({e}, ''), '\s+', ' ', 'g')))"


def _texts(e: str) -> str:
    return f"list_sort(list_distinct(list_transform(list_filter(coalesce({e}, []), lambda x: x is not null), lambda x: {_plain('x')})))"


def _structs(e: str, *fields: str) -> str:
    parts = ", ".join([_plain(f"x.{f}") for f in fields] + ["coalesce(x.\"order\"::varchar, 'null')"])
    return f"list_sort(list_distinct(list_transform(list_filter(coalesce({e}, []), lambda x: x is not null), lambda x: concat_ws('|', {parts}))))"


def _number_differs(c: str) -> str:
    return f"(a.{c} is null) <> (b.{c} is null) or abs(a.{c} - b.{c}) > 0.0001 * greatest(abs(a.{c}), abs(b.{c}))"


def _p4_sql(name: str, key: str, tests: dict[str, str]) -> str:
    k = "{0}.film_id::varchar" if key == "film_id" else "upper(" + _plain("{0}.actor_name") + ")"
    on = f"{k.format('a')} = {k.format('b')}"
    parts = [
        f"select '{name}' as tbl, {k.format('a')} as row_key, 'row' as field, 'only_local' as kind from {name} a where not exists (select 1 from {name}_wh b where {on})",
        f"select '{name}', {k.format('b')}, 'row', 'only_warehouse' from {name}_wh b where not exists (select 1 from {name} a where {on})",
    ]
    parts += [f"select '{name}', {k.format('a')}, '{c}', 'differs' from {name} a join {name}_wh b on {on} where {t}" for c, t in tests.items()]
    return " union all ".join(parts)


def _pair(form, c: str, *more: str) -> str:
    return f"{form(f'a.{c}', *more)} <> {form(f'b.{c}', *more)}"


_P4 = _p4_sql(
    "film_meta",
    "film_id",
    {c: _pair(_plain, c) for c in ("title", "release_date", "director", "description", "budget_currency", "budget_source", "ip_strength", "adaptation_type", "evt_dstbtr", "evt_rel_at")}
    | {c: _pair(_texts, c) for c in ("writers", "genres")}
    | {c: _number_differs(c) for c in ("budget_usd", "budget_local")}
    | {"studios": _pair(_structs, "studios", "name", "role"), "cast": _pair(_structs, '"cast"', "actor", '"character"')},
) + " union all " + _p4_sql(
    "cast_enriched",
    "actor_name",
    {c: _pair(_plain, c) for c in ("fame_source", "fame_tier", "primary_market", "age_range")} | {"cross_media": _pair(_texts, "cross_media"), "film_count": _number_differs("film_count")},
)


def _json_list(v: str) -> str:
    text = f"({v} ->> '$')"
    return f"""case json_type({v}) when 'ARRAY' then {v} when 'OBJECT' then case when json_type({v}, '$.items') = 'ARRAY' then json_extract({v}, '$.items') else json_array({v}) end
    when 'VARCHAR' then case when {text} like '[%' then {text}::json else json_array({v}) end end"""


def _levels(table: str, key: str, source: str, child: str, column: str, name: str, below: str = "", below_child: str = "", below_name: str = "") -> str:
    named = lambda e, n: f"case when json_type({e}) = 'OBJECT' then json_extract_string({e}, '$.{n}') else {e} ->> '$' end"
    parted = lambda l: f"unnest(json_extract({l}, '$[*]')) as e, generate_subscripts(json_extract({l}, '$[*]'), 1) as pos"
    top = f"(select key, {parted('l')} from (select {key} as key, {_json_list(f'json_extract(r, $${column}$$)')} as l from {source}) where l is not null)"
    out = f"select '{table}' as tbl, key as row_key, '{child}' as child, 0 as parent_pos, pos, {named('e', name)} as name from {top} where json_type(e) <> 'NULL'"
    if below:
        inner = f"(select key, parent_pos, {parted('l')} from (select key, pos as parent_pos, {_json_list(f'json_extract(e, $${below}$$)')} as l from {top} where json_type(e) = 'OBJECT') where l is not null)"
        out += f" union all select '{table}', key, '{below_child}', parent_pos, pos, {named('e', below_name)} from {inner} where json_type(e) <> 'NULL'"
    return out


_RECORDS = "(select progress_id, case when json_type(record::json) = 'VARCHAR' then (record::json ->> '$')::json else record::json end as r from meta_progress)"
_META = """select 'film_meta' as tbl, film_id as row_key, '{0}' as child, 0 as parent_pos, pos, e.{2} as name from (select film_id, unnest({1}) as e, generate_subscripts({1}, 1) as pos from film_meta) where e is not null"""
_P6 = " union all ".join(
    [
        _META.format("studio", "studios", "name"),
        _META.format("cast", '"cast"', "actor"),
        _levels("meta_progress", "progress_id", _RECORDS, "studio", "$.studios", "name", "$.deals", "deal", "territory"),
        _levels("meta_progress", "progress_id", _RECORDS, "cast", "$.cast", "actor", "$.voices", "voice", "voice_actor"),
    ]
)

# Independent of the operator's patterns: one test for each currency, the first number, and the word after it.
_MONEY = [
    ("AUD", r"A\$|\bAUD\b|Australian dollars"), ("EUR", r"€|\bEUR\b|\beuros\b"), ("GBP", r"£|\bGBP\b|pounds sterling"), ("KRW", r"₩|\bKRW\b|\bwon\b"),
    ("JPY", r"\bJPY\b|\byen\b|万円|\(Japan\)"), ("CNY", r"\bCNY\b|\bRMB\b|\byuan\b|万元|\(China\)"), ("INR", r"₹|\bINR\b|\brupees\b|Rs\.|\bcrore\b|\blakhs\b"), ("USD", r"\$|\bUSD\b|dollars"),
]
_SCALED = [("lakhs", 100000), ("crore", 10000000), ("cr", 10000000), ("Cr", 10000000), ("万", 10000), ("bn", 1000000000), ("billion", 1000000000), ("Mio.", 1000000), ("million", 1000000), ("m", 1000000), ("k", 1000)]
_NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?(?:e\+[0-9]+)?"
_AFTER = "(" + "|".join(w.replace(".", r"\.") for w, _ in _SCALED) + ")"
_P2 = rf"""with t as (select film_id, budget_usd as v, budget_local as l, upper(trim(budget_currency)) as c, budget_source as t from film_meta where budget_usd <> 0),
u as (select *, case {" ".join(f"when regexp_matches(t, '{p}') then '{c}'" for c, p in _MONEY)} end as unit,
  case when regexp_matches(t, '000s|''000|thousands of') then 1000 when regexp_matches(t, 'USD mn|\$ millions') then 1000000 end as phrase from t),
n as (select *, case when phrase is null then try_cast(replace(regexp_extract(t, '({_NUMBER})', 1), ',', '') as double) end as number,
  case when phrase is null then regexp_extract(t, '{_NUMBER} ?{_AFTER}(?:[^a-z]|$)', 1) end as word from u),
f as (select n.*, case {" ".join(f"when word = '{w}' then {m}" for w, m in _SCALED)} else coalesce(phrase, 1) end as factor, a.units_per_usd as ur, b.units_per_usd as cr
  from n left join fx_rates a on a.currency = n.unit left join fx_rates b on b.currency = n.c),
g as (select *, abs(v - number * factor / ur) <= 0.006 * greatest(abs(v), number * factor / ur) as conv, abs(v - number * factor) <= 0.006 * greatest(abs(v), number * factor) as whole,
  abs(v - number) <= 0.006 * greatest(abs(v), number) as part, abs(v - l / cr) <= 0.006 * greatest(abs(v), l / cr) as lconv, abs(v - l) <= 0.006 * greatest(abs(v), l) as lwhole from f),
r as (select film_id, v, coalesce(case when unit is not null then unit end, case when cr is not null then c end) as named,
  case when conv then 'USD' when whole or part or (number is null and unit is not null) then unit when lconv then 'USD' when lwhole and cr is not null then c end as cur,
  case when conv or whole then 1 when part or (number is null and unit is not null) then factor when lconv or (lwhole and cr is not null) then 1 end as mult from g),
e as (select r.*, v * mult / x.units_per_usd as usd, y.units_per_usd as lr from r left join fx_rates x on x.currency = cur left join fx_rates y on y.currency = named and named <> 'USD'),
m as (select coalesce(e.film_id, k.film_id) as film_id, e.v, e.cur, e.mult, e.usd, case when named <> 'USD' then named end as named, lr, k.budget as b
  from e full join (select film_id, budget from tmdb_cache where budget <> 0) k on e.film_id = k.film_id),
w as (select 'film_meta' as tbl, film_id, v as s, b as est, named, lr, cur, mult from m where v is not null union all
  select 'tmdb_cache', film_id, b, usd, named, lr, null, null from m where b is not null),
o as (select *, abs(ln(s / est)) as d1, abs(ln(s * 1000 / est)) as d2, abs(ln(s * 1000000 / est)) as d3, coalesce(abs(ln(s / lr / est)), 1e9) as d4 from w),
p as (select tbl, film_id, s, case when cur is not null then cur when est is null or d1 <= ln(3) or least(d1, d2, d3) <= d4 then 'USD' else named end as currency,
  (case when cur is not null then mult when est is null then case when abs(s) < 10000 then 1000000 else 1 end when d1 <= ln(3) then 1 when d4 < least(d1, d2, d3) then 1
    when d3 <= least(d1, d2) then 1000000 when d2 <= d1 then 1000 else 1 end)::bigint as multiplier from o)"""

QUERIES = {"p2_found": p2_found, "p2_dollars": p2_dollars, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found}
SQL: dict[str, str] = {
    "p2_found": _P2 + " select tbl, film_id, currency, multiplier from p where currency <> 'USD' or multiplier <> 1",
    "p2_dollars": _P2 + " select tbl, film_id, s as stated, currency, multiplier, round(s * multiplier / units_per_usd)::bigint as usd from p join fx_rates using (currency)",
    "p4_found": _P4, "p6_found": _P6,
}
