"""One quantity recorded in different units and scales (problem 2). Pure SQL expressions and joins to small alias tables.

A stored number S comes with a text that may quote an amount (number, scale word, unit), a unit field, and a second
field that holds the amount in whole local units. Each of these proposes readings of S, i.e. a unit and a multiplier;
a reading with a quoted amount holds only if it reproduces the amount. Where nothing on the row tells, an independent
estimate of the same quantity chooses the reading that comes nearest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How currencies are written, in lower case, and the currency meant.
CURRENCY_ALIASES = {
    "usd": "USD", "us$": "USD", "$": "USD", "dollars": "USD", "us dollars": "USD",
    "eur": "EUR", "€": "EUR", "euros": "EUR", "euro": "EUR",
    "gbp": "GBP", "£": "GBP", "pounds sterling": "GBP", "pounds": "GBP",
    "inr": "INR", "₹": "INR", "rs.": "INR", "rs": "INR", "rupees": "INR", "indian rupees": "INR",
    "jpy": "JPY", "¥ (japan)": "JPY", "¥": "JPY", "円": "JPY", "yen": "JPY", "japanese yen": "JPY",
    "cny": "CNY", "rmb": "CNY", "¥ (china)": "CNY", "元": "CNY", "yuan": "CNY", "chinese yuan": "CNY", "renminbi": "CNY",
    "krw": "KRW", "₩": "KRW", "won": "KRW", "korean won": "KRW",
    "aud": "AUD", "a$": "AUD", "australian dollars": "AUD",
}
# Scale words in lower case, their factor, and the currency they imply where none is written.
SCALES = {
    "k": (1_000, None), "'000": (1_000, None), "000s": (1_000, None), "thousands of": (1_000, None), "thousand": (1_000, None),
    "m": (1_000_000, None), "mn": (1_000_000, None), "mio.": (1_000_000, None), "million": (1_000_000, None),
    "millions": (1_000_000, None), "millions of": (1_000_000, None),
    "bn": (1_000_000_000, None), "billion": (1_000_000_000, None), "b": (1_000_000_000, None),
    "cr": (10_000_000, "INR"), "crore": (10_000_000, "INR"), "crores": (10_000_000, "INR"),
    "lakh": (100_000, "INR"), "lakhs": (100_000, "INR"), "万": (10_000, None),
}
UNIT_WORD = r"US\$|A\$|\$|€|£|₹|₩|¥|円|元|Rs\.?|EUR|USD|GBP|INR|JPY|CNY|RMB|KRW|AUD|euros?|(?:Australian |US )?dollars|pounds(?: sterling)?|(?:Indian )?rupees|(?:Japanese )?yen|(?:Chinese )?yuan|renminbi|(?:Korean )?won"
NUMBER = r"\d[\d,]*(?:\.\d+)?(?:[eE]\+?\d+)?"
SCALE_WORD = r"Mio\.|millions?|mn|m|billion|bn|b|thousand|k|crores?|Cr|cr|lakhs?|万"
# unit, number, scale, unit, country
AMOUNT = rf"(?:^|(?<![\w$]))({UNIT_WORD})?\s?({NUMBER})\s?(?:({SCALE_WORD})(?!\w))?\s?({UNIT_WORD})?(?!\w)(?:\s?\((Japan|China)\))?"
AMOUNT_CJK = rf"({UNIT_WORD})?\s?({NUMBER})\s?(万)()({UNIT_WORD})"
# the last phrase of the text names a unit without an amount: scale, unit, scale
PHRASE = rf"(?:^|, )(?:(?:amounts?|figures?|sum) )?(?:in )?(thousands of |millions of )?({UNIT_WORD})(?: figure)?\s?(mn|'000|000s|millions)?\s*(?:\([^()]*\))?\s*$"
TOLERANCE = 0.006


def alias_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The fixed alias tables (some dozens of rows, whatever the data's size)."""
    units = spark.createDataFrame(list(CURRENCY_ALIASES.items()), "_ta string, _tu string")
    scales = spark.createDataFrame([(k, f, u) for k, (f, u) in SCALES.items()], "_sa string, _sf bigint, _su string")
    return units, scales


def _part(text: Column, pattern: str, group: int) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", F.lower(F.trim(found)))


def text_amount(spark: SparkSession, df: DataFrame, text: str) -> DataFrame:
    """`df` with t_number, t_unit, t_factor: the amount, unit and scale that the text column names, each null if absent.

    Extra columns keep their names; null and empty texts give nulls.
    """
    t = F.regexp_replace(F.col(text), r"(?U)\s+", " ")
    cjk = t.rlike(AMOUNT_CJK)
    has = cjk | t.rlike(AMOUNT)
    pick = lambda a, c: F.when(cjk, _part(t, AMOUNT_CJK, c)).otherwise(_part(t, AMOUNT, a))
    unit = F.coalesce(pick(1, 1), pick(4, 5))
    country = F.when(~cjk, _part(t, AMOUNT, 5))
    unit = F.when(unit.isin("¥") & country.isNotNull(), F.concat(unit, F.lit(" ("), country, F.lit(")"))).otherwise(unit)
    phrase = ~has | (pick(1, 1).isNull() & pick(4, 5).isNull() & pick(3, 3).isNull())
    p_scale = F.coalesce(_part(t, PHRASE, 1), _part(t, PHRASE, 3))
    number = F.when(~phrase, F.regexp_replace(pick(2, 2), ",", "").try_cast("double"))
    raw = df.withColumns(
        {
            "t_number": number,
            "_alias": F.coalesce(F.when(~phrase, unit), F.when(phrase, _part(t, PHRASE, 2))),
            "_scale": F.coalesce(F.when(~phrase, pick(3, 3)), F.when(phrase, p_scale)),
        }
    )
    units, scales = alias_tables(spark)
    return (
        raw.join(F.broadcast(units), raw["_alias"] == units["_ta"], "left")
        .join(F.broadcast(scales), raw["_scale"] == scales["_sa"], "left")
        .withColumn("t_unit", F.coalesce("_tu", "_su"))
        .withColumn("t_factor", F.when(F.col("t_unit").isNotNull(), F.coalesce("_sf", F.lit(1))))
        .drop("_alias", "_scale", "_ta", "_tu", "_sa", "_sf", "_su")
    )


def near(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """a and b are equal but for rounding; null if either is null."""
    return F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b))


def _rated(df: DataFrame, rates: DataFrame, unit: str, out: str) -> DataFrame:
    """`df` with the units per common unit of the column `unit` as `out`; rates is a small table of fixed size."""
    r = rates.select(F.upper(F.trim(rates.columns[0])).alias("_u"), F.col(rates.columns[1]).cast("double").alias(out))
    return df.join(F.broadcast(r), df[unit] == r["_u"], "left").drop("_u")


def read_units(
    spark: SparkSession,
    df: DataFrame,
    rates: DataFrame,
    value: str,
    text: str | None = None,
    unit: str | None = None,
    local: str | None = None,
    common: str = "USD",
) -> DataFrame:
    """`df` with what each row itself tells of the unit and scale of `value`.

    Added: r_unit and r_multiplier (value x r_multiplier is in whole r_unit; null where nothing tells), r_rate (of
    r_unit), r_local (another unit than the common one that the row names, if any) and l_rate.
    In order: a quoted amount that the value reproduces (converted: common unit; itself: the text's unit; its number
    without the scale word: the text's unit and scale); a phrase of the text; the local amount with the unit field
    (converted: common unit; itself: that unit). A quoted amount that the value does not reproduce tells nothing.
    Null and zero values tell nothing. rates: (unit, units per common unit), a table of fixed size, is broadcast.
    """
    none = F.lit(None)
    work = df.withColumn("_text", F.col(text) if text else none.cast("string"))
    work = text_amount(spark, work, "_text")
    work = work.withColumn("_unit", F.upper(F.trim(F.col(unit))) if unit else none.cast("string"))
    work = _rated(_rated(work, rates, "t_unit", "_t_rate"), rates, "_unit", "_u_rate")
    v, number = F.col(value).cast("double"), F.col("t_number")
    amount = number * F.col("t_factor")
    loc = F.col(local).cast("double") if local else none.cast("double")
    say = lambda u, m: F.struct(u.alias("u"), F.lit(m).cast("bigint").alias("m"))
    t_say = lambda m: F.struct(F.col("t_unit").alias("u"), m.cast("bigint").alias("m"))
    reading = F.coalesce(
        F.when(near(v, amount / F.col("_t_rate")), say(F.lit(common), 1)),
        F.when(near(v, amount), t_say(F.lit(1))),
        F.when(near(v, number), t_say(F.col("t_factor"))),
        F.when(number.isNull() & F.col("_t_rate").isNotNull(), t_say(F.col("t_factor"))),
        F.when(near(v, loc / F.col("_u_rate")), say(F.lit(common), 1)),
        F.when(near(v, loc) & F.col("_u_rate").isNotNull(), say(F.col("_unit"), 1)),
    )
    work = work.withColumn("_r", F.when(v != 0, reading))
    named = F.coalesce(F.when(F.col("_t_rate").isNotNull(), F.col("t_unit")), F.when(F.col("_u_rate").isNotNull(), F.col("_unit")))
    work = work.withColumns({"r_unit": F.col("_r.u"), "r_multiplier": F.col("_r.m"), "r_local": F.when(named != common, named)})
    work = _rated(_rated(work, rates, "r_unit", "r_rate"), rates, "r_local", "l_rate")
    return work.drop("_text", "_unit", "_t_rate", "_u_rate", "_r", "t_number", "t_unit", "t_factor")


def nearest_reading(value: Column, estimate: Column, local: Column, local_rate: Column, common: str = "USD", honest: float = 3.0, least: float = 10_000.0) -> Column:
    """The reading (unit, multiplier) of a bare number that comes nearest to an independent estimate.

    The plain reading, whole common units, stands if it is within a factor of `honest` of the estimate; else the
    candidates are thousands and millions of the common unit and whole local units. Without an estimate
    the number counts as whole common units, or as millions if it is under `least`, which no such quantity is.
    Null for a null or zero value.
    """
    v = value.cast("double")
    option = lambda u, m, rate: F.struct(F.abs(F.log(v * m / rate / estimate)).alias("d"), u.alias("unit"), F.lit(m).cast("bigint").alias("multiplier"))
    usd = F.lit(common)
    options = [option(usd, 1, 1.0), option(usd, 1_000, 1.0), option(usd, 1_000_000, 1.0), option(local, 1, local_rate)]
    nearest = F.array_min(F.filter(F.array(*options), lambda o: o["d"].isNotNull()))
    best = F.when(options[0]["d"] <= F.log(F.lit(honest)), options[0]).otherwise(nearest)
    bare = F.struct(F.lit(0.0).alias("d"), usd.alias("unit"), F.when(F.abs(v) < least, F.lit(1_000_000)).otherwise(F.lit(1)).cast("bigint").alias("multiplier"))
    return F.when(v != 0, F.when(estimate > 0, best).otherwise(bare))
