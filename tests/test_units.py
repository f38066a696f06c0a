import pytest
from pyspark.sql import functions as F

from marquetry.operators.units import nearest_reading, read_units, text_amount

AMOUNTS = {
    "Reel (citing €41.6m)": (41.6, "EUR", 1_000_000),
    "Reel: 2.4 Mio. EUR, stated here in US dollars": (2.4, "EUR", 1_000_000),
    "about EUR 7500k per Reel": (7500.0, "EUR", 1_000),
    "12,300,000 pounds sterling": (12300000.0, "GBP", 1),
    "Rs. 206.5 cr": (206.5, "INR", 10_000_000),
    "177.5 crore": (177.5, "INR", 10_000_000),
    "₹86Cr": (86.0, "INR", 10_000_000),
    "42 lakhs": (42.0, "INR", 100_000),
    "21500万円": (21500.0, "JPY", 10_000),
    "780万元": (780.0, "CNY", 10_000),
    "¥470m (Japan)": (470.0, "JPY", 1_000_000),
    "₩27.39 bn": (27.39, "KRW", 1_000_000_000),
    "565m won": (565.0, "KRW", 1_000_000),
    "A$5.7m": (5.7, "AUD", 1_000_000),
    "56.7 million Australian dollars": (56.7, "AUD", 1_000_000),
    "US$2.37m": (2.37, "USD", 1_000_000),
    "Reel, amounts in USD mn (reported)": (None, "USD", 1_000_000),
    "Reel, in $000s": (None, "USD", 1_000),
    "Reel, USD '000": (None, "USD", 1_000),
    "Reel, $ millions": (None, "USD", 1_000_000),
    "Reel, figures in thousands of US dollars": (None, "USD", 1_000),
    "Reel, sum in Rs. (rumoured)": (None, "INR", 1),
    "Reel, yuan figure": (None, "CNY", 1),
    "Silver Rupee Cinema Journal (reported)": (None, None, None),
    "Pound Lane Review": (None, None, None),
    "": (None, None, None),
}


def test_text_amounts(spark):
    df = spark.createDataFrame([(k,) for k in AMOUNTS] + [(None,)], "t string")
    found = {r["t"]: (r["t_number"], r["t_unit"], r["t_factor"]) for r in text_amount(spark, df, "t").collect()}
    assert found.pop(None) == (None, None, None)
    assert found == AMOUNTS


def test_readings(spark):
    rates = spark.createDataFrame([("USD", 1.0), ("EUR", 0.92), ("INR", 83.0), ("KRW", 1340.0)], "currency string, units double")
    rows = [
        (1, 45217391.0, "converted from €41.6m", "EUR", 41600000.0, "USD", 1),
        (2, 41600000.0, "citing €41.6m", None, None, "EUR", 1),
        (3, 41.6, "€41.6m", "USD", 41600000.0, "EUR", 1_000_000),
        (4, 27.39e9, "₩27.39 bn", "USD", None, "KRW", 1),
        (5, 195e6, "Silver Rupee Journal", "INR", 195e6, "INR", 1),
        (6, 2349398.0, None, "INR", 195e6, "USD", 1),
        (7, 980e6, None, None, None, None, None),
        (8, None, "€41.6m", None, None, None, None),
        (9, 0.0, "€41.6m", None, None, None, None),
        (10, 5.0, "€41.6m", None, None, None, None),
    ]
    df = spark.createDataFrame([r[:5] for r in rows], "id int, v double, text string, unit string, local double")
    out = read_units(spark, df, rates, "v", "text", "unit", "local").collect()
    assert {r["id"]: (r["r_unit"], r["r_multiplier"]) for r in out} == {r[0]: r[5:] for r in rows}


@pytest.mark.parametrize("value,estimate,expected", [(45.2, 44e6, ("USD", 1_000_000)), (3869.0, 3.7e6, ("USD", 1_000)), (6.0e9, 7.2e7, ("INR", 1)), (5e6, 9e6, ("USD", 1)), (2.8, None, ("USD", 1_000_000)), (5e6, None, ("USD", 1)), (None, 5.0, None), (0.0, 5.0, None)])
def test_nearest(spark, value, estimate, expected):
    df = spark.createDataFrame([(value, estimate)], "v double, e double")
    r = df.select(nearest_reading(F.col("v"), F.col("e"), F.lit("INR"), F.lit(83.0)).alias("r")).first()["r"]
    assert (r and (r["unit"], r["multiplier"])) == expected
