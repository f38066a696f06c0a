from pyspark.sql import functions as F

from marquetry.operators.nested import Level, canonical_list, canonical_objects, flatten_list, flatten_tree, unwrap_json

DEEP = [Level("studio", "studios", "name", (Level("deal", "deals", "territory"),))]


def _studios(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, record string")
    part = F.from_json(unwrap_json(F.col("record")), "struct<studios string>")["studios"]
    return df.select("id", canonical_objects(part, "name", "deals", "territory").alias("studios"), F.lit(7).alias("pos"))


def test_shapes(spark):
    texts = [
        '{"studios": [{"name": "A", "deals": [{"territory": "X"}, null, {"territory": "Y"}]}, null, "B"]}',
        '{"studios": {"name": "C", "deals": {"territory": "Z"}}}',
        '{"studios": {"items": [{"name": "D"}, "E"]}}',
        '{"studios": "F"}',
        '{"studios": "[{\\"name\\": \\"G\\"}]"}',
        '"{\\"studios\\": [\\"H\\"]}"',
        '{"studios": null}',
        "{}",
        "no json",
        None,
        '{"studios": [{"deals": ["W"]}]}',
    ]
    rows = sorted(map(tuple, flatten_tree(_studios(spark, texts), "id", DEEP).collect()), key=str)
    assert rows == sorted(
        [
            (0, "studio", 0, 1, "A"), (0, "deal", 1, 1, "X"), (0, "deal", 1, 3, "Y"), (0, "studio", 0, 3, "B"),
            (1, "studio", 0, 1, "C"), (1, "deal", 1, 1, "Z"), (2, "studio", 0, 1, "D"), (2, "studio", 0, 2, "E"),
            (3, "studio", 0, 1, "F"), (4, "studio", 0, 1, "G"), (5, "studio", 0, 1, "H"), (10, "studio", 0, 1, None), (10, "deal", 1, 1, "W"),
        ],
        key=str,
    )


def test_typed_tables(spark):
    kind = "id bigint, studios array<struct<order:int,name:string,deals:array<struct<territory:string,share:double>>>>"
    df = spark.createDataFrame([(1, [(1, "A", [("X", 0.5)]), None, (2, "B", None)]), (2, None), (3, []), (1, [(1, "A", [])])], kind)
    top = sorted(map(tuple, flatten_list(df, "id", "studios").select("row_key", "pos", "order", "name").collect()))
    assert top == [(1, 1, 1, "A"), (1, 1, 1, "A"), (1, 3, 2, "B")]
    deep = [tuple(r) for r in flatten_list(df, "id", "studios", "deals").collect()]
    assert deep == [(1, 1, 1, "X", 0.5)]


def test_empty_table(spark):
    assert flatten_tree(_studios(spark, [None]).filter("id > 5"), "id", DEEP).count() == 0


def test_canonical_list(spark):
    df = spark.createDataFrame([("[1, \"a\"]",), ("x",), ("[broken",), (None,)], "t string")
    out = [r[0] for r in df.select(canonical_list(F.col("t"))).collect()]
    assert out[0] == ["1", "a"] and out[1] == ["x"] and out[3] is None
