from marquetry.operators.diff import compare_copies, long_form

KIND = "id bigint, t string, n double, a array<string>, s array<struct<o:int,name:string>>"


def _run(spark, left, right, **how):
    a, b = spark.createDataFrame(left, KIND), spark.createDataFrame(right, KIND)
    return sorted((r["row_key"], r["field"], r["kind"]) for r in long_form(compare_copies(a, b, "id", **how)).collect())


def test_rules(spark):
    left = [
        (1, " Ab  c", 100.0, ["x", None], [(1, "P")]), (2, None, None, None, None), (3, "a", 1.0, ["b", "a"], []), (4, "only", None, None, None), (5, "q", 0.0, None, [(1, "X"), (2, "Y")]),
    ]
    right = [
        (1, "aB C ", 100.005, ["X "], [(1, "p ")]), (2, "", None, [], []), (3, "b", 1.1, ["a", "b", "a"], None), (6, "only", None, None, None), (5, "q", None, None, [(2, "Y"), (1, "X")]),
    ]
    for unique in (True, False):
        assert _run(spark, left, right, unique_keys=unique) == [(3, "n", "differs"), (3, "t", "differs"), (4, "row", "only_left"), (5, "n", "differs"), (6, "row", "only_right")]


def test_repeated_and_null_keys(spark):
    row = (None, "a", None, None, None)
    assert _run(spark, [row, row, row], [row, row]) == [(None, "row", "only_left")]
    assert _run(spark, [(1, "a", None, None, None)] * 2, [(1, "a", None, None, None)] * 2) == []


def test_empty_side(spark):
    assert _run(spark, [], [(1, "a", None, None, None)]) == [(1, "row", "only_right")]
    assert _run(spark, [], []) == []


def test_text_key_and_clashing_columns(spark):
    a = spark.createDataFrame([("Ann  Lee", "x", 1)], "name string, k string, here int")
    b = spark.createDataFrame([(" ann lee", "y", 1, 5)], "name string, k string, here int, more int")
    found = [tuple(r) for r in long_form(compare_copies(a, b, "name", text_key=True)).collect()]
    assert found == [("ANN LEE", "k", "differs", "x", "y")]


def test_differences_array(spark):
    a, b = spark.createDataFrame([(1, "x", 1.0, None, None)], KIND), spark.createDataFrame([(1, "y", 2.0, None, None)], KIND)
    row = compare_copies(a, b, "id").first()
    assert [(d["field"], d["left"], d["right"]) for d in row["differences"]] == [("t", "x", "y"), ("n", "1.0", "2.0")]
