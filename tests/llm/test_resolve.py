import random

import numpy as np
import pyarrow as pa
import pytest

from marquetry.llm.edits import close_pairs, deletion_keys
from marquetry.llm.names import edits, full_names, name_form
from marquetry.llm.resolve import linked_pairs, resolve_names

KIND = "id bigint, name string, market string, age string, g string"
WEIGHTS = {"market": 1.0, "age": 1.0}


def entities(spark, rows, **how):
    df = spark.createDataFrame(rows, KIND)
    return {r["id"]: r["entity"] for r in resolve_names(spark, df, "id", "name", WEIGHTS, **how).collect()}


def test_forms_agree():
    same = ["Kenji Basdimel", "KENJI  BASDIMEL", "Basdimel, Kenji", "Basdimel Kenji", "KenjiBasdimel", "Kenji Bas dimel", "Kenji R. Basdimel", "Kenji Basdymel", "Kenji Basdimel, Jr.", "Dr Kenji Basdimel", "Kenji Basdimel (voice)", "Kenji 'Ace' Basdimel", "Kenji Basdimelle"]
    key = name_form(same[0]).spelling
    for s in same:
        f = name_form(s)
        assert key in (f.spelling, *f.keys), s
    assert name_form("Nate Losshuteth").spelling == name_form("Nathaniel Losschuteth").spelling
    assert name_form("InÃ©s van Losshuteth").spelling == name_form("Inés van Losshuteth").spelling
    for s in ("K. Basdimel", "Basdimel, K.", "BASDIMEL K"):
        assert (name_form(s).initial, name_form(s).family) == ("k", name_form(same[0]).family)


@pytest.mark.parametrize("text", [None, "", "  ", "-", "Jr.", "(voice)", '"'])
def test_no_name(text):
    assert name_form(text).spelling == ""


def near(words, size=40):
    """Pairs of words that meet, by batches of `size` rows."""
    index, key, mark = deletion_keys(words, np.zeros(len(words), np.uint64))
    order = np.argsort(key, kind="stable")
    rows = pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (index, key, mark)], names=["node", "key", "mark"])
    batches = (rows.slice(i, size) for i in range(0, len(order), size))
    return {(m, n): s for b in close_pairs(batches) for m, n, s in zip(*(b.column(c).to_pylist() for c in range(3)))}


def test_edit_keys():
    random.seed(3)
    words = sorted({"".join(random.choice("abc") for _ in range(random.randint(0, 6))) for _ in range(150)})
    found = near(words)
    assert set(found) == {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if edits(words[i], words[j]) == 1}
    assert all(s == (min(len(words[i]), len(words[j])) <= 5) for (i, j), s in found.items())
    long = "abcdefghij" * 300
    assert set(near([long, long[:1500] + "x" + long[1500:], long[:700] + "x" + long[701:], long[:-1] + "xx"])) == {(0, 1), (0, 2)}
    assert near([]) == {} and edits("abc", "xyz") == 3


def test_short_forms(spark):
    assert set(full_names("alex")) == {"alexander", "alexandra"} and full_names("hettie") == ["henrietta"] and full_names("luc") == ["luc"]
    # a short form of two names goes to the one that agrees, or to the only one there is
    rows = [
        (1, "Samuel Fokhosel", "US", "40s", "x"), (2, "Samantha Fokhosel", "UK", "20s", "x"), (3, "Sam Fokhosel", "UK", "20s", "x"), (4, "Sammy Fokhosel", "US", "40s", "x"),
        (5, "Ned Basdimel", None, None, "x"), (6, "Edward Basdimel", "UK", None, "x"), (7, "Ned Basdmiel", "UK", None, "x"), (8, "Edmund Krulk", "UK", "20s", "x"), (9, "Edward Krulk", "UK", "20s", "x"), (10, "Ed Krulk", "UK", "20s", "x"),
    ]
    e = entities(spark, rows)
    assert (e[3], e[4]) == (2, 1) and e[1] != e[2] and e[5] == e[6] == e[7] == 5 and len({e[8], e[9], e[10]}) == 3


def test_short_names_need_agreement(spark):
    rows = [(1, "Bo Lee", "US", "40s", "x"), (2, "Bo Lea", "US", "40s", "x"), (3, "Bo Lex", None, None, "x"), (4, "Ulla Kronvik", None, None, "x"), (5, "Ulla Kronvig", None, None, "x")]
    e = entities(spark, rows)
    assert e[1] == e[2] and e[3] == 3 and e[4] == e[5]


def test_long_chain(spark):
    """Each spelling is one edit from the next only."""
    names, last = [], "Ulla Kronvikovanomedelisutra"
    for i in range(24):
        last = last[: 5 + i] + "x" + last[6 + i :]
        names.append(last)
    assert set(entities(spark, [(i, n, None, None, "x") for i, n in enumerate(names)]).values()) == {0}


def test_linking(spark):
    rows = [
        (1, "Kenji Basdimel", "India", "child", "x"), (2, "K. Basdimel", "India", "child", "x"), (3, "Basdimel, Kenji", "India", None, "x"), (4, "Kenji Basdmiel", "India", "child", "x"),
        (5, "Katherine Basdimel", "US", "70+", "x"), (6, "K Basdimel", "US", "70+", "x"), (7, "Kenji Basdimelov", "India", "child", "x"), (8, "Kenji Basdimel", "India", "child", "y"),
        (9, None, None, None, "x"), (10, "", None, None, "x"), (11, "Ulla Tuslosette", None, None, "x"), (12, "Ulla  TUSLOSETTE", None, None, "x"), (12, "Ulla Tuslosette", "UK", None, "x"),
    ]
    e = entities(spark, rows, within="g")
    assert e[1] == e[2] == e[3] == e[4] == 1
    assert e[5] == e[6] == 5
    assert e[7] == 7 and e[8] == 8 and e[9] == 9 and e[10] == 10
    assert e[11] == e[12] == 11


def test_a_merge_brings_a_further_merge(spark):
    # the initial agrees with nobody by its age alone; only the merged profile has both its market and its age
    rows = [(1, "Hubert Fokhosel", "China", None, "x"), (2, "Hubert Fokhosell", None, "20s", "x"), (3, "H. Fokhosel", "China", "20s", "x"), (4, "Henrietta Fokhosel", "China", "60s", "x")]
    assert len({entities(spark, rows)[i] for i in (1, 2, 3)}) == 1


def test_hot_name_and_empty(spark):
    rows = [(i, "Odalys Brennavoss", "US", "40s", "x") for i in range(120)] + [(500, "O. Brennavoss", "US", "40s", "x")]
    e = entities(spark, rows)
    assert set(e.values()) == {0}
    assert entities(spark, []) == {}
    df = resolve_names(spark, spark.createDataFrame(rows[:4], KIND), "id", "name", WEIGHTS)
    assert linked_pairs(df, "id").count() == 6


def test_long_name(spark):
    long = "Ann " + "Q" * 5000 + "x"
    assert entities(spark, [(1, long, None, None, "x"), (2, long.upper(), None, None, "x")]) == {1: 1, 2: 1}
