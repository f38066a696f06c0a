import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquetry.llm.matching import FIELDS, ROW, _borders, _bound, assign, auction, candidate_rows, match_entities, one_to_one, profiles, sorted_neighbourhood, with_confidence
from marquetry.llm.graph import components
from marquetry.llm.names import skeleton, skeletons
from marquetry.llm.titles import company_key, date_days, people_keys, title_form
from marquetry.sources.scratch import Scratch

KIND = "id bigint, titles array<string>, trusts array<double>, dates array<string>, people array<string>, companies array<string>"


def test_titles():
    assert title_form("GC The Wolf of X (Hindi)") == title_form("Wolf of X") == title_form("Wolf of X, The")
    assert title_form("Seven Oaths").text == title_form("7 Oaths").text
    assert title_form("Yard: Part Two").sequel == title_form("Yard II").sequel == "2" != title_form("Yard").sequel
    assert title_form("") is None and title_form(None) is None and title_form("(2004)") is not None
    assert date_days("2020-01-31")[0] == date_days("31/01/2020")[0]
    assert date_days("2020")[1] and date_days("0000-00-00") == (None, False) and date_days("x") == (None, False)
    assert set(people_keys("Ann Lee|B. Cox")) >= set(people_keys("Lee, Ann"))
    assert company_key("JUNIPER PRODS.") == company_key("Juniper Productions") and company_key(None) is None


def run(spark, left, right):
    out = match_entities(spark, spark.createDataFrame(left, KIND), spark.createDataFrame(right, KIND))
    return {r["id"]: r["other"] for r in out.collect()}


def row(i, title, date=None, person=None, firms=None, alias=None):
    return (i, [title, alias], [1.0, 1.0], [date], [person], firms)


def test_matching(spark):
    left = [
        row(1, "GC A Fox in Purlungrad", "2010-05-01", "Ann Lee", ["Juniper Studios"]), row(2, "A Fox in Purlungrad (Hindi)", "2010-05-02", "Lee, Ann", None), row(3, "Fox in Purlungrad II", "2014-01-01", "Ann Lee", None),
        row(4, "A Fox in Purlungrad", "1950-01-01", "Bob Cox", None), row(5, "Under the Krunkulia Wi", "2009-02-03", "Cy Dee", ["Owlery Films"]), row(6, None), (7, None, None, None, None, None), row(8, "Lone Work", "2001-01-01", "Eve Fay", None),
    ]
    right = [
        row(11, "Fox in Purlungrad, A", "2010-05-05", "A. Lee", ["JUNIPER STUDIOS"]), row(12, "A Fox in Purlungrad II", "2014-01-09", "Ann Lee", None), row(13, "A Fox in Purlungrad", "1950-03-01", "Robert Cox", None),
        row(14, "Under the Krunkulia Widow", "2009-02-20", "Cy Dee", ["Owlery Films"]), row(15, None), (16, None, None, None, None, None), row(17, "Lone Work", "1961-01-01", "Gus Hay", None),
    ]
    assert run(spark, left, right) == {1: 11, 2: 11, 3: 12, 4: 13, 5: 14}
    assert run(spark, left, []) == run(spark, [], right) == {}


def test_hot_title(spark):
    random.seed(5)
    word = lambda: "".join(random.choice("bdgklmnprst") + random.choice("aeiou") for _ in range(5)).title()
    people = [f"{word()} {word()}" for _ in range(90)]
    left = [row(i, "Same Old Title", f"{1900 + i}-01-01", p, [f"{p} films"]) for i, p in enumerate(people)]
    right = [row(1000 + i, "Same Old Title", f"{1900 + i}-01-03", p, [f"{p} films"]) for i, p in enumerate(people)]
    assert run(spark, left, right) == {i: 1000 + i for i in range(90)}


def test_many_bookings(spark):
    """One work under more rows than the window has places, each of another day, among others of the same person."""
    left = [row(i, "Quiet Harbour", f"2005-{1 + i % 9:02}-{1 + i // 9:02}", "Ann Lee", ["Juniper Studios"]) for i in range(90)]
    right = [row(1000, "Quiet Harbour", "2005-06-20", "Ann Lee", ["Juniper Studios"])]
    assert run(spark, left, right) == {i: 1000 for i in range(90)}


def test_window_counts_keys(spark):
    """Rows of one key are one place, wherever partitions end."""
    spread = lambda i: (i, ["Quiet Harbour"], [1.0], ["2005-05-01"], ["Ann Lee"], ["Juniper Studios"])
    described = profiles(spark.createDataFrame([spread(i) for i in range(3 * 2048)], KIND), 0).union(profiles(spark.createDataFrame([spread(9000 + i) for i in range(3)], KIND), 1))
    assert sorted_neighbourhood(spark, candidate_rows(described)).count() == 3 * 3 * 2048
    # places over several partitions of few keys
    assert sorted(_borders({0: 20, 2: 3, 5: 20}, 12)) == [(0, 2, -20), (0, 5, -23), (2, 2, 0), (2, 5, -3), (5, 2, 3), (5, 5, 0)]


def best_total(edges):
    """The greatest total confidence, by trying every assignment of lefts."""
    lefts = sorted({e[0] for e in edges})

    def go(i, used):
        if i == len(lefts):
            return 0.0
        return max([go(i + 1, used)] + [c + go(i + 1, used | {r}) for l, r, c in edges if l == lefts[i] and r not in used])

    return go(0, frozenset())


@pytest.mark.parametrize("seed", range(12))
def test_assignment_is_best(seed):
    random.seed(seed)
    edges = [(i, 100 + j, round(random.uniform(0.6, 1.0), 3)) for i in range(random.randint(1, 7)) for j in range(random.randint(1, 5)) if random.random() < 0.6]
    got = assign([e[0] for e in edges], [e[1] for e in edges], [e[2] for e in edges]) if edges else []
    assert len({edges[e][0] for e in got}) == len(got) == len({edges[e][1] for e in got})
    assert sum(edges[e][2] for e in got) == pytest.approx(best_total(edges))


def test_assignment_over_components(spark):
    """Works that contest fewer entries at nearly equal confidences, a long chain, and pairs nobody contests."""
    random.seed(1)
    edges = [(10 * g + i, 10_000 + 10 * g + j, 0.9 + 0.0001 * ((i * j + g) % 7)) for g in range(5) for i in range(4) for j in range(3)]
    edges += [(1000 + i, 20_000 + i + d, 0.8 + 0.1 * d) for i in range(9) for d in (0, 1)] + [(5000, 50_000, 0.7)]
    df = spark.createDataFrame(edges, "left bigint, right bigint, confidence double")
    total = 15 * 0.9 + 9 * 0.9 + 0.7
    for largest in (100_000, 20):  # the chain by assignment in a task, and by auction
        got = one_to_one(Scratch(spark), df, step=0.02, largest=largest).collect()
        assert len({r["left"] for r in got}) == len(got) == len({r["right"] for r in got}) == 15 + 9 + 1
        assert total - 0.2 * (largest == 20) <= sum(r["confidence"] for r in got) <= total + 0.02
    few = spark.createDataFrame([(i, 9, 0.9) for i in range(4)] + [(i, 8, 0.89) for i in range(4)], "left bigint, right bigint, confidence double")
    assert sum(r["confidence"] for r in auction(Scratch(spark), few, 0.05).collect()) == pytest.approx(1.79)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95)] + [(200, x) for x in range(201, 230)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components(Scratch(spark), df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 90 for i in (90, 95, 100)} | {i: 200 for i in range(200, 230)}
    assert components(Scratch(spark), df.limit(0)).count() == 0


def test_assignment_of_nothing(spark):
    assert one_to_one(Scratch(spark), spark.createDataFrame([], "left bigint, right bigint, confidence double")).count() == 0


def test_skeletons():
    words = ["Schützenfest", "phoebe", "", "éé", "aee", "eeeee", "thaccooe", "0l5", "中文", "bookkeepe", "moose", "qu-een e"]
    for some in (words, words[2:4], [""], []):
        assert skeletons(some) == [skeleton(w) for w in some]


def test_title_without_words(spark):
    """Titles of nothing but marks tell nothing."""
    left = [row(1, "...", "2001-01-01", "Ann Lee", ["Juniper Studios"]), row(2, "Fox in Purlungrad", "2001-01-01", "Bob Cox", None, "-")]
    right = [row(11, "???", "2001-01-01", "Ann Lee", ["Juniper Studios"]), row(12, "Fox in Purlungrad", "2001-01-02", "Bob Cox", None, "_")]
    assert run(spark, left, right) == {2: 12}


def test_pairs_that_cannot_count(spark):
    """A pair that can't be accepted for its days, people and companies is no candidate, unless less is asked."""
    side = lambda i, date, person: profiles(spark.createDataFrame([row(i, "Quiet Harbour", date, person, None)], KIND), i)
    far, near = (side(0, "2005-05-01", "Ann Lee").union(side(1, date, "Gustav Hayworth")) for date in ("2006-12-01", "2005-05-20"))
    pairs = lambda d, accept: sorted_neighbourhood(spark, candidate_rows(d, accept=accept), accept=accept).count()
    assert (pairs(far, 0.6), pairs(far, 0.5), pairs(near, 0.6)) == (0, 1, 1)


def test_bound(spark):
    """No pair's confidence exceeds what the candidates are chosen by."""
    random.seed(7)
    pick = lambda values, most: [random.choice(values) for _ in range(random.randint(0, most))]
    people = ["Ann Lee", "Lee, Ann", "A. Lee", "An Leigh", "Bo Cox", "Ann", "Lea", "X", "N/A", "", None, "Gustav Hayworth", "Gustaf Haywort|Bo Fox", "G. Hayworh"]
    dates = ["2005-05-01", "2005-05-20", "2005-12-01", "2006-07-01", "2009-01-01", "2005", "2011", "x", None]
    one = lambda i: (i, ["Quiet Harbour", random.choice(["Quiet Harbor", "Loud Harbour", None])], [1.0, 0.6], pick(dates, 3), pick(people, 2), pick(["Owlery Films", "Juniper", "Moss", None], 3))
    described = profiles(spark.createDataFrame([one(i) for i in range(60)], KIND), 0).union(profiles(spark.createDataFrame([one(i) for i in range(60)], KIND), 1)).cache()
    a = described.filter("side = 0").select("id", F.struct(*FIELDS).alias("f"))
    b = described.filter("side = 1").select(F.col("id").alias("other"), F.struct(*FIELDS).alias("e"))
    scored = with_confidence(a.crossJoin(b), "f", "e").select("id", "other", "confidence").toPandas()
    rows = described.orderBy("side", "id").toPandas()
    rows = {c: rows[c].to_numpy(float if c in ("day", "last") else None) for c in ROW if c in rows}
    most = _bound(rows, scored["id"].to_numpy(), 60 + scored["other"].to_numpy())
    assert (scored["confidence"] <= most + 1e-9).all()
    assert 200 < (most < 0.6).sum() and (scored["confidence"] >= 0.6).sum() > 200
    described.unpersist()
