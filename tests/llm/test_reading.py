import numpy as np
import pytest

from marquetry.llm.boosting import fit_trees, isotonic
import re

from marquetry.llm import textstats
from marquetry.llm.reading import reading_levels, reading_model
from marquetry.llm.textstats import FEATURES, text_features

EASY = ["The cat is here.", "Mum says no.", "A dog can run.", "Look! It is a red kite.", "They go to bed."]
HARD = [
    "The asymmetrical reciprocity of spectatorship presupposes hegemonic configurations of domesticity.",
    "Insofar as the narration withholds focalisation, the text interrogates conventional taxonomies of affiliation.",
    "Notwithstanding the aforementioned indemnification, remuneration shall be construed as contingent.",
    "Epistemological indeterminacy, whereby representation is disavowed, necessitates a phenomenological critique.",
]
PLAIN = ["The film opens on Friday in most large cities.", "Sales were strongest in cities with weekday screenings.", "The director began as a sound mixer before this film.", "Viewers who liked the first film should enjoy this one."]


def corpus(n=240):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        band = (1, 3, 5)[i % 3]
        pool = {1: EASY, 3: PLAIN, 5: HARD}[band]
        rows.append((i, " ".join(rng.choice(pool, 4)), f"s{i % 4}", band))
    return rows


def test_features():
    texts = [None, "", "<p>Hello there. Hello again!</p>", "word " * 200_000, "12 -- 3", "L'été, c'est bien ; l'hiver: non?\nOui", "𠀀 😀 İx"] + [r[1] for r in corpus(60)]
    base, owner, bucket = text_features(texts)
    words = np.bincount(owner, minlength=len(texts))
    assert base.shape == (len(texts), len(FEATURES)) and np.isfinite(base).all()
    assert not base[[0, 1, 4]].any() and words[[0, 1, 4]].tolist() == [0, 0, 0] and words[2] == 3
    at = {f: i for i, f in enumerate(FEATURES)}
    assert base[3, 0] == pytest.approx(np.log1p(200_000)) and base[5, at["clause_mean"]] == pytest.approx(6 / 5)
    # against plain counting
    for t, row in zip(texts[7:], base[7:]):
        w = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", t)
        s = [len(re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", x)) for x in re.split(r"[.!?…]+(?=\s|$)|\n+", t)]
        s = [x for x in s if x]
        assert row[at["sent_mean"]] == pytest.approx(np.mean(s)) and row[at["sent_q90"]] == pytest.approx(np.quantile(s, 0.9))
        assert row[at["word_q90"]] == pytest.approx(np.quantile([len(x) for x in w], 0.9)) and row[at["variety"]] == pytest.approx(len({x.lower() for x in w}) / len(w) ** 0.8)
        assert row[at["function"]] == pytest.approx(np.mean([x.lower() in textstats.FUNCTION_WORDS for x in w]))
    # chunks make no difference
    whole, textstats.CHUNK = textstats.CHUNK, 50
    try:
        assert np.allclose(text_features(texts)[0], base) and (text_features(texts)[1] == owner).all()
    finally:
        textstats.CHUNK = whole


def test_trees():
    rng = np.random.default_rng(0)
    x = rng.random((600, 5))
    y = 3 * (x[:, 0] > 0.5) + x[:, 1] + rng.normal(0, 0.05, 600)
    model = fit_trees(x[:400], y[:400])
    assert np.abs(model.predict(x[400:]) - y[400:]).mean() < 0.15
    kx, ky = isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 3, 2, 4]))
    assert (np.diff(ky) >= 0).all() and (np.diff(kx) > 0).all()
    flat = fit_trees(np.zeros((10, 2)), np.ones(10))
    assert flat.predict(np.zeros((2, 2))).tolist() == [1.0, 1.0]


def test_levels(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, s, "x") for i, t, s, _ in rows] + [(1000, None, None, "x"), (1001, "  12 ", "s0", "x")], "doc bigint, text string, source string, band string")
    marks = [(i, b) for i, _, _, b in rows[:150]] + [(0, 1), (77_777, 5), (3, None)]
    labels = spark.createDataFrame(marks, "doc bigint, grade int")
    model = reading_model(docs, labels, "doc", "text", "source", "grade")
    out = {r["doc"]: (r["level"], r["band"]) for r in reading_levels(docs, model, "doc", "text").collect()}
    assert out[1000] == out[1001] == (None, None) and len(out) == len(rows) + 2
    held = [out[i][1] == b for i, _, _, b in rows[150:] if b in (1, 5)]
    assert np.mean(held) > 0.95
    assert {r["source"] for r in model.report} == {"s0", "s1", "s2", "s3"} and all(r["error"] < 0.5 for r in model.report)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc bigint, text string, source string")
    none = spark.createDataFrame([], "doc bigint, grade int")
    assert reading_model(docs, none, "doc", "text", "source", "grade") is None
    assert reading_levels(docs, None, "doc", "text").first()["band"] is None
    one = spark.createDataFrame([(1, 3)], "doc bigint, grade int")
    assert reading_levels(docs, reading_model(docs, one, "doc", "text", "source", "grade"), "doc", "text").first()["level"] == pytest.approx(3.0, abs=0.5)
