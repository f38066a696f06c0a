import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marquetry.functions import entities as E
from marquetry.functions import jsonx as J
from marquetry.functions import similarity
from marquetry.functions import titles as X
from marquetry.functions.similarity import indel_ratio
from marquetry.operators import curate, encode, profile, upsert, variants
from marquetry.operators.enrich import Answer, RateLimited, ReplayProvider, best_hit, empty, enrich, with_retries
from marquetry.sources import files, warehouse

TITLES = {
    "FFS - All About E": "All About E",
    "3D Kanguva (Hindi)": "Kanguva",
    "Rocketry - The Nambi Effect (Tamil)": "Rocketry - The Nambi Effect",
    "Dunkirk - 70mm": "Dunkirk",
    "Title [French Film Festival]": "Title",
    "Skyfall": "Skyfall",
    "AFI - 3D Something New (Tamil) (2004)": "Something New",
    "Up - Gala": "Up - Gala",
    "A Long Title - Gala": "A Long Title",
    "Shiri 4K Remastering": "Shiri",
}


def value(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_title_cleaning(spark):
    df = spark.createDataFrame([(t,) for t in TITLES] + [(None,), ("",)], "t string")
    once = df.withColumn("c", X.clean_title("t"))
    found = {r["t"]: r["c"] for r in once.collect()}
    assert found.pop(None) is None and found.pop("") == ""
    assert found == TITLES
    assert once.filter(~X.clean_title("c").eqNullSafe(F.col("c"))).count() == 0


def test_title_tags(spark):
    tags = value(spark, X.title_tags(F.lit("3D Kanguva (Hindi)")))
    assert tags == {"3d_prefix": "3D", "language_bracket": "(Hindi)"}
    assert value(spark, X.title_tags(F.lit("Plain"))) == {}


def test_names(spark):
    assert value(spark, E.actor_names(F.lit("AND Yoon Kye-sang|N/A|X| and "))) == ["YOON KYE-SANG", "AND"][:1]
    assert value(spark, E.actor_names(F.lit('["a b", "c d"]'))) == ["A B", "C D"]
    assert value(spark, E.actor_names(F.lit(None).cast("string"))) == []
    assert value(spark, E.director_names(F.lit("Ann, Bob |Cy,"))) == ["Ann", "Bob", "Cy"]


def test_sentences_and_forms(spark):
    assert value(spark, E.first_sentence(F.lit("A rather long first sentence. Then another."))) == "A rather long first sentence."
    assert value(spark, E.first_sentence(F.lit("Short. Then another."))) == "Short. Then another."
    assert value(spark, E.variant_title(F.lit("gc Tom & Jerry"))) == "TOM AND JERRY"
    assert value(spark, E.base_title(F.lit("3D - Up"))) == "UP"
    assert value(spark, E.sheet_name(F.lit("a/b: c  d" + "x" * 40))) == "ab c d" + "x" * 25
    assert value(spark, E.clock(F.lit(3725))) == "1:02:05"


@pytest.mark.parametrize("empty_value", [1.0, 0.0, None])
def test_jaccard_policies(spark, empty_value):
    none = F.array().cast("array<string>")
    assert value(spark, E.jaccard(none, F.lit(None).cast("array<string>"), empty_value)) == empty_value
    assert value(spark, E.jaccard(F.array(F.lit("A "), F.lit("b")), F.array(F.lit("a")), empty_value)) == 0.5


def test_json(spark):
    assert value(spark, J.strict_json(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert value(spark, J.strict_json(F.lit('{"a": [1,],}'))) is None
    assert value(spark, J.salvaged_json(F.lit('so: {"a": [1,],} ok'))) == '{"a": [1]}'
    assert value(spark, J.salvaged_json(F.lit("{}"))) is None
    assert value(spark, J.failure_class(F.lit("{"), F.lit("incomplete"), F.lit("max"))) == "response_incomplete:max"
    assert value(spark, J.variant_list(F.lit('["a", " ", null]'))) == ["a"]
    assert value(spark, J.variant_list(F.lit("solo"))) == ["solo"]
    assert value(spark, J.variant_list(F.lit("NaN"))) == []


def test_flatten(spark):
    def flat(a, b):
        columns = J.flatten_payloads([("a", F.lit(a)), ("b", F.lit(b))], ["k"])
        return spark.range(1).select(*(v.alias(n) for n, v in columns.items())).first().asDict()

    assert flat('{"k": 1}', '{"k": 1}') == {"k": "1", "b__k": None}
    assert flat('{"k": 1}', '{"k": 2}') == {"k": "1", "b__k": "2"}
    assert flat('{"k": null}', '{"k": 2}') == {"k": None, "b__k": "2"}
    assert flat("{}", '{"k": 2}') == {"k": "2", "b__k": None}


def test_indel():
    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return 100.0 if not a + b else 200.0 * t[-1][-1] / (len(a) + len(b))

    for a, b in [("", ""), ("a", ""), ("kitten", "sitting"), ("THE CAT", "CAT THE"), ("x" * 100, "xy" * 60)]:
        assert indel_ratio(a, b) == pytest.approx(slow(a, b)) == indel_ratio(b, a)


def test_upserts(spark):
    old = spark.createDataFrame([(1, "o1", 1), (2, "o2", 2), (2, "o3", 3), (None, "on", 4)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "n1", 1), (2, "n2", 2), (3, "n3", 3)], "k int, v string, n int")
    run = lambda p: {r["k"]: r["v"] for r in upsert.upsert(old, new, ["k"], p, [F.col("n")]).collect()}
    assert run("new_wins") == {1: "o1", 2: "n1", 3: "n3", None: "on"}
    assert run("existing_wins") == {1: "o1", 2: "o2", 3: "n3", None: "on"}
    assert run("last_wins") == {1: "o1", 2: "n2", 3: "n3", None: "on"}
    assert run("new_wins") == {r["k"]: r["v"] for r in upsert.upsert(old, new.limit(0), ["k"], "new_wins", [F.col("n")]).collect()} | {2: "n1", 3: "n3"}
    assert [r["k"] for r in upsert.drop_repeated_keys(old, "k").orderBy("k").collect()] == [None, 1]
    merged = {r["k"]: (r["v"], r["n"]) for r in upsert.merge_by_name(old.filter("k = 1"), new.filter("n > 1").select("k", "v"), "k").collect()}
    assert merged == {1: ("o1", 1), 2: ("n2", None), 3: ("n3", None)}


def test_curation(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "gone")], "k int, t string")
    assert sorted(r["k"] for r in df.filter(curate.not_among("t", ["x"])).collect()) == [1, 3]
    old = spark.createDataFrame([(1, ""), (3, "other"), (3, "gone")], "k int, t string")
    assert {r["k"]: r["change"] for r in curate.detect_changes(df, old, "k", "t").collect()} == {2: "new", 3: "changed"}
    assert curate.detect_changes(df, None, "k", "t").count() == 3
    assert curate.chunked(spark.range(60).toDF("k"), [F.col("k")]).groupBy("batch").count().orderBy("batch").collect()[-1]["count"] == 10
    pinned = spark.createDataFrame([(7,)], "k bigint")
    picked = [r["k"] for r in curate.seeded_sample(spark.range(60).toDF("k"), "k", 5, pinned=pinned).collect()]
    assert len(picked) == 5 and 7 in picked


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 4), (None, 5)], "g string, x int")
    assert {r["g"]: r["upper_median"] for r in profile.upper_median(df, ["g"], "x").collect()} == {"a": 3, None: 5}
    assert [tuple(r) for r in profile.frequency(df, F.col("g")).collect()] == [("a", 4), (None, 1)]
    cover = {r["column"]: r["n_filled"] for r in profile.coverage(df, ["g", "x"]).collect()}
    assert cover == {"g": 4, "x": 5}
    assert profile.coverage(df.limit(0), ["g"]).first()["pct"] is None


def test_encoders(spark):
    df = spark.createDataFrame([(1, ["A", "b "]), (2, ["b"]), (3, None), (4, ["c", " "])], "k int, g array<string>")
    mapped = {r["k"]: r["g_mapped"] for r in encode.map_top_tokens(df, "k", "g", 1).collect()}
    assert mapped == {1: ["__OTHER__", "b"], 2: ["b"], 3: ["__EMPTY__"], 4: ["__OTHER__"]}
    hot = encode.multi_hot(df, "g", values=["b", "B"])
    assert [c for c in hot.columns if c.startswith("g_")] == ["g_b", "g_B_2", "g_OTHER"]
    with pytest.raises(ValueError):
        encode.assert_unique(df.union(df), "k")


def test_variants(spark):
    rows = [(1, "3D Up", True, ["a"], "s"), (2, "Up", False, ["b"], "s"), (3, "Other", False, None, "s"), (4, "3D Lone", True, ["c"], "s"), (5, None, False, ["d"], "s")]
    df = spark.createDataFrame(rows, "k int, t string, d boolean, l array<string>, s string")
    out = {r["k"]: (r["has_3d_version"], r["l"]) for r in variants.merge_editions(df, "k", "t", F.col("d"), ["l"]).collect()}
    assert out == {1: (1, ["a", "b"]), 2: (1, ["a", "b"]), 3: (0, None), 4: (0, ["c"]), 5: (0, ["d"])}
    films = spark.createDataFrame(
        [(1, "GC Tom & Jerry", "A cat and a mouse fight all day long in a house", ["x"]), (2, "Tom and Jerry", "A cat and a mouse fight", ["y"]), (3, "Nothing alike", None, None), (4, "GC Unmatched Thing", None, None)],
        "k bigint, t string, s string, l array<string>",
    )
    best = variants.fuzzy_best(films, "k", "t", "s")
    assert [(r["event_key"], r["standard_key"]) for r in best.collect()] == [(1, 2)]
    merged = {r["k"]: (r["s"], r["l"]) for r in variants.merge_events(films, best, "k", "s", ["l"]).collect()}
    assert merged[2] == ("A cat and a mouse fight all day long in a house", ["x", "y"]) and set(merged) == {2, 3, 4}


def test_texts():
    random.seed(3)
    texts = ["", "A", *("".join(random.choice("ABCDé 😀") for _ in range(random.randrange(150))) for _ in range(60))]
    packed = similarity.Texts(texts)
    for x in texts:
        exact = [similarity.indel_ratio(x, y) for y in texts]
        assert packed.ratio(x, np.arange(len(texts))).tolist() == exact and (packed.bound(x) >= exact).all()
    assert similarity.Texts([]).bound("A").size == 0


def test_fuzzy_best_is_best_of_all(spark):
    """As by comparing each event with each standard row, also where titles share no word and openings differ."""
    random.seed(7)
    pool = ["".join(random.choice("ABDEGIKLMNORSTU") for _ in range(random.randint(2, 8))) for _ in range(60)]
    text = lambda n: " ".join(random.choice(pool) for _ in range(n))
    standard = [(i, text(random.randint(1, 4)), random.choice([None, text(18), text(18)])) for i in range(120)]
    events = []
    for i in range(60):
        _, t, s = random.choice(standard)
        words = [w if random.random() < 0.75 else random.choice(pool) for w in (s or "").split()]
        events.append((1000 + i, "GC " + random.choice([t[:-1] + "X", text(2), t]), " ".join(words) or None))
    got = variants.fuzzy_best(spark.createDataFrame(standard + events, "k bigint, t string, s string"), "k", "t", "s").collect()
    want = {}
    for e, t, s in events:
        t, s = t[3:].strip(), (s or "")[:80].strip()
        scores = []
        for d, u, v in standard:
            v = (v or "")[:80].strip()
            scores.append((similarity.indel_ratio(similarity.token_sort(t), similarity.token_sort(u)), similarity.indel_ratio(s, v) if s and v else 0.0, -d))
        both = max(x[1] for x in scores) > 0
        score, d = max((0.4 * x + 0.6 * y if both else x, d) for x, y, d in scores)
        if score >= 60:
            want[e] = (-d, pytest.approx(score))
    assert len(want) > 30 and {r["event_key"]: (r["standard_key"], r["score"]) for r in got} == want


def test_providers(spark, tmp_path):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RateLimited("wait")
        return Answer(raw="{}")

    assert with_retries(flaky, sleep=lambda s: None).error is None and len(calls) == 3
    assert with_retries(lambda: 1 / 0).error.startswith("ZeroDivisionError")
    task = files.Task("t", "")
    answers = {("1", "t"): Answer(raw='{"a": "x",}', prompt_tokens=10), ("2", "t"): Answer(raw="broken"), ("3", "t"): Answer(error="down")}
    work = spark.createDataFrame([(1, "q"), (2, "q"), (3, "q"), (4, "q")], "k int, c string")
    done = spark.createDataFrame([("4", "old")], "key string, a string")
    errors = spark.createDataFrame([("1", "earlier", None)], "key string, _error string, _raw_output string")
    checkpoint, ledger, cost = enrich(spark, work, done, errors, "k", "c", [task], ReplayProvider(answers), ["a"], batches=2, prices=(1e6, 0.0, 0.0))
    assert {r["key"]: r["a"] for r in checkpoint.collect()} == {"1": "x", "4": "old"}
    assert {r["key"]: r["_error"] for r in ledger.collect()} == {"2": "json_parse_failed", "3": "down"}
    assert cost == pytest.approx(10.0)
    stopped, _, spent = enrich(spark, work, done, errors, "k", "c", [task], ReplayProvider(answers), ["a"], most_cost=0.0)
    assert stopped.count() == 1 and spent == 0.0
    assert empty(spark, "a int").count() == 0
    hits = spark.createDataFrame([(1, 2000, 1990, 0), (1, 2000, 2001, 1), (2, None, 1990, 0)], "k int, y int, hy int, pos int")
    assert {r["k"]: r["hy"] for r in best_hit(hits, "k", "y", "hy", "pos").collect()} == {1: 2001, 2: 1990}


def test_files(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark, spark.range(3).toDF("a"), path)
    files.replace_table(spark, spark.read.parquet(path).filter("a > 0"), path, backup=True)
    assert spark.read.parquet(path).count() == 2
    assert files.cached(spark, path, lambda: 1 / 0).count() == 2
    files.rename_columns(spark, path, {"a": "b"})
    assert spark.read.parquet(path).columns == ["b"]
    ordered = files.scan_ordered(spark, [[path], [], [path]])
    assert ordered.count() == 4 and {r["source_rank"] for r in ordered.collect()} == {0, 2}
    keyed = str(tmp_path / "k")
    files.write_keyed_json(spark.createDataFrame([(1, "x")], "k int, v string"), keyed, "k")
    assert [tuple(r) for r in files.read_keyed_json(spark, keyed, spark.createDataFrame([], "v string, w int").schema).collect()] == [("1", "x", None)]
    assert files.unique_sheet_names(["a/b", "A?B", "x" * 40, "x" * 50]) == {"a/b": "ab", "A?B": "AB_2", "x" * 40: "x" * 31, "x" * 50: "x" * 29 + "_2"}
    for run in ("2026-01-01", "2026-02-01"):
        (tmp_path / "runs" / run).mkdir(parents=True)
    assert files.latest_run(spark, str(tmp_path / "runs")).endswith("2026-02-01")
    (tmp_path / "tasks.json").write_text('{"a": {"system_prompt": "p", "enabled": false}, "b": {"system_prompt": "q", "max_tokens": 9}}')
    assert files.load_tasks(str(tmp_path / "tasks.json")) == {"b": files.Task("b", "q", max_tokens=9)}
    names = files.write_workbook({"one": spark.range(2).toDF("a")}, str(tmp_path / "book"))
    assert files.read_sheet(spark, str(tmp_path / "book"), names["one"]).count() == 2


def test_warehouse(spark):
    parts = warehouse.select_many(spark, "select 1 as a; select ';' as b", labels=["x"])
    assert parts["x"].first()["a"] == 1 and parts[1].first()["b"] == ";"
    assert warehouse.select(spark, "select array_contains(:ids, 2) as hit", {"ids": [1, 2]}).first()["hit"]
    assert not warehouse.truncate(spark, "t; drop table x")
    df = spark.createDataFrame([(1, ["a", " "], float("nan"), "s")], "k int, l array<string>, x double, synopsis string")
    assert [tuple(r) for r in warehouse.to_staging(df).collect()] == [(1, '["a"]', None)]
    local, remote = warehouse.synchronise(spark.createDataFrame([(1, "l")], "k int, v string"), spark.createDataFrame([(2, "r")], "k int, v string"), "k")
    assert sorted(r["k"] for r in local.collect()) == sorted(r["k"] for r in remote.collect()) == [1, 2]


def test_incremental_stream(spark, tmp_path):
    from marquetry.streaming.incremental import upsert_increment

    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, n int")
    df.coalesce(1).write.parquet(source)
    go = lambda: upsert_increment(spark, source, df.schema, state, target, ["k"], [F.col("n")])
    go()
    assert [r["v"] for r in spark.read.parquet(target).collect()] == ["a"]
    spark.createDataFrame([(1, "c", 1), (2, "d", 1)], df.schema).coalesce(1).write.mode("append").parquet(source)
    go()
    go()
    assert {r["k"]: r["v"] for r in spark.read.parquet(target).collect()} == {1: "c", 2: "d"}


def test_clean_runs_to_the_end(spark):
    marks = "FFS - AFI - GC - NRL - JFF - ABC - XYZ - Film"
    titles = [marks, "Film (Hindi) (IMAX) (3D) (2004) [JFF] - Preview", None, "", "  ", "A - " * 200 + "Film"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "k int, t string")
    got = [r["c"] for r in df.select("k", X.clean_title("t").alias("c")).orderBy("k").collect()]
    assert got[0] == "Film" and got[2:5] == [None, "", ""]
    again = spark.createDataFrame([(c,) for c in got], "t string").filter("t is not null").select("t", X.clean_title("t").alias("c")).collect()
    assert all(r["t"] == r["c"] for r in again)


def test_rereleases_and_rescores(spark):
    from marquetry.operators.enrich import flag_rereleases, rescored

    films = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    seen = spark.createDataFrame([(1, 0), (1, 1), (3, 1)], "k int, rerelease_flag int")
    assert {r["x"]: r["rerelease_flag"] for r in flag_rereleases(films, seen, "k").collect()} == {"a": 1, "b": 0, "c": 0}
    cache = spark.createDataFrame([(1, 10, 0.5, False), (2, 20, 0.9, True), (3, 30, 0.4, None), (4, None, None, False)], "k int, hit int, score double, manual boolean")
    hits = spark.createDataFrame([(1, 10, 0.8, 40), (1, 11, 0.8, 3), (2, 21, 1.0, 0), (3, 30, 0.7, None), (4, 41, None, 1)], "k int, hit int, score double, off int")
    got = {r["k"]: (r["hit"], r["score"], r["changed"]) for r in rescored(cache, hits, "k", "hit", "score", "off", "manual").collect()}
    assert got == {1: (11, 0.8, True), 2: (20, 0.9, False), 3: (30, 0.7, False), 4: (None, None, False)}


def test_fallback(spark, tmp_path):
    from marquetry.sources.files import with_fallback

    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        spark.createDataFrame([(day,)], "day string").write.parquet(str(tmp_path / day))

    def fails():
        raise OSError("away")

    assert {r["day"] for r in with_fallback(spark, fails, str(tmp_path)).collect()} == {"2024-01-02", "2024-01-03", "2024-01-04"}
    assert with_fallback(spark, lambda: spark.range(2), str(tmp_path)).count() == 2


def test_payload_numbering(spark):
    from marquetry.functions.jsonx import flatten_payloads

    df = spark.createDataFrame([('{"a": "1", "t__a": "x"}', '{"a": 2, "n": {"z": 1}}'), ("[1]", '{"a": null}')], "p string, q string")
    columns = flatten_payloads([("s", F.col("p")), ("t", F.col("q"))], ["a", "t__a", "n"])
    rows = df.select(*(v.alias(k) for k, v in columns.items())).collect()
    assert (rows[0]["a"], rows[0]["t__a"], rows[0]["t__a__2"], rows[0]["n"]) == ("1", "x", "2", '{"z":1}')
    assert rows[1]["a"] is None and rows[1]["t__a__2"] is None


def test_scratch(spark):
    from marquetry.sources.files import exists
    from marquetry.sources.scratch import Scratch

    s = Scratch(spark)
    one, n = s.counted(spark.range(5))
    path = next(iter(s.paths.values()))
    out = s.result(one.filter("id > 1"))
    assert n == 5 and out.count() == 3 and not exists(spark, path)
    s.drop()
    assert not s.paths


def test_masks_and_letters():
    random.seed(5)
    texts = ["", "A", *("".join(random.choice("ABCDé 😀") for _ in range(random.randrange(150))) for _ in range(40))]
    for queries in (texts, texts[:1], []):
        masks, letters = similarity.Masks(queries), similarity.Letters(queries)
        codes = masks.codes([*texts, "XYZ"])
        exact = [[similarity.indel_ratio(x, y) for y in queries] for x in [*texts, "XYZ"]]
        total = np.array([[len(x) + len(y) for y in queries] for x in [*texts, "XYZ"]]).reshape(len(codes), len(queries))
        common = masks.all_common(codes, np.arange(len(queries)))
        assert variants._ratio(common, total).tolist() == exact
        x, y = (i.ravel() for i in np.indices(common.shape))
        assert (masks.pair_common(codes, x, y) == common[x, y]).all()
        levels = letters.levels()
        assert (similarity.Letters([*texts, "XYZ"]).reached(levels) @ letters.reached(levels).T >= common).all()


def test_fuzzy_best_of_like_synopses(spark, monkeypatch):
    """Synopses of few patterns, in several blocks: the best row of all by few comparisons of synopses, found once only."""
    random.seed(11)
    name = lambda: "".join(random.choice("BDGKLMNPRST") + random.choice("AEIOU") for _ in range(random.randint(2, 4)))
    patterns = ["SET IN {0}, THE FILM FOLLOWS A {1}, WHO LEARNS TO SWIM", "{0} PACKS A BAG AND TAKES THE FIRST TRAIN WITH A {1}", "WHEN A {1} OPENS A CINEMA IN {0}, NOBODY WILL BELIEVE IT"]
    text = lambda: random.choice(patterns).format(name(), random.choice(["CLERK", "BUS DRIVER", "RETIRED BOXER"]))
    rows = [(i, f"{'GC ' if i < 30 else ''}{random.choice(['THE ', 'BETWEEN '])}{name()} {random.choice(['WOLF', 'ICEBREAKER'])}", text()) for i in range(900)]
    best = variants.fuzzy_best(spark.createDataFrame(rows, "k bigint, t string, s string"), "k", "t", "s", cell=256)
    # its two uses in merge_events compare nothing again
    assert "CoGroups" not in best._jdf.queryExecution().toString()
    want = {}
    for k, t, s in rows[:30]:
        scores = ((0.4 * similarity.indel_ratio(similarity.token_sort(t[3:]), similarity.token_sort(u)) + 0.6 * similarity.indel_ratio(s[:80], v[:80]), -d) for d, u, v in rows[30:])
        score, d = max(scores)
        want[k] = (-d, score)
    assert {r["event_key"]: (r["standard_key"], r["score"]) for r in best.collect()} == want

    met, pairs = [], similarity.Masks.pair_common
    monkeypatch.setattr(similarity.Masks, "pair_common", lambda self, codes, row, query: (met.append(len(row)), pairs(self, codes, row, query))[1])
    events = pd.DataFrame([(k, t[3:], s, True, want[k][1]) for k, t, s in rows[:30]], columns=["e", "t", "s", "both", "known"])
    got = variants._best_of_cell(60.0)(events, pd.DataFrame(rows[30:], columns=["d", "t", "s"]))
    assert {e: (d, score) for e, d, score in got.itertuples(index=False)} == want and sum(met) < 30 * 870 / 5
