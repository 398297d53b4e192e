import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairlake.llm import calibrated_sample as cal
from pairlake.llm import canonical_match as match
from pairlake.llm import percentiles as perc
from pairlake.llm import score_cutoff as cutoff
from pairlake.runtime import cut

NAN, INF = float("nan"), float("inf")
ENTRIES = [(1, "Gridusbel", ["그리두스벨"]), (2, "Gridusbel Hydra", [None]), (3, "Peastgo Contour", []), (4, "lip_volume", ["입술 볼륨", "volume labial"]), (5, "nose_reshape", ["remodelação nasal"]), (6, "Rinerqui", [])]


#: What is learnt from values that stand beside enough entries, given here by hand.
ADDED = frozenset({("right", "# ml"), ("left", "# syringes of"), ("left", "brand"), ("right", "see notes"), ("right", "both sides")})


@pytest.fixture(scope="module")
def trie():
    return match.Trie(ENTRIES, ADDED)


@pytest.mark.parametrize(
    ("value", "term"),
    [
        ("Gridusbel", 1), ("gridusbel®", 1), ("Ｇｒｉｄｕｓｂｅｌ", 1), ("Gridusbеl", 1), ("Gr1dusbe1", 1), ("Gridusbel 1ml", 1), ("2 syringes of Gridusbel", 1), ("brand: Gridusbel", 1),
        ("Gridusbel; Gridusbel", 1), ("Gridusbel Gridusbel", 1), ("Gridusbel - see notes", 1), ("Gridu", 1), ("Gridusb...", 1), ("Hydra Gridusbel", 2), ("GridusbelHydra", 2), ("Gridusbel hidra", 2),
        ("gridsubel", 1), ("Peastgo kontour", 3), ("volume lip", 4), ("LIP VOLUME", 4), ("lip/volume", 4), ("입술볼륨", 4), ("Volume  Labial", 4), ("remodelacao nasal", 5), ("nose reshape, both sides", 5),
        ("#nose_reshape", 5), ("Rinerki", 6), ("rinerkwi", 6), ("lebsudirg", 0), ("TBD", 0), ("?", 0), ("-", 0), ("dental veneers", 0), ("기타", 0), ("x" * 500, 0),
    ],
)
def test_typed_values(trie, value, term):
    assert trie.match(value)[0] == term


def damerau(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=7), min_size=1, max_size=12), st.text("abcd", max_size=8), st.integers(0, 3))
def test_automaton_is_edit_distance(names, value, most):
    trie = match.Trie([(k, n, []) for k, n in enumerate(names)])
    want = {k: damerau(value, n) for k, n in enumerate(names) if damerau(value, n) <= most}
    assert trie.search(value, most) == want


def test_labels(spark, monkeypatch):
    terms = spark.createDataFrame([(1, "brand", "Gridusbel", None), (2, "category", "lip_volume", "입술 볼륨"), (2, "category", "lip_volume", "입술 볼륨")], "term_id long, kind string, name string, name_ko string")
    rows = [(1, "LIP VOLUME", "Gridusbel"), (1, "LIP VOLUME", "Gridusbel"), (2, None, "  "), (3, " ", "gridsubel"), (4, "n/a", None), (None, "LIP VOLUME", "x"), (5, "lip_volume", "")]
    labels = spark.createDataFrame(rows, "id long, c string, b string").withColumns({"value": F.lit(1), "kind": F.lit("q"), "term_id": F.lit(7)})
    fields = {"c": "category", "b": "brand"}
    want = {(1, "c", 2), (1, "b", 1), (3, "b", 1), (4, "c", 0), (5, "c", 2)}
    get = lambda l, t: sorted((x.label_id, x.field, x.term_id) for x in match.map_labels(l, t, fields).collect())
    assert get(labels, terms) == sorted(want)
    monkeypatch.setattr(match, "MAX_ENTRIES", 1)
    assert get(labels, terms) == sorted(want)
    assert get(labels.limit(0), terms) == []
    assert {x[2] for x in get(labels, terms.limit(0))} == {0}


def test_blocks_choose_as_one_list_and_values_may_be_long(spark, monkeypatch):
    names = ["Restylane", "Restylame", "Botox", "Gridusbel", "Gridusbel Hydra", "Peastgo Contour", "Peastgo Ultra"]
    terms = spark.createDataFrame([(k, "brand", n, None) for k, n in enumerate(names, 1)], "term_id long, kind string, name string, name_ko string")
    long = "botox " + "(see notes) both sides " * 40
    seen = [f"{n} {x}" for n in names[:4] for x in ("1ml", "- see notes", "(both sides)", "hidra")]
    typed = ["Restylabe", "restylane 1ml", long, "x" * 100_000, "1ml " * 5000, "peast", "Gridu", "hydra gridusbel", "peastgo", "Botx", "", "??", *seen]
    labels = spark.createDataFrame([(k, v) for k, v in enumerate(typed)], "id long, b string")
    get = lambda: {(x.label_id, x.term_id) for x in match.map_labels(labels, terms, {"b": "brand"}).collect()}
    one = get()
    assert {(0, 0), (1, 1), (2, 3), (3, 0), (4, 0), (5, 0), (6, 4), (7, 5), (9, 3)} <= one
    added = match.learnt(match.spread(match.long_values(labels, {"b": "brand"})), match._blocks(terms))
    assert added == {("right", "# ml"), ("right", "see notes"), ("right", "both sides")}
    for block in (1, 2, 3):
        monkeypatch.setattr(match, "MAX_ENTRIES", block)
        assert get() == one
        found = match.within(match.long_values(labels, {"b": "brand"}), terms).collect()
        assert {(x.term_id, x.distance) for x in found if x.value == "Restylabe"} == {(1, 1), (2, 1)}
        for x in found:
            s, n = match.letters(match.trimmed(x.value, added)), match.letters(match.fold(names[x.term_id - 1]))
            assert x.distance == damerau(s, n) <= match.limit(len(s))


def test_no_addition_is_dropped(spark, monkeypatch):
    names = ["Restylane", "Botox", "Gridusbel", "Peastgo Contour"]
    terms = spark.createDataFrame([(k, "brand", n, None) for k, n in enumerate(names, 1)], "term_id long, kind string, name string, name_ko string")
    note = "as it was told by her own doctor there"
    seen = [f"{n} {x}" for n in names[:3] for x in ("1ml", "- see notes", "(both sides)", note)]
    labels = spark.createDataFrame(list(enumerate([f"Restylne {note}", "2 ml botx", "Gridusbl both sides 3 ml - see notes", "peastgo kontour see notes", "none", *seen])), "id long, b string")
    get = lambda: ({(x.label_id, x.term_id) for x in match.map_labels(labels, terms, {"b": "brand"}).collect()}, {tuple(x) for x in match.within(match.long_values(labels, {"b": "brand"}), terms).collect()})
    as_set = get()
    assert {(0, 1), (2, 3), (3, 4), (4, 0)} <= as_set[0]
    # more than are sent as a set: each value has its own, and the answers stay
    monkeypatch.setattr(match, "ADDITIONS", 1)
    assert get() == as_set
    monkeypatch.setattr(match, "MAX_ENTRIES", 2)
    assert get() == as_set


def test_cutoffs_are_exact(spark):
    r = random.Random(2)
    rows = [(r.choice(["hot", "hot", "b", "c", None]), r.choice([None, 0.5, 0.5, round(r.random(), 3), 0.0, 1.0])) for _ in range(3000)]
    rows = [(s, NAN if k % 97 == 0 else x) for k, (s, x) in enumerate(rows)]
    targets = {"hot": 33, "b": 100, "c": 1, "none": 50}
    df = spark.createDataFrame(rows, "source string, score double").withColumns({"cutoff": F.lit(1), "n": F.lit(1)}).withColumn("score", F.when(~F.isnan("score"), F.col("score")))
    got = {x.source: x for x in cutoff.cutoffs(cut(df), spark.createDataFrame(list(targets.items()), "source string, keep_percent int")).collect()}
    assert set(got) == {"hot", "b", "c"}
    for s, x in got.items():
        own = sorted([v for t, v in rows if t == s and v is not None and v == v], reverse=True)
        need = max(1, math.ceil(targets[s] * len(own) / 100))
        assert (x.cutoff, x.n, x.kept) == (own[need - 1], len(own), sum(v >= own[need - 1] for v in own))
    assert cutoff.cutoffs(df.limit(0), spark.createDataFrame([("a", 5)], "source string, keep_percent int")).count() == 0


def test_bad_brackets_fall_back_to_all_values(spark, monkeypatch):
    df = cut(spark.createDataFrame([("a", k / 1000) for k in range(1000)], "source string, score double"))
    targets = spark.createDataFrame([("a", 30)], "source string, keep_percent int")
    monkeypatch.setattr(cutoff, "ACCURACY", 2)
    assert [(x.cutoff, x.kept) for x in cutoff.cutoffs(df, targets).collect()] == [(0.7, 300)]


def test_newton_reaches_the_goal(spark):
    rows = [(float(n), s, float(g)) for n in (1, 7, 500, 100000) for s in (1e-4, 0.2, 1.0) for g in (1, 3, 120)]
    df = spark.createDataFrame(rows, "n double, s double, g double").withColumn("t", cal.newton(F.col("n"), F.col("s"), F.col("g")))
    for x in df.collect():
        assert abs(x.n * x.s * math.exp(x.t) - x.g) < 1e-6 * x.g


def test_plan_and_draw(spark, monkeypatch):
    targets = spark.createDataFrame([("a", 500, 5), ("b", 490, 5), ("c", 10, 5), ("d", 0, 0)], "category string, permille int, floor int")
    records = spark.createDataFrame([(1, "a", k) for k in range(300)] + [(1, "b", k) for k in range(1000, 1030)] + [(1, "c", 2000 + k) for k in range(40)] + [(1, None, 1), (2, "x", 5), (1, "a", 0)], "population long, category string, record_id long")
    counts = records.distinct().groupBy("population", "category").agg(F.count(F.lit(1)).alias("available"))
    plan = cut(cal.plan(counts, targets, 100))
    got = {(x.population, x.category): x for x in plan.collect()}
    assert len(got) == 8
    assert got[1, "a"].goal == 50 and not got[1, "a"].gap and abs(got[1, "a"].probability - 1 / 6) < 1e-9
    assert got[1, "b"].goal == 30 and got[1, "b"].gap and got[1, "c"].goal == 5 and not got[1, "d"].gap
    assert got[2, "a"].gap and got[2, "a"].available == 0
    for block in (5000, 37):
        monkeypatch.setattr(cal, "BLOCK", block)
        drawn = cal.draw(records.withColumn("h", F.lit(1)), plan).collect()
        n = Counter((x.population, x.category) for x in drawn)
        assert len({x.record_id for x in drawn}) == len(drawn)
        assert n[1, "b"] == 30 and n[1, "c"] == 5 and abs(n[1, "a"] - 50) <= 1 and set(n) == {(1, "a"), (1, "b"), (1, "c")}
    assert cal.draw(records.limit(0), plan).count() == 0 and cal.plan(counts.limit(0), targets, 100).count() == 0


def test_joint_calibration_holds_size_and_both_margins(spark, monkeypatch):
    r = random.Random(3)
    targets = spark.createDataFrame([("a", 500, 5), ("b", 490, 5), ("c", 10, 5), ("d", 0, 0)], "category string, permille int, floor int")
    rows = [(pop, c, r.choices(["x", "y", None], [6, 3, 1])[0], pop * 10_000 + k) for pop, sizes in ((1, {"a": 300, "b": 30, "c": 40}), (2, {"a": 900, "b": 700, "c": 80, "d": 9, "z": 50}), (3, {"a": 20})) for c, n in sizes.items() for k, _ in enumerate(range(n), 1000 * ord(c[0]))]
    records = spark.createDataFrame(rows, "population long, category string, stratum string, record_id long")
    cells = cut(cal.calibrated(records.groupBy("population", "category", "stratum").agg(F.count(F.lit(1)).alias("available")), targets, 100))
    got = cells.collect()
    goal = {(x.population, x.category): x.goal for x in got}
    assert [round(goal[1, c], 6) for c in "abcd"] == [65, 30, 5, 0] and [round(goal[3, c], 6) for c in "abcd"] == [20, 0, 0, 0]
    assert {(x.population, x.category) for x in got if x.gap} == {(1, "b"), (3, "a"), (3, "b"), (3, "c")}
    for (pop, c), g in goal.items():
        assert sum(x.available * x.probability for x in got if (x.population, x.category) == (pop, c)) == pytest.approx(g, abs=1e-6)
    second = [x for x in got if x.population == 2]
    n = sum(x.available for x in second)
    for s in ("x", "y", ""):
        own = [x for x in second if x.stratum == s]
        assert sum(x.available * x.probability for x in own) == pytest.approx(100 * sum(x.available for x in own) / n, abs=0.5)
    for block in (5000, 61):
        monkeypatch.setattr(cal, "BLOCK", block)
        drawn = cal.draw(records.unionByName(records.limit(9)), cells).collect()
        count = Counter((x.population, x.category) for x in drawn)
        assert [sum(v for k, v in count.items() if k[0] == pop) for pop in (1, 2, 3)] == [100, 100, 20]
        assert all(abs(count[k] - g) <= 1 for k, g in goal.items()) and len({x.record_id for x in drawn}) == len(drawn)
    assert cal.calibrated(cells.limit(0), targets, 100).count() == 0


def test_every_position_of_a_block_keeps_its_probability(spark, monkeypatch):
    monkeypatch.setattr(cal, "BLOCK", 3)
    one = [("p", "a", k) for k in range(11)]
    records = spark.createDataFrame([(s, c, k + 100 * s) for s in range(600) for _, c, k in one], "population long, category string, record_id long")
    planned = records.select("population").distinct().withColumns({"category": F.lit("a"), "available": F.lit(11), "probability": F.lit(0.37)})
    hits = Counter(x.record_id % 100 for x in cal.draw(records, planned).collect())
    assert all(abs(hits[k] / 600 - 0.37) < 0.08 for k in range(11)) and abs(sum(hits.values()) / 6600 - 0.37) < 0.005


def test_pivotal_method_keeps_probabilities():
    r, hits = random.Random(0), Counter()
    p = [0.2, 0.5, 0.9, 0.4, 0.0, 1.0, 0.3, 0.7]
    for _ in range(4000):
        out = cal.fight(p, [r.random() for _ in p])
        assert sum(out) == pytest.approx(sum(p)) and all(x in (0.0, 1.0) for x in out)
        hits.update(k for k, x in enumerate(out) if x == 1.0)
    assert all(abs(hits[k] / 4000 - x) < 0.04 for k, x in enumerate(p))


def brute(values, p):
    v = sorted(values)
    return v[max(1, math.ceil(round(p * len(v), 6))) - 1]


def test_percentiles_exact_merged_and_bounded(spark):
    r = random.Random(8)
    rows = [(r.choice(["x", "x", None]), day, r.choice([None, NAN, INF, -INF, 0.0, -0.0, -3.5, 1e-9, 1e12, 7.0, 7.0, r.gauss(50, 30)])) for day in range(4) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, day int, v double").withColumns({"r": F.lit(1), "n": F.lit(2), "p": F.lit(1)}).withColumn("v", perc.finite(F.col("v")))
    points = [0.0, 0.1, 0.5, 0.9, 1.0]
    whole = perc.value_counts(df, ["k"], "v")
    parts = perc.merge(*[perc.value_counts(df.where(f"day = {d}"), ["k"], "v") for d in range(4)])
    for counts in (whole, parts):
        got = {(x.k, x.p): (x.value, x.n) for x in perc.percentiles(counts, ["k"], points).collect()}
        for k in ("x", None):
            own = [v for kk, _, v in rows if kk == k and v is not None and math.isfinite(v)]
            assert {p: got[k, p] for p in points} == {p: (brute(own, p), len(own)) for p in points}
    near = perc.value_counts(df.withColumn("v", perc.on_grid(F.col("v"), 0.5)), ["k"], "v")
    for x in perc.percentiles(near, ["k"], points).collect():
        own = [v for kk, _, v in rows if kk == x.k and v is not None and math.isfinite(v)]
        assert abs(x.value - brute(own, x.p)) <= 0.25 + 1e-3
    assert perc.percentiles(whole.limit(0), ["k"], points).count() == 0
    assert perc.percentiles(perc.value_counts(df, [], "v"), [], [0.5]).count() == 1


def test_kth_of_any_keys(spark):
    from pairlake.llm import selection

    r = random.Random(12)
    shapes = {"same": lambda: 0.5, "wide": lambda: r.choice([-1e300, 1e300, 0.0, 1e-300]), "near": lambda: 1 + r.random() * 1e-15, "even": r.random, "skew": lambda: r.random() ** 40}
    rows = [(g, float(f()), r.choice([-(2**62), 2**62, 0, r.randint(-9, 9), r.randint(10**17, 10**17 + 9)])) for g, f in shapes.items() for _ in range(200)]
    df = cut(spark.createDataFrame(rows, "g string, x double, i long"))
    for key, at in (("x", 1), ("i", 2)):
        ends = df.groupBy("g").agg(F.min(key).alias("lo_"), F.max(key).alias("hi_"))
        for k in (1, 77, 200, 201):
            got = {v.g: (v[f"{key}_"], v.left, v.equal) for v in selection.kth(df, ends.withColumn("left", F.lit(k).cast("long")), ["g"], key).collect()}
            for g in shapes:
                own = sorted(v[at] for v in rows if v[0] == g)
                assert got.get(g) == ((own[k - 1], k - sum(v < own[k - 1] for v in own), own.count(own[k - 1])) if k <= 200 else None)
