import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairlake.llm import contributor_caps as caps
from pairlake.llm import entity_split as split
from pairlake.llm import history_dedup as hist
from pairlake.llm.pictures import with_pictures, with_site
from pairlake.runtime import cut

NAN = float("nan")


def brute_caps(rows, limits):
    """rows: (id, author, domain, score); limits per level; greedy over the laminar matroid."""
    best = sorted(rows, key=lambda r: (-(r[3] if r[3] is not None and r[3] == r[3] and 0 <= r[3] <= 1 else -1), r[0]))
    used, kept = defaultdict(int), set()
    for i, a, d, _ in best:
        keys = [k for k in (("a", a, d), ("d", d)) if None not in k]
        if all(used[k] < limits[k[0]] for k in keys):
            kept.add(i)
            for k in keys:
                used[k] += 1
    return kept


def test_nested_caps_are_the_greedy_choice(spark):
    r = random.Random(5)
    rows = [(i, f"a{r.randint(0, 6)}", r.choice(["d0", "d0", "d0", "d1", None]), r.choice([None, NAN, -1.0, 0.5, 0.5, 0.5, r.random(), 1.0, 91.5])) for i in range(400)]
    df = spark.createDataFrame(rows, "rid long, author string, domain string, score double").withColumns({"id": F.lit("x"), "rank": F.lit(1)})
    got = caps.ranked_records(df.unionByName(df.limit(30)), "rid", F.col("score"), {"author": F.col("author"), "domain": F.col("domain")})
    kept = caps.nested_caps(cut(got), [("author", 9), ("domain", 40)])
    assert {x.id for x in kept.collect()} == brute_caps(rows, {"a": 9, "d": 40})


def test_caps_by_share_ties_and_empty(spark):
    df = spark.createDataFrame([(i, "hot", 0.5) for i in range(90)] + [(100 + i, f"s{i}", None) for i in range(10)], "id long, site string, score double")
    rows = cut(caps.ranked_records(df, "id", F.col("score"), {"site": F.col("site")}))
    assert sorted(x.id for x in caps.nested_caps(rows, [("site", 0.2)]).collect()) == [*range(20), *range(100, 110)]
    assert caps.nested_caps(rows.limit(0), [("site", 0.2)]).count() == 0
    assert caps.nested_caps(rows, [("site", 1000)]).count() == 100
    tiny = cut(caps.ranked_records(spark.createDataFrame([(1, "a", 1e-20), (2, "a", 2e-20)], "id long, site string, score double"), "id", F.col("score"), {"site": F.col("site")}))
    assert [x.id for x in caps.nested_caps(tiny, [("site", 1)]).collect()] == [2]


def union_find(links):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for _, a, b in links:
        if a and b:
            up[top(a)] = top(b)
    return {x: top(x) for x in up}


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_forest_spans_the_components(spark, shape):
    r = random.Random(3)
    if shape == "random":
        links = [(i, f"n{r.randint(0, 60)}", f"n{r.randint(0, 60)}") for i in range(45)] + [(900, None, "n1"), (901, "n2", "n2")]
    elif shape == "chain":
        links = [(i, f"n{i:03}", f"n{i + 1:03}") for i in range(60)]
    else:
        links = [(i, "hub", f"n{i}") for i in range(80)]
    forest, roots = split.spanning_forest(spark.createDataFrame(links, "link_id long, a string, b string"))
    want = union_find([x for x in links if x[1] != x[2]])
    got = {x.node: x.root for x in roots.collect()}
    same = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    want = {k: v for k, v in want.items() if k in got}
    assert same(got) == same(want)
    edges = forest.collect()
    assert len(edges) == len(got) - len(set(got.values())) == len({e.link_id for e in edges})
    assert same(union_find([(e.link_id, e.a, e.b) for e in edges])) == same(got)


def test_components_conflicts_and_deal(spark):
    rows = [(1, "x", "y", True), (2, "y", "y", False), (3, "y", "z", None), (4, "q", "q", True), (5, None, None, False), (6, None, "z", True), (1, "x", "y", True)]
    df = spark.createDataFrame(rows, "record_id long, a string, b string, flag boolean").withColumns({"root": F.lit(9), "entity": F.lit(1)})
    rooted, _ = split.components(df, ["flag"])
    got = {x.record_id: x.root for x in rooted.collect()}
    assert got[1] == got[2] == got[3] == got[6] and len({got[1], got[4], got[5]}) == 3
    assert {(x.pair_id_a, x.pair_id_b) for x in split.conflicts(rooted, "flag").collect()} == {(1, 2), (2, 6)}
    sizes = spark.createDataFrame([(f"r{i}", 1 + i % 5 * 3) for i in range(1000)], "root string, n long")
    dealt = split.deal(sizes, [("train", 800), ("validation", 100), ("test", 100)]).collect()
    assert len({x.root for x in dealt}) == 1000
    for band in {x.n.bit_length() for x in dealt}:
        own = [x.split for x in dealt if x.n.bit_length() == band]
        for name, part in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
            assert abs(own.count(name) - part * len(own)) <= 2
    empty, _ = split.components(df.limit(0), ["flag"])
    assert empty.count() == 0 and split.deal(sizes.limit(0), [("train", 900), ("test", 100)]).count() == 0


SAME = [
    "https://silk.test/gallery/case-10116/ab-4616-before.jpeg",
    "HTTPS://img7.Silk.Test:443//old/gallery/Case-000010116/ab-4616-before-1024x768.webp?w=1#top",
    " http://www.silk.test/gallery/case%2D10116/ab-4616%2dbefore@2x.png\n",
    "https://relay.imgpass.example/fetch?url=https%3A%2F%2Fsilk.test%2Fgallery%2Fcase-10116%2Fab-4616-before.jpg&w=900",
    "https://silk.test/cache/1200/gallery/case-10116/ab-4616-before_large.jpg&amp;x=1",
]
OTHER = [
    "https://silk.example/gallery/case-10116/ab-4616-before.jpeg", "https://silk.test/gallery/case-10117/ab-4616-before.jpeg",
    "https://silk.test/gallery/case-10116/ab-4615-before.jpeg", "https://silk.test/gallery/case-10116/ab-4616-after.jpeg",
    "https://silk.test/c/10116/before/other.jpg", "https://silk.test/photos/view.php?case=10116&img=x-b", None, "", "%zz", "x" * 5000,
]


def test_addresses_of_one_picture(spark):
    rows = [(i, u) for i, u in enumerate([*SAME, *OTHER])]
    got = {r.i: r.p for r in with_pictures(spark.createDataFrame(rows, "i int, u string"), {"u": "p"}).collect()}
    assert len({got[i] for i in range(len(SAME))}) == 1
    assert not {got[i] for i in range(len(SAME))} & {got[i] for i in range(len(SAME), len(rows))}
    view = ["https://a.test/photos/view.php?case=00012&img=q-b", "https://m.a.test/photos//view.php?amp;img=q%2Db&amp;case=12&utm=x", "https://a.test/photos/view.php?case=12&img=q-a"]
    a, b, c = (r.p for r in with_pictures(spark.createDataFrame([(u,) for u in view], "u string"), {"u": "p"}).collect())
    assert a == b != c


def test_sites(spark):
    rows = [("cdn.a.co.example", "x"), (" WWW.A.CO.EXAMPLE. ", None), ("https://a.co.example:443/", ""), ("", "https://img.a.co.example/case"), (None, "https://u@a.co.example/x"), (None, None), ("sub.other.org", "")]
    got = [r.s for r in with_site(spark.createDataFrame(rows, "d string, u string"), "d", "u", "s").collect()]
    assert got[:5] == ["a.co.example"] * 5 and got[5] is None and got[6] == "other.org"


def url(case, name, role):
    return f"https://a.test/gallery/case-{case}/{name}-{role}.jpg"


def test_admission_one_by_one_is_admission_at_once(spark, tmp_path):
    r = random.Random(1)
    pair = lambda: (url(r.randint(1, 3), f"n{r.randint(0, 4)}", "before"), url(r.randint(1, 3), f"n{r.randint(0, 4)}", "after"))
    rows = [(i, *pair()) for i in range(1, 120)] + [(200, None, url(1, "n1", "after")), (201, None, url(1, "n1", "after")), (202, url(1, "n1", "after"), url(1, "n1", "before"))]
    schema = "id long, before_url string, after_url string"
    first = {}
    for i, b, a in rows:
        if b and a:
            first.setdefault((b, a), i)
    want = {(first[b, a], i) for i, b, a in rows if i > 60 and b and a and first[b, a] != i}
    old, new = rows[:60], rows[60:]
    df = spark.createDataFrame(new, schema).withColumns({"f0": F.lit(1), "cell_a": F.lit(2)})
    known = hist.pivot_table(hist.points(spark.createDataFrame(old, schema)))
    repeats, _ = hist.admit(known, hist.points(df.unionByName(df.limit(3))))
    assert {(x.first_id, x.dup_id) for x in repeats.collect()} == want
    path, got = str(tmp_path / "pivots"), set()
    hist.write_table(known, path, files=3)
    for k in range(0, len(new), 25):
        stored = spark.read.parquet(path)
        found, fresh = hist.admit(stored, hist.points(spark.createDataFrame(new[k : k + 25], schema)))
        got |= {(x.first_id, x.dup_id) for x in found.collect()}
        hist.write_table(cut(fresh), path)
    assert got == want
    assert hist.admit(known, hist.points(df.limit(0)))[0].count() == 0
    assert hist.admit(known.limit(0), hist.points(df.limit(1)))[0].count() == 0


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 2**31), st.integers(0, 40))
def test_pivots_lose_nothing_within_the_radius(spark, seed, radius):
    r = random.Random(seed)
    spots = [tuple(r.randrange(hist.TOP) for _ in hist.COORDINATES) for _ in range(3)]
    pts = [(i, i % 5, i % 7, *[min(hist.TOP - 1, c + r.randint(0, 12)) for c in r.choice(spots)]) for i in range(60)]
    df = hist.with_distances(spark.createDataFrame(pts, "id long, f0 long, f1 long, c0 long, c1 long, c2 long, c3 long"))
    gap = lambda x, y: sum(abs(a - b) for a, b in zip(x[3:], y[3:]))
    want = {(x[0], y[0], gap(x, y), x[1:3] == y[1:3]) for x in pts for y in pts if gap(x, y) <= radius}
    for small in (False, True):
        assert {(x.id, x.known_id, x.distance, x.same) for x in hist.near(df, df, radius, small).collect()} == want


SHOT = "https://a.test/c/{}/{}/IMG_{}.jpg"


def test_batches_in_order_with_near_duplicates(spark, tmp_path):
    r = random.Random(7)
    pair = lambda: (r.randint(1, 2), r.randint(1, 9), r.randint(1, 9))
    made = {i: pair() for i in range(1, 140)}
    rows = [(i, SHOT.format(c, "before", b), SHOT.format(c, "after", a), None if i < 60 else i // 20) for i, (c, b, a) in made.items()]
    schema = "id long, before_url string, after_url string, batch int"
    old, new = (spark.createDataFrame([x for x in rows if ok(x[0])], schema) for ok in (lambda i: i < 60, lambda i: i >= 60))
    first = {}
    for i, p in made.items():
        first.setdefault(p, i)
    want = {(first[p], i) for i, p in made.items() if i >= 60 and first[p] != i}
    # one row per batch and two pictures is compared with all that was accepted before, and its batch
    own = {}
    for i, p in made.items():
        if i >= 60:
            own.setdefault((i // 20, p), i)
    next_shot = lambda p, q: p[0] == q[0] and abs(p[1] - q[1]) + abs(p[2] - q[2]) == 1
    near = {(i, j) for (_, p), i in own.items() for q, j in first.items() if j < i and next_shot(p, q)}
    path = str(tmp_path / "pivots")
    old.write.parquet(str(tmp_path / "old"))
    history = hist.History.create(hist.points(spark.read.parquet(str(tmp_path / "old"))), path)
    assert history.rows().count() == len({p for i, p in made.items() if i < 60}) and len(history.lows) <= 256
    repeats, links = history.admit_batches(hist.points(new, keep=["batch"]), "batch")
    assert {(x.first_id, x.dup_id) for x in repeats.collect()} == want
    got = links.where("not same").collect()
    assert all(x.distance == 2 for x in got) and near <= {(x.id, x.known_id) for x in got}
    assert history.rows().count() == len(first)
    # a later session opens the table; neither it nor its batch reads the accepted addresses
    again = hist.History.open(spark, path)
    assert again.lows == history.lows
    late = spark.createDataFrame([(900, *rows[0][1:3], 50), (901, SHOT.format(9, "before", 1), SHOT.format(9, "after", 2), 50), (902, None, None, None)], schema)
    repeats, _ = again.admit_batches(hist.points(late, keep=["batch"]), "batch")
    assert [tuple(x) for x in repeats.collect()] == [(first[made[1]], 900)]
    assert all("/pivots/" in f for f in again.rows().inputFiles()) and not any("/old/" in f for f in repeats.inputFiles())
    assert again.admit_batches(hist.points(late.limit(0), keep=["batch"]), "batch")[0].count() == 0


def test_a_batch_reads_only_the_ranges_it_reaches(spark, tmp_path):
    rows = [(i, SHOT.format(i, "before", 1), SHOT.format(i, "after", 2)) for i in range(1, 500)]
    history = hist.History.create(hist.points(spark.createDataFrame(rows, "id long, before_url string, after_url string")), str(tmp_path / "p"))
    assert len(history.lows) == 7
    plan = history.rows([3])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    assert {x.cell for x in history.rows([3]).select("cell").distinct().collect()} == {3}
    lows = [None, *history.lows]
    for x in history.rows().select("cell", "d0", history.cell(F.col("d0")).alias("c")).collect():
        assert x.c == x.cell and (lows[x.cell] is None or lows[x.cell] <= x.d0)


def test_batches_in_one_pass_are_batches_one_by_one(spark, tmp_path):
    r = random.Random(3)
    old = [(i, SHOT.format(1, "before", r.randint(1, 6)), SHOT.format(1, "after", r.randint(1, 3)), 0) for i in range(1, 15)]
    new = [(i, SHOT.format(1, "before", r.randint(1, 6)), SHOT.format(1, "after", r.randint(1, 6)), 1 + i % 4) for i in range(20, 90)]
    schema = "id long, before_url string, after_url string, batch int"
    # ids don't rise with the batches: what was admitted first may have the larger id
    old, new = cut(hist.points(spark.createDataFrame(old, schema), keep=["batch"])), cut(hist.points(spark.createDataFrame(new, schema), keep=["batch"]))
    rows = lambda df: sorted(tuple(x) for x in df.collect())
    once = hist.History.create(old, str(tmp_path / "once"))
    _, links = once.admit_batches(new, "batch")
    each, want = hist.History.create(old, str(tmp_path / "each")), []
    for k in range(1, 5):
        want += rows(each.admit_batches(new.where(F.col("batch") == k), "batch")[1])
    assert rows(links) == sorted(want) and len(want) > 50
    assert rows(once.rows().select("id", *hist.PRINTS)) == rows(each.rows().select("id", *hist.PRINTS))


def test_history_is_read_once_for_all_batches(spark, tmp_path, monkeypatch):
    rows = [(i, SHOT.format(i, "before", 1), SHOT.format(i, "after", 2), i % 12) for i in range(1, 60)]
    pts = cut(hist.points(spark.createDataFrame(rows, "id long, before_url string, after_url string, batch int"), keep=["batch"]))
    history, reads = hist.History.create(pts, str(tmp_path / "p")), []
    own = hist.History.rows
    monkeypatch.setattr(hist.History, "rows", lambda self, cells=None: reads.append(cells) or own(self, cells))
    history.admit_batches(pts, "batch")
    assert len(reads) == 1
