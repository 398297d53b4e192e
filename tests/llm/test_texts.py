import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairlake.llm import leakage, packing, reading_level
from pairlake.llm.textnorm import words

ITEM = "Choose the photograph in which the brow tail shows a waxy sheen but no trace of selcalpe. Records from the dexhylo registry mention nine earlier visits and a firm cord."
SECOND = "Choose the photograph in which the chin pad shows a pale ring but no trace of vofithu. Records from the marvaju registry mention two earlier visits and faint banding."


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 900), max_size=60))
def test_first_fit_decreasing(sizes):
    sizes = sorted(sizes, reverse=True)
    room, want = [], []
    for s in sizes:
        k = next((k for k, x in enumerate(room) if x >= s), len(room))
        if k == len(room):
            room.append(1000)
        room[k] -= s
        want.append(k)
    assert packing.first_fit_decreasing(sizes, 1000) == want


def test_packing_is_whole(spark):
    sizes = [(i, random.Random(i).randint(1, 300)) for i in range(500)] + [(1000, 2500), (1001, 1000), (1002, 1)]
    df = spark.createDataFrame(sizes, "doc_id long, n_tokens long").withColumns({"g": F.lit(1), "part": F.lit("x")})
    out = packing.pack(df.unionByName(df.limit(4)), 1000, group=100).collect()
    back, used = {}, {}
    for x in out:
        back.setdefault(x.doc_id, []).append((x.start, x.size))
        used[x.container] = used.get(x.container, 0) + x.size
    assert max(used.values()) <= 1000 and sum(used.values()) / (1000 * len(used)) > 0.95
    for i, n in sizes:
        at = 0
        for start, size in sorted(back[i]):
            assert start == at
            at += size
        assert at == n and len(back[i]) == -(-n // 1000)
    assert packing.pack(df.limit(0), 1000).count() == 0
    with pytest.raises(ValueError, match="capacity"):
        packing.pack(df, 0)


def test_token_counts(spark):
    texts = ["", None, "hello world", "보톡스 " * 5, "a" * 100_000, "<|endoftext|>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    enc = packing.tokenizer(packing.TOKENIZER)
    got = {x.doc_id: x.n_tokens for x in packing.token_counts(docs).collect()}
    assert got == {i: len(enc.encode_ordinary(t)) for i, t in enumerate(texts) if t}
    assert all(enc.decode(enc.encode_ordinary(t)) == t for t in texts if t)


def brute_tiles(a, b, least):
    """Greedy string tiling as it is defined: again and again the longest unmarked matches."""
    used_a, used_b, out = set(), set(), []
    while True:
        best, hits = least - 1, []
        for p in range(len(a)):
            for q in range(len(b)):
                n = 0
                while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n] and p + n not in used_a and q + n not in used_b:
                    n += 1
                if n > best:
                    best, hits = n, [(p, q)]
                elif n == best and n >= least:
                    hits.append((p, q))
        if not hits:
            return out
        for p, q in hits:
            if not any(p + k in used_a or q + k in used_b for k in range(best)):
                used_a.update(range(p, p + best))
                used_b.update(range(q, q + best))
                out.append((p, q, best))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=18), st.lists(st.sampled_from("abcx"), max_size=25))
def test_tiles(a, b):
    assert sorted(leakage.tiles(a, b, 3)) == sorted(brute_tiles(a, b, 3))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(1, 4)), max_size=9, unique_by=(lambda x: x[0], lambda x: x[1])))
def test_heaviest_chain(found):
    best = 0
    for mask in range(1 << len(found)):
        own = sorted(x for k, x in enumerate(found) if mask >> k & 1)
        if all(x[1] < y[1] for x, y in zip(own, own[1:])):
            best = max(best, sum(x[2] for x in own))
    assert leakage.heaviest_chain([(p, q, 1, w) for p, q, w in found]) == best


def test_leaks(spark, monkeypatch):
    clean = "My friend asked why my ear was odd. " * 20
    half = "Records from the dexhylo registry mention nine earlier visits and a firm cord."
    docs = [
        (1, clean + ITEM + clean), (2, clean + ITEM.upper().replace(" ", "\n")), (3, "<p>" + half.replace("registry", "reg-\nistry").replace("visits", "vis​its") + "</p>" + clean),
        (4, clean), (5, None), (6, ""), (7, "Choose the photograph in which the brow tail shows a hollow but no trace of nothing."), (8, ITEM.replace("the", "<b>the</b>").replace("trace", "hint")),
        (9, clean * 40 + SECOND), (10, ITEM + " " + SECOND),
    ]
    items = [(101, ITEM), (102, SECOND), (103, None), (104, ""), (105, "!!!")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(5), "coverage": F.lit(1)})
    i = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 101), (2, 101), (3, 101), (8, 101), (9, 102), (10, 101), (10, 102)}
    assert {(x.doc_id, x.item_id) for x in leakage.leaks(d, i).where("coverage >= 1/3").collect()} == want
    monkeypatch.setattr(leakage, "MAX_BLOCK_WORDS", 10)
    assert {(x.doc_id, x.item_id) for x in leakage.leaks(d, i).collect()} >= {(1, 101), (9, 102)}
    monkeypatch.undo()
    assert leakage.leaks(d.limit(0), i).count() == 0 and leakage.leaks(d, i.limit(0)).count() == 0


def test_shared_wording_does_not_depend_on_blocks(spark, monkeypatch):
    d = spark.createDataFrame([(1, ITEM), (2, "Choose the photograph in which the sky is blue but no trace of rain. Records from the past mention snow."), (3, SECOND)], "doc_id long, text string")
    i = spark.createDataFrame([(101, ITEM), (102, SECOND)], "item_id long, text string")
    whole = sorted(map(tuple, leakage.leaks(d, i, share=0.05).collect()))
    monkeypatch.setattr(leakage, "MAX_BLOCK_WORDS", 10)
    assert sorted(map(tuple, leakage.leaks(d, i, share=0.05).collect())) == whole


def test_reordered_passages_tile_but_do_not_keep_order():
    index = leakage.ItemIndex([(1, ITEM), (2, SECOND)])
    a, b = ITEM.split(". ")
    ordered, tiled = leakage.coverage(index, 1, words(b + " " + a))
    assert tiled == 1.0 and ordered < 0.8


def test_passages_without_rare_words():
    body = "when the brow is given to a florist ask how many units remain before the cooling starts and why it hurts"
    names = "nemiren dusmarbra griquizan vatelbel miombra juwope hylo thuwoom"
    item = words(f"{names} {body} dexhylo voquidor registry lamp zanbrako palcalkra selcalpe marvaju")
    index = leakage.ItemIndex([(1, " ".join(item)), (2, " ".join(reversed(words(body))))])
    own, rare = index.countable[1], index.distinctive[1]
    assert all(own) and sum(rare) == 16
    third = -(-len(item) // 3)
    for start in range(len(item) - third + 1):
        passage = item[start : start + third]
        assert leakage.coverage(index, 1, ["x"] * 5 + passage + ["y"] * 5)[0] >= leakage.SHARE
        if not any(rare[start : start + third]):
            # a single word that other items have too is altered
            assert leakage.coverage(index, 1, [*passage[:6], "z", *item[start + 7 : start + third + 1]])[0] >= leakage.SHARE
    # a refilled form: short pieces, names exchanged
    form = words("ask nemiren about the brow if dusmarbra is given to a florist and griquizan units remain before vatelbel cooling starts")
    index = leakage.ItemIndex([(1, " ".join(form)), (2, "ask about the brow if is given to florist a and units remain before cooling starts")])
    refilled = [f"other{k}" if r else w for k, (w, r) in enumerate(zip(form, index.distinctive[1]))]
    assert leakage.tiles(form, refilled) and leakage.coverage(index, 1, refilled) == (0.0, 0.0)


def test_words():
    assert words("<p>Ｆｏｏ</p><p>b­ar&amp;ção sep-\narate</p>") == ["foo", "bar", "cao", "separate"]
    assert words(None) == words("...") == []


EASY = ["I am fine now.", "My ear is red.", "It did not hurt.", "We went home soon."]
HARD = ["Multivariable quantification recapitulates anatomical implications notwithstanding considerable attrition.", "Longitudinal standardization substantiates interdisciplinary inconsistencies throughout surveillance."]


def corpus(seed, n):
    r = random.Random(seed)
    out = []
    for k in range(n):
        g = 1 if k % 2 else 4
        out.append((k, " ".join(r.choice(EASY if g == 1 else HARD) for _ in range(12)), g))
    return out


def test_held_out_levels(spark):
    rows = corpus(1, 80)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(900, None), (901, ""), (902, "too short"), (903, "zzz " * 40)], "doc_id long, text string").withColumns({"reading_level": F.lit("x"), "g": F.lit(1)})
    rated = spark.createDataFrame([(k, "r", g) for k, _, g in rows[:40]] + [(1, "s", 1), (2, "s", None), (None, "s", 2), (3, "s", 9)], "doc_id long, rater string, reading_level int")
    models = reading_level.train(docs, rated)
    got = {x.doc_id: x.reading_level for x in reading_level.levels(docs, models).collect()}
    assert {k: got[k] for k, _, g in rows[40:]} == {k: g for k, _, g in rows[40:]}
    assert {900, 901, 902}.isdisjoint(got) and got[903] == 1
    seeded = reading_level.train(docs, rated.limit(0))
    got = {x.doc_id: x.reading_level for x in reading_level.levels(docs, seeded).collect()}
    assert all(got[k] < got[j] for k, _, g in rows if g == 1 for j, _, h in rows if h == 4)
    assert reading_level.levels(docs.limit(0), models).count() == 0


def test_a_long_quotation_does_not_decide():
    models = reading_level.Models({w: [9.0, 0, 0, 0] for s in EASY for w in words(s)} | {w: [0, 0, 0, 9.0] for s in HARD for w in words(s)})
    assert models.level(" ".join(EASY * 3) + " " + HARD[0]) == 1
    assert models.level(None) == 1


def test_texts_of_one_id_and_without_id_are_items(spark):
    docs = spark.createDataFrame([(1, "one two three"), (1, "two three one"), (1, "one two three"), (None, "four"), (2, "")], "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    out = packing.pack(packing.token_counts(docs), 100).collect()
    assert sorted((x.doc_id or 0) for x in out) == [0, 1, 1] and len({x.container for x in out}) == 1
