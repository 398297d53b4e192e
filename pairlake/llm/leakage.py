"""Evaluation passages inside a training corpus, by greedy string tiling.

Every document is compared with every evaluation item that shares a seed (a run
of ``SEED`` words that belongs to one item only). Seeds are looked up through
their rarest word, so a document is read once and most of it costs one set
lookup a word. A pair with a seed is tiled: matches of at least ``MIN_TILE``
words, found by running Karp-Rabin hashing of all word windows of the item,
are marked longest first and never overlap. Tiles then count as follows.

* Words of an item that lie only in runs shared with other items (instruction
  sentences, question forms) count neither for nor against it.
* The other words are weighed by one over the number of items that have them,
  from 1 for a word of one item down to 0 for a word of all items: a refilled question form agrees with an item in short pieces of common words,
  between which those that few items have (names and the like) are exchanged. So
  where the weights reproduced don't reach the share, only long verbatim
  passages count, whatever words they hold: runs of at least ``VERBATIM`` words
  (tiles on both sides of one altered word that other items have too are one
  run), and single tiles that reach the share alone.
* Tiles that keep the item's order are joined into the heaviest chain; the
  share of countable words in that chain is ``coverage``. ``tiled`` is the same
  share over all tiles, whatever their order, so reordered passages show up.

Documents are read in one pass without a shuffle. What is sent to executors
is the item index; it is bounded by ``MAX_BLOCK_WORDS`` words of items, and
more items than that are done in several passes, one block of items each. What
items share is found over all of them on the driver, before they are divided.

Cases: null, empty or wordless documents and items give no row; a document
repeated under the same id gives repeated rows only if the input repeats it
(rows are made distinct at the end); texts of any length are read whole; an
item all of whose wording is shared can't be found (nothing of it counts).
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlake.llm.textnorm import words

SEED = 3
MIN_TILE = 3
SHARE = 1 / 3
VERBATIM = 12
MAX_BLOCK_WORDS = 2_000_000
BASE, MOD = 1_000_003, (1 << 61) - 1


class Wording:
    """Owners of seeds (-1 where items share one) and the number of items with each word, over all items."""

    def __init__(self, texts: dict[int, list[str]], seed: int = SEED) -> None:
        self.owners: dict[tuple[str, ...], int] = {}
        self.df: Counter[str] = Counter()
        self.n = len(texts)
        for i, w in texts.items():
            self.df.update(set(w))
            for k in range(len(w) - seed + 1):
                g = tuple(w[k : k + seed])
                self.owners[g] = i if self.owners.get(g, i) == i else -1


class ItemIndex:
    """Seeds of evaluation items with their rarest words, and each item's words.

    ``wording`` is that of all items, where these are only a block of them.
    """

    def __init__(self, items: list[tuple[int, str]], seed: int = SEED, wording: Wording | None = None) -> None:
        self.seed = seed
        self.words = {i: w for i, t in items if (w := words(t))}
        every = wording or Wording(self.words, seed)
        owners, df = every.owners, every.df
        self.countable: dict[int, list[bool]] = {}
        self.distinctive = {i: [df[x] == 1 for x in w] for i, w in self.words.items()}
        self.weights: dict[int, list[float]] = {}
        self.anchor: dict[str, list[tuple[int, tuple[str, ...], int]]] = defaultdict(list)
        for i, w in self.words.items():
            own = [False] * len(w)
            for k in range(len(w) - seed + 1):
                if owners[tuple(w[k : k + seed])] == i:
                    own[k : k + seed] = [True] * seed
            self.countable[i] = own
            self.weights[i] = [float(o) if every.n == 1 else o * (1 / df[x] - 1 / every.n) / (1 - 1 / every.n) for o, x in zip(own, w)]
        for g, i in owners.items():
            if i != -1 and i in self.words:
                at = min(range(seed), key=lambda k: (df[g[k]], -len(g[k])))
                self.anchor[g[at]].append((at, g, i))
        self.anchor = dict(self.anchor)

    def candidates(self, doc: list[str]) -> set[int]:
        """Items that own a seed which occurs in the document."""
        anchor, seed, found = self.anchor, self.seed, set()
        for p, w in enumerate(doc):
            if w in anchor:
                for at, g, i in anchor[w]:
                    if i not in found and p >= at and tuple(doc[p - at : p - at + seed]) == g:
                        found.add(i)
        return found


def window_hashes(ids: list[int], n: int) -> Iterator[int]:
    """Running Karp-Rabin hashes of all windows of n word ids."""
    if len(ids) < n:
        return
    top, h = pow(BASE, n - 1, MOD), 0
    for x in ids[:n]:
        h = (h * BASE + x) % MOD
    yield h
    for k in range(n, len(ids)):
        h = ((h - ids[k - n] * top) * BASE + ids[k]) % MOD
        yield h


def tiles(item: list[str], doc: list[str], least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, document position, words), longest first."""
    vocab = {w: k for k, w in enumerate(dict.fromkeys(item), 1)}
    a, b = [vocab[w] for w in item], [vocab.get(w, 0) for w in doc]
    at: dict[int, list[int]] = defaultdict(list)
    for p, h in enumerate(window_hashes(a, least)):
        at[h].append(p)
    seeds = []
    # a document's words outside the item are 0, so only its runs of item words are hashed
    start = 0
    while start < len(b):
        if not b[start]:
            start += 1
            continue
        end = start
        while end < len(b) and b[end]:
            end += 1
        for q, h in enumerate(window_hashes(b[start:end], least), start):
            for p in at.get(h, ()):
                if a[p : p + least] == b[q : q + least]:
                    seeds.append((p, q))
        start = end
    if not seeds:
        return []
    alive = set(seeds)
    runs = []
    for p, q in seeds:
        if (p - 1, q - 1) not in alive:
            n = least
            while (p + n - least + 1, q + n - least + 1) in alive:
                n += 1
            runs.append((n, p, q))
    used_a, used_b, out = set(), set(), []
    # longest first; a run that earlier tiles cut into is put back with what is left of it
    buckets: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for n, p, q in runs:
        buckets[n].append((p, q))
    for n in range(max(buckets), least - 1, -1):
        for p, q in sorted(buckets.pop(n, ())):
            free = [p + k not in used_a and q + k not in used_b for k in range(n)]
            if all(free):
                used_a.update(range(p, p + n))
                used_b.update(range(q, q + n))
                out.append((p, q, n))
                continue
            k = 0
            while k < n:
                if not free[k]:
                    k += 1
                    continue
                e = k
                while e < n and free[e]:
                    e += 1
                if e - k >= least:
                    buckets[e - k].append((p + k, q + k))
                k = e
    return out


def heaviest_chain(found: list[tuple[int, int, int, int]]) -> int:
    """Largest total weight of tiles (p, q, n, weight) that rise in both texts."""
    best_q: list[int] = []
    best_w: list[int] = []
    top = 0
    for _, q, _, w in sorted(found):
        k = bisect_right(best_q, q) - 1
        v = w + (best_w[k] if k >= 0 else 0)
        if k >= 0 and best_w[k] >= v:
            continue
        if k >= 0 and best_q[k] == q:
            best_w[k] = v
        else:
            k += 1
            best_q.insert(k, q)
            best_w.insert(k, v)
        while k + 1 < len(best_w) and best_w[k + 1] <= v:
            del best_q[k + 1], best_w[k + 1]
        top = max(top, v)
    return top


def verbatim(found: list[tuple[int, int, int]], rare: list[bool], least: int = VERBATIM) -> set[tuple[int, int, int]]:
    """Tiles in runs of at least ``least`` words; a run goes on after one altered word unless that word is rare."""
    runs: list[list[tuple[int, int, int]]] = []
    for p, q, n in sorted(found):
        if runs:
            p0, q0, n0 = runs[-1][-1]
            if p - p0 - n0 == q - q0 - n0 == 1 and not rare[p - 1]:
                runs[-1].append((p, q, n))
                continue
        runs.append([(p, q, n)])
    return {t for r in runs if r[-1][0] + r[-1][2] - r[0][0] >= least for t in r}


def coverage(index: ItemIndex, item_id: int, doc: list[str], least: int = MIN_TILE, share: float = SHARE) -> tuple[float, float]:
    """Share of an item's countable words reproduced: in the item's order, in any order."""
    own, rare, weights = index.countable[item_id], index.distinctive[item_id], index.weights[item_id]
    total = sum(own)
    if not total:
        return 0.0, 0.0
    matches = tiles(index.words[item_id], doc, least)
    found = [(p, q, n, weight) for p, q, n in matches if (weight := sum(own[p : p + n]))]
    if sum(sum(weights[p : p + n]) for p, _, n in matches) < share * sum(weights):
        long = verbatim(matches, rare)
        found = [x for x in found if x[:3] in long or x[3] / total >= share]
    return heaviest_chain(found) / total, sum(w for *_, w in found) / total


def match_batch(index: ItemIndex, ids: pd.Series, texts: pd.Series, share: float) -> list[tuple[int, int, float, float]]:
    out = []
    for doc_id, text in zip(ids, texts):
        if not text:
            continue
        doc = words(text)
        for i in sorted(index.candidates(doc)):
            ordered, tiled = coverage(index, i, doc, share=share)
            if max(ordered, tiled) >= share:
                out.append((doc_id, i, ordered, tiled))
    return out


def leaks(
    documents: DataFrame,
    items: DataFrame,
    share: float = SHARE,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, coverage, tiled) of pairs that reproduce at least ``share`` of an item.

    ``coverage`` keeps the item's order, ``tiled`` doesn't; a row is given if
    either reaches the share.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null")
    schema = "doc_id long, item_id long, coverage double, tiled double"
    block: list[tuple[int, str]] = []
    size, parts = 0, []

    def search(own: list[tuple[int, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(ItemIndex(own, wording=wording))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = sent.value
            for pdf in batches:
                rows = match_batch(index, pdf["doc_id"], pdf["text"], share)
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "coverage", "tiled"])

        return docs.mapInPandas(run, schema)

    rows = items.select(F.col(item_col).cast("long"), F.col(item_text)).where(f"`{item_col}` is not null").distinct()
    texts = dict(rows.toLocalIterator())
    # what items share is found over all of them, so that results don't depend on the blocks
    wording = Wording({i: w for i, t in texts.items() if (w := words(t))})
    for item_id, text in texts.items():
        n = len(words(text))
        if block and size + n > MAX_BLOCK_WORDS:
            parts.append(search(block))
            block, size = [], 0
        block.append((item_id, text))
        size += n
    parts.append(search(block))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
