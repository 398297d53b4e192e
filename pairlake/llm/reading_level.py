"""Reading level of documents, by smoothed unigram language models per grade.

One unigram model per grade is counted from rated documents (a document that
raters disagree on counts for each grade with its raters' share) and smoothed
by adding ``SMOOTH`` to every count. Without rated documents the grades are
seeded by a formula (letters per word and words per sentence).

A text's level is the grade with the highest posterior of the document: the
product of its sentences' likelihoods under the models. A sentence is taken to
be pasted from elsewhere with the chance ``PASTED``, and then says nothing of the
grade, so that a footer or one long quotation doesn't outweigh the rest.

Words are counted in a distributed way; the models come from about
``MAX_RATED`` rated documents (those whose id's hash lies below a bound taken from
their number), which bounds what is sent to executors; nothing is sorted for it.
Documents are read once for the models and once for
their levels; texts are not shuffled, but for the rated ones of the models.

Cases: null, empty and short texts (under ``least`` words) have no row; a
document that is given or rated several times counts once; words that no rated document has say
nothing; ties go to the lower level; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlake.llm.textnorm import WORD, fold, plain

GRADES = 4
SMOOTH = 0.1
MAX_RATED = 50_000
PASTED = 0.02
SENTENCE = re.compile(r"(?<=[.!?。])\s+|\n+")
#: Bounds of the formula between the grades; it grows by 4.71 a letter per word and 0.5 a word per sentence.
FORMULA = (16.0, 22.0, 30.0)


def sentences(text: str | None) -> list[list[str]]:
    """Folded words of each sentence that has words."""
    return [w for s in SENTENCE.split(fold(plain(text))) if (w := WORD.findall(s))]


def formula_grade(text: str | None) -> int:
    """Grade from letters per word and words per sentence."""
    parts = sentences(text)
    n = sum(map(len, parts))
    if not n:
        return 1
    score = 4.71 * sum(len(w) for s in parts for w in s) / n + 0.5 * n / len(parts) - 9
    return 1 + sum(score > b for b in FORMULA)


class Models:
    """Log probabilities of words per grade."""

    def __init__(self, counts: dict[str, list[float]], smooth: float = SMOOTH) -> None:
        self.ids = {w: k for k, w in enumerate(counts)}
        table = np.array(list(counts.values()), dtype=float).reshape(len(counts), GRADES) + smooth
        self.logs = np.log(table / np.maximum(table.sum(axis=0), 1e-9)) if counts else np.zeros((0, GRADES))

    def posterior(self, parts: list[list[str]]) -> np.ndarray:
        """The document's posterior of each grade."""
        ids = self.ids
        known = [[k for w in s if (k := ids.get(w)) is not None] for s in parts]
        known = [k for k in known if k]
        if not known:
            return np.full(GRADES, 1 / GRADES)
        starts = np.cumsum([0, *[len(k) for k in known[:-1]]])
        total = np.add.reduceat(self.logs[[k for s in known for k in s]], starts, axis=0)
        whole = np.log((1 - PASTED) * np.exp(total - total.max(axis=1, keepdims=True)) + PASTED).sum(axis=0)
        p = np.exp(whole - whole.max())
        return p / p.sum()

    def level(self, text: str | None) -> int:
        return int(np.argmax(np.round(self.posterior(sentences(text)), 12))) + 1


def word_counts(rated: DataFrame) -> DataFrame:
    """(word, c1..c4) of rated texts (text, r1..r4: the share of raters per grade)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for text, *shares in pdf[["text", "r1", "r2", "r3", "r4"]].itertuples(index=False):
                shares = np.array(shares)
                for w, n in Counter(x for s in sentences(text) for x in s).items():
                    sums[w] = sums[w] + n * shares if w in sums else n * shares
        for words in _slices(list(sums)):
            yield pd.DataFrame([(w, *sums[w]) for w in words], columns=["word", "c1", "c2", "c3", "c4"])

    parts = rated.mapInPandas(run, "word string, c1 double, c2 double, c3 double, c4 double")
    return parts.groupBy("word").agg(*[F.sum(f"c{g}").alias(f"c{g}") for g in range(1, GRADES + 1)])


def _slices(x: list, n: int = 20_000) -> Iterator[list]:
    for k in range(0, len(x), n):
        yield x[k : k + n]


def _bounded(rows: DataFrame, most: int) -> DataFrame:
    """All rows (doc_id, ...) if they are at most ``most``, else about so many, by a hash of their id."""
    n = rows.count()
    return rows if n <= most else rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(most / n * (1 << 40)))


def train(documents: DataFrame, ratings: DataFrame) -> Models:
    """Models from documents (doc_id, text) and ratings (doc_id, reading_level)."""
    ok = ratings.where(F.col("doc_id").isNotNull() & F.col("reading_level").between(1, GRADES))
    shares = ok.groupBy("doc_id").agg(*[(F.count_if(F.col("reading_level") == g) / F.count(F.lit(1))).alias(f"r{g}") for g in range(1, GRADES + 1)])
    shares = _bounded(shares, MAX_RATED)
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    # about MAX_RATED short rows go to every task, and only their texts are shuffled, to count each document once
    rows = word_counts(docs.join(F.broadcast(shares), "doc_id").dropDuplicates(["doc_id"]).drop("doc_id")).collect()
    if not rows:
        seeded = _bounded(docs, MAX_RATED)
        grade = F.pandas_udf(lambda t: t.map(formula_grade), "int")
        own = seeded.withColumn("g", grade("text")).select("text", *[(F.col("g") == g).cast("double").alias(f"r{g}") for g in range(1, GRADES + 1)])
        rows = word_counts(own).collect()
    return Models({r["word"]: [r["c1"], r["c2"], r["c3"], r["c4"]] for r in sorted(rows, key=lambda r: r["word"])})


def levels(documents: DataFrame, models: Models, least: int = 30) -> DataFrame:
    """(doc_id, reading_level, certainty) of documents (doc_id, text) with at least ``least`` words between white space."""
    sent = documents.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                if len(text.split()) >= least:
                    p = m.posterior(sentences(text))
                    k = int(np.argmax(np.round(p, 12)))
                    out.append((doc_id, k + 1, float(p[k])))
            yield pd.DataFrame(out, columns=["doc_id", "reading_level", "certainty"])

    docs = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInPandas(run, "doc_id long, reading_level int, certainty double")
