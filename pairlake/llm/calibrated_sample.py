"""Samples whose category shares follow target proportions, by calibration and the pivotal method.

Per population (here: the pairs of one balance report) every record starts
with the same inclusion probability. Calibration tilts it exponentially:
Newton iterations on the dual of the calibration problem drive expected numbers
to their targets. The dual's gradient and Hessian need only totals, so records are
aggregated once (partially, in a distributed way) and the iterations run on one row
per population and cell.

``plan`` calibrates by category alone, inside generated code: the dual falls
into one equation a category. Probabilities end at 1; what a category then falls
short of its target is its residual, and a residual is a gap, which is reported.

``calibrated`` calibrates jointly by category and a second margin (strata, whose
shares are to stay those of the population): one dual with all multipliers, whose
Hessian is solved in every Newton step. Category targets are exact; the second margin
is a soft one, since it may contradict them. The size of the sample is held: floors
come first, no category gets more than it has, and the room that gaps leave goes to the
others in proportion to their targets.

Records are then drawn with the tilted probabilities by the pivotal method:
two undecided records at a time fight, one of them is decided, and the sum of
probabilities stays, so every category gets its target to within one record, and the
sample its size. The fights are run in random blocks of bounded size; each block leaves
at most one undecided record per category, and those fight once more per population, in
order of category. Each round of fights has random numbers of its own.

Cases: null categories and categories without a target are no part of the
sample; repeated records count once; a population without records gives only
gaps; a target of 0 with a floor still gets its floor; floors above the size make the
sample larger than it; empty tables give no rows; null strata are a stratum.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairlake.runtime import cut

BLOCK = 5_000
NEWTON = 60


def newton(total: Column, start: Column, goal: Column) -> Column:
    """Tilt of a category: the root of total * start * exp(tilt) = goal, by damped Newton steps."""

    def step(tilt: Column, _: Column) -> Column:
        moment = total * start * F.exp(tilt)
        move = (goal - moment) / moment
        return tilt + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), move))

    return F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON)), F.lit(0.0), step)


def plan(counts: DataFrame, targets: DataFrame, size: int) -> DataFrame:
    """One row per population and target category.

    counts: (population, category, available); targets: (category, permille, floor), a short table of
    fixed categories. Gives required, goal, the tilt, the inclusion probability and whether there is a gap.
    """
    counts = counts.groupBy("population", "category").agg(F.sum("available").cast("long").alias("available")).where("population is not null")
    targets = targets.where("category is not null").groupBy("category").agg(F.max("permille").alias("permille"), F.max("floor").alias("floor"))
    population = counts.select("population").distinct()
    pairs = F.collect_list(F.struct("category", "permille", "floor"))
    # every population needs all categories: the target table is one array, not a join
    wanted = population.join(F.broadcast(targets.agg(pairs.alias("t"))), F.lit(True)).select("population", F.inline("t"))
    have = wanted.join(counts, ["population", "category"], "left").withColumn("available", F.coalesce("available", F.lit(0).cast("long")))
    required = F.greatest(F.col("floor").cast("double"), F.col("permille") * size / 1000)
    goal = F.least(F.ceil(F.round(required, 9)).cast("double"), F.col("available").cast("double"))
    out = have.withColumns({"required": required, "goal": goal})
    everyone = counts.groupBy("population").agg(F.sum("available").alias("records"))
    out = out.join(everyone, "population").withColumn("start", F.least(F.lit(1.0), F.lit(float(size)) / F.greatest(F.col("records"), F.lit(1))))
    have, start = F.col("available").cast("double"), F.col("start")
    tilt = lambda goal: F.when((F.col(goal) > 0) & (F.col("available") > 0), newton(have, start, F.col(goal)))
    reached = lambda tilt: F.when(F.col(tilt).isNull(), 0.0).otherwise(F.least(F.lit(1.0), start * F.exp(tilt)))
    # calibrated to all that is required, a category falls short by its residual: its probabilities end at 1
    out = out.withColumn("full", tilt("required")).withColumn("residual", F.col("required") - have * reached("full"))
    out = out.withColumn("gap", F.col("residual") > F.col("required") * 1e-9).withColumn("tilt", tilt("goal")).withColumn("probability", reached("tilt"))
    return out.select("population", "category", "available", "required", "permille", "floor", "goal", "residual", "gap", "tilt", "probability")


def goals(available: np.ndarray, permille: np.ndarray, floor: np.ndarray, size: float) -> np.ndarray:
    """Expected numbers that hold the size: in proportion to the targets, at least the floors, at most what is there."""
    low = np.minimum(floor, available)
    if available.sum() <= size:
        return available
    if low.sum() >= size:
        return low
    small, large = 0.0, 1.0
    fill = lambda t: np.clip(t * permille, low, available)
    while fill(large).sum() < size and large < 1e12:
        large *= 2
    if fill(large).sum() < size:
        # all with a target have all they can: what is left goes to those without, by what they have
        got = fill(large)
        return got + (available - got) * (size - got.sum()) / (available - got).sum()
    for _ in range(200):
        middle = (small + large) / 2
        small, large = (middle, large) if fill(middle).sum() < size else (small, middle)
    got = fill(large)
    open_ = (got > low) & (got < available)
    if open_.any():
        got[open_] *= 1 + (size - got.sum()) / got[open_].sum()
    return got


def solve(n: np.ndarray, cat: np.ndarray, stratum: np.ndarray, goal: np.ndarray, share: np.ndarray, start: float, soft: float = 1e-2, turns: int = 100) -> np.ndarray:
    """Inclusion probabilities of cells (n records, number of category and stratum): Newton on the joint dual.

    ``goal`` per category is met exactly, ``share`` per stratum as far as ``soft`` (a penalty on its multipliers) lets it.
    """
    c, s = len(goal), len(share)
    x = np.zeros((len(n), c + s))
    x[np.arange(len(n)), cat] = 1.0
    x[np.arange(len(n)), c + stratum] = 1.0
    target, ridge = np.concatenate([goal, share]), np.concatenate([np.full(c, 1e-12), np.full(s, soft)])
    chance = lambda m: np.minimum(1.0, start * np.exp(np.clip(x @ m, -60, 60)))

    def dual(m: np.ndarray) -> float:
        eta = np.clip(x @ m, -60, 60)
        free = start * np.exp(eta)
        # the integral of min(1, start exp(eta)): beyond 1 it is linear
        return float((n * np.where(free < 1, free, 1.0 + eta + np.log(start))).sum() - target @ m + 0.5 * (ridge * m * m).sum())

    m = np.zeros(c + s)
    for _ in range(turns):
        p = chance(m)
        slope = x.T @ (n * p) - target + ridge * m
        if np.abs(slope).max() < 1e-9 * max(1.0, target.sum()):
            break
        bend = (x * (n * np.where(p < 1, p, 0.0))[:, None]).T @ x + np.diag(ridge + 1e-9)
        move, at, step = np.clip(-np.linalg.solve(bend, slope), -2, 2), dual(m), 1.0
        while step > 1e-6 and dual(m + step * move) > at + 1e-4 * step * (slope @ move):
            step /= 2
        m = m + step * move
    p = chance(m)
    # what the soft margin left of the categories' equations: one equation each
    for k in range(c):
        own = (cat == k) & (n > 0)
        for _ in range(100):
            got, free = (n[own] * p[own]).sum(), (n[own] * np.where(p[own] < 1, p[own], 0.0)).sum()
            if free <= 0 or abs(got - goal[k]) < 1e-12 * max(1.0, goal[k]):
                break
            p[own] = np.where(p[own] < 1, np.minimum(1.0, p[own] * max(0.0, 1 + (goal[k] - got) / free)), 1.0)
    return p


def calibrated(cells: DataFrame, targets: DataFrame, size: int) -> DataFrame:
    """(population, category, stratum, available, required, goal, gap, probability) of cells (population, category, stratum, available).

    One row per cell of a target category; a population has at most categories x strata of them. The goal is that of the category.
    """
    cells = cells.groupBy("population", "category", F.coalesce(F.col("stratum").cast("string"), F.lit("")).alias("stratum")).agg(F.sum("available").cast("long").alias("n"))
    wanted = plan(cells.select("population", "category", F.col("n").alias("available")), targets, size).select("population", "category", "required", "permille", "floor", "gap")
    rows = wanted.join(cells, ["population", "category"], "left").select("population", "category", "stratum", F.coalesce("n", F.lit(0).cast("long")).alias("available"), "required", "permille", "floor", "gap")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["category", "stratum"], na_position="last").reset_index(drop=True)
        cat, names = pd.factorize(pdf["category"])
        stratum, strata = pd.factorize(pdf["stratum"].fillna(""))
        n = pdf["available"].to_numpy(float)
        first = pdf.groupby(cat).first()
        have, by = np.bincount(cat, n, len(names)), np.bincount(stratum, n, len(strata))
        goal = goals(have, first["permille"].to_numpy(float), first["floor"].to_numpy(float), float(size))
        p = np.zeros(len(n))
        if n.sum():
            p = solve(n, cat, stratum, goal, goal.sum() * by / by.sum(), min(1.0, size / n.sum()))
        return pdf.assign(goal=goal[cat], probability=p)[["population", "category", "stratum", "available", "required", "goal", "gap", "probability"]]

    kind = dict(rows.dtypes)["population"]
    return rows.groupBy("population").applyInPandas(run, f"population {kind}, category string, stratum string, available long, required double, goal double, gap boolean, probability double")


def fight(p: list[float], u: list[float]) -> list[float]:
    """Pivotal method: probabilities become 0 or 1, but for at most one; u: a random number for each record."""
    p = list(p)
    open_ = -1
    for k in range(len(p)):
        if p[k] < 1e-9 or p[k] > 1 - 1e-9:
            p[k] = float(round(p[k]))
            continue
        if open_ < 0:
            open_ = k
            continue
        a, b, s = p[open_], p[k], p[open_] + p[k]
        if s < 1:
            # the loser gets 0, the winner the sum
            win, lose = (open_, k) if u[k] < a / s else (k, open_)
            p[win], p[lose] = s, 0.0
            open_ = win
        else:
            # the winner gets 1, the loser what is left
            win, lose = (open_, k) if u[k] < (1 - b) / (2 - s) else (k, open_)
            p[win], p[lose] = 1.0, s - 1
            open_ = lose
        if p[open_] < 1e-9 or p[open_] > 1 - 1e-9:
            p[open_] = float(round(p[open_]))
            open_ = -1
    return p


def draw(records: DataFrame, planned: DataFrame, seed: str = "42") -> DataFrame:
    """(population, category, record_id) of the sample; records: (population, category, record_id), with a stratum if ``planned`` has one."""
    cell = ["population", "category", *(["stratum"] if "stratum" in planned.columns else [])]
    total = F.sum("available").over(Window.partitionBy("population"))
    chance = planned.withColumn("total", total).where("probability > 0").select(*cell, "probability", "total")
    if "stratum" in cell:
        records = records.withColumn("stratum", F.coalesce(F.col("stratum").cast("string"), F.lit("")))
    own = records.where("population is not null and category is not null and record_id is not null").select(*cell, "record_id").dropDuplicates(["population", "category", "record_id"])
    number = lambda k: F.xxhash64(F.lit(f"{seed} round {k}"), "record_id").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    h = F.xxhash64(F.lit(seed), "record_id")
    keyed = own.join(chance, cell).withColumns({"h": h, "u1": number(1), "u2": number(2), "u3": number(3), "block": F.pmod(h, F.ceil(F.col("total") / BLOCK))})
    kind = dict(own.dtypes)["population"]
    schema = f"population {kind}, category string, record_id long, h long, u1 double, u2 double, u3 double, probability double"
    columns = [x.split()[0] for x in schema.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["category", "h", "record_id"])[columns]
        p, u, cat = pdf["probability"].tolist(), pdf["u1"].tolist(), pdf["category"].tolist()
        out, k = [], 0
        while k < len(p):
            e = bisect_right(cat, cat[k], k)
            out += fight(p[k:e], u[k:e])
            k = e
        return pdf.assign(probability=out)

    once = cut(keyed.groupBy("population", "block").applyInPandas(run, schema))
    # what blocks leave undecided: at most one record a category each
    again = once.where("probability > 0 and probability < 1")

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["category", "h", "record_id"])[columns]
        out = fight(pdf["probability"].tolist(), pdf["u2"].tolist())
        return pdf.assign(probability=[float(p > 0 and (p >= 1 or u < p)) for p, u in zip(out, pdf["u3"])])

    done = once.where("probability >= 1").unionByName(again.groupBy("population").applyInPandas(last, schema).where("probability >= 1"))
    return done.select("population", "category", "record_id")
