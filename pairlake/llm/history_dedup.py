"""New batches against all accepted history, over a kept table of distances to pivots.

A row's point has four coordinates, two for its before and two for its after
picture. A coordinate is a number whose leading digits are a hash of the site,
then of the case, then of the series (role and file name without its last
number), and whose last digits are the file's number itself, so it keeps
likeness: shots that follow each other in a series lie one apart in both of
their picture's coordinates, other pictures lie far away. The metric is the sum
of the coordinates' differences (L1): 0 for the same two pictures, 2 if one of
the two is the neighbouring shot.

The pivot table keeps for every accepted row its point and its distances to
four fixed pivots. By the triangle inequality two rows within radius r have
distances to every pivot that differ by at most r: the join takes cells of the
first two pivots, drops what another pivot tells apart, and verifies the true
distance. Rows within the radius are near-duplicates; those that also agree in
a 128-bit hash of the two pictures (the exact check) are repeats.

``History`` is that table in the shared folder, range-partitioned and sorted
by the first distance. Accepted addresses are parsed once, when it is made.
New rows are parsed alone, read only the ranges that their own distances reach
(partition pruning) and are joined without moving history while they are of
bounded size. Batches that come together are admitted in order but in one pass:
a row meets history, its own batch and earlier batches, so history is read and
moved once, not once a batch; then links to rows that weren't admitted
themselves (they had a same row with a smaller id before them) are dropped, and
the new rows are appended. That is what one batch after the other gives.

Copies of one row are one point of the table, so they are no hot cell; ranges
come from the data's own distribution, so a site with a third of all rows
spreads over a third of the ranges. Only the last join, of the new rows with the
outcome of their pictures (one row), meets all copies; such a join is what AQE
splits.

Cases: a row whose pictures can't be read from its addresses (null or blank)
is no repetition of anything; an address of unknown form stands for itself;
repeated ids count once; empty batches and an empty history give no rows. Ids
rise from batch to batch: the row admitted first is the one repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.llm.pictures import with_pictures
from pairlake.runtime import bounded, cut, fresh_path, written

PRINTS = ["f0", "f1"]
COORDINATES = ["c0", "c1", "c2", "c3"]
DISTANCES = ["d0", "d1", "d2", "d3"]
COLUMNS = ["id", *PRINTS, *COORDINATES, *DISTANCES]
#: Bits of a coordinate: site, case, series, number.
SITE_BITS, CASE_BITS, SERIES_BITS, NUMBER_BITS = 14, 14, 12, 20
#: Fixed points: corners of the space, all coordinates are below TOP.
TOP = 1 << (SITE_BITS + CASE_BITS + SERIES_BITS + NUMBER_BITS)
PIVOTS = [(0, 0, 0, 0), (0, 0, TOP, TOP), (0, TOP, 0, TOP), (0, TOP, TOP, 0)]
#: One of the two pictures may be the neighbouring shot.
RADIUS = 2
#: History has about so many rows in a range; ranges are at least 8, at most 256.
RANGE_ROWS = 100_000
#: Batch of accepted rows: before all others.
ACCEPTED = -(1 << 62)
NUMBER = r"(\d{1,6})$"


def points(rows: DataFrame, id_col: str = "id", before: str = "before_url", after: str = "after_url", keep: list[str] | None = None) -> DataFrame:
    """(id, f0, f1, c0..c3, kept columns); a picture that can't be read is like no other row's.

    Nothing is filtered on what is computed here: such a filter would be pushed to the scan with
    all of the address's stages in one expression.
    """
    keep = keep or []
    own = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(before).alias("b"), F.col(after).alias("a"), *keep)
    own = with_pictures(own, {"b": "pb", "a": "pa"})
    sides = ("pb", "pa")
    own = own.withColumns({p: F.coalesce(F.nullif(F.col(p), F.lit("")), F.concat(F.lit(f"{p} of row "), F.col("id").cast("string"), F.lit("."))) for p in sides})
    own = own.withColumns({f"{p}_n": F.regexp_extract(p, NUMBER, 1) for p in sides})
    own = own.withColumns({f"{p}_s": F.substring(F.col(p), F.lit(1), F.length(p) - F.length(f"{p}_n")) for p in sides})
    # bits, not divisions: what can't be null has no filter that would be pushed down into the parsing
    hashed = lambda seed, x, bits: F.xxhash64(F.lit(seed), x).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    def coordinate(p: str, seed: int) -> Column:
        site, case = F.substring_index(p, "|", 1), F.substring_index(p, "|", 2)
        parts = [(hashed(seed, site, SITE_BITS), CASE_BITS), (hashed(seed, case, CASE_BITS), SERIES_BITS), (hashed(seed, F.col(f"{p}_s"), SERIES_BITS), NUMBER_BITS)]
        total = F.lit(0).cast("long")
        for value, shift in parts:
            total = F.shiftleft(total + value, shift)
        return total + F.coalesce(F.nullif(F.col(f"{p}_n"), F.lit("")).cast("long"), F.lit(0))

    prints = [F.xxhash64(F.lit(k), *sides).alias(f) for k, f in zip((11, 23), PRINTS)]
    coordinates = [coordinate(p, seed) for p in sides for seed in (5, 7)]
    return own.select("id", *prints, *[c.alias(n) for c, n in zip(coordinates, COORDINATES)], *keep)


def _distance(a: list[Column], b: list[Column]) -> Column:
    total = F.abs(a[0] - b[0])
    for x, y in zip(a[1:], b[1:]):
        total = total + F.abs(x - y)
    return total


def with_distances(pts: DataFrame) -> DataFrame:
    own = [F.col(c) for c in COORDINATES]
    return pts.withColumns({d: _distance(own, [F.lit(x).cast("long") for x in p]) for d, p in zip(DISTANCES, PIVOTS)})


def pivot_table(pts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(id, f0, f1, c0..c3, d0..d3): one row per two pictures (and ``by``), the smallest id; distances to all pivots."""
    first = pts.groupBy(*(by or []), *PRINTS, *COORDINATES).agg(F.min("id").alias("id"))
    return with_distances(first).select(*COLUMNS, *(by or []))


def write_table(table: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Adds rows to a pivot table on disk, range-partitioned and sorted by the first distance."""
    by = ["d0", "d1", "d2"]
    (table.repartitionByRange(files, *by) if files else table.repartitionByRange(*by)).sortWithinPartitions(*by).write.mode(mode).parquet(path)


def near(known: DataFrame, new: DataFrame, radius: int = RADIUS, small: bool = False, order: str | None = None) -> DataFrame:
    """(id, f0, f1, known_id, distance, same) of all rows of two pivot tables within the radius of each other.

    Rows meet in cells of the first two pivots, wide enough that most of ``new`` reaches one cell only.
    ``small``: ``new`` is known to be of bounded size and is sent to where ``known`` lies. ``order``: a column of
    both; rows meet only what isn't later than they are, and the result has it too, and known's as known_(order).
    """
    bits = (4 * radius + 3).bit_length()
    columns = [*COLUMNS, order] if order else COLUMNS
    # one struct a row instead of eleven renamed columns: the optimizer infers less from it
    left = new.select(F.struct(*columns).alias("n"))
    for k in (0, 1):
        d = F.col(f"n.d{k}")
        left = left.withColumn(f"cell_{k}", F.explode(F.sequence(F.shiftright(d - radius, bits), F.shiftright(d + radius, bits))))
    right = known.select(F.struct(*columns).alias("k"), *[F.shiftright(f"d{k}", bits).alias(f"cell_{k}") for k in (0, 1)])
    joined = right.join(F.broadcast(left) if small else left, ["cell_0", "cell_1"])
    close = F.col(f"k.{order}") <= F.col(f"n.{order}") if order else F.lit(True)
    for d in DISTANCES:
        close = close & (F.abs(F.col(f"k.{d}") - F.col(f"n.{d}")) <= radius)
    gap = _distance([F.col(f"k.{c}") for c in COORDINATES], [F.col(f"n.{c}") for c in COORDINATES])
    same = (F.col("k.f0") == F.col("n.f0")) & (F.col("k.f1") == F.col("n.f1"))
    ordered = [F.col(f"n.{order}").alias(order), F.col(f"k.{order}").alias(f"known_{order}")] if order else []
    return joined.where(close).select("n.id", "n.f0", "n.f1", F.col("k.id").alias("known_id"), gap.alias("distance"), same.alias("same"), *ordered).where(F.col("distance") <= radius)


def repeated(incoming: DataFrame, firsts: DataFrame) -> DataFrame:
    """(first_id, dup_id) of rows (id, f0, f1) whose two pictures were admitted under a smaller id; firsts: (f0, f1, first_id)."""
    least = firsts.groupBy(*PRINTS).agg(F.min("first_id").alias("first_id"))
    return incoming.select("id", *PRINTS).join(least, PRINTS).where("first_id < id").select("first_id", F.col("id").alias("dup_id")).distinct()


def admit(known: DataFrame, incoming: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """(repeats, additions) of one batch of points against a pivot table.

    repeats: (first_id, dup_id), the smallest id in history or in the batch with the same two pictures;
    additions: the pivot table's rows to append, one per new two pictures.
    """
    added = cut(pivot_table(incoming))
    found = near(known, added, radius).where("same")
    firsts = found.select(*PRINTS, F.col("known_id").alias("first_id")).unionByName(added.select(*PRINTS, F.col("id").alias("first_id")))
    return repeated(incoming, firsts), added.join(found.select("id"), "id", "left_anti").select(*COLUMNS)


class History:
    """A pivot table in the shared folder, in ranges (``cell``) of the first distance."""

    def __init__(self, spark: SparkSession, path: str, lows: list[int]) -> None:
        self.spark, self.path, self.lows = spark, path, lows

    @classmethod
    def create(cls, pts: DataFrame, path: str | None = None) -> History:
        """Makes the table of accepted rows; their addresses are never read again."""
        spark = pts.sparkSession
        path = path or fresh_path(spark, "history")
        ranges = max(8, min(256, pts.count() // RANGE_ROWS))
        ranged = pivot_table(pts).repartitionByRange(ranges, "d0").withColumn("cell", F.spark_partition_id())
        ranged.sortWithinPartitions("cell", "d0").write.partitionBy("cell").parquet(path)
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> History:
        """A table made before; its ranges' lower ends (at most 256 numbers) are taken from it."""
        own = cls(spark, path, [])
        own.lows = [r["low"] for r in own.rows().groupBy("cell").agg(F.min("d0").alias("low")).orderBy("low").collect()][1:]
        return own

    def rows(self, cells: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some ranges: others are not read."""
        schema = ", ".join(f"{c} long" for c in COLUMNS) + ", cell int"
        every = self.spark.read.schema(schema).parquet(self.path)
        return every if cells is None else every.where(F.col("cell").isin(cells))

    def cell(self, distance: Column) -> Column:
        """The range of a distance."""
        if not self.lows:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(x) for x in self.lows]), lambda x: x <= distance))

    def append(self, fresh: DataFrame, small: bool = False) -> None:
        """Adds rows; ``small``: they are known to be of bounded size and are written by one task."""
        own = fresh.select(*COLUMNS, self.cell(F.col("d0")).alias("cell"))
        own = own.coalesce(1) if small else own.repartition("cell")
        own.sortWithinPartitions("cell", "d0").write.mode("append").partitionBy("cell").parquet(self.path)

    def admit_batches(self, incoming: DataFrame, batch: str, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
        """(repeats, links) of points with a batch number; batches are admitted in order, in one pass, and new rows appended.

        repeats: (first_id, dup_id); links: (id, f0, f1, known_id, distance, same), all pairs of
        one row per two pictures within the radius. Rows without a batch number come first.
        """
        rows = cut(incoming.select("id", *PRINTS, *COORDINATES, F.coalesce(F.col(batch).cast("long"), F.lit(-1)).alias("batch")))
        own = written(pivot_table(rows, ["batch"]), "batches")
        reach = F.sequence(self.cell(F.col("d0") - radius), self.cell(F.col("d0") + radius))
        cells = sorted(r["c"] for r in own.select(F.explode(reach).alias("c")).distinct().collect())
        known = self.rows(None if len(cells) > len(self.lows) else cells).select(*COLUMNS, F.lit(ACCEPTED).cast("long").alias("batch"))
        small = bounded(own)
        links = written(near(known.unionByName(own), own, radius, small, "batch").where("known_id < id"), "links")
        # a row with the same two pictures before it isn't admitted, so that no later row meets it
        refused = links.where("same").select("id", "batch").distinct()
        met = refused.select(F.col("id").alias("known_id"), F.col("batch").alias("known_batch"))
        later = links.where("known_batch < batch").join(met, ["known_id", "known_batch"], "left_anti")
        found = links.where("known_batch = batch").unionByName(later).select("id", *PRINTS, "known_id", "distance", "same")
        self.append(own.join(refused, ["id", "batch"], "left_anti"), small)
        # a row of its own batch is a first one unless a smaller id was linked to it
        firsts = found.where("same").select(*PRINTS, F.col("known_id").alias("first_id")).unionByName(own.select(*PRINTS, F.col("id").alias("first_id")))
        return repeated(rows, firsts), found
