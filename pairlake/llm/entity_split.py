"""Splits that keep related records together: spanning forest by Borůvka contraction.

Records link entities (here: image pairs link gallery cases). In every round
each entity picks its smallest incident link (links are ordered by their own
id, so picks never form a cycle but for two entities that pick each other),
picked links are contracted by pointer jumping, and links inside a contracted
entity are dropped. Rounds end when no link is left; the number of entities at
least halves in each, so there are at most log2(n). Picked links are the
spanning forest; it is written to the shared folder with every round's links
and can be read again. Only linked entities take part, entities without links
are their own root.

Minima are partially aggregated and links are relabelled with joins against
one row per entity, so a hub that a third of all links touch is no single task.

Roots (whole components) are dealt to splits: they are ordered by size band
(powers of two, largest first) and a hash of their name, numbered without a
global sort in one task (running numbers inside hash blocks, plus offsets of
blocks), and dealt systematically: number i goes to the last split whose
cumulative quota steps up at i. Every band thus gets each split's proportion
to within one root.

Cases: a record without one of its entities links nothing; without both it is
its own component; a record that is given twice is in the result twice, in one
component, and in conflicts once; self links are dropped; an
empty table gives no forest and no splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairlake.runtime import cut, fresh_path

BLOCKS = 1024


def _jumped(parent: DataFrame) -> DataFrame:
    """(node, root): every node's pointer followed to its end; parents are nodes of the table or roots."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = cut(parent.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("next"), (F.col("above") != F.col("parent")).alias("moved")))
        moving = step.where("moved").limit(1).count()
        parent = step.select("node", F.col("next").alias("parent"))
        if not moving:
            return parent.select("node", F.col("parent").alias("root"))


def spanning_forest(links: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(forest, roots) of links (link_id, a, b): forest (link_id, a, b, round) as written, roots (node, root).

    The root of a component is one of its nodes. Nodes without links aren't in ``roots``.
    """
    spark = links.sparkSession
    path = path or fresh_path(spark, "forest")
    live = links.where("a is not null and b is not null and a <> b and link_id is not null")
    live = cut(live.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("link_id").alias("link_id")).withColumns({"u": F.col("a"), "v": F.col("b")}))
    roots = None
    turn = 0
    while True:
        picks = (
            live.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other")))).alias("x"), "link_id", "a", "b")
            .groupBy("x.node")
            .agg(F.min(F.struct("link_id", "x.other", "a", "b")).alias("m"))
            .select("node", "m.*")
        )
        picks = cut(picks)
        picks.select("link_id", "a", "b", F.lit(turn).alias("round")).distinct().write.mode("append").parquet(path)
        if picks.isEmpty():
            break
        back = picks.select(F.col("node").alias("other"), F.col("other").alias("back"))
        parent = picks.join(back, "other", "left").select(
            "node", F.when((F.col("back") == F.col("node")) & (F.col("node") < F.col("other")), F.col("node")).otherwise(F.col("other")).alias("parent")
        )
        jumped = _jumped(parent)
        if roots is None:
            roots = jumped
        else:
            up = jumped.select(F.col("node").alias("root"), F.col("root").alias("above"))
            roots = cut(roots.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")))
        ru, rv = jumped.select(F.col("node").alias("u"), F.col("root").alias("ru")), jumped.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        live = live.join(ru, "u", "left").join(rv, "v", "left").select("a", "b", "link_id", F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")).where("u <> v")
        live = cut(live.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.min(F.struct("link_id", "a", "b")).alias("m")).select("u", "v", "m.*"))
        turn += 1
        if live.isEmpty():
            break
    forest = spark.read.schema("link_id long, a string, b string, round int").parquet(path)
    if roots is None:
        roots = spark.createDataFrame([], "node string, root string")
    return forest, roots


def components(records: DataFrame, keep: list[str] | None = None, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """((record_id, root, kept columns), forest) of records (record_id, a, b, ...): a and b name the entities they link."""
    records = records.where("record_id is not null").select("record_id", "a", "b", *[F.col(c).alias(f"own_{c}") for c in keep or []])
    own = F.concat(F.lit("record:"), F.col("record_id").cast("string"))
    named = records.withColumn("entity", F.coalesce("a", "b", own))
    forest, roots = spanning_forest(records.select(F.col("record_id").alias("link_id"), "a", "b"), path)
    rooted = named.join(roots.withColumnRenamed("node", "entity"), "entity", "left").withColumn("root", F.coalesce("root", "entity")).drop("entity")
    return rooted.select("record_id", "root", *[F.col(f"own_{c}").alias(c) for c in keep or []]), forest


def conflicts(rooted: DataFrame, flag: str) -> DataFrame:
    """(pair_id_a, pair_id_b), a < b: records of one component of which one has the flag true, the other false."""
    flagged = rooted.where(F.col(flag).isNotNull()).select("root", "record_id", F.col(flag).alias("flag"))
    both = flagged.groupBy("root").agg(F.min("flag").alias("low"), F.max("flag").alias("high")).where("not low and high").select("root")
    divided = flagged.join(both, "root", "left_semi")
    yes, no = divided.where("flag").select("root", F.col("record_id").alias("x")), divided.where("not flag").select("root", F.col("record_id").alias("y"))
    return yes.join(no, "root").select(F.least("x", "y").alias("pair_id_a"), F.greatest("x", "y").alias("pair_id_b")).distinct()


def deal(sizes: DataFrame, permille: list[tuple[str, int]], seed: str = "42") -> DataFrame:
    """(root, n, split): roots dealt systematically, size band by size band, in the given proportions."""
    keyed = sizes.select("root", "n").withColumn("band", -F.floor(F.log2(F.col("n").cast("double")))).withColumn("h", F.xxhash64(F.lit(seed), "root"))
    keyed = keyed.withColumn("block", F.pmod("h", F.lit(BLOCKS)))
    counts = keyed.groupBy("band", "block").agg(F.count(F.lit(1)).alias("c"))
    # at most bands x BLOCKS rows, some ten thousand
    before = counts.withColumn("before", F.sum("c").over(Window.orderBy("band", "block")) - F.col("c")).drop("c")
    inner = keyed.withColumn("i", F.row_number().over(Window.partitionBy("band", "block").orderBy("h", "root")))
    i = F.col("before") + F.col("i")
    return inner.join(F.broadcast(before), ["band", "block"]).select("root", "n", _nested(i, permille).alias("split"))


def _nested(i, permille: list[tuple[str, int]]):
    """The split of number i: cumulative quotas from the last split on step up at i, the first to do so takes it."""
    out, upto, steps = F.lit(permille[0][0]), 0, []
    for name, p in reversed(permille[1:]):
        upto += p
        steps.append((name, upto))
    for name, q in reversed(steps):
        out = F.when(F.floor(i * q / 1000) > F.floor((i - 1) * q / 1000), F.lit(name)).otherwise(out)
    return out
