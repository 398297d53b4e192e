"""Queries of the training-data operators over the project's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlake.llm import calibrated_sample, canonical_match, contributor_caps, entity_split, history_dedup, leakage, packing, percentiles, reading_level, score_cutoff
from pairlake.llm.pictures import usable, with_site
from pairlake.runtime import bounded, cut, table, written

FIELDS = {"treatment_category": "category", "treatment_brand": "brand"}
SAMPLE = 120
POINTS = [0.05, 0.25, 0.5, 0.75, 0.95]
GRID = {"blur_score": 0.01, "lighting_uniformity": 0.0001, "mean_brightness": 0.01}
PROPORTIONS = [("train", 800), ("validation", 100), ("test", 100)]


def _sited_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs as delivered with site, case and site ending of the before image."""
    pairs = table(spark, sf, "image_pair").select("id", "before_image_id", "pair_confidence")
    image = with_site(table(spark, sf, "image").select(F.col("id").alias("before_image_id"), "domain", "source_url"), "domain", "source_url", "site", "case_no").drop("domain", "source_url")
    return pairs.join(image, "before_image_id", "left")


# --- 1: caps per contributor


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "image_pair").select("id", "before_image_id", "pair_confidence")
    image = with_site(table(spark, sf, "image").select(F.col("id").alias("before_image_id"), "domain", "source_url"), "domain", "source_url", "site").drop("domain", "source_url")
    rows = cut(contributor_caps.ranked_records(pairs.join(image, "before_image_id", "left"), "id", F.col("pair_confidence"), {"site": F.col("site")}))
    kept = contributor_caps.nested_caps(rows, [("site", 1 / 50)])
    return rows.select("id").join(kept.select("id"), "id", "left_anti").select(F.col("id").alias("pair_id"))


def p1_nested_caps(spark: SparkSession, sf: str) -> DataFrame:
    """Kept pairs with at most 2 a case, a 50th of all pairs a site and a third a site ending."""
    levels = {"case": F.col("case_no"), "site": F.col("site"), "ending": F.regexp_extract("site", r"^[^.]+\.(.*)$", 1)}
    rows = cut(contributor_caps.ranked_records(_sited_pairs(spark, sf), "id", F.col("pair_confidence"), levels))
    kept = contributor_caps.nested_caps(rows, [("case", 2), ("site", 1 / 50), ("ending", 1 / 3)])
    return kept.select(F.col("id").alias("pair_id"), F.col("level_site").alias("site"), F.col("level_case").alias("case_no"))


# --- 2: splits that keep related records together


def _linked_pairs(spark: SparkSession, sf: str) -> DataFrame:
    image = with_site(table(spark, sf, "image").select("id", "domain", "source_url"), "domain", "source_url", "site", "case_no")
    image = image.select("id", F.concat_ws("|", "site", F.coalesce("case_no", F.concat(F.lit("image "), F.col("id").cast("string")))).alias("entity"))
    pairs = table(spark, sf, "image_pair").where("id is not null")
    one = pairs.groupBy(F.col("id").alias("record_id")).agg(F.max("before_image_id").alias("x"), F.max("after_image_id").alias("y"), F.max("in_training_set").alias("in_training_set"))
    b, a = image.select(F.col("id").alias("x"), F.col("entity").alias("a")), image.select(F.col("id").alias("y"), F.col("entity").alias("b"))
    return one.join(b, "x", "left").join(a, "y", "left").select("record_id", "a", "b", "in_training_set")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    rooted, _ = entity_split.components(cut(_linked_pairs(spark, sf)), ["in_training_set"])
    return entity_split.conflicts(rooted, "in_training_set")


def p2_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of cases by their smallest pair: number of pairs, of those with each flag, and whether the flag divides them."""
    rooted, _ = entity_split.components(cut(_linked_pairs(spark, sf)), ["in_training_set"])
    yes, no = F.count_if("in_training_set"), F.count_if(~F.col("in_training_set"))
    own = rooted.groupBy("root").agg(F.min("record_id").alias("class_id"), F.count(F.lit(1)).alias("n_pairs"), yes.alias("n_true"), no.alias("n_false"))
    return own.select("class_id", "n_pairs", "n_true", "n_false", ((F.col("n_true") > 0) & (F.col("n_false") > 0)).alias("divided"))


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs, groups and shares that each split got, its largest group, and the number of groups larger than the split's part."""
    splits = p2_splits(spark, sf)
    groups = splits.groupBy("split", "case_group").agg(F.count(F.lit(1)).alias("n"))
    parts = spark.createDataFrame(PROPORTIONS, "split string, permille int")
    total = groups.agg(F.sum("n").alias("total"))
    own = groups.join(F.broadcast(parts), "split").join(F.broadcast(total), F.lit(True))
    # a group that is larger than a split's part can't be in it without breaking its proportion
    return own.groupBy("split", "permille").agg(F.sum("n").alias("n_pairs"), F.count(F.lit(1)).alias("n_groups"), F.round(1000 * F.sum("n") / F.max("total"), 1).alias("got_permille"), F.max("n").alias("largest"), F.count_if(F.col("n") * 1000 > F.col("permille") * F.col("total")).alias("n_too_large"))


def p2_splits(spark: SparkSession, sf: str) -> DataFrame:
    rooted, _ = entity_split.components(cut(_linked_pairs(spark, sf)))
    rooted = cut(rooted.select("record_id", "root"))
    dealt = entity_split.deal(rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n")), PROPORTIONS)
    return rooted.join(dealt, "root").select(F.col("record_id").alias("pair_id"), F.col("root").alias("case_group"), "split")


# --- 3: batches against history


def _admitted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(repeats, links) of all incoming batches, admitted one after the other to the kept table of the queue's rows."""
    history = history_dedup.History.create(history_dedup.points(table(spark, sf, "staging_queue")))
    return history.admit_batches(history_dedup.points(table(spark, sf, "staging_incoming"), keep=["batch_no"]), "batch_no")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _admitted(spark, sf)[0]


def p3_near(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming rows beside which an accepted one has the neighbouring shot of one of the two pictures (one row per two pictures)."""
    return _admitted(spark, sf)[1].where("not same").select("id", F.col("known_id").alias("near_id"), "distance")


def p3_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Per batch of incoming rows how many are repeats and how many new."""
    found = p3_found(spark, sf)
    incoming = table(spark, sf, "staging_incoming").select(F.col("id").alias("dup_id"), "batch_no").distinct()
    return incoming.join(found, "dup_id", "left").groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_rows"), F.count("first_id").alias("n_repeats"))


# --- 4: typed values to a canonical list


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    return canonical_match.map_labels(table(spark, sf, "treatment_label"), table(spark, sf, "canonical_term"), FIELDS)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    terms = table(spark, sf, "canonical_term").select("kind", F.col("name").alias("value")).distinct()
    return _mapped(spark, sf).join(terms, ["kind", "value"], "left_anti").select("label_id", "field", "term_id")


def p4_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Values without an entry, with their number of labels."""
    return _mapped(spark, sf).where("term_id = 0").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def p4_within(spark: SparkSession, sf: str) -> DataFrame:
    """All entries within the limit of every distinct typed value."""
    values = canonical_match.long_values(table(spark, sf, "treatment_label"), FIELDS).select("kind", "value").distinct()
    return canonical_match.within(values, table(spark, sf, "canonical_term"))


# --- 5: cutoffs that keep a share


def _sourced_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(pair_id, source, score): distinct pairs with a usable score and the source they came from."""
    pairs = table(spark, sf, "image_pair").select(F.col("id").alias("pair_id"), "before_image_id", "after_image_id", usable(F.col("pair_confidence")).alias("score")).where("score is not null and pair_id is not null")
    # an address is replaced by 64 bits; a row is joined by both addresses, 128 bits
    image = table(spark, sf, "image").select("id", F.xxhash64("source_url").alias("h"))
    b, a = image.select(F.col("id").alias("before_image_id"), F.col("h").alias("hb")), image.select(F.col("id").alias("after_image_id"), F.col("h").alias("ha"))
    targets = table(spark, sf, "source_target").select(score_cutoff.tidy(F.col("source_name")).alias("key"), F.col("source_name").alias("source")).dropDuplicates(["key"])
    queue = table(spark, sf, "staging_queue").select(F.xxhash64("before_url").alias("hb"), F.xxhash64("after_url").alias("ha"), score_cutoff.tidy(F.col("source_name")).alias("key"))
    named = queue.join(F.broadcast(targets) if bounded(targets) else targets, "key").select("hb", "ha", "source")
    joined = pairs.join(b, "before_image_id").join(a, "after_image_id").select("pair_id", "hb", "ha", "score")
    return joined.join(named, ["hb", "ha"]).groupBy("pair_id").agg(F.min("source").alias("source"), F.min("score").alias("score"))


def _cutoffs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    scores = cut(_sourced_scores(spark, sf))
    targets = table(spark, sf, "source_target").select(F.col("source_name").alias("source"), "keep_percent")
    return scores, score_cutoff.cutoffs(scores, targets)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    scores, found = _cutoffs(spark, sf)
    return scores.join(found.select("source", "cutoff"), "source").where("score >= cutoff").select("pair_id")


def p5_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    _, found = _cutoffs(spark, sf)
    return found.select(F.col("source").alias("source_name"), "keep_percent", F.col("n").alias("n_usable"), "cutoff", F.col("kept").alias("n_kept"))


# --- 6: samples with target proportions


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sample_target").select(F.col("treatment_category").alias("category"), F.col("target_permille").alias("permille"), F.col("min_count").alias("floor"))


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    report = table(spark, sf, "balance_report").where("report_id is not null")
    latest = report.groupBy(F.col("report_id").alias("population"), F.col("treatment_category").alias("category")).agg(F.max(F.struct("reported_at", "pair_count")).alias("m"))
    return calibrated_sample.plan(latest.select("population", "category", F.coalesce("m.pair_count", F.lit(0)).alias("available")), _targets(spark, sf), SAMPLE)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).where("gap").select(F.col("population").alias("report_id"), F.col("category").alias("treatment_category"))


def _drawn(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(sample, calibrated cells): labels mapped to their entry, by category and the labels' source as second margin."""
    names = table(spark, sf, "canonical_term").where("kind = 'category'").select("term_id", F.col("name").alias("category"))
    mapped = _mapped(spark, sf).where("field = 'treatment_category' and term_id > 0").join(names, "term_id").select("label_id", "category")
    labels = table(spark, sf, "treatment_label").select(F.col("id").alias("label_id"), "pair_id", "source").distinct().join(mapped, "label_id").groupBy("pair_id").agg(F.min(F.struct("category", F.col("source").alias("stratum"))).alias("m")).select("pair_id", "m.*")
    # a report's range of pairs is cut into blocks, so that labels find it by an equal key
    width = 512
    ranges = table(spark, sf, "balance_report").groupBy("report_id").agg(F.max("first_pair_id").alias("lo"), F.max("last_pair_id").alias("hi"))
    ranges = ranges.withColumn("b", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    inside = labels.withColumn("b", F.floor(F.col("pair_id") / width)).join(ranges, "b").where("pair_id between lo and hi")
    records = cut(inside.select(F.col("report_id").alias("population"), "category", "stratum", F.col("pair_id").alias("record_id")))
    cells = cut(calibrated_sample.calibrated(records.groupBy("population", "category", "stratum").agg(F.count_distinct("record_id").alias("available")), _targets(spark, sf), SAMPLE))
    return calibrated_sample.draw(records, cells), cells


def p6_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs drawn for each report."""
    drawn, _ = _drawn(spark, sf)
    return drawn.select(F.col("population").alias("report_id"), F.col("category").alias("treatment_category"), F.col("record_id").alias("pair_id"))


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """What was required, aimed at and drawn per report and category."""
    drawn, cells = _drawn(spark, sf)
    aimed = cells.groupBy("population", "category").agg(F.sum("available").alias("available"), F.max("required").alias("required"), F.round(F.max("goal"), 6).alias("goal"), F.max("gap").alias("gap"))
    got = drawn.groupBy("population", "category").agg(F.count(F.lit(1)).alias("n_drawn"))
    return aimed.join(got, ["population", "category"], "left").select(F.col("population").alias("report_id"), F.col("category").alias("treatment_category"), "available", "required", "goal", F.coalesce("n_drawn", F.lit(0)).alias("n_drawn"), "gap")


# --- 7: percentiles


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """(site, grade, day, measures): every score counts once, unreadable pictures don't; values that aren't usable are null."""
    scored = table(spark, sf, "quality_result").select("id", "image_id", "grade", F.to_date("scored_at").alias("day"), "width", "height", *GRID)
    own = scored.where("id is not null and not (coalesce(width, 1) = 0 or coalesce(height, 1) = 0)").drop("width", "height")
    image = with_site(table(spark, sf, "image").select(F.col("id").alias("image_id"), "domain", "source_url"), "domain", "source_url", "site").drop("domain", "source_url")
    v = [F.when(percentiles.finite(F.col(m)) >= 0, percentiles.on_grid(percentiles.finite(F.col(m)), s)).alias(m) for m, s in GRID.items()]
    return own.join(image, "image_id", "left").dropDuplicates(["image_id", "id"]).select("site", "grade", "day", *v)


def _long(scored: DataFrame, *columns) -> DataFrame:
    """(columns, measure, v), usable values only."""
    values = F.map_from_arrays(F.array(*[F.lit(m) for m in GRID]), F.array(*GRID))
    return scored.select(*columns, F.explode(values).alias("measure", "v")).where("v is not null")


def p7_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counts that combine: of site, grade, day and measure."""
    return percentiles.value_counts(_long(_scored(spark, sf), "site", "grade", "day"), ["site", "grade", "day", "measure"], "v")


def p7_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles by site, by grade and by day."""
    scored = written(_scored(spark, sf), "scored")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in ("site", "grade", "day")])
    number = F.xxhash64("g.kind", F.col("g.key").isNull(), "g.key", "measure").alias("group_no")
    # values are counted under the number of their group; what a number stands for is a short table of its own
    names = scored.select(F.explode(kinds).alias("g")).distinct().select("g", F.explode(F.array(*[F.lit(m) for m in GRID])).alias("measure")).select(number, "g.kind", F.col("g.key").alias("group_key"), "measure")
    each = _long(scored, kinds.alias("gs")).select(F.explode("gs").alias("g"), "measure", "v").select(number, "v")
    out = percentiles.percentiles(written(percentiles.value_counts(each, ["group_no"], "v"), "counts"), ["group_no"], POINTS)
    return out.join(names, "group_no").select("kind", "group_key", "measure", "p", F.round("value", 4).alias("value"), "n")


# --- 8: packing


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    return cut(packing.token_counts(table(spark, sf, "documents"), spark.conf.get("pairlake.tokenizer", packing.TOKENIZER)))


def p8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_sizes(spark, sf))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Number of containers, the least number that could hold the tokens, and the share of their room that is used."""
    own = p8_packing(spark, sf).groupBy("container").agg(F.sum("size").alias("used"))
    n, used = F.count(F.lit(1)), F.sum("used")
    return own.agg(n.alias("n_containers"), used.alias("n_tokens"), F.ceil(used / packing.CAPACITY).alias("n_least"), F.round(used / (n * packing.CAPACITY), 4).alias("fill"))


def p8_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Per document whether its pieces are all its tokens, each once, undivided if they fit, in containers that aren't overfull."""
    sizes = _sizes(spark, sf)
    packed = cut(packing.pack(sizes))
    full = packed.groupBy("container").agg(F.sum("size").alias("used"))
    ends = packed.join(full, "container").groupBy("doc_id").agg(F.sum("size").alias("got"), F.max(F.col("start") + F.col("size")).alias("end"), F.count(F.lit(1)).alias("pieces"), F.max("used").alias("used"))
    whole = (F.col("got") == F.col("n_tokens")) & (F.col("end") == F.col("n_tokens")) & (F.col("pieces") == F.ceil(F.col("n_tokens") / packing.CAPACITY))
    return sizes.select("doc_id", "n_tokens").join(ends, "doc_id", "left").select("doc_id", F.coalesce(whole, F.lit(False)).alias("whole"), F.coalesce(F.col("used") <= packing.CAPACITY, F.lit(False)).alias("fits"))


# --- 9: leaked evaluation texts


def p9_leaks(spark: SparkSession, sf: str) -> DataFrame:
    found = leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_item"))
    return found.select("doc_id", "item_id", F.round("coverage", 4).alias("coverage"), F.round("tiled", 4).alias("tiled"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    found = leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_item"))
    return found.where(F.col("coverage") >= leakage.SHARE).select("doc_id", "item_id")


# --- 10: reading level


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    documents, ratings = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "level_sample")
    models = reading_level.train(documents, ratings)
    # rated documents are left out after their level is known: ids are shuffled, texts are not
    return reading_level.levels(documents, models).join(ratings.select("doc_id").distinct(), "doc_id", "left_anti")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).select("doc_id", "reading_level").distinct()


def p10_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and characters per source and level."""
    info = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return _levels(spark, sf).join(info, "doc_id").groupBy("source", "reading_level").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.round(F.avg("certainty"), 4).alias("certainty"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        p1_found, p1_nested_caps, p2_found, p2_groups, p2_splits, p2_report, p3_found, p3_near, p3_batches, p4_found, p4_unmatched, p4_within, p5_found, p5_cutoffs, p6_found, p6_sample, p6_report,
        p7_percentiles, p7_counts, p8_packing, p8_fill, p8_checked, p9_found, p9_leaks, p10_found, p10_profile,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from pairlake.llm.sql import SQL

    return dict(SQL)
