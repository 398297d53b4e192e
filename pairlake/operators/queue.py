"""The staging queue as an append-only log: what happened to a row is a row, its state is the last one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A failure's reason is kept up to so many characters.
REASON = 512


def event(rows: DataFrame, status: Column | str, number: Column, reason: Column | None = None) -> DataFrame:
    """(id, number, status, reason): one event for each of the rows; a later event has a larger number."""
    said = F.lit(None).cast("string") if reason is None else F.substring(reason, 1, REASON)
    return rows.select("id", number.cast("long").alias("number"), (F.lit(status) if isinstance(status, str) else status).alias("status"), said.alias("reason"))


def current(events: DataFrame) -> DataFrame:
    """(id, number, status, reason): the last event of each row; ``max_by`` with partial aggregation, no window."""
    last = F.max_by(F.struct("status", "reason"), F.struct("number", "status"))
    return events.groupBy("id").agg(F.max("number").alias("number"), last.alias("x")).select("id", "number", "x.*")


def dequeue(state: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(ids, events) of the ``most`` oldest pending rows: they are marked as being processed by appending the events."""
    taken = state.where("status = 'pending'").orderBy("id").limit(most)
    return taken.select("id"), event(taken, "processing", F.col("number") + 1)


def reset_stale(state: DataFrame) -> DataFrame:
    """Events that give rows left in processing back; their number is the number of rows reset."""
    return event(state.where("status = 'processing'"), "pending", F.col("number") + 1)


def labelled(metadata: str = "metadata", field: str = "treatment_category") -> Column:
    return F.coalesce(F.contains(F.col(metadata), F.lit(field)), F.lit(False))


def without_label(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows to delete as unlabelled, or the ``most`` first of them as a sample to look at."""
    bad = rows.where(~labelled())
    return bad if most is None else bad.orderBy("id").limit(most)
