"""Integrity reports replacing database constraints."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """Child keys with no parent row (a foreign key that would fail): one
    row per orphan key with its row count and date range.

    The child is summarised per key first (partial aggregation on the map
    side, so a key holding a large share of the rows never travels as rows);
    only the per-key summary meets the parent's distinct keys."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return per_key.join(parent.select(key).distinct(), key, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row (a primary key that would fail)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > F.lit(1)))


class Checked(NamedTuple):
    good: DataFrame
    rejects: DataFrame


def split_rejects(batch: DataFrame, parent: DataFrame, keys: list[str], foreign: str, seq: str) -> Checked:
    """A batch in front of its load: ``good`` rows, and ``rejects`` with the
    ``reason`` a database would have given: ``null key``, ``orphan`` (no row
    in ``parent``), ``duplicate`` (a row of that key arrived before, by ``seq``).

    The parent's keys are met by a left join with one row a key, which the
    engine broadcasts or filters by at run time by measured size; a hot key
    adds rows to its partition only until adaptive execution splits it.  Rows
    of one key are numbered after the orphans are marked, so an orphan is
    reported once, as such."""
    known = parent.select(F.col(foreign).alias("_known")).where("_known IS NOT NULL").distinct()
    null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    marked = batch.join(known, batch[foreign] == known["_known"], "left").withColumn(
        "reason", F.when(null_key, "null key").when(F.col("_known").isNull(), "orphan")).drop("_known")
    rest = [F.col(c).asc_nulls_first() for c in batch.columns if c not in keys and c != seq]
    place = F.row_number().over(Window.partitionBy(*keys, "reason").orderBy(F.col(seq).asc(), *rest))
    marked = marked.withColumn("_place", place).withColumn(
        "reason", F.when(F.col("reason").isNull() & (F.col("_place") > 1), "duplicate").otherwise(F.col("reason"))).drop("_place")
    return Checked(marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL"))
