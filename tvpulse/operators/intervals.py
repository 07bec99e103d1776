"""Fold overlapping or touching intervals per device, station, genre.

Definition (ordered by start, end, id within a group): a row opens a new
folded interval when no earlier row exists or its start is after the max end
of all earlier rows; touching intervals (end == next start) merge.

A plain window over the whole group would sort a hot device in one task, so
the running quantities are computed as a two-level prefix instead:

1. rows are cut into hour chunks of their start; per (group, chunk) the max
   end is aggregated and a window over the chunk rows of each group (at most
   24 per day) gives the carry-in max of all earlier chunks;
2. inside each (group, chunk) the ordered window adds the local running max,
   which decides the open flag of every row;
3. the latest opening start at or before each row (the folded interval's id)
   is again local running max plus a chunk carry of earlier chunks;
4. a grouped aggregate on (group, fold start) yields start, end, SOURCE_ROWS.

Rows sharing a start are combined first (map-side), so every window is
bounded by the distinct starts of one hour of one group, or by the chunk
count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.functions.joins import join_null_safe
from tvpulse.functions.time import micros_between

FOLD_KEYS = ("DEVICE_ID", "NETWORK_ID", "GENRE")
_HOUR_MICROS = 3_600_000_000


def _hour_chunk(ts: str):
    return F.floor(micros_between(F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(ts)) / F.lit(_HOUR_MICROS))


def fold_intervals(df: DataFrame, keys=FOLD_KEYS, start: str = "VIEW_FROM", end: str = "VIEW_TO") -> DataFrame:
    """Folded intervals (keys, start, end, SOURCE_ROWS).

    Rows of a group with the same start are interchangeable for the fold (the
    first may open a new interval, the others cannot), so they are first
    combined map-side into one row with the latest end and their row count:
    exact copies or bursts sharing a start never pile up in one window. NULL
    keys form groups of their own."""
    keys = list(keys)
    ck = keys + ["_chunk"]
    rows = (df.groupBy(*keys, start).agg(F.max(end).alias(end), F.count(F.lit(1)).alias("_w"))
            .withColumn("_chunk", _hour_chunk(start)))
    earlier_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    # 1. carry-in of max end from earlier chunks
    chunk_max = (rows.groupBy(*ck).agg(F.max(end).alias("_cmax"))
                 .select(*ck, F.max("_cmax").over(earlier_chunks).alias("_carry_end")))
    rows = join_null_safe(rows, chunk_max, ck)

    # 2. open flag from carry + local running max (starts are unique per group now)
    local = Window.partitionBy(*ck).orderBy(start)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    prev_end = F.greatest(F.col("_carry_end"), F.max(end).over(before))
    rows = rows.withColumn("_opens", prev_end.isNull() | (F.col(start) > prev_end))
    rows = rows.withColumn("_local_open", F.max(F.when(F.col("_opens"), F.col(start))).over(upto))

    # 3. fold id = latest opening start, carrying across chunks
    chunk_open = (rows.groupBy(*ck).agg(F.max("_local_open").alias("_copen"))
                  .select(*ck, F.max("_copen").over(earlier_chunks).alias("_carry_open")))
    rows = join_null_safe(rows, chunk_open, ck).withColumn(
        "_fold", F.coalesce(F.col("_local_open"), F.col("_carry_open")))

    # 4. one row per folded interval
    return (rows.groupBy(*keys, "_fold")
            .agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("_w").alias("SOURCE_ROWS"))
            .select(*keys, start, end, "SOURCE_ROWS"))


def fold_totals(folded: DataFrame) -> DataFrame:
    """INPUT_ROWS and FOLDED_ROWS of a folded result, as one aggregate row."""
    return folded.agg(F.sum("SOURCE_ROWS").alias("INPUT_ROWS"), F.count(F.lit(1)).alias("FOLDED_ROWS"))


def fold_with_totals(folded: DataFrame, folder: str) -> DataFrame:
    """Every folded row with the INPUT_ROWS and FOLDED_ROWS of the whole.

    The fold is written once to ``folder``; its one-row totals then stand
    beside each stored row as literals, so no window holds all rows in one task."""
    folded.write.parquet(folder)
    stored = folded.sparkSession.read.schema(folded.schema).parquet(folder)
    totals = fold_totals(stored).first()
    return stored.select("*", F.coalesce(F.lit(totals["INPUT_ROWS"]), F.lit(0)).cast("bigint").alias("INPUT_ROWS"),
                         F.lit(totals["FOLDED_ROWS"]).cast("bigint").alias("FOLDED_ROWS"))
