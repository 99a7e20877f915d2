"""Per-card transaction sequences: ``lag`` columns without one task per card.

A plain ``Window.partitionBy('card_num')`` puts every transaction of a card
into one task; a card holding a third of the data would stall the job, and no
time slot helps when its rows lie in one hour.  Here the rows are range
partitioned on the whole sort order (card, time, tie-break), so a hot card
simply covers many partitions, all of one size.  A lag reaches back a fixed
number of rows, so a partition needs only the last few rows of the ones before
it: these tails, a few rows per partition, are handed on as context, and the
window runs per card *and* partition.  The lags are exact, whatever the skew,
without a count, a threshold or a time limit on the lookback.

The ranges are drawn from a sample, so the sorted rows are written once to the
shared folder before anything depends on where they fell.  Keep ``df`` narrow:
it crosses two exchanges.

Where the longest sequence fits a task with ease, as one count per key says,
the plain window needs one exchange and no file; the lags are the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.session import materialize


def longest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group of equal ``keys``."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def with_lags(
    df: DataFrame,
    lags: Mapping[str, Iterable[int]],
    partition_by: Sequence[str] = ("card_num",),
    ts_col: str = "transaction_date",
    tiebreak: str | Sequence[str] = "trans_id",
    partitions: int | None = None,
    short: bool = False,
) -> DataFrame:
    """Add ``<col>_lag<k>`` for each requested column and offset, over the
    rows of equal ``partition_by`` ordered by (``ts_col``, ``tiebreak``).
    ``short`` says that every sequence fits a task."""
    spark = df.sparkSession
    order = [ts_col, *([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    keys = [*partition_by, *order]

    def lag_columns(w) -> list:
        return [F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c, ks in lags.items() for k in ks]

    if short:
        return df.select("*", *lag_columns(Window.partitionBy(*partition_by).orderBy(*order)))
    depth = max((k for ks in lags.values() for k in ks), default=1)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id()), "sequence-rows")

    last = Window.partitionBy("_part").orderBy(*[F.desc(k) for k in keys])
    tails = materialize(
        placed.withColumn("_nth", F.row_number().over(last)).where(F.col("_nth") <= depth).drop("_nth"),
        "sequence-tails")
    # Partitions that hold rows, in order: one number per partition.
    parts = sorted(r[0] for r in tails.select("_part").distinct().collect())
    handed = [(p, q) for i, p in enumerate(parts) for q in parts[i + 1:i + 1 + depth]]
    after = F.broadcast(spark.createDataFrame(handed, "_part int, _next int"))
    context = tails.join(after, "_part").drop("_part").withColumnRenamed("_next", "_part")

    rows = placed.withColumn("_own", F.lit(True)).unionByName(context.withColumn("_own", F.lit(False)))
    w = Window.partitionBy(*partition_by, "_part").orderBy(*order)
    return rows.select("*", *lag_columns(w)).where("_own").drop("_own", "_part")
