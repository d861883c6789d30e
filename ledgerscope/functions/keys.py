"""Dense, stable surrogate keys (SERIAL / BIGSERIAL) without a global
single-partition window.

``row_number() OVER (ORDER BY key)`` would pull every row into one task.
Instead the rows are range-partitioned on the key and sorted inside each
partition; a row's id is ``start + (rows in earlier partitions) + (its
position in its partition)``. The per-partition counts form a table with one
row per partition (a proven size bound), so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def dense_surrogate_key(
    df: DataFrame,
    order_cols: list[str],
    id_col: str,
    start=1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... following ``order_cols``.

    ``order_cols`` must be unique per row (ties would be numbered in an
    arbitrary order). ``start`` may be an int or a one-row DataFrame column
    expression already resolved to an int by the caller.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Freeze partition membership and positions; also cuts the lineage so a
    # lost executor re-reads the checkpoint instead of re-sampling ranges.
    ranged = reliable_checkpoint(ranged)
    ranged = ranged.withColumn("_part", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    )
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the running sum is over at most n rows.
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"),
    )
    out = ranged.join(F.broadcast(offsets), "_part").withColumn(
        id_col, (F.lit(start) + F.col("_off") + F.col("_pos")).cast("long")
    )
    return out.drop("_mid", "_part", "_pos", "_off")
