"""Category to number by frequency, and the number to a sparse vector, with no list of categories on the driver.

Categories are counted, put in order (most frequent first, then by name) over the cluster and numbered by a running count, which
splits into ranges when there are many. The table of categories is joined to the rows; categories that hold very many rows are few
and are joined apart, by broadcast, so no task receives all rows of one category.
"""

from __future__ import annotations

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankops.operators.heavy import join_split
from bankops.operators.skew import fits_one_task, hot_limit, running
from bankops.session import stored


def frequency_index(df: DataFrame, col: str, index: str = "idx", hot_rows: int | None = None) -> DataFrame:
    """(col, index): 0.0 for the most frequent category, ties by the category's own order; null is no category."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    counts = stored(counts)  # numbered in ranges, whose bounds must see the same rows twice
    numbered = running(counts, [], [F.col("_n").desc(), F.col(col)], {"_at": ("count", F.lit(1))}, hot_rows)
    return numbered.select(col, (F.col("_at") - 1).cast("double").alias(index))


def one_hot_table(index: DataFrame, col: str, idx: str = "idx", vector: str = "vec", drop_last: bool = True) -> DataFrame:
    """The index table with a sparse vector for each category: a one at its number; with ``drop_last`` the last one has none.

    Vectors are made once for each category, not for each row.
    """
    size = index.count()
    slots = max(size - 1, 0) if drop_last else size

    @F.udf(VectorUDT())
    def spike(at):
        return SparseVector(slots, [int(at)], [1.0]) if at < slots else SparseVector(slots, [], [])

    return index.withColumn(vector, spike(F.col(idx)))


def join_categories(df: DataFrame, table: DataFrame, col: str, hot_rows: int | None = None) -> DataFrame:
    """The rows with the table's other columns; a category that the table does not know, or null, gets nulls.

    Frequent categories do not gather in one task, see ``join_split``.
    """
    limit = hot_limit(df, hot_rows)
    return join_split(df, table, [col], limit, fits_one_task(df, limit))
