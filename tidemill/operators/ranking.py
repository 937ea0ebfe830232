"""The greatest rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sums of the same terms in another order differ in their last bits. Scores are compared at this
# many significant digits, whatever their size, so that equal scores stay ties; ties go by item.
SCORE_DIGITS = 12


def top_per_key(
    df: DataFrame, key: str, score: str, tie: str, n: int, digits: int | None = SCORE_DIGITS
) -> DataFrame:
    """The ``n`` rows with the greatest ``score`` per key, with their ``rank`` from 1.

    Spark cuts each key to ``n`` rows in every task before the shuffle, so a hot key arrives as
    ``n`` rows per task.
    """
    by = F.col(score)
    if digits is not None:
        by = F.format_string(f"%.{digits - 1}e", by).try_cast("double")
    order = Window.partitionBy(key).orderBy(by.desc(), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
