"""One output per key value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.operators.joins import _spread


def export_by_key(
    df: DataFrame, path: str, key: str, score: str, run_date: str, then: Sequence[str] = ()
) -> None:
    """Write ``path/run_date=YYYYMMDD/<key>=<value>/part-*.csv`` with rows by numeric score, highest first.

    The frame is cut into ranges of (key, score), so a hot key is written by several tasks; its files in name order
    are in score order; rows of equal score by the columns ``then``, otherwise in any order. Rows without a key go to the folder that Hive layouts keep for null.
    """
    by = [F.col("_key").asc(), F.col("_by").desc_nulls_last(), *[F.col(c).asc() for c in then], F.col("_tie").asc()]
    number = F.col(score).try_cast("double")
    ordered = (
        df.withColumn("_tie", _spread(df))
        .withColumns({"_key": F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(NULL_FOLDER)), "_by": number})
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(F.col("_key").alias("_folder"), *df.columns)
    )
    keyed = ordered.drop(key).withColumnRenamed("_folder", key)
    keyed.write.mode("overwrite").partitionBy(key).csv(f"{path}/run_date={run_date}", header=True)


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
