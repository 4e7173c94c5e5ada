"""Trend results as CSV folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from burstline.schemas import STORED_TRENDS

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def write_trends(df: DataFrame, path: str, header: bool = False) -> None:
    """Overwrite a CSV folder, one file per partition, without header by default."""
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def read_trends(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Read all part files of a result folder back under its column names."""
    return (
        spark.read.schema(STORED_TRENDS)
        .option("header", header)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
