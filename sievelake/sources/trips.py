"""Raw trips."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Parquet file or directory of one batch, with the schema it was written with."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such input: {path}") from error
        raise
