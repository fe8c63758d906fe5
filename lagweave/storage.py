"""Tables that are used more than once: written to the shared folder, read from there."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[tuple, DataFrame] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a temporary folder serves a local master, whose executors are the driver's own process; any other master is an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    df.write.parquet(path := f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return spark.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, name: str, *key, make: Callable[[], DataFrame]) -> DataFrame:
    """What make() gives, stored at the first call of this Spark application for the same name and key (the inputs' folder and all parameters).

    Inputs must not change while the application runs, as with any plan that reads a table twice."""
    whole = (spark.sparkContext.applicationId, name, *key)
    if whole not in _MADE:
        _MADE[whole] = stored(make(), name)
    return _MADE[whole]
