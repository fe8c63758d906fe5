"""What the operators of this subpackage share: reading, shared storage, hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a folder of the system's temporary ones serves a local master, whose driver and executors are one
    process; any other master is an error, because its executors would not see each other's files."""
    set_to = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that the driver and all executors share")
        set_to = tempfile.mkdtemp(prefix="spark-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage, and survives the loss of executors."""
    spark = df.sparkSession
    df.write.parquet(path := new_path(spark, name))
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what stored() wrote for these tables; nothing may read them any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until df has no column of that name."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        out.append(n)
    return out


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is 0 modulo 5; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def rows(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds at most about `most` bytes, or one row."""
    for b in batches:
        n = max(1, -(-b.nbytes // most))
        step = max(1, -(-b.num_rows // n))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products of hashes spread over all bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x
