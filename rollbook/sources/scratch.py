"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from rollbook.sources.buckets import tidy

CHECKPOINT_KEY = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder the session names.

    Executors on several machines share nothing else, so a session of a cluster without it gets an
    error; only a session that runs in this process gets a folder of this machine.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="rollbook-")
    return f"{base.rstrip('/')}/rollbook-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the scratch folder and read back.

    For a result that several branches use: it is computed once, survives lost executors,
    and its measured size lets Spark choose the later joins.
    """
    path = scratch_dir(df.sparkSession, name)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """`stored`, with one file per hash bucket of `key`: later joins on it do not move this side.

    There are as many buckets as a shuffle has partitions.
    """
    spark = df.sparkSession
    path, table = scratch_dir(spark, name), f"rollbook_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    read = spark.table(table)
    read.stored_at = path
    return read


def released(*tables: DataFrame) -> None:
    """Delete tables that `stored` returned, once nothing that will still run reads them."""
    for table in tables:
        delete(table.sparkSession, table.stored_at)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of any Hadoop file system; it may be gone already."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
