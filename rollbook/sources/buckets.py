"""Stored tables whose rows lie where a join needs them.

A table is partitioned by term, and the rows of a term are dealt into a fixed number of buckets by
their keys.  A join on the keys then shuffles its other side only, into the buckets that exist: the
stored side, which holds all crawls so far, is read in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A join on (term, call number) may use rows that lie by call number alone.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC = "spark.sql.parquet.compression.codec"
MOST_TERMS = 1000


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Options of the session for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy(spark: SparkSession):
    """For the length of a block, the shuffle files of a job go when the job ends.

    Otherwise Spark keeps them until the driver collects its garbage, so those of all jobs add up.
    Tables written in the block are compressed with zstd, which makes them smaller.
    """
    return settings(spark, {SHUFFLE_CLEANUP: "true", CODEC: "zstd"})


class BucketedTable:
    """A table below `path`, one folder per term, `buckets` sorted files in it.

    The files are the table: a new session that names the same path, keys and number of buckets finds
    what an older one wrote.  Null keys have a bucket like any value; a null term is an error.
    Choose the number of buckets so that one bucket of the largest term fits a task, once and for all:
    it cannot change without rewriting the table.  A key held by very many rows is one bucket, so the
    keys should be near unique within a term, as call numbers are.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 8,
        term: str = "term",
    ):
        if term in keys or term not in schema.fieldNames():
            raise ValueError(f"{term} must be a column, and no key")
        self.spark, self.path, self.term = spark, path, term
        self.keys, self.buckets = list(keys), buckets
        self.columns = [*[c for c in schema.fieldNames() if c != term], term]
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
        self.name = f"bucketed_{uuid.uuid4().hex[:12]}"
        self.kinds = {c: schema[c].dataType.simpleString() for c in self.columns}
        kinds = ", ".join(f"`{c}` {kind}" for c, kind in self.kinds.items())
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(
            f"CREATE TABLE {self.name} ({kinds}) USING parquet PARTITIONED BY (`{term}`) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def terms(self, rows: DataFrame) -> list[str]:
        """The distinct terms of some rows: a few per crawl, and an error beyond MOST_TERMS."""
        found = rows.select(F.col(self.term).cast("string")).distinct().limit(MOST_TERMS + 1).collect()
        if len(found) > MOST_TERMS:
            raise ValueError(f"more than {MOST_TERMS} terms at once; merge them in several calls")
        if any(r[0] is None for r in found):
            raise ValueError(f"rows without a {self.term} belong to no folder")
        return sorted(r[0] for r in found)

    def of_terms(self, terms: Sequence[str]) -> DataFrame:
        """What is stored for these terms; other folders are not listed or read."""
        return self.read().where(F.col(self.term).isin(list(terms)))

    def replace_terms(self, rows: DataFrame, terms: Sequence[str]) -> None:
        """Make the rows all that is stored for `terms`, which they must belong to.

        Terms without rows become empty; other terms are not touched.  Rows must not be read from
        this table.  One file per term and bucket: a task holds one bucket, sorted by key.
        """
        dealt = rows.select(*self.columns).repartition(self.buckets, *self.keys)
        with tidy(self.spark):
            with settings(self.spark, {OVERWRITE: "dynamic"}):
                dealt.write.insertInto(self.name, overwrite=True)
            without = set(terms) - set(self.terms(rows))
        for term in without:
            literal = term.replace("\\", "\\\\").replace("'", "\\'")
            kinds = ", ".join(f"CAST(NULL AS {self.kinds[c]})" for c in self.columns if c != self.term)
            self.spark.sql(
                f"INSERT OVERWRITE {self.name} PARTITION (`{self.term}`='{literal}') "
                f"SELECT {kinds} FROM range(0)"
            )
        self.spark.catalog.refreshTable(self.name)

    def drop(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
