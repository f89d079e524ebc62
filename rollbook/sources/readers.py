"""Readers with explicit schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.sources.buckets import settings


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    """What `read` gives; an empty table with the schema where the path is absent."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file holding one JSON array of records. Such a file cannot be split, so stored
    terms should be JSON lines or Parquet; this reads what other tools wrote."""
    return _or_empty(
        spark, schema, lambda: spark.read.schema(schema).option("multiLine", True).json(path)
    )


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and line breaks inside quoted cells."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).options(**options).csv(path))


def term_files(
    spark: SparkSession, folder: str, schema: T.StructType, array_files: bool = False
) -> DataFrame:
    """All `<term>.json` files of a folder as one table with a `term` column."""
    read = json_records if array_files else json_lines
    df = read(spark, f"{folder.rstrip('/')}/*.json", schema)
    if not df.inputFiles():
        return df.withColumn("term", F.lit(None).cast("string"))
    return df.withColumn("term", F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1))


def term_partitions(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Stored terms as partitions `term=.../`; filters on `term` prune folders."""
    full = T.StructType([*schema.fields, T.StructField("term", T.StringType())])
    return _or_empty(spark, full, lambda: spark.read.schema(full).json(folder))


RAW_PAGE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("term", "department_code", "class_id")]
    + [T.StructField("ts", T.TimestampType()), T.StructField("raw_content", T.StringType())]
)


def _named(names: Sequence[str] | None) -> str:
    """A glob for one level of a tree: any of the names as they are, or all."""
    if names is None:
        return "*"
    plain = [re.sub(r"([\\*?\[\]{},])", r"\\\1", n) for n in names]
    return "{" + ",".join(plain) + "}"


def tree_settings(spark: SparkSession) -> dict[str, str]:
    """Options for trees of many small files in many folders.

    By its own options Spark lists each folder in a task of its own and counts a file as 4 MB when it
    deals files to tasks, which for pages costs far more than to list and read them.
    """
    return {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": str(256 << 10),
    }


def raw_pages(
    spark: SparkSession,
    folder: str,
    terms: Sequence[str] | None = None,
    departments: Sequence[str] | None = None,
) -> DataFrame:
    """`<term>/<department>[/<class>]/<time>.html` files: one row per page with its path parts.

    `terms` and `departments` are part of the path, so folders of others are not even listed; an
    absent folder is an empty table, and so is an empty file, which Spark never reads.  Spark plans the tasks by the sizes of the files.

    Times are `2020-07-10_18:35_UTC`, or `2020-07-10_18-35_UTC` on file systems (HDFS, a local
    disk with checksums) that refuse a colon in a name.
    """
    wanted = folder.rstrip("/")
    if terms is not None or departments is not None:
        wanted += f"/{_named(terms)}/{_named(departments)}"
    if terms == [] or departments == []:
        return spark.createDataFrame([], RAW_PAGE)
    try:
        with settings(spark, tree_settings(spark)):  # folders are listed here
            df = (
                spark.read.option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.html")
                .text(wanted, wholetext=True)
            )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_PAGE)
    path = F.url_decode("_metadata.file_path")
    tail = r"/([^/]+)/([^/]+)(?:/([^/]+))?/(\d{4}-\d{2}-\d{2}_\d{2}[:-]\d{2})_UTC\.html$"
    inside = F.regexp_replace(path, "^.*?" + _literal(folder), "")
    minute = F.regexp_replace(F.regexp_extract(inside, tail, 4), r"(\d{2})-(\d{2})$", r"$1:$2")
    return df.select(
        F.regexp_extract(inside, tail, 1).alias("term"),
        F.regexp_extract(inside, tail, 2).alias("department_code"),
        F.nullif(F.regexp_extract(inside, tail, 3), F.lit("")).alias("class_id"),
        F.try_to_timestamp(minute, F.lit("yyyy-MM-dd_HH:mm")).alias("ts"),
        F.col("value").alias("raw_content"),
    )


def _literal(folder: str) -> str:
    """Folder as a literal inside a Java regex."""
    return "\\Q" + folder.rstrip("/") + "\\E"


def search_payload(payload: Column) -> Column:
    """Search API answer -> array of struct(title, snippet)."""
    return F.from_json(payload, schemas.SEARCH_PAYLOAD)["query"]["search"]


def article_payload(payload: Column) -> Column:
    """Article API answer -> struct(title, extract) of its first page."""
    pages = F.from_json(payload, schemas.ARTICLE_PAYLOAD)["query"]["pages"]
    return F.get(F.map_values(pages), F.lit(0))
