"""Writers. Every writer stays partitioned; none gathers a table into one file."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import flatten_join, join_pairs
from rollbook.operators.ordered import fingerprint, join_null_safe
from rollbook.sources import readers
from rollbook.sources.buckets import settings
from rollbook.sources.scratch import stored

# Person columns that only the JSON copy keeps.
JSON_ONLY = ("reviews", "gscholar")


def json_by_term(
    df: DataFrame,
    path: str,
    term: str = "term",
    mode: str = "overwrite",
    rebalance: bool = True,
    compression: str = "gzip",
) -> None:
    """JSON lines in one folder per term, compressed unless `compression` is "none".

    A compressed file is read by one task; rebalanced files are small enough for that.

    Rows are rebalanced by term first, so a term gets files of a sensible size, and a large
    term several tasks, instead of one file per task and term. Pass `rebalance=False` to
    keep the order of rows that are sorted already.
    """
    out = df.hint("rebalance", term) if rebalance else df
    out.write.mode(mode).partitionBy(term).option("compression", compression).json(path)


def flat_columns(df: DataFrame, json_only: Sequence[str] = JSON_ONLY) -> DataFrame:
    """List columns as sorted newline-joined text, struct lists as lines; for CSV."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "array<string>":
            out[name] = flatten_join(F.col(name))
        elif kind == "array<array<string>>":
            out[name] = flatten_join(F.col(name), nested=True)
        elif kind.startswith("array<struct<"):
            fields = df.schema[name].dataType.elementType.names
            out[name] = join_pairs(F.col(name), fields)
    return df.drop(*json_only).withColumns({c: e for c, e in out.items() if c not in json_only})


def csv_flat(df: DataFrame, path: str, json_only: Sequence[str] = JSON_ONLY) -> None:
    options = {"header": True, "quote": '"', "escape": '"', "quoteAll": True}
    flat_columns(df, json_only).write.mode("overwrite").options(**options).csv(path)


def jsonl_append(df: DataFrame, path: str) -> None:
    """Add one line per row to a log folder."""
    df.write.mode("append").json(path)


def raw_snapshots(
    pages: DataFrame, stored_last: DataFrame | None, path: str, keys: Sequence[str]
) -> DataFrame:
    """Append the pages whose content differs from the last stored version of their key.

    `stored_last` has the keys and `digest`; it holds digests only, never page bodies.
    Returns what was written.
    """
    new = pages.withColumn("digest", fingerprint(F.col("raw_content")))
    if stored_last is not None:
        old = stored_last.select(*keys, F.col("digest").alias("_old"))
        new = join_null_safe(new, old, keys, "left")
        new = new.filter(~F.col("digest").eqNullSafe(F.col("_old"))).drop("_old")
    parts = [k for k in ("term", "department_code") if k in keys]
    new.write.mode("append").partitionBy(*parts).parquet(path)
    return new


def named_files(
    rows: DataFrame,
    folder: str,
    head: str = "",
    between: str = "",
    tail: str = "",
    by: Sequence[str] = (),
    pieces: int = 1,
) -> DataFrame:
    """Write (name, place, body) rows as one file per name below a folder, bodies in order of place.

    Spark's own writers choose their names; this is for trees whose names carry meaning.  A file is
    written by one task, batch after batch, under a name of its own and moved when complete, so a
    repeated task replaces the file and none is ever half there.  Returns (name, n_rows), stored.

    With `pieces` the rows are sorted in so many ranges of (name, the columns `by`, which the order
    of place begins with); each is written as parts of its files, and the task of a file only strings
    its parts together, so it sorts and holds nothing.
    """
    # a plain path or a URI of any file system Arrow knows; Hadoop writes file:/x for file:///x
    uri = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder
    parts = f".parts-{uuid.uuid4().hex}"

    def place_of(system: fs.FileSystem, base: str, name: str) -> str:
        """A new hidden file next to where the file of that name goes."""
        parent = f"{base}/{name}".rpartition("/")[0]
        system.create_dir(parent, recursive=True)
        return f"{parent}/.{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(uri)
        name, sink, n, hidden = None, None, 0, ""
        whole = pieces == 1
        at = TaskContext.get().partitionId()

        def done() -> pa.RecordBatch:
            if whole:
                sink.write(tail.encode())
            sink.close()
            if whole:
                system.move(hidden, f"{base}/{name}")
            return pa.RecordBatch.from_pylist([{"name": name, "n_rows": n, "at": at, "part": hidden}], PART)

        for batch in batches:
            for new, body in zip(batch.column(0), batch.column(1)):
                if sink is None or new.as_py() != name:
                    if sink is not None:
                        yield done()
                    name, n = new.as_py(), 0
                    hidden = place_of(system, base, name if whole else f"{parts}/part")
                    sink = system.open_output_stream(hidden, compression=None)
                    if whole:
                        sink.write(head.encode())
                elif between:
                    sink.write(between.encode())
                sink.write(body.as_py().encode())
                n += 1
        if sink is not None:
            yield done()

    def string_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(uri)
        listed = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for name, own in groupby(listed, key=lambda row: row[0]):
            hidden, n = place_of(system, base, name), 0
            with system.open_output_stream(hidden, compression=None) as sink:
                for k, (_, n_rows, part) in enumerate(own):
                    sink.write((between if k else head).encode())
                    with system.open_input_stream(part, compression=None) as source:
                        while block := source.read(1 << 20):
                            sink.write(block)
                    n += n_rows
                sink.write(tail.encode())
            system.move(hidden, f"{base}/{name}")
            yield pa.RecordBatch.from_pylist([{"name": name, "n_rows": n}], OUT)

    OUT = pa.schema([("name", pa.string()), ("n_rows", pa.int64())])
    PART = pa.schema([*OUT, ("at", pa.int64()), ("part", pa.string())])
    dealt = rows.repartition("name") if pieces == 1 else rows.repartitionByRange(pieces, "name", *by)
    bodies = dealt.sortWithinPartitions("name", "place").select("name", F.coalesce("body", F.lit("")).alias("body"))
    made = bodies.mapInArrow(write, "name string, n_rows bigint, at bigint, part string")
    if pieces == 1:
        return stored(made.select("name", "n_rows"), "written")
    made = stored(made, "parts")
    listed = made.repartition("name").sortWithinPartitions("name", "at").select("name", "n_rows", "part")
    out = stored(listed.mapInArrow(string_together, "name string, n_rows bigint"), "written")
    path = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{parts}")
    path.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out


ROWS_PER_PIECE = 400_000


def term_files(
    df: DataFrame, folder: str, term: str = "term", order: Sequence[str] = (), rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """`<term>.json` files that hold one JSON array of records each; `order` sorts the records.

    The format of other tools: a file cannot be split, so one task strings a term together from parts
    that were sorted and written in pieces of about `rows_per_piece` rows.  `json_by_term` is the
    form for terms of any size.  Null terms are left out.
    """
    record = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != term]))
    place = F.struct(*[F.col(c) for c in order], record.alias("record"))
    name = F.concat(F.col(term), F.lit(".json"))
    by = [F.col(c).alias(f"by{k}") for k, c in enumerate(order)]
    rows = df.select(name.alias("name"), place.alias("place"), record.alias("body"), *by).where("name IS NOT NULL")
    pieces = max(1, -(-df.count() // rows_per_piece))
    return named_files(rows, folder, "[\n", ",\n", "\n]\n", [f"by{k}" for k in range(len(by))], pieces)


def page_tree(pages: DataFrame, folder: str) -> DataFrame:
    """Store pages as `<term>/<department>[/<class>]/<time>.html`, as `readers.raw_pages` reads them.

    `pages`: term, department_code, class_id (null for listings), ts, raw_content.  A page whose
    text equals the last stored one of its folder is skipped, and so is a null or empty one, which
    could not be read back; of several with one name the greatest
    text stays.  Versions that come together are compared with the stored one only.  Returns
    (name, n_rows) of what was written.
    """
    keys = ["term", "department_code", "class_id"]
    new = pages.where("raw_content <> ''").groupBy(*keys, F.date_trunc("minute", "ts").alias("ts")).agg(
        F.max("raw_content").alias("raw_content")
    )
    old = readers.raw_pages(pages.sparkSession, folder).groupBy(*keys).agg(
        F.max_by(fingerprint(F.col("raw_content")), "ts").alias("_old")
    )
    new = join_null_safe(new, old, keys, "left")
    new = new.where(~fingerprint(F.col("raw_content")).eqNullSafe(F.col("_old")))
    time = F.concat(F.date_format("ts", "yyyy-MM-dd_HH-mm"), F.lit("_UTC.html"))
    name = F.concat_ws("/", *keys, time)
    rows = new.select(name.alias("name"), F.col("ts").alias("place"), F.col("raw_content").alias("body"))
    with settings(pages.sparkSession, readers.tree_settings(pages.sparkSession)):  # the stored pages are read here
        return named_files(rows, folder)
