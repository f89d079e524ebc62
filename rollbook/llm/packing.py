"""Best-fit packing of token pieces by exact complements.

Pieces of one length are interchangeable, so the plan is made on the histogram of lengths, which
has `capacity` entries however many pieces there are.  The longest pieces come first: their gap is
looked up among single lengths, sums of two and sums of three, and each combination is used as
often as its lengths are available.  What finds no exact partner is packed best-fit.

Spark then gives every piece its number within its length (counts per stored partition and
length, summed up) and joins the numbers with the plan's ranges.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.sources.scratch import stored

# --- plan ---------------------------------------------------------------------------------------


class _Stock:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] += n
        self.patterns: list[tuple[tuple[int, ...], int]] = []

    def use(self, lengths: tuple[int, ...]) -> None:
        """Fill as many sequences with these lengths as there are pieces for."""
        need = Counter(lengths)
        times = int(min(self.left[x] // n for x, n in need.items()))
        if times > 0:
            for x, n in need.items():
                self.left[x] -= n * times
            self.patterns.append((lengths, times))

    def present(self, most: int) -> np.ndarray:
        """Lengths up to `most` that are left, the longest first."""
        return np.flatnonzero(self.left[: max(most, 0) + 1])[::-1]

    def pairs(self, total: int) -> list[tuple[int, int]]:
        """Available (a, b) with a + b == total and a >= b: each a looks up its complement."""
        a = self.present(total - 1)
        b = total - a
        ok = (b <= a) & (self.left[b] > 0) & ((a != b) | (self.left[a] > 1))
        return [(int(x), int(y)) for x, y in zip(a[ok], b[ok])]


def _complements(stock: _Stock, length: int, capacity: int, most: int) -> None:
    """Fill sequences that begin with `length` by exactly `most` pieces, while there are any."""
    gap = capacity - length
    if most == 1:
        if gap <= length:
            stock.use((length, gap))
    elif most == 2:
        for pair in stock.pairs(gap):
            stock.use((length, *pair))
            if not stock.left[length]:
                break
    else:
        for first in map(int, stock.present(gap - 2)):
            if not stock.left[length]:
                break
            if not stock.left[first]:
                continue
            for pair in stock.pairs(gap - first):
                stock.use((length, first, *pair))
                if not (stock.left[length] and stock.left[first]):
                    break


def _best_fit(stock: _Stock, capacity: int, only: int | None = None) -> None:
    """Fill sequences with the longest piece that still fits; with `only`, those it begins."""
    while len(rest := stock.present(capacity)) and (only is None or stock.left[only]):
        lengths, gap = [], capacity
        while gap and len(rest):
            x = int(rest[0])
            again = lengths.count(x) + 1
            if stock.left[x] < again:
                rest = rest[1:]
                continue
            lengths.append(x)
            gap -= x
            rest = rest[rest <= gap]
        stock.use(tuple(lengths))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences); uses every piece once.

    Exact complements are looked up in two orders: round by round (all single complements, then
    pairs, then triples), and length by length, where a length without complements is packed
    best-fit before shorter ones may spend the pieces that it needs.  Best fit alone is the third
    candidate, so the plan is never worse than that; the one with the fewest sequences is taken.
    Lengths of zero take no room and must not be among the counts.
    """

    def full() -> _Stock:
        stock = _Stock(counts, capacity)
        if stock.left[capacity]:
            stock.use((capacity,))
        return stock

    def rounds(stock: _Stock) -> None:
        for most in (1, 2, 3):  # pieces beside the longest one of a sequence
            for length in map(int, stock.present(capacity - 1)):
                if stock.left[length]:
                    _complements(stock, length, capacity, most)

    def longest_first(stock: _Stock) -> None:
        for length in map(int, stock.present(capacity - 1)):
            for most in (1, 2, 3):
                if stock.left[length]:
                    _complements(stock, length, capacity, most)
            if stock.left[length]:
                _best_fit(stock, capacity, length)

    least = -(-sum(x * n for x, n in counts.items()) // capacity)
    best, fewest = [], None
    for exact in (longest_first, rounds, lambda stock: None):
        stock = full()
        exact(stock)
        _best_fit(stock, capacity)
        used = sum(times for _, times in stock.patterns)
        if fewest is None or used < fewest:
            best, fewest = stock.patterns, used
        if fewest == least:
            break
    return best


def _ranges(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, last number, first sequence, offset): which pieces go where."""
    used: Counter = Counter()
    out, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            out.append((x, used[x], used[x] + times - 1, sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """Add sequence_id and offset to pieces (part, number, <length_col>, ...).

    `part` and `number` say where a piece lies: number counts the pieces of one length within a
    part from 0, as `tokenize` writes them.  The table must be stored, since it is read twice.
    Lengths have to be 1 to `capacity`; others raise an error.
    """
    spark, length = pieces.sparkSession, F.col(length_col)
    cells = pieces.groupBy("part", length.alias("__length")).agg(F.count("*").alias("__n"))
    cells = stored(cells, "pack-cells")
    totals = cells.groupBy("__length").agg(F.sum("__n").alias("n")).limit(capacity + 1).collect()
    counts = {r["__length"]: r["n"] for r in totals}
    if any(x is None or not 0 < x <= capacity for x in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    before = Window.partitionBy("__length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("part").alias("__part"),
        "__length",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    # at most a few ranges for each of the `capacity` lengths: bounded whatever the input
    ranges = spark.createDataFrame(
        _ranges(plan(counts, capacity)),
        "__len int, __first long, __last long, __sequence long, __offset long",
    )
    numbered = pieces.join(
        cells, (pieces["part"] == F.col("__part")) & (length == F.col("__length"))
    ).withColumn("__at", F.col("number") + F.col("__before"))
    placed = numbered.join(
        F.broadcast(ranges),
        (length == F.col("__len")) & F.col("__at").between(F.col("__first"), F.col("__last")),
    )
    return placed.select(
        *[pieces[c] for c in pieces.columns],
        (F.col("__sequence") + F.col("__at") - F.col("__first")).alias("sequence_id"),
        F.col("__offset").alias("offset"),
    )


# --- pieces -------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies spell bytes: printable bytes stand for
    themselves, the others for the letters from code point 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _tokenizer(raw: bytes) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file, run by tiktoken, which is several times faster.

    Both give the same ids where a merge's rank is the id of what it makes, which is checked.
    An added token is its own id wherever its literal stands in a text, as the library reads it; the
    text before and after it is encoded by itself.
    """
    import public_tokenizers as public

    model = json.loads(raw)["model"]
    added = json.loads(raw)["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("added tokens that take spaces along or need word borders are not supported")
    special = {t["content"]: t["id"] for t in added}
    letters, vocab = _byte_letters(), model["vocab"]
    ids = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if ids != list(range(256, 256 + len(ids))):
        raise ValueError("ids do not follow the order of merges")
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding(
        "file", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be shorter than capacity."""
    first = n % capacity
    head = [(0, first)] if first else []
    return head + [(s, capacity) for s in range(first, n, capacity)]


def tokenize(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of every whole text: part, number, <id_col>, piece, start, length, ids (4 bytes each).

    A document is its ids followed by `end_id`, so a null or empty text is one piece of one token.
    Repeated rows give repeated pieces; other columns are left out; no rows give no pieces.
    """
    with open(tokenizer_file, "rb") as f:  # a parameter of bounded size
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = _tokenizer(raw.value).encode_to_numpy, Counter()
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows: list[tuple] = []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or "", allowed_special="all"), end_id).astype("<u4")
                for piece, (start, n) in enumerate(cut(len(ids), capacity)):
                    rows.append((k, seen[n], piece, start, n, ids[start : start + n].tobytes()))
                    seen[n] += 1
            k, number, piece, start, n, out = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(number, pa.int64()),
                    batch.column(0).take(pa.array(k, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(out, pa.binary()),
                ],
                names=["part", "number", "id", "piece", "start", "length", "ids"],
            )

    pick = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"part int, number bigint, id {kind}, piece int, start bigint, length bigint, ids binary"
    )
    return pick.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Tokenize, cut and pack: pieces with sequence_id and offset.

    With keep_ids the ids of each piece come along as `ids`; else their checksum `ids_crc32`.
    The pieces are stored once in the shared folder, so a lost executor repeats no placement and
    numbers agree between the two readings.
    """
    pieces = tokenize(docs, tokenizer_file, capacity, end_id, id_col, text_col)
    if not keep_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = pack(stored(pieces, "pieces"), capacity)
    return packed.drop("part", "number")
