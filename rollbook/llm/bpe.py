"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one vocabulary token can be the last token of its encoding:
the one that fits behind the last token of the prefix before it.  Storing that token per prefix
encodes the piece, extends it exactly when bytes are appended, and re-encodes only the
neighbourhood of an edit.

Whole texts are split by a pattern first, as rank-file tokenizers do, and every match is encoded on
its own.  Spark deals the rows; each task keeps a bounded cache of pieces it has already encoded.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

NEVER = 1 << 62
# Only speed and memory of a worker depend on these three.
CACHE_PIECES = 1_000_000  # pieces remembered
CACHED_CHARS = 40  # longer pieces are not remembered
CHUNK_CHARS = 4_000_000  # texts split at a time


class Vocabulary:
    """Tokens by rank and the tests which two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.width = max(map(len, ranks), default=1)
        self.joined: dict[tuple[int, int], int] = {}
        # tokens at the right and left edge of a token while it grew, the last made first,
        # each with the rank at which the next merge takes it away
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        for token, r in sorted(ranks.items(), key=lambda x: x[1]):
            halves = [
                (ranks[token[:i]], ranks[token[i:]])
                for i in range(1, len(token))
                if token[:i] in ranks and token[i:] in ranks
            ]
            made = [(a, b) for a, b in halves if a < r and b < r and self._apart(a, b)]
            self.right_edge[r], self.left_edge[r] = [(r, NEVER)], [(r, NEVER)]
            if made:
                a, b = made[0]
                (right, _), *above_b = self.right_edge[b]
                (left, _), *above_a = self.left_edge[a]
                self.right_edge[r] += [(right, r), *above_b]
                self.left_edge[r] += [(left, r), *above_a]
            for pair in halves:
                self.joined[pair] = r
        # every tail of a token, with the token it is itself; a token that no merges lead to never
        # comes out of them
        self.tail = {t[i:]: -1 for t in ranks for i in range(1, len(t))}
        self.tail |= {t: r if len(t) == 1 or self.right_edge[r][1:] else -1 for t, r in ranks.items()}

    @classmethod
    def from_file(cls, raw: bytes) -> Vocabulary:
        """From the lines of a rank file: base64 token, space, rank."""
        lines = (line.split() for line in raw.splitlines() if line.strip())
        return cls({base64.b64decode(a): int(b) for a, b in lines})

    def _apart(self, a: int, b: int) -> bool:
        """True if no merge crosses the border while a and b are being built.

        The pairs that meet at the border are visited from the finished tokens back to single
        bytes.  A crossing merge happens if its rank is lower than the next merge of the left
        neighbour and not higher than that of the right one: of equal ranks the left goes first.
        """
        left, right, i, j = self.right_edge[a], self.left_edge[b], 0, 0
        while True:
            (x, x_gone), (y, y_gone) = left[i], right[j]
            crossing = self.joined.get((x, y), NEVER)
            if crossing < x_gone and crossing <= y_gone and crossing != NEVER:
                return False
            # undo the later of the two merges
            if x > y and i + 1 < len(left) or j + 1 == len(right):
                i += 1
                if i == len(left):
                    return True
            else:
                j += 1

    def fits(self, a: int, b: int) -> bool:
        if len(self._fits) > 1_000_000:
            self._fits.clear()
        known = self._fits[a << 32 | b] = self._apart(a, b)
        return known

    def extend(self, piece: bytes, last: list[int], until: int) -> None:
        """Append the last tokens of piece[: len(last)] up to piece[:until]; last[i] is that of piece[:i].

        The candidates are the tokens at the end of the prefix, the longest one tried first.
        """
        tail, known = self.tail.get, self._fits.get
        for end in range(len(last), until + 1):
            start, found = end - 1, []
            token = tail(piece[start:end])
            while token is not None:
                if token >= 0:
                    found.append(token)
                    found.append(start)
                if not start:
                    break
                start -= 1
                token = tail(piece[start:end])
            while True:
                start, token = found.pop(), found.pop()
                if not start:
                    break
                before = last[start]
                fit = known(before << 32 | token)
                if fit or fit is None and self.fits(before, token):
                    break
            last.append(token)


class PrefixEncoding:
    """The encoding of one piece with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> PrefixEncoding:
        """Exact: prefixes that are already there keep their tokens."""
        self.piece += more
        self.vocabulary.extend(self.piece, self.last, len(self.piece))
        return self

    def edit(self, start: int, removed: int, inserted: bytes) -> int:
        """Replace bytes; returns how many prefixes were encoded anew.

        Behind the edit the old tokens hold again as soon as a stretch as wide as the longest
        token has come out unchanged.
        """
        old, shift = self.last, len(inserted) - removed
        self.piece = self.piece[:start] + inserted + self.piece[start + removed :]
        self.last = old[: start + 1]
        same = done = 0
        for end in range(start + 1, len(self.piece) + 1):
            if same >= self.vocabulary.width:
                self.last += old[end - shift :]
                break
            self.vocabulary.extend(self.piece, self.last, end)
            done += 1
            behind = end > start + len(inserted)
            same = same + 1 if behind and old[end - shift] == self.last[end] else 0
        return done

    def tokens(self) -> list[int]:
        ids, end = [], len(self.piece)
        while end:
            ids.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[ids[-1]])
        return ids[::-1]


class Encoder:
    """Texts to their ids as little-endian 32-bit bytes; keeps pieces it has met."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self.bytes_of = vocabulary.bytes_of.__getitem__
        self.id_of = {r: r.to_bytes(4, "little") for r in vocabulary.bytes_of}
        self.width = {r: len(t) for r, t in vocabulary.bytes_of.items()}
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Encode pieces in sorted order: what a piece shares with the one before is only appended to."""
        out, rank, before, last = {}, self.vocabulary.rank, b"", [-1]
        width = self.width
        for raw, piece in sorted((p.encode(), p) for p in pieces):
            whole = rank.get(raw)  # a piece that is a token is that token
            if whole is not None:
                out[piece] = self.id_of[whole]
                continue
            shared, most = 0, min(len(raw), len(before))
            while shared < most and raw[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            self.vocabulary.extend(raw, last, len(raw))
            before, ids, end = raw, [], len(raw)
            while end:
                token = last[end]
                ids.append(self.id_of[token])
                end -= width[token]
            out[piece] = b"".join(ids[::-1])
        return out

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text in turn; texts are taken in chunks of CHUNK_CHARS."""
        begin = 0
        while begin < len(texts):
            end, chars = begin, 0
            while end < len(texts) and chars < CHUNK_CHARS:
                chars += len(texts[end] or "")
                end += 1
            split = [self.split(t or "") for t in texts[begin:end]]
            if len(self.known) > CACHE_PIECES:
                self.known.clear()
            fresh = self.learn(set().union(*split) - self.known.keys())
            self.known |= {p: ids for p, ids in fresh.items() if len(p) <= CACHED_CHARS}
            of = self.known.get
            for pieces in split:
                try:
                    yield b"".join(map(of, pieces))
                except TypeError:  # a long piece is not among the kept ones
                    yield b"".join(of(p) or fresh[p] for p in pieces)
            begin = end

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _encoder(raw: bytes, pattern: str) -> Encoder:
    return Encoder(Vocabulary.from_file(raw), pattern)


def _map_texts(
    df: DataFrame, ranks_file: str, pattern: str, id_col: str, text_col: str, row, columns: dict
) -> DataFrame:
    """Column id and what row(encoder, ids) gives for every text."""
    with open(ranks_file, "rb") as f:  # a vocabulary file is a parameter of bounded size
        raw = df.sparkSession.sparkContext.broadcast(f.read())
    names, kinds = ["id", *columns], [kind for _, kind in columns.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = [row(encoder, ids) for ids in encoder.encode_all(texts)]
            values = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values], names=names)

    pick = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    schema = [f"id {df.schema[id_col].dataType.simpleString()}"]
    schema += [f"{name} {kind}" for name, (kind, _) in columns.items()]
    return pick.mapInArrow(run, ", ".join(schema)).withColumnRenamed("id", id_col)


def encode(
    df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns id, ids (little-endian 32-bit token ids) of every whole text.

    A null or empty text has no ids, repeated rows stay repeated, other columns are left out, a
    null id stays null, an empty table gives an empty table.  A text of any length is one row.
    """
    columns = {"ids": ("binary", pa.binary())}
    return _map_texts(df, ranks_file, pattern, id_col, text_col, lambda _, ids: (ids,), columns)


def decode(df: DataFrame, ranks_file: str, id_col: str = "doc_id") -> DataFrame:
    """The way back: columns id, text_bytes from the ids column of `encode`; null ids: no bytes."""
    kind = df.schema[id_col].dataType.simpleString()
    with open(ranks_file, "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value, r"\S+")
        for batch in batches:
            texts = [encoder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["id", "text_bytes"]
            )

    pick = df.select(df[id_col].alias("id"), df["ids"])
    return pick.mapInArrow(run, f"id {kind}, text_bytes binary").withColumnRenamed("id", id_col)


def digests(
    df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns id, n_tokens, ids_sha256, decoded_sha256: ids and decoded bytes as digests.

    Encodes and decodes in one pass, so that ids need not be written between the two.
    """

    def row(encoder: Encoder, ids: bytes):
        back = encoder.decode(ids)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

    columns = {
        "n_tokens": ("bigint", pa.int64()),
        "ids_sha256": ("string", pa.string()),
        "decoded_sha256": ("string", pa.string()),
    }
    return _map_texts(df, ranks_file, pattern, id_col, text_col, row, columns)
