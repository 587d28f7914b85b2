"""Helpers shared by the text operators: input guards, word handling, and the engine's scratch tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import ship
from ..scratch import drop_path, scratch_path, stored

__all__ = ["drop_path", "scratch_path", "stored"]

#: Fixed values of the contracts: white space, and a word made of anything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Stands for a null doc_id inside the operators; it ranks after every other id.  So the largest long
#: is no id of its own: a document that has it counts as one without an id, and gets null back.
NULL_ID = (1 << 63) - 1

#: Relations with at most this many rows may be broadcast, after they were counted.
BROADCAST_ROWS = 100_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, _UPPER, _UPPER.lower())


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text column as a string, null read as empty."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def id_of(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The id column as a long, null read as NULL_ID."""
    return F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID))


def id_back(column: Column) -> Column:
    """Undo ``id_of``: NULL_ID becomes null again."""
    return F.when(column != F.lit(NULL_ID), column)


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just what the text operators work on: doc long, body binary (UTF-8), th long.

    ``th`` hashes the text.  (doc, th) names a row: rows that agree in both are copies of one row
    and always get the same result, so joining on the pair is safe with repeated ids.
    """
    ship(docs.sparkSession)
    return docs.select(
        id_of(docs, id_col).alias("doc"),
        text_of(docs, text_col).cast("binary").alias("body"),
        F.xxhash64(text_of(docs, text_col)).alias("th"),
    )


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it was counted to hold few rows; else leave the join to Spark."""
    return F.broadcast(df) if rows <= limit else df


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered; forgets all when it gets large."""

    #: About 150 bytes a word in each Python worker.
    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.LIMIT:
            self.clear()
        out = self[word] = xxh3_64_intdigest(word)
        return out


_hashes = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads them evenly."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E6C63D0876A9A35)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC3A5C85C97CB3127)
    return x ^ (x >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 0x51ED270B27B4F3CF) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive word hashes."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    step = np.uint64(seed | 1)
    for j in range(1, n):
        out *= step
        out += hashes[j : len(hashes) - n + 1 + j]
    return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


