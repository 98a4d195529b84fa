"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_SPACE = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_words(text: str) -> list[bytes]:
    """The maximal runs of characters other than space and \\t..\\r, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def crc_remainder(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def crc_of(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def frames(rows: Iterable[tuple], columns: list[str], size: int = 4096) -> Iterator[pd.DataFrame]:
    """Rows as data frames of at most ``size`` rows, for mapInPandas."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield pd.DataFrame.from_records(block, columns=columns)
            block = []
    if block:
        yield pd.DataFrame.from_records(block, columns=columns)


def groups(texts: list[str], size: int = 1 << 21) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` code points together; a longer text stands alone."""
    block, total = [], 0
    for text in texts:
        if block and total + len(text) > size:
            yield block
            block, total = [], 0
        block.append(text)
        total += len(text)
    if block:
        yield block


class TwoGenerationCache(dict):
    """A bounded memo of ``make``: entries unused for a whole generation are forgotten.

    Only speed depends on the bound; a forgotten key is computed again.
    """

    def __init__(self, make: Callable, bound: int = 400_000):
        super().__init__()
        self.make, self.bound, self.older = make, bound, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
