"""Reading tables, keeping intermediate tables, and word splitting shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir

ASCII_SPACE = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the cluster's shared folder and read back; a lost executor loses none of it."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to clash with no column."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(docs: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]


def raw_bytes(column: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def batch_of(schema: pa.Schema, columns: dict[str, Iterable]) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def fill_batches(schema: pa.Schema, rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Gather row tuples into record batches."""
    chunk: list[tuple] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) >= size:
            yield batch_of(schema, dict(zip(schema.names, zip(*chunk))))
            chunk = []
    if chunk:
        yield batch_of(schema, dict(zip(schema.names, zip(*chunk))))


class WordHashes(dict):
    """64-bit hashes of words, remembered; emptied when it has grown beyond its limit."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()

#: What a worker remembers beyond its task, each with a function that empties it.
memories: list[tuple[object, Callable[[], None]]] = [(_hashes, _hashes.clear)]


def take_up(memory: object) -> None:
    """Empty the other memories: a worker that goes on with another stage keeps one of them at a time."""
    for other, empty in memories:
        if other is not memory:
            empty()


ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that each bit depends on all."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    take_up(_hashes)
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """One hash for each run of ``size`` words; for fewer words, one of the whole sequence."""
    if not words:
        return np.empty(0, np.uint64)
    each = word_hashes(words)
    count = max(1, len(words) - size + 1)
    total = np.full(count, np.uint64(min(size, len(words))))
    with np.errstate(over="ignore"):
        for k in range(min(size, len(words))):
            total = mixed(total * ODD + each[k : k + count])
    return total
