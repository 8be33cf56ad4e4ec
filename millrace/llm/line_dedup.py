"""Line dedup: range-partitioned line hashes, first occurrences in a stream, keep bitmaps per document.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at
least ``min_chars`` code points found in at least ``min_docs`` documents keep their lines only in
the largest ``doc_id`` that holds them.

Null text is one empty line. Rows without a doc_id take no part and lose nothing. Rows that share a
doc_id count as one document; each is cut by itself. Empty tables give empty results; extra columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ASCII_SPACE, columns_of, fill_batches, fresh, kept, raw_bytes

LINES_DDL = "h1 long, h2 long, doc_id long, row_hash long, n_lines int, pos int"
LINES = pa.schema(
    [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("row_hash", pa.int64()),
     ("n_lines", pa.int32()), ("pos", pa.int32())]
)
FOUND = LINES.append(pa.field("kind", pa.int32()))
# Dropped for certain; undecided, as its key may go on in a neighbouring partition; only shows that a document holds the key.
DROP, OPEN, WITNESS = 0, 1, 2


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, row_hash, n_lines, n_dropped, bitmap`` for each row that loses lines.

    ``row_hash`` is xxhash64 of the text, which tells rows of one doc_id apart. ``bitmap`` has one
    bit for each line, set if it stays, packed and compressed with zlib.
    """
    lines = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("row_hash"), raw_bytes().alias("t")
    )
    lines = kept(lines.mapInArrow(lambda batches: long_lines(batches, min_chars), LINES_DDL), "lines")
    # A key that many documents hold spans partitions, as the range goes on with the document.
    order = ["h1", "h2", F.desc("doc_id"), "row_hash", "pos"]
    dealt = lines.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    found = kept(dealt.mapInArrow(lambda batches: scan(batches, min_docs), f"{LINES_DDL}, kind int"), "found-lines")
    # Only the first and last key of a partition are settled here, so verdicts are two for each partition at most.
    verdicts = (
        found.where(f"kind <> {DROP}").groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("holders"), F.max("doc_id").alias("keeper"))
        .where(F.col("holders") >= min_docs)
    )
    settled = found.where(f"kind = {OPEN}").join(F.broadcast(verdicts), ["h1", "h2"]).where("doc_id <> keeper")
    columns = ["doc_id", "row_hash", "n_lines", "pos"]
    dropped = found.where(f"kind = {DROP}").select(*columns).unionByName(settled.select(*columns))
    gathered = dropped.groupBy("doc_id", "row_hash").agg(F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone"))
    return gathered.mapInArrow(pack, "doc_id long, row_hash long, n_lines int, n_dropped int, bitmap binary")


def long_lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc, row_hash, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = text.split(b"\n")
                for pos, line in enumerate(lines):
                    key = line.strip(ASCII_SPACE).lower()
                    if len(key) >= min_chars and n_chars(key) >= min_chars:
                        h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(key), np.int64)
                        yield int(h1), int(h2), doc, row_hash, len(lines), pos

    return fill_batches(LINES, rows(), 16_384)


def n_chars(raw: bytes) -> int:
    return len(raw) if raw.isascii() else int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def scan(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Stream one partition, sorted by key, then by falling document.

    A key's first document here keeps its lines. Those of the next ones wait until ``min_docs``
    documents were seen, then they and all that follow drop. The partition's first key may have
    begun earlier, so all its rows stay open; its last key may go on, so what waits stays open too.
    """

    def rows():
        key, first_key, doc, n_docs = None, True, None, 0
        waiting: list[tuple] = []
        witnesses: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    first_key = key is None
                    key, doc, n_docs, waiting, witnesses = row[:2], None, 0, [], []
                if row[2] != doc:
                    doc, n_docs = row[2], n_docs + 1
                    if n_docs <= min_docs and not first_key:
                        witnesses.append(row)
                if first_key:
                    yield *row, OPEN
                elif n_docs >= min_docs:
                    for earlier in waiting:
                        yield *earlier, DROP
                    waiting = []
                    if n_docs > 1:
                        yield *row, DROP
                elif n_docs > 1:
                    waiting.append(row)
        for row in waiting:
            yield *row, OPEN
        for row in witnesses:
            yield *row, WITNESS

    return fill_batches(FOUND, rows(), 16_384)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, gone = batch.column("n_lines").to_pylist(), batch.column("gone")
        maps, counts = [], []
        for n, positions in zip(sizes, gone):
            keep = np.ones(n, np.uint8)
            keep[positions.values.to_numpy()] = 0
            counts.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        arrays = [*batch.columns[:3], pa.array(counts, pa.int32()), pa.array(maps, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row_hash", "n_lines", "n_dropped", "bitmap"])


def cut(raw: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The text without its dropped lines; how many lines it had and lost."""
    lines = raw.split(b"\n")
    if bitmap is None:
        return raw, len(lines), 0
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return b"\n".join(line for line, k in zip(lines, keep) if k), len(lines), len(lines) - int(keep.sum())


def with_bitmaps(docs: DataFrame, name: str = "_bitmap", **limits: int) -> DataFrame:
    """The rows with a last column of bitmaps, null where no line drops; its name gives way to the columns'."""
    doc, row, bitmap = fresh(docs, "_doc", "_row", name)
    marks = keep_bitmaps(docs, **limits).select(
        F.col("doc_id").alias(doc), F.col("row_hash").alias(row), F.col("bitmap").alias(bitmap)
    )
    on = (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(row))
    return docs.join(marks, on, "left").select(*columns_of(docs), bitmap)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents with the lines that stay; ``n_chars`` follows the text.

    Documents that lose lines and have no word left are dropped.
    """
    marked = with_bitmaps(docs, min_chars=min_chars, min_docs=min_docs)
    names = docs.columns
    text, n_chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, texts, stay = list(batch.columns[:-1]), [], []
            for t, bitmap in zip(batch.column(text).to_pylist(), batch.columns[-1].to_pylist()):
                if bitmap is not None:
                    t = cut((t or "").encode(), bitmap)[0].decode()
                texts.append(t)
                stay.append(bitmap is None or bool(t.strip()))
            columns[text] = pa.array(texts, pa.string())
            if n_chars_at is not None:
                old = columns[n_chars_at]
                cut_here = batch.columns[-1].is_valid().to_pylist()
                counts = [len(t) if c else n for t, c, n in zip(texts, cut_here, old.to_pylist())]
                columns[n_chars_at] = pa.array(counts, old.type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stay, pa.bool_()))

    return marked.mapInArrow(run, docs.schema)
