"""Token ids in files: canonical length-limited Huffman codes, blocks that decode by themselves.

Layout of a file: a magic line; the blocks' payloads; a zlib-packed footer; the footer's length and
the magic line again. The footer holds the code lengths, for each block its place, its token count
and the bit offset of every ``CHECK``-th token, and for each document its id and token count.
A decoder follows all checkpoints of a block at once, one table look-up for each token.

Files follow ascending doc_id, and so do documents within them; rows without doc_id come first,
rows of one doc_id in order of their ids. Folders are URIs that pyarrow opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import kept
from millrace.session import shared_dir

MAGIC = b"MILLHUF1\n"
BLOCK, CHECK = 1 << 19, 256
#: Bytes of ids that are counted at once.
PORTION = 1 << 20


# Codes


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Optimal lengths of at most ``limit`` bits by merging packages; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit or 0, (n - 1).bit_length()) if limit else min(24, (n - 1).bit_length() + 4)
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    packages, leaves = np.empty(0), []
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        at = np.argsort(merged, kind="stable")
        leaves.append(at < n)
        ranked = merged[at]
        packages = ranked[0 : len(ranked) - 1 : 2] + ranked[1::2]
    found, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaves):
        here = int(np.count_nonzero(is_leaf[:take]))
        found[:here] += 1
        take = 2 * (take - here)
    lengths[order] = found
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        width = int(lengths.max())
        steps = np.uint64(1) << (width - lengths[order]).astype(np.uint64)
        starts = np.cumsum(steps) - steps
        codes[order] = starts >> (width - lengths[order]).astype(np.uint64)
    return codes


class Table:
    """Symbol and length for every bit pattern as wide as the longest code."""

    def __init__(self, lengths: np.ndarray):
        self.width = max(1, int(lengths.max(initial=0)))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = (1 << (self.width - lengths[order].astype(np.int64))).astype(np.int64)
        self.symbols = np.zeros(1 << self.width, np.uint32)
        self.lengths = np.ones(1 << self.width, np.uint8)
        filled = int(spans.sum())
        self.symbols[:filled] = np.repeat(order, spans)
        self.lengths[:filled] = np.repeat(lengths[order], spans)


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Payload, and the bit offset of every ``CHECK``-th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    placed = codes[ids] << (64 - size - (begins & 31)).astype(np.uint64)
    word = begins >> 5
    n_words = int(ends[-1] >> 5) + 2
    # The bits of different ids never overlap, so sums below 2**32 are exact as doubles.
    high = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), n_words)
    low = np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    return (high + low).astype(np.uint64).astype(">u4").tobytes(), begins[::CHECK].copy()


def decode_block(payload: bytes, n: int, checks: np.ndarray, table: Table) -> np.ndarray:
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    windows = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros((CHECK, len(checks)), np.uint32)
    at, shift = checks.copy(), 32 - table.width
    last = len(windows) - 1
    for k in range(CHECK):
        pattern = (windows[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(shift)
        out[k] = table.symbols[pattern]
        at += table.lengths[pattern]
    return out.T.reshape(-1)[:n]


# Files


def place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def portions(rows: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of all rows, some rows at a time: counting costs as much as the vocabulary is large."""
    waiting, held = [], 0
    for raw in rows:
        waiting.append(raw)
        held += len(raw)
        if held >= PORTION:
            yield b"".join(waiting)
            waiting, held = [], 0
    if waiting:
        yield b"".join(waiting)


def count_ids(tokens: DataFrame, dtype: np.dtype) -> np.ndarray:
    """How often each id occurs; each task sends a row for each id it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for portion in portions(raw for batch in batches for raw in batch.column(0).to_pylist()):
            here = np.bincount(np.frombuffer(portion, dtype))
            if len(here) > len(total):
                total = np.pad(total, (0, len(here) - len(total)))
            total[: len(here)] += here
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    # As many rows as the vocabulary has entries, at most.
    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
    counts = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    counts[ids] = n
    return counts


def write_ids(tokens: DataFrame, dtype: np.dtype, folder: str | None = None) -> DataFrame:
    """Write ``doc_id, ids`` to files; the manifest ``path, part, n_docs, n_tokens, base`` in file order.

    ``base`` is the number of ids in earlier files. A task that runs again writes the same file anew and renames it into place.
    """
    spark = tokens.sparkSession
    folder = folder or shared_dir(spark, "token-files")
    lengths = spark.sparkContext.broadcast(code_lengths(count_ids(tokens, dtype)))  # one byte for each vocabulary entry
    ordered = tokens.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = place(folder)
        files.create_dir(root, recursive=True)
        path, rough = f"{root}/ids-{task.partitionId():06d}.huf", f"{root}/.tmp-{task.taskAttemptId()}"
        with files.open_output_stream(rough) as out:
            n_docs, n_tokens = write_file(out, batches, dtype, lengths.value)
        files.move(rough, path)
        yield pa.RecordBatch.from_pydict(
            {"path": [path], "part": pa.array([task.partitionId()], pa.int32()), "n_docs": [n_docs], "n_tokens": [n_tokens]}
        )

    manifest = kept(ordered.mapInArrow(run, "path string, part int, n_docs long, n_tokens long"), "manifest")
    before = F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")  # a row for each file
    return manifest.withColumn("base", before).withColumn("folder", F.lit(folder))


def write_file(out, batches: Iterator[pa.RecordBatch], dtype: np.dtype, lengths: np.ndarray) -> tuple[int, int]:
    codes, blocks, docs, sizes = canonical(lengths), [], [], []
    waiting, n_waiting, at = [], 0, out.write(MAGIC) or len(MAGIC)

    def flush(ids: np.ndarray) -> None:
        nonlocal at
        payload, checks = encode_block(ids, codes, lengths)
        out.write(payload)
        blocks.append((at, len(payload), len(ids), checks))
        at += len(payload)

    for batch in batches:
        for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.frombuffer(raw, dtype)
            docs.append(doc)
            sizes.append(len(ids))
            waiting.append(ids)
            n_waiting += len(ids)
            if n_waiting >= BLOCK:
                ids = np.concatenate(waiting)
                whole = len(ids) - len(ids) % BLOCK
                for k in range(0, whole, BLOCK):
                    flush(ids[k : k + BLOCK])
                waiting, n_waiting = [ids[whole:].copy()], len(ids) - whole
    if n_waiting:
        flush(np.concatenate(waiting))
    footer = io.BytesIO()
    np.savez(
        footer, lengths=lengths, blocks=np.array([b[:3] for b in blocks], np.int64).reshape(-1, 3),
        checks=np.concatenate([b[3] for b in blocks]) if blocks else np.zeros(0, np.int64),
        docs=np.array([d or 0 for d in docs], np.int64), known=np.array([d is not None for d in docs], bool), sizes=np.array(sizes, np.int64),
    )
    packed = zlib.compress(footer.getvalue())
    out.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
    return len(docs), sum(sizes)


class Reader:
    """One file: its documents, and its ids block by block; any block can be read alone."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        file.seek(end - len(MAGIC) - 8)
        size, magic = int.from_bytes(file.read(8), "little"), file.read(len(MAGIC))
        file.seek(0)
        if magic != MAGIC or file.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        file.seek(end - len(MAGIC) - 8 - size)
        footer = np.load(io.BytesIO(zlib.decompress(file.read(size))))
        self.docs, self.known, self.sizes = footer["docs"], footer["known"], footer["sizes"]
        self.places, self.checks = footer["blocks"], footer["checks"]
        self.table = Table(footer["lengths"])
        self.first_check = np.r_[0, np.cumsum(-(-self.places[:, 2] // CHECK))]

    def block(self, k: int) -> np.ndarray:
        at, size, n = map(int, self.places[k])
        self.file.seek(at)
        return decode_block(self.file.read(size), n, self.checks[self.first_check[k] : self.first_check[k + 1]], self.table)

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """Each document's id and its ids, in pieces."""
        blocks = iter(range(len(self.places)))
        rest = np.zeros(0, np.uint32)
        for doc, known, size in zip(self.docs.tolist(), self.known.tolist(), self.sizes.tolist()):
            pieces = []
            while size:
                if not len(rest):
                    rest = self.block(next(blocks))
                pieces.append(rest[:size])
                size -= len(pieces[-1])
                rest = rest[len(pieces[-1]) :]
            yield doc if known else None, pieces


def read_ids(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base, folder in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with place(folder)[0].open_input_file(path) as file:
                    rows = []
                    for doc, pieces in Reader(file).documents():
                        crc, n = 0, 0
                        for ids in pieces:
                            crc, n = zlib.crc32(ids.astype("<u4").tobytes(), crc), n + len(ids)
                        rows.append((doc, base, n, crc))
                        base += n
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], schema=schema)

    files = kept(manifest.select("path", "base", "folder"), "files")
    return files.repartition(max(1, files.count())).mapInArrow(run, ", ".join(f"{n} long" for n in schema.names))
