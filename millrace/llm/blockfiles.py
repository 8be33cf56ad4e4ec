"""Documents gathered into block files in the cluster's shared folder, for operators that return to their texts.

Folders are URIs that pyarrow opens (file, hdfs, s3, gs). A task that runs again writes the same
file anew and renames it into place.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept, raw_bytes
from millrace.session import shared_dir

BLOCK = 8 << 20


def put(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    raw = io.BytesIO()
    np.savez(raw, **arrays)
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    rough = f"{root}/.tmp-{TaskContext.get().taskAttemptId()}-{name}"
    with files.open_output_stream(rough) as out:
        out.write(zstandard.ZstdCompressor(level=3).compress(raw.getvalue()))
    files.move(rough, f"{root}/{name}")


def get(folder: str, name: str) -> dict[str, np.ndarray]:
    files, root = fs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{root}/{name}") as file:
        held = np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(file.read())))
    return {key: held[key] for key in held.files}


def names_in(folder: str) -> list[str]:
    """Names of the files that are complete, in order; none if nothing was written."""
    files, root = fs.FileSystem.from_uri(folder)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if not f.base_name.startswith(".tmp-"))


def put_parts(folder: str, name: str, parts: Iterable[bytes]) -> list[int]:
    """Where each part ends in a file that holds them one after another, written as they come."""
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    rough, ends = f"{root}/.tmp-{TaskContext.get().taskAttemptId()}-{name}", [0]
    with files.open_output_stream(rough) as out:
        for part in parts:
            out.write(part)
            ends.append(ends[-1] + len(part))
    files.move(rough, f"{root}/{name}")
    return ends[1:]


def get_part(folder: str, name: str, begin: int, end: int) -> bytes:
    files, root = fs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{root}/{name}") as file:
        file.seek(begin)
        return file.read(end - begin)


def drop(folder: str) -> None:
    """Delete a folder of files that no task reads any more, if there is one."""
    files, root = fs.FileSystem.from_uri(folder)
    if files.get_file_info(root).type != fs.FileType.NotFound:
        files.delete_dir(root)


def write_blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """``block, folder, n_bytes``; a file holds doc ids, ends and bytes of whole texts, about ``size`` bytes or one text."""
    folder = shared_dir(docs.sparkSession, "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            block = part << 32 | number
            put(folder, f"{block}.docs", {
                "ids": np.array(ids, np.int64), "ends": np.cumsum([len(t) for t in texts], dtype=np.int64),
                "text": np.frombuffer(b"".join(texts), np.uint8)})
            row = pa.RecordBatch.from_pydict({"block": [block], "n_bytes": [held]})
            ids.clear()
            texts.clear()
            number, held = number + 1, 0
            return row

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and held + len(text) > size:
                    yield flush()
                ids.append(doc)
                texts.append(text)
                held += len(text)
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), raw_bytes().alias("t"))
    return kept(rows.mapInArrow(run, "block long, n_bytes long"), "block-list").withColumn("folder", F.lit(folder))
