"""Quality rules: text statistics, and bands of compression ratios by length of text.

Null text counts as empty; empty tables give empty results; extra columns pass through untouched;
repeated rows are each judged by themselves. Every rule looks at the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ASCII_SPACE, ODD, mixed, raw_bytes, word_hashes

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits on bytes before over bytes after zstandard compression.

    A text of at most ``lengths[i]`` bytes must have a ratio within ``whole[i]``; the last band holds
    all longer texts. Each chunk of ``chunk`` bytes must have one within ``chunks``, but for a share
    of at most ``tolerated`` of a text's chunks; shorter texts have chunks of ``small`` bytes and
    ``smalls``. Where chunks leave a rest, the last one covers the text's end and overlaps its
    predecessor. Texts below ``small`` bytes are judged as a whole only. Longer texts compress better,
    so their bands lie higher; the lower ends are what random letters reach, the upper ends what pure
    repetition does.
    """

    level: int = 3
    lengths: tuple[int, ...] = (500, 2_000, 8_000, 32_000)
    whole: tuple[tuple[float, float], ...] = ((1.1, 2.4), (1.36, 2.6), (1.5, 2.8), (1.6, 3.1), (1.6, 3.8))
    chunk: int = 2048
    chunks: tuple[float, float] = (1.36, 3.2)
    small: int = 500
    smalls: tuple[float, float] = (1.3, 2.4)
    tolerated: float = 0.34

    def pieces(self, size: int) -> list[tuple[int, int]]:
        """Begin and end of the chunks of a text of ``size`` bytes; together they cover it."""
        step = self.chunk if size >= self.chunk else self.small
        if size < step:
            return []
        begins = [*range(0, size - step + 1, step)]
        if size % step:
            begins.append(size - step)
        return [(i, i + step) for i in begins]

    def accepts(self, size: int, ratio: float, chunk_ratios: list[float]) -> bool:
        low, high = self.whole[int(np.searchsorted(self.lengths, size))]
        if not low <= ratio <= high:
            return False
        least, most = self.chunks if size >= self.chunk else self.smalls
        odd = sum(not least <= r <= most for r in chunk_ratios)
        return odd <= self.tolerated * len(chunk_ratios)


STATS = pa.schema(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
     ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
     ("n_chunks", pa.int64())]
)
STATS_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long"
)


def measure(docs: DataFrame, bands: Bands = Bands(), text: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(bands)
        for batch in batches:
            rows = [judge(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * len(STATS)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, STATS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *STATS.names])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", raw_bytes(text).alias("t")).mapInArrow(run, f"doc_id {id_type}, {STATS_DDL}")


def filter_by_rules(docs: DataFrame, bands: Bands = Bands(), text: str = "text") -> DataFrame:
    """The rows whose text the rules accept, with their columns as they are."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, verdict = Judge(bands), STATS.names.index("kept")
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([judge((t or "").encode())[verdict] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


class Judge:
    def __init__(self, bands: Bands):
        self.bands = bands
        self.zstd = zstandard.ZstdCompressor(level=bands.level)

    def __call__(self, raw: bytes) -> tuple:
        words = raw.split()
        n_words = len(words)
        repeated = repeated_words(words)
        failed = n_words < 50 or 100 * repeated > 50 * n_words
        chars = np.frombuffer(raw.translate(None, ASCII_SPACE), np.uint8)
        word_chars = int(np.count_nonzero((chars & 0xC0) != 0x80))
        n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [line for line in raw.split(b"\n") if line.strip()]
        ratio = self.ratio(raw)
        chunk_ratios = [self.ratio(raw[a:b]) for a, b in self.bands.pieces(len(raw))]
        kept = not failed and self.bands.accepts(len(raw), ratio, chunk_ratios)
        return (n_words, word_chars, n_symbols, len(lines) - len(set(lines)), repeated, failed, kept, ratio, len(chunk_ratios))

    def ratio(self, raw: bytes) -> float:
        return len(raw) / len(self.zstd.compress(raw))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice in the text."""
    if len(words) < 4:
        return 0
    each = word_hashes(words)
    with np.errstate(over="ignore"):
        windows = mixed(mixed(mixed(each[:-2]) * ODD + each[1:-1]) * ODD + each[2:])
    order = np.argsort(windows)
    equal = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(len(windows), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= again
    return int(np.count_nonzero(covered))
