"""Token ids of whole texts by a tokenizer file, with remembered words.

Words repeat, so each worker keeps the ids of the words it has met and asks the tokenizer only for
new ones. A text whose white space makes the cut into words unsafe is encoded whole; the ids are the same.
For byte-level tokenizers, each different word of some megabytes of text is looked up once, and ids are gathered by its number.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.common import kept, memories, take_up


#: Letters below have one lower-case letter each, whatever stands beside them, and are composed already.
LATIN_END = "\u0130"
#: Punctuation that is cut off a word's end, unless an added token has it.
TRAILING = ".,!?;:*#$%&"
#: Bytes of text whose different words are looked up at once; a longer text is encoded by itself.
PORTION = 1 << 23


class Unsafe(Exception):
    """A chunk whose ids may depend on its neighbours."""


class Remembered(dict):
    """Ids by chunk, in two generations: when the young one is full, it replaces the old one."""

    LIMIT = 300_000

    def __init__(self, coder: Encoder, prefix: str = ""):
        super().__init__()
        self.coder, self.prefix, self.old = coder, prefix, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            core = chunk.rstrip(self.coder.trailing)
            if core != chunk and core and core[-1].isalpha() and chunk == chunk.lstrip():
                # punctuation after a letter is a piece of its own
                seen = core in self
                ids = self[core] + self.coder.marks[chunk[len(core) :]]
                if not seen:  # a rare word: remembered without its punctuation only
                    return ids
            else:
                ids = self.made(chunk)
        self.remember(chunk, ids)
        return ids

    def made(self, chunk: str) -> bytes:
        if chunk.isalpha():  # no white space then
            if chunk.isascii() or max(chunk) < LATIN_END:
                return self.coder.letters(self.prefix, chunk)
        elif not chunk or chunk != chunk.strip():
            raise Unsafe
        return self.coder.whole(self.prefix + chunk)

    def remember(self, chunk: str, ids: bytes) -> None:
        if len(self) >= self.LIMIT:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids

    def of_each(self, chunks: list[str]) -> list[bytes | None]:
        """Ids of different chunks, which have no punctuation to cut off; none where a chunk is unsafe."""
        found = list(map(self.get, chunks))
        left = [i for i, ids in enumerate(found) if ids is None]
        new = [chunks[i] for i in left]
        for i, chunk, ids in zip(left, new, list(map(self.old.get, new))):
            if ids is None:
                try:
                    ids = self.made(chunk)
                except Unsafe:
                    continue
            found[i] = ids
            if len(self) >= self.LIMIT:
                self.remember(chunk, ids)
            else:
                self[chunk] = ids
        return found


class Marks(dict):
    """Ids of runs of punctuation."""

    def __init__(self, coder: Encoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, run: str) -> bytes:
        ids = self.coder.whole(run)
        if len(run) < 16:
            self[run] = ids
        return ids


def byte_alphabet() -> dict[int, str]:
    """The letters that byte-level models write bytes with: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        with open(path) as file:
            spec = json.load(file)
        before, normal = spec["pre_tokenizer"] or {}, spec["normalizer"]
        if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
            self.encode = self.by_lines
        elif before.get("type") == "Sequence" and before["pretokenizers"][0].get("behavior") == "Removed":
            self.encode = self.by_words
        else:
            self.encode = self.whole
        self.lower = self.encode == self.by_words
        self.cutting = [t["content"] for t in spec["added_tokens"]]
        self.added = [t.lower() for t in self.cutting]
        self.trailing = "".join(c for c in TRAILING if not any(c in t for t in self.added))
        self.tokenize = self.model.tokenize
        self.pieces = [i.to_bytes(self.dtype.itemsize, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        self.marks = Marks(self)
        self.first, self.inner = Remembered(self), Remembered(self, " ")
        self.breaks: dict[tuple[int, bool], bytes] = {}

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, prefix: str, word: str) -> bytes:
        """Ids of Latin letters: one piece, which the model itself can cut without the steps before it."""
        raw = word.lower() if self.lower else word
        if not raw.isascii():  # ASCII letters are their own bytes' letters
            raw = raw.encode().decode("latin-1").translate(self.alphabet)
        tokens = self.tokenize(self.alphabet[32] + raw if prefix else raw)
        return self.pieces[tokens[0].id] if len(tokens) == 1 else b"".join([self.pieces[t.id] for t in tokens])

    def by_words(self, text: str) -> bytes:
        """For tokenizers that drop white space: pieces never reach across it."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python only
            return self.whole(text)
        return b"".join(map(self.first.__getitem__, self.lowered(text).split()))

    def lowered(self, text: str) -> str:
        """The text in lower case, where that is sure to change no ids, so that fewer different words are met."""
        try:
            text.encode("latin-1")  # letters beyond may be composed with their neighbours, or have several forms
        except UnicodeEncodeError:
            return text
        low = text.lower()
        return text if any(t in low for t in self.added) else low

    def by_lines(self, text: str) -> bytes:
        """For byte-level tokenizers: a piece begins at every single space or line break between other characters."""
        if "\n\n" in text and any(t in text for t in self.cutting):  # a run of line breaks before one is a piece
            return self.whole(text)
        out, empty, begun = [], 0, False
        try:
            for line in text.split("\n"):
                if not line:
                    empty += 1
                    continue
                if begun or empty:
                    out.append(self.line_breaks(empty + begun, False))
                begun, empty = True, 0
                head, *rest = line.split(" ")
                out.append(self.first[head])
                out.extend(map(self.inner.__getitem__, rest))
        except Unsafe:
            return self.whole(text)
        if empty:
            out.append(self.line_breaks(empty - (not begun), True))
        return b"".join(out)

    def texts(self, column: pa.Array, end: bytes) -> Iterator[pa.Array]:
        """Ids of texts, each with ``end`` after them; null is empty."""
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, a = np.cumsum(sizes), 0
        while a < len(sizes):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PORTION, side="right")))
            part = column.slice(a, b - a)
            if self.encode == self.by_lines and upto[b - 1] - upto[a] + sizes[a] <= PORTION:
                yield self.gathered(part.cast(pa.string()).fill_null(""), end)
            else:
                yield pa.array([self.encode(t or "") + end for t in part.to_pylist()], pa.binary())
            a = b

    def gathered(self, column: pa.Array, end: bytes) -> pa.Array:
        """Ids by the numbers of chunks: words between single spaces, the first ones of lines with the line break before."""
        chunks = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        begins, coded = chunks.offsets.to_numpy()[:-1], chunks.values.dictionary_encode()
        ids, sizes, unsafe = self.of_chunks(coded.dictionary)
        number = coded.indices.to_numpy().astype(np.int64)
        whole = np.logical_or.reduceat(unsafe[number], begins)
        # A text's first word has no space before it; a text that isn't cut is one chunk.
        heads = coded.dictionary.take(pa.array(number[begins])).to_pylist()
        more = [self.encode(column[i].as_py()) if whole[i] else self.first[head] for i, head in enumerate(heads)] + [end]
        number[begins] = np.arange(len(sizes), len(sizes) + len(begins))
        if whole.any():
            left = ~np.repeat(whole, np.diff(np.r_[begins, len(number)]))
            left[begins] = True
            number, begins = number[left], (np.cumsum(left) - 1)[begins]
        number = np.insert(number, np.r_[begins[1:], len(number)], len(sizes) + len(more) - 1)
        flat, more_sizes = self.flat(more)
        out, n = taken(np.concatenate([ids, flat]), np.concatenate([sizes, more_sizes]), number)
        ends = np.cumsum(np.add.reduceat(n, begins + np.arange(len(begins)))) * self.dtype.itemsize
        return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(np.r_[0, ends].astype("<i4")), pa.py_buffer(out)])

    def of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different chunks without spaces, one after another, how many each has, and whether it is unsafe."""
        cores = pc.utf8_rtrim(chunks, characters=self.trailing)
        cut = pc.and_(pc.utf8_is_alpha(pc.utf8_slice_codeunits(cores, -1)), pc.not_equal(cores, chunks))
        coded = pc.if_else(cut, cores, chunks).dictionary_encode()
        words, heads = strings(coded.dictionary), []
        for i in np.flatnonzero(pc.starts_with(coded.dictionary, "\n").to_numpy(zero_copy_only=False)).tolist():
            heads.append((i, words[i]))
            words[i] = ""
        found = self.inner.of_each(words)
        for i, head in heads:
            try:
                found[i] = self.line_breaks(1, False) + self.first[head[1:]]
            except Unsafe:
                pass
        word = coded.indices.to_numpy()
        unsafe = np.fromiter((ids is None for ids in found), bool, len(found))[word]
        at = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        lengths = pc.utf8_length(cores).to_numpy()[at].tolist()
        runs = pa.array([c[n:] for c, n in zip(strings(chunks.take(pa.array(at))), lengths)], pa.string()).dictionary_encode()
        parts = [ids or b"" for ids in found] + [b""] + [self.marks[run] for run in runs.dictionary.to_pylist()]
        mark = np.full(len(chunks), len(found), np.int64)
        mark[at] += 1 + runs.indices.to_numpy()
        ids, n = taken(*self.flat(parts), np.stack([word, mark], axis=1).ravel())
        return ids, n[::2] + n[1::2], unsafe

    def flat(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), self.dtype), np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize

    def line_breaks(self, n: int, last: bool) -> bytes:
        """A run of line breaks: all but the last one are a piece, if text follows."""
        if n == 0:
            return b""
        if (n, last) not in self.breaks:
            runs = [n] if last else [n - 1, 1]
            self.breaks[n, last] = b"".join(self.whole("\n" * k) for k in runs if k)
        return self.breaks[n, last]


def taken(ids: np.ndarray, sizes: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the numbered ones of parts that lie one after another, and how many each has."""
    n = sizes[number]
    upto = np.cumsum(n)
    return ids[np.repeat((np.cumsum(sizes) - sizes)[number] - (upto - n), n) + np.arange(n.sum())], n


def strings(column: pa.Array) -> list[str]:
    """The strings of a column that hold no space."""
    if not len(column):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column), " ")[0].as_py().split(" ")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


memories.append((encoder, encoder.cache_clear))


def token_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, part, seq, n_tokens, ids`` of every row, written once: its ids and the end id.

    ``part`` and ``seq`` name a row, also where doc_id is null or repeated. Null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_up(encoder)
        coder, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in batches:
            at = 0
            for ids in coder.texts(batch.column(1), end):
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()),
                     pc.divide(pc.binary_length(ids).cast(pa.int64()), coder.dtype.itemsize), ids],
                    names=["doc_id", "part", "seq", "n_tokens", "ids"],
                )
                seq, at = seq + n, at + n

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ddl = "doc_id long, part int, seq long, n_tokens long, ids binary"
    return kept(rows.mapInArrow(run, ddl), "tokens")


def id_type(path: str) -> np.dtype:
    return np.dtype("<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4")


def crc_of(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes(), before)
