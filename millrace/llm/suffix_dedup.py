"""Substring dedup with suffix arrays: maximal repeats of at least ``LEAST`` bytes across documents.

Windows of ``LEAST`` bytes are dealt out by the least hash among their ``SEED``-byte strings, so equal
windows meet, and the neighbouring windows with one least hash travel as a single short string.

1. Documents go to block files. Each block sends the least hashes it has, four bytes each; it
   learns which of them other blocks or several of its documents have too.
2. It sends the strings of those. For all strings of one hash an enhanced suffix array (order and
   common prefix lengths) is built, over the suffixes that hold a whole window. A scan with a
   stack finds its common-prefix intervals; those whose suffixes differ in the byte before them
   are the maximal repeats, each with all strings it occurs in. Equal strings are sent once for each block, so a passage in
   very many documents is not a large group.
   Where blocks hold many strings of one hash, its windows are sent one by one instead, as 64-bit hashes without their
   bytes, dealt by these: only equal windows meet then, and no suffix array grows with the corpus.
3. Each block learns the repeats of its strings, with the least doc_id of each, and finds all their occurrences.

Texts are whole and taken as bytes; repeats never cross documents. Null text is empty. Rows without doc_id neither lose
bytes nor count as copies; rows of one doc_id are no copies of each other. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blockfiles import get, put, write_blocks
from millrace.llm.common import kept, mixed, raw_bytes

LEAST, SEED = 50, 24
REACH = LEAST - SEED + 1  # seed strings in a window
WIDTH = LEAST + REACH - 1  # longest string that travels
CHUNK = 1 << 17
#: Text bytes for each bucket of hashes.
BUCKET = 32 << 20
#: Strings of one hash, as blocks count them, beyond which its windows are dealt by their own hashes.
CROWD = 1 << 12
#: So many runs of one hash in a block count as they are; of more, the different strings are counted.
FEW = 8


# Windows and their least hashes


def seed_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the ``SEED`` bytes at each position, built by doubling."""
    h = mixed(text.astype(np.uint64) + np.uint64(0x51ED27))
    steps: dict[int, np.ndarray] = {1: h}
    size = 1
    factor = np.uint64(0x9E3779B97F4A7C15)
    while size * 2 <= SEED:
        h = steps[size]
        steps[size * 2] = h[:-size] * factor + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    done, out = size, steps[size]
    for part in sorted(steps, reverse=True):
        if done + part <= SEED:
            n = len(steps[part]) - done
            out = out[:n] * factor + (steps[part][done : done + n] ^ (steps[part][done : done + n] >> np.uint64(29)))
            done += part
    return mixed(out)


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def runs(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, window count, hash and document number of each run of windows with one least hash."""
    n = len(text) - LEAST + 1
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    begins, counts, hashes = [], [], []
    valid = np.zeros(max(n, 0) + 1, np.int8)
    long = ends - starts >= LEAST
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - LEAST + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    with np.errstate(over="ignore"):
        for a in range(0, max(n, 0), CHUNK):
            b = min(a + CHUNK, n)
            least = sliding_least(seed_hashes(text[a : b + LEAST - 1]), REACH)
            ok = valid[a:b]
            change = np.r_[True, (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])]
            at = np.flatnonzero(change)
            size = np.diff(np.r_[at, b - a])
            good = ok[at]
            at, size = at[good], size[good]
            # Runs in periodic text are cut to at most REACH windows.
            pieces = -(-size // REACH)
            first = np.repeat(at, pieces)
            k = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begins.append(first + k * REACH + a)
            counts.append(np.minimum(np.repeat(size, pieces) - k * REACH, REACH))
            hashes.append(mixed(least[first] ^ np.uint64(0xA5A5)))
    if not begins:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty
    begin = np.concatenate(begins)
    return begin, np.concatenate(counts), np.concatenate(hashes), np.searchsorted(ends, begin, side="right")


def coded(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) % np.uint64(n_buckets) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def sorted_hashes(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, low 32 bits) in order, as one number; the runs in that order; where each begins."""
    code = coded(hashes, n_buckets)
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
    return ranked[first], order, first


def by_bucket(codes: np.ndarray) -> Iterator[tuple[int, slice]]:
    bucket = (codes >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else []
    for a, b in itertools.pairwise(edges):
        yield int(bucket[a]), slice(int(a), int(b))


# Messages


def packed(**arrays: np.ndarray) -> bytes:
    """Arrays of numbers, the first bytes of all numbers before the second ones and so on: so like bytes lie together."""
    parts = [np.array([a.nbytes for a in arrays.values()], np.int64).tobytes()]
    parts += [np.ascontiguousarray(a).reshape(-1, 1).view(np.uint8).T.tobytes() for a in arrays.values()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpacked(blob: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(types), []
    for size, kind in zip(np.frombuffer(raw, np.int64, len(types)), types):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, int(size), at).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += int(size)
    return out


MESSAGE = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())])
MESSAGE_DDL = "bucket int, block long, blob binary"


def messages(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MESSAGE)] if rows else [pa.array([], f.type) for f in MESSAGE], schema=MESSAGE)


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(bucket, [(block, blob)]) from rows in order of bucket."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for bucket, group in itertools.groupby(rows, key=lambda r: r[0]):
        yield bucket, [(block, blob) for _, block, blob in group]


def met(frame: DataFrame, reduce) -> DataFrame:
    """Messages of one bucket meet in order of block; the answers, written."""
    dealt = frame.repartition("bucket").sortWithinPartitions("bucket", "block")
    return kept(dealt.mapInArrow(reduce, MESSAGE_DDL), "answers")


# The three rounds


def send_hashes(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    for block, folder in blocks_in(batches):
        data = get(folder, f"{block}.docs")
        begin, count, hashes, _ = runs(data["text"], data["ends"])
        codes, order, first = sorted_hashes(hashes, n_buckets)
        n, raw = np.diff(np.r_[first, len(order)]), data["text"].tobytes()
        for i in np.flatnonzero(n > FEW).tolist():
            at = order[first[i] : first[i] + n[i]]
            n[i] = len({raw[a:b] for a, b in zip(begin[at].tolist(), (begin[at] + count[at] + LEAST - 1).tolist())})
        low, n = (codes & np.uint64(0xFFFFFFFF)).astype("<u4"), n.astype("<u4")
        yield messages([(bucket, block, packed(low=low[s], n=n[s])) for bucket, s in by_bucket(codes)])


def blocks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    for batch in batches:
        yield from zip(batch.column("block").to_pylist(), batch.column("folder").to_pylist())


def find_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tell each block which of its hashes another block has."""
    for bucket, sent in grouped(batches):
        lows = [unpacked(blob, "<u4")[0] for _, blob in sent]
        values = np.concatenate(lows)
        order = np.argsort(values, kind="stable")
        equal = values[order[1:]] == values[order[:-1]]
        shared = np.zeros(len(values), bool)
        shared[order[1:][equal]] = True
        shared[order[:-1][equal]] = True
        answers = np.split(shared, np.cumsum([len(x) for x in lows])[:-1])
        yield messages([(bucket, block, packed(bits=np.packbits(a))) for (block, _), a in zip(sent, answers)])


def find_crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tell each block which of its hashes another block has, and which have more than ``CROWD`` strings."""
    for bucket, sent in grouped(batches):
        parts = [unpacked(blob, "<u4", "<u4") for _, blob in sent]
        values, n = (np.concatenate([p[i] for p in parts]) for i in range(2))
        _, place, holders = np.unique(values, return_inverse=True, return_counts=True)
        crowded = np.bincount(place, n) > CROWD
        edges = np.cumsum([len(p[0]) for p in parts])[:-1]
        answers = zip(np.split((holders > 1)[place], edges), np.split(crowded[place], edges))
        yield messages([(bucket, block, packed(bits=np.packbits(a), crowd=np.packbits(c))) for (block, _), (a, c) in zip(sent, answers)])


def by_window(raw: bytes, begin: np.ndarray, count: np.ndarray, hashes: np.ndarray, doc: np.ndarray, crowded: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs, those of crowded hashes cut to single windows with hashes of their own, and which are such windows."""
    n = np.where(crowded, count, 1)
    which = np.repeat(np.arange(len(n)), n)
    begin = begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    single, hashes = crowded[which], hashes[which]
    hashes[single] = np.fromiter((xxhash.xxh3_64_intdigest(raw[a : a + LEAST]) for a in begin[single].tolist()), np.uint64, int(single.sum()))
    return begin, np.where(single, 1, count[which]), hashes, doc[which], single


def send_strings(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, folder, answers in zip(*(batch.column(c).to_pylist() for c in ("block", "folder", "answers"))):
            data = get(folder, f"{block}.docs")
            text, ids = data["text"], data["ids"]
            begin, count, hashes, doc = runs(text, data["ends"])
            codes, order, first = sorted_hashes(hashes, n_buckets)
            bits = {a["bucket"]: a["blob"] for a in answers or ()}
            shared, crowd = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
            for bucket, s in by_bucket(codes):
                shared[s], crowd[s] = (np.unpackbits(b, count=s.stop - s.start) for b in unpacked(bits[bucket], "u1", "u1"))
            if len(order):
                shared |= np.minimum.reduceat(doc[order], first) != np.maximum.reduceat(doc[order], first)
            sizes = np.diff(np.r_[first, len(order)])
            # The runs to send, in order of bucket and hash.
            at = order[np.repeat(shared, sizes)]
            raw = text.tobytes()
            begin, count, hashes, doc, single = by_window(raw, begin[at], count[at], hashes[at], doc[at], np.repeat(crowd[shared], sizes[shared]))
            ends = begin + np.where(single, 0, count + LEAST - 1)  # of what travels; a single window's hash tells all of it
            strings = [raw[a:b] for a, b in zip(begin.tolist(), ends.tolist())]
            content = np.fromiter((h if s else xxhash.xxh3_64_intdigest(x) for x, h, s in zip(strings, hashes.tolist(), single.tolist())), np.uint64, len(strings))
            code = coded(hashes, n_buckets)
            by_content = np.lexsort((ids[doc], content, single, code))
            new = np.ones(len(begin), bool)
            if len(begin):
                c, d, w = content[by_content], code[by_content], single[by_content]
                new[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1]) | (w[1:] != w[:-1])
            heads = np.flatnonzero(new)
            chosen = by_content[heads]
            ids_ranked = ids[doc[by_content]]
            least = ids_ranked[heads]
            most = np.maximum.reduceat(ids_ranked, heads) if len(heads) else least
            put(folder, f"{block}.runs", {"begin": begin[by_content].astype("<i4" if len(text) < 1 << 31 else "<i8"), "new": np.packbits(new)})
            codes_sent = code[chosen]
            rows = []
            for bucket, s in by_bucket(codes_sent):
                pick = chosen[s]
                body = b"".join([strings[i] for i in pick.tolist()])
                rows.append((bucket, block, packed(
                    entry=np.array([s.start], "<i4"), hash=code[pick] & np.uint64(0xFFFFFFFF), content=content[pick].astype("<u8"),
                    least=least[s].astype("<i8"), several=(least[s] != most[s]).astype("u1"),
                    size=np.array([len(strings[i]) for i in pick.tolist()], "u1"), body=np.frombuffer(body, np.uint8))))
            if rows:
                yield messages(rows)


def find_repeats(batches: Iterator[pa.RecordBatch], named: bool = True) -> Iterator[pa.RecordBatch]:
    """Tell each block the maximal repeats of its strings: where, how long, the least doc_id, and a name.

    If not ``named``, without names, and only those of strings that some document of the block repeats from a smaller doc_id.
    """
    for bucket, sent in grouped(batches):
        parts = [unpacked(blob, "<i4", "<u8", "<u8", "<i8", "u1", "u1", "u1") for _, blob in sent]
        first, hashes, content, least, several, size, body = (np.concatenate([p[i] for p in parts]) for i in range(7))
        n_sent = np.array([len(p[1]) for p in parts])
        owner = np.repeat(np.arange(len(sent)), n_sent)
        entry = np.arange(len(owner)) + np.repeat(first - np.cumsum(n_sent) + n_sent, n_sent)
        starts = np.cumsum(size, dtype=np.int64) - size
        # Low halves of hashes, which tell apart those of a bucket but for chance; single windows, without bytes, keep to themselves.
        single = size == 0
        hashes = hashes | single.astype(np.uint64) << np.uint64(32)
        order = np.lexsort((least, content, hashes))
        h, c = hashes[order], content[order]
        new_hash = np.r_[True, h[1:] != h[:-1]]
        new = new_hash | np.r_[True, c[1:] != c[:-1]]
        heads = np.flatnonzero(new)
        string = np.cumsum(new) - 1  # by place in order: which distinct string
        first_doc = least[order][heads]
        held_by_several = (np.maximum.reduceat(least[order], heads) != first_doc) | (np.maximum.reduceat(several[order], heads) > 0)
        per_hash = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_hash))
        alone = np.repeat(per_hash == 1, per_hash) | single[order[heads]]
        lengths = np.where(single, LEAST, size.astype(np.int64))[order[heads]]
        # A string of several documents is a repeat as a whole; other repeats lie within strings of one hash.
        whole = np.flatnonzero(held_by_several)
        found = [np.stack([whole, np.zeros(len(whole), np.int64), lengths[whole], first_doc[whole], c[heads[whole]].view(np.int64)], axis=1)]
        others = np.flatnonzero(~alone)
        if len(others):
            found.append(repeats_within(others, body, starts[order[heads]], lengths, first_doc))
        found = np.concatenate(found)
        found = found[np.argsort(found[:, 0], kind="stable")]
        low, high = np.searchsorted(found[:, 0], string), np.searchsorted(found[:, 0], string, side="right")
        n = high - low
        which = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        entries, owners = np.repeat(entry[order], n), np.repeat(owner[order], n)
        if not named:
            found[:, 4] = 0
            copied = np.repeat(several[order] > 0, n) | (found[which, 3] < np.repeat(least[order], n))
            which, entries, owners = which[copied], entries[copied], owners[copied]
        rows = []
        for k, (block, _) in enumerate(sent):
            mine = owners == k
            if mine.any():
                f = found[which[mine]]
                rows.append((bucket, block, packed(
                    entry=entries[mine].astype("<i4"), at=f[:, 1].astype("u1"), size=f[:, 2].astype("u1"), least=f[:, 3].astype("<i8"), name=f[:, 4].astype("<i8"))))
        if rows:
            yield messages(rows)


def repeats_within(strings: np.ndarray, body: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first_doc: np.ndarray) -> np.ndarray:
    """Rows (string, offset, length, least doc, name) of the maximal repeats that several of the strings hold."""
    n_windows = lengths[strings] - LEAST + 1
    owner = np.repeat(strings, n_windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    rest = lengths[owner] - offset
    padded = np.r_[body, np.zeros(WIDTH, np.uint8)]
    begin = starts[owner] + offset
    order, common = suffix_order(padded, begin, rest)
    before = np.where(offset > 0, padded[np.maximum(begin - 1, 0)].astype(np.int64), -1 - owner)[order]
    owner, offset, begin, docs = owner[order], offset[order], begin[order], first_doc[owner[order]]
    out = []
    for low, high, size in intervals(common):
        left = before[low : high + 1]
        if (left[0] < 0 or (left != left[0]).any()) and docs[low : high + 1].min() != docs[low : high + 1].max():
            name = xxhash.xxh3_64_intdigest(padded[begin[low] : begin[low] + size].tobytes()) - (1 << 63)
            members = np.empty((high - low + 1, 5), np.int64)
            members[:, 0], members[:, 1], members[:, 2] = owner[low : high + 1], offset[low : high + 1], size
            members[:, 3], members[:, 4] = docs[low : high + 1].min(), name
            out.append(members)
    return np.concatenate(out) if out else np.empty((0, 5), np.int64)


def suffix_order(padded: np.ndarray, begin: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the common prefix lengths of neighbours in it."""
    windows = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)
    matrix = windows[begin]
    matrix[np.arange(WIDTH) >= rest[:, None]] = 0
    words = np.zeros((len(begin), -(-WIDTH // 8) * 8), np.uint8)
    words[:, :WIDTH] = matrix
    keys = words.view(">u8").astype(np.uint64)
    order = np.lexsort((rest, *keys.T[::-1]))
    common = np.zeros(max(len(order) - 1, 0), np.int64)
    for a in range(0, len(common), CHUNK):
        here, after = order[a : a + CHUNK], order[a + 1 : a + 1 + CHUNK]
        here = here[: len(after)]
        differs = matrix[here] != matrix[after]
        prefix = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDTH)
        common[a : a + len(after)] = np.minimum(prefix, np.minimum(rest[here], rest[after]))
    return order, common


def intervals(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals of at least ``LEAST`` (first, last, length), by a scan with a stack."""
    stack: list[tuple[int, int]] = []  # (first, length), lengths rising
    for i in np.flatnonzero(common >= LEAST).tolist():
        size = int(common[i])
        if stack and i and common[i - 1] < LEAST:
            stack = []
        low = i
        while stack and stack[-1][1] > size:
            low, longer = stack.pop()
            yield low, i, longer
        if not stack or stack[-1][1] < size:
            stack.append((low, size))
        if i + 1 == len(common) or common[i + 1] < LEAST:
            while stack:
                low, longer = stack.pop()
                yield low, i + 1, longer


def found_repeats(docs: DataFrame, reduce=find_repeats) -> DataFrame:
    """The blocks, each with the repeats of its strings."""
    blocks = write_blocks(docs)
    facts = blocks.agg(F.count("*"), F.sum("n_bytes")).first()
    n_blocks, n_buckets = max(1, facts[0]), max(64, -(-(facts[1] or 0) // BUCKET))
    spread = blocks.repartition(n_blocks)

    def answered(answers: DataFrame) -> DataFrame:
        # Dealt by block once, for the lists and the join.
        lists = answers.repartition(n_blocks, "block").groupBy("block").agg(F.collect_list(F.struct("bucket", "blob")).alias("answers"))
        return blocks.repartition(n_blocks, "block").join(lists, "block", "left").select("block", "folder", "answers")

    shared = met(spread.mapInArrow(lambda b: send_hashes(b, n_buckets), MESSAGE_DDL), find_crowded)
    repeats = met(answered(shared).mapInArrow(lambda b: send_strings(b, n_buckets), MESSAGE_DDL), reduce)
    return answered(repeats)


def occurrences_in(block: int, folder: str, answers: list[dict] | None):
    """The block's data, and for every occurrence of a repeat: document number, begin, length, least doc_id, name."""
    data = get(folder, f"{block}.docs")
    if not answers:
        empty = np.zeros(0, np.int64)
        return data, empty, empty, empty, empty, empty
    held = get(folder, f"{block}.runs")
    begin = held["begin"].astype(np.int64)
    doc, own = np.searchsorted(data["ends"], begin, side="right"), np.cumsum(np.unpackbits(held["new"], count=len(begin)), dtype=np.int64) - 1
    parts = [unpacked(a["blob"], "<i4", "u1", "u1", "<i8", "<i8") for a in answers]
    entry, at, size, least, name = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(5))
    order = np.argsort(entry, kind="stable")
    low, high = np.searchsorted(entry[order], own), np.searchsorted(entry[order], own, side="right")
    n = high - low
    which = order[np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
    return data, np.repeat(doc, n), np.repeat(begin, n) + at[which], size[which], least[which], name[which]


def repeats(docs: DataFrame) -> DataFrame:
    """``repeat_id, doc_id, start, length, first_doc`` of every occurrence of every maximal repeat of two or more documents.

    Repeats are maximal within the strings that meet; a longer one shows as several that overlap, and one of a
    crowded hash as its windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                data, doc, begin, size, least, name = occurrences_in(*row)
                starts = np.r_[0, data["ends"]]
                yield pa.RecordBatch.from_pydict(
                    {"repeat_id": name, "doc_id": data["ids"][doc], "start": begin - starts[doc], "length": size, "first_doc": least})

    known = docs.where("doc_id IS NOT NULL")
    return found_repeats(known).mapInArrow(run, "repeat_id long, doc_id long, start long, length long, first_doc long")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row: bytes that an earlier document repeats go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                data, doc, begin, size, least, _ = occurrences_in(*row)
                copy = least < data["ids"][doc]
                change = np.zeros(len(data["text"]) + 1, np.int64)
                np.add.at(change, begin[copy], 1)
                np.add.at(change, begin[copy] + size[copy], -1)
                gone = np.cumsum(change[:-1]) > 0
                rows, start = [], 0
                for doc_id, end in zip(data["ids"].tolist(), data["ends"].tolist()):
                    mask = gone[start:end]
                    spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(bool(len(mask)) and bool(mask[0]))
                    rows.append((doc_id, end - start, int(np.count_nonzero(mask)), spans, data["text"][start:end][~mask].tobytes()))
                    start = end
                yield pa.RecordBatch.from_pydict(dict(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept"), zip(*rows))))

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    found = found_repeats(docs.where("doc_id IS NOT NULL"), lambda b: find_repeats(b, named=False)).mapInArrow(run, ddl)
    rest = docs.where("doc_id IS NULL").select(raw_bytes().alias("kept"))
    size, none = F.length("kept").cast("long"), F.lit(0).cast("long")
    return found.unionByName(rest.select(F.lit(None).cast("long").alias("doc_id"), size.alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), "kept"))

