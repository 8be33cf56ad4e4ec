"""N-gram Jaccard join, aware of set sizes: small sets meet by enumerated subsets, large ones in inverted lists.

A document's set holds the hashes of its distinct three-word shingles (A-Z lower-cased). Sets link
when ``100 * |x & y| >= percent * |x | y|``. Equal sets are one class and go on as one.

First, sets that can link with none go: most elements of a set that links are elements of others too. Of
large sets the ``PROBE`` least elements are looked up; one that links has fewer of them elsewhere than
asked for with a chance of ``CHANCE`` only. What is left is a small part of ordinary text, and only that
part's texts are gathered and get keys.

* Small sets enumerate two-element subsets: sets that link share at least two of the first
  ``s - ceil(t s) + 2`` elements in hash order, since they overlap in ``t s`` elements or more.
* Large sets scan inverted lists. Linked sets, the larger of size band b, differ in at most
  ``k`` elements. Elements are dealt to ``m > k`` parts by hash, so ``m - k`` parts hold the same
  elements in both; a list holds the sets with one part in common. Sets with so many empty parts
  that only those might agree meet by single elements too.
* The boundary is the size up to which subsets cost fewer keys than lists.

Sets of a list form a group under the list's least set. A group with many elements is cut into
blocks, and every two blocks are compared in a task of their own, so nothing is left out and no
task holds more than two blocks. Tasks return a spanning forest of the links, not pairs.

Null text and text without words have no set and link with nothing. Rows without doc_id come back
with a null component. Rows that share a doc_id are one document: each has its own set, and they share a component.
Empty tables give empty results; extra columns are ignored, and pass through ``one_of_each``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ODD, columns_of, fill_batches, kept, mixed, raw_bytes, shingle_hashes
from millrace.llm.components import components_of

WORDS = 3
PERCENT = 90
#: A band of sizes reaches from its first size to half as many more.
GROWTH = 1.5
#: Elements of a set that are looked up in others, and the chance to miss one that links.
PROBE, CHANCE = 64, 1e-9
#: Shingles in one block of a group.
BLOCK = 1 << 20


class Plan:
    """Which keys a set of a given size gets, for one threshold."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        # One element more or less already breaks the threshold for smaller sets: only equal ones link.
        self.least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
        self.boundary = self._boundary()
        #: Of the least ``PROBE`` elements of a union, so many at least are in both sets.
        self.probed, share, chance = 0, percent / 100, 0.0
        while (chance := chance + math.comb(PROBE, self.probed) * share**self.probed * (1 - share) ** (PROBE - self.probed)) <= CHANCE:
            self.probed += 1

    def elsewhere(self, n: Column) -> Column:
        """So many of the probed elements of a set that links are probed elements of others."""
        whole = F.ceil(n * self.percent / F.lit(100))
        return F.when(n < PROBE * self.percent // 100, whole).otherwise(F.least(whole, F.lit(self.probed)))

    def overlap(self, size: int) -> int:
        """Elements that a set of this size shares at least with any set it links to."""
        return -(-self.percent * size // 100)

    def bands(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(band, differing elements at most, parts) of the set's own band and of the next, if it can link into it."""
        band, first, after = 0, self.least, int(self.least * GROWTH) + 1
        while first * self.percent <= size * 100:
            if size < after:
                k = (after - 1) * (100 - self.percent) // self.percent
                yield band, k, k + 3 + k // 8
            band, first, after = band + 1, after, int(after * GROWTH) + 1

    def subset_keys(self, size: int) -> int:
        n = size - self.overlap(size) + 2
        return n * (n - 1) // 2

    def _boundary(self) -> int:
        size = self.least
        while size < 1 << 20 and self.subset_keys(size) <= sum(m for _, _, m in self.bands(size)):
            size += 1
        return size - 1

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """List keys of a set given as sorted distinct hashes."""
        size = len(elements)
        found: list[np.ndarray] = []
        with np.errstate(over="ignore"):
            if self.least <= size <= self.boundary:
                head = elements[: size - self.overlap(size) + 2]
                pairs = np.array(list(combinations(range(len(head)), 2)))
                found.append(mixed(mixed(head[pairs[:, 0]]) * ODD + head[pairs[:, 1]]))
            if size >= self.least and size * 100 >= self.boundary * self.percent:
                for band, k, m in self.bands(size):
                    found.extend(part_keys(elements, band, k, m, size - self.overlap(size) + 1))
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def part_keys(elements: np.ndarray, band: int, k: int, m: int, head: int) -> Iterator[np.ndarray]:
    scattered = mixed(elements + np.uint64(band + 1))
    part = (scattered >> np.uint64(20)) % np.uint64(m)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    content = np.add.reduceat(mixed(scattered[order]), starts)
    yield mixed(content + mixed(part[starts] + np.uint64((band + 1) << 40)))
    if m - len(starts) >= m - k:
        yield mixed(elements[:head] + np.uint64((band + 1) << 50))


def set_of(raw: bytes, words: int = WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(raw.lower().split(), words))


def sign(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of every row.

    ``class_id`` is the least doc_id with the same set, ``component_id`` the least reachable by links.
    """
    plan = Plan(percent)
    docs = docs.select(F.col("doc_id").cast("long"), raw_bytes().alias("t"))
    sets = kept(docs.mapInArrow(lambda b: signed(b, words), "doc_id long, n long, sig binary, low array<long>"), "sets")
    first = F.min(F.struct("doc_id", "n", "low")).alias("x")
    classes = sets.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(first)
    classes = kept(classes.select(F.monotonically_increasing_id().alias("id"), "sig", "x.*"), "classes")
    likely = kept(may_link(classes, plan), "likely")
    # One plan at every size: a broadcast would serve small inputs only.
    texts = kept(docs.join(likely.hint("merge"), "doc_id").select("id", "sig", "n", "t"), "texts")
    keyed = kept(texts.mapInArrow(lambda b: keys_of(b, percent, words), "id long, keys array<long>"), "keys")
    postings = keyed.select("id", F.explode("keys").alias("key"))
    heads = postings.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("other")).where("pivot <> other")
    members = kept(postings.join(heads.drop("other"), "key").select("pivot", "id").distinct(), "members")
    links = kept(linked(texts, likely, members, percent, words), "links")
    return components_of(sets, classes, links).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), F.col("component").alias("component_id")
    )


def may_link(classes: DataFrame, plan: Plan) -> DataFrame:
    """``id, sig, n, doc_id`` of the classes whose probed elements are found in other classes often enough."""
    probed = classes.select("id", F.explode("low").alias("value"))
    shared = probed.groupBy("value").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("value")
    found = probed.join(shared, "value").groupBy("id").agg(F.count("*").alias("found"))
    return classes.join(found, "id").where(F.col("found") >= plan.elsewhere(F.col("n"))).select("id", "sig", "n", "doc_id")


def signed(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [set_of(t, words) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([sign(s) for s in sets], pa.binary()),
             long_lists([s[:PROBE] for s in sets])],
            names=["doc_id", "n", "sig", "low"],
        )


def keys_of(batches: Iterator[pa.RecordBatch], percent: int, words: int) -> Iterator[pa.RecordBatch]:
    plan = Plan(percent)
    for batch in batches:
        ids, keys = [], []
        for id_, sig, text in zip(*(batch.column(c).to_pylist() for c in ("id", "sig", "t"))):
            elements = set_of(text, words)
            if sign(elements) == sig:  # not another text of the same doc_id
                ids.append(id_)
                keys.append(plan.keys(elements))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), long_lists(keys)], names=["id", "keys"])


def long_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([*(a.view(np.int64) for a in arrays), np.empty(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def linked(texts: DataFrame, likely: DataFrame, members: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (u, v) within each group, as a spanning forest of every pair of blocks."""
    members = members.join(likely.select("id", "n"), "id")
    blocks = members.groupBy("pivot").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("n_blocks"))
    placed = members.join(blocks, "pivot").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    placed = placed.select(
        "id", "pivot", "own", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("with")
    ).select("id", "pivot", "own", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    dealt = placed.join(texts, "id").repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "id")
    return dealt.select("pivot", "i", "j", "own", "id", "sig", "t").mapInArrow(
        lambda batches: compare(batches, percent, words), "u long, v long"
    )


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def compare(batches: Iterator[pa.RecordBatch], percent: int, words: int) -> Iterator[pa.RecordBatch]:
    def rows():
        group, held = None, []
        for batch in batches:
            for pivot, i, j, own, id_, sig, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (pivot, i, j) != group:
                    yield from forest(held, percent)
                    group, held = (pivot, i, j), []
                elements = set_of(text, words)
                if sign(elements) == sig and not (held and held[-1][1] == id_):  # not another text of the doc_id, nor a copy
                    held.append((len(elements), id_, i == j or own == i, i == j or own == j, elements))
        yield from forest(held, percent)

    return fill_batches(LINKS, rows())


def forest(held: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links that join what links join in one group; pairs already joined through others are skipped."""
    if len(held) < 2:
        return []
    held.sort(key=lambda h: h[:2])
    sizes = np.array([h[0] for h in held])
    left, right = np.array([h[2] for h in held]), np.array([h[3] for h in held])
    whole = np.concatenate([h[4] for h in held])
    _, token = np.unique(whole, return_inverse=True)
    owner = np.repeat(np.arange(len(held)), sizes)
    order = np.argsort(token, kind="stable")
    lists, bounds = owner[order], np.r_[0, np.cumsum(np.bincount(token))]
    tokens = np.split(token, np.cumsum(sizes)[:-1])
    root = np.arange(len(held))
    out = []
    for x in range(1, len(held)):
        low = int(np.searchsorted(sizes[:x], -(-percent * sizes[x] // 100)))
        open_ = np.flatnonzero((root[low:x] != root[x]) & ((left[x] & right[low:x]) | (right[x] & left[low:x]))) + low
        if not len(open_):
            continue
        found = np.concatenate([lists[bounds[t] : bounds[t + 1]] for t in tokens[x]])
        shared = np.bincount(found, minlength=len(held))[open_]
        for y in open_[100 * shared >= percent * (sizes[x] + sizes[open_] - shared)]:
            if root[y] != root[x]:
                out.append((held[x][1], held[y][1]))
                root[root == root[x]] = root[y]
    return out


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents whose doc_id is their component's; rows without doc_id stay."""
    first = components(docs, percent, words).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(*columns_of(docs)).unionByName(docs.where("doc_id IS NULL"))
