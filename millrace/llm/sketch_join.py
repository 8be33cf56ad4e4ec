"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct five-word shingles (A-Z lower-cased; fewer words are
one shingle). Its sketch is the ``SKETCH`` least hashes. Sets link when
``100 * |x & y| >= percent * |x | y|``; equal sets are one class and go on as one.

1. Inverted lists of retained values: a class is listed under its ``LISTED`` least hashes, or as many as
   make sure that any set it links to has one of them. Linked sets without a common one among twelve have
   a chance of ``(1 - percent / 100) ** 12``.
2. Long lists, of shingles that many texts hold, say little. Classes in one are listed anew, under all
   the values of their sketch that are in short lists, and under those of long ones only as far as they
   need them: sketches of linked sets share ``Plan.least`` values or more, up to a chance of ``CHANCE``, so
   any ``SKETCH - least + 1`` of them, in an order that all follow, hold a common one. Long lists are
   divided by the size of the sets.
3. The classes of a list form a group under the list's least class. Within a task, lists of retained values
   count overlaps, and the lowest part of the united sketches estimates the similarity. First only sketches are
   sent to the groups; classes that reach the threshold with no other (again up to ``CHANCE``) go. The texts
   of those that stay follow, and links are confirmed on the full sets. Groups are compared from one
   member to the others, and a member that links join already is not compared with its own.
4. A group with more than ``BLOCK`` shingles is cut into parts. First each meets the least class only;
   then classes that do not link to it meet all parts, two parts a task. Nothing is left out, no
   task holds more than two parts, and large groups of near copies cost in proportion to their size.

Null text and text without words have an empty set and link with nothing. Rows without doc_id come back
with a null component and are kept. Rows that share a doc_id are one document: each has its own set, and they
share a component. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns_of, fill_batches, kept, raw_bytes, shingle_hashes
from millrace.llm.components import components_of

WORDS, PERCENT = 5, 85
SKETCH, LISTED = 64, 12
CHANCE = 1e-9
#: Members of a list that is not long.
CROWD = 100
#: Tasks among which the members of a long list are dealt.
SALTS = 32
#: Shingles in one part of a group.
BLOCK = 1 << 20
#: Sets that one is compared with at once, at most.
LOT = 256
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Plan:
    """Numbers that follow from the threshold."""

    def __init__(self, percent: int = PERCENT):
        if not 1 <= percent <= 100:
            raise ValueError("percent is between 1 and 100")
        self.percent, share, chance = percent, percent / 100, 0.0
        #: Values among the least ``SKETCH`` of a union that both sets have, if they link.
        self.least = 0
        while (chance := chance + math.comb(SKETCH, self.least) * share**self.least * (1 - share) ** (SKETCH - self.least)) <= CHANCE:
            self.least += 1

    def certain(self, n: Column) -> Column:
        """So many of the first elements of a set, in any order, hold one of each set that it links to."""
        return n - F.ceil(n * self.percent / F.lit(100)) + 1

    def listed(self, n: Column) -> Column:
        return F.least(self.certain(n), F.lit(LISTED)).cast("int")

    def listed_again(self, n: Column) -> Column:
        partial = F.least(n, F.lit(SKETCH)) - self.least + 1
        return F.when(n < SKETCH * self.percent // 100, self.certain(n)).otherwise(F.greatest(partial, self.certain(n))).cast("int")

    def band(self, n: Column) -> Column:
        """Sizes of linked sets lie in one band or in neighbouring ones."""
        width = 1.001 * math.log(100 / self.percent) if self.percent < 100 else 1.0
        return F.floor(F.log(n.cast("double")) / F.lit(width))


def set_of(raw: bytes, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(raw.lower().split(), words))


def sign(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def sketched(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [set_of(t, words) for t in batch.column(1).to_pylist()]
        low = [s[:SKETCH].view(np.int64) for s in sets]
        ends = np.cumsum([0, *map(len, low)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(sign, sets), pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*low, np.empty(0, np.int64)])))],
            names=["doc_id", "n", "sig", "sketch"],
        )


def components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` of every row.

    ``class_id`` is the least doc_id with the same set, ``component_id`` the least reachable by links.
    """
    plan = Plan(percent)
    docs = docs.select(F.col("doc_id").cast("long"), raw_bytes().alias("t"))
    sets = kept(docs.mapInArrow(lambda b: sketched(b, words), "doc_id long, n long, sig binary, sketch array<long>"), "sketches")
    first = F.min(F.struct("doc_id", "n", "sketch"))
    classes = sets.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(first.alias("x"))
    classes = kept(classes.select(F.monotonically_increasing_id().alias("id"), "sig", "x.*"), "classes")
    members = kept(listed_together(classes, plan), "members")
    links = linked(docs, classes, members, plan, words)
    return components_of(sets, classes, links).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def listed_together(classes: DataFrame, plan: Plan) -> DataFrame:
    """``pivot, id``: classes that share a list, under the least of them."""
    n = F.col("n")
    heads = classes.select("id", F.explode(F.slice("sketch", 1, plan.listed(n))).alias("value"))
    lists = heads.groupBy("value").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    met = kept(heads.join(lists, "value").select("id", "pivot", "size"), "listed")
    short = met.where(F.col("size") <= CROWD).select("pivot", "id")

    crowded = met.where(F.col("size") > CROWD).select("id").distinct()
    values = classes.join(crowded, "id").select("id", "n", F.explode("sketch").alias("value"))
    sizes = values.groupBy("value").agg(F.count("*").alias("size"))
    rated = values.join(sizes, "value").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct((F.col("size") > CROWD).alias("crowd"), "value", "size"))).alias("v")
    )
    chosen = rated.select("id", "n", F.explode(F.slice("v", 1, plan.listed_again(n))).alias("v")).where("v.size > 1")
    by_band = F.array(F.xxhash64("v.value", plan.band(n)), F.xxhash64("v.value", plan.band(n) + 1))
    keys = F.explode(F.when(F.col("v.crowd"), by_band).otherwise(F.array("v.value"))).alias("key")
    keyed = kept(chosen.select("id", F.col("v.crowd").alias("crowd"), keys), "listed-again")
    lists = keyed.groupBy("key", "crowd").agg(F.min("id").alias("pivot"), F.max("id").alias("other")).where("pivot <> other")
    # Members of one long list meet its pivot in several tasks.
    salts = F.when(F.col("crowd"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    lists = lists.select("key", "crowd", "pivot", F.explode(salts).alias("salt"))
    salt = F.when(F.col("crowd"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0).cast("int")
    again = keyed.withColumn("salt", salt).join(lists, ["key", "crowd", "salt"]).select("pivot", "id")
    return short.unionByName(again).distinct()


def linked(docs: DataFrame, classes: DataFrame, members: DataFrame, plan: Plan, words: int) -> DataFrame:
    """Links (u, v) that join what links join within each group."""
    sized = kept(members.join(classes.select("id", "n"), "id"), "sized")
    groups = sized.groupBy("pivot").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts"))
    groups = kept(groups, "groups")
    sized = sized.join(groups, "pivot")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    everywhere = F.when(F.col("id") == F.col("pivot"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    placed = sized.select("*", F.explode(everywhere).alias("i")).withColumns({"j": F.col("i"), "own": F.col("i")})
    links = kept(compared(docs, classes, placed, plan, words), "links")
    if groups.where("parts > 1").isEmpty():
        return links

    stars = links.select(F.col("u").alias("pivot"), F.col("v").alias("id"), F.lit(True).alias("tied"))
    rest = sized.where("parts > 1 AND id <> pivot").join(stars, ["pivot", "id"], "left").withColumn("tied", F.coalesce("tied", F.lit(False)))
    parts = rest.groupBy("pivot").agg(
        F.ceil(F.sum(F.when(~F.col("tied"), F.col("n"))) / BLOCK).cast("int").alias("free"),
        F.coalesce(F.ceil(F.sum(F.when(F.col("tied"), F.col("n"))) / BLOCK), F.lit(0)).cast("int").alias("bound"),
    ).where("free > 0")
    # Free classes meet all parts, those tied to the pivot only the free ones, which are numbered first.
    rest = rest.join(parts, "pivot").withColumn(
        "own", F.when(F.col("tied"), F.col("free") + F.pmod(F.xxhash64("id"), F.greatest("bound", F.lit(1))))
        .otherwise(F.pmod(F.xxhash64("id"), F.col("free"))).cast("int")
    )
    last = F.when(F.col("tied"), F.col("free")).otherwise(F.col("free") + F.col("bound")) - 1
    pairs = rest.select("*", F.explode(F.sequence(F.lit(0), last)).alias("with"))
    pairs = pairs.select("pivot", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", F.lit(1).alias("parts"), "id")
    return links.unionByName(kept(compared(docs, classes, pairs, plan, words), "links"))


def compared(docs: DataFrame, classes: DataFrame, placed: DataFrame, plan: Plan, words: int) -> DataFrame:
    """Links within each cell (pivot, i, j) of groups: by sketches who may link at all, then by texts who does."""
    cell = ["pivot", "i", "j"]
    low = placed.select(*cell, "own", "parts", "id").join(classes.select("id", "n", "sketch"), "id")
    low = low.repartition(*cell).sortWithinPartitions(*cell, "id").select(*cell, "own", "parts", "id", "n", "sketch")
    stay = kept(low.mapInArrow(lambda batches: thin(batches, plan), "pivot long, i int, j int, own int, parts int, id long"), "stay")
    rows = stay.join(classes.select("id", "sig", "doc_id"), "id").join(docs, "doc_id")
    rows = rows.repartition(*cell).sortWithinPartitions(*cell, "id").select(*cell, "own", "parts", "id", "sig", "t")
    return rows.mapInArrow(lambda batches: compare(batches, plan, words), "u long, v long")


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
STAY = pa.schema([("pivot", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("own", pa.int32()), ("parts", pa.int32()), ("id", pa.int64())])


def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], int, Iterator[tuple]]]:
    """(pivot, i, j), how many parts the group has, and the cell's rows from ``own`` on."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for (*cell, parts), group in groupby(rows, key=lambda r: (*r[:3], r[4])):
        yield tuple(cell), parts, ((r[3], *r[5:]) for r in group)


def thin(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    def rows():
        for cell, parts, members in by_cell(batches):
            group = Group(plan, cell[0] if parts > 1 else None)
            for own, id_, n, sketch in members:
                group.add(id_, n, np.array(sketch, np.int64).view(np.uint64), own == cell[1], own == cell[2])
            for k in group.may_link():
                left, _ = group.sides[k]
                yield *cell, cell[1] if left else cell[2], parts, group.ids[k]

    return fill_batches(STAY, rows())


def compare(batches: Iterator[pa.RecordBatch], plan: Plan, words: int) -> Iterator[pa.RecordBatch]:
    def rows():
        for cell, parts, members in by_cell(batches):
            group, sets = Group(plan, cell[0] if parts > 1 else None), {}
            for own, id_, sig, text in members:
                elements = set_of(text, words)
                if sign(elements) == sig:  # not another text of the same doc_id
                    group.add(id_, len(elements), elements[:SKETCH], own == cell[1], own == cell[2])
                    sets[id_] = elements
            yield from group.links(sets)

    return fill_batches(LINKS, rows())


def shared_with(mine: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements of a sorted set each of the other sets holds; none of the sets is empty."""
    ends = np.cumsum([len(s) for s in others])
    elements = np.concatenate(others)
    at = mine.searchsorted(elements)
    at[at == len(mine)] = 0
    return np.add.reduceat((mine[at] == elements).astype(np.int64), np.r_[0, ends[:-1]])


class Group:
    """Classes that may link, in one task: all with each other, two parts with each other, or one class with the rest."""

    def __init__(self, plan: Plan, star: int | None = None):
        self.plan, self.star = plan, star
        self.ids: list[int] = []
        self.sizes: list[int] = []
        self.low: list[np.ndarray] = []
        self.sides: list[tuple[bool, bool]] = []

    def add(self, id_: int, size: int, low: np.ndarray, left: bool, right: bool) -> None:
        if not self.ids or self.ids[-1] != id_:  # rows may repeat
            self.ids.append(id_)
            self.sizes.append(size)
            self.low.append(low)
            self.sides.append((left, right))

    def may_link(self) -> list[int]:
        """Numbers of the classes that may link with another one here."""
        found = np.zeros(len(self.ids), bool)
        for x, near in self.meetings(lambda x, others: ~found[others] | ~found[x]):
            found[near] = True
            found[x] |= bool(len(near))
        return np.flatnonzero(found).tolist()

    def links(self, sets: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        """Links that join what links join here."""
        root, out, sizes = np.arange(len(self.ids)), [], np.array(self.sizes)
        for x, near in self.meetings(lambda x, others: root[others] != root[x]):
            mine, lot = sets[self.ids[x]], 4
            while len(near := near[root[near] != root[x]]):
                some, near, lot = near[:lot], near[lot:], min(4 * lot, LOT)
                shared = shared_with(mine, [sets[self.ids[y]] for y in some.tolist()])
                for y in some[100 * shared >= self.plan.percent * (sizes[x] + sizes[some] - shared)].tolist():
                    if root[y] != root[x]:
                        out.append((self.ids[x], self.ids[y]))
                        root[root == root[y]] = root[x]
        return out

    def meetings(self, wanted: Callable[[int, np.ndarray | slice], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """Each class with the ``wanted`` ones after it that it may link with."""
        count = len(self.ids)
        if count < 2:
            return
        sizes, low = np.array(self.sizes), np.array([len(s) for s in self.low])
        owner, starts = np.repeat(np.arange(count), low), np.cumsum(low) - low
        sketches = np.full((count, SKETCH), NONE)
        sketches[owner, np.arange(len(owner)) - np.repeat(starts, low)] = np.concatenate(self.low)
        first, keep, lists, bounds = self.listed(owner, starts, low)
        left, right = np.array(self.sides).T
        for x in [self.ids.index(self.star)] if self.star in self.ids else range(count) if self.star is None else ():
            if not wanted(x, slice(None)).any():
                continue
            near = np.zeros(count, bool)
            for v in first[starts[x] : starts[x] + keep[x]].tolist():
                near[lists[bounds[v] : bounds[v + 1]]] = True
            near[x] = False
            if self.star is None:
                near[:x] = False  # these have met x
            others = np.flatnonzero(near)
            shorter, longer = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
            open_ = wanted(x, others) & ((left[x] & right[others]) | (right[x] & left[others])) & (100 * shorter >= self.plan.percent * longer)
            others = others[open_]
            yield x, others[self.similar(sketches, x, others)]

    def listed(self, owner: np.ndarray, starts: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
        """The values of each sketch, those of the fewest classes here first; how many of them count; by value, the classes for which it counts.

        Two sketches that may be similar share so many values that those which count hold a common one.
        """
        _, value = np.unique(np.concatenate(self.low), return_inverse=True)
        held = np.bincount(value)
        rank = np.empty(len(held), np.int64)
        rank[np.argsort(held, kind="stable")] = np.arange(len(held))
        first = rank[value][np.lexsort((rank[value], owner))]
        shared = np.where(low < SKETCH, np.minimum(-(-self.plan.percent * low // 100), self.plan.least), self.plan.least)
        keep = low - np.maximum(shared, 1) + 1
        counts = np.arange(len(owner)) - np.repeat(starts, low) < keep[owner]
        listed, own = first[counts], owner[counts]
        return first, keep, own[np.argsort(listed, kind="stable")], np.r_[0, np.cumsum(np.bincount(listed, minlength=len(held)))]

    def similar(self, sketches: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
        """Whether the least values of the united sketches allow the similarity."""
        both = np.sort(np.concatenate([np.broadcast_to(sketches[x], (len(others), SKETCH)), sketches[others]], axis=1), axis=1)
        twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != NONE)
        rank = np.arange(both.shape[1] - 1) - np.cumsum(twice, axis=1) + twice
        shared = (twice & (rank < SKETCH)).sum(axis=1)
        union = (both != NONE).sum(axis=1) - twice.sum(axis=1)
        return np.where(union < SKETCH, 100 * shared >= self.plan.percent * union, shared >= self.plan.least)


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents whose doc_id is their component's; rows without doc_id stay."""
    first = components(docs, percent, words).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(*columns_of(docs)).unionByName(docs.where("doc_id IS NULL"))
