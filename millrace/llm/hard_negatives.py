"""Hard negatives of anchors by BOND: a vertical scan of the vectors with bounds on what is still unread.

Vectors are stored by column in blocks, with the least and greatest value of each column. An anchor reads a
block's columns in falling order of its own components' size. After each few columns, the partial
scores plus the least and greatest contribution that the other columns can make bound every candidate's
score. Candidates stay in the anchor's bitmap only while their bounds meet one of its score windows, above the
k-th score found in it so far, here or by bounds alone; what stays to the end has its exact score.

1. Positives of an anchor: its ``positives`` highest scores of the same label, in one unbounded window.
2. Negatives: for each positive's score p the ``negatives`` highest scores s of other labels with
   ``low * p <= 100 * s <= high * p``. Positives with one score share a window.

Anchors and blocks meet in a grid: each cell holds a bounded group of anchors and streams the blocks of
one part past them; a cell sends k rows a window at most, and Spark ranks them.

Components become floor(scale * x); scores are exact integer inner products, and such beyond 64 bits count as
the last value of the range. Higher scores come first, ties by smaller vec_id. Rows with null vec_id, label or
vector, or with null or non-finite components, take no part. Vectors meet only those of their length. Rows
that repeat a vec_id are candidates each, but never for their own id; as an anchor the least of them counts. Empty
tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import kept
from millrace.llm.vectors import LAST, clamped, loaded, stored, top_of, whole

BLOCK = 4096
#: Bytes of anchors in one group, and of blocks in one part beyond which there are more parts.
GROUP_BYTES, PART_BYTES = 8 << 20, 1 << 30
#: Columns read between two looks at the bounds.
STEP = 8
BLOCK_DDL = "dim int, n int, kind string, ids binary, labels binary, m binary"
FOUND = pa.schema([("anchor_id", pa.int64()), ("window", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "anchor_id long, window long, vec_id long, score long"


def usable(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and components (as doubles) of the vectors that take part, by length."""
    lists = batch.column("embedding")
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components are NaN here
    ids, labels, sizes = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), np.diff(ends)
    good = np.isfinite(flat)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        index = ends[at][:, None] + np.arange(size)
        ok = good[index].all(axis=1)
        if ok.any():
            yield ids[at[ok]], labels[at[ok]], flat[index[ok]]


def column_blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, x in usable(batch):
            for k in range(0, len(ids), BLOCK):
                part = x[k : k + BLOCK].T
                kind, raw = stored(whole(part, scale), part)
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([part.shape[0]], pa.int32()), "n": pa.array([part.shape[1]], pa.int32()), "kind": [kind],
                    "ids": [ids[k : k + BLOCK].astype("<i8").tobytes()], "labels": [labels[k : k + BLOCK].astype("<i8").tobytes()], "m": [raw],
                })


def anchor_rows(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, x in usable(batch):
            forms = [stored(whole(row, scale), row) for row in x]
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64()), "label": pa.array(labels, pa.int64()), "dim": pa.array([x.shape[1]] * len(ids), pa.int32()),
                "kind": [f[0] for f in forms], "m": [f[1] for f in forms],
            })


@dataclass
class Wanted:
    """A score window and the best ``k`` found in it."""

    name: int
    low: int
    high: int
    k: int
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @property
    def floor(self) -> int:
        """Scores below are not wanted any more."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.floor) & (scores <= self.high)
        ids, scores = np.concatenate([self.ids, ids[inside]]), np.concatenate([self.scores, scores[inside]])
        best = np.lexsort((ids, ~scores))[: self.k]  # ~s falls as s rises, and has no overflow
        self.ids, self.scores = ids[best], scores[best]


class Block:
    """Candidates by column."""

    def __init__(self, dim: int, n: int, kind: str, ids: bytes, labels: bytes, m: bytes, scale: int):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.columns = loaded(kind, m, scale).reshape(dim, n)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        self.top = top_of(self.columns)
        self.forms: dict[type, np.ndarray] = {}

    def as_type(self, dtype: type) -> np.ndarray:
        if dtype not in self.forms:
            self.forms[dtype] = self.columns.astype(dtype)
        return self.forms[dtype]


class Anchor:
    def __init__(self, id_: int, label: int, vector: np.ndarray, windows: list[Wanted], same: bool):
        self.id, self.label, self.windows, self.same = id_, label, windows, same
        self.order = np.array(sorted(range(len(vector)), key=lambda d: -abs(int(vector[d]))), np.int64)
        self.vector = vector[self.order]
        self.size = sum(abs(int(v)) for v in vector)

    def scan(self, block: Block) -> None:
        """Read the block column by column, the largest components first."""
        alive = np.flatnonzero(((block.labels == self.label) == self.same) & (block.ids != self.id))
        reach = self.size * block.top
        dtype = np.float64 if reach < 1 << 53 else np.int64 if reach < 1 << 62 else object
        columns, vector = block.as_type(dtype), self.vector.astype(dtype)
        ends = np.stack([vector * block.least[self.order].astype(dtype), vector * block.most[self.order].astype(dtype)])
        # What the columns from each one on can add, at least and at most.
        least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (np.minimum(*ends), np.maximum(*ends)))
        partial = np.zeros(len(alive), dtype)
        whole_block = len(alive) == columns.shape[1]
        for k in range(0, len(vector), STEP):
            dims, after = self.order[k : k + STEP], min(k + STEP, len(vector))
            partial = partial + vector[k:after] @ (columns[dims] if whole_block else columns[np.ix_(dims, alive)])
            stay = self.may_matter(clamped(partial + least[after]), clamped(partial + most[after]))
            if not stay.all():
                alive, partial, whole_block = alive[stay], partial[stay], False
            if not len(alive):
                return
        ids, scores = block.ids[alive], clamped(partial).astype(np.int64)
        for window in self.windows:
            window.add(ids, scores)

    def may_matter(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(least), bool)
        for window in self.windows:
            floor = window.floor
            sure = least[((least >= window.low) & (most <= window.high)).astype(bool)]
            if len(sure) >= window.k:  # so many are inside, whatever the rest of their scores
                floor = max(floor, int(np.sort(sure)[-window.k]))
            stay |= ((most >= floor) & (least <= window.high)).astype(bool)
        return stay


def scan(batches: Iterator[pa.RecordBatch], scale: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Rows come by cell, its anchors before its blocks. Null ``scores`` ask for the highest of the same label."""
    cell, anchors = None, []

    def send() -> Iterator[pa.RecordBatch]:
        rows = [(a.id, w.name, int(i), int(s)) for a in anchors for w in a.windows for i, s in zip(w.ids, w.scores)]
        for at in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + (1 << 16)]), FOUND)], schema=FOUND)

    for batch in batches:
        for r in batch.to_pylist():
            if (r["dim"], r["g"], r["p"]) != cell:
                yield from send()
                cell, anchors = (r["dim"], r["g"], r["p"]), []
            if r["vec_id"] is None:
                block = Block(r["dim"], r["n"], r["kind"], r["ids"], r["labels"], r["m"], scale)
                for anchor in anchors:
                    anchor.scan(block)
            else:
                same = r["scores"] is None
                windows = [Wanted(0, -LAST - 1, LAST, k)] if same else [
                    Wanted(p, -(-low * p // 100), min(high * p // 100, LAST), k) for p in r["scores"]]
                windows = [w for w in windows if w.low <= w.high]
                if windows:
                    anchors.append(Anchor(r["vec_id"], r["label"], loaded(r["kind"], r["m"], scale), windows, same))
    yield from send()


@dataclass(frozen=True)
class Grid:
    """Candidate blocks and anchors, and into how many parts and groups they are dealt."""

    blocks: DataFrame
    anchors: DataFrame
    parts: int
    groups: int

    def best(self, anchors: DataFrame, scale: int, k: int, low: int = 0, high: int = 0) -> DataFrame:
        """``anchor_id, window, vec_id, score, rank`` for anchors with ``scores``."""
        g = F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))).alias("g")
        p = F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))).alias("p")
        none = F.lit(None)
        rows = anchors.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(self.groups)).cast("int")).select(
            "dim", "g", p, "vec_id", "label", "scores", none.cast("int").alias("n"), "kind", none.cast("binary").alias("ids"),
            none.cast("binary").alias("labels"), "m")
        blocks = self.blocks.withColumn("p", F.pmod(F.xxhash64("ids"), F.lit(self.parts)).cast("int")).select(
            "dim", g, "p", none.cast("long").alias("vec_id"), none.cast("long").alias("label"), none.cast("array<long>").alias("scores"),
            "n", "kind", "ids", "labels", "m")
        dealt = rows.unionByName(blocks).repartition(self.parts * self.groups, "dim", "g", "p")
        dealt = dealt.sortWithinPartitions("dim", "g", "p", F.col("vec_id").isNull(), "vec_id")
        found = dealt.mapInArrow(lambda batches: scan(batches, scale, k, low, high), FOUND_DDL)
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def gridded(vectors: DataFrame, is_anchor: Column, label: Column, scale: int) -> Grid:
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), label.cast("long").alias("label"), is_anchor.alias("q")
    ).where("vec_id IS NOT NULL AND embedding IS NOT NULL AND label IS NOT NULL")
    blocks = kept(rows.drop("q").mapInArrow(lambda b: column_blocks(b, scale), BLOCK_DDL), "columns")
    anchors = rows.where("q").drop("q").mapInArrow(lambda b: anchor_rows(b, scale), "vec_id long, label long, dim int, kind string, m binary")
    least = F.min(F.struct("dim", "kind", "m", "label")).alias("x")
    anchors = kept(anchors.groupBy("vec_id").agg(least).select("vec_id", "x.*"), "anchors")
    n_blocks, n_bytes = blocks.agg(F.count("*"), F.sum(F.length("m"))).first()
    anchor_bytes = anchors.agg(F.sum(F.col("dim") * 8 + 512)).first()[0] or 0
    parts = max(min(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-(n_bytes or 0) // PART_BYTES), 1)
    return Grid(blocks, anchors, parts, max(1, -(-anchor_bytes // GROUP_BYTES)))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vec_id, embedding`` and a label."""
    if not 0 <= low <= high:
        raise ValueError("a window reaches from low up to high percent of the positive's score")
    grid = gridded(vectors, is_anchor, F.col("label") if label is None else label, scale)
    first = grid.best(grid.anchors.withColumn("scores", F.lit(None).cast("array<long>")), scale, positives)
    first = kept(first.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("scores"))
    found = grid.best(grid.anchors.join(scores, "vec_id"), scale, negatives, low, high)
    found = found.withColumnRenamed("window", "positive_score")
    return first.join(found, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
