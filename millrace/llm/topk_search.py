"""Exact top-k search by inner product, by distributed histogram selection.

Every pass scores all candidates against all queries, block by block. Counting passes add up a
histogram of scores for each query over the interval that holds its k-th score, and narrow the
interval to one bin, until it is a single value. The last pass keeps what scores higher, and of
equal scores the smallest ids. A task sends at most k bins, or k rows above what it must, for each query.
Queries and their intervals are written block by block for each pass; a task reads these files one after another
for the candidates it holds, so that neither a shuffle nor the driver carries queries for each part of the candidates.

Components become floor(scale * x); scores are exact, and such beyond 64 bits count as the last value
of the range. Vectors that are null or hold null or non-finite components take no part. Vectors meet only those of their own length. Rows that repeat a vec_id are candidates each, but never for their own
id; as a query the least of them counts. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blockfiles import get, names_in, put
from millrace.llm.common import kept
from millrace.llm.vectors import LAST, clamped, loaded, stored, top_of, whole
from millrace.session import shared_dir

BINS = 256
CANDIDATES, QUERIES = 4096, 256
#: Score tables that a task gathers before it sends counts, in query blocks.
HELD = 64
#: Bytes of candidates that a task holds against one query block after another.
LOT = 16 << 20


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vec_id, embedding`` that ``is_query`` selects."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), is_query.alias("q")).where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL"
    )
    blocks = kept(rows.select("vec_id", "embedding").mapInArrow(
        lambda b: candidate_blocks(b, scale), "dim int, n int, top double, kind string, ids binary, m binary"), "candidates")
    facts = blocks.agg(F.count("*"), F.max("top")).first()
    spread = max(1, min(facts[0], int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocks = kept(blocks.drop("top").repartition(spread), "candidates")

    queries = rows.where("q").select("vec_id", "embedding").mapInArrow(lambda b: query_rows(b, scale), "qid long, dim int, reach double, kind string, v binary")
    queries = kept(queries.groupBy("qid").agg(F.min(F.struct("kind", "v", "dim", "reach")).alias("x")).select("qid", "x.*"), "queries")
    n_blocks = max(1, -(-queries.count() // QUERIES))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(n_blocks)).cast("int"))
    # A score is at most the query's sum of sizes times the largest component; both are rounded, so a little more.
    edge = F.col("reach") * float(facts[1] or 0) * 1.001 + 1
    edge = F.when(edge >= float(1 << 63), F.lit(LAST)).otherwise(edge).cast("long")
    low = F.when(edge == LAST, F.lit(-LAST - 1)).otherwise(-edge)
    state = queries.select("qid", low.alias("lo"), edge.alias("last"), F.lit(0).cast("long").alias("above"))

    def met(state: DataFrame, reduce, ddl: str) -> DataFrame:
        """What ``reduce`` makes of the candidates and the query blocks in a folder."""
        folder = shared_dir(spark, "query-blocks")
        grouped = queries.join(state, "qid").groupBy("block", "dim").agg(
            F.collect_list(F.struct("qid", "kind", "v", "lo", "last", "above")).alias("qs")
        )
        kept(grouped.mapInArrow(lambda b: put_queries(b, folder), "block int, dim int"), "query-list")
        return blocks.mapInArrow(lambda b: reduce(b, folder, k, scale), ddl)

    while True:
        state = kept(state, "intervals")
        if state.where("lo < last").isEmpty():
            break
        counts = met(state, histograms, "qid long, bin int, n long")
        counts = counts.groupBy("qid", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("qid").orderBy(F.desc("bin")))
        reached = counts.join(state, "qid").withColumn("upto", above + F.col("above")).where(F.col("upto") >= k)
        reached = reached.groupBy("qid").agg(F.max(F.struct("bin", "upto", "n")).alias("x"))
        # Intervals may be as wide as 64 bits, so their ends are reckoned as decimals.
        lo, last = (F.col(c).cast("decimal(20,0)") for c in ("lo", "last"))
        step = F.floor((last - lo) / BINS) + 1
        low = lo + F.col("x.bin") * step
        # Fewer than k candidates: everything counts, so the threshold falls to the lowest score.
        state = state.join(reached, "qid", "left").select(
            "qid", F.coalesce(low.cast("long"), F.col("lo")).alias("lo"),
            F.when(F.col("x").isNull(), F.col("lo")).otherwise(F.least(last, low + step - 1).cast("long")).alias("last"),
            F.coalesce(F.col("x.upto") - F.col("x.n"), F.col("above")).alias("above"),
        )
    found = met(state, best, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def usable(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and components (as doubles) of the vectors that take part, by length."""
    lists = batch.column(1)
    flat, ends = lists.values.to_numpy(zero_copy_only=False).astype(np.float64), lists.offsets.to_numpy()
    ids, sizes = batch.column(0).to_numpy(), np.diff(ends)
    good = np.isfinite(flat)  # null components are NaN here
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        index = ends[at][:, None] + np.arange(size)
        ok = good[index].all(axis=1)
        if ok.any():
            yield ids[at[ok]], flat[index[ok]]


def candidate_blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, x in usable(batch):
            for k in range(0, len(ids), CANDIDATES):
                part = x[k : k + CANDIDATES]
                matrix = whole(part, scale)
                kind, raw = stored(matrix, part)
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([part.shape[1]], pa.int32()), "n": pa.array([len(part)], pa.int32()), "top": [as_double(top_of(matrix))],
                    "kind": [kind], "ids": [ids[k : k + CANDIDATES].astype("<i8").tobytes()], "m": [raw],
                })


def query_rows(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, x in usable(batch):
            matrices = [whole(row, scale) for row in x]
            forms = [stored(m, row) for m, row in zip(matrices, x)]
            yield pa.RecordBatch.from_pydict({
                "qid": pa.array(ids, pa.int64()), "dim": pa.array([x.shape[1]] * len(ids), pa.int32()),
                "reach": [as_double(sum(abs(v) for v in m.tolist())) for m in matrices], "kind": [f[0] for f in forms], "v": [f[1] for f in forms],
            })


def as_double(n: int) -> float:
    return float(min(n, 1 << 1000))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a with all rows of b, cut to 64 bits."""
    reach = top_of(a) * top_of(b) * max(1, a.shape[1])
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if reach < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return clamped(a.astype(object) @ b.T.astype(object))


def put_queries(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One file for each block of queries of one length."""
    for batch in batches:
        for block, dim, queries in zip(*(batch.column(c).to_pylist() for c in ("block", "dim", "qs"))):
            put(folder, f"{dim}-{block}", {
                **{c: np.array([q[c] for q in queries], np.int64) for c in ("qid", "lo", "last", "above")},
                "kind": np.array([q["kind"] for q in queries]), "sizes": np.array([len(q["v"]) for q in queries], np.int64),
                "v": np.frombuffer(b"".join(q["v"] for q in queries), np.uint8)})
        yield batch.select(["block", "dim"])


class Block:
    """The queries of one block with their intervals."""

    def __init__(self, dim: int, held: dict[str, np.ndarray], scale: int):
        self.ids, self.lo, self.last, self.above = (held[c] for c in ("qid", "lo", "last", "above"))
        raw = np.split(held["v"], np.cumsum(held["sizes"])[:-1])
        self.matrix = np.stack([loaded(kind, v.tobytes(), scale) for kind, v in zip(held["kind"].tolist(), raw)]).reshape(len(raw), dim)
        # Differences of 64-bit integers fit unsigned ones.
        self.step = (self.last.view(np.uint64) - self.lo.view(np.uint64)) // np.uint64(BINS) + np.uint64(1)


def lots(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Length, ids and vectors of candidate blocks, about ``LOT`` bytes of them at a time."""
    lot, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            dim, n, kind, ids, m = (batch.column(c)[i].as_py() for c in ("dim", "n", "kind", "ids", "m"))
            matrix = loaded(kind, m, scale).reshape(n, dim)
            lot.append((dim, np.frombuffer(ids, "<i8"), matrix))
            size += matrix.nbytes
            if size >= LOT:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def scored(batches: Iterator[pa.RecordBatch], folder: str, scale: int) -> Iterator[tuple[str, Block, np.ndarray, np.ndarray, np.ndarray]]:
    """For each pair of blocks: name and queries of the one, candidate ids, scores, and which are no query's own."""
    names = None
    for lot in lots(batches, scale):
        names = names_in(folder) if names is None else names
        dims = {dim for dim, _, _ in lot}
        for name in names:
            if (dim := int(name.split("-")[0])) in dims:
                block = Block(dim, get(folder, name), scale)
                for own, ids, matrix in lot:
                    if own == dim:
                        yield name, block, ids, products(matrix, block.matrix), ids[:, None] != block.ids


def histograms(batches: Iterator[pa.RecordBatch], folder: str, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[Block, np.ndarray]] = {}

    def send() -> Iterator[pa.RecordBatch]:
        for block, counts in held.values():
            # Counts below a query's k highest scores here cannot matter.
            higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            row, column = np.nonzero((counts > 0) & (higher < k))
            yield pa.RecordBatch.from_pydict(
                {"qid": block.ids[row], "bin": pa.array(column, pa.int32()), "n": counts[row, column]}
            )
        held.clear()

    for name, block, _, scores, others in scored(batches, folder, scale):
        if name not in held and len(held) >= HELD:
            yield from send()
        _, counts = held.setdefault(name, (block, np.zeros((len(block.ids), BINS), np.int64)))
        inside = others & (scores >= block.lo) & (scores <= block.last)
        row, column = np.nonzero(inside)
        above = scores[row, column].view(np.uint64) - block.lo[column].view(np.uint64)
        slot = column * BINS + (above // block.step[column]).astype(np.int64)
        counts += np.bincount(slot, minlength=counts.size).reshape(counts.shape)
    yield from send()


def best(batches: Iterator[pa.RecordBatch], folder: str, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    ties: dict[int, np.ndarray] = {}

    def rows(qid, vec, score) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"query_id": np.asarray(qid, np.int64), "vec_id": np.asarray(vec, np.int64), "score": np.asarray(score, np.int64)})

    levels: dict[int, int] = {}
    for _, block, ids, scores, others in scored(batches, folder, scale):
        row, column = np.nonzero(others & (scores > block.lo))
        yield rows(block.ids[column], ids[row], scores[row, column])
        row, column = np.nonzero(others & (scores == block.lo))
        for c in np.unique(column):
            qid, here = int(block.ids[c]), ids[row[column == c]]
            wanted = k - int(block.above[c])
            ties[qid] = np.sort(np.concatenate([ties.get(qid, here[:0]), here]))[:wanted]
            levels[qid] = int(block.lo[c])
        if len(ties) > HELD * QUERIES:
            for qid, vec in ties.items():
                yield rows([qid] * len(vec), vec, [levels[qid]] * len(vec))
            ties.clear()
            levels.clear()
    for qid, vec in ties.items():
        yield rows([qid] * len(vec), vec, [levels[qid]] * len(vec))
