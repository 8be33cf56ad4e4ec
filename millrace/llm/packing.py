"""Packing into windows: shallow length combinations, counted by non-negative least squares.

A document of n tokens gives full windows, a main piece in whole grains, and a tail below one
grain. Combinations of up to ``depth`` main lengths that fill a window exactly are enumerated;
non-negative least squares against the histogram of main lengths tells how often to use each.
Rounded down, they take main pieces by rank. What is left, main pieces and tails, is packed
greedily end to end, cut at window ends; the last, partial window is cut at powers of two, which
need no padding. So nothing is padded.

Rows are named by ``part`` and ``seq``: doc_id may be null or repeated. An empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import kept

WINDOW, GRAIN, DEPTH = 4096, 32, 3


def combinations(bins: int, depth: int) -> np.ndarray:
    """All multisets of two to ``depth`` sizes in 1..bins-1 that add up to ``bins``: one row of counts each."""
    found: list[list[int]] = []

    def extend(sizes: list[int], rest: int) -> None:
        if rest == 0 and len(sizes) > 1:
            found.append(sizes)
        elif len(sizes) < depth:
            last = len(sizes) == depth - 1
            for size in [rest] if last else range(sizes[-1] if sizes else 1, rest + 1):
                if size < bins and size >= (sizes[-1] if sizes else 1):
                    extend([*sizes, size], rest - size)

    extend([], bins)
    return np.array([np.bincount(sizes, minlength=bins) for sizes in found], np.int64).reshape(-1, bins)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets."""
    x = np.zeros(a.shape[1])
    passive = np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[0] + 10):
        gradient = np.where(passive, -np.inf, a.T @ (b - a @ x))
        best = int(np.argmax(gradient))
        if gradient[best] <= limit:
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            trial = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if trial.min() > 0:
                x[:] = 0
                x[at] = trial
                break
            below = trial <= 0
            step = np.min(x[at][below] / np.maximum(x[at][below] - trial[below], 1e-300))
            x[at] += step * (trial - x[at])
            dropped = at[below & (x[at] <= 1e-9 * max(1.0, x.max()))]
            passive[dropped if len(dropped) else at[np.argmin(trial)]] = False
            x[~passive] = 0
    return x


def repeats(histogram: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Combinations in use and how often, never asking for more pieces of a size than there are."""
    kinds = combinations(len(histogram), depth)
    if not len(kinds) or not histogram.sum():
        return kinds[:0], np.zeros(0, np.int64)
    counts = np.floor(nnls(kinds.T.astype(float), histogram.astype(float)) + 1e-9).astype(np.int64)
    left = histogram - counts @ kinds
    while (left < 0).any():
        size = int(np.argmin(left))
        k = max(np.flatnonzero((kinds[:, size] > 0) & (counts > 0)), key=lambda i: counts[i])
        cut = min(counts[k], -(left[size] // kinds[k, size]))
        counts[k] -= cut
        left += cut * kinds[k]
    used = counts > 0
    return kinds[used], counts[used]


def pack(lengths: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """``part, seq, start, length, sequence_id, offset`` of every piece of ``part, seq, n_tokens``."""
    spark = lengths.sparkSession
    whole_rows, by_part = Window.partitionBy("part").orderBy("seq"), Window.partitionBy("part", "bin").orderBy("seq")
    rows = lengths.select("part", "seq", "n_tokens").withColumns(
        {"n_full": F.expr(f"n_tokens div {window}"), "bin": F.expr(f"(n_tokens % {window}) div {grain}"),
         "tail": F.col("n_tokens") % grain}
    )
    rows = rows.withColumn("full_before", F.sum("n_full").over(whole_rows) - F.col("n_full"))
    rows = kept(rows.withColumn("rank_here", F.row_number().over(by_part) - 1), "lengths")

    # One row for each part and size: bounded by tasks, whatever the number of documents.
    sizes = rows.groupBy("part", "bin").agg(F.count("*").alias("n"), F.sum("n_full").alias("full"))
    ranks = sizes.withColumn("rank_base", F.sum("n").over(Window.partitionBy("bin").orderBy("part")) - F.col("n"))
    fulls = running(sizes.groupBy("part").agg(F.sum("full").alias("v")), "full_base")
    tally = {r["bin"]: (r["n"], r["full"]) for r in sizes.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect()}
    histogram = np.zeros(window // grain, np.int64)
    for size, (n, _) in tally.items():
        histogram[size] = n if size else 0
    n_full = sum(full or 0 for _, full in tally.values())
    kinds, counts = repeats(histogram, depth)
    slots = spark.createDataFrame(slot_rows(kinds, counts, n_full, grain), "bin long, low long, high long, each int, base long, at array<int>")

    rows = rows.join(ranks.select("part", "bin", "rank_base"), ["part", "bin"]).join(fulls, "part")
    rows = rows.withColumn("rank", F.col("rank_base") + F.col("rank_here"))
    full = rows.where("n_full > 0").select(
        "part", "seq", F.posexplode(F.sequence(F.lit(1), F.col("n_full"))).alias("k", "one"), "full_base", "full_before"
    ).select(
        "part", "seq", (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"),
        (F.col("full_base") + F.col("full_before") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    # At most ``depth`` slots for each combination in use, of which there are no more than sizes: small for any input.
    slots = F.broadcast(slots.withColumnRenamed("bin", "of"))
    mains = rows.where("bin > 0").join(slots, (F.col("bin") == F.col("of")) & F.expr("rank >= low AND rank < high"), "left")
    mains = mains.withColumns({"start": F.col("n_full") * window, "length": F.col("bin") * grain})
    mains = kept(mains.select("part", "seq", "start", "length", "rank", "low", "each", "base", "at"), "mains")
    placed = mains.where("low IS NOT NULL").select(
        "part", "seq", "start", "length", (F.col("base") + F.expr("(rank - low) div each")).alias("sequence_id"),
        F.element_at("at", ((F.col("rank") - F.col("low")) % F.col("each") + 1).cast("int")).cast("long").alias("offset"),
    )
    tails = rows.where("tail > 0").select("part", "seq", (F.col("n_tokens") - F.col("tail")).alias("start"), F.col("tail").alias("length"))
    rest = mains.where("low IS NULL").select("part", "seq", "start", "length").unionByName(tails)
    return full.unionByName(placed).unionByName(greedy(rest, n_full + int(counts.sum()), window))


def running(values: DataFrame, name: str) -> DataFrame:
    """``part`` and the sum of ``v`` over smaller parts; one row for each part."""
    return values.select("part", (F.sum("v").over(Window.orderBy("part")) - F.col("v")).alias(name))


def slot_rows(kinds: np.ndarray, counts: np.ndarray, base: int, grain: int) -> list[tuple]:
    """For each size the ranks that a combination takes, and where its pieces lie in the sequence."""
    taken: dict[int, int] = {}
    out = []
    for kind, count in zip(kinds, counts):
        offset = 0
        for size in map(int, np.flatnonzero(kind)):
            each = int(kind[size])
            low = taken.get(size, 0)
            taken[size] = high = low + each * int(count)
            out.append((size, low, high, each, base, [offset + i * size * grain for i in range(each)]))
            offset += each * size * grain
        base += int(count)
    return out


def greedy(rest: DataFrame, base: int, window: int) -> DataFrame:
    """Lay pieces end to end in order of part, seq and start, and cut them where a sequence ends."""
    rest = kept(rest, "rest")
    sums = rest.groupBy("part").agg(F.sum("length").alias("v"))
    total = sums.agg(F.sum("v")).first()[0] or 0
    order = Window.partitionBy("part").orderBy("seq", "start")
    rest = rest.join(running(sums, "part_base"), "part")
    rest = rest.withColumn("begin", F.col("part_base") + F.sum("length").over(order) - F.col("length"))
    rest = rest.withColumn("end", F.col("begin") + F.col("length"))
    # The last sequences: one for each binary digit of what is left over.
    regular, ends = total - total % window, [total - total % window]
    for digit in reversed(range(window.bit_length())):
        if total % window >> digit & 1:
            ends.append(ends[-1] + (1 << digit))
    last = F.array(*[F.lit(e).cast("long") for e in ends])
    cuts = F.array_union(
        F.array((F.expr(f"begin div {window}") + 1) * window), last
    )
    cuts = F.array_sort(F.filter(cuts, lambda c: (c > F.col("begin")) & (c < F.col("end")) & ((c <= regular) | F.array_contains(last, c))))
    rest = rest.withColumn("cuts", F.concat(F.array("begin"), cuts, F.array("end")))
    rest = rest.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("cuts") - 1)))
    rest = rest.withColumns({"a": F.element_at("cuts", F.col("k")), "b": F.element_at("cuts", F.col("k") + 1)})
    index = F.size(F.filter(last, lambda c: c <= F.col("a"))) - 1
    return rest.select(
        "part", "seq", (F.col("start") + F.col("a") - F.col("begin")).alias("start"), (F.col("b") - F.col("a")).alias("length"),
        F.when(F.col("a") < regular, F.expr(f"a div {window}")).otherwise(F.lit(regular // window) + index).cast("long").__add__(base).alias("sequence_id"),
        F.when(F.col("a") < regular, F.col("a") % window).otherwise(F.col("a") - F.element_at(last, F.greatest(index + 1, F.lit(1)))).cast("long").alias("offset"),
    )
