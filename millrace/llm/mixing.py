"""Mixing sources to target weights: iterative proportional fitting, then a sample by hash.

Token counts by source, language and topic are raked to target marginals. A cell's fitted tokens
over those it has are the probability with which its documents stay, never above one. Only
DataFrame functions are used. Fitting works on one row for each cell.

Null sources, languages and topics are categories of their own. Documents without words weigh
nothing and stay, and so does a category that has no others; in a table without words all stay. Rows of one doc_id
stay or go together; rows without one go by their text. An empty table gives an empty result; other columns pass
through, whatever their names. ``marginals`` reports how near raking came to its goals.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import columns_of, fresh, kept

DIMENSIONS = ("source", "lang", "topic")
NULL = "\x00null"


@dataclass(frozen=True)
class Targets:
    """What the mixture should be.

    ``shares`` may name shares of a dimension's categories, null as None; a category of the table
    that is left out is an error. Elsewhere a category gets its own share
    raised to ``power``, which lowers what is over-represented. ``budget`` is the part of all
    tokens to keep. Raking ends when all marginals are within ``tolerance`` or after ``sweeps``.
    """

    budget: float = 0.8
    power: dict[str, float] = field(default_factory=lambda: {"source": 0.8, "lang": 0.9, "topic": 1.0})
    shares: dict[str, dict[str | None, float]] = field(default_factory=dict)
    tolerance: float = 1e-3
    sweeps: int = 12
    seed: int = 7


def n_words(text: str = "text") -> Column:
    """Runs of other characters than white space: each becomes one letter, and the letters are counted."""
    marked = F.regexp_replace(F.col(text), r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(marked) - F.length(F.replace(marked, F.lit("x"), F.lit(""))), F.lit(0)).cast("long")


def topic_of(text: str = "text") -> Column:
    """A coarse topic by form, for tables without a ``topic`` column: marked-up, shouted or plain prose."""
    size = F.greatest(F.length(text), F.lit(1))
    marks, loud = (F.regexp_count(F.col(text), F.lit(p)) for p in ("[#*$%&|<>]", "[A-Z]"))
    return F.when(marks * 50 > size, "marked").when(loud * 4 > size, "loud").otherwise("plain")


def label(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL))


def by_category(cells: DataFrame, *values: str) -> DataFrame:
    """``dimension, category`` and its ``goal``, if the cells have goals, three times each cell."""
    entries = [
        F.struct(F.lit(n).alias("dimension"), F.col(n).alias("category"), *([F.col(f"goal_{n}").alias("goal")] if f"goal_{n}" in cells.columns else []))
        for n in DIMENSIONS
    ]
    return cells.select(F.explode(F.array(*entries)).alias("c"), *values).select("c.*", *values)


def goals(cells: DataFrame, targets: Targets) -> DataFrame:
    """``dimension, category, goal``: the tokens that each category should keep."""
    categories = by_category(cells, "tokens").groupBy("dimension", "category").agg(F.sum("tokens").alias("t"))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    power = F.coalesce(*[F.when(F.col("dimension") == n, F.lit(float(p))) for n, p in targets.power.items()], F.lit(1.0))
    wish = F.pow(F.col("t") / F.lit(float(total or 1)), power)
    shares = [(n, NULL if k is None else str(k), float(v)) for n, given in targets.shares.items() for k, v in given.items()]
    if shares:
        named = cells.sparkSession.createDataFrame(shares, "dimension string, category string, given double")
        categories = categories.join(named, ["dimension", "category"], "left")
        bound = F.col("dimension").isin(*{s[0] for s in shares})
        if missing := categories.where(bound & F.col("given").isNull() & (F.col("t") > 0)).limit(5).collect():
            raise ValueError("no share is given for " + ", ".join(f"{r['dimension']} {r['category']!r}" for r in missing))
        wish = F.when(bound, F.coalesce("given", F.lit(0.0))).otherwise(wish)
    wished = kept(categories.select("dimension", "category", F.when(F.col("t") > 0, wish).otherwise(0.0).alias("wish")), "wishes")
    sums = {r["dimension"]: r["w"] for r in wished.groupBy("dimension").agg(F.sum("wish").alias("w")).collect()}
    scale = F.coalesce(*[F.when(F.col("dimension") == n, F.lit(total * targets.budget / (w or 1.0))) for n, w in sums.items()], F.lit(0.0))
    return wished.select("dimension", "category", (F.col("wish") * scale).alias("goal"))


def fitted(cells: DataFrame, targets: Targets) -> DataFrame:
    """The cells with the ``goal_*`` of their categories and ``fitted`` tokens, never more than they have."""
    cells = kept(cells, "cells")
    wanted = goals(cells, targets)
    for name in DIMENSIONS:
        mine = wanted.where(F.col("dimension") == name).select(F.col("category").alias(name), F.col("goal").alias(f"goal_{name}"))
        cells = cells.join(mine, name)
    cells = kept(cells.withColumn("fitted", F.col("tokens").cast("double")), "cells")
    for sweep in range(targets.sweeps):
        for name in DIMENSIONS:
            total = F.sum("fitted").over(Window.partitionBy(name))
            cells = cells.withColumn("fitted", F.when(total > 0, F.col("fitted") * F.try_divide(f"goal_{name}", total)).otherwise(0.0))
        cells = cells.withColumn("fitted", F.least("fitted", F.col("tokens").cast("double")))
        if sweep % 3 == 2 or sweep == targets.sweeps - 1:
            cells = kept(cells, "cells")
            if (reached(cells).agg(F.max("off")).first()[0] or 0.0) <= targets.tolerance:
                break
    return cells


def reached(cells: DataFrame) -> DataFrame:
    """``dimension, category, tokens, goal, fitted, off``; ``off`` is the distance from the goal, as a part of it."""
    sums = by_category(cells, "tokens", "fitted").groupBy("dimension", "category").agg(
        F.sum("tokens").alias("tokens"), F.max("goal").alias("goal"), F.sum("fitted").alias("fitted")
    )
    return sums.withColumn("off", F.abs(F.col("fitted") - F.col("goal")) / F.greatest("goal", F.lit(1.0)))


def marginals(docs: DataFrame, targets: Targets = Targets(), topic: Column | None = None) -> DataFrame:
    """``dimension, category, tokens, goal, fitted, off, met``: what raking reached for each category, null as it was."""
    found = reached(fitted(cells_of(docs, topic), targets))
    return found.withColumns({"category": F.nullif("category", F.lit(NULL)), "met": F.col("off") <= targets.tolerance})


def fit(cells: DataFrame, targets: Targets) -> DataFrame:
    """``probability`` for ``source, lang, topic, tokens`` of every cell."""
    probability = F.when(F.col("tokens") > 0, F.try_divide("fitted", F.col("tokens"))).otherwise(1.0)
    return fitted(cells, targets).select(*DIMENSIONS, probability.alias("probability"))


def topic_label(docs: DataFrame, topic: Column | None) -> Column:
    """The given topic, else the table's own, else one by form."""
    if topic is None:
        topic = F.col("topic") if "topic" in docs.columns else topic_of()
    return F.coalesce(topic.cast("string"), F.lit(NULL))


def cells_of(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    labels = [label("source").alias("source"), label("lang").alias("lang"), topic_label(docs, topic).alias("topic")]
    return docs.select(*labels, n_words().alias("tokens")).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))


def weigh(docs: DataFrame, targets: Targets = Targets(), topic: Column | None = None) -> DataFrame:
    """The rows with ``mix_topic, mix_tokens, mix_probability, mix_kept``, which give way to columns of these names."""
    source, lang, topic_, tokens, probability = fresh(docs, "_source", "_lang", "_topic", "_tokens", "_probability")
    labelled = docs.withColumns({source: label("source"), lang: label("lang"), topic_: topic_label(docs, topic), tokens: n_words()})
    found = fit(cells_of(docs, topic), targets).toDF(source, lang, topic_, probability)
    known = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(targets.seed), "doc_id"))
    draw = F.coalesce(known, F.xxhash64(F.lit(targets.seed), "text"))
    chance = F.pmod(draw, F.lit(1 << 52)) / float(1 << 52)
    joined = labelled.join(found, [source, lang, topic_], "left")
    names = fresh(docs, "mix_topic", "mix_tokens", "mix_probability", "mix_kept")
    stays = chance < F.when(F.col(tokens) > 0, F.col(probability)).otherwise(1.0)
    added = [F.col(topic_), F.col(tokens), F.col(probability), stays]
    return joined.select(*columns_of(docs), *[c.alias(n) for c, n in zip(added, names)])


def sample(docs: DataFrame, targets: Targets = Targets(), topic: Column | None = None) -> DataFrame:
    weighed = weigh(docs, targets, topic)
    return weighed.where(F.col(weighed.columns[-1])).select(*columns_of(docs))
