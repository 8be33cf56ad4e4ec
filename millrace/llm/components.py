"""Connected components by alternating stars; every round is one written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (u, v), roots included; the root is the least node.

    Each round joins larger neighbours, then smaller ones, to the least known node, which takes a
    logarithmic number of rounds. Least nodes aggregate partially, so the centre of a large star
    costs a row for each task. Nulls and loops are left out.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, seen = kept(edges, "edges"), None
    while (state := fingerprint(edges)) != seen:
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = small.unionByName(least.withColumnRenamed("m", "v"))
        edges = kept(tied.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components_of(sets: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, n, rep, component`` of every row of ``sets`` (doc_id, n, sig).

    ``classes`` (id, sig, doc_id) has one row for each set that occurs, ``links`` (u, v) joins their ids.
    ``rep`` is the least doc_id with the set, ``component`` the least that links reach; both are null
    where doc_id is. Sets of one doc_id belong together. A row without set is its own component.
    """
    named = classes.select("sig", "id", F.col("doc_id").alias("rep"))
    rows = kept(sets.select("doc_id", "n", "sig").join(named, "sig", "left").drop("sig"), "rows")
    held = rows.where("id IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("id").alias("u"), F.max("id").alias("w"))
    same = rows.join(held.where("u <> w"), "doc_id").where("id IS NOT NULL").select("u", F.col("id").alias("v"))
    roots = connected(links.unionByName(same)).withColumnRenamed("node", "id")
    tagged = classes.select("id", "doc_id").join(roots, "id")
    tops = tagged.join(tagged.groupBy("root").agg(F.min("doc_id").alias("top")), "root").select("id", "top")
    known = F.col("doc_id").isNotNull()
    return rows.join(tops, "id", "left").select(
        "doc_id", "n", F.when(known, F.coalesce("rep", "doc_id")).alias("rep"),
        F.when(known, F.coalesce("top", "rep", "doc_id")).alias("component"),
    )
