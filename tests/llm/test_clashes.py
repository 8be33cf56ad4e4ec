"""Awkward column names, wordless tables and scores at the ends of the range."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import jaccard_join, line_dedup, mixing, quality_rules, sketch_join, topk_search
from millrace.llm.vectors import LAST

NAMES = (
    "_doc _row _bitmap _first _source _lang _topic _tokens _probability mix_topic mix_tokens mix_probability mix_kept "
    "t sig keys n rep key pivot own i j u v root top id parts x value size h1 h2 pos kind row_hash probability fitted tokens part seq ids"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randint(0, 200)}" for _ in range(60)) + "\nA line that is long enough to be shared" for _ in range(30)]
    texts += texts[:4] + [None, "", "\n \n"]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), *[f"{n}-{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ddl).repartition(2)


STAGES = {
    "quality": quality_rules.filter_by_rules, "lines": line_dedup.dedup_lines, "jaccard": jaccard_join.one_of_each,
    "mix": lambda d: mixing.sample(d, mixing.Targets(budget=1.0)), "sketches": sketch_join.one_of_each,
}


@pytest.mark.parametrize("stage", STAGES)
def test_extra_columns_come_out_as_they_were(docs, stage):
    found = STAGES[stage](docs)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in NAMES)


def test_packing_ignores_extra_columns(docs):
    pieces = corpus_pipeline.STAGES[-1][1](docs.sparkSession, docs, "")
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_weigh_gives_way(docs):
    found = mixing.weigh(docs)
    assert found.columns == [*docs.columns, "_mix_topic", "_mix_tokens", "_mix_probability", "_mix_kept"]


def mixed(spark, rows, **targets):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string, lang string")
    return frame, {r["doc_id"]: r for r in mixing.weigh(frame, mixing.Targets(**targets)).collect()}


def test_wordless_source(spark):
    rows = [("", "empty", "en"), (None, "empty", "de"), (" \n", None, None)] + [(f"some words {i}", "full", "en") for i in range(50)]
    _, found = mixed(spark, rows, budget=0.5)
    assert all(found[i]["mix_kept"] and found[i]["mix_probability"] == 1 for i in range(3))
    assert all(found[i]["mix_probability"] == pytest.approx(0.5, rel=0.01) for i in range(3, 53))


def test_wordless_table(spark):
    frame, found = mixed(spark, [("", "a", "en"), (None, None, "de")])
    assert all(r["mix_kept"] and r["mix_tokens"] == 0 for r in found.values()) and len(found) == 2
    assert mixing.marginals(frame).where("NOT met").count() == 0


def test_shares_must_name_every_category(spark):
    rows = [("a b", "x", "en"), ("a b", None, "en"), ("", "void", "en")]
    with pytest.raises(ValueError, match="source"):
        mixed(spark, rows, shares={"source": {"x": 1.0}})
    _, found = mixed(spark, rows * 10, budget=0.5, shares={"source": {"x": 0.25, None: 0.75}}, sweeps=30)
    assert found[1]["mix_probability"] == pytest.approx(3 * found[0]["mix_probability"], rel=0.01)


def test_marginals(spark):
    rows = [("a b", "x", "en")] * 90 + [("a b", "y", None)] * 10
    frame, _ = mixed(spark, rows)
    found = {(r["dimension"], r["category"]): r for r in mixing.marginals(frame, mixing.Targets(budget=0.5)).collect()}
    assert set(found) == {("source", "x"), ("source", "y"), ("lang", "en"), ("lang", None), ("topic", "plain")}
    assert found["topic", "plain"]["tokens"] == 200 and found["topic", "plain"]["fitted"] == pytest.approx(100, rel=0.01)
    # Languages wish for other parts than sources do, and both are the same rows here: the report says so.
    assert not all(r["met"] for r in found.values())


@pytest.mark.parametrize("size", [2.0**20, 2.0**21, 2.0**26, 2.0**50, 2.0**62, 1e307])
def test_top_k_of_large_components(spark, size):
    """Scores up to 2^62, between 2^62 and 2^63, and beyond 64 bits, where they are cut."""
    rng = random.Random(int(math.log2(size)))
    rows = [(i, [rng.uniform(-size, size), rng.choice([-0.5, 0.5]), size]) for i in range(60)]
    rows += [(i, [0.0, rng.uniform(-9, 9), 0.0]) for i in range(60, 120)] + [(200 + i, [size, 1.0, size]) for i in range(3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in topk_search.top_k(frame, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [int(x) * 1024 if abs(x) > 2**52 else math.floor(x * 1024) for x in v] for i, v in rows}
    for q in [i for i in whole if i % 20 == 0]:
        scores = [(-max(min(sum(a * b for a, b in zip(whole[q], v)), LAST), -LAST - 1), i) for i, v in whole.items() if i != q]
        assert sorted(found[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:10])]
