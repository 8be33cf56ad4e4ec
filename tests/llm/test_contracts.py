"""Query results that SQL cannot express, against plain versions; empty tables for all."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import grade_model, huffman, jaccard_join, mixing, quality_rules
from millrace.llm.queries import QUERIES
from millrace.llm.tokens import id_type, token_table

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    words = ["lorem", "Ipsum", "dolor#", "sit|", "<amet>", "é", "100%", "a&b", "$", "naïve,"]
    out = [None, "", "\n\n", "one", " \t", "x\x85y  z", "same line\nsame line\n same line\n\n\nsame line"]
    for _ in range(60):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        out.append("\n".join(lines + rng.choices(lines, k=rng.randint(0, 3))))
    return out + [out[9], " ".join(f"word{k}" for k in range(9_000))]


@pytest.fixture(scope="module")
def docs(spark, texts, tmp_path_factory):
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("contracts"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def plain_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    again = {i + d for i, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def test_op8_base_columns(spark, docs, texts):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = QUERIES["op8_quality_rules"](spark, docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[n] for n in names) == plain_rules(texts[r["doc_id"]])
        judge = quality_rules.Judge(quality_rules.Bands())
        assert r["kept"] == judge((texts[r["doc_id"]] or "").encode())[6] and not (r["kept"] and r["base_failed"])
    assert len({r["base_failed"] for r in rows}) == 2


def test_op5_pieces_are_the_tokenizers_ids(spark, docs, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]
    upto, used = dict.fromkeys(range(len(texts)), 0), {}
    for p in sorted(QUERIES["op5_packing"](spark, docs).collect(), key=lambda p: (p["doc_id"], p["start"])):
        whole = ids[p["doc_id"]]
        assert p["start"] == upto[p["doc_id"]] and p["doc_tokens"] == len(whole)
        upto[p["doc_id"]] += p["length"]
        assert p["ids_crc32"] == zlib.crc32(whole[p["start"] : p["start"] + p["length"]].tobytes())
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert upto == {i: len(x) for i, x in enumerate(ids)}
    for pieces in used.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096


def plain_fit(grade, rows, fit, steps=4_000):
    """The same loss by plain gradient descent, with slopes by differences."""
    def loss(x):
        w, t = x[: fit.features], x[fit.features :]
        ends = np.r_[-np.inf, t, np.inf]
        total = 0.0
        for g, (ids, values) in zip(grade, rows):
            s = float(w[ids] @ values)
            total -= np.log(1 / (1 + np.exp(s - ends[g + 1])) - 1 / (1 + np.exp(s - ends[g])))
        return total / len(grade) + fit.penalty * float(w @ w) / 2

    return loss


def test_op9_ends_at_the_least_loss():
    """No step in any direction lowers the loss that the fit is said to lower: weights by differences, thresholds too."""
    rng = np.random.default_rng(3)
    fit = grade_model.Fit(rows=100, features=8, floor=1, rounds=3_000)
    grade = rng.integers(0, 3, 90)
    rows = [(np.unique(rng.integers(0, 8, 3)), None) for _ in grade]
    rows = [(ids, np.where(ids % 3 == g, 1.0, 0.4).astype(np.float32)) for (ids, _), g in zip(rows, grade)]
    model = grade_model.learn(grade, [r[0] for r in rows], [r[1] for r in rows], fit)
    loss = plain_fit(grade, rows, fit)
    x = np.concatenate([model.weights, model.thresholds])
    assert model.thresholds[0] < model.thresholds[1]
    for k in range(len(x)):
        step = np.zeros(len(x))
        step[k] = 1e-4
        assert abs(loss(x + step) - loss(x - step)) / 2e-4 < 2e-2


def test_raked_sample_follows_its_probabilities(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(5, 60)), rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b"]), 1) for i in range(6_000)]
    frame = spark.createDataFrame(rows, COLUMNS)
    targets = mixing.Targets(budget=0.5, shares={"source": {"a": 0.5, "b": 0.5}}, power={"lang": 1.0, "topic": 1.0}, sweeps=60)
    found = mixing.weigh(frame, targets).collect()
    chosen = mixing.sample(frame, targets).collect()
    assert {r["doc_id"] for r in chosen} == {r["doc_id"] for r in found if r["mix_kept"]}
    for source in "ab":
        mine = [r for r in found if r["source"] == source]
        expected = sum(r["mix_probability"] * r["mix_tokens"] for r in mine)
        assert sum(r["mix_tokens"] for r in mine if r["mix_kept"]) == pytest.approx(expected, rel=0.06)


def test_empty_tables(spark, tmp_path):
    nothing = spark.createDataFrame([], COLUMNS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("byte_bpe_50k.json")
    frames = [
        huffman.read_ids(huffman.write_ids(token_table(nothing, path, 0), id_type(path))), corpus_pipeline.STAGES[-1][1](spark, nothing, ""),
        grade_model.score(nothing, grade_model.train(nothing, labels)), jaccard_join.one_of_each(nothing), quality_rules.filter_by_rules(nothing),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name in ("op11_minhash_dedup", "op12_periodic_runs"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op2_topk_search", "op13_hard_negatives"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0
