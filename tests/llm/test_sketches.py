"""Sketch join against all pairs, with lists and groups cut small."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import sketch_join
from millrace.llm.sketch_join import Group, Plan, set_of


def plain_set(text, words=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def plain_components(sets: dict, percent=85):
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {d: top(d) for d in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randint(0, 999)}"
    return words


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = {0: None, 1: "", 2: " \t\n", 3: "one two", 4: "ONE  two", 5: "two one", 6: "x " * 300, 7: "a b c d e"}
    sentence = [f"s{k}" for k in range(60)]
    for family in range(12):
        base = [f"w{rng.randint(0, 3_000)}" for _ in range(rng.choice([8, 30, 70, 100, 240, 900]))]
        if family % 3 == 0:
            base = sentence + base
        for k in range(rng.randint(2, 9)):
            out[len(out)] = rng.choice([" ", "\n"]).join(edited(rng, base, rng.randint(0, max(1, len(base) // 25))))
    for k in range(25):  # a template that is most of many texts, and no link by itself
        out[len(out)] = " ".join(sentence + [f"v{rng.randint(0, 9_999)}" for _ in range(14 + k)])
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, 1, "p", 2) for d, t in texts.items()]
    rows += [(None, texts[20], 1, "p", 2), (20, texts[20], 1, "p", 2), (40, texts[20], 1, "p", 2), (41, None, 1, "p", 2)]
    return spark.createDataFrame(rows, "doc_id int, text string, id int, pivot string, n int").repartition(3)


@pytest.mark.parametrize("crowd, block", [(100, 1 << 20), (1, 1 << 20), (3, 300), (1, 120)])
def test_components(spark, docs, texts, monkeypatch, crowd, block):
    monkeypatch.setattr(sketch_join, "CROWD", crowd)
    monkeypatch.setattr(sketch_join, "BLOCK", block)
    sets = {d: [plain_set(t)] for d, t in texts.items()}
    sets[40].append(plain_set(texts[20]))
    expected = plain_components(sets)
    rows = sketch_join.components(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["class_id"] is None and r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
            assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]} | {0}
    assert len(set(expected.values())) < len(expected) - 10


def test_other_limits(docs, texts):
    found = {r["doc_id"]: r["component_id"] for r in sketch_join.components(docs.where("doc_id not in (20, 40)"), 60, 2).collect()}
    expected = plain_components({d: [plain_set(t, 2)] for d, t in texts.items() if d not in (20, 40)}, 60)
    assert {d: c for d, c in found.items() if d is not None} == expected


def test_one_of_each(docs, texts):
    stays = sketch_join.one_of_each(docs)
    assert stays.columns == docs.columns
    sets = {d: [plain_set(t)] for d, t in texts.items()}
    sets[40].append(plain_set(texts[20]))
    expected = {d for d, c in plain_components(sets).items() if d == c}
    assert {r["doc_id"] for r in stays.collect()} == expected | {None}


def test_empty_table(docs):
    assert sketch_join.components(docs.limit(0)).count() == 0 and sketch_join.one_of_each(docs.limit(0)).count() == 0


def test_plan():
    with pytest.raises(ValueError):
        Plan(0)
    assert 20 < Plan(85).least < 54 and Plan(100).least == 64


@pytest.mark.parametrize("star", [False, True])
def test_group(star):
    """Joined by links exactly what all pairs join, and for a star only pairs with it."""
    rng = random.Random(9)
    sets = []
    for _ in range(6):
        base = [f"w{rng.randint(0, 500)}" for _ in range(rng.choice([40, 120]))]
        sets += [set_of(" ".join(edited(rng, base, rng.randint(0, 3))).encode(), 5) for _ in range(8)]
    group = Group(Plan(), 17 if star else None)
    for k, s in enumerate(sets):
        for _ in range(2):
            group.add(k, len(s), s[: sketch_join.SKETCH], True, True)
    found = group.links(dict(enumerate(sets)))
    linked = {(a, b) for a, b in combinations(range(len(sets)), 2)
              if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert {tuple(sorted(x)) for x in found} <= linked
    stay = set(group.may_link())
    assert {k for x in (found if star else linked) for k in x} <= stay
    assert len(stay) < len(sets)
    if star:
        assert {tuple(sorted(x)) for x in found} == {x for x in linked if 17 in x}
    else:
        root = list(range(len(sets)))
        for a, b in found:
            root = [root[a] if r == root[b] else r for r in root]
        assert all(root[a] == root[b] for a, b in linked)


def test_unrelated_classes_with_common_values_are_not_compared(monkeypatch):
    """Values that all classes of a group hold say nothing; only rare ones bring two together."""
    rng = np.random.default_rng(12)
    common = np.arange(1, 25, dtype=np.uint64)
    sets = [np.unique(np.r_[common, rng.integers(1 << 40, 1 << 63, 200).astype(np.uint64)]) for _ in range(250)]
    for k in (3, 50, 51):
        sets.append(np.unique(np.r_[sets[k][:-4], rng.integers(1 << 40, 1 << 63, 4).astype(np.uint64)]))
    sets += [common[:9], common[:10], common[:3], common[1:]]
    group, seen = Group(Plan()), []
    for k, s in enumerate(sets):
        group.add(k, len(s), s[: sketch_join.SKETCH], True, True)
    similar = Group.similar
    monkeypatch.setattr(Group, "similar", lambda self, sketches, x, others: (seen.append(len(others)), similar(self, sketches, x, others))[1])
    linked = {(a, b) for a, b in combinations(range(len(sets)), 2)
              if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert {tuple(sorted(x)) for x in group.links(dict(enumerate(sets)))} == linked and len(linked) == 4
    assert {k for x in linked for k in x} <= set(group.may_link())
    assert sum(seen) < 200
