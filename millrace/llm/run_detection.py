"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a stretch of consecutive words whose smallest period q fits at least ``exponent`` times, with
``length`` words at least, which no neighbouring word continues. Each appended word makes the way from
its prefix state to the root of the automaton's suffix links the preferred path (access in a link-cut
tree) and colours it with its own end. Before that, every segment of the way has one colour, the
previous end of the words that the segment stands for: its longest one, of l words, ended d words
earlier. With ``l >= (exponent - 1) d`` these are squares, and more, of smallest period d, as a nearer
copy would have recoloured the segment. The longest one reaches back to the run's first word; on the
right the run is followed word by word, once for each run.

Only stretches that may hold a run go into an automaton: past its first period, every word of a run
recurs within q words. Distances to the previous equal word therefore bound where runs of q up to 8,
16, 32, ... may lie, which leaves few words of ordinary text; nothing that can be a run is left out.

A task holds one batch of texts and the automaton of one stretch, a few hundred bytes for each of its
words. Words are runs of other bytes than ``[\\x20\\x09-\\x0D]`` and are equal if their 64-bit hashes are.
Null and empty texts have no words, no runs and an empty collapsed text; rows that share a doc_id, or
have none, are judged one by one; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ODD, mixed, raw_bytes, word_hashes

Run = tuple[int, int, int]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("strongest", RUN), ("collapsed", pa.string())]
)
RUN_DDL = "struct<start: long, length: long, period: long>"
FOUND_DDL = f"doc_id long, n_words long, runs array<{RUN_DDL}>, strongest {RUN_DDL}, collapsed string"
#: Words whose distances are looked at together.
PORTION = 1 << 18


class SuffixAutomaton:
    """States from 1 (the root) with the length of their longest word and their suffix link; 0 is none."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.prefix = [0, 0], [0, 0], []
        following: list[dict[int, int]] = [{}, {}]
        last = 1
        for word in words:
            state = self._state(following, self.length[last] + 1, {})
            at = last
            while at and word not in following[at]:
                following[at][word] = state
                at = self.link[at]
            self.link[state] = self._target(following, at, word) if at else 1
            self.prefix.append(state)
            last = state

    def _state(self, following: list[dict[int, int]], length: int, edges: dict[int, int]) -> int:
        following.append(edges)
        self.length.append(length)
        self.link.append(0)
        return len(following) - 1

    def _target(self, following: list[dict[int, int]], at: int, word: int) -> int:
        """The state of the longest suffix that occurred before, split off if its state holds longer words."""
        found = following[at][word]
        if self.length[found] == self.length[at] + 1:
            return found
        split = self._state(following, self.length[at] + 1, dict(following[found]))
        self.link[split] = self.link[found]
        self.link[found] = split
        while at and following[at].get(word) == found:
            following[at][word] = split
            at = self.link[at]
        return split


class LastEnds:
    """A link-cut forest over a tree; every preferred path has the colour of its last access.

    Paths are splay trees by depth, deeper nodes to the right. The colour is kept at the splay root.
    """

    def __init__(self, parent: list[int]):
        self.up = list(parent)
        self.left, self.right, self.colour = ([0] * len(parent) for _ in range(3))

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                break
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == (left[p] == x):
                self._rotate(p)
            elif inner:
                self._rotate(x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            left[p] = b = right[x]
            right[x] = p
        else:
            right[p] = b = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        # The last turn of a splay is with the root, whose colour x takes over.
        self.colour[x] = self.colour[p]

    def access(self, node: int, colour: int) -> Iterator[tuple[int, int]]:
        """(colour so far, deepest node) of every segment on the way to the root, which takes the new colour."""
        at, below = node, 0
        while at:
            self._splay(at)
            yield self.colour[at], at
            deeper = self.right[at]
            if deeper:
                self.colour[deeper] = self.colour[at]
            self.right[at] = below
            below, at = at, self.up[at]
        self.colour[below] = colour


def runs_of(words: list[int], length: int, exponent: int) -> list[Run]:
    """(start, length, period) of all runs."""
    automaton, found = SuffixAutomaton(words), []
    ends, longest = LastEnds(automaton.link), automaton.length
    followed: dict[int, int] = {}
    for end, state in enumerate(automaton.prefix, 1):
        for before, node in ends.access(state, end):
            period = end - before
            if before and longest[node] >= (exponent - 1) * period and followed.get(period, 0) < end:
                start, after = before - longest[node], end
                while after < len(words) and words[after] == words[after - period]:
                    after += 1
                followed[period] = after
                if after - start >= length:
                    found.append((start, after - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, sizes: np.ndarray, length: int, exponent: int) -> list[tuple[int, int, int]]:
    """(text, begin, end) of the disjoint parts of concatenated texts outside of which no run can lie."""
    if not len(hashes):
        return []
    text = np.repeat(np.arange(len(sizes)), sizes)
    with np.errstate(over="ignore"):
        key = mixed(hashes + text.astype(np.uint64) * ODD)
    order = np.argsort(key, kind="stable")
    distance = np.full(len(key), len(key) + 1)
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]]) + 1
    distance[order[again]] = order[again] - order[again - 1]
    begins = np.cumsum(sizes) - sizes
    parts, low, high = [], 1, max(1, length // exponent)
    while low <= int(sizes.max()):
        q = np.arange(low, high + 1)
        near = np.r_[False, distance <= high, False]
        edges = np.flatnonzero(near[1:] != near[:-1]).reshape(-1, 2)
        for a, b in edges[edges[:, 1] - edges[:, 0] >= int((np.maximum(length, exponent * q) - q).min())]:
            parts.append((int(text[a]), max(int(a) - high, int(begins[text[a]])), int(b)))
        low, high = high + 1, high * 2
    out: list[tuple[int, int, int]] = []
    for t, a, b in sorted(parts):
        if out and out[-1][0] == t and a <= out[-1][2]:
            out[-1] = (t, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((t, a, b))
    return [(t, a - int(begins[t]), b - int(begins[t])) for t, a, b in out]


def runs_in_texts(texts: list[list[bytes]], length: int, exponent: int) -> list[list[Run]]:
    sizes = np.array([len(words) for words in texts], np.int64)
    each = [word_hashes(words) for words in texts]
    found: list[list[Run]] = [[] for _ in texts]
    for t, begin, end in stretches(np.concatenate(each), sizes, length, exponent):
        found[t].extend((begin + start, n, q) for start, n, q in runs_of(each[t][begin:end].tolist(), length, exponent))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length over period; ties go to the smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by spaces, of every run only its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, n, q in runs:
            keep[start + q : start + n] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def find_runs(docs: DataFrame, length: int = 24, exponent: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` of every row; runs by start, then period."""

    def rows(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_in_texts(texts, length, exponent)
        as_dicts = [[dict(zip(RUN.names, r)) for r in each] for each in runs]
        best = [strongest(each) for each in runs]
        columns = (
            ids, [len(words) for words in texts], as_dicts, [b and dict(zip(RUN.names, b)) for b in best],
            [collapsed(words, each).decode() for words, each in zip(texts, runs)],
        )
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc, raw in zip(batch.column(0), batch.column(1)):
                ids.append(doc.as_py())
                texts.append(raw.as_py().split())
                held += len(texts[-1])
                if held >= PORTION:
                    yield rows(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield rows(ids, texts)

    if length < 1 or exponent < 2:
        raise ValueError("runs hold one word and two periods at least")
    return docs.select(F.col("doc_id").cast("long"), raw_bytes().alias("t")).mapInArrow(run, FOUND_DDL)
