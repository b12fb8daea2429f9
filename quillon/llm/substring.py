"""Substring dedup of word sequences with suffix automata of reference shards.

The reference of a shard is the earlier text around the anchors dealt to it. Documents' segments are streamed through
the shard's automaton in order of place: matching statistics of at least the window length mark a later repeat, and the
segment then joins the automaton. Shards are dealt by anchor rather than broadcast, since sending every shard to every
task would grow with the square of the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillon.llm.anchors import Spec, removed, repeated_spans


class SuffixAutomaton:
    """The least automaton of all substrings of the sequences added so far (no match crosses two of them)."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence) -> None:
        last = 0
        for x in sequence:
            last = self._extend(last, x)

    def _extend(self, last: int, x) -> int:
        follow, link, length = self.next, self.link, self.length
        if (q := follow[last].get(x)) is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, q, x)
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and x not in follow[p]:
            follow[p][x] = new
            p = link[p]
        if p != -1:
            q = follow[p][x]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, x)
        return new

    def _clone(self, p: int, q: int, x) -> int:
        follow, link = self.next, self.link
        twin = len(follow)
        follow.append(follow[q].copy())
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        link[q] = twin
        while p != -1 and follow[p].get(x) == q:
            follow[p][x] = twin
            p = link[p]
        return twin

    def matches(self, sequence):
        """For each element, how long a run that ends with it occurs in the automaton."""
        state = size = 0
        for x in sequence:
            while state and x not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if x in self.next[state]:
                state, size = self.next[state][x], size + 1
            yield size


def later_windows(table: pa.Table, spec: Spec) -> tuple[np.ndarray, ...]:
    """Of the variants of each anchor, the windows that an earlier variant holds too."""
    h, doc, mark, start = (table.column(c).to_numpy() for c in ("h", "doc", "mark", "start"))
    order = np.lexsort((start, mark, doc, h))
    pieces = table.column("piece").to_pylist()
    rows, begins = [], []
    automaton, anchor, place = SuffixAutomaton(), None, None
    for i in order.tolist():
        here = (h[i], doc[i], mark[i], start[i])
        if here == place:
            continue  # a repeated row of the input
        place = here
        if h[i] != anchor:
            automaton, anchor = SuffixAutomaton(), h[i]
        words = pieces[i].split()
        for j, size in enumerate(automaton.matches(words)):
            if size >= spec.length:
                rows.append(i)
                begins.append(int(start[i]) + j - spec.length + 1)
        automaton.add(words)
    rows, begins = np.array(rows, np.int64), np.array(begins, np.int64)
    return doc[rows], mark[rows], begins, begins + spec.length


def _cut_words(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[int, bytes]:
    words = text.split()  # of bytes: at ASCII white space
    out, at = [], 0
    for a, b in zip(start.tolist(), stop.tolist()):
        out += words[at:a]
        at = b
    return len(words), b" ".join(out + words[at:])


def dedup_substrings(docs: DataFrame, length: int = 20) -> DataFrame:
    """Remove later repeats of word sequences of at least `length` words from docs (doc_id, text).

    A word goes if a window of `length` words over it also starts earlier: in a smaller doc_id, or earlier in the same
    document; windows are judged on the input. Words are runs of anything but ASCII white space. Returns doc_id,
    n_units (words), spans (maximal removed ranges of words) and kept (the words left, joined by one space). A null or
    empty text has no words. Rows that share doc_id and text are one document; rows that share the doc_id only are
    ordered by a hash of their text; a null doc_id comes first. An empty table gives no rows.
    """
    spec = Spec("word", length, max(1, length // 2), keep_first=True)
    return removed(repeated_spans(docs, spec, later_windows), _cut_words, "string")
