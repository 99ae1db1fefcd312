"""Substring dedup of words with suffix automata of reference shards.

A window is a repeat if its words also start earlier: in a document with a
smaller id, or before it in the same document.  The contexts of anchors that
occur again (see ``repeats``) are dealt into shards by anchor, so a window and
all its equals are in one shard of bounded size.  A shard's contexts come in
the order of their places.  Each is first streamed through the automaton of
all contexts before it: the matching statistics give, for every word, the
longest stretch ending there that the reference holds, and where that reaches
the window's length, the window is a repeat.  Then the context joins the
reference.  Overlapping repeats form maximal spans, which are removed.

One shard's automaton is never sent to all documents: documents send it only
the contexts that share an anchor with it.  So the work grows with the input,
not with documents times shards.

Defined cases: a null text has no words; a null id comes after all others;
rows that repeat an id share their places, and equal places are never earlier
than one another; an empty table gives an empty result; ``cut`` keeps all
other columns and leaves a text without repeats as it is, null included.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repeats import ELSEWHERE, Kind, Run, Units, find_repeats


def words_kind(window: int = 20) -> Kind:
    return Kind(window, max(1, 2 * window // 5), words=True, by_place=True)


class Automaton:
    """Suffix automaton of several sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        """Split off the short suffixes of q that end in c after p."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, sequence: list[int]) -> None:
        moves, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            q = moves[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, c, q)
                continue
            state = self._state(length[last] + 1, 0, {})
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = state
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                link[state] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = state

    def match(self, sequence: list[int]) -> list[int]:
        """Length of the longest known stretch that ends at each position."""
        moves, link, length = self.next, self.link, self.length
        state = size = 0
        out = []
        for c in sequence:
            while state and c not in moves[state]:
                state = link[state]
                size = length[state]
            if c in moves[state]:
                state = moves[state][c]
                size += 1
            out.append(size)
        return out


def resolve(runs: list[Run], kind: Kind) -> list[np.ndarray]:
    """Masks of each run's entries, by matching against the shard's automaton."""
    masks = [np.full(len(r.right), ELSEWHERE, dtype=np.uint64) for r in runs]
    gram = 8 * kind.gram
    groups: dict[bytes, dict[tuple[bytes, bytes], list]] = {}
    for run, r in enumerate(runs):
        for entry, (right, left, place) in enumerate(zip(r.right, r.left, r.least)):
            context = groups.setdefault(right[:gram], {}).setdefault((left, right), [place, []])
            context[0] = min(context[0], place)
            context[1].append((run, entry, place))
    reference: list[tuple] = []
    for contexts in groups.values():
        if len(contexts) > 1:
            reference += [(least, left + right, places) for (left, right), (least, places) in contexts.items()]
            continue
        # All occurrences of the anchor have the same surroundings: nothing to match.
        [(least, places)] = contexts.values()
        for run, entry, place in places:
            if place == least:
                masks[run][entry] = 0
    automaton = Automaton()
    reference.sort(key=lambda x: x[0])
    for _, same in groupby(reference, key=lambda x: x[0]):
        fresh = []
        for least, raw, places in same:
            sequence = np.frombuffer(raw, np.uint64).tolist()
            mask = 0
            for j, size in enumerate(automaton.match(sequence)[kind.window - 1:]):
                if size >= kind.window:
                    mask |= 1 << j
            for run, entry, place in places:
                if place == least:
                    masks[run][entry] = mask
            fresh.append(sequence)
        for sequence in fresh:
            automaton.add(sequence)
    return masks


def kept_words(text: str | None, removed: np.ndarray) -> list[bytes]:
    words = (text or "").encode().split()
    return [w for w, gone in zip(words, removed.tolist()) if not gone] if removed.any() else words


def digest_block(rows: pa.Table, units: Units, removed: np.ndarray) -> pa.Table:
    out: list[list] = [[], [], []]
    for text, a, b in zip(rows.column(1).to_pylist(), units.starts.tolist(), units.starts[1:].tolist()):
        kept = kept_words(text, removed[a:b])
        for column, value in zip(out, (b - a, b - a - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())):
            column.append(value)
    return pa.Table.from_arrays([rows.column(0).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in out[:2]), pa.array(out[2], pa.string())],
                                names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def digest(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return find_repeats(rows, "doc_id", "text", words_kind(window), resolve, digest_block,
                        "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, their repeats removed; kept words are joined by single spaces."""
    order = [doc_id, text, *(c for c in docs.columns if c not in (doc_id, text))]

    def finish(rows: pa.Table, units: Units, removed: np.ndarray) -> pa.Table:
        texts = rows.column(1).to_pylist()
        for i, (a, b) in enumerate(zip(units.starts.tolist(), units.starts[1:].tolist())):
            if removed[a:b].any():
                texts[i] = b" ".join(kept_words(texts[i], removed[a:b])).decode()
        return rows.set_column(1, rows.field(1), pa.array(texts, rows.field(1).type))

    schema = T.StructType([docs.schema[c] for c in order])
    return find_repeats(docs.select(*order), doc_id, text, words_kind(window), resolve, finish, schema).select(*docs.columns)
