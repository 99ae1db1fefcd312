"""Exact substring dedup of bytes by a distributed merge sort of suffixes.

Blocks exchange sorted, front-coded runs of the suffixes that start at anchors
(see ``repeats``), cut where the last window of the anchor ends.  A bucket
merges its runs with a loser tree that knows, for every run's head, how many
bytes it shares with the suffix last output: of two heads the one that shares
more is the smaller, and only heads that share equally much are compared, from
there on.  No prefix that is known to be equal is looked at again.  The merge
also gives the common prefix of neighbours, so suffixes with an equal anchor
gram come as one stretch, in which the windows are compared.

Defined cases: null text is empty bytes; matches never cross documents; a null
id comes after all others; rows that repeat an id have no smaller id among
each other, so they do not remove from one another; an empty table gives an
empty result; other columns are ignored by the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import ELSEWHERE, LAST, Kind, Run, Units, find_repeats


def bytes_kind(window: int = 50) -> Kind:
    """Windows of bytes; anchor grams of about half a window, in steps of eight."""
    return Kind(window, max(8, window // 16 * 8), words=False, by_place=False)


def merge(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, entry, bytes in common with the entry output before) in sorted order."""
    n = 1
    while n < len(runs):
        n *= 2
    heads: list[bytes | None] = [r.right[0] if r.right else None for r in runs] + [None] * (n - len(runs))
    at = [0] * n
    # Bytes that a run's head shares with the suffix last output.
    shared = [0] * n
    losers = [0] * n

    def beats(a: int, b: int) -> bool:
        """Whether a's head goes first; the loser's shared length becomes that with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return True
        if x is None:
            return False
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        i = shared[a]
        if x == y:
            shared[b if a < b else a] = len(x)
            return a < b
        end = min(len(x), len(y))
        while i < end and x[i] == y[i]:
            i += 1
        first = i == len(x) or (i < len(y) and x[i] < y[i])
        shared[b if first else a] = i
        return first

    def build(node: int) -> int:
        if node >= n:
            return node - n
        a, b = build(2 * node), build(2 * node + 1)
        won = beats(a, b)
        losers[node] = b if won else a
        return a if won else b

    winner = build(1) if n > 1 else 0
    while heads[winner] is not None:
        yield winner, at[winner], shared[winner]
        at[winner] += 1
        run, i = runs[winner], at[winner]
        if i < len(run.right):
            heads[winner], shared[winner] = run.right[i], run.common[i]
        else:
            heads[winner], shared[winner] = None, 0
        node = (winner + n) // 2
        while node:
            other = losers[node]
            # The common case inline: heads that share differently much need no look at the bytes.
            if heads[other] is not None:
                if heads[winner] is None or shared[other] > shared[winner]:
                    losers[node], winner = winner, other
                elif shared[other] == shared[winner] and not beats(winner, other):
                    losers[node], winner = winner, other
            node //= 2


def resolve(runs: list[Run], kind: Kind) -> list[np.ndarray]:
    """Masks of each run's entries, stretch by stretch of equal anchor grams."""
    masks = [np.full(len(r.right), ELSEWHERE, dtype=np.uint64) for r in runs]
    stretch: list[tuple[int, int]] = []
    for run, entry, common in merge(runs):
        if common < kind.gram and stretch:
            settle(stretch, runs, kind, masks)
            stretch = []
        stretch.append((run, entry))
    if stretch:
        settle(stretch, runs, kind, masks)
    return masks


def settle(stretch: list[tuple[int, int]], runs: list[Run], kind: Kind, masks: list[np.ndarray]) -> None:
    """Windows that occur in a context with a smaller least document."""
    contexts: dict[tuple[bytes, bytes], list] = {}
    for run, entry in stretch:
        r = runs[run]
        doc = r.least[entry][0]
        context = contexts.setdefault((r.left[entry], r.right[entry]), [doc, []])
        context[0] = min(context[0], doc)
        context[1].append((run, entry, doc))
    if len(contexts) == 1:
        [(least, places)] = contexts.values()
        for run, entry, doc in places:
            if doc == least:
                masks[run][entry] = 0
        return
    seen: dict[bytes, int] = {}
    width = kind.window
    for (left, right), (least, places) in sorted(contexts.items(), key=lambda c: c[1][0]):
        whole, mask = left + right, 0
        for j in range(len(whole) - width + 1):
            if seen.setdefault(whole[j:j + width], least) < least:
                mask |= 1 << j
        for run, entry, doc in places:
            if doc == least:
                masks[run][entry] = mask


def digest_block(rows: pa.Table, units: Units, removed: np.ndarray) -> pa.Table:
    out: list[list] = [[], [], [], []]
    raw = units.data.tobytes()
    for a, b in zip(units.starts.tolist(), units.starts[1:].tolist()):
        gone = removed[a:b]
        n = int(np.count_nonzero(gone))
        spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)) if n else 0
        kept = units.data[a:b][~gone].tobytes() if n else raw[a:b]
        for column, value in zip(out, (b - a, n, spans, hashlib.sha256(kept).hexdigest())):
            column.append(value)
    return pa.Table.from_arrays([rows.column(0).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
                                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digest(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return find_repeats(rows, "doc_id", "text", bytes_kind(window), resolve, digest_block,
                        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def spans(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, begin, end) in bytes of every maximal removed run."""
    def finish(rows: pa.Table, units: Units, removed: np.ndarray) -> pa.Table:
        ids, begins, ends = [], [], []
        for doc, a, b in zip(units.ids.tolist(), units.starts.tolist(), units.starts[1:].tolist()):
            step = np.diff(removed[a:b].astype(np.int8), prepend=0, append=0)
            low, high = np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()
            ids += [None if doc == LAST else doc] * len(low)
            begins += low
            ends += high
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "begin": pa.array(begins, pa.int64()), "end": pa.array(ends, pa.int64())})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return find_repeats(rows, "doc_id", "text", bytes_kind(window), resolve, finish, "doc_id long, begin long, end long")
