"""Near-duplicates by SimHash, with candidates found by pigeonring filtering.

A fingerprint of 64 bits is a ring of four segments.  If two fingerprints
differ in at most three bits, then from some segment on every chain of l
consecutive segments differs in at most floor(3 l / 4) bits: none in the
first, one in the first two, two in the first three.  A candidate shares a key
of the first two segments (equal, or equal after one flip of a bit from 0 to 1
in the second); it then has to pass the budget of three segments before the
full distance is counted.  That is far stricter than one shared segment, and
no link is lost.

Equal fingerprints are merged before anything is compared, and a group of one
key reports a spanning forest of its links, never all its pairs.

Defined cases: a null, empty or blank text has fingerprint zero, which links
like any other; rows that repeat an id are judged each for itself; a null id
takes no part in the choice of the least id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.operators.skew import lookup

from .common import store
from .components import components

SEED = 42
BITS, SEGMENTS, REACH = 64, 4, 3
WIDTH = BITS // SEGMENTS
LOW = np.uint64((1 << WIDTH) - 1)
#: Groups of one key above this size are split by a further segment.
SPLIT = 2048


def fingerprint(words: list[bytes], size: int = 3) -> int:
    """Bits that are set in over half the hashes of the shingles, repeats included."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if not words:
        return 0
    if len(words) < size:
        return digest(b" ".join(words), SEED)
    shingles = zip(*(words[i:] for i in range(size)))
    hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t or "").encode().lower().split(), size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def segment(fp: np.ndarray, i: int) -> np.ndarray:
    """Segment i of the ring, counted from the low bits."""
    return (fp >> np.uint64(WIDTH * (i % SEGMENTS))) & LOW


def chain(start: int, length: int) -> np.uint64:
    """Mask of so many consecutive segments."""
    return np.uint64(sum(int(LOW) << (WIDTH * ((start + k) % SEGMENTS)) for k in range(length)))


def ring_keys(fp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(start, key, member rows, probing) of all keys of two segments."""
    rows = np.arange(len(fp))
    for i in range(SEGMENTS):
        first, second = segment(fp, i) << np.uint64(WIDTH), segment(fp, i + 1)
        yield i, first | second, rows, False
        for bit in range(WIDTH):
            zero = rows[(second >> np.uint64(bit)) & np.uint64(1) == 0]
            yield i, first[zero] | second[zero] | np.uint64(1 << bit), zero, True


def candidate_keys(nodes: DataFrame) -> DataFrame:
    """Rows (key, fp, probing); the key holds the start in its upper bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(whole), 4096):
                fp = whole[at:at + 4096]
                found = [(key | np.uint64(i << 2 * WIDTH), fp[rows], probing) for i, key, rows, probing in ring_keys(fp)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([k for k, _, _ in found]).view(np.int64)),
                     pa.array(np.concatenate([f for _, f, _ in found]).view(np.int64)),
                     pa.array(np.concatenate([np.full(len(k), p) for k, _, p in found]))],
                    ["key", "fp", "probing"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long, probing boolean")


def within(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Pigeonring check of the longer chain, then the full distance."""
    diff = a ^ b
    near = np.bitwise_count(diff & CHAINS[start]) <= 3 * REACH // SEGMENTS
    near[near] = np.bitwise_count(diff[near]) <= REACH
    return near


CHAINS = np.array([chain(i, 3) for i in range(SEGMENTS)], dtype=np.uint64)


def pairs_of(sizes: np.ndarray, begins: np.ndarray, probing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (member, later member) inside groups; two probing rows never pair."""
    left, right = [], []
    for size in np.unique(sizes):
        if size > 1:
            a, b = np.triu_indices(size, 1)
            first = begins[sizes == size]
            left.append((first[:, None] + a).ravel())
            right.append((first[:, None] + b).ravel())
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    keep = ~(probing[a] & probing[b])
    return a[keep], b[keep]


def linked_in(fp: np.ndarray, probing: np.ndarray, start: int, forest: "Forest") -> None:
    """Links inside one large group of a key.

    Up to three differing bits lie in the other two segments, so one of them
    has at most one: members are split by that segment, equal or with one
    flip, until the parts hold few fingerprints or no segment is left.
    """
    for i in (start + 2, start + 3):
        value = segment(fp, i)
        keys, rows, probes = [value], [np.arange(len(fp))], [np.zeros(len(fp), bool)]
        for bit in range(WIDTH):
            zero = np.flatnonzero((value >> np.uint64(bit)) & np.uint64(1) == 0)
            keys.append(value[zero] | np.uint64(1 << bit))
            rows.append(zero)
            probes.append(np.ones(len(zero), bool))
        key, row, probe = np.concatenate(keys), np.concatenate(rows), np.concatenate(probes)
        order = np.argsort(key, kind="stable")
        key, row, probe = key[order], row[order], probe[order]
        for low, high in runs(key):
            if high - low > 1:
                side, flip = row[low:high], probe[low:high]
                for k in np.flatnonzero(~flip):
                    near = np.bitwise_count(fp[side] ^ fp[side[k]]) <= REACH
                    near &= ~(probing[side] & probing[side[k]])
                    for other in fp[side[near]].tolist():
                        forest.join(int(fp[side[k]]), other)


def runs(key: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of equal neighbours."""
    cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
    edges = [0, *cuts.tolist(), len(key)]
    return list(zip(edges, edges[1:])) if len(key) else []


class Forest:
    """Union-find that remembers the links that joined two trees."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.above[max(x, y)] = min(x, y)
            self.links.append((a, b))


def links(keys: DataFrame) -> DataFrame:
    """A forest of links (u, v) of each task's groups of equal key."""

    def solve(key: np.ndarray, fp: np.ndarray, probing: np.ndarray) -> pa.RecordBatch | None:
        forest = Forest()
        start = (key >> np.uint64(2 * WIDTH)).astype(np.int64)
        bounds = np.array(runs(key), dtype=np.int64).reshape(-1, 2)
        sizes = bounds[:, 1] - bounds[:, 0]
        small = sizes <= 64
        a, b = pairs_of(sizes[small], bounds[small, 0], probing)
        near = within(fp[a], fp[b], start[a])
        for x, y in zip(fp[a[near]].tolist(), fp[b[near]].tolist()):
            forest.join(x, y)
        for low, high in bounds[~small].tolist():
            if high - low > SPLIT:
                linked_in(fp[low:high], probing[low:high], int(start[low]), forest)
                continue
            for k in range(low, high):
                if not probing[k]:
                    near = within(fp[low:high], fp[k], start[low:high])
                    for other in fp[low:high][near].tolist():
                        forest.join(int(fp[k]), other)
        if not forest.links:
            return None
        found = np.array(forest.links, dtype=np.uint64).view(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            probing = batch.column(2).to_numpy(zero_copy_only=False)
            # Rows come sorted: the last group may go on in the next batch.
            whole = int(np.searchsorted(key, key[-1], "left"))
            if whole or (held and held[0][0][0] != key[-1]):
                parts = [*held, (key[:whole], fp[:whole], probing[:whole])]
                if (done := solve(*(np.concatenate(x) for x in zip(*parts)))) is not None:
                    yield done
                held = []
            held.append((key[whole:], fp[whole:], probing[whole:]))
        if held and (done := solve(*(np.concatenate(x) for x in zip(*held)))) is not None:
            yield done

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """doc_id, fp, fingerprint (hex) and component_id of every document."""
    rows = store(fingerprints(docs, doc_id, text, size), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    member = components(links(candidate_keys(nodes)))
    tied = member.join(nodes, member["node"] == nodes["fp"]).select("fp", "root", "least")
    named = tied.join(tied.groupBy("root").agg(F.min("least").alias("component")), "root").select("fp", "component")
    entry = nodes.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    # A fingerprint of very many copies is answered from a broadcast of at most a thousand such.
    return lookup(rows, entry, ["fp"], nodes.select("fp", "n")).select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
