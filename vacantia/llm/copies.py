"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sources, and every link is decided by the exact
Jaccard similarity of the sets, as 64-bit hashes.  First SimHash fingerprints
of the sets are linked by pigeonring filtering, which joins exact copies and
the large groups of close ones.  A pair at 0.8 is ten bits apart, though, where
no chain of segments prunes, so the rest comes from MinHash: sixty least
hashes in twenty bands of three.  A pair at 0.8 shares no band in 6 of ten
million cases.

Equal sets are merged before anything is compared.  Bands are taken in two
waves; a key goes on only if its members are not all joined yet.  The members
of a key are compared inside one task, all at once for one of them, and only a
forest of links leaves it.  Keys with many or long members are dealt into
blocks, every two of which meet in one task, so no pair of a key is missed.

Sets are made twice, since few texts have a candidate: once for the hashes of
all texts, once more for those that share a key.

Defined cases: words are those of the lower-cased text; a text of fewer words
than a shingle is one shingle as a whole, so empty texts are equal; null is
empty; rows that repeat an id are judged each for itself; a null id takes no
part in the choice of the least id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.operators.skew import lookup

from . import simhash
from .common import discard, mixed, store
from .components import components
from .simhash import SEED

BANDS, DEPTH = 20, 3
HASHES = BANDS * DEPTH
SALTS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64))[:, None]
FACTORS = mixed(SALTS + np.uint64(1 << 32)) | np.uint64(1)
#: Bands of the first wave, which joins most of what there is to join.
FIRST_BANDS = 4
#: Members of a key, and hashes of all its members, that make a block.
MEMBERS, BLOCK_HASHES = 512, 1 << 20


def shingles(words: list[bytes], size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), SEED)], dtype="<u8")
    return np.unique(np.array([digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(size)))], dtype="<u8"))


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 2048):
            least = np.minimum(least, ((hashes[None, at:at + 2048] ^ SALTS) * FACTORS).min(axis=1))
    return least


def majority(hashes: np.ndarray) -> int:
    """SimHash of a set: the bits that are set in over half its hashes."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def node_of(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def pick(doc_id: str, text_hash: Column) -> Column:
    """Number of a row by its id and text; tells a set's text apart from others."""
    return F.xxhash64(F.col(doc_id).cast("long"), text_hash)


def hashed(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """One row for each document: the hash of its set (node), its size, its SimHash and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [shingles((t or "").encode().lower().split(), size) for t in batch.column(2).to_pylist()]
                least = np.array([least_hashes(x) for x in found])
                keys = np.zeros((len(found), BANDS), dtype=np.uint64)
                for k in range(DEPTH):
                    keys = mixed(keys ^ least[:, k::DEPTH]) + np.arange(BANDS, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), batch.column(1), signed([node_of(x) for x in found]), pa.array([len(x) for x in found], pa.int64()),
                     signed([majority(x) for x in found]), pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "node", "size", "fp", "keys"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, node long, size long, fp long, keys array<long>")


def sets_of(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(node, body) of the sets whose rows are picked; the body holds the set's hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                found = [shingles((t or "").encode().lower().split(), size) for t in whole.column(0).slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([signed([node_of(x) for x in found]), pa.array([x.tobytes() for x in found], pa.binary())], ["node", "body"])

    rows = docs.select(pick(doc_id, F.xxhash64(text)).alias("pick"), F.col(text).alias("text")).join(wanted.select("pick"), "pick", "left_semi")
    # Only rows that repeat both id and text come twice.
    return rows.select("text").mapInArrow(run, "node long, body binary").dropDuplicates(["node"])


def similar(pairs: DataFrame, bodies: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose sets have this Jaccard similarity or more; there are about as many pairs as nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), "<u8") for x in (a, b))
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(common >= least * (len(a) + len(b) - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    both = lookup(lookup(pairs, bodies.select(F.col("node").alias("u"), F.col("body").alias("a")), ["u"]),
                  bodies.select(F.col("node").alias("v"), F.col("body").alias("b")), ["v"], pairs.groupBy("v").agg(F.count("*").alias("n")))
    return both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def forest(node: np.ndarray, root: np.ndarray, bodies: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that join members of different roots, enough to join all that are linked."""
    sizes = np.array([len(b) for b in bodies])
    tree = np.unique(root, return_inverse=True)[1]
    names, ids = np.unique(np.concatenate(bodies), return_inverse=True)
    owner = np.repeat(np.arange(len(bodies)), sizes)
    begins = np.cumsum(sizes) - sizes
    links, mark = [], np.zeros(len(names), dtype=bool)
    for i in range(len(bodies)):
        other = (tree != tree[i]) & (np.minimum(sizes, sizes[i]) >= least * np.maximum(sizes, sizes[i]) - 1e-9)
        other[:i] = False
        if not other.any():
            continue
        mine = ids[begins[i]:begins[i] + sizes[i]]
        mark[mine] = True
        common = np.bincount(owner[begins[i]:][mark[ids[begins[i]:]]], minlength=len(bodies))
        mark[mine] = False
        near = np.flatnonzero(other & (common >= least * (sizes + sizes[i] - common) - 1e-9))
        if len(near):
            trees, first = np.unique(tree[near], return_index=True)
            links += [(node[i], node[k]) for k in near[first]]
            tree[np.isin(tree, trees)] = tree[i]
    return links


def joined_in_keys(entries: DataFrame, bodies: DataFrame, least: float) -> DataFrame:
    """Links (u, v) among the members of each key that have different roots; entries are (key, node, size, root)."""
    groups = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.sum("size").alias("hashes"))
    blocks = F.greatest(F.ceil(F.col("n") / MEMBERS), F.ceil(F.col("hashes") / BLOCK_HASHES)).cast("int")
    open_keys = store(groups.where("low < high").select("key", "n", F.least(blocks, F.col("n")).cast("int").alias("blocks")), "keys")
    members = lookup(entries, open_keys.select("key", "blocks"), ["key"], groups.select("key", "n")).where("blocks IS NOT NULL")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # A block meets every block, itself included.
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved(rows: pa.Table) -> pa.RecordBatch:
            place = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in range(3)])
            change = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            node, root = rows.column(3).to_numpy(), rows.column(4).to_numpy()
            body = [np.frombuffer(b, "<u8") for b in rows.column(5).to_pylist()]
            edges, found = [0, *change.tolist(), rows.num_rows], []
            for low, high in zip(edges, edges[1:]):
                if high - low > 1:
                    found += forest(node[low:high], root[low:high], body[low:high], least)
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # Rows come sorted: the last group may go on in the next batch.
            last = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
            same = (last == last[:, -1:]).all(axis=0)
            whole = int(np.argmax(same))
            before = [b.column(c)[0].as_py() for b in held[:1] for c in range(3)]
            if whole or (held and before != last[:, -1].tolist()):
                yield solved(pa.Table.from_batches([*held, batch.slice(0, whole)]))
                held = []
            held.append(batch.slice(whole))
        if held:
            yield solved(pa.Table.from_batches(held))

    return (dealt.join(bodies, "node").select("key", "i", "j", "node", "root", "body").repartition("key", "i", "j")
            .sortWithinPartitions("key", "i", "j", "node").mapInArrow(run, "u long, v long"))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id, text_hash, group_id and component_id of every document.

    ``group_id`` names the group by a set's hash, ``component_id`` by its least id.
    """
    rows = store(hashed(docs, doc_id, text, size), "hashes")
    nodes = store(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("fp").alias("fp"),
                                           F.min(pick("doc_id", F.col("text_hash"))).alias("pick"), F.min("keys").alias("keys")), "nodes")
    entries = store(nodes.select("node", "size", F.posexplode("keys").alias("band", "key")), "entries")

    # SimHash first: sets of one fingerprint, and fingerprints that pigeonring filtering links.
    prints = store(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")), "prints")
    close = simhash.links(simhash.candidate_keys(prints))
    names = prints.select("fp", "first")
    linked = (close.join(names.select(F.col("fp").alias("u"), F.col("first").alias("a")), "u")
              .join(names.select(F.col("fp").alias("v"), F.col("first").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
    equal = lookup(nodes.select("node", "fp"), names, ["fp"], prints.select("fp", "n")).where("first <> node").select(F.col("first").alias("u"), F.col("node").alias("v"))
    pairs = store(linked.union(equal), "pairs")

    shared = entries.groupBy("key").agg(F.count("*").alias("n"))
    wanted = (lookup(entries, shared.where("n > 1").select("key", F.lit(True).alias("shared")), ["key"], shared).where("shared").select("node")
              .union(pairs.select("u")).union(pairs.select("v")).distinct())
    bodies = store(sets_of(nodes.join(wanted, "node", "left_semi"), docs, doc_id, text, size), "bodies")

    found = store(similar(pairs, bodies, least), "similar")
    for wave in (F.col("band") < FIRST_BANDS, F.col("band") >= FIRST_BANDS):
        member = components(found).withColumnRenamed("node", "member")
        rooted = entries.where(wave).join(member, F.col("node") == F.col("member"), "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
        more = store(found.union(joined_in_keys(rooted, bodies, least)), "similar")
        discard(found)
        found = more
    for done in (entries, pairs, bodies, prints):
        discard(done)
    member = components(found).withColumnRenamed("node", "member")
    tied = nodes.join(member, F.col("node") == F.col("member")).select("node", "root", "least")
    named = tied.join(tied.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "root", "component")
    entry = nodes.join(named, "node", "left").select(
        "node", F.coalesce("root", "node").alias("group_id"), F.coalesce("component", "least").alias("component_id"))
    return lookup(rows.select("doc_id", "text_hash", "node"), entry, ["node"], nodes.select("node", "n")).select(
        "doc_id", "text_hash", "group_id", "component_id")
