"""Windows that occur again: the exchange that both dedup operators stand on.

A text is a row of units (bytes or words); a window is so many consecutive
units.  Every window picks as its anchor the gram (a shorter stretch) with the
least hash inside it, which depends on the window's content alone.  So equal
windows have equal anchors at the same place, and comparing what surrounds
equal anchors finds every repeated window, though only about one position in
fourteen (bytes) or seven (words) is an anchor.

1. Texts are dealt into blocks by hash and packed; the packed blocks are
   written once as a bucketed table, so no later step shuffles text.
2. Each block sends the distinct hashes of its anchors, and how often they
   occur, to buckets by hash.  A bucket answers which occur again.
3. Blocks send the surroundings of those anchors (contexts) as sorted runs.
   Copies inside a block are one entry, with the least place they occur at.
4. A bucket resolves its runs by the operator's own method: for each entry,
   whether this block holds the least place, and which windows of that least
   place occur earlier in another context.  All other places are repeats
   altogether.
5. Blocks turn the answers into removed units.

An anchor with very many different contexts would make a large group in one
bucket.  Such anchors send single windows instead of contexts, each to the
bucket of its own hash, so that a group holds one entry for each block.  This
gives the same answers.  Hashes only decide what is compared; texts are
compared themselves (words by 64-bit hashes).
"""

from __future__ import annotations

import io
import pickle
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.shared import new_path

from .common import mixed, parts, row_ranges, store, text_slices, total_bytes

#: A null id comes after all others.
LAST = np.iinfo(np.int64).max
MOST_BUCKETS = 100_000
FLAGS, CONTEXTS, WINDOWS = 0, 1, 2


@dataclass(frozen=True)
class Kind:
    """What is compared: ``window`` units, anchored by grams of ``gram`` units.

    ``by_place``: an earlier start in the same document counts as well.
    """

    window: int
    gram: int
    words: bool
    by_place: bool
    block_bytes: int = 8 << 20
    #: Anchors that occur more often send windows instead of contexts.
    frequent: int = 1024


def packer() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def squeeze(value) -> bytes:
    raw = pickle.dumps(value, protocol=5)
    return len(raw).to_bytes(8, "little") + packer().compress(raw, asbytes=True)


def unsqueeze(data: bytes):
    return pickle.loads(packer().decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))


# ---------------------------------------------------------------- blocks

def pack_blocks(docs: DataFrame, doc_id: str, text: str, kind: Kind) -> tuple[DataFrame, int]:
    """A bucketed table (block, payload) of whole rows, and the number of blocks.

    The columns named by doc_id and text come first; a payload holds the rows
    of one input batch that belong to the block.
    """
    spark = docs.sparkSession
    blocks = parts(total_bytes(docs, text), kind.block_bytes, spark.sparkContext.defaultParallelism)
    rest = [c for c in docs.columns if c not in (doc_id, text)]
    number = "block"
    while number in docs.columns:
        number += "_"
    rows = docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(blocks)).cast("int").alias(number), doc_id, text, *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            number = batch.column(0).to_numpy()
            found, payloads = np.unique(number), []
            for block in found:
                part = table.select(range(1, table.num_columns)).take(np.flatnonzero(number == block))
                out = io.BytesIO()
                with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression=packer())) as writer:
                    writer.write_table(part)
                payloads.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(payloads, pa.binary())], ["block", "payload"])

    buckets = min(blocks, MOST_BUCKETS)
    name = f"blocks_{uuid.uuid4().hex}"
    (rows.mapInArrow(run, "block int, payload binary").repartition(buckets, "block")
     .write.bucketBy(buckets, "block").option("path", new_path(spark, name)).option("compression", "none").saveAsTable(name))
    packed = spark.table(name)
    # The frame reads the files from now on; its name is of no further use.
    spark.sql(f"DROP TABLE {name}")
    return packed, blocks


def unpack(payloads: list[bytes]) -> pa.Table:
    """Rows of a block, always in the same order."""
    tables = [pa.ipc.open_stream(p).read_all() for p in sorted(payloads)]
    return pa.concat_tables(tables).combine_chunks()


@dataclass
class Units:
    """All texts of a block as one array of units."""

    ids: np.ndarray
    data: np.ndarray
    starts: np.ndarray


def units_of(table: pa.Table, kind: Kind) -> Units:
    ids = table.column(0).cast(pa.int64()).fill_null(LAST).combine_chunks().to_numpy(zero_copy_only=False)
    column = table.column(1).combine_chunks()
    if not kind.words:
        data, starts = text_slices(column)
        return Units(ids, data, starts)
    import xxhash

    digest, rows = xxhash.xxh64_intdigest, []
    for text in column.to_pylist():
        rows.append(np.array([digest(w) for w in (text or "").encode().split()], dtype=np.uint64))
    return Units(ids, np.concatenate([np.zeros(0, np.uint64), *rows]), np.cumsum([0, *map(len, rows)], dtype=np.int64))


# ---------------------------------------------------------------- anchors

def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at every position; grams of bytes are read eight at a time."""
    count = len(data) - gram + 1
    step, cells = 1, data
    with np.errstate(over="ignore"):
        if data.dtype == np.uint8:
            step, cells = 8, data.astype(np.uint64)
            for s in (1, 2, 4):
                cells = cells[:-s] | (cells[s:] << np.uint64(8 * s))
        h = np.full(count, 0x9E3779B97F4A7C15, dtype=np.uint64)
        for at in range(0, gram, step):
            h ^= cells[at:at + count]
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xFF51AFD7ED558CCD)
    return h


@dataclass
class Anchors:
    """Anchor positions with the first and last window that chose them."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    row: np.ndarray
    key: np.ndarray


def anchors_of(units: Units, kind: Kind, chunk: int = 1 << 21) -> Anchors:
    """Anchors of all windows, some texts at a time."""
    found: list[tuple] = []
    for first, last in row_ranges(units.starts, chunk):
        base = units.starts[first]
        data = units.data[base:units.starts[last]]
        starts = units.starts[first:last + 1] - base
        if len(data) >= kind.window:
            found.append(_anchors(data, starts, kind, int(base), first))
    if not found:
        empty = np.zeros(0, np.int64)
        return Anchors(empty, empty, empty, empty, np.zeros(0, np.uint64))
    return Anchors(*(np.concatenate(x) for x in zip(*found)))


def _anchors(data: np.ndarray, starts: np.ndarray, kind: Kind, base: int, first: int) -> tuple:
    h = gram_hashes(data, kind.gram)
    least = (h >> np.uint64(32)).astype(np.uint32)
    place = np.arange(len(h), dtype=np.int32)
    choices, width = kind.window - kind.gram + 1, 1

    def halve(shift: int) -> None:
        nonlocal least, place
        left, right = least[:-shift], least[shift:]
        place = np.where(right < left, place[shift:], place[:-shift])
        least = np.minimum(left, right)

    while 2 * width <= choices:
        halve(width)
        width *= 2
    if choices > width:
        halve(choices - width)
    # Windows that begin in one text and end in the next are none.
    edge = np.zeros(len(place) + 1, dtype=np.int8)
    begins, ends = starts[:-1], starts[1:] - kind.window + 1
    some = ends > begins
    np.add.at(edge, begins[some], 1)
    np.add.at(edge, ends[some], -1)
    window = np.flatnonzero(np.cumsum(edge[:-1]))
    if not len(window):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    chosen = place[window]
    cut = np.flatnonzero((chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)) + 1
    low_at, high_at = np.concatenate([[0], cut]), np.concatenate([cut, [len(window)]]) - 1
    at = chosen[low_at].astype(np.int64)
    return (at + base, window[low_at] + base, window[high_at] + base,
            np.searchsorted(starts, at, "right") - 1 + first, mixed(h[at]))


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the keys."""
    return ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def distinct_keys(anchors: Anchors, units: Units, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, how often each occurs (up to 255), and each anchor's key number.

    Where only other documents count, a document counts once.
    """
    keys, number = np.unique(anchors.key, return_inverse=True)
    if kind.by_place:
        count = np.bincount(number, minlength=len(keys))
    else:
        pair = np.sort(number * len(units.ids) + anchors.row)
        first = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, bool)
        count = np.bincount(pair[first] // len(units.ids), minlength=len(keys))
    return keys, np.minimum(count, 255).astype(np.uint8), number


def slices(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of equal neighbours."""
    if len(buckets):
        cuts = np.concatenate([[0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]])
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            yield int(buckets[a]), a, b


def planes(keys: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane, so that they pack well."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


MESSAGE = "bucket int, block int, kind int, data binary"
MESSAGE_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 4, MESSAGE_SCHEMA.types)],
                                schema=MESSAGE_SCHEMA)


def send_keys(table: pa.Table, kind: Kind, buckets: int) -> pa.Table:
    units = units_of(unpack(table.column("payload").to_pylist()), kind)
    keys, count, _ = distinct_keys(anchors_of(units, kind), units, kind)
    block = table.column("block")[0].as_py()
    return messages([(bucket, block, FLAGS, squeeze((planes(keys[a:b]), count[a:b].tobytes())))
                     for bucket, a, b in slices(bucket_of(keys, buckets))])


def answer_keys(table: pa.Table, kind: Kind) -> pa.Table:
    """Per key of each block: 0 if it does not occur again, 2 if very often, else 1."""
    sent = [unsqueeze(d.as_py()) for d in table.column("data")]
    keys = [unplanes(k) for k, _ in sent]
    number = np.unique(np.concatenate(keys), return_inverse=True)[1]
    total = np.bincount(number, weights=np.frombuffer(b"".join(c for _, c in sent), np.uint8))
    flag = np.where(total < 2, 0, np.where(total > kind.frequent, 2, 1)).astype(np.uint8)[number]
    ends = np.cumsum([0, *map(len, keys)])
    return messages([(bucket, block, FLAGS, squeeze(flag[a:b].tobytes())) for bucket, block, a, b in zip(
        table.column("bucket").to_pylist(), table.column("block").to_pylist(), ends, ends[1:])])


# ---------------------------------------------------------------- contexts

@dataclass
class Entries:
    """Distinct contexts of a block, in the order in which they are sent.

    A context is (right, left): the units from the anchor on and those before
    it, as bytes.  ``owner`` gives the entry of each place (an anchor).
    """

    bucket: np.ndarray
    right: list[bytes]
    left: list[bytes]
    least: np.ndarray
    frequent: np.ndarray
    place: np.ndarray
    owner: np.ndarray


def entries_of(units: Units, anchors: Anchors, number: np.ndarray, keys: np.ndarray, flags: np.ndarray, kind: Kind,
               buckets: int) -> Entries:
    raw, size = units.data.tobytes(), units.data.itemsize
    place = np.flatnonzero(flags[number] > 0)
    low, at = (size * anchors.low[place]).tolist(), (size * anchors.at[place]).tolist()
    high = (size * (anchors.high[place] + kind.window)).tolist()
    seen: dict[tuple[bytes, bytes], int] = {}
    owner = np.array([seen.setdefault((raw[b:c], raw[a:b]), len(seen)) for a, b, c in zip(low, at, high)], dtype=np.int64)
    contexts = list(seen)
    # The least place of each context: the first of its places in the order of all places.
    doc, spot = units.ids[anchors.row[place]], anchors.at[place] - units.starts[anchors.row[place]]
    order = np.lexsort((spot, doc))
    first = order[np.unique(owner[order], return_index=True)[1]] if len(owner) else owner
    key = number[place[first]]
    home = bucket_of(keys, buckets)[key].astype(np.int64)
    heads = [h.to_bytes(8, "big") + right for h, (right, _) in zip(home.tolist(), contexts)]
    sent = sorted(range(len(contexts)), key=heads.__getitem__)
    rank = np.empty(len(sent), dtype=np.int64)
    rank[sent] = np.arange(len(sent))
    return Entries(home[sent], [contexts[e][0] for e in sent], [contexts[e][1] for e in sent],
                   np.stack([doc[first][sent], spot[first][sent]], axis=1) if sent else np.zeros((0, 2), np.int64),
                   flags[key[sent]] == 2 if sent else np.zeros(0, bool), place, rank[owner] if sent else owner)


def front_coded(rights: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Common prefix with the entry before, length of the rest, and the rests."""
    width = max(map(len, rights))
    rows = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rights), np.uint8).reshape(-1, width)
    lengths = np.array([len(r) for r in rights])
    differs = np.ones((len(rights), width + 1), dtype=bool)
    differs[1:, :-1] = rows[1:] != rows[:-1]
    common = np.minimum(differs.argmax(axis=1), lengths)
    common[1:] = np.minimum(common[1:], lengths[:-1])
    rest = b"".join(r[c:] for r, c in zip(rights, common.tolist()))
    return common.astype(np.uint16).tobytes(), (lengths - common).astype(np.uint16).tobytes(), rest


def front_decoded(common: bytes, length: bytes, rest: bytes) -> tuple[list[int], list[bytes]]:
    shared = np.frombuffer(common, np.uint16).tolist()
    ends = np.cumsum(np.frombuffer(length, np.uint16), dtype=np.int64).tolist()
    out, before, at = [], b"", 0
    for c, end in zip(shared, ends):
        before = before[:c] + rest[at:end]
        out.append(before)
        at = end
    return shared, out


def pairs_raw(pairs: np.ndarray | list[tuple[int, int]]) -> bytes:
    return np.asarray(pairs, dtype=np.int64).reshape(-1, 2).T.tobytes()


def pairs_read(raw: bytes) -> list[tuple[int, int]]:
    return list(zip(*np.frombuffer(raw, np.int64).reshape(2, -1).tolist()))


def window_entries(entries: Entries, kind: Kind, size: int, buckets: int) -> tuple[list[bytes], list[tuple[int, int]], np.ndarray]:
    """Distinct windows of the frequent contexts, their least places and buckets, in sending order."""
    import xxhash

    seen: dict[bytes, tuple[int, int]] = {}
    width = kind.window * size
    for e in np.flatnonzero(entries.frequent).tolist():
        whole, least = entries.left[e] + entries.right[e], tuple(entries.least[e].tolist())
        for at in range(0, len(whole) - width + 1, size):
            w = whole[at:at + width]
            if w not in seen or least < seen[w]:
                seen[w] = least
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen], dtype=np.uint64)
    order = np.lexsort((hashes, bucket_of(hashes, buckets)))
    contents = list(seen)
    return [contents[i] for i in order], [seen[contents[i]] for i in order], bucket_of(hashes, buckets)[order]


def read_block(table: pa.Table, answers: pa.Table, kind: Kind, buckets: int):
    """Rows, units, anchors and entries of a block from its payloads and its answered keys."""
    rows = unpack(table.column("payload").to_pylist())
    units = units_of(rows, kind)
    anchors = anchors_of(units, kind)
    keys, _, number = distinct_keys(anchors, units, kind)
    told = {b: unsqueeze(d) for b, k, d in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "data"))) if k == FLAGS}
    flags = np.frombuffer(b"".join(told[b] for b in sorted(told)), np.uint8)
    return rows, units, anchors, entries_of(units, anchors, number, keys, flags, kind, buckets)


def send_contexts(table: pa.Table, answers: pa.Table, kind: Kind, buckets: int) -> pa.Table:
    """Front-coded sorted runs of contexts, and of single windows for frequent anchors."""
    if not table.num_rows:
        return messages([])
    _, units, _, entries = read_block(table, answers, kind, buckets)
    block, size, out = table.column("block")[0].as_py(), units.data.itemsize, []
    rare = np.flatnonzero(~entries.frequent)
    for bucket, a, b in slices(entries.bucket[rare]):
        some = rare[a:b].tolist()
        lefts = [entries.left[e] for e in some]
        out.append((bucket, block, CONTEXTS, squeeze((
            *front_coded([entries.right[e] for e in some]), np.array([len(x) for x in lefts], np.uint16).tobytes(),
            b"".join(lefts), pairs_raw(entries.least[some])))))
    contents, least, home = window_entries(entries, kind, size, buckets)
    for bucket, a, b in slices(home):
        out.append((bucket, block, WINDOWS, squeeze((b"".join(contents[a:b]), pairs_raw(least[a:b])))))
    return messages(out)


@dataclass
class Run:
    """One block's sorted entries in a bucket."""

    common: list[int]
    right: list[bytes]
    left: list[bytes]
    least: list[tuple[int, int]]


def run_of(data: bytes) -> Run:
    common, length, rest, left_length, lefts, least = unsqueeze(data)
    shared, rights = front_decoded(common, length, rest)
    ends = np.cumsum(np.frombuffer(left_length, np.uint16), dtype=np.int64).tolist()
    return Run(shared, rights, [lefts[a:b] for a, b in zip([0, *ends], ends)], pairs_read(least))


#: Answer for an entry whose least place is in another block: every window is a repeat.
ELSEWHERE = np.uint64(0xFFFFFFFFFFFFFFFF)
Resolve = Callable[[list[Run], Kind], list[np.ndarray]]


def answer_contexts(table: pa.Table, kind: Kind, resolve: Resolve) -> pa.Table:
    bucket, out = table.column("bucket")[0].as_py(), []
    sent = list(zip(*(table.column(c).to_pylist() for c in ("block", "kind", "data"))))
    runs = [(block, run_of(data)) for block, what, data in sent if what == CONTEXTS]
    if runs:
        for (block, _), masks in zip(runs, resolve([r for _, r in runs], kind)):
            out.append((bucket, block, CONTEXTS, squeeze(masks.tobytes())))
    singles = [(block, *unsqueeze(data)) for block, what, data in sent if what == WINDOWS]
    least: dict[bytes, tuple[int, int]] = {}
    read = []
    for block, raw, places in singles:
        places = pairs_read(places)
        width = len(raw) // len(places)
        contents = [raw[i:i + width] for i in range(0, len(raw), width)]
        read.append((block, contents, places))
        for w, place in zip(contents, places):
            if w not in least or place < least[w]:
                least[w] = place
    for block, contents, places in read:
        held = np.array([earliest(least[w], place, kind) for w, place in zip(contents, places)], dtype=np.uint8)
        out.append((bucket, block, WINDOWS, squeeze(held.tobytes())))
    return messages(out)


def earliest(least: tuple[int, int], place: tuple[int, int], kind: Kind) -> bool:
    """Whether no place before this one holds the content."""
    return place <= least if kind.by_place else place[0] <= least[0]


def masks_of(entries: Entries, answers: pa.Table, kind: Kind, size: int, buckets: int) -> np.ndarray:
    """Per entry the windows of its least place that are repeats, as bits from the first on."""
    told: dict[tuple[int, int], bytes] = {
        (k, b): unsqueeze(d) for b, k, d in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "data"))) if k != FLAGS}
    masks = np.zeros(len(entries.right), dtype=np.uint64)
    rare = np.flatnonzero(~entries.frequent)
    masks[rare] = np.frombuffer(b"".join(told[k] for k in sorted(told) if k[0] == CONTEXTS), np.uint64)
    if len(rare) < len(masks):
        contents, least, _ = window_entries(entries, kind, size, buckets)
        held = np.frombuffer(b"".join(told[k] for k in sorted(told) if k[0] == WINDOWS), np.uint8).tolist()
        first = {w: place for w, place, h in zip(contents, least, held) if h}
        width = kind.window * size
        for e in np.flatnonzero(entries.frequent).tolist():
            whole, own, mask = entries.left[e] + entries.right[e], tuple(entries.least[e].tolist()), 0
            for j, at in enumerate(range(0, len(whole) - width + 1, size)):
                place = first.get(whole[at:at + width])
                if place is None or not earliest(place, own, kind):
                    mask |= 1 << j
            masks[e] = mask
    return masks


def removed_units(units: Units, anchors: Anchors, entries: Entries, masks: np.ndarray, kind: Kind) -> np.ndarray:
    """True for every unit that a repeated window covers."""
    place, owner = entries.place, entries.owner
    edge = np.zeros(len(units.data) + 1, dtype=np.int32)
    low, high = anchors.low[place], anchors.high[place]
    if len(place):
        least = entries.least[owner]
        doc = units.ids[anchors.row[place]]
        at_least = doc == least[:, 0]
        if kind.by_place:
            at_least &= anchors.at[place] - units.starts[anchors.row[place]] == least[:, 1]
        mask = np.where(at_least, masks[owner], ELSEWHERE)
        whole = np.uint64(2) ** (high - low).astype(np.uint64)
        whole = whole | (whole - np.uint64(1))
        mask &= whole
        full = mask == whole
        np.add.at(edge, low[full], 1)
        np.add.at(edge, high[full] + kind.window, -1)
        for i in np.flatnonzero(~full & (mask != 0)).tolist():
            bits, start = int(mask[i]), int(low[i])
            while bits:
                j = (bits & -bits).bit_length() - 1
                edge[start + j] += 1
                edge[start + j + kind.window] -= 1
                bits &= bits - 1
    return np.cumsum(edge[:-1]) > 0


# ---------------------------------------------------------------- the job

Finish = Callable[[pa.Table, Units, np.ndarray], pa.Table]


def find_repeats(docs: DataFrame, doc_id: str, text: str, kind: Kind, resolve: Resolve, finish: Finish, schema: str) -> DataFrame:
    """Run the five steps; ``finish`` makes a block's result from its rows and removed units."""
    packed, buckets = pack_blocks(docs, doc_id, text, kind)
    keys = packed.groupBy("block").applyInArrow(lambda t: send_keys(t, kind, buckets), MESSAGE)
    answered = store(keys.groupBy("bucket").applyInArrow(lambda t: answer_keys(t, kind), MESSAGE), "answers")
    contexts = packed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        lambda t, a: send_contexts(t, a, kind, buckets), MESSAGE)
    resolved = contexts.groupBy("bucket").applyInArrow(lambda t: answer_contexts(t, kind, resolve), MESSAGE)

    def last(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows, units, anchors, entries = read_block(table, answers, kind, buckets)
        masks = masks_of(entries, answers, kind, units.data.itemsize, buckets)
        return finish(rows, units, removed_units(units, anchors, entries, masks, kind))

    return packed.groupBy("block").cogroup(answered.union(resolved).groupBy("block")).applyInArrow(last, schema)
