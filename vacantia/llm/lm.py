"""Language-model scores of whole documents.

The model is a gated recurrent network over words.  Its output softmax is
factored by classes: first the class of the next token, then the token within
the class.  The most frequent words are the vocabulary; all other words are
one entry of it, "rare", and share its probability in proportion to their
counts in the whole training corpus, with half a count for each and for
words never seen.  So every text has a proper likelihood.

Counts, totals and vocabulary come from all training rows.  Texts become word
numbers once, in a table laid out by training wave.  Training documents are
dealt by the hash of their content into shards of at most 500,000 tokens on average,
and the shards into waves of 1, 2, 4, ... of them: all shards of a wave start
from the same weights and step sizes, which are averaged by tokens after it.
So every training document gives gradients exactly once, early waves move fast
and late ones use the whole cluster, and shards, waves and result follow from
the corpus, not from its partitioning.  Only a corpus of less than 100,000
tokens is passed several times.  Within a shard the network is trained by
truncated backpropagation through windows that carry the state along a document
(stretches of 2,048 tokens of a longer one start anew).  Scoring carries the
state through all windows of a document, from its first word to its end.

The vocabulary and the table of frequent counts have fixed sizes and are the
only things broadcast; counts of all other words reach the documents by a join.
The table holds the words most frequent in all texts, held-out ones included,
so no word in the join can hold more than its share of 1 in 65,536 tokens.

Defined cases: a null or blank text is the end token alone; rows that repeat an
id are scored each for itself; without training rows the model is uniform over
classes and c and N are zero; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mixed, parts, remainder, row_ranges, store, stretches

#: The end of a document; no word is empty or holds a space.
END = " "
RARE = "  "
LOG10 = np.log(10.0)


@dataclass
class Shape:
    words: int = 2046
    classes: int = 46
    hidden: int = 16
    window: int = 32
    lanes: int = 512
    stretch: int = 2048


@dataclass
class Vocabulary:
    """Ids by falling count, so that the ids of a class are a range."""

    ids: dict[str, int]
    class_of: np.ndarray
    begins: np.ndarray
    counts: np.ndarray

    @property
    def arrays(self) -> tuple[np.ndarray, ...]:
        """What training and scoring of numbered words need."""
        return self.class_of, self.begins, self.counts


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts behind one another, and where each text's begin (one entry more); null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    begins = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values
    filled = pc.not_equal(pc.binary_length(words), 0)
    if pc.all(filled).as_py():
        return words, begins
    # White space at an end of a text leaves an empty word.
    return words.filter(filled), np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[begins]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c, n) of (text, training): occurrences in training texts and in all; the end of each counts as a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in stretches(batch, 0, 8_000_000):
                words, begins = words_of(part.column(0))
                training = part.column(1).to_numpy(zero_copy_only=False)
                coded = words.dictionary_encode()
                codes = coded.indices.to_numpy()
                n = np.bincount(codes, minlength=len(coded.dictionary))
                c = np.bincount(codes[np.repeat(training, np.diff(begins))], minlength=len(n))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([coded.dictionary, pa.array([END])]),
                                                  pa.array(np.append(c, training.sum())), pa.array(np.append(n, len(training)))], ["word", "c", "n"])

    return texts.mapInArrow(run, "word string, c long, n long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def build_vocabulary(top: list[tuple[str, int]], total: int, shape: Shape) -> Vocabulary:
    """Classes of about equal frequency over the most frequent words, the end and "rare"."""
    chosen = [(w, c) for w, c in top if w != END][:shape.words]
    end = next((c for w, c in top if w == END), 0)
    entries = sorted([*chosen, (END, end), (RARE, max(0, total - end - sum(c for _, c in chosen)))], key=lambda e: (-e[1], e[0]))
    weight = np.sqrt(np.array([c + 0.5 for _, c in entries]))
    middle = (np.cumsum(weight) - weight / 2) / weight.sum()
    raw = (middle * shape.classes).astype(np.int64)
    class_of = np.unique(raw, return_inverse=True)[1]
    begins = np.searchsorted(class_of, np.arange(class_of[-1] + 2))
    return Vocabulary({w: i for i, (w, _) in enumerate(entries)}, class_of, begins, np.array([c for _, c in entries], dtype=float))


def initial(vocabulary: Vocabulary, shape: Shape) -> dict[str, np.ndarray]:
    """Random recurrent weights; output biases start at the counts' logarithms."""
    rng = np.random.default_rng(11)
    v, c, h = len(vocabulary.class_of), len(vocabulary.begins) - 1, shape.hidden
    mass = np.array([vocabulary.counts[a:b].sum() + 1 for a, b in zip(vocabulary.begins, vocabulary.begins[1:])])
    return {k: x.astype(np.float32) for k, x in {
        # Input rows hold the words' contributions to both gates and the candidate.
        "input": rng.normal(0, 0.1, (v + 1, 3 * h)), "gates": rng.normal(0, 0.2, (h, 2 * h)), "state": rng.normal(0, 0.2, (h, h)),
        "class_w": np.zeros((h, c)), "class_b": np.log(mass / mass.sum()),
        "word_w": np.zeros((h, v)), "word_b": np.log(vocabulary.counts + 0.5),
    }.items()}


def forward(p: dict, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
    """States after each step of a window: inputs (steps, lanes) -> (steps + 1, lanes, hidden).

    Each gate has a block of its own, so that every operation runs over memory without gaps.
    """
    steps, (lanes, h) = len(inputs), state.shape
    states = np.empty((steps + 1, lanes, h), dtype=state.dtype)
    states[0] = state
    gates = np.empty((steps, 2, lanes, h), dtype=state.dtype)
    fresh = np.empty((steps, lanes, h), dtype=state.dtype)
    # Gates are 1 / (1 + exp(-x)); the sign is changed in the weights.
    to_gates = -p["gates"]
    for_gates = np.empty((2, steps, lanes, h), dtype=state.dtype)
    for k in range(2):
        np.take(-p["input"][:, k * h:(k + 1) * h], inputs, axis=0, out=for_gates[k], mode="clip")
    for_fresh = np.take(np.ascontiguousarray(p["input"][:, 2 * h:]), inputs, axis=0)
    both, reset = np.empty((lanes, 2 * h), state.dtype), np.empty_like(state)
    blocks = both.reshape(lanes, 2, h).transpose(1, 0, 2)
    for t in range(steps):
        before, after, g, n = states[t], states[t + 1], gates[t], fresh[t]
        np.matmul(before, to_gates, out=both)
        np.add(blocks, for_gates[:, t], out=g)
        np.exp(g, out=g)
        g += 1
        np.reciprocal(g, out=g)
        np.multiply(g[0], before, out=reset)
        np.matmul(reset, p["state"], out=n)
        n += for_fresh[t]
        np.tanh(n, out=n)
        np.subtract(before, n, out=after)
        after *= g[1]
        after += n
    return states, (gates, fresh)


def gradients_of(p: dict, vocabulary: Vocabulary, hidden: np.ndarray, targets: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the targets' summed log-probability, of the weights and of the states; entries run down, tokens across."""
    def missed(weights: np.ndarray, part: np.ndarray, bias: np.ndarray, own: np.ndarray) -> np.ndarray:
        x = weights.T @ part
        x += bias[:, None]
        x -= x.max(axis=0)
        np.exp(x, out=x)
        x *= -1 / x.sum(axis=0)
        x.reshape(-1)[own * len(own) + np.arange(len(own))] += 1
        return x

    classes = vocabulary.class_of[targets]
    order = np.argsort(classes.astype(np.int16), kind="stable")
    across = np.ascontiguousarray(hidden[order].T)
    classes, inner = classes[order], targets[order]
    wrong = missed(p["class_w"], across, p["class_b"], classes)
    gradients = {"class_w": across @ wrong.T, "class_b": wrong.sum(axis=1),
                 "word_w": np.zeros_like(p["word_w"]), "word_b": np.zeros_like(p["word_b"])}
    down = p["class_w"] @ wrong
    cuts = np.searchsorted(classes, np.arange(len(vocabulary.begins)))
    for c, (a, b) in enumerate(zip(vocabulary.begins, vocabulary.begins[1:])):
        low, high = cuts[c], cuts[c + 1]
        if high > low and b - a > 1:
            weights, part = p["word_w"][:, a:b], across[:, low:high]
            wrong = missed(weights, part, p["word_b"][a:b], inner[low:high] - a)
            gradients["word_w"][:, a:b] = part @ wrong.T
            gradients["word_b"][a:b] = wrong.sum(axis=1)
            down[:, low:high] += weights @ wrong
    back = np.empty_like(hidden)
    back[order] = down.T
    return gradients, back


def log_likelihood(p: dict, vocabulary: Vocabulary, hidden: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log-probabilities of the targets alone; entries run down, tokens across, so sums are over rows."""
    def chosen(weights: np.ndarray, part: np.ndarray, bias: np.ndarray, own: np.ndarray) -> np.ndarray:
        x = weights.T @ part
        x += bias[:, None]
        high = x.max(axis=0)
        out = x.reshape(-1)[own * len(own) + np.arange(len(own))] - high
        x -= high
        np.exp(x, out=x)
        return out - np.log(x.sum(axis=0))

    classes = vocabulary.class_of[targets]
    order = np.argsort(classes.astype(np.int16), kind="stable")
    across = np.ascontiguousarray(hidden[order].T)
    classes, inner = classes[order], targets[order]
    out = chosen(p["class_w"], across, p["class_b"], classes)
    cuts = np.searchsorted(classes, np.arange(len(vocabulary.begins)))
    for c, (a, b) in enumerate(zip(vocabulary.begins, vocabulary.begins[1:])):
        low, high = cuts[c], cuts[c + 1]
        if high > low and b - a > 1:
            out[low:high] += chosen(p["word_w"][:, a:b], across[:, low:high], p["word_b"][a:b], inner[low:high] - a)
    back = np.empty(len(out))
    back[order] = out
    return back


def windows(documents: list[np.ndarray], start: int, shape: Shape) -> Iterator[tuple]:
    """(inputs, targets, mask, rows, first) of consecutive windows.

    Documents are taken longest first, so the lanes that are still busy are
    always the first ones; each document's windows follow one another.
    """
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    for low in range(0, len(order), shape.lanes):
        group = order[low:low + shape.lanes]
        lengths = np.array([len(documents[i]) for i in group])
        # All tokens of the group behind one another, a start before each document.
        flat = np.concatenate([x for i in group for x in ((start,), documents[i])]).astype(np.int64)
        heads = np.cumsum(lengths + 1) - lengths - 1
        for begin in range(0, lengths[0], shape.window):
            busy = int(np.searchsorted(-lengths, -begin, "left"))
            steps = min(shape.window, int(lengths[0]) - begin)
            at = np.arange(begin, begin + steps)[:, None]
            mask = at < lengths[:busy]
            before = heads[:busy] + np.minimum(at, lengths[:busy] - 1)
            yield np.where(mask, flat[before], start), np.where(mask, flat[before + 1], 0), mask, group[:busy], begin == 0


def window_gradients(p: dict, vocabulary: Vocabulary, inputs: np.ndarray, targets: np.ndarray, mask: np.ndarray,
                     state: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Gradients through one window, the rows of ``input`` that its own gradient belongs to, and the state after it."""
    h = state.shape[1]
    states, (gates, fresh) = forward(p, inputs, state)
    seen = mask.ravel()
    gradients, back = gradients_of(p, vocabulary, states[1:].reshape(-1, h)[seen], targets.ravel()[seen])
    flow = np.zeros((mask.size, h), state.dtype)
    flow[seen] = back
    flow = flow.reshape(*mask.shape, h)
    old, r, z = states[:-1], gates[:, 0], gates[:, 1]
    # What does not depend on later steps is computed for the whole window at once.
    by_fresh = (1 - z) * (1 - fresh * fresh)
    by_z = (old - fresh) * z * (1 - z)
    by_r = old * r * (1 - r)
    given = np.empty((*mask.shape, 3 * h), state.dtype)
    later, kept = np.zeros_like(state), np.empty_like(state)
    to_state, to_gates = p["state"].T.copy(), p["gates"].T.copy()
    for t in range(len(inputs) - 1, -1, -1):
        later += flow[t]
        own, own_fresh = given[t, :, :2 * h], given[t, :, 2 * h:]
        np.multiply(later, by_fresh[t], out=own_fresh)
        np.matmul(own_fresh, to_state, out=kept)
        np.multiply(kept, by_r[t], out=own[:, :h])
        np.multiply(later, by_z[t], out=own[:, h:])
        later *= z[t]
        kept *= r[t]
        later += kept
        later += np.matmul(own, to_gates, out=kept)
    flat_given = given.reshape(-1, 3 * h)
    gradients["gates"] = old.reshape(-1, h).T @ flat_given[:, :2 * h]
    gradients["state"] = (r * old).reshape(-1, h).T @ flat_given[:, 2 * h:]
    flat = inputs.ravel()[seen]
    order = np.argsort(flat.astype(np.int16) if len(p["input"]) < 32_768 else flat, kind="stable")
    flat = flat[order]
    begins = np.flatnonzero(np.diff(flat, prepend=-1))
    gradients["input"] = np.add.reduceat(flat_given[np.flatnonzero(seen)[order]], begins, axis=0)
    return gradients, flat[begins], states[-1]


def train(p: dict, vocabulary: Vocabulary, documents: list[np.ndarray], shape: Shape, squares: dict, rate: float = 0.2) -> None:
    """AdaGrad steps in place, one for each window of a group of documents."""
    start, state = len(vocabulary.class_of), None
    stretches = [d[a:a + shape.stretch] for d in documents for a in range(0, len(d), shape.stretch)]
    size = 1.0 / np.sqrt(shape.lanes * shape.window)
    for inputs, targets, mask, rows, first in windows(stretches, start, shape):
        state = np.zeros((len(rows), shape.hidden), np.float32) if first else state[:len(rows)]
        gradients, used, state = window_gradients(p, vocabulary, inputs, targets, mask, state)
        rows_gradient = gradients.pop("input") * size
        steps = (squares["input"][used] + rows_gradient ** 2).astype(np.float32)
        squares["input"][used] = steps
        p["input"][used] += rate * rows_gradient / np.sqrt(steps)
        for name, gradient in gradients.items():
            gradient *= size
            squares[name] += gradient ** 2
            gradient *= rate
            gradient /= np.sqrt(squares[name])
            p[name] += gradient


def score(p: dict, vocabulary: Vocabulary, documents: list[np.ndarray], shape: Shape, together: int = 32_768) -> np.ndarray:
    """Log-likelihood of each whole document, its state carried across windows; softmax over several windows at once."""
    out, start, state = np.zeros(len(documents)), len(vocabulary.class_of), None
    held: list[tuple] = []
    size = 0

    def settle() -> None:
        logs = log_likelihood(p, vocabulary, *(np.concatenate([w[i] for w in held]) for i in range(2)))
        out[:] += np.bincount(np.concatenate([w[2] for w in held]), logs, len(out))
        held.clear()

    for inputs, targets, mask, rows, first in windows(documents, start, shape):
        state = np.zeros((len(rows), shape.hidden), np.float32) if first else state[:len(rows)]
        states, _ = forward(p, inputs, state)
        state = states[-1]
        seen = mask.ravel()
        held.append((states[1:].reshape(-1, shape.hidden)[seen], targets.ravel()[seen],
                     np.broadcast_to(np.asarray(rows), mask.shape).ravel()[seen]))
        size += len(held[-1][1])
        if size >= together:
            settle()
            size = 0
    if held:
        settle()
    return out


def flatten(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def restore(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size
        out[k] = flat[at:at + size].reshape(like[k].shape).astype(np.float32)
        at += size
    return out


def total_weights(df: DataFrame, tasks: int, width: int = 16) -> tuple[float, np.ndarray] | None:
    """Sum (tokens, weights) rows in a tree whose nodes add at most ``width`` rows."""
    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(w.as_buffer(), np.float64) for w in rows.column("weights"))
        return pa.table({"node": rows.column("node").slice(0, 1),
                         "tokens": pa.array([sum(rows.column("tokens").to_pylist())], pa.float64()),
                         "weights": pa.array([total.tobytes()], pa.binary())})

    while tasks > width:
        df = df.withColumn("node", F.floor(F.col("node") / width)).groupBy("node").applyInArrow(add, df.schema)
        tasks = -(-tasks // width)
    rows = df.collect()
    if not rows:
        return None
    return sum(r["tokens"] for r in rows), sum(np.frombuffer(bytes(r["weights"])) for r in rows)


@dataclass
class Model:
    """Everything that scoring a text needs but the counts of infrequent words."""

    shape: Shape
    vocabulary: Vocabulary
    weights: dict
    frequent: pa.Array
    frequent_id: np.ndarray
    base_log: np.ndarray
    rare_log: np.ndarray
    train_tokens: int
    distinct: int
    rare_total: float

    @property
    def base_total(self) -> float:
        return self.train_tokens + 0.5 * (self.distinct + 1)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Positions in the frequent table, -1 for other words."""
        return pc.index_in(words, value_set=self.frequent).fill_null(-1).to_numpy()


def count_model(counts: DataFrame, shape: Shape, frequent: int = 65_536) -> Model:
    """Totals and the frequent words of stored counts; weights are untrained."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    own = [(r["word"], r["c"]) for r in counts.where("c > 0").orderBy(F.desc("c"), "word").limit(shape.words + 1).collect()]
    vocabulary = build_vocabulary(own, n, shape)
    # The vocabulary's words first, then those most frequent in all texts.
    listed = dict(own) | {END: dict(own).get(END, 0)}
    for r in counts.orderBy(F.desc("n"), "word").limit(frequent).collect():
        listed.setdefault(r["word"], r["c"])
    top = list(listed.items())
    ids = np.array([vocabulary.ids.get(w, vocabulary.ids[RARE]) for w, _ in top], dtype=np.int64)
    c = np.array([c for _, c in top], dtype=np.float64)
    is_rare = ids == vocabulary.ids[RARE]
    inside = int((~is_rare & (c > 0)).sum())
    rare_total = n - c[~is_rare].sum() + 0.5 * (v - inside + 1)
    base_total = n + 0.5 * (v + 1)
    # Unseen words are at the last position, which -1 also means.
    return Model(shape, vocabulary, initial(vocabulary, shape), pa.array([w for w, _ in top], pa.string()),
                 np.append(ids, vocabulary.ids[RARE]), np.append(np.log10((c + 0.5) / base_total), 0.0),
                 np.append(np.where(is_rare, np.log10((c + 0.5) / rare_total), 0.0), 0.0), n, v, rare_total)


#: Training tokens of a shard at most, as an average over shards.
SHARD_TOKENS = 500_000
#: Training tokens for each task of scoring at most, as an average.
SCORED_TOKENS = 3_000_000
#: The wave of documents that are not learned from.
UNTRAINED = -1


def waves(tokens_in_all: int) -> int:
    """Waves of 1, 2, 4, ... shards that hold so many training tokens together."""
    return parts(tokens_in_all, SHARD_TOKENS).bit_length()


def passes(tokens_in_all: int) -> int:
    """How often a corpus is passed: a few documents alone would hardly move the weights."""
    return parts(100_000, max(1, tokens_in_all))


def rest_of(words: pa.Array, rows: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """The distinct words of each of n rows, joined by spaces (null if there are none), and how often each occurs."""
    coded = words.dictionary_encode()
    width = max(1, len(coded.dictionary))
    keys, times = np.unique(rows * width + coded.indices.to_numpy(), return_counts=True)
    begins = np.searchsorted(keys // width, np.arange(n + 1)).astype(np.int32)
    lists = pa.ListArray.from_arrays(begins, coded.dictionary.take(pa.array(keys % width)))
    return (pc.if_else(pa.array(np.diff(begins) > 0), pc.binary_join(lists, " "), pa.scalar(None, pa.string())),
            pa.ListArray.from_arrays(begins, pa.array(times, pa.int32())))


def numbered(rows: DataFrame, model: Model) -> DataFrame:
    """Word numbers and count sums of each row (doc_id, text, training, content), stored by training wave."""
    shipped = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    shards = np.uint64(2 ** waves(model.train_tokens) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = pickle.loads(shipped.value)
        end = own.numbers(pa.array([END]))[0]
        row = TaskContext.get().partitionId() << 33
        known_count = np.append(own.base_log[:-1] > np.log10(0.5 / own.base_total) + 1e-12, False)
        frequent_id = own.frequent_id.astype("<u2")
        for batch in batches:
            content = batch.column("content").to_numpy()
            # Rows repeated as they are go to different shards.
            copies: Counter = Counter()
            nth = np.empty(len(content), np.uint64)
            for i, key in enumerate(content.tolist()):
                nth[i] = copies[key]
                copies[key] += 1
            place = (mixed(content.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * nth) % shards).astype(np.int64)
            wave = np.where(batch.column("training").to_numpy(zero_copy_only=False), np.frexp(place + 1)[1] - 1, UNTRAINED)
            batch = batch.append_column("shard", pa.array(place)).append_column("wave", pa.array(wave, pa.int32()))
            for part in stretches(batch, 1, 4_000_000):
                words, begins = words_of(part.column("text"))
                at = own.numbers(words)
                rest = rest_of(words.filter(pa.array(at < 0)), np.repeat(np.arange(len(part)), np.diff(begins))[at < 0], len(part))
                at = np.insert(at, begins[1:], end)
                begins += np.arange(len(begins))
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((2 * begins).astype(np.int32)), pa.py_buffer(frequent_id[at])])
                known, base, rare = (np.add.reduceat(x[at], begins[:-1]) for x in (known_count.astype(np.int64), own.base_log, own.rare_log))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(part))), part.column("doc_id").cast(pa.int64()), *(part.column(c) for c in ("training", "content", "shard", "wave")), ids,
                     *map(pa.array, (np.diff(begins), known, base, rare)), *rest],
                    ["row", "doc_id", "training", "content", "shard", "wave", "ids", "n_tokens", "n_known", "base", "rare", "rest", "times"])
                row += len(part)

    schema = ("row long, doc_id long, training boolean, content long, shard long, wave int, ids binary, n_tokens long, n_known long, "
              "base double, rare double, rest string, times array<int>")
    return store(rows.mapInArrow(run, schema), "numbered", "wave")


def shard_trainer(shipped: Broadcast, repeats: int) -> Callable[[pa.Table], pa.Table]:
    """A function that trains on one shard (shard, content, ids) and returns its weights and step sizes, times its tokens."""

    def run(group: pa.Table) -> pa.Table:
        shape, arrays, weights, squares = pickle.loads(shipped.value)
        group = group.sort_by([("content", "ascending")])
        held = [np.frombuffer(b.as_buffer(), "<u2").astype(np.int64) for b in group.column("ids")]
        for _ in range(repeats):
            train(weights, Vocabulary({}, *arrays), held, shape, squares)
        seen = float(sum(map(len, held)))
        both = np.concatenate([flatten(weights), flatten(squares)]).astype(np.float64)
        return pa.table({"node": group.column("shard").slice(0, 1), "tokens": pa.array([seen]),
                         "weights": pa.array([(seen * both).tobytes()], pa.binary())})

    return run


def fit(model: Model, found: DataFrame) -> None:
    """Train wave by wave on (wave, shard, content, ids); a wave's weights and step sizes are averaged by tokens."""
    context = found.sparkSession.sparkContext
    squares = {k: np.full(x.shape, 1e-2, np.float32) for k, x in model.weights.items()}
    for wave in range(waves(model.train_tokens)):
        shipped = context.broadcast(pickle.dumps((model.shape, model.vocabulary.arrays, model.weights, squares)))
        # Shards of wave w are numbered from 2^w - 1.
        shards = (found.where(F.col("wave") == wave).select((F.col("shard") - (2 ** wave - 1)).alias("shard"), "content", "ids")
                  .repartition(2 ** wave, "shard").groupBy("shard")
                  .applyInArrow(shard_trainer(shipped, passes(model.train_tokens)), "node long, tokens double, weights binary"))
        summed = total_weights(shards, 2 ** wave)
        if summed:
            mean = summed[1] / summed[0]
            half = len(mean) // 2
            model.weights, squares = restore(mean[:half], model.weights), restore(mean[half:], squares)
        shipped.unpersist()


def score_documents(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """Train on the rows where ``training`` holds and score every row.

    Returns doc_id, training, n_tokens, n_known, train_tokens, base_score and
    score (logarithms to base ten).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"),
                       F.xxhash64(F.col(doc_id), F.col(text)).alias("content"))
    counts = store(word_counts(rows.select("text", "training")), "counts")
    model = count_model(counts, shape)
    found = numbered(rows, model)
    fit(model, found)
    shipped = spark.sparkContext.broadcast(pickle.dumps((model.shape, model.vocabulary.arrays, model.weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_shape, arrays, weights = pickle.loads(shipped.value)
        vocabulary = Vocabulary({}, *arrays)
        for batch in gathered(batches):
            ids = [np.frombuffer(b.as_buffer(), "<u2").astype(np.int64) for b in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score(weights, vocabulary, ids, own_shape) / LOG10)], ["row", "logs"])

    # Words outside the frequent table: their counts come by a join, summed per document.
    rest = found.select("row", F.inline(F.arrays_zip(F.split("rest", " ").alias("word"), "times"))).join(
        counts.where("c > 0").select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rest.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / model.base_total)).alias("more_base"),
        F.sum(F.col("times") * F.log10((c + 0.5) / model.rare_total)).alias("more_rare"))
    # Few large tasks: each takes as many steps as its longest document has tokens.
    tasks = max(2 * spark.sparkContext.defaultParallelism, parts(model.train_tokens, SCORED_TOKENS))
    logs = store(found.select("row", "ids").coalesce(tasks).mapInArrow(run, "row long, logs double"), "logs")
    return found.drop("rest", "times", "ids", "content", "shard", "wave").join(logs, "row").join(sums, "row", "left").select(
        "doc_id", "training", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("logs") + F.col("rare") + F.coalesce("more_rare", F.lit(0.0))).alias("score"))


def gathered(batches: Iterator[pa.RecordBatch], size: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Batches put together, and cut, to about so many bytes of ids."""
    held, total = [], 0
    for batch in batches:
        for first, last in row_ranges(np.cumsum([0, *(len(b.as_buffer()) for b in batch.column("ids"))]), size):
            held.append(batch.slice(first, last - first))
            total += sum(len(b.as_buffer()) for b in held[-1].column("ids"))
            if total >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 5) == 1
