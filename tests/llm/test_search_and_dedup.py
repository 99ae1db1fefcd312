"""Top-k search, language model, SimHash and both dedup operators against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import awkward_texts
from tests.oracle import compare, connect
from vacantia.llm import automata, components, lm, queries, repeats, simhash, suffixes, topk
from vacantia.llm.common import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---------------------------------------------------------------- top-k

def test_top_k_against_sql(spark):
    assert compare(queries.QUERIES["op2_exact_top_k"](spark, SF), connect(SF), topk.SQL) is None


def brute_top_k(rows, queries_, k, scale):
    good = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in sorted({(i, tuple(v)) for i, v in good if i in queries_}):
        found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def test_top_k_of_awkward_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.0, 0.02, -0.5, rng.gauss(0, 1)]) for _ in range(rng.choice([8, 8, 8, 5]))]) for i in range(200)]
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (304, []), (None, [1.0] * 8)]
    rows += [rows[7], rows[20], (60, rows[3][1])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id bigint, embedding array<double>, score int, j int")
    got = topk.top_k(df.where("vec_id % 20 = 0"), df, k=7, candidate_block=50, query_block=4).collect()
    assert sorted(tuple(r) for r in got) == brute_top_k(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 7, 64)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df.where("vec_id = 0"), df).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(df.where("vec_id < 0"), df).count() == 0
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


# ---------------------------------------------------------------- language model

def base_scores(rows, training):
    tokens = {n: [*WORD.findall(lower(t)), None] for n, (_, t) in enumerate(rows)}
    c = Counter(w for n, (i, _) in enumerate(rows) if training(i) for w in tokens[n])
    total, kinds = sum(c.values()), len(c)
    return total, [(i, len(tokens[n]), sum(c[w] > 0 for w in tokens[n]),
                    sum(math.log10((c[w] + .5) / (total + .5 * (kinds + 1))) for w in tokens[n])) for n, (i, _) in enumerate(rows)]


def matches(got, rows, training):
    total, wanted = base_scores(rows, training)
    assert all(r["train_tokens"] == total for r in got)

    def key(x):
        return (x[0] is None, x[0] or 0, x[1], x[3])
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
    for a, b in zip(found, sorted(wanted, key=key), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def test_lm_of_documents(spark):
    docs = documents(spark, SF)
    got = queries.QUERIES["op4_lm_scoring"](spark, SF).collect()
    matches(got, [tuple(r) for r in docs.select("doc_id", "text").collect()], lambda i: not held(i))
    unseen = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"]) for r in got)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert sum(r["score"] for r in unseen) > 1.05 * sum(r["base_score"] for r in unseen)


def test_lm_beats_the_base(spark):
    got = queries.QUERIES["op4_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_trains_on_every_training_document(spark, monkeypatch):
    """Each in one shard of one wave, also where one row is repeated very often."""
    seen, fit = [], lm.fit

    def spy(model, found):
        seen.extend(found.select("doc_id", "training", "wave", "shard").collect())
        fit(model, found)

    monkeypatch.setattr(lm, "fit", spy)
    often = next(i for i in range(9) if not held(i))
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, often).otherwise(F.col("id")).alias("doc_id"), F.repeat(F.lit("green river "), 400).alias("text"))
    training = ~lm.held_out(F.col("doc_id"))
    total = lm.score_documents(df, training).first()["train_tokens"]
    assert total > 3 * lm.SHARD_TOKENS
    assert Counter(r["doc_id"] for r in seen if r["wave"] >= 0) == Counter(r["doc_id"] for r in df.where(training).collect())
    assert all((r["wave"] == -1) != r["training"] for r in seen)
    assert all(2 ** r["wave"] - 1 <= r["shard"] < 2 ** (r["wave"] + 1) - 1 for r in seen if r["training"])
    per_shard = Counter(r["shard"] for r in seen if r["training"])
    assert len(per_shard) == 2 ** lm.waves(total) - 1 and max(per_shard.values()) < 1.3 * sum(per_shard.values()) / len(per_shard)


def test_lm_does_not_depend_on_partitions(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = []
    for n in (1, 4, 32):
        rows = lm.score_documents(docs.repartition(n), ~lm.held_out(F.col("doc_id"))).where(~F.col("training"))
        found.append(rows.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first())
    assert max(f[0] for f in found) - min(f[0] for f in found) < 0.001 and min(f[0] - f[1] for f in found) > 0.1


def test_lm_words_and_rest_by_whole_columns():
    """Words of a column without an object each: the same as cutting every text's bytes; other words once a row with their count."""
    texts = [*awkward_texts(), "É\x85a\xa0B\x1cc\u3000d\x0be\x0cF\r\ng  \tİ ", " lead", "trail\n", "AbC abc ABC x AbC"]
    plain = [(t or "").encode().lower().split() for t in texts]
    words, begins = lm.words_of(pa.array(texts).slice(0))
    assert [words[a:b].cast(pa.binary()).to_pylist() for a, b in zip(begins.tolist(), begins[1:].tolist())] == plain
    sliced, cut = lm.words_of(pa.array(["before", *texts, "after"]).slice(1, len(texts)))
    assert sliced.equals(words) and cut.tolist() == begins.tolist()
    rows = np.repeat(np.arange(len(texts)), np.diff(begins))
    rare = np.array([len(w) % 2 == 1 for w in words.to_pylist()])
    joined, times = lm.rest_of(words.filter(pa.array(rare)), rows[rare], len(texts))
    for own, line, n in zip(plain, joined.to_pylist(), times.to_pylist()):
        wanted = Counter(w.decode() for w in own if len(w.decode()) % 2 == 1)
        assert line is None if not wanted else dict(zip(line.split(" "), n, strict=True)) == wanted
    assert [len(x) for x in lm.rest_of(pa.array([], pa.string()), np.zeros(0, np.int64), 2)] == [2, 2]


def test_lm_waves_follow_the_tokens():
    """Small corpora alone are passed more than once; shards hold half to all of SHARD_TOKENS."""
    assert lm.passes(200) == 500 and lm.passes(100_000) == 1 and lm.waves(0) == 1
    for total in (10 ** 5, 10 ** 6, 10 ** 7 + 3, 10 ** 13):
        assert total / (2 ** lm.waves(total) - 1) <= lm.SHARD_TOKENS < 2 * max(total, lm.SHARD_TOKENS) / (2 ** lm.waves(total) - 1) + 1


def test_lm_of_awkward_texts(spark, awkward, nothing):
    df, rows = awkward
    got = lm.score_documents(df, ~lm.held_out(F.col("doc_id"))).collect()
    matches(got, rows, lambda i: not held(i))
    assert all(math.isfinite(r["score"]) for r in got)
    untrained = lm.score_documents(df, F.lit(False)).collect()
    assert len(untrained) == len(rows) and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in untrained)
    assert lm.score_documents(nothing, F.lit(True)).count() == 0


@pytest.fixture(scope="module")
def tiny():
    shape = lm.Shape(words=9, classes=3, hidden=4, window=5, lanes=3)
    vocabulary = lm.build_vocabulary([(w, 20 - i) for i, w in enumerate("abcdefghijk")], 200, shape)
    rng = np.random.default_rng(0)
    weights = {k: (x + rng.normal(0, 0.3, x.shape)).astype(np.float64) for k, x in lm.initial(vocabulary, shape).items()}
    return shape, vocabulary, weights


def plain_score(weights, vocabulary, document, hidden):
    """One token at a time, with the whole softmax."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    h, total, before = np.zeros(hidden), 0.0, len(vocabulary.class_of)
    for token in document:
        given = weights["input"][before]
        g = sigmoid(h @ weights["gates"] + given[:2 * hidden])
        r, z = g[:hidden], g[hidden:]
        n = np.tanh((r * h) @ weights["state"] + given[2 * hidden:])
        h = (1 - z) * n + z * h
        by_class = h @ weights["class_w"] + weights["class_b"]
        by_word = h @ weights["word_w"] + weights["word_b"]
        c = vocabulary.class_of[token]
        inside = by_word[vocabulary.class_of == c]
        total += by_class[c] - np.log(np.exp(by_class).sum()) + by_word[token] - np.log(np.exp(inside).sum())
        before = token
    return total


def test_scores_carry_the_state_through_the_document(tiny):
    shape, vocabulary, weights = tiny
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, len(vocabulary.class_of), n) for n in (1, 23, 7, 5, 12, 10)]
    got = lm.score({k: x.astype(np.float32) for k, x in weights.items()}, vocabulary, docs, shape)
    for g, d in zip(got, docs):
        assert g == pytest.approx(plain_score(weights, vocabulary, d, shape.hidden), rel=1e-4)


def test_softmax_sums_to_one(tiny):
    shape, vocabulary, weights = tiny
    n = len(vocabulary.class_of)
    hidden = np.repeat(np.random.default_rng(2).normal(size=(1, shape.hidden)), n, axis=0)
    assert np.exp(lm.log_likelihood(weights, vocabulary, hidden, np.arange(n))).sum() == pytest.approx(1)


def test_output_gradients_match_differences(tiny):
    shape, vocabulary, weights = tiny
    rng = np.random.default_rng(3)
    hidden, targets = rng.normal(size=(6, shape.hidden)), rng.integers(0, len(vocabulary.class_of), 6)
    gradients, back = lm.gradients_of(weights, vocabulary, hidden, targets)
    for name, spot in (("class_w", (1, 1)), ("class_b", (0,)), ("word_w", (2, 5)), ("word_b", (int(targets[0]),))):
        moved = {**weights, name: weights[name].copy()}
        moved[name][spot] += 1e-6
        rise = (lm.log_likelihood(moved, vocabulary, hidden, targets) - lm.log_likelihood(weights, vocabulary, hidden, targets)).sum() / 1e-6
        assert rise == pytest.approx(gradients[name][spot], rel=1e-3, abs=1e-5)
    moved = hidden.copy()
    moved[0, 0] += 1e-6
    rise = (lm.log_likelihood(weights, vocabulary, moved, targets) - lm.log_likelihood(weights, vocabulary, hidden, targets)).sum() / 1e-6
    assert rise == pytest.approx(back[0, 0], rel=1e-3, abs=1e-5)


def test_a_gate_lies_in_one_block(tiny):
    """Steps run over memory without gaps, and windows are those of each document by itself."""
    shape, vocabulary, weights = tiny
    rng = np.random.default_rng(6)
    docs, start = [rng.integers(0, len(vocabulary.class_of), n) for n in (1, 9, 4, 4, 30, 8, 7)], len(vocabulary.class_of)
    read = {}
    for inputs, targets, mask, rows, first in lm.windows(docs, start, shape):
        _, (gates, _) = lm.forward(weights, inputs, np.zeros((len(rows), shape.hidden)))
        assert gates[0, 0].flags.c_contiguous and gates.shape == (len(inputs), 2, len(rows), shape.hidden)
        assert (inputs[~mask] == start).all() and not targets[~mask].any()
        for lane, i in enumerate(rows):
            assert first == (i not in read)
            held = read.setdefault(i, ([], []))
            held[0].extend(inputs[mask[:, lane], lane])
            held[1].extend(targets[mask[:, lane], lane])
    assert all(read[i] == ([start, *d[:-1]], list(d)) for i, d in enumerate(docs))


def test_gradients_through_time_match_differences(tiny):
    """Recurrent and input weights, through all steps of a window that starts from a carried state."""
    shape, vocabulary, weights = tiny
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, len(vocabulary.class_of), n) for n in (5, 4, 2)]
    inputs, targets, mask, rows, _ = next(lm.windows(docs, len(vocabulary.class_of), shape))
    state = rng.normal(0, 0.5, (len(rows), shape.hidden))

    def total(p):
        states, _ = lm.forward(p, inputs, state)
        return lm.log_likelihood(p, vocabulary, states[1:].reshape(-1, shape.hidden)[mask.ravel()], targets.ravel()[mask.ravel()]).sum()

    gradients, used, after = lm.window_gradients(weights, vocabulary, inputs, targets, mask, state)
    full = np.zeros_like(weights["input"])
    full[used] = gradients["input"]
    assert np.array_equal(after, lm.forward(weights, inputs, state)[0][-1])
    for name, gradient in (("gates", gradients["gates"]), ("state", gradients["state"]), ("input", full)):
        for spot in np.ndindex(gradient.shape):
            up, down = {**weights, name: weights[name].copy()}, {**weights, name: weights[name].copy()}
            up[name][spot] += 1e-5
            down[name][spot] -= 1e-5
            assert (total(up) - total(down)) / 2e-5 == pytest.approx(gradient[spot], rel=1e-4, abs=1e-7)


def test_weights_are_summed_in_a_tree(spark):
    rows = [(i, 1.0, np.array([i, 1.0]).tobytes()) for i in range(70)]
    df = spark.createDataFrame(rows, "node long, tokens double, weights binary")
    tokens, total = lm.total_weights(df, 70, width=4)
    assert tokens == 70 and total.tolist() == [sum(range(70)), 70]


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Least id of each component, from (id, fingerprint) rows."""
    above = {f: f for f in set(f for _, f in fps)}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x
    nodes = sorted(above)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                above[max(x, y)] = min(x, y)
    least = {}
    for i, f in fps:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return [least.get(root(f)) for _, f in fps]


def test_near_duplicates_of_awkward_texts(awkward, nothing):
    df, rows = awkward
    got = simhash.near_duplicates(df).collect()
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    wanted = Counter((i, f"{f:016x}", c) for (i, f), c in zip(fps, plain_components(fps)))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == wanted
    assert simhash.near_duplicates(nothing).count() == 0


def planted(rng, clusters, chain):
    """Fingerprints with chains of small steps, dense groups and noise."""
    out = []
    for _ in range(clusters):
        f = rng.getrandbits(64)
        for _ in range(chain):
            out.append(f)
            for _ in range(rng.choice([1, 2, 3, 3, 4])):
                f ^= 1 << rng.randrange(64)
    return out + [rng.getrandbits(64) for _ in range(200)]


@pytest.mark.parametrize("split", [simhash.SPLIT, 3])
def test_links_lose_nothing(spark, monkeypatch, split):
    """All components, also where large groups of one key are split further."""
    monkeypatch.setattr(simhash, "SPLIT", split)
    rng = random.Random(split)
    fps = sorted(set(planted(rng, 30, 8)))
    center = rng.getrandbits(64)
    fps += sorted({center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)} - set(fps))
    key = np.array(fps, dtype=np.uint64)
    nodes = spark.createDataFrame([(int(x),) for x in key.view(np.int64)], "fp long")
    member = {r["node"]: r["root"] for r in components.components(simhash.links(simhash.candidate_keys(nodes))).collect()}
    groups = {}
    for f, signed in zip(fps, key.view(np.int64).tolist()):
        groups.setdefault(member.get(signed, signed), []).append(f)
    wanted = {}
    for f, c in zip(fps, plain_components([(n, f) for n, f in enumerate(fps)])):
        wanted.setdefault(c, []).append(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_split_of_a_large_group():
    rng = random.Random(4)
    low = rng.getrandbits(32)
    fps = np.array(sorted({low | (rng.getrandbits(6) << 32) | (rng.getrandbits(6) << 50) for _ in range(300)}), dtype=np.uint64)
    forest = simhash.Forest()
    simhash.linked_in(fps, np.zeros(len(fps), bool), 0, forest)
    wanted = plain_components([(i, int(f)) for i, f in enumerate(fps)])
    assert len({forest.root(int(f)) for f in fps}) == len(set(wanted))


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


# ---------------------------------------------------------------- repeated passages

def plain_byte_dedup(rows, window):
    holders = {}
    texts = [((repeats.LAST if i is None else i), i, (t or "").encode()) for i, t in rows]
    for order, _, b in texts:
        for at in range(len(b) - window + 1):
            w = b[at:at + window]
            holders[w] = min(order, holders.get(w, order))
    out = []
    for order, i, b in texts:
        gone = [False] * len(b)
        for at in range(len(b) - window + 1):
            if holders[b[at:at + window]] < order:
                gone[at:at + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def plain_word_dedup(rows, window):
    first = {}
    texts = [((repeats.LAST if i is None else i), i, (t or "").encode().split()) for i, t in rows]
    for order, _, words in texts:
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            first[key] = min((order, at), first.get(key, (order, at)))
    out = []
    for order, i, words in texts:
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < (order, at):
                gone[at:at + window] = [True] * window
        kept = b" ".join(x for x, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def patchwork(seed, n, alphabet, joiner):
    """Texts cut and pasted from few snippets, so that repeats overlap in all ways."""
    rng = random.Random(seed)
    snippets = [joiner.join(rng.choice(alphabet) for _ in range(rng.randint(3, 80))) for _ in range(12)]
    return [(i, joiner.join(rng.choice(snippets)[rng.randint(0, 9):] for _ in range(rng.randint(0, 7)))) for i in range(n)]


@pytest.mark.parametrize("frequent", [1024, 3])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é"])
def test_byte_dedup_of_patchwork(spark, monkeypatch, frequent, alphabet):
    kind = suffixes.bytes_kind
    monkeypatch.setattr(suffixes, "bytes_kind", lambda w: replace(kind(w), frequent=frequent))
    rows = patchwork(frequent, 60, alphabet, "")
    got = suffixes.digest(spark.createDataFrame(rows, "doc_id bigint, text string"), 50).collect()
    assert sorted(map(tuple, got)) == sorted(plain_byte_dedup(rows, 50))


@pytest.mark.parametrize("frequent", [1024, 3])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh"])
def test_word_dedup_of_patchwork(spark, monkeypatch, frequent, alphabet):
    kind = automata.words_kind
    monkeypatch.setattr(automata, "words_kind", lambda w: replace(kind(w), frequent=frequent))
    rows = patchwork(frequent, 60, alphabet, " ")
    got = automata.digest(spark.createDataFrame(rows, "doc_id bigint, text string"), 20).collect()
    assert sorted(map(tuple, got)) == sorted(plain_word_dedup(rows, 20))


def test_dedup_of_awkward_texts(awkward, nothing):
    df, rows = awkward

    def key(x):
        return str(x)
    assert sorted((tuple(r) for r in suffixes.digest(df).collect()), key=key) == sorted(plain_byte_dedup(rows, 50), key=key)
    assert sorted((tuple(r) for r in automata.digest(df).collect()), key=key) == sorted(plain_word_dedup(rows, 20), key=key)
    assert suffixes.digest(nothing).count() == automata.digest(nothing).count() == 0


def test_spans_are_the_removed_bytes(spark):
    passage = "a passage that is long enough to be found again, word by word and byte by byte. "
    df = spark.createDataFrame([(1, passage), (2, f"before {passage}after"), (None, passage)], "doc_id bigint, text string")
    assert sorted((tuple(r) for r in suffixes.spans(df).collect()), key=str) == [(2, 7, 7 + len(passage)), (None, 0, len(passage))]


def test_cut_keeps_columns_and_clean_texts(awkward):
    df, rows = awkward
    out = automata.cut(df)
    assert out.schema == df.schema
    wanted = {i: (n, h) for i, n, g, h in plain_word_dedup(rows, 20) if not g}
    removed = {i: h for i, _, g, h in plain_word_dedup(rows, 20) if g}
    texts = {i: t for i, t in rows}
    for r in out.collect():
        if r["doc_id"] in removed:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == removed[r["doc_id"]]
        elif r["doc_id"] in wanted and r["doc_id"] is not None:
            assert r["text"] == texts[r["doc_id"]]


def test_automaton_holds_exactly_the_substrings():
    rng = random.Random(6)
    for _ in range(30):
        known = [[rng.randint(0, 2) for _ in range(rng.randint(1, 15))] for _ in range(4)]
        automaton = automata.Automaton()
        for s in known:
            automaton.add(s)
        asked = [rng.randint(0, 3) for _ in range(25)]
        held_ = {tuple(s[a:b]) for s in known for a in range(len(s)) for b in range(a, len(s) + 1)}
        wanted = [max(n for n in range(end + 1) if tuple(asked[end - n:end]) in held_) for end in range(1, 26)]
        assert automaton.match(asked) == wanted


@pytest.mark.parametrize("seed", range(8))
def test_merge_sorts_and_knows_common_prefixes(seed):
    rng = random.Random(seed)
    runs = []
    for _ in range(rng.randint(1, 9)):
        right = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 20))})
        common, length, rest = repeats.front_coded(right)
        shared, decoded = repeats.front_decoded(common, length, rest)
        assert decoded == right
        runs.append(repeats.Run(shared, right, [b""] * len(right), [(0, 0)] * len(right)))
    out = list(suffixes.merge(runs))
    merged = [runs[r].right[e] for r, e, _ in out]
    assert merged == sorted(x for r in runs for x in r.right)
    for (a, b), (_, _, common) in zip(zip(merged, merged[1:]), out[1:]):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert common == n
