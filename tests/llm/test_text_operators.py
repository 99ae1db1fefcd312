"""Codec, packing, rules, classifier and language filters against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tests.oracle import compare, connect
from vacantia.llm import langid, packing, pieces, quality, rules
from vacantia.llm.common import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- codec

@pytest.fixture(scope="module")
def codec():
    return pieces.codec(pieces.MODEL)


def best_total(codec, word):
    """Best sum of scores by trying all pieces at all places."""
    values = {p: v for p, (_, _, v) in ((k, codec.automaton.get(k)) for k in codec.automaton.keys())}
    best = [0.0] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(max(0, end - 20), end):
            value = values.get(word[begin:end], codec.unknown_score if end - begin == 1 else None)
            if value is not None:
                best[end] = max(best[end], best[begin] + value)
    return best[-1]


def test_segmentation_is_the_best_one(codec):
    rng = random.Random(5)
    values = {i: v for _, i, v in codec.automaton.values()}
    for _ in range(60):
        text = "".join(rng.choice("the and  ing ßé日") for _ in range(rng.randint(1, 25)))
        ids = codec.encode(text)
        # A character of several bytes without a piece is one unknown.
        lost = sum(c not in codec.singles for c in pieces.SPACE + text.replace(" ", pieces.SPACE))
        total = sum(values[i] for i in ids if i in values) + lost * codec.unknown_score
        assert total == pytest.approx(best_total(codec, pieces.SPACE + text.replace(" ", pieces.SPACE)))


def test_round_trip(spark, awkward, codec):
    df, rows = awkward
    got = pieces.digest(df).collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    back = df.select("doc_id", "text", pieces.decode(pieces.encode(F.col("text"))).alias("b")).collect()
    assert all(r["b"] == (r["text"] or "") for r in back)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_pieces"] == 0 and by_id[17]["n_byte_pieces"] > 0


def test_unknown_characters_become_bytes(codec):
    char = "\U0001F9FF"
    assert [codec.raw[i] for i in codec.encode("a" + char)[-4:]] == [bytes([b]) for b in char.encode()]


def test_codec_of_nothing(nothing):
    assert pieces.digest(nothing).count() == 0


# ---------------------------------------------------------------- packing

def encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def packed_rightly(rows, texts, capacity):
    """Pieces are those of the tokenizer; every sequence is filled without gaps or overlaps."""
    encode, pieces_of = encoder(), Counter()
    for text in texts:
        ids = [*encode(text or ""), 0]
        first = len(ids) % capacity or capacity
        at = 0
        for number, size in enumerate([first] + [capacity] * ((len(ids) - first) // capacity)):
            raw = np.array(ids[at:at + size], dtype="<u4").tobytes()
            pieces_of[number, at, size, zlib.crc32(raw)] += 1
            at += size
    assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces_of
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def best_fit_decreasing(lengths, capacity):
    """Sequences that best fit opens, document by document."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_packing_of_awkward_texts(awkward):
    df, rows = awkward
    got = packing.best_fit_pack(df, 64, group=5).collect()
    count = packed_rightly(got, [t for _, t in rows], 64)
    assert count == best_fit_decreasing([r["length"] for r in got], 64)


def test_packing_of_documents(spark):
    docs = documents(spark, SF)
    got = packing.best_fit_pack(docs, 2048, group=50).collect()
    assert packed_rightly(got, [r["text"] for r in docs.collect()], 2048) == best_fit_decreasing([r["length"] for r in got], 2048)


def test_packing_matches_added_tokens_in_text(spark):
    """Ids are those of the JSON file's tokenizer as it is, which finds its added token inside texts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    oracle = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a  <|endoftext|><|endoftext|>  b\n", "<|endoftext| > <|ENDOFTEXT|>", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pieces(df).collect()}
    for i, text in enumerate(texts):
        ids = [*oracle.encode(text, add_special_tokens=False).ids, packing.END]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
    assert got[0][0] == 5


def test_packing_of_nothing(nothing):
    assert packing.best_fit_pack(nothing).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_equals_best_fit_on_documents(seed):
    rng = random.Random(seed)
    lengths = [min(100, int(rng.paretovariate(1)) + rng.randint(0, 20)) for _ in range(400)]
    slots = packing.plan(Counter(lengths), 100)
    used = {low + i for _, a, b, low, _ in slots for i in range(b - a)}
    assert len(used) == best_fit_decreasing(lengths, 100) == max(used) + 1
    for length, n in Counter(lengths).items():
        assert sorted(r for x, a, b, _, _ in slots if x == length for r in range(a, b)) == list(range(n))


# ---------------------------------------------------------------- rules

def test_rules_against_sql(spark):
    assert compare(rules.quality_rules(documents(spark, SF)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), connect(SF), rules.SQL) is None


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {p for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rule_counts_of_awkward_texts(awkward):
    df, rows = awkward
    got = rules.quality_rules(df).collect()
    found = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    assert found == Counter((i, *counts_of(t)) for i, t in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_verdict_does_not_depend_on_the_order(spark):
    base = rules.base_counts(documents(spark, SF)).cache()
    some = rules.default_rules()
    first, second = (base.where(rules.cascade(some, order).isNull()).select("doc_id").collect() for order in (list(some), list(some)[::-1]))
    assert {tuple(r) for r in first} == {tuple(r) for r in second}


def test_order_puts_the_busy_rule_first(spark):
    sample = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text")).cache()
    order = rules.order_rules(sample, {"never": F.col("doc_id") < 0, "most": F.col("doc_id") > 10})
    assert order == ["most", "never"]


def test_rules_plan_is_native(spark):
    plan = rules.quality_rules(documents(spark, SF))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_of_nothing(nothing):
    assert rules.quality_rules(nothing).count() == 0


# ---------------------------------------------------------------- quality classifier

def test_label_model_finds_the_accuracies():
    """Votes drawn from known accuracies: posteriors match the classes."""
    rng = np.random.default_rng(1)
    n, k = 20_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    right_on_bad = np.linspace(0.3, 0.9, k)
    said_good = np.where(good[:, None], rng.random((n, k)) < 0.995, rng.random((n, k)) > right_on_bad)
    vote = np.where(rng.random((n, k)) < 0.1, quality.NONE, np.where(said_good, quality.GOOD, quality.BAD))
    patterns, number, counts = np.unique(vote @ 3 ** np.arange(k - 1, -1, -1), return_inverse=True, return_counts=True)
    model = quality.fit_labels(patterns, counts.astype(float))
    assert ((model.posterior(patterns)[number] > 0.5) == good).mean() > 0.97
    assert np.abs(1 - model.good_vote[0] - right_on_bad).max() < 0.05 and abs(model.prior - 0.8) < 0.03


def test_classifier_agrees_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.classify(documents(spark, sf)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    bad = [r for r in got if not r["quality"]]
    assert sum(not r["kept"] for r in bad) > 0.9 * len(bad)
    assert sum(r["kept"] for r in got if r["quality"]) >= 0.99 * (len(got) - len(bad))


def test_classifier_of_awkward_texts(awkward, nothing):
    df, rows = awkward
    got = quality.classify(df).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in got)
    assert quality.classify(nothing).count() == 0


# ---------------------------------------------------------------- language filters

def test_filters_hold_every_gram():
    grams = np.unique(np.random.default_rng(2).integers(0, 2 ** 40, 5000).astype(np.uint64))
    table = np.zeros((1, 1 << 16), np.uint8)
    for at in langid.positions(grams, 3, 1 << 16):
        table[0][at] |= 4
    hit = np.bitwise_and.reduce([table[0][at] for at in langid.positions(grams, 3, 1 << 16)])
    assert (hit == 4).all()
    other = np.random.default_rng(4).integers(2 ** 41, 2 ** 42, 20_000).astype(np.uint64)
    share = np.mean(np.bitwise_and.reduce([table[0][at] for at in langid.positions(other, 3, 1 << 16)]) > 0)
    rate = langid.Filters(["a", "b", "c"], table, 3).false_rates()[2]
    assert share == pytest.approx(rate, rel=0.2)


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_labels_are_no_input_of_a_prediction(spark):
    docs = documents(spark, SF)
    swapped = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).drop("source")
    a, b = ({r["doc_id"]: r["lang_pred"] for r in langid.identify(d).collect()} for d in (docs, swapped))
    assert a == b and "xx" not in a.values()


def test_language_of_awkward_texts(spark, awkward, nothing):
    df, rows = awkward
    rng = random.Random(8)
    taught = [(1000 + i, prose(rng, 30), "en") for i in range(40)] + [(2000 + i, prose(rng, 30, "der die das und nicht Straße".split()), "de") for i in range(40)]
    got = {r["doc_id"]: r for r in langid.identify(
        df.select("doc_id", "text", "lang").union(spark.createDataFrame(taught, "doc_id bigint, text string, lang string"))).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 15, 18))
    assert got[4]["lang_pred"] == "de" and got[5]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    # Nothing to learn from: every text is of no known language.
    assert {r["lang_pred"] for r in langid.identify(df).collect()} == {"und"}
    assert langid.identify(nothing).count() == 0


def test_many_languages(spark):
    rng = random.Random(9)
    rows = [(100 * k + i, prose(rng, 40, [f"{chr(97 + k)}{w}" for w in ("ol", "ume", "rata", "pin")]), f"l{k:02d}") for k in range(20) for i in range(12)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id'] // 100:02d}" for r in got)
