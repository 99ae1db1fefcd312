"""The pipeline: every stage on its own input, and the whole."""

import hashlib
import random

import corpus_pipeline
from tests.llm.test_search_and_dedup import plain_components, plain_fingerprint, plain_word_dedup
from tests.llm.test_text_operators import best_fit_decreasing, packed_rightly
from vacantia.llm import copies, stages
from vacantia.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    """Each stage against brute force on what the stage before kept."""
    docs = documents(spark, SF)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    schema, before = docs.schema, docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, before, SF)
        assert after.schema.names == schema.names and [f.dataType for f in after.schema] == [f.dataType for f in schema]
        after = spark.createDataFrame(after.collect(), schema)
        old, new = ({r["doc_id"]: r for r in d.collect()} for d in (before, after))
        if number == 0:
            good = [i for i in old if labels.get(i) == 1]
            assert sum(i in new for i in good) >= 0.99 * len(good)
            assert sum(i in new for i in old if labels.get(i) == 0) <= 0.25 * sum(v == 0 for v in labels.values())
        if number == 1:
            assert len(new) >= 0.99 * len(old)
        if number == 2:
            assert set(new) == set(jaccard_components([(i, r["text"]) for i, r in old.items()]).values())
        if number == 3:
            wanted = plain_word_dedup([(i, r["text"]) for i, r in sorted(old.items())], 20)
            for i, _, gone, digest in wanted:
                text = new[i]["text"]
                assert new[i]["n_chars"] == len(text)
                assert hashlib.sha256(text.encode()).hexdigest() == digest if gone else text == old[i]["text"]
        if number < 3:
            assert all(new[i] == old[i] for i in new)
        before = after
    got = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert packed_rightly(got, [r["text"] for r in before.collect()], 2048) == best_fit_decreasing([r["length"] for r in got], 2048)


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert len(out) > 100 and max(r["offset"] + r["length"] for r in out) <= 2048


def test_stages_of_awkward_texts(spark, awkward, nothing):
    df, rows = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SF).schema.names == df.columns
        assert stage(spark, nothing, SF).count() == 0
    assert stages.best_fit_packing(spark, nothing, SF).count() == 0


def test_near_dedup_of_awkward_rows(spark, awkward):
    """One row for each component and for each id; rows without an id stay."""
    df, rows = awkward
    got = [r["doc_id"] for r in stages.simhash_near_dedup(spark, df, SF).collect()]
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    keep = {c for c in plain_components(fps) if c is not None}
    assert sorted(i for i in got if i is not None) == sorted(keep)
    assert got.count(None) == sum(i is None for i, _ in rows)


def test_language_stage_drops_text_without_letters(spark):
    prose = "the green river under the mountain was often there and bright " * 3
    df = spark.createDataFrame([(i, prose, "en", "s", len(prose)) for i in range(40)] + [(99, "123 !!! ???", "en", "s", 11), (98, None, None, None, None)],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["doc_id"] for r in stages.language_id(spark, df, SF).collect()}
    assert kept == set(range(40))


def five_word_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if len(words) < 5 else set(zip(*(words[i:] for i in range(5))))


def jaccard_components(rows):
    """Least ids of the components of pairs with a similarity of 0.8 or more, by brute force."""
    above, found = {i: i for i, _ in rows}, [(i, five_word_sets(t)) for i, t in rows]
    for k, (i, a) in enumerate(found):
        for j, b in found[:k]:
            if len(a & b) >= 0.8 * len(a | b):
                old, new = max(above[i], above[j]), min(above[i], above[j])
                above = {x: new if c == old else c for x, c in above.items()}
    return above


def test_near_dedup_finds_all_pairs_at_four_fifths(spark):
    """Copies with a few words edited are many bits apart, yet one of each group stays."""
    rng, rows = random.Random(7), []
    for group in range(60):
        text = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 120, 600]))]
        for edits in (0, 1, 2, 3):
            changed = list(text)
            for at in rng.sample(range(len(text)), max(edits and 1, len(text) * edits // 150)):
                changed[at] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(changed)))
    wanted = jaccard_components(rows)
    assert len(set(plain_components([(i, plain_fingerprint(t)) for i, t in rows]))) > len(set(wanted.values()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in stages.simhash_near_dedup(spark, df, SF).collect()} == set(wanted.values())
    docs = documents(spark, SF)
    wanted = jaccard_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: r["component_id"] for r in copies.near_copies(docs).collect()}
    assert got == wanted


def test_large_groups_are_split_without_a_loss(spark, monkeypatch):
    """Chains through the members of one large group are found whether or not its keys are dealt into blocks."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for k in range(220):
        changed = list(base)
        for at in rng.sample(range(150), rng.randrange(6)):
            changed[at] = f"x{rng.randrange(5000)}"
        rows.append((k, " ".join(changed)))
    wanted = jaccard_components(rows)
    assert 3 < len(set(wanted.values())) < 150
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for members in (512, 16):
        monkeypatch.setattr(copies, "MEMBERS", members)
        assert {r["doc_id"]: r["component_id"] for r in copies.near_copies(df).collect()} == wanted


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    """The copy under a larger id goes; the other text of that id, and both texts of id 1, stay."""
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    rows = [(1, texts["a"]), (1, texts["b"]), (2, texts["a"]), (2, texts["c"]), (2, texts["c"]), (3, texts["d"] + " end"), (3, texts["d"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [tuple(r) for r in stages.simhash_near_dedup(spark, df, SF).collect()]
    assert sorted(kept)[:3] == sorted([(1, texts["a"]), (1, texts["b"]), (2, texts["c"])])
    assert len(kept) == 4 and kept.count((3, texts["d"])) + kept.count((3, texts["d"] + " end")) == 1


def test_no_document_vouches_for_its_own_language(spark):
    """A text like no other goes whether or not the filters learned from it."""
    prose = "the green river under the mountain was often there and bright " * 3
    odd = [(100 + i, " ".join("".join(random.Random(i * 100 + k).choices("bcdfghjklmnpqrstvwxz", k=9)) for k in range(30))) for i in range(8)]
    df = spark.createDataFrame([(i, t, "en") for i, t in [*((i, prose) for i in range(40)), *odd]], "doc_id bigint, text string, lang string")
    assert {r["doc_id"] for r in stages.language_id(spark, df, SF).collect()} == set(range(40))
