"""Lexicons and rules as tables, against the list forms and brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vacantia.functions import skills, vocab
from vacantia.operators import phrases

WORDS = ["python", "sql", "c", "c++", "c#", ".net", "node.js", "power", "bi", "react", "native", "r", "the", "é", "naïve", "r&d", "ci/cd", "x_y"]


def texts(rng, n):
    return ["".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", ", ", "", "-", "\n"]) for _ in range(rng.randrange(25))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "id bigint, t string, core string")


def test_as_the_list_form(spark):
    """Symbols, boundaries and separators as whole_words has them."""
    rng = random.Random(1)
    lexicon = [*vocab.SKILLS_FULL, "power bi", "c", "c++", "c#", ".net", "node.js", "react native", "power  bi", "ci/cd", "the c++", "é", "r&d", "x_y", "-r"]
    df = frame(spark, [*texts(rng, 300), None, "", "   ", "+++", "python", "c++x c++ daily .netc x.net"])
    table = spark.createDataFrame([(s.upper() if rng.random() < .2 else s,) for s in lexicon] + [(None,), ("",), ("+",)], "p string")
    got = {r["id"]: r["found"] for r in phrases.with_phrases(df, ["id"], "t", table, "p").collect()}
    wanted = {r["id"]: r["f"] for r in df.select("id", skills.whole_words(F.col("t"), list(dict.fromkeys(lexicon))).alias("f")).collect()}
    assert got == wanted and sum(map(len, got.values())) > 1000


def test_a_hundred_thousand_phrases(spark):
    """The plan stays small and without a nested loop, and the rows are those of brute force."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    lexicon = list({" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 2, 3, 3, 4]))) for _ in range(130_000)})
    assert len(lexicon) > 100_000
    rows = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(150)] + ["w1 " * 2000]
    df = phrases.phrases_in(frame(spark, rows), ["id"], "t", spark.createDataFrame([(p,) for p in lexicon], "p string"), "p")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and len(plan) < 100_000
    known, wanted = set(lexicon), set()
    for i, text in enumerate(rows):
        words = re.findall(r"\w+", text)
        wanted |= {(i, w) for n in range(1, 5) for k in range(len(words)) if (w := " ".join(words[k:k + n])) in known and k + n <= len(words)}
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == wanted


def test_first_rule(spark):
    rules = spark.createDataFrame([("nation one", "a", 2), ("one", "b", 5), ("two", "c", 1), ("two", "d", 1), ("ONE", "e", 3), (None, "z", 0)], "p string, l string, n int")
    df = frame(spark, ["Nation One two", "one", "nation ones", None, "nation  one", "two"])
    got = {r["id"]: r["label"] for r in phrases.first_rule(df, ["id"], "t", rules, "p", "l", "n", "none").collect()}
    assert got == {0: "c", 1: "e", 2: "none", 3: "none", 4: "e", 5: "c"}


@pytest.mark.parametrize("lexicon", [[], [None], ["++"]])
def test_nothing_to_find(spark, lexicon):
    table = spark.createDataFrame([(p,) for p in lexicon], "p string")
    df = frame(spark, ["one", None])
    assert phrases.phrases_in(df, ["id"], "t", table, "p").count() == 0
    assert [r["found"] for r in phrases.with_phrases(df, ["id"], "t", table, "p").collect()] == [[], []]
    assert phrases.phrases_in(df.limit(0), ["id"], "t", spark.createDataFrame([("a",)], "p string"), "p").count() == 0


def test_a_small_lexicon_is_broadcast(spark, monkeypatch):
    """Windows are made once and not exchanged; a lexicon above the limit finds the same."""
    rng = random.Random(4)
    df = frame(spark, texts(rng, 100))
    lexicon = spark.createDataFrame([(p,) for p in ["c++", "power bi", "react native", ".net", "the", "r&d", "é"]], "p string")
    small = phrases.phrases_in(df, ["id"], "t", lexicon, "p")
    plan = small._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("split(") == 1
    monkeypatch.setattr(phrases, "SMALL", 3)
    large = phrases.phrases_in(df, ["id"], "t", lexicon, "p")
    assert set(map(tuple, small.collect())) == set(map(tuple, large.collect())) and small.count() > 100
