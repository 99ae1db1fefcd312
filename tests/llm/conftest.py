import random

import pytest

EXTRA = ("lang string, source string, n_chars bigint, score double, block int, bucket int, payload binary, kind int, "
         "pattern int, fp bigint, `row` int, word string, key int, piece int, length int, rank int, h bigint")


def prose(rng, n, words="the of and station letter mountain green river under often seven bright was there came".split()):
    return " ".join(rng.choice(words) for _ in range(n))


def awkward_texts():
    """Texts that operators must survive: empty, blank, long, repeated, with odd characters."""
    rng = random.Random(3)
    passage = prose(rng, 60)
    letters = "".join(rng.choice("ab") for _ in range(400))
    return [None, "", " \t\n\x0b\x0c\r ", "a", "Ümlaut und Straße, nicht wahr?", passage, passage, f"{prose(rng, 30)} {passage} end",
            passage.upper(), f"{passage} {passage}", prose(rng, 40_000), "x" * 50_000, "same same " * 300, letters, letters[200:] + letters[:200],
            "*** ||| ### !!! " * 20, "日本語のテキスト😀 " * 10, "one two three four five six seven eight nine ten\n" * 12, "12 34 56 78", "\x00 nul \x00"]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward text, repeated rows, null ids and clashing column names."""
    texts = awkward_texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, texts[5]), (100, texts[5]), (None, "a text without an id, of ten words or so, maybe"), (None, None)]
    blank = [None] * EXTRA.count(",") + [None]
    df = spark.createDataFrame([(i, t, *blank) for i, t in rows], f"doc_id bigint, text string, {EXTRA}")
    return df.repartition(3).cache(), rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
