"""Spelling variants and whitening against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vacantia.llm import variants, whitening
from vacantia.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_counts(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at:] == b[at + 1:] or (len(a) == len(b) and a[at + 1:] == b[at + 1:])


def plain_variants(n):
    near, shapes = defaultdict(set), defaultdict(set)
    for w in n:
        for rest in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            shapes[rest].add(w)
    for group in shapes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def got_variants(df):
    rows = df.collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_variants_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = plain_variants(plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert got_variants(QUERIES["op11_spelling_variants"](spark, SF)) == wanted
    assert any(v[0] for v in wanted.values())


@pytest.mark.parametrize("crowd", [2, 2048])
def test_variants_of_crowded_words(spark, crowd):
    """Words with common halves, chains of forms, ties; crowded keys go by deletions and give the same."""
    rng, n = random.Random(5), {}
    for k in range(40):
        base = "".join(rng.choice("abé") for _ in range(rng.choice([7, 8, 9, 40])))
        for step in range(30):
            at, kind = rng.randrange(len(base)), rng.randrange(3) if len(base) > 7 else 1
            base = base[:at] + ("" if kind == 0 else rng.choice("abéx")) + base[at + (kind < 2):]
            if len(base) >= 7:
                n[base] = rng.choice([2, 2, 20, 25, 250, 3000])
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got_variants(variants.spelling_variants(words, crowd=crowd)) == plain_variants(n)


def test_variants_follow_forms_to_the_last(spark):
    chain = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zbcdefg": 20, "zzzzzzz": 2}
    got = got_variants(variants.spelling_variants(spark.createDataFrame(list(chain.items()), "word string, n long")))
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij", 2, 2, 20)
    assert got["zzzzzzz"] == (None, "zzzzzzz", 2, 0, None)


def test_variants_of_awkward_texts(spark, awkward, nothing):
    df, rows = awkward
    twice = df.union(df)
    wanted = plain_variants(plain_counts([*rows, *rows]))
    assert got_variants(variants.spelling_variants(variants.counts(twice))) == wanted
    assert variants.spelling_variants(variants.counts(nothing)).count() == 0


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, 1.0, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, component int, n double, x string")


def checked_whitening(rows, got, components=16):
    """Compare with a dense eigensolver; rows are (id, usable vector)."""
    exact = {tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for _, v in rows}
    x = np.array(sorted(exact), dtype=np.int64)
    n, total = len(x), x.sum(axis=0)
    y = x - total / n
    covariance = y.T @ y / n
    e, q = np.linalg.eigh(covariance)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    keep = e > 1e-9 * np.trace(covariance)
    by_row = Counter((r["vec_id"], r["component"]) for r in got)
    ids = Counter(i for i, _ in rows)
    assert by_row == {(i, k + 1): m for i, m in ids.items() for k in range(keep.sum())}
    deviation = {i: sum((n * (int(np.floor(64 * float(c))) + 1_000_000) - int(s)) ** 2 for c, s in zip(v, total)) for i, v in rows}
    sizes = {i: np.abs((np.floor(64 * np.array(v, dtype=float)) + 1_000_000 - total / n) @ q / np.sqrt(np.where(keep, e, 1))) for i, v in rows}
    distinct = [k for k in range(int(keep.sum())) if all(abs(e[k] - o) > 1e-6 * e[0] for j, o in enumerate(np.linalg.eigvalsh(covariance)[::-1]) if j != k)]
    for r in got:
        k = r["component"] - 1
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(e[k] / np.trace(covariance), rel=1e-9)
        if ids[r["vec_id"]] == 1:
            assert r["deviation"] == deviation[r["vec_id"]]
            if k in distinct:
                assert abs(r["whitened"]) == pytest.approx(sizes[r["vec_id"]][k], abs=1e-8)


def test_whitening_of_embeddings(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    checked_whitening(rows, QUERIES["op12_embedding_whitening"](spark, SF).collect())


def test_whitening_of_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(5)] + [0.5, 0.5]) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (101, rows[4][1]), (None, rows[5][1])]
    bad = [(200, None), (201, [None] * 7), (202, [float("nan")] * 7), (203, [float("inf")] + [0.0] * 6)]
    got = whitening.whiten(vectors(spark, rows + bad)).collect()
    checked_whitening(rows, got)
    assert {r["component"] for r in got} == set(range(1, 6))
    short = whitening.whiten(vectors(spark, [(1, [1.0]), (2, [0.0, 1.0]), (3, [])])).collect()
    checked_whitening([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], short)
    for none in ([], bad, [(1, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(vectors(spark, none)).count() == 0


def test_deviations_beyond_small_numbers_are_exact(spark):
    rows = [(i, [float(i * 2 ** 19), float(i % 3)]) for i in range(12)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(vectors(spark, rows, "double")).collect() if r["component"] == 1}
    x = [[int(64 * v) + 1_000_000 for v in row] for _, row in rows]
    total = [sum(c) for c in zip(*x)]
    assert got == {i: sum((12 * v - s) ** 2 for v, s in zip(x[i], total)) for i in range(12)}


def spectrum(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [[5, 5, 5, 1, 0, 0], [1.0] * 20, [400, *np.linspace(60, 80, 60)], list(10.0 ** -np.arange(9)),
                                    [7 + 1e-13 * k for k in range(12)] + [1, 2], [3.0], [0.0, 0.0]])
def test_contour_integration_finds_the_leading_pairs(values):
    v = spectrum(values, len(values))
    found, rows = whitening.leading((v + v.T) / 2, 16)
    wanted = [x for x in sorted(values, reverse=True)[:16] if x > 1e-11 * max(values)]
    assert found == pytest.approx(wanted, rel=1e-6, abs=1e-13 * max(values))
    assert np.abs(rows @ rows.T - np.eye(len(found))).max(initial=0) < 1e-10
    assert np.abs(v @ rows.T - rows.T * found).max(initial=0) < 1e-12 * max(1, max(values))


def test_inertia_counts_negative_eigenvalues():
    rng = np.random.default_rng(2)
    for n in range(1, 15):
        a = rng.standard_normal((n, n))
        a = a + a.T
        np.fill_diagonal(a, 0 if n % 2 else a.diagonal())
        assert whitening.inertia(a) == (np.linalg.eigvalsh(a) < 0).sum()
