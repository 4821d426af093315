"""Collocations, multi-index search and whitening against plain Python and numpy."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, documents, lower
from pyspark.sql import functions as F

from recordforge.llm import collocations, multi_index, queries, whitening
from recordforge.llm.common import table

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>"


# ---- collocations

def phrase_counts(rows, longest=4):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang or "und"][tuple(w[i:i + k])] += 1
    return counts


def brute_phrases(rows, min_count, top=2000, longest=4):
    out = []
    for lang, f in phrase_counts(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * c >= 80 * a and inside(p, q) for q, c in candidates.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n, -s) for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def awkward_corpus(spark):
    rng = random.Random(5)
    pool = ["New", "new", "york", "City", "a", "É", "é", "x.y", "\t", "\n", "b,", "\x0c", "c d", "d", "e!"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(60)] + AWKWARD
    docs = documents(spark, texts, lang={k: [None, "en", "und", "de"][k % 4] for k in range(len(texts))})
    return docs.unionByName(docs.where("doc_id < 9")).withColumns({"prefix": F.lit(1), "phrase": F.lit("p"), "n": F.lit(2)})


@pytest.mark.parametrize("longest", [2, 4])
def test_phrases_match_brute_force(spark, longest):
    docs = awkward_corpus(spark)
    got = collocations.mine_phrases(docs, min_count=3, max_words=longest)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 3, longest=longest)
    best = collocations.mine_phrases(docs, min_count=3, top=2, max_words=longest).collect()
    assert sorted(map(tuple, best)) == brute_phrases(rows, 3, top=2, longest=longest)


def test_phrases_do_not_depend_on_the_pair_filter(spark):
    docs = awkward_corpus(spark)
    full = collocations.mine_phrases(docs, min_count=3, filter_bits=32)  # lets nearly every pair through
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, collocations.mine_phrases(docs, min_count=3).collect()))


def test_phrases_of_no_text(spark):
    docs = documents(spark, [None, "", " ", "one"])
    assert collocations.mine_phrases(docs).count() == 0
    assert collocations.mine_phrases(docs.limit(0)).count() == 0


def test_stripes_of_a_text_counted_in_chunks(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "bb", "ccc", "d.", "é"]) for _ in range(400)), "", "x" * 300, "a bb\n" * 50, "a bb"]
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 23)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 7)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en", "de", "en"]), pa.array([t.encode() for t in texts])], ["lang", "text"])

    class Everything:
        value = b"\xff" * 8

    got = Counter()
    for build in (collocations._short_stripes(4), collocations._long_stripes(4, Everything, 64)):
        for rows in build(iter([batch])):
            for r in rows.to_pylist():
                for w, n in zip(r["words"], r["counts"]):
                    got[r["lang"], " ".join(x for x in (r["prefix"], w) if x)] += n if w or r["prefix"] else 0
    want = Counter({(lang, " ".join(p)): c for lang, f in phrase_counts(zip(["en", "de", "en", "de", "en"], texts)).items() for p, c in f.items()})
    assert +got == want


# ---- nearest neighbours

def brute_neighbours(rows, k, is_query):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in rows:
        if is_query(i):
            near = sorted((-math.fsum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i)
            out[i] = near[:k]
    return out


def test_neighbours_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(4)
    # whole numbers: products are exact and ties are real
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # a hot vector, asked for more than once
    odd = [(500, None), (501, []), (502, [0.0] * 6), (503, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (504, [float("nan")] * 6),
           (505, [float("inf")] * 6), (506, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + odd + rows[:3], VECTORS).withColumns({"__node": F.lit(1), "score": F.lit("x")})
    want = brute_neighbours(rows, 5, lambda i: i % 20 == 0)
    for settings in ({}, {"group_rows": 16, "group_queries": 2, "centroids": 4}):
        got = defaultdict(list)
        for r in multi_index.nearest_neighbours(df, k=5, is_query=F.col("vec_id") % 20 == 0, **settings).collect():
            got[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
        assert {q: [(s, i) for _, s, i in sorted(x)] for q, x in got.items()} == want
        assert all([rank for rank, *_ in sorted(x)] == list(range(1, 6)) for x in got.values())


def test_neighbours_when_there_are_few(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5])], VECTORS)
    assert [tuple(r) for r in multi_index.nearest_neighbours(df, is_query=F.col("vec_id") == 20).collect()] == [(20, 1, 1, 0.5)]
    assert multi_index.nearest_neighbours(df.limit(0)).count() == 0
    assert multi_index.nearest_neighbours(df.where("vec_id = 1")).count() == 0
    assert multi_index.nearest_neighbours(spark.createDataFrame([(1, [0.0])], VECTORS)).count() == 0
    assert multi_index.nearest_neighbours(spark.createDataFrame([(1, [2.0]), (2, [3.0])], VECTORS)).count() == 2


def recall(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    asked = np.flatnonzero(ids % 20 == 0)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    got = defaultdict(dict)
    for r in queries.QUERIES["op12_nearest_neighbours"](spark, sf).collect():
        got[r["query_id"]][r["vec_id"]] = r["score"]
    assert set(got) == set(ids[asked].tolist()) and all(len(g) == 20 for g in got.values())
    hits = 0
    for k, i in enumerate(asked):
        found = got[int(ids[i])]
        assert np.allclose([scores[k, np.flatnonzero(ids == j)[0]] for j in found], list(found.values()), rtol=0, atol=1e-12)
        hits += len(set(found) & set(ids[np.lexsort((ids, -scores[k]))[:20]].tolist()))
    return hits / (20 * len(asked))


def test_neighbour_query_recall(spark):
    assert recall(spark, "/root/testdata/sf0.1") >= 0.95


def test_walk_order_and_groups():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal(7), rng.standard_normal(5)
    sums = [a[i] + b[j] for i, j in multi_index.best_pairs(a, b)]
    assert len(sums) == 35 and sums == sorted(sums, reverse=True)
    plan = multi_index.lay_out([(1, 3), (2, 4), (5, 25), (6, 2), (9, 9)], 10)
    assert plan == {1: (0, 1), 2: (0, 1), 5: (1, 3), 6: (4, 1), 9: (5, 1)}


# ---- whitening

@pytest.mark.parametrize("size", [1, 2, 9, 64])
def test_components_match_eigh(size):
    rng = np.random.default_rng(size)
    base = rng.standard_normal((size, size))
    q, _ = np.linalg.qr(base)
    spectra = (base @ base.T, np.eye(size) * 3, np.ones((size, size)), q @ np.diag(10.0 ** -np.linspace(0, 14, size)) @ q.T,
               q @ np.diag(np.repeat([5.0, 1.0], [size // 2, size - size // 2])) @ q.T, np.zeros((size, size)))
    for a in spectra:
        a = (a + a.T) / 2
        e, v = whitening.components(a, 8)
        assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:8], rtol=0, atol=1e-13 * max(1e-300, np.linalg.norm(a)))
        assert np.linalg.norm(a @ v - v * e) <= 1e-13 * max(1e-300, np.linalg.norm(a)) or not a.any()
        assert np.allclose(v.T @ v, np.eye(len(e)), atol=1e-13)


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    e = np.r_[np.geomspace(1e-9, 1, 10), -np.geomspace(1e-9, 1, 10)]
    u = whitening.polar_factor(q @ np.diag(e) @ q.T)
    assert np.allclose(u, q @ np.diag(np.sign(e)) @ q.T, atol=1e-6)
    assert np.allclose(u @ u.T, np.eye(20), atol=1e-12)


def test_whitening_query_matches_numpy(spark):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    x = np.floor(1024 * np.array([r[1] for r in rows], dtype=np.float64)) + 100_000
    n, sums = len(x), x.sum(axis=0).astype(int).tolist()
    centred = x - x.mean(axis=0)
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:8], v[:, ::-1][:, :8]
    want = centred @ v / np.sqrt(e)
    got = queries.QUERIES["op13_embedding_whitening"](spark, SF).collect()
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    by = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(1, 9):
        mine = np.array([by[r[0], c]["whitened"] for r in rows])
        assert np.allclose(mine, want[:, c - 1] * np.sign(mine @ want[:, c - 1]), atol=1e-8)
        assert abs(by[rows[0][0], c]["explained"] / (e[c - 1] / np.trace(cov)) - 1) < 1e-10
    for k, r in enumerate(rows):
        assert by[r[0], 1]["deviation"] == sum((n * int(a) - s) ** 2 for a, s in zip(x[k].tolist(), sums))
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_whitening_defined_cases(spark):
    odd = [(500, None), (501, []), (503, [1.0, None]), (504, [float("nan"), 1.0]), (505, [float("inf"), 1.0]), (506, [1.0])]
    rows = [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (2, [2.0, 5.0]), (None, [4.0, 5.0])]
    df = spark.createDataFrame(rows + odd, VECTORS).withColumns({"n": F.lit("x"), "component": F.lit(1), "__vec": F.lit(2)})
    got = whitening.whiten(df).collect()
    assert sorted(map(str, (r["vec_id"] for r in got))) == sorted(["1", "2", "2", "None"] * 2)
    first = {r["vec_id"]: r for r in got if r["component"] == 1}
    x = [101_024, 102_048, 102_048, 104_096]
    assert {i: first[i]["deviation"] for i in (1, 2)} == {1: (4 * x[0] - sum(x)) ** 2, 2: (4 * x[1] - sum(x)) ** 2}
    assert first[1]["explained"] == 1.0 and first[1]["n"] == 4
    values = np.array([r["whitened"] for r in got if r["component"] == 1])
    assert abs(values.mean()) < 1e-12 and abs((values ** 2).mean() - 1) < 1e-12
    assert all(r["whitened"] is None and r["explained"] == 0 for r in got if r["component"] == 2)  # a constant column
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id = 1")).where("whitened is not null").count() == 0  # one vector has no variance


def test_deviations_beyond_products_of_longs():
    x = np.array([[1e9, 3.0], [0.0, 5.0]])
    assert whitening._deviations(x, 3, [7, 8]) == [(3 * 10 ** 9 - 7) ** 2 + 1, 49 + 49]
    assert whitening._deviations(x, 10 ** 6, [0, 0])[0] is None
