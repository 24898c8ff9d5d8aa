from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexforge.llm import near_duplicates as nd
from lexforge.llm.components import components
from lexforge.llm.embedding_dedup import near_vectors, spherical_kmeans

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grouped(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = {}
    for k, t in docs:
        sets.setdefault(k, []).append(shingles(t))
    near = lambda s, h: bool(s and h) and 100 * len(s & h) >= 75 * len(s | h)
    return grouped(sets, [(a, b) for a, b in combinations(sets, 2) if any(near(s, h) for s in sets[a] for h in sets[b])]), {k: [len(s) for s in v] for k, v in sets.items()}


def family(rng, k, n, edits):
    """Copies of one text, each with up to ``edits`` words changed."""
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        t = base[:]
        for _ in range(rng.randint(0, edits)):
            t[rng.randrange(len(t))] = f"e{rng.randint(0, 10**6)}"
        out.append((next(k), " ".join(t)))
    return out


def corpus(seed=1):
    rng, k = random.Random(seed), iter(range(10**6))
    docs = family(rng, k, 40, 3) + family(rng, k, 60, 9) + family(rng, k, 10, 0)
    passage = " ".join(f"p{j}" for j in range(60))
    docs += [(next(k), passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(90))) for _ in range(60)]
    docs += [(next(k), t) for t in (None, "", " \n", "one two", "ONE two", "one two three four five", "a b c d e f")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("block", [8, 512])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "PER_PIVOT", max(4, block // 4))
    docs = corpus(block)
    got = nd.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    comps, sizes = brute(docs)
    assert {r["doc_id"]: r["component_id"] for r in got} == comps
    assert all(r["n_shingles"] in sizes[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == len(docs)


def test_edges(spark, edges, nothing):
    rows = edges.collect()
    got = nd.near_duplicates(edges).collect()
    comps, _ = brute([(r["doc_id"], r["text"]) for r in rows])
    assert len(got) == len(rows) and {r["doc_id"]: r["component_id"] for r in got} == comps
    assert {r["doc_id"]: r["component_id"] for r in got}[6] == 1
    assert nd.near_duplicates(nothing).collect() == []


def test_null_ids_stay_alone(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f")], "doc_id bigint, text string")
    assert sorted(str(r["component_id"]) for r in nd.near_duplicates(df).collect()) == ["4", "None", "None"]


def test_sketches_fill_every_bin_and_estimate():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for n in (1, 3, 40, 400):
        doc = np.zeros(n, dtype=np.int64)
        assert (nd.sketches(doc, base[:n], 1) == nd.sketches(doc, base[:n][::-1].copy(), 1)).all()
    near = np.concatenate([base[:300], base[100:400]])
    s = nd.sketches(np.repeat([0, 1], 300), near, 2)
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.2


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5), (101, 100)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")).collect()}
    want = grouped({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if k in got} and all(k in got for a, b in links if a != b for k in (a, b))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(seed, n=400, d=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    hot = rng.normal(size=d)
    near = [hot + 0.1 * rng.normal(size=d) for _ in range(150)]
    pairs = [v + 0.05 * rng.normal(size=d) for v in x[:80]]
    rows = [[float(np.float32(c)) for c in v] for v in [*x, *near, *pairs]]
    rows += [rows[0], rows[0], [2 * c for c in rows[3]], [0.0] * d, None, [float("nan")] * d, [None, *rows[5][1:]], [float("inf"), *rows[5][1:]]]
    order = rng.permutation(len(rows))
    return [(int(k), rows[j]) for k, j in enumerate(order)]


@pytest.mark.parametrize(("block", "cells"), [(2048, None), (32, 3)])
def test_vectors_equal_brute_force(spark, monkeypatch, block, cells):
    from lexforge.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors(block)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, n_links int")
    got = {r["vec_id"]: r for r in near_vectors(df, cells=cells).collect()}
    good = [(k, np.array(v, dtype=np.float32).astype(float)) for k, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    hit = x @ x.T >= 0.95
    ids = [k for k, _ in good]
    exact = {k: int(h.sum()) - 1 for k, h in zip(ids, hit, strict=True)}
    assert all(got[k]["n_links"] <= exact[k] for k in ids)
    assert sum(got[k]["n_links"] for k in ids) >= 0.99 * sum(exact.values())
    comps = grouped(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(hit, 1)), strict=True)])
    assert sum(got[k]["component_id"] != comps[k] for k in ids) <= 2
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in {k for k, _ in rows} - set(ids))
    assert len(got) == len(rows)


def close_pairs(seed, n, d):
    """Vectors and partners at cosines about 0.95, and the exact links."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=(n, d))
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    cos = rng.uniform(0.93, 0.99, n)[:, None]
    x = np.concatenate([x, cos * x + np.sqrt(1 - cos**2) * side])
    return x, int((np.triu(x @ x.T >= 0.95, 1)).sum())


@pytest.mark.parametrize("exact", [False, True])
def test_links_across_many_cells(spark, exact):
    x, links = close_pairs(4, 1500, 32)
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = near_vectors(df, cells=200, exact=exact).agg(F.sum("n_links")).head()[0]
    assert links > 500 and (got == 2 * links if exact else 0.9 * 2 * links <= got <= 2 * links)


def test_vectors_of_extreme_size(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(k, [c * scale for c in v]) for k, scale in enumerate([1.0, 1e200, 1e300, 1e-200, -1.0])]
    got = {r["vec_id"]: tuple(r) for r in near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert got == {k: (k, 3, 0, k == 0) for k in range(4)} | {4: (4, 0, 4, True)}


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []
    assert [tuple(r) for r in near_vectors(spark.createDataFrame([(3, None)], "vec_id bigint, embedding array<float>")).collect()] == [(3, 0, 3, True)]


def test_centres_are_unit_and_none_is_lost():
    x = np.random.default_rng(0).normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = spherical_kmeans(np.concatenate([x, x[:1].repeat(200, 0)]), 20)
    assert c.shape == (20, 8) and np.allclose(np.linalg.norm(c, axis=1), 1)


def test_word_hashes_do_not_depend_on_the_runs_they_are_made_in(monkeypatch):
    from lexforge.llm import wordhash

    texts = pa.array(["one two  three four five six seven", "", "x" * 50 + " two three", None, "é ü two three four five six"])
    whole = [wordhash.Words(*wordhash.spans_of(texts), wordhash.SPACED)]
    monkeypatch.setattr(wordhash, "_CHUNK", 9)
    short = wordhash.Words(*wordhash.spans_of(texts), wordhash.SPACED)
    assert whole[0].h.tolist() == short.h.tolist() and whole[0].grams(5)[1].tolist() == short.grams(5)[1].tolist()


def test_a_text_of_five_megabytes(spark):
    """Near copies and a benchmark passage are found in very long texts too."""
    from lexforge.llm.decontaminate import contamination

    rng = random.Random(4)
    words = [f"w{rng.randrange(200_000)}" for _ in range(700_000)]
    passage = [f"p{k}" for k in range(13)]
    long, near = " ".join(words), " ".join([*words[:300_000], *passage, *words[300_040:]])
    near_duplicates = nd.near_duplicates
    docs = spark.createDataFrame([(1, long), (2, near), (3, "short text"), (4, long[: len(long) // 2])], "doc_id bigint, text string")
    assert len(long) > 4_500_000
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    bench = spark.createDataFrame([(9, " ".join(["not", *passage, "there"])), (8, " ".join(words[-50:]))], "item_id bigint, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in contamination(docs, bench).collect()}
    assert got == {1: (50, 1), 2: (63, 2), 3: (0, 0), 4: (0, 0)}
