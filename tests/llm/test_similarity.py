"""Fingerprints, SimHash groups and neighbours against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import rows as as_rows
from llm_cases import documents, hard, no_docs  # noqa: F401

from siltstone.llm import fingerprints as fp
from siltstone.llm import neighbours, queries, simhash
from siltstone.llm.components import roots


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def in_order(docs):
    """By descending id, NULL last, then by text (NULL is empty)."""
    return sorted(docs.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text or ""))


def test_fingerprints_of_all_documents(spark, small, documents):
    found = {r.doc_id: r for r in queries.op2_document_fingerprints(spark, small).collect()}
    ordered = in_order(documents)
    errors = []
    for r, after in zip(ordered, ordered[1:] + ordered[:1]):
        half, got = len(r.text) // 2, found[r.doc_id]
        edited = r.text[: len(r.text) - half] + after.text[:half]
        assert got.n_chars == len(r.text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, e, n = (shingles(t, 5) for t in (r.text, edited, after.text))
        errors += [got.near_edited - jaccard(a, e), got.near_next - jaccard(a, n)]
        if len(a | e) <= fp.K:
            assert got.near_edited == pytest.approx(jaccard(a, e)) and got.n_shingles == len(a)
    assert np.abs(errors).max() < 0.15 and np.abs(errors).mean() < 0.02


def test_equal_texts_have_equal_fingerprints(hard):
    found = fp.edited_fingerprints(hard, buckets=4).collect()
    assert len(found) == hard.count()
    texts = {(r.doc_id, len(r.text or "")): r.text for r in hard.collect()}
    by_text = {}
    for r in found:
        by_text.setdefault(texts[r.doc_id, r.n_chars] or "", set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    ordered = in_order(hard)
    want = []
    for r, after in zip(ordered, ordered[1:] + ordered[:1]):
        text, half = r.text or "", len(r.text or "") // 2
        edited = text[: len(text) - half] + (after.text or "")[:half]
        want.append((r.doc_id, hashlib.sha256(edited.encode()).hexdigest()))
    assert Counter((r.doc_id, r.edited_sha256) for r in found) == Counter(want)


def test_one_document_and_none(hard, no_docs):
    one = fp.edited_fingerprints(hard.where("doc_id = 1")).first()
    assert one.near_next == 1.0
    assert fp.edited_fingerprints(no_docs).count() == 0


def test_sketches_merge(spark, documents):
    """The sketch of parts is the sketch of the whole where no shingle crosses the cut."""
    rows = [(d, "\n".join(w for w in r.text.split()[:5])) for d, r in enumerate(documents.limit(60).collect())]
    parts = spark.createDataFrame([(d % 3, t) for d, t in rows], "doc_id long, text string")
    merged = {r.doc_id: r.fingerprint for r in fp.merged(fp.fingerprints(parts, k=8), "doc_id", k=8).collect()}
    for key in range(3):
        sketches = [fp.sketch_of(r.fingerprint) for r in fp.fingerprints(parts, k=8).where(f"doc_id = {key}").collect()]
        assert fp.sketch_of(merged[key]).tolist() == np.unique(np.concatenate(sketches))[:8].tolist()


def test_estimates():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 2**63, 20_000, dtype=np.uint64) for _ in range(2))
    whole, part = np.concatenate((a, b)), a
    s, t = (np.unique(x)[: fp.K] for x in (whole, part))
    assert fp.distinct(s) == pytest.approx(40_000, rel=0.2)
    assert fp.resemblance(s, t) == pytest.approx(0.5, abs=0.1)
    assert fp.containment(t, s) > 0.85
    none = np.zeros(0, np.uint64)
    assert fp.resemblance(none, none) == 1.0 and fp.resemblance(none, s) == 0.0 and fp.containment(none, s) == 1.0


# ---- SimHash -----------------------------------------------------------------------------------


def plain_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(len(w) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance=4):
    """Component of each entry of a list of fingerprints, as the first index in it."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i:] ^ values[i]) <= distance) + i:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_duplicates_of_all_documents(spark, small, documents):
    docs = sorted(documents.collect(), key=lambda r: r.doc_id)
    fps = [plain_fingerprint(r.text) for r in docs]
    roots_ = components(fps)
    want = {(r.doc_id, f"{f:016x}", docs[k].doc_id) for r, f, k in zip(docs, fps, roots_)}
    assert set(map(tuple, queries.op10_simhash_near_dedup(spark, small).collect())) == want


def test_near_duplicates_of_hard_documents(hard, no_docs):
    docs = sorted(hard.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    roots_ = components([plain_fingerprint(r.text) for r in docs])
    want = Counter((r.doc_id, docs[k].doc_id) for r, k in zip(docs, roots_))
    found = simhash.near_duplicates(hard)
    assert Counter((r.doc_id, r.component_id) for r in found.collect()) == want
    kept = simhash.one_of_each(hard)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({docs[k].doc_id for k in roots_})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_links_of_dense_groups(spark):
    """Balls and chains of fingerprints, some denser than a small bucket."""
    rng = np.random.default_rng(1)
    fps = set()
    for size in [200] + [25] * 30:
        x = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(size):
            y = x
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                y ^= 1 << int(bit)
            fps.add(y)
            if rng.random() < 0.3:
                x = y
    fps = sorted(fps, key=lambda f: f - (1 << 64) if f >> 63 else f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4)
    found = {r.node: r.root for r in roots(links).collect()}
    want = [signed[k] for k in components(fps)]
    assert [found.get(f, f) for f in signed] == want
    assert links.count() < 45 * len(fps)


@pytest.mark.parametrize("distance", range(6))
def test_segments_cover_every_distance(distance):
    parts = simhash.segments(distance)
    assert sum(bits for _, bits, _ in parts) == 64 and sum(r + 1 for _, _, r in parts) == distance + 1


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k + 1, k) for k in range(60)] + [(k, 1000) for k in range(1001, 1040)] + [(5, 5)]
    found = roots(spark.createDataFrame(chain, "u long, v long")).collect()
    assert {(r.node, r.root) for r in found} == {(k, 0) for k in range(1, 61)} | {(k, 1000) for k in range(1001, 1040)}


# ---- neighbours --------------------------------------------------------------------------------


def exact(rows, k, every):
    for q, v in rows:
        if q % every == 0:
            near = sorted(
                (float(np.sqrt(((np.array(x, float) - np.array(v, float)) ** 2).sum())), i)
                for i, x in rows
                if i != q and len(x) == len(v)
            )
            yield q, near[:k]


def test_neighbours_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {}
    for r in queries.op5_approximate_neighbours(spark, folder).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q, near in exact(rows, 10, 100):
        got = sorted(found.pop(q))
        assert [r for r, _, _ in got] == list(range(1, 11))
        scores = {i: np.sqrt(((np.array(v, float) - np.array(rows[q][1], float)) ** 2).sum()) for i, v in rows}
        assert all(s == pytest.approx(scores[i], abs=1e-12) for _, i, s in got)
        assert [(s, i) for _, i, s in got] == sorted((s, i) for _, i, s in got)
        hits += len({i for _, i in near} & {i for _, i, _ in got})
        total += len(near)
    assert not found and hits / total >= 0.9


def test_neighbours_of_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 5.0]), (200, [0.0, 0.0]),
        (300, None), (3, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (4, [100.0, 3.0]), (400, [1.0, 2.0, 3.0]),
        (None, [1.0, 1.0]), (500, []),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS cid")
    good = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 5.0]), (4, [100.0, 3.0]), (400, [1.0, 2.0, 3.0])]
    want = [(q, k + 1, i, s) for q, near in exact(good, 10, 100) for k, (s, i) in enumerate(near)]
    assert as_rows(neighbours.nearest_neighbours(df)) == as_rows(spark.createDataFrame(want, "a long, b int, c long, d double"))
    assert neighbours.nearest_neighbours(df.limit(0)).count() == 0


def test_neighbours_among_many_copies(spark):
    """A third of all rows share one vector; more copies than neighbours are asked for."""
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest_neighbours(df).collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    for q, near in exact(rows, 10, 100):
        if q % 3 == 0:
            assert sorted(found[q]) == near
        assert len(found[q]) == 10


@pytest.mark.parametrize("offset, scale", [(1e6, 1.0), (1e7, 1.0), (0.0, 1e200), (0.0, 1e-200), (3.0, 1e-9)])
def test_neighbours_far_from_zero_and_of_any_size(spark, offset, scale):
    """A common offset, huge and tiny components: ranks and distances are those of direct differences."""
    rng = np.random.default_rng(11)
    vectors = (rng.standard_normal((300, 16)) + offset) * scale
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    rough, slack = neighbours.rough_squares(vectors, vectors[:20])
    assert np.isfinite(rough).all() and slack < np.median(rough)
    found: dict = {}
    for r in neighbours.nearest_neighbours(df, every=100, k=10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(found) == [0, 100, 200]
    for q, hits in found.items():
        apart = neighbours.distances(vectors, vectors[q])
        assert all(score == apart[k] for k, score in hits) and len(hits) == 10
    # Inside one block the ranks are exact.
    rows, ids, scores = neighbours.nearest_in(vectors, np.arange(300), vectors[:20], 11)
    for q in range(20):
        want = sorted(zip(neighbours.distances(vectors, vectors[q]), range(300)))[:11]
        assert [(s, i) for r, i, s in zip(rows, ids, scores) if r == q] == want
