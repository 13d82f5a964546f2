"""Classifiers by held-out accuracy; mixing by its constraints."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_cases import documents, hard, no_docs  # noqa: F401

from siltstone.llm import language, mixing, quality, queries

FOLDER = "/root/testdata/sf0.1"


def is_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language_held_out(spark):
    found = queries.op9_language_id(spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    rows = found.toPandas()
    assert (rows.held_out == rows.doc_id.map(is_out)).all() and rows.score.between(0, 1).all()
    out = rows[rows.held_out]
    assert (out.lang_pred == out.lang).mean() > 0.99


def test_language_of_hard_documents(spark, documents, hard, no_docs):
    model = language.train(documents)
    rows = language.identified(hard, model).collect()
    assert len(rows) == hard.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (3, 4, 5, 9))
    assert by_id[7].lang_pred == "de"
    kept = language.with_language(hard, model)
    assert kept.columns == hard.columns and {3, 4, 5, 9}.isdisjoint(r.doc_id for r in kept.collect())
    assert language.identified(no_docs, model).count() == 0
    untaught = language.train(no_docs)
    assert {r.lang_pred for r in language.identified(hard, untaught).collect()} == {"und"}
    assert language.with_language(hard, untaught).count() == 9
    one = language.train(documents.where("lang = 'de'"))
    assert {r.lang_pred for r in language.identified(documents, one).collect()} == {"de"}


@pytest.mark.parametrize("n", [2, 3, 5, 6, 7, 40])
def test_codewords_differ(n):
    code = language.codewords(n).astype(int)
    apart = (code.shape[1] - code @ code.T) // 2 + np.eye(n, dtype=int) * code.shape[1]
    assert set(np.unique(code)) == {-1, 1} and apart.min() >= (1 if n == 2 else code.shape[1] // 4)
    assert (np.abs(code.sum(0)) < n).all()


def test_codewords_correct_a_wrong_bit():
    code = language.codewords(5)
    model = language.LanguageModel(
        list("abcde"), code, np.zeros((1, 15)), np.zeros(15), np.ones(15), np.full(15, 1 / 15)
    )
    for k, word in enumerate(code):
        for bit in range(15):
            means = 3.0 * word
            means[bit] *= -1
            best, share, close = model.decode(means[None])
            assert best[0] == k and share[0] > 0.5 and not close[0]
    assert model.decode(np.zeros((1, 15)))[2][0]


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = queries.op6_quality_classifier(spark, FOLDER).toPandas()
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()
    out = rows[rows.held_out].merge(labels.toPandas(), on="doc_id")
    good, bad = out[out.quality == 1].score.values, out[out.quality == 0].score.values
    auc = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    assert auc > 0.98 and (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.9


def test_quality_votes_are_exact(spark, documents, small):
    """Scores equal a plain vote over all labelled vectors."""
    model = quality.train(documents, spark.read.parquet(f"{small}/labels.parquet"))
    from siltstone.llm.common import utf8
    import pyarrow as pa

    texts = [r.text for r in documents.limit(40).collect()]
    data, bounds = utf8(pa.array(texts))
    rows = model.project(quality.features(data, bounds))
    scores = model.scores(data, bounds)
    n, compared = quality.NEIGHBOURS, 0
    for row, score in zip(rows, scores):
        cosines = (model.vectors @ row).astype(float)
        order = np.argsort(-cosines, kind="stable")
        if cosines[order[n - 1]] - cosines[order[n]] < 1e-6:
            continue  # several labelled documents are the 25th nearest
        weight = np.maximum(cosines[order[:n]], 0)
        assert score == pytest.approx((weight * model.labels[order[:n]]).sum() / weight.sum(), abs=1e-5)
        compared += 1
    assert compared > 20


def test_repeated_labelled_ids_teach_once(spark, documents, small):
    """Copies of a labelled document, and other texts under its id, neither crowd out the sample nor reach
    the driver; two fits are equal."""
    labels = spark.read.parquet(f"{small}/labels.parquet")
    usual = quality.train(documents, labels)
    marked = labels.where("quality = 1").join(documents, "doc_id").select(*documents.columns).limit(40)
    copies = marked.where(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 != 0).limit(1)
    many = documents.unionByName(copies.join(spark.range(5000)).select(*documents.columns))
    rows = quality.training_rows(many, labels, "doc_id", "text", "quality")
    assert rows.count() == len(usual.labels) <= 2 * quality.PER_LABEL
    again = quality.train(many.repartition(7), labels)
    assert (again.vectors == usual.vectors).all() and (again.labels == usual.labels).all()


def test_a_language_of_repeated_rows_is_learned(spark, documents):
    """However often its only row is repeated, and on every run alike."""
    row = (1, "zzyzx qoph zzyzx qoph wexx " * 5, "xx", "s", 100)
    assert not is_out(1)
    repeated = spark.createDataFrame([row], documents.schema).join(spark.range(20_000)).select(*documents.columns)
    models = [language.train(documents.unionByName(repeated).repartition(n)) for n in (3, 8)]
    assert all("xx" in m.languages for m in models) and models[0].languages == models[1].languages
    assert np.allclose(models[0].weights, models[1].weights)


def test_language_scores_are_those_of_a_plain_version(spark, documents):
    """Mean log odds of each bit over the trigrams of a text, then the least weighted loss."""
    model = language.train(documents)
    found = {r.doc_id: r for r in language.identified(documents, model).collect()}
    for r in documents.limit(30).collect():
        raw = [c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in (r.text or "").encode()]
        sums, n = np.zeros(model.code.shape[1]), 0
        for k in range(len(raw) - 2):
            code = 0
            for c in raw[k : k + 3]:
                code = ((code ^ c) * 0x9E3779B1) % 2**32
            sums += model.weights[code >> (32 - language.BITS)]
            n += 1
        margin = (sums / max(n, 1) - model.middle) / model.spread
        loss = [(np.log1p(np.exp(-margin * word)) * model.trust).sum() for word in model.code.astype(float)]
        if r.text and any(c.isalpha() for c in r.text):
            assert found[r.doc_id].lang_pred == model.languages[int(np.argmin(loss))]


def test_quality_of_hard_documents(spark, documents, hard, no_docs, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = quality.train(documents, labels)
    rows = {r.doc_id: r for r in quality.scored(hard, model).collect()}
    assert rows[3].score == rows[4].score == 0.5 and rows[3].predicted == 1
    assert quality.scored(hard, model).count() == hard.count()
    assert quality.good_only(hard, model).columns == hard.columns
    assert quality.scored(no_docs, model).count() == 0
    untaught = quality.train(documents, labels.limit(0))
    assert {r.score for r in quality.scored(hard, untaught).collect()} == {0.5}
    labels_with_nulls = labels.unionByName(labels.selectExpr("NULL AS doc_id", "NULL AS quality", "toxic").limit(2))
    assert len(quality.train(documents, labels_with_nulls).labels) == len(model.labels)


def test_repetition_shares():
    import pyarrow as pa

    from siltstone.llm.common import utf8

    shares = quality.repetition(*utf8(pa.array(["a a a a", "a b\na b\nc d", "", None, "x"])))
    assert shares.tolist() == [[1000, 0], [0, 333], [0, 0], [0, 0], [0, 0]]


# ---- mixing ------------------------------------------------------------------------------------


def plain_targets(sizes: dict) -> dict:
    """Share by weight, stop at the cap, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        rest = sum(weight[s] for s in names if s not in capped)
        out = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / rest for s in names}
        more = {s for s in names if s not in capped and out[s] > 2 * sizes[s]}
        if not more:
            return out
        capped |= more


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", FOLDER])
def test_mixing_meets_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = queries.op4_mixing_sources(spark, folder).toPandas()
    rows = rows.merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(n == len(texts[d].encode().split()) for d, n in zip(rows.doc_id, rows["size"]))
    by_source = rows.groupby("source").agg({"size": "sum", "source_size": "first", "target": "first", "taken": "sum"})
    want = plain_targets(by_source["size"].to_dict())
    for s, r in by_source.iterrows():
        assert r.source_size == r["size"] and r.target == pytest.approx(want[s])
        largest = rows[rows.source == s]["size"].max()
        assert abs(r.taken - r.target) <= largest / 2 + 1e-6
    assert (rows.taken <= 2 * rows["size"]).all() and (rows.taken % rows["size"].clip(lower=1) == 0).all()


def test_mixing_repeats_itself_and_copies_rows(spark, documents):
    first, again = (mixing.mixed_sizes(documents).orderBy("doc_id").collect() for _ in range(2))
    assert first == again
    mixed = Counter(r.doc_id for r in mixing.mixed_documents(documents).collect())
    assert mixed == Counter({r.doc_id: r.taken // r["size"] for r in first if r.taken})


def test_mixing_hard_documents(hard, no_docs):
    rows = mixing.mixed_sizes(hard).collect()
    assert len(rows) == hard.count()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    sizes: dict = {}
    for r in hard.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    want = plain_targets(sizes)
    assert sorted({r.target for r in rows}) == pytest.approx(sorted(set(want.values())))
    mixed = mixing.mixed_documents(hard)
    assert mixed.columns == hard.columns
    assert mixing.mixed_sizes(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mixing_keeps_expectations(spark):
    """Over many seeds each document is taken as often as its share says."""
    docs = spark.createDataFrame(
        [(k, "w " * (1 + k % 7), "en", "ab"[k % 2], 0) for k in range(40)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    totals, share = Counter(), {}
    for seed in range(4):
        for r in mixing.copies(docs, seed=seed).collect():
            totals[r.id] += r.copies
            share[r.id] = r.target / r.source_size
    mean = sum(totals[k] / 4 - share[k] for k in share) / len(share)
    assert abs(mean) < 0.15
