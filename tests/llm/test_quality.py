"""Held-out accuracy, labels and edge cases of the quality classifier."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from folkmoot.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    out = quality.score(docs, model).join(labels, "doc_id", "left").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    told = [r for r in out if r.held_out and r.quality is not None]
    assert np.mean([r.predicted == r.quality for r in told]) >= 0.95


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs, x) for x in (labels, turned))
    assert all((x == y).all() for x, y in zip(a.weights, b.weights))


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "some text here.", 0), (3, "x " * 100_000, 0), (3, "again", 0)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    none = quality.train(docs, labels.limit(0))
    assert none is None and {r.score for r in quality.score(docs, none).collect()} == {1.0}
    assert quality.keep_good(docs, none).count() == 5 and quality.score(docs.limit(0), none).count() == 0


def test_non_negative_risk_separates_two_clusters():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 0.5, (3000, 4)), rng.normal(-1, 0.5, (600, 4))
    model = quality.fit(good[:800], np.concatenate([good[800:], bad]), 0.8, steps=600)
    assert (model.score(good) >= 0.7).mean() > 0.97 and (model.score(bad) < 0.7).mean() > 0.97


def test_prior_is_estimated_from_positives_and_unlabelled():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        good, bad = rng.normal(1, 0.5, (5000, 6)), rng.normal(-1, 0.5, (3000, 6))
        n = int(3000 * share)
        mixed = np.concatenate([good[:n], bad[: 3000 - n]])
        assert abs(quality.class_prior(good[3000:], mixed) - share) < 0.06


def test_bad_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a, b = (quality.train(docs, x) for x in (labels, labels.where("quality = 1")))
    assert a.prior == b.prior and all((x == y).all() for x, y in zip(a.weights, b.weights))


def test_the_fit_reaches_the_least_risk():
    """Against a direct minimum: of one standardised feature the risk of every threshold-like line is computed."""
    rng = np.random.default_rng(7)
    good, bad = rng.normal(1, 0.8, (2000, 1)), rng.normal(-1, 0.8, (2000, 1))
    unlabelled, prior = np.concatenate([good[1000:], bad[:1000]]), 0.5

    def risk(zp, zu):
        return prior * np.logaddexp(0, -zp).mean() + max(0.0, np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())

    least = min(risk(a * good[:1000, 0] + b, a * unlabelled[:, 0] + b) for a in np.linspace(0.5, 8, 40) for b in np.linspace(-3, 3, 41))
    model = quality.fit(good[:1000], unlabelled, prior)
    assert risk(model.logit(good[:1000]), model.logit(unlabelled)) < least + 0.02


def test_many_rows_of_one_id_stay_within_the_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(3, f"some text number {i}.") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    sizes, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda p, u, *a, **k: sizes.append((len(p), len(u))) or fit(p, u, *a, **k))
    quality.train(docs, labels, most=10)
    assert sizes and max(map(max, sizes)) <= 10
