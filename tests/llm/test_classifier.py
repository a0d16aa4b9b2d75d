import zlib

import numpy as np
from corpus_fixtures import prose, write_tables
from pyspark.sql import functions as F

from palate.llm import quality_classifier as qc


def tables(spark, n=400):
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(i, 40 + i % 50) if good else (prose(i, 3) + " | #### ") * (3 + i % 9)
        docs.append((i, text, "en", "s", i))
        labels.append((i, int(good), 0))
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, y long")
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_statistics_are_finite_for_odd_texts(odd):
    for r in odd.collect():
        x = qc.statistics(r.text or "")
        assert len(x) == len(qc.STATISTICS) and np.isfinite(x).all()


def test_held_out_accuracy_and_columns(spark, tmp_path):
    docs, labels = tables(spark)
    folder = write_tables(spark, tmp_path, documents=docs, labels=labels)
    got = {r.doc_id: r for r in qc.op10_quality_classifier(spark, folder).collect()}
    assert len(got) == 400
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, int(i % 4 != 0)) for i, r in got.items() if r.held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = tables(spark, 200)
    other = labels.withColumn("quality", F.when(qc.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    x = np.array([qc.statistics(prose(9, 30)), qc.statistics("#### | " * 9)])
    a, b = qc.train(docs, labels), qc.train(docs, other)
    assert np.allclose(a.score(x), b.score(x))


def test_normal_equations_do_not_depend_on_partitions(spark):
    docs, labels = tables(spark, 120)
    x = np.array([qc.statistics(prose(i, 30)) for i in range(20)])
    a, b = (qc.train(d, labels).score(x) for d in (docs.coalesce(1), docs.repartition(7)))
    assert np.allclose(a, b, atol=1e-6)


def test_weights_equal_ridge_over_all_rows_at_once(spark):
    """Labels that are null, repeated or of unknown ids; fold 0 and the calibration fold take no part."""
    docs, labels = tables(spark, 300)
    extra = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (8, None, 0), (9_999, 1, 0), (None, 1, 0)], labels.schema)
    labels = labels.unionByName(extra)
    model = qc.train(docs.repartition(5), labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    of = lambda i: zlib.crc32(str(i).encode()) % qc.FOLDS
    rows = [(r.doc_id, r.quality) for r in labels.collect() if r.doc_id in text and r.quality is not None]
    seen = np.array([qc.statistics(text[i]) for i, _ in rows if of(i) != 0], float)
    spread = seen.std(axis=0)
    assert np.allclose(model.mean, seen.mean(axis=0)) and np.allclose(model.spread, np.where(spread > 1e-9, spread, 1.0))
    fit = [(i, y) for i, y in rows if of(i) > qc.CALIBRATION]
    phi, y = model.expand(np.array([qc.statistics(text[i]) for i, _ in fit], float)), np.array([float(v) for _, v in fit])
    system = phi.T @ phi + qc.RIDGE * len(fit) * np.eye(phi.shape[1])
    assert np.allclose(model.weights, np.linalg.solve(system, phi.T @ y), atol=1e-7)
    # The waves approximate a Gaussian kernel between standardized rows.
    waves = phi[:, : qc.DIMENSIONS]
    z = phi[:, qc.DIMENSIONS : -1]
    far = ((z[:, None] - z[None, :]) ** 2).sum(axis=2)
    assert np.abs(waves @ waves.T - np.exp(-far / len(qc.STATISTICS))).mean() < 0.08


def test_isotonic_equals_the_min_max_formula():
    """The fitted value at i is the largest, over j up to i, of the smallest mean of j to k, over k from i on."""
    rng = np.random.default_rng(6)
    n = rng.integers(1, 9, 60).astype(float)
    good = np.array([float(rng.integers(0, c + 1)) for c in n])
    mean = lambda j, k: good[j : k + 1].sum() / n[j : k + 1].sum()
    want = [max(min(mean(j, k) for k in range(i, 60)) for j in range(i + 1)) for i in range(60)]
    x, y = qc.isotonic(np.arange(60.0), good, n)
    assert np.allclose(y, sorted(set(np.round(want, 12))))
    for xi, yi in zip(x, y, strict=True):  # each block's centre, weighted by its rows
        at = np.flatnonzero(np.isclose(want, yi))
        assert np.isclose(xi, (at * n[at]).sum() / n[at].sum())


def test_query_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    labels = odd.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    for name, docs in (("odd", odd), ("none", none)):
        folder = write_tables(spark, tmp_path / name, documents=docs, labels=labels)
        rows = qc.op10_quality_classifier(spark, folder).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 20, 200).astype(float)
    good = np.minimum(n, rng.binomial(20, np.linspace(0.1, 0.9, 200)))
    x, y = qc.isotonic(np.arange(200.0), good, n)
    assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all()


def test_odd_rows_and_no_labels(spark, odd, none):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    model = qc.train(odd, labels)
    assert set(model.score(np.zeros((3, len(qc.STATISTICS))))) == {0.5}
    kept = qc.keep_likely(odd, model)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))
    assert qc.keep_likely(none, model).count() == 0
    repeated = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert np.isfinite(qc.train(odd, repeated).score(np.zeros((1, len(qc.STATISTICS))))).all()
