"""The quality classifier: held-out labels, and odd inputs."""

import zlib

import numpy as np

from lakeferry.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_labels_are_predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.trained(docs, labels)
    assert 0.7 < model.prior < 0.98
    found = quality.scored(docs, model).join(labels, "doc_id").collect()
    own = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    for rows in (found, own):
        right = {k: [r.predicted == k for r in rows if r.quality == k] for k in (0, 1)}
        assert np.mean(right[1]) > 0.97
        assert np.mean(right[0]) > 0.8
    good = [r.score for r in own if r.quality == 1]
    bad = [r.score for r in own if r.quality == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.97


def test_labels_of_held_out_and_bad_documents_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.trained(docs, labels)
    other = labels.where(~quality.held_out(labels.doc_id) & (labels.quality == 1))
    again = quality.trained(docs.selectExpr("*", "1 AS kind"), other.unionByName(other))
    assert np.allclose(model.weights, again.weights)


def test_odd_inputs(spark):
    docs = spark.createDataFrame(
        [(None, "a", 9), (1, None, 9), (2, "", 9), (2, "", 9), (3, "x" * 300_000, 9), (4, "日本", 9)],
        "doc_id long, text string, SCORE int",
    )
    labels = spark.createDataFrame(
        [(2, 1, 3), (3, 1, 3), (3, 0, 3), (None, 1, 3), (4, None, 3)], "doc_id long, quality int, text int"
    )
    for marks in (labels, labels.limit(0)):
        rows = quality.scored(docs, quality.trained(docs, marks)).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
        assert {r.predicted for r in rows if r.score >= 0.3} <= {1}
    assert quality.trained(docs.limit(0), labels).weights is None
    assert quality.scored(docs.limit(0), quality.Model()).count() == 0


def plain_risk(x, p, u, prior):
    """The two terms, one row after another."""
    loss = lambda z, label: np.log1p(np.exp(-z if label else z))
    positive = sum(loss(float(row @ x), 1) for row in p) / len(p)
    as_bad = sum(loss(float(row @ x), 0) for row in p) / len(p)
    unlabelled = sum(loss(float(row @ x), 0) for row in u) / len(u)
    return prior * positive, unlabelled - prior * as_bad


def test_risk_and_its_gradient():
    pick = np.random.default_rng(4)
    p, u = pick.standard_normal((40, 5)) + 1, pick.standard_normal((60, 5))
    signs = set()
    for prior in (0.1, 0.5, 0.95):
        for scale in (0.1, 1.0, 3.0):
            x = scale * pick.standard_normal(5)
            first, second = plain_risk(x, p, u, prior)
            assert np.isclose(quality.risk(x, p, u, prior), first + max(0, second))
            signs.add(second < 0)
            # up the second term where it is negative, down both elsewhere
            total = (lambda y: -plain_risk(y, p, u, prior)[1]) if second < 0 else (lambda y: sum(plain_risk(y, p, u, prior)))
            numeric = [(total(x + e) - total(x - e)) / 2e-5 for e in np.eye(5) * 1e-5]
            assert np.allclose(quality.risk_step(x, p, u, prior, 0.0), numeric, atol=1e-4)
    for x in (np.array([-8.0, 0, 0, 0, 0]), np.array([0.0, -9, 0, 0, 0])):
        signs.add(plain_risk(x, p, u, 0.95)[1] < 0)
    decay = quality.risk_step(x, p, u, 0.1, 0.5) - quality.risk_step(x, p, u, 0.1, 0.0)
    assert np.allclose(decay, 0.5 * x) or plain_risk(x, p, u, 0.1)[1] < 0


def test_fit_lowers_the_risk_and_finds_the_prior():
    pick = np.random.default_rng(5)
    good, bad = pick.standard_normal((900, 4)) + 1.5, pick.standard_normal((900, 4)) - 1.5
    p, u = good[:400], np.vstack([good[400:], bad[:500]])
    model = quality.fit(p, u)
    assert abs(model.prior - 0.5) < 0.15
    new_good, new_bad = model.score(good[400:]), model.score(bad[500:])
    assert (new_good > 0.5).mean() > 0.97 and np.mean(new_good[:, None] > new_bad) > 0.99
    rows = lambda m: np.hstack([(m - model.mean) / model.scale, np.ones((len(m), 1))])
    x = np.append(model.weights, model.bias)
    assert quality.risk(x, rows(p), rows(u), model.prior) < 0.5 * quality.risk(0 * x, rows(p), rows(u), model.prior)
