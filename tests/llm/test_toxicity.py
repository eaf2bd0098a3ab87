"""Op 10: the risk's behaviour, held-out accuracy, and rows at the edges."""

import zlib

import numpy as np

from panelspark.llm import op10_toxicity as op
from llm_fixtures import docs_of  # noqa: F401


def rows_of(words, n, rng, extra=()):
    out = []
    for _ in range(n):
        out.append(np.unique(np.r_[rng.choice(words, 12), list(extra)]).astype(np.int64))
    return out


def test_non_negative_risk_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    clean, bad = np.arange(100, 400), np.arange(500, 505)
    positive = [np.unique(np.r_[r, rng.choice(bad, 2)]) for r in rows_of(clean, 200, rng)]
    unlabelled = [np.unique(np.r_[r, rng.choice(bad, 2)]) if i % 10 == 0 else r for i, r in enumerate(rows_of(clean, 1500, rng))]
    m = op.train(op.Rows.of(positive), op.Rows.of(unlabelled), 0.1)
    w = np.zeros(op.BUCKETS)
    w[m["used"]] = m["weights"]
    s = np.array([w[r].sum() for r in unlabelled]) + m["bias"]
    toxic = np.arange(1500) % 10 == 0
    assert (s[toxic] > 0).mean() > 0.95 and (s[~toxic] > 0).mean() < 0.02


def test_risk_and_gradient_equal_plain_loops():
    """Both parts of the risk by a loop over rows; the direction by finite differences, on both sides of 0."""
    rng = np.random.default_rng(1)
    rows = lambda n: [np.unique(rng.choice(8, rng.integers(0, 6))).astype(np.int64) for _ in range(n)]
    signs = set()
    for prior in (0.1, 0.5, 0.9):
        pos, unl = [np.union1d(r, [0]) for r in rows(9)], [np.setdiff1d(r, [0]) for r in rows(14)]
        p, u = (op.Sparse(op.Rows.of(x), np.arange(8)) for x in (pos, unl))
        for scale in (0.3, 4.0):
            w = rng.normal(size=9) * scale - 2.0
            w[0] = 3 * scale

            def parts(w):
                g = lambda r: sum(w[int(b)] for b in r) + w[-1]
                loss = lambda z: float(np.log1p(np.exp(-z)))
                neg = sum(loss(-g(r)) for r in unl) / len(unl) - prior * sum(loss(-g(r)) for r in pos) / len(pos)
                return prior * sum(loss(g(r)) for r in pos) / len(pos), neg

            a, b, direction = op.risk(p, u, w, prior)
            assert np.allclose([a, b], parts(w))
            signs.add(b >= 0)
            total = (lambda w: sum(parts(w))) if b >= 0 else (lambda w: -parts(w)[1])
            for j in range(9):
                e = np.zeros(9)
                e[j] = 1e-6
                assert np.isclose((total(w + e) - total(w - e)) / 2e-6, direction[j], atol=1e-7)
    assert signs == {True, False}


def test_held_out_accuracy_on_a_table(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op10_toxicity_scores"](spark, d).collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(labels[i], r.score) for i, r in got.items() if r.held_out and labels.get(i) is not None]
    pos, neg = (np.array([s for y, s in held if y == k]) for k in (1, 0))
    auc = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert auc > 0.95 and (neg >= 0.5).mean() < 0.02 and (pos >= 0.5).mean() > 0.7


def test_rows(spark, docs_of):
    rows = [(i, f"plain words number n{i} here" + (" awful" if i % 9 == 0 else "")) for i in range(300)] + [(None, "awful"), (900, None), (901, ""), (0, "plain"), (902, "long " * 50_000 + "awful")]
    labels = [(i, 1, int(i % 9 == 0)) for i in range(0, 300, 2)] + [(4, 1, None), (0, 1, 0), (None, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = op.fit(docs_of(rows), lab)
    out = op.score(docs_of(rows), model)
    got = out.collect()
    assert len(got) == len(rows) and out.columns.count("score") == 1
    by = {r.text: r.score for r in got}
    assert by["awful"] > by["plain"] and by[None] == by[""]
    assert op.fit(docs_of(rows), lab.limit(0)) is None
    none = op.score(docs_of(rows), None)
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)} and none.columns.count("score") == 1
    assert op.score(docs_of([]), model).count() == 0 and op.fit(docs_of([]), lab) is None
