"""What the check of round 3 named in the toxicity scores."""

import numpy as np

from millrace.llm import toxicity


def plain_index(n, width, k):
    return toxicity.Index(None, np.ones(width), np.zeros(n), np.ones(n), [str(i) for i in range(n)], 0.1, k, 4.0, 0.5)


def test_frequent_terms_are_not_gone_through_posting_by_posting(monkeypatch):
    """op6: postings of terms that half of the examples have are no steps of their own, and all neighbours are those of the full product."""
    rng = np.random.RandomState(3)
    n, frequent, width, k = 960, 60, 400, 5
    share = np.where(np.arange(width) < frequent, 0.5, 0.004)
    dense, q = (np.where(rng.rand(m, width) < share, 0.1 + rng.rand(m, width), 0) for m in (n, 100))
    index = plain_index(n, width, k)
    example, term = np.nonzero(dense)
    index.build(term, example, dense[example, term])
    text, at = np.nonzero(q)
    steps, ranges = [], toxicity._ranges

    def counted(lo, hi):
        steps.append(int((hi - lo).sum()))
        return ranges(lo, hi)

    monkeypatch.setattr(toxicity, "_ranges", counted)
    got = index.nearest(np.searchsorted(text, np.arange(101)), at, q[text, at])
    want = q @ dense.T
    near = np.argsort(-got, axis=1, kind="stable")[:, :k]
    assert np.allclose(np.take_along_axis(got, near, 1), -np.sort(-want, axis=1)[:, :k])
    assert np.allclose(got[got >= 0], want[got >= 0])
    assert sum(steps) < (dense > 0).sum(axis=0)[at].sum() / 20


def test_equal_cosines_rank_by_place_whatever_the_order_of_sums():
    """op6: 0.1 + 0.2 + 0.3 and 0.3 + 0.2 + 0.1 differ in the last bit, and the lower place wins."""
    cosines = np.array([[0.5, 0.3 + 0.2 + 0.1, 0.1 + 0.2 + 0.3, 0.7]])
    assert cosines[0, 1] != cosines[0, 2]
    _, near, cosine = plain_index(4, 3, 3).votes(cosines)
    assert near.tolist() == [[3, 1, 2]] and cosine.tolist() == [[0.7, cosines[0, 1], cosines[0, 2]]]


def test_two_examples_leave_votes_as_they_are(spark):
    """op6: folds without an example, or whose index would lack a class, give no vote to calibrate with."""
    docs = spark.createDataFrame([(0, "good words here"), (1, "grumbly words here")], "doc_id long, text string")
    index = toxicity.train(docs, spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int"))
    assert (index.slope, index.shift, len(index.names)) == (1.0, 0.0, 2)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, index).collect()}
    assert scores[0] < scores[1]
