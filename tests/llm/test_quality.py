"""The quality classifier: held-out accuracy, trees and awkward rows."""

import numpy as np
import pytest

from chatloom.llm import quality
from chatloom.llm.trees import BINS, LEAST_HESSIAN, RATE, RIDGE, _edges, fit

SF_DIR = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def test_trees_learn_and_flat_traversal_equals_walking():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(float)
    model = fit(rows[:2000], labels[:2000])
    scores = model.score(rows[2000:])
    assert ((scores > 0.5) == labels[2000:]).mean() > 0.95

    def walk(row):
        odds = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            odds += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-odds))

    assert np.allclose(scores[:50], [walk(r) for r in rows[2000:2050]])


def test_every_split_is_the_best_one():
    """Splits and leaves of every tree against sums over the rows of each node."""
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 12, size=(400, 3)).astype(float)
    labels = ((rows[:, 0] + rows[:, 1] > 11) ^ (rng.random(400) < 0.1)).astype(float)
    model = fit(rows, labels)
    odds = np.full(len(rows), model.base)
    splits = 0

    def weight(own):
        return gradient[own].sum() ** 2 / (hessian[own].sum() + RIDGE)

    def gain(own, feature, threshold):
        right = rows[own, feature] > threshold
        sides = own[~right], own[right]
        if min(hessian[side].sum() for side in sides) < LEAST_HESSIAN:
            return 0.0
        return weight(sides[0]) + weight(sides[1]) - weight(own)

    def visit(node, own):
        nonlocal splits
        if node >= len(feature):
            value = -RATE * gradient[own].sum() / (hessian[own].sum() + RIDGE)
            assert np.isclose(leaf[node - len(feature)], value)
            odds[own] += value
            return
        cuts = [(f, v) for f in range(rows.shape[1]) for v in range(11)]
        best = max(gain(own, f, v) for f, v in cuts)
        chosen = gain(own, feature[node], threshold[node])
        assert np.isclose(chosen, max(best, 0.0), atol=1e-6)
        splits += np.isfinite(threshold[node])
        right = rows[own, feature[node]] > threshold[node]
        visit(2 * node + 1, own[~right])
        visit(2 * node + 2, own[right])

    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        chance = 1 / (1 + np.exp(-odds))
        gradient, hessian = chance - labels, chance * (1 - chance)
        visit(0, np.arange(len(rows)))
    assert splits > 100
    assert np.allclose(model.score(rows), 1 / (1 + np.exp(-odds)))


def test_bins_hold_even_shares():
    column = np.random.default_rng(2).permutation(6400).astype(float)
    edges = _edges(column)
    assert len(edges) == BINS - 1
    sizes = np.bincount(np.searchsorted(edges, column), minlength=BINS)
    assert abs(sizes - 100).max() <= 2
    # A value that most rows have is one border at most, the largest none.
    assert _edges(np.array([0.0] * 900 + [1.0] * 50 + [2.0] * 50)).tolist() == [0.0, 1.0]
    assert _edges(np.full(10, 3.0)).tolist() == []


def test_one_label_or_none_gives_its_share():
    rows = np.ones((4, 3))
    assert fit(rows, np.ones(4)).score(rows).min() > 0.99
    assert fit(rows[:0], np.zeros(0)).score(rows).tolist() == [0.5] * 4


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    return quality.quality_scores(docs, labels).join(labels, "doc_id").toPandas()


def test_held_out_documents_are_told_apart(scored):
    held = scored[scored.held_out]
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() > 0.97
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.98


def test_awkward_rows(spark, documents, awkward):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 0, 0), (7, 0, None), (99, None, 0), (None, 1, 0)], LABELS
    )
    frame = documents(awkward, clashing=True)
    got = quality.quality_scores(frame, labels).collect()
    assert len(got) == len(awkward)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    kept = quality.without_rejects(frame, labels)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_without_labels_everything_stays(spark, documents, awkward):
    labels = spark.createDataFrame([], LABELS)
    assert quality.without_rejects(documents(awkward), labels).count() == len(awkward)
    assert quality.quality_scores(documents([]), labels).count() == 0


def test_held_out_rows_teach_nothing(spark, documents):
    import zlib

    rows = [(i, "good text here" if i % 2 else "BAD!!! BAD###") for i in range(300)]
    labels = [(i, i % 2, 0) for i, _ in rows]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, q, _ in labels]
    models = [
        quality.learn(documents(rows), spark.createDataFrame(x, LABELS)) for x in (labels, flipped)
    ]
    assert np.array_equal(models[0].leaf, models[1].leaf)
