"""K-means with given centers against plain numpy, and the Spark ML parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.operators import clustering as cl
from tarn.sources.lines import read_centers, read_points


def frame(spark, points):
    return spark.createDataFrame([([float(x) for x in p],) for p in points], "point array<double>")


def plain_lloyd(points, centers, rounds, distance):
    costs = []
    for _ in range(rounds):
        ids = sorted(centers)
        table = np.array([[distance(p, centers[c]) for c in ids] for p in points])
        nearest = np.array(ids)[table.argmin(axis=1)]
        costs.append(table.min(axis=1).sum())
        centers = {c: points[nearest == c].mean(axis=0) for c in ids if (nearest == c).any()}
    return costs, centers


@pytest.mark.parametrize("metric,distance", [
    ("sqeuclidean", lambda p, c: np.mean((p - c) ** 2)),
    ("manhattan", lambda p, c: np.mean(np.abs(p - c))),
    (lambda x, c: np.abs(x - c).max(axis=1), lambda p, c: np.abs(p - c).max()),
])
def test_lloyd(spark, metric, distance):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(m, 1, (70, 6)) for m in (0, 3, 6)])
    # The fourth center is far away and vanishes in the first round.
    centers = {0: points[0], 1: points[1], 2: points[100], 3: np.full(6, 1e3)}
    model = cl.GivenCentersKMeans(5, centers, metric).fit(frame(spark, points))
    costs, final = plain_lloyd(points, centers, 5, distance)
    assert np.allclose(model.costs, costs)
    assert sorted(model.centers) == sorted(final) == [0, 1, 2]
    assert all(np.allclose(model.centers[c], final[c]) for c in final)
    if metric == "sqeuclidean":
        assert all(a >= b for a, b in zip(model.costs, model.costs[1:]))
    assigned = model.assign(frame(spark, points)).collect()
    for row in assigned:
        distances = {c: distance(np.array(row.point), v) for c, v in model.centers.items()}
        assert row.cluster == min(distances, key=distances.get)
        assert row.distance == pytest.approx(min(distances.values()))


def test_tie_goes_to_the_lowest_cluster(spark):
    model = cl.GivenCentersKMeans(0, {7: np.array([1.0]), 2: np.array([-1.0])})
    assert model.assign(frame(spark, [[0.0]])).first().cluster == 2


def test_empty_partitions_and_bad_points(spark):
    points = frame(spark, [[0.0], [1.0]]).repartition(8)
    model = cl.GivenCentersKMeans(1, {0: np.array([0.0])}).fit(points)
    assert model.costs == [1.0] and model.centers[0] == [0.5]
    assert model.assign(points.where("point[0] > 5")).count() == 0
    with pytest.raises(Exception, match="must not be null"):
        cl.GivenCentersKMeans(1, {0: np.array([0.0])}).fit(
            spark.createDataFrame([([None],)], "point array<double>")
        )


def test_files_and_result_frames(spark, tmp_path):
    (tmp_path / "centers.txt").write_text("0 0\n10 10\n0 10\n")
    (tmp_path / "points.txt").write_text("1 1\n9 9.5\n0 9\n")
    centers = cl.centers_from(read_centers(spark, str(tmp_path / "centers.txt")))
    assert {c: list(v) for c, v in centers.items()} == {0: [0, 0], 1: [10, 10], 2: [0, 10]}
    model = cl.GivenCentersKMeans(2, centers).fit(read_points(spark, str(tmp_path / "points.txt")))
    rows = {r.cluster: r.center for r in model.center_rows(spark).collect()}
    assert rows == {0: [1.0, 1.0], 1: [9.0, 9.5], 2: [0.0, 9.0]}
    assert [(r["round"], r.cost) for r in model.cost_rows(spark).collect()][1] == (2, 0.0)


def test_pca_and_ml_kmeans(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=(200, 5)) * [5, 3, 1, 0.5, 0.1] + 4
    rows = spark.createDataFrame([tuple(map(float, v)) for v in values], list("abcde"))
    vectors = cl.assemble(rows, list("abcde"))
    model = cl.pca(vectors, 2)
    _, basis = np.linalg.eigh(np.cov(values.T))
    for found, expected in zip(model.pc.toArray().T, basis.T[::-1]):
        assert abs(found @ expected) == pytest.approx(1.0)
    projected = np.array([r.pca.toArray() for r in model.transform(vectors).collect()])
    original = np.array([r.features.toArray() for r in vectors.collect()])
    assert np.allclose(projected, original @ model.pc.toArray())

    blobs = np.concatenate([rng.normal(0, 0.1, (30, 3)), rng.normal(9, 0.1, (20, 3))])
    labelled = spark.createDataFrame(
        [([float(x) for x in p], int(i >= 30)) for i, p in enumerate(blobs)],
        "point array<double>, truth int",
    )
    vectors = cl.as_vectors(labelled)
    clustered = cl.ml_kmeans(vectors, 2).transform(vectors)
    assert cl.silhouette(clustered) > 0.99
    row = cl.label_accuracy(clustered, "prediction", "truth").first()
    assert (row.correct, row.n, row.accuracy) == (50, 50, 1.0)


def test_accuracy_takes_the_better_naming(spark):
    rows = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 1)], "cluster int, label int")
    row = cl.label_accuracy(rows, "cluster", "label").first()
    assert (row.correct, row.n, row.accuracy) == (3, 4, 0.75)


def test_components_and_clusters_are_checked(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(300, 4)) * [5, 3, 1, 0.5] + 1e6
    frame = cl.as_vectors(spark.createDataFrame([(r.tolist(),) for r in data], "point array<double>"))
    assert np.allclose(cl.covariance(frame), np.cov(data.T), atol=1e-6)
    centred = cl.as_vectors(spark.createDataFrame([(r.tolist(),) for r in data - 1e6], "point array<double>"))
    model = cl.pca(centred, 2)
    rows = cl.pca_residuals(model, centred).collect()
    assert max(r.residual for r in rows) < 1e-8 and [r.share for r in rows] == pytest.approx(list(model.explainedVariance.toArray()))
    wrong = cl.as_vectors(spark.createDataFrame([(r[::-1].tolist(),) for r in data], "point array<double>"))
    assert min(r.residual for r in cl.pca_residuals(model, wrong).collect()) > 0.1
    fitted = cl.ml_kmeans(centred, 3)
    found = cl.settled(fitted, fitted.transform(centred)).collect()
    assert sum(r.n for r in found) == 300 and sum(r.misplaced for r in found) == 0 and len(found) == 3
    moved = fitted.transform(centred).withColumn("prediction", F.lit(0))
    assert cl.settled(fitted, moved).first().misplaced > 100
