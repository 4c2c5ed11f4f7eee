"""K-means with given centers, Spark ML clustering, silhouette and label accuracy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
from pyspark.storagelevel import StorageLevel

# A metric maps points (n, d) and one center (d,) to n distances.
Metric = Callable[[np.ndarray, np.ndarray], np.ndarray]


def mean_squared(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Mean of squared differences: squared Euclidean distance over the dimension."""
    difference = points - center
    return np.einsum("ij,ij->i", difference, difference) / points.shape[1]


def mean_absolute(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.abs(points - center).mean(axis=1)


METRICS: dict[str, Metric] = {"sqeuclidean": mean_squared, "manhattan": mean_absolute}


def _matrix(column: pa.Array) -> np.ndarray:
    if column.null_count or pa.compute.list_flatten(column).null_count:
        raise ValueError("points and their coordinates must not be null")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return flat.reshape(len(column), -1)


def _nearest(points: np.ndarray, centers: np.ndarray, metric: Metric):
    """Index of and distance to the nearest center; the lowest index wins a tie."""
    distances = np.stack([metric(points, center) for center in centers], axis=1)
    index = distances.argmin(axis=1)
    return index, distances[np.arange(len(points)), index]


@dataclass
class GivenCentersKMeans:
    """Lloyd's iterations from given centers, for a fixed number of rounds.

    ``costs`` holds, per round, the sum of distances to the centers before their update.
    New centers are means under either metric. A cluster that loses all points is gone.

    Each task reduces its points to one row per cluster with numpy, so a round shuffles
    tasks x k rows and brings k rows to the driver, whatever the number of points.
    """

    max_iter: int
    centers: dict[int, np.ndarray]
    metric: str | Metric = "sqeuclidean"
    costs: list[float] = field(default_factory=list)

    def _distance(self) -> Metric:
        return METRICS[self.metric] if isinstance(self.metric, str) else self.metric

    def _current(self) -> tuple[np.ndarray, np.ndarray]:
        ids = sorted(self.centers)
        return np.array(ids, dtype="int32"), np.array([self.centers[i] for i in ids], dtype="float64")

    def fit(self, points: DataFrame, column: str = "point") -> GivenCentersKMeans:
        points = points.select(F.col(column).cast("array<double>").alias("point"))
        points = points.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for _ in range(self.max_iter):
                self._round(points)
        finally:
            points.unpersist()
        return self

    def _round(self, points: DataFrame) -> None:
        ids, centers = self._current()
        distance = self._distance()

        def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, cost, total = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(centers.shape)
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                block = _matrix(batch.column(0))
                index, nearest = _nearest(block, centers, distance)
                n += np.bincount(index, minlength=len(ids))
                cost += np.bincount(index, weights=nearest, minlength=len(ids))
                total += (index == np.arange(len(ids))[:, None]).astype("float64") @ block
            used = n > 0
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array(ids[used]),
                    "n": pa.array(n[used].astype("int64")),
                    "cost": pa.array(cost[used]),
                    "total": pa.array(list(total[used]), pa.list_(pa.float64())),
                }
            )

        rows = (
            points.mapInArrow(partial_sums, "cluster int, n long, cost double, total array<double>")
            .groupBy("cluster")
            .agg(
                F.sum("n").alias("n"),
                F.sum("cost").alias("cost"),
                Summarizer.sum(array_to_vector("total")).alias("total"),
            )
            .collect()
        )
        self.costs.append(sum(row["cost"] for row in rows))
        self.centers = {row["cluster"]: row["total"].toArray() / row["n"] for row in rows}

    def assign(self, points: DataFrame, column: str = "point") -> DataFrame:
        """``points`` with the nearest current center: columns cluster and distance."""
        ids, centers = self._current()
        distance = self._distance()
        added = [StructField("cluster", IntegerType()), StructField("distance", DoubleType())]
        schema = StructType([*points.schema.fields, *added])

        def nearest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows == 0:
                    index, nearest = np.zeros(0, dtype=int), np.zeros(0)
                else:
                    block = _matrix(batch.column(column))
                    index, nearest = _nearest(block, centers, distance)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(ids[index]), pa.array(nearest)],
                    names=[*batch.schema.names, "cluster", "distance"],
                )

        return points.mapInArrow(nearest_rows, schema)

    def center_rows(self, spark: SparkSession) -> DataFrame:
        """The current centers as ``(cluster, center)``: k rows."""
        rows = [(c, [float(x) for x in v]) for c, v in sorted(self.centers.items())]
        return spark.createDataFrame(rows, "cluster int, center array<double>")

    def cost_rows(self, spark: SparkSession) -> DataFrame:
        """One row per round: ``(round, cost)``."""
        return spark.createDataFrame(list(enumerate(self.costs, 1)), "round int, cost double")


def centers_from(rows: DataFrame) -> dict[int, np.ndarray]:
    """Bring a k-row center table ``(cluster, center)`` to the driver."""
    return {row["cluster"]: np.array(row["center"]) for row in rows.collect()}


def group_means(points: DataFrame, group: str, column: str = "point") -> DataFrame:
    """Mean vector per group as ``(cluster, center)``."""
    return (
        points.groupBy(F.col(group).cast("int").alias("cluster"))
        .agg(Summarizer.mean(array_to_vector(F.col(column).cast("array<double>"))).alias("mean"))
        .select("cluster", vector_to_array("mean").alias("center"))
    )


def assemble(rows: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    """Gather number columns into one ML vector column."""
    return rows.withColumn(output, array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def as_vectors(points: DataFrame, column: str = "point", output: str = "features") -> DataFrame:
    return points.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def ml_kmeans(vectors: DataFrame, k: int, seed: int = 1, features: str = "features") -> KMeansModel:
    return KMeans(featuresCol=features).setK(k).setSeed(seed).fit(vectors)


def pca(vectors: DataFrame, k: int, features: str = "features", output: str = "pca") -> PCAModel:
    """Principal components. ``transform`` projects the rows as they are, without centering."""
    return PCA(k=k, inputCol=features, outputCol=output).fit(vectors)


def silhouette(clustered: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """Mean silhouette under squared Euclidean distance, in time linear in the rows."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(clustered)


def label_accuracy(clustered: DataFrame, cluster: str, label: str) -> DataFrame:
    """Two clusters against two labels, under the better naming of the clusters."""
    counts = clustered.agg(
        F.count_if(F.col(cluster) == F.col(label)).alias("same"), F.count("*").alias("n")
    )
    correct = F.greatest(F.col("same"), F.col("n") - F.col("same"))
    return counts.select(correct.alias("correct"), "n", (correct / F.col("n")).alias("accuracy"))


def covariance(vectors: DataFrame, features: str = "features") -> np.ndarray:
    """The sample covariance matrix: tasks reduce their rows to sums about a common point, which add up.

    One row of the squared dimension a task reaches the driver.
    """
    rows = vectors.select(vector_to_array(features).alias("x"))
    first = rows.first()
    if first is None:
        return np.zeros((0, 0))
    near = np.array(first.x)  # sums about a point of the data lose nothing far from zero
    size = len(near)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, size) - near
            n, total, squares = n + len(x), total + x.sum(axis=0), squares + x.T @ x
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total.tolist()], "squares": [squares.ravel().tolist()]})

    parts = rows.mapInArrow(sums, "n bigint, total array<double>, squares array<double>").collect()
    n, total = sum(p.n for p in parts), sum(np.array(p.total) for p in parts)
    squares = sum(np.array(p.squares) for p in parts).reshape(size, size)
    return (squares - np.outer(total, total) / n) / max(n - 1, 1)


def pca_residuals(model: PCAModel, vectors: DataFrame, features: str = "features") -> DataFrame:
    """``(component, share, residual)``: the share of the variance that a component explains by the data's
    own covariance, and how far it is from an eigenvector of it (relative to the eigenvalue)."""
    matrix = covariance(vectors, features)
    rows = []
    for number, direction in enumerate(model.pc.toArray().T, 1):
        value = float(direction @ matrix @ direction)
        residual = float(np.linalg.norm(matrix @ direction - value * direction)) / max(abs(value), 1e-30)
        rows.append((number, value / float(np.trace(matrix)), residual))
    return vectors.sparkSession.createDataFrame(rows, "component int, share double, residual double")


def settled(model: KMeansModel, clustered: DataFrame, features: str = "features", cluster: str = "prediction") -> DataFrame:
    """``(cluster, n, misplaced, moved)``: rows of a cluster, rows whose nearest center is another one, and
    how far the cluster's mean is from its center. Nothing is misplaced or moves at a fixed point."""
    centers = [[float(c) for c in center] for center in model.clusterCenters()]
    point = vector_to_array(features)
    gap = lambda center: F.aggregate(
        F.zip_with(point, F.array(*map(F.lit, center)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d
    )
    gaps = F.array(*[gap(center) for center in centers])
    judged = clustered.select(F.col(cluster).alias("cluster"), F.col(features).alias("x"), gaps.alias("gaps"))
    # a tie may go to either center
    farther = F.col("gaps")[F.col("cluster")] > F.array_min("gaps") * (1 + 1e-9) + 1e-12
    sums = judged.groupBy("cluster").agg(F.count("*").alias("n"), F.count_if(farther).alias("misplaced"), Summarizer.mean(F.col("x")).alias("mean"))
    named = clustered.sparkSession.createDataFrame(list(enumerate(centers)), "cluster int, center array<double>")
    moved = F.aggregate(F.zip_with(vector_to_array("mean"), "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    return sums.join(F.broadcast(named), "cluster").select("cluster", "n", "misplaced", F.sqrt(moved).alias("moved"))
