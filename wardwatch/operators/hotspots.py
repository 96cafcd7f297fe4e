"""Geographic hotspots: k centres with the points nearest to them.

Coordinates are taken on a grid of a billionth of a degree, so that sums over points are
whole numbers and come out the same in any order, on any number of tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.session import checkpointed

GRID = 1e9
ROUNDS = 20


@dataclass
class Clustering:
    """Centres on the grid, by cluster, and how many rounds moved them."""

    grid: list[tuple[float, float]]
    rounds: int

    @property
    def centres(self) -> list[tuple[float, float]]:
        return [(x / GRID, y / GRID) for x, y in self.grid]


def located(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    """Rows with both coordinates."""
    return df.filter(F.col(latitude).isNotNull() & F.col(longitude).isNotNull())


def _on_grid(coordinate: str) -> Column:
    return F.floor(F.col(coordinate).cast("double") * GRID + 0.5).cast("double")


def _positions(points: DataFrame, latitude: str, longitude: str) -> DataFrame:
    """(gx, gy, points): distinct positions, stored in the shared folder."""
    known = located(points, latitude, longitude)
    placed = known.select(_on_grid(latitude).alias("gx"), _on_grid(longitude).alias("gy"))
    return checkpointed(placed.groupBy("gx", "gy").agg(F.count("*").alias("points")))


def _squares(grid: list[tuple[float, float]], x: Column, y: Column) -> list[Column]:
    return [(x - cx) * (x - cx) + (y - cy) * (y - cy) for cx, cy in grid]


def _least(squares: list[Column]) -> Column:
    return F.least(*squares) if len(squares) > 1 else squares[0]


def _nearest(grid: list[tuple[float, float]], x: Column, y: Column) -> Column:
    """Number of the nearest centre; of equal ones, the first."""
    squares = _squares(grid, x, y)
    return (F.array_position(F.array(*squares), _least(squares)) - 1).cast("int")


def fit_hotspots(
    points: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    k: int = 10,
    rounds: int = ROUNDS,
) -> tuple[Clustering, DataFrame]:
    """k-means from a start that follows from the points; also gives the distinct positions.

    Positions recur (they are given per street block), so the fit is to the distinct ones
    weighted by their count. The first centre is the heaviest position, each further one the
    position of the greatest weight times squared distance from those before; equal ones go
    by their coordinates. Then centres move to the means of their points until they stay, at
    most ``rounds`` times; one without points stays. Every step is one aggregate of a row per
    centre over the stored positions, so only centres reach the driver, and the same points
    give the same centres, whatever their partitions.
    """
    positions = _positions(points, latitude, longitude)
    grid = _start(positions, k)
    for done in range(rounds):
        moved = _moved(positions, grid)
        if moved == grid:
            return Clustering(grid, done), positions
        grid = moved
    return Clustering(grid, rounds), positions


def _start(positions: DataFrame, k: int) -> list[tuple[float, float]]:
    x, y, weight = F.col("gx"), F.col("gy"), F.col("points").cast("double")
    grid: list[tuple[float, float]] = []
    while len(grid) < k:
        score = weight * _least(_squares(grid, x, y)) if grid else weight
        best = F.max(F.struct(score.alias("score"), (-x).alias("x"), (-y).alias("y")))
        row = positions.filter(score > 0).agg(best.alias("best")).first()["best"]
        if row is None:  # fewer positions than centres
            break
        grid.append((0.0 - row["x"], 0.0 - row["y"]))
    return grid


def _moved(positions: DataFrame, grid: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The means of the points of each centre."""
    if not grid:
        return grid
    x, y = F.col("gx"), F.col("gy")
    sums = [F.sum(c.cast("decimal(18,0)") * F.col("points")).cast("double") for c in (x, y)]
    count = F.sum("points").cast("double")
    means = positions.groupBy(_nearest(grid, x, y).alias("cluster")).agg(
        (sums[0] / count).alias("x"), (sums[1] / count).alias("y")
    )
    moved = {row["cluster"]: (row["x"], row["y"]) for row in means.collect()}
    return [moved.get(cluster, centre) for cluster, centre in enumerate(grid)]


def fit_kmeans(
    points: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    k: int = 10,
    seed: int = 42,
    **params,
) -> tuple[Clustering, DataFrame]:
    """The same with Spark ML's KMeans, which draws its start by ``seed``.

    The result depends on how the positions are partitioned, not on the points alone.
    """
    positions = _positions(points, latitude, longitude)
    degrees = positions.select(
        (F.col("gx") / GRID).alias("x"),
        (F.col("gy") / GRID).alias("y"),
        F.col("points").cast("double").alias("weight"),
    ).sortWithinPartitions("x", "y")
    featured = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(degrees)
    kmeans = KMeans(
        k=k, seed=seed, featuresCol="features", predictionCol="cluster", weightCol="weight", **params
    )
    model = kmeans.fit(featured)
    grid = [(float(c[0]) * GRID, float(c[1]) * GRID) for c in model.clusterCenters()]
    return Clustering(grid, model.summary.numIter), positions


def cluster_sizes(fit: Clustering, positions: DataFrame, name: str = "crime_count") -> DataFrame:
    """One row per centre with the number of points assigned to it."""
    schema = "cluster_id int, centroid_latitude double, centroid_longitude double"
    centres = [(number, *centre) for number, centre in enumerate(fit.centres)]
    table = positions.sparkSession.createDataFrame(centres, schema)
    nearest = _nearest(fit.grid, F.col("gx"), F.col("gy")) if fit.grid else F.lit(0)
    sizes = positions.groupBy(nearest.alias("cluster")).agg(F.sum("points").alias(name))
    joined = table.join(sizes, table.cluster_id == sizes.cluster, "left").drop("cluster")
    return joined.orderBy(F.desc(name), "cluster_id")


def label_points(
    fit: Clustering,
    points: DataFrame,
    keep: list[str],
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """Every located point with its cluster; no shuffle."""
    known = located(points, latitude, longitude)
    nearest = _nearest(fit.grid, _on_grid(latitude), _on_grid(longitude)) if fit.grid else F.lit(0)
    return known.select(*keep, latitude, longitude, nearest.alias("cluster"))


def fit_summary(fit: Clustering, positions: DataFrame) -> DataFrame:
    """(located_points, positions, clusters, cost) of a fit, in one row.

    The cost is the sum of squared distances of all points to their centres.
    """
    square = _least(_squares(fit.grid, F.col("gx"), F.col("gy"))) if fit.grid else F.lit(0.0)
    return positions.agg(
        F.coalesce(F.sum("points"), F.lit(0)).alias("located_points"),
        F.count("*").alias("positions"),
        F.lit(len(fit.grid)).cast("long").alias("clusters"),
        F.coalesce(F.sum(F.col("points") * square / GRID / GRID), F.lit(0.0)).alias("cost"),
    )
