"""Fits against plain rounds, and what holds for any: counts, nearest centres, cost."""

import random

import pytest
from pyspark.sql import functions as F

from wardwatch import operators as ops
from wardwatch.plans import views

CENTRES = [(41.9, -87.6), (41.7, -87.7), (42.0, -87.8)]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    data = []
    for i in range(900):
        lat, lon = CENTRES[i % 3]
        # Positions recur, as they do when they are given per block.
        step = rng.randrange(5) / 1000
        data.append((str(i), "T", "8", lat + step, lon - step))
    data += [("n1", "T", "8", None, -87.6), ("n2", "T", "8", 41.9, None)]
    return spark.createDataFrame(
        data, "id string, primary_type string, district string, latitude double, longitude double"
    )


@pytest.fixture(scope="module")
def fitted(points):
    return ops.fit_hotspots(points, k=3)


def test_sizes_sum_to_the_located_points(fitted):
    sizes = ops.cluster_sizes(*fitted).collect()
    assert [r["crime_count"] for r in sizes] == [300, 300, 300]
    for row in sizes:
        assert min(
            abs(row["centroid_latitude"] - lat) + abs(row["centroid_longitude"] - lon)
            for lat, lon in CENTRES
        ) < 0.01


def test_model_is_fitted_to_distinct_positions(fitted):
    model, positions = fitted
    assert positions.count() == 15
    assert positions.agg(F.sum("points")).first()[0] == 900
    assert ops.fit_summary(model, positions).first()["cost"] < 0.01


def test_weighted_cost_is_the_cost_over_all_points(points, fitted):
    model, positions = fitted
    labelled = ops.label_points(model, points, ["id"]).collect()
    centres = model.centres
    cost = sum(
        (r["latitude"] - centres[r["cluster"]][0]) ** 2
        + (r["longitude"] - centres[r["cluster"]][1]) ** 2
        for r in labelled
    )
    assert cost == pytest.approx(ops.fit_summary(model, positions).first()["cost"])


def test_every_point_has_its_nearest_centre(points, fitted):
    model, _ = fitted
    labelled = ops.label_points(model, points, ["id", "primary_type", "district"])
    assert labelled.columns == [
        "id",
        "primary_type",
        "district",
        "latitude",
        "longitude",
        "cluster",
    ]
    rows = labelled.collect()
    assert len(rows) == 900
    centres = model.centres
    for r in rows:
        away = [(r["latitude"] - c[0]) ** 2 + (r["longitude"] - c[1]) ** 2 for c in centres]
        assert away[r["cluster"]] == pytest.approx(min(away), abs=1e-9)


def test_a_second_fit_gives_the_same(points, fitted):
    again, _ = ops.fit_hotspots(points.repartition(7), k=3)
    assert again == fitted[0]


def test_fit_is_that_of_plain_rounds(points, fitted):
    """Weighted farthest points, then means, in whole numbers of the grid."""
    from collections import Counter
    from fractions import Fraction

    located = [(r.latitude, r.longitude) for r in points.dropna().collect()]
    grid = Counter((int(lat * 1e9 + 0.5), -int(-lon * 1e9 + 0.5)) for lat, lon in located)
    square = lambda p, c: (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2
    centres = [min(grid, key=lambda p: (-grid[p], p))]
    while len(centres) < 3:
        score = {p: n * min(square(p, c) for c in centres) for p, n in grid.items()}
        centres.append(min(grid, key=lambda p: (-score[p], p)))
    for _ in range(20):
        own = {p: min(range(3), key=lambda c: square(p, centres[c])) for p in grid}
        for c in range(3):
            mine = [p for p in grid if own[p] == c]
            total = sum(grid[p] for p in mine)
            centres[c] = tuple(Fraction(sum(p[i] * grid[p] for p in mine), total) for i in (0, 1))
    for ours, plain in zip(fitted[0].grid, centres):
        assert ours == pytest.approx(tuple(map(float, plain)))


def test_spark_ml_finds_the_same_clusters(points, fitted):
    model, positions = ops.fit_kmeans(points, k=3)
    assert [r["crime_count"] for r in ops.cluster_sizes(model, positions).collect()] == [300] * 3
    for one in model.centres:
        assert min(abs(one[0] - c[0]) + abs(one[1] - c[1]) for c in fitted[0].centres) < 1e-6


def test_no_points(points):
    model, positions = ops.fit_hotspots(points.limit(0))
    assert model.centres == [] and ops.cluster_sizes(model, positions).collect() == []
    assert ops.label_points(model, points.limit(0), ["id"]).collect() == []
    assert ops.fit_summary(model, positions).first()["cost"] == 0


def test_fewer_positions_than_clusters(points):
    model, positions = ops.fit_hotspots(points.limit(3), k=10)
    assert len(model.centres) <= 3
    assert ops.cluster_sizes(model, positions).agg(F.sum("crime_count")).first()[0] == 3


def test_views_of_hotspots(fitted):
    sizes = ops.cluster_sizes(*fitted)
    shown = views.v_hotspot_map(sizes).collect()
    assert [r["size"] for r in shown] == [50.0] * 3
    assert shown[0]["label"] == f"Cluster {shown[0]['cluster_id']} — 300 crimes"
    stats = views.v_cluster_stats(sizes).collect()
    assert {r["pct_of_total"] for r in stats} == {"33.3%"}
