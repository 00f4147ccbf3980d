"""Points in polygons against trying every side of every polygon."""

import json
import random

from portpulse.operators.areas import points_in_areas


def inside(px, py, polygons):
    odd = False
    for ring in (r for p in polygons for r in p):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (px - x1) * (y2 - y1) == (py - y1) * (x2 - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_points_in_areas(spark):
    r = random.Random(5)
    star = [[1.0, 0.0], [1.3, 1.0], [2.0, 1.2], [1.4, 1.5], [1.6, 2.4], [1.0, 1.8], [0.2, 2.5], [0.6, 1.4], [-0.3, 1.1], [0.7, 0.9]]
    shapes = {
        "star": [[star]],  # not closed
        "square with a hole": [[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], [[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5], [0.5, 0.5]]]],
        "two parts": [[[[-1, -1], [-0.5, -1], [-0.75, 0.5], [-1, -1]]], [[[2.5, 0], [3, 0], [3, 3], [2.5, 0]]]],
        "far": [[[[100, 100], [101, 100], [101, 101], [100, 100]]]],
        "point": [[[[1, 1], [1, 1], [1, 1]]]],
    }
    rows = [
        (name, json.dumps({"type": "Polygon", "coordinates": polygons[0]} if len(polygons) == 1 else {"type": "MultiPolygon", "coordinates": polygons}))
        for name, polygons in shapes.items()
    ]
    rows += [("none", None), ("broken", "{not json"), ("line", json.dumps({"type": "LineString", "coordinates": [[0, 0], [1, 1]]}))]
    boundaries = spark.createDataFrame(rows, "area string, geometry string")
    points = [(r.uniform(-1.5, 3.5), r.uniform(-1.5, 3.5)) for _ in range(400)]
    points += [(0.0, 0.0), (2.0, 1.0), (0.5, 0.75), (1.0, 1.0), (1.0, 0.0), (-0.75, 0.5), (0.5, 2.0), (100.5, 100.25), (2.5, 0.0)]
    data = [(k, x, y, "x") for k, (x, y) in enumerate(points)] + [(9000, None, 1.0, "x"), (9001, 1.0, None, "x")]
    frame = spark.createDataFrame(data, "id int, longitude double, latitude double, _strip string")
    want = {(k, name) for k, (x, y) in enumerate(points) for name, polygons in shapes.items() if inside(x, y, polygons)}
    assert len({n for _, n in want}) == 5
    for cell in (0.25, 1.7):
        got = points_in_areas(frame.drop("_strip"), boundaries, "area", cell=cell).collect()
        assert sorted((p.id, p.area) for p in got) == sorted(want)
    plan = points_in_areas(frame.drop("_strip"), boundaries, "area")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
