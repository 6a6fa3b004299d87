import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from haulscore import schemas
from haulscore.functions.geometry import MOST_EDGES, OUTSIDE, exact_sign, segment_cells
from haulscore.operators import assign_segments, attach_segments, override_segments
from haulscore.sources import segments_from_wkt
from helpers import layer, rows, square


def sites(spark, points):
    return spark.createDataFrame(
        [(f"R{i}", *(None if v is None else float(v) for v in p), "A", 1) for i, p in enumerate(points)],
        "Reference string, Longitude double, Latitude double, Zone string, Grid int",
    )


def assigned(spark, segments, points, most_edges=MOST_EDGES):
    got = assign_segments(sites(spark, points), segments, most_edges)
    return [r[1] for r in sorted(tuple(r) for r in got.select("Reference", "bay_segment").collect())]


def test_square_edges_are_half_open(spark):
    one = layer(spark, square(1, 0, 0, 1, 1))
    points = [(0.5, 0.5), (1.5, 0.5), (-0.1, 0.5), (0, 0.5), (1, 0.5), (0.5, 0), (0.5, 1)]
    assert assigned(spark, one, points) == ["OTB", None, None, "OTB", None, "OTB", None]


def test_a_shared_edge_belongs_to_one_side(spark):
    slanted_left = [(1, 1, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (2.0, 0.0), (1.0, 3.0), (0.0, 3.0), (0.0, 0.0)])]
    slanted_right = [(2, 1, i, x, y) for i, (x, y) in enumerate([(4.0, 0.0), (4.0, 3.0), (1.0, 3.0), (2.0, 0.0), (4.0, 0.0)])]
    both = layer(spark, slanted_left, slanted_right)
    on_edge = [(2 - y / 3, y) for y in (0.1, 0.3, 0.75, 1.5, 2.9)]
    assert all(name in ("OTB", "HB") for name in assigned(spark, both, on_edge))
    assert len(assigned(spark, both, on_edge)) == len(on_edge)


@pytest.mark.parametrize("most_edges", [2, 5, 50])
def test_result_does_not_depend_on_the_cells(spark, most_edges):
    concave = [(3, 1, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)])]
    points = [(x / 3 + 0.013, y / 3 + 0.007) for x in range(-1, 14) for y in range(-1, 14)]

    def brute(x, y):
        ring = [(v[3], v[4]) for v in concave]
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hits += 1
        return "MTB" if hits % 2 else None

    got = assign_segments(sites(spark, points), layer(spark, concave), most_edges)
    found = {r["Reference"]: r["bay_segment"] for r in got.collect()}
    assert found == {f"R{i}": brute(*p) for i, p in enumerate(points)}


def test_overlap_gives_a_row_each_and_missing_coordinates_none(spark):
    two = layer(spark, square(1, 0, 0, 2, 2), square(2, 1, 1, 3, 3))
    got = assign_segments(sites(spark, [(1.5, 1.5), (0.5, 0.5), (None, 1.0)]), two, 2)
    assert rows(got, "Reference", "bay_segment") == [("R0", "HB"), ("R0", "OTB"), ("R1", "OTB"), ("R2", None)]


def test_wkt_with_a_hole_and_parts(spark):
    wkt = [
        (1, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"),
        (2, "MULTIPOLYGON (((5 0, 6 0, 6 1, 5 1, 5 0)), ((7.5 0, 8 0, 8 1, 7.5 1, 7.5 0)))"),
    ]
    segments = segments_from_wkt(spark.createDataFrame(wkt, schemas.WKT_LAYER))
    points = [(0.5, 0.5), (2, 2), (5.5, 0.5), (6.5, 0.5), (7.75, 0.5)]
    assert assigned(spark, segments, points) == ["OTB", None, "HB", None, "HB"]


def ring(code, points, ring_no=1):
    return [(code, ring_no, i, float(x), float(y)) for i, (x, y) in enumerate([*points, points[0]])]


def exact_inside(points, x, y):
    """Crossings of a ray to the right, in rational numbers; the point counts as a little to the right of its place, and above it by less."""
    held, x, y = False, Fraction(x), Fraction(y)
    for a, b in zip(points, [*points[1:], points[0]], strict=True):
        (ax, ay), (bx, by) = sorted(((Fraction(u), Fraction(v)) for u, v in (a, b)), key=lambda p: p[1])
        held ^= ay <= y < by and (bx - ax) * (y - ay) > (by - ay) * (x - ax)
    return held


def star(rng, corners, x=0.0, y=0.0, size=1.0):
    """A jagged ring round a place."""
    return [(x + size * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / corners), y + size * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / corners)) for i in range(corners)]


@pytest.mark.parametrize("most_edges", [4, 16])
def test_jagged_rings_against_rational_numbers(spark, most_edges):
    rng = random.Random(most_edges)
    shapes = {code: star(rng, rng.choice([3, 7, 60]), rng.uniform(-3, 3), rng.uniform(-3, 3), rng.uniform(0.2, 3)) for code in range(1, 6)}
    points = [(rng.uniform(-7, 7), rng.uniform(-7, 7)) for _ in range(300)]
    points += [p for shape in shapes.values() for p in shape[:20]]  # the corners themselves
    points += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for shape in shapes.values() for a, b in zip(shape, shape[1:], strict=False)][:60]
    points += [(float(i), float(j)) for i in range(-4, 5) for j in range(-4, 5)] + [(float("nan"), 0.0), (0.0, float("inf")), (None, 1.0)]
    got = assign_segments(sites(spark, points), layer(spark, *[ring(code, shape) for code, shape in shapes.items()]), most_edges)
    names = {code: name for code, name in enumerate(["OTB", "HB", "MTB", "LTB", "Boca Ceiga"], 1)}
    want = []
    for i, (x, y) in enumerate(points):
        held = [names[c] for c, shape in shapes.items() if x is not None and math.isfinite(x) and math.isfinite(y) and exact_inside(shape, x, y)]
        want += [(f"R{i}", name) for name in held or [None]]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select("Reference", "bay_segment").collect())


def test_points_on_a_slanted_edge_have_one_stated_answer(spark):
    """Places whose products round to the edge, on it and beside it by the last bit: right of the edge is inside the right polygon, and so is the edge."""
    low, high = (0.1, 0.3), (0.1 + 3 * 0.7, 0.3 + 3 * 1.1)
    left_ring, right_ring = [low, high, (-9.0, high[1]), (-9.0, low[1])], [low, (9.0, low[1]), (9.0, high[1]), high]
    points = []
    for k in range(1, 60):
        y = low[1] + (high[1] - low[1]) * k / 60
        x = low[0] + (high[0] - low[0]) * k / 60
        points += [(x, y), (math.nextafter(x, 9), y), (math.nextafter(x, -9), y), (x, math.nextafter(y, 9))]
    points += [(0.5, 0.5), (0.25, 0.25)]
    for most_edges in (4, 16):
        got = assigned(spark, layer(spark, ring(1, left_ring), ring(2, right_ring)), points, most_edges)
        by_point = dict(zip(sorted(f"R{i}" for i in range(len(points))), got, strict=True))
        for i, (x, y) in enumerate(points):
            want = "OTB" if exact_inside(left_ring, x, y) else "HB" if exact_inside(right_ring, x, y) else None
            assert by_point[f"R{i}"] == want


def test_the_sign_is_exact(spark):
    rng = random.Random(3)
    rows_ = []
    for _ in range(200):
        ax, ay, bx, by = (rng.uniform(-1, 1) * 2.0 ** rng.randint(-20, 20) for _ in range(4))
        t = rng.random()
        x, y = ax + (bx - ax) * t, ay + (by - ay) * t
        rows_.append((ax, ay, bx, by, x, rng.choice([y, math.nextafter(y, 1e9), math.nextafter(y, -1e9)])))
    rows_.append((0.1, 0.1, 0.3, 0.3, 0.2, 0.2))
    rows_.append((1.0, 1.0, 3.0, 5.0, 2.0, 3.0))
    frame = spark.createDataFrame(rows_, "ax double, ay double, bx double, by double, x double, y double")
    got = frame.select("*", exact_sign("struct(ax, ay, bx, by)", "x", "y").alias("sign")).collect()
    for r in got:
        ax, ay, bx, by, x, y = (Fraction(r[c]) for c in ("ax", "ay", "bx", "by", "x", "y"))
        d = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        assert r["sign"] == (d > 0) - (d < 0)


def lattice(n):
    """n * n squares that share all their sides."""
    return [(1 + (i * n + j) % 7, i * n + j, i, j) for i in range(n) for j in range(n)]


def test_ten_thousand_polygons(spark):
    n = 100
    squares = spark.createDataFrame(
        [(code, [[(float(i + u), float(j + v)) for u, v in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]]) for code, _, i, j in lattice(n)],
        "segment_code int, rings array<array<struct<x:double,y:double>>>",
    ).withColumn("bay_segment", F.concat(F.lit("S"), F.col("segment_code").cast("string")))
    rng = random.Random(5)
    points = [(rng.uniform(-1, n + 1), rng.uniform(-1, n + 1)) for _ in range(2000)] + [(float(i), float(i % 7)) for i in range(0, n + 1)]
    cells = segment_cells(squares)
    got = {r["Reference"]: r["bay_segment"] for r in assign_segments(sites(spark, points), cells).collect()}
    assert len(got) == len(points)
    for i, (x, y) in enumerate(points):
        a, b = math.floor(x), math.floor(y)
        assert got[f"R{i}"] == (f"S{1 + (a * n + b) % 7}" if 0 <= a < n and 0 <= b < n else None)


def test_cells_grow_with_the_boundary_and_full_ones_hold_no_edge(spark):
    """Four times the corners on one outline: about four times the cells, not sixteen times; most of the area is in cells without an edge."""
    sizes = {}
    for corners in (250, 1000):
        outline = [(10 * math.cos(2 * math.pi * i / corners), 10 * math.sin(2 * math.pi * i / corners)) for i in range(corners)]
        leaves = segment_cells(layer(spark, ring(1, outline)), most_edges=4).leaves.where(F.col("level") != OUTSIDE)
        sizes[corners] = leaves.count()
        full = leaves.where("size(candidates) = 1 and size(candidates[0].edges) = 0 and candidates[0].corner")
        area = full.select(F.sum(F.pow(F.lit(32.0) / F.pow(F.lit(2.0), F.col("level")), F.lit(2.0)))).first()[0]
        assert area > (0.75 if corners == 250 else 0.85) * math.pi * 100
        assert leaves.select(F.max(F.aggregate("candidates", F.lit(0), lambda n, c: n + F.size(c["edges"])))).first()[0] <= 4
    assert sizes[1000] < 6 * sizes[250]


def test_a_layer_without_polygons(spark):
    none = spark.createDataFrame([], "bay_segment string, rings array<array<struct<x:double,y:double>>>")
    assert assigned(spark, none, [(0.5, 0.5), (None, 1)]) == [None, None]


def overridden(spark, data, **options):
    frame = spark.createDataFrame(
        data, "Reference string, Longitude double, Latitude double, Zone string, Grid int, bay_segment string"
    )
    return rows(override_segments(frame, **options), "Reference", "bay_segment")


def test_overrides_come_before_the_drop(spark):
    data = [
        ("a", -82.0, 27.5, "A", 363, None),
        ("b", -82.0, 27.5, "A", 203, "Boca Ceiga"),
        ("c", -82.0, 27.5, "A", 220, "OTB"),
        ("d", -82.0, 27.5, "A", 1, None),
        ("e", -82.0, 27.5, "A", 1, "Terra Ceia"),
        ("f", -82.0, 27.5, "A", None, "HB"),
    ]
    assert overridden(spark, data) == [("a", "LTB"), ("b", "MTB"), ("c", "MTB"), ("f", "HB")]


def test_the_conditional_grid_compares_the_chosen_axis(spark):
    data = [("n", -82.5, 27.9, "A", 204, "OTB"), ("s", -82.5, 27.6, "A", 204, "OTB")]
    assert overridden(spark, data) == [("n", "MTB"), ("s", "MTB")]
    assert overridden(spark, data, axis="y") == [("n", "OTB"), ("s", "MTB")]


def test_attach_matches_missing_keys_and_keeps_bare_sites(spark):
    catch = spark.createDataFrame(
        [("a", None, 1, 0.5, "x"), ("a", None, 1, 0.5, "y"), ("b", "Z", None, 0.6, "x"), ("c", "Z", 3, 0.7, "x")],
        "Reference string, Zone string, Grid int, Longitude double, NODCCODE string",
    )
    known = spark.createDataFrame(
        [("a", 0.5, 1.0, None, 1, "OTB"), ("b", 0.6, 1.0, "Z", None, "HB"), ("d", 0.9, 1.0, "Z", 4, "LTB")],
        "Reference string, Longitude double, Latitude double, Zone string, Grid int, bay_segment string",
    )
    got = attach_segments(catch, known)
    assert got.columns == [*catch.columns, "bay_segment"]
    assert rows(got) == rows(
        spark.createDataFrame(
            [
                ("a", None, 1, 0.5, "x", "OTB"),
                ("a", None, 1, 0.5, "y", "OTB"),
                ("b", "Z", None, 0.6, "x", "HB"),
                ("d", "Z", 4, None, None, "LTB"),
            ],
            got.schema,
        )
    )


def test_unknown_axis_is_refused(spark):
    with pytest.raises(KeyError):
        override_segments(spark.range(1).withColumn("Longitude", F.lit(1.0)), axis="z")
