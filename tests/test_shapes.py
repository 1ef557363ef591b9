from __future__ import annotations

import json
import struct

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from terrane.functions import holds, role
from terrane.operators import geometry, maintain, rules, temporal
from terrane.sources import shapes

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
NOTCHED = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]


def test_areas_points_and_clips(spark):
    df = spark.createDataFrame([(1, SQUARE, 1.0, 9.0, 1.0, 3.0), (2, NOTCHED, -1.0, 5.0, 2.0, 9.0), (3, [], 0.0, 1.0, 0.0, 1.0), (4, SQUARE, 5.0, 6.0, 0.0, 1.0)], f"k int, ring {geometry.RING}, a double, b double, c double, d double")
    cut = geometry.clip(df, "ring", "cut", "a", "b", "c", "d")
    got = {r.k: (r.area, round(r.cut, 9)) for r in cut.select("k", geometry.area(F.col("ring")).alias("area"), geometry.area(F.col("cut")).alias("cut")).collect()}
    # the notched one has two triangles above y = 2, each 4/3 wide and 2 high
    assert got == {1: (16.0, 6.0), 2: (10.0, round(8 / 3, 9)), 3: (0.0, 0.0), 4: (16.0, 0.0)}
    points = spark.createDataFrame([(1, 2.0, 3.0), (2, 0.5, 2.0), (3, 9.0, 9.0)], "p int, x double, y double")
    inside = geometry.points_in_rings(points, df.select("k", "ring"), "ring", 1.5).select("k", "p")
    assert sorted(map(tuple, inside.collect())) == [(1, 1), (1, 2), (2, 2), (4, 1), (4, 2)]


def test_densify_and_simplify(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (3.0, 0.0), (3.0, 0.5)],), ([(1.0, 1.0)],), ([],), (None,)], f"line {geometry.RING}")
    got = [None if r[0] is None else [tuple(p) for p in r[0]] for r in df.select(geometry.densify(F.col("line"), 1.0)).collect()]
    assert got == [[(0, 0), (1, 0), (2, 0), (3, 0), (3, 0.5)], [(1, 1)], [], None]
    line = spark.createDataFrame([([(0.0, 0.0), (1.0, 0.1), (2.0, -0.1), (3.0, 5.0), (4.0, 6.0), (5.0, 7.0)],)], f"line {geometry.RING}")
    kept = line.select(geometry.simplifier(0.5)(F.col("line"))).first()[0]
    assert [tuple(p) for p in kept] == [(0, 0), (2, -0.1), (3, 5), (5, 7)]
    keys = spark.createDataFrame([([(1.0, 2.0), (0.001, 0.0)],), ([(0.0, 0.0), (1.0, 2.0)],)], f"line {geometry.RING}").select(geometry.segment_key(geometry.edges(F.col("line"), False)[0])).collect()
    assert {r[0] for r in keys} == {"0.00,0.00,1.00,2.00"}


def test_topojson_stitches_shared_arcs(spark, tmp_path):
    arcs = [[[1, 0], [1, 1]], [[1, 1], [0, 1], [0, 0], [1, 0]], [[1, 0], [2, 0], [2, 1], [1, 1]]]
    geometries = [{"type": "Polygon", "properties": {"n": "left"}, "arcs": [[0, 1]]}, {"type": "MultiPolygon", "properties": {"n": "right"}, "arcs": [[[2, -1]]]}, {"type": "Polygon", "properties": {"n": "line"}, "arcs": [[0]]}]
    doc = {"type": "Topology", "arcs": arcs, "objects": {"units": {"type": "GeometryCollection", "geometries": geometries}}}
    (tmp_path / "plain.json").write_text(json.dumps(doc))
    deltas = [[p if i == 0 else [p[0] - arc[i - 1][0], p[1] - arc[i - 1][1]] for i, p in enumerate(arc)] for arc in arcs]
    (tmp_path / "quantised.json").write_text(json.dumps(doc | {"arcs": deltas, "transform": {"scale": [2, 2], "translate": [10, 0]}}))
    got = {(r.path.rsplit("/", 1)[1], r.n): r.polygons for r in shapes.topojson(spark, str(tmp_path), "units", "n string").collect()}
    assert got["plain.json", "left"] == [[[[1, 0], [1, 1], [0, 1], [0, 0], [1, 0]]]]
    assert got["plain.json", "right"] == [[[[1, 0], [2, 0], [2, 1], [1, 1], [1, 0]]]]
    assert got["quantised.json", "left"] == [[[[12, 0], [12, 2], [10, 2], [10, 0], [12, 0]]]]
    assert len(got) == 4


def _shp(bodies: list[bytes]) -> bytes:
    records = b"".join(struct.pack(">2i", i + 1, len(b) // 2) + b for i, b in enumerate(bodies))
    return struct.pack(">i", 9994) + bytes(20) + struct.pack(">i", (100 + len(records)) // 2) + bytes(72) + records


def test_shapefile(spark, tmp_path):
    ring = [*SQUARE, SQUARE[0]]
    polygon = struct.pack("<i4d2ii", 5, 0, 0, 4, 4, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    (tmp_path / "a.shp").write_bytes(_shp([polygon, struct.pack("<i2d", 1, 7, 8), struct.pack("<i", 0)]))
    field = lambda name, size: name.ljust(11, b"\0") + b"C" + bytes(4) + bytes([size]) + bytes(15)
    rows = b" one 12" + b"*two  3" + "  é  4".encode()
    (tmp_path / "a.dbf").write_bytes(b"\x03" + bytes(3) + struct.pack("<IHH", 3, 97, 7) + bytes(20) + field(b"NAME", 4) + field(b"N", 2) + b"\r" + rows)
    got = shapes.shapefile(spark, str(tmp_path / "*.shp")).orderBy("record")
    assert [(r.record, r.kind, r.attributes) for r in got.collect()] == [(0, 5, {"NAME": "one", "N": "12"}), (2, 0, {"NAME": "é", "N": "4"})]
    assert got.select(geometry.area(shapes.rings_of("parts")[0])).first()[0] == 16.0
    (tmp_path / "b.shp").write_bytes(_shp([polygon]))
    with pytest.raises(PythonException, match="no .dbf"):
        shapes.shapefile(spark, str(tmp_path / "*.shp")).collect()


def test_upserts_members_and_digests(spark):
    old, new = (spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "a"), (2, "b"), (None, "c")], [(2, "x"), (3, "y")]))
    kept = lambda r: sorted(map(tuple, maintain.upsert(old, new, ["k"], r).collect()), key=repr)
    assert kept(True) == [(1, "a"), (2, "x"), (3, "y"), (None, "c")]
    assert kept(False) == [(1, "a"), (2, "b"), (3, "y"), (None, "c")]
    m = spark.createDataFrame([("b|a", "c|a"), (None, "")], "a string, b string")
    both = m.select(maintain.union_members(F.col("a"), F.col("b")), maintain.keep_members(F.col("a"), ["b"])).collect()
    assert [tuple(r) for r in both] == [("a|b|c", "b"), ("", None)]
    files = [("p1", "x"), ("p2", "y"), ("p3", None)]
    digest = lambda rows: maintain.tree_digest(spark.createDataFrame(rows, "p string, d string"), [], "p", "d", "out").first().out
    assert digest(files) == digest(files[::-1]) != digest([*files[:2], ("p3", "z")])


def test_records_by_preference_and_events_by_either_key(spark):
    r = spark.createDataFrame([("a", 1, "1900-01-01", "1910-12-31"), ("a", 2, "1905-01-01", "1920-12-31"), ("b", 3, "1950-01-01", None)], "k string, n int, s string, e string").withColumn("s", F.to_date("s")).withColumn("e", F.to_date("e"))
    got = temporal.preferred(r, "k", "s", "e", "n", ["1906-07-01", "1915-07-01", "1930-07-01"], "n", "v")
    assert sorted((x.k, x.day.year, x.v) for x in got.collect()) == [("a", 1906, 1), ("a", 1915, 2), ("a", 1930, 2), ("b", 1906, 3), ("b", 1915, 3), ("b", 1930, 3)]
    s = spark.createDataFrame([("a", 1, 0), ("a", 2, 5), ("a", 4, 7), ("b", 3, 0)], "k string, t int, v int")
    assert sorted(map(tuple, temporal.floor_then_near(s, "k", "t", "v", 3, "o").collect())) == [("a", 5), ("b", 0)]
    left = spark.createDataFrame([(1, "x", 10), (2, None, 20), (3, "z", None)], "i int, name string, code int")
    events = spark.createDataFrame([(1, "x", 20, "e1"), (2, None, 10, "e2"), (3, "x", None, "e3")], "no int, n string, c int, v string")
    got = rules.last_of_either(left, events, [("name", "n"), ("code", "c")], "no", "v", "o").select("i", "o")
    assert sorted(map(tuple, got.collect())) == [(1, "e3"), (2, "e1"), (3, None)]


def test_roles_and_details(spark):
    df = spark.createDataFrame([("39 40=A;*= B ", ""), ("39=A", "xyz"), (None, None)], "r string, t string")
    got = df.select(role(F.col("r"), "40"), role(F.col("r"), "45"), holds("lacks", "q", F.col("t")), holds("startswith", "xy", F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("A", "B", False, False), (None, None, True, True), (None, None, False, False)]
