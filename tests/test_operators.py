from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrane.functions import camel_split, fuzzy_date, normal_name, slug, zigzag
from terrane.operators import allocate, encode, graph, rules, spatial, temporal


def one(df):
    return df.collect()


def test_rule_patterns(spark):
    names = spark.createDataFrame([("USSR (Soviet Union)",), ("poland",), ("Poland",), (None,)], "n string")
    got = one(names.select(rules.glob(F.col("n"), "Poland|USSR*").alias("a"), rules.glob(F.col("n"), "*").alias("b"), rules.prefix_or_equal(F.col("n"), "Pol*").alias("c")))
    assert [(r.a, r.b, r.c) for r in got] == [(True, True, False), (False, True, False), (True, True, True), (False, True, False)]


def test_layered_veto_equals_the_loop(spark):
    import itertools

    flags = [(i, *bits, over) for i, (*bits, over) in enumerate(itertools.product([True, False], repeat=5))]
    df = spark.createDataFrame(flags, "i int, a boolean, b boolean, c boolean, d boolean, over boolean")
    kinds = {"a": True, "b": False, "c": True, "d": False}
    compiled = rules.layered([(F.col(k), F.lit(k), w) for k, w in kinds.items()], F.lit("base"), F.when(F.col("over"), F.lit("overlay")))
    for r in one(df.withColumn("x", compiled)):
        now, source = ("overlay", "overlay") if r.over else ("base", "base")
        for k, whole in kinds.items():
            if r[k] and not (whole and source == "overlay"):
                now, source = k, "rule"
        assert r.x == now


@pytest.mark.parametrize(("rows", "total", "want"), [([(1.0, 1.0)] * 3, 100, [33, 33, 34]), ([(0.0, 1.0), (0.0, 3.0)], 8, [2, 6])])
def test_largest_remainder(spark, rows, total, want):
    df = spark.createDataFrame([(1, i, w, a, total) for i, (w, a) in enumerate(rows)], "g int, i int, w double, area double, total int")
    got = [r.n for r in one(allocate.largest_remainder(df, ["g"], "w", "total", ["i"], "n", "area").orderBy("i"))]
    assert sorted(got) == want
    assert sum(got) == total


def test_calibration_conserves_and_spreads(spark):
    cells = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0), ("b", 0.0), ("c", 5.0)], "k string, v double")
    targets = spark.createDataFrame([("a", 8.0), ("b", 10.0)], "k string, t double")
    got = sorted((r.k, r.out) for r in one(allocate.calibrate(cells, targets, "k", "v", "t", "out")))
    assert got == [("a", 2.0), ("a", 6.0), ("b", 5.0), ("b", 5.0), ("c", 5.0)]


def test_validity_and_nearest(spark):
    d = lambda s: dt.date.fromisoformat(s)
    spans = spark.createDataFrame([("x", d("1905-09-05"), None), ("y", None, d("1905-09-04"))], "n string, s date, e date")
    on = lambda day: [r.n for r in one(spans.where(temporal.in_force(F.lit(day).cast("date"), F.col("s"), F.col("e"))))]
    assert on("1905-09-04") == ["y"]
    assert on("1905-09-05") == ["x"]
    right = spark.createDataFrame([(1, 1995, "a"), (1, 1997, "b")], "k int, y int, v string")
    left = spark.createDataFrame([(1, 1996), (1, 2000), (2, 1996)], "k int, at int")
    assert [(r.k, r["at"], r.v2) for r in one(temporal.nearest(left, right, "k", "at", "y", "v", "v2").orderBy("k", "at"))] == [(1, 1996, "a"), (1, 2000, "b"), (2, 1996, None)]


def test_bracket_fill(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, 2.0), (1, 2, None), (1, 3, 8.0), (1, 4, None)], "k int, t int, v double")
    assert [r.f for r in one(temporal.bracket_fill(df, ["k"], "t", "v", "f").orderBy("t"))] == [2.0, 2.0, 5.0, 8.0, 8.0]
    assert [round(r.f, 9) for r in one(temporal.bracket_fill(df, ["k"], "t", "v", "f", log=True).orderBy("t"))][2] == 4.0


def test_codec_round_trip_and_errors(spark):
    values = [[], [5], [-1, 1 << 40, 3, 3], None]
    df = spark.createDataFrame([(v,) for v in values], "v array<long>")
    assert [r.d for r in one(df.select(encode.decode_deltas(encode.encode_deltas("v")).alias("d")))] == values
    with pytest.raises(ValueError, match="truncated"):
        encode.unvarint(encode.varint([300])[:1])
    with pytest.raises(ValueError, match="long"):
        encode.unvarint(b"\xff" * 11)


def test_dictionary_is_first_seen(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2), (None, 3)], "v string, i int")
    assert [(r.v, r.code) for r in one(encode.dictionary(df, "v", "i").orderBy("code"))] == [("a", 0), ("b", 1)]


def test_text_functions(spark):
    df = spark.createDataFrame([("Sao Paulo -- X",), ("中文",)], "s string")
    got = [r[0] for r in one(df.select(slug(F.col("s"))))]
    assert got[0] == "sao-paulo-x"
    assert len(got[1]) == 8
    row = one(spark.createDataFrame([("NewYork", "Île-de-France", "~1897", "1900-02", -3)], "a string, b string, c string, d string, n long").select(camel_split(F.col("a")), normal_name("b"), fuzzy_date(F.col("c")), fuzzy_date(F.col("d"), True), zigzag(F.col("n"))))[0]
    assert tuple(row) == ("New York", "iledefrance", dt.date(1897, 1, 1), dt.date(1900, 2, 28), 5)


def test_cells_and_graph(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.5, 0.0), (3, 5.0, 5.0)], "k int, x double, y double")
    assert [(r.a, r.b) for r in one(spatial.pairs_within(points, "k", "x", "y", 1.0))] == [(1, 2)]
    edges = spark.createDataFrame([(3, 2), (2, 1), (9, 8)], "src int, dst int")
    assert sorted((r.node, r.label) for r in one(graph.components(edges))) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert sorted((r.node, r.n_hops) for r in one(graph.hops(edges, spark.createDataFrame([(3,)], "n int")))) == [(1, 2), (2, 1), (3, 0)]


def test_nearest_sites_end_on_odd_coordinates(spark):
    """NaN, infinite and null coordinates are left out, and the rounds end."""
    from terrane.operators import spatial

    points = spark.createDataFrame([(1, 0.0, 0.0), (2, float("nan"), 1.0), (3, None, 2.0), (4, float("inf"), 0.0), (5, 900.0, 900.0)], "pid long, x double, y double")
    sites = spark.createDataFrame([(1, 1.0, 0.0), (2, 800.0, 900.0), (3, float("nan"), 0.0)], "sid long, x double, y double")
    got = {r.pid: (r.sid, r.dist) for r in spatial.nearest_site(points, sites, 0.5).collect()}
    assert got == {1: (1, 1.0), 5: (2, 100.0)}


def test_hops_have_no_limit(spark):
    from terrane.operators import graph

    edges = spark.createDataFrame([(i, i + 1) for i in range(130)] + [(500, 501)], "src int, dst int").coalesce(1)
    got = {r.node: r.n_hops for r in graph.hops(edges, spark.createDataFrame([(0,)], "node int")).collect()}
    assert got == {i: i for i in range(131)}


def test_manifest_diff_of_null_digests(spark):
    from terrane.operators import encode

    old = spark.createDataFrame([("a", None), ("b", None), ("c", "1"), ("d", "1")], "path string, digest string")
    new = spark.createDataFrame([("a", None), ("b", "2"), ("c", None), ("e", None)], "path string, digest string")
    got = {r.path: r.state for r in encode.manifest_diff(old, new, "path", "digest").collect()}
    assert got == {"b": "differs", "c": "differs", "d": "missing", "e": "extra"}


def test_allocation_without_weight(spark):
    """All weights zero: the fallback, and equal weights where that is zero too."""
    from terrane.operators import allocate

    rows = [("a", i, 0.0, f, 8) for i, f in ((1, 1.0), (2, 3.0))] + [("b", i, 0.0, 0.0, 5) for i in (1, 2, 3)] + [("c", 1, None, None, 4)]
    df = spark.createDataFrame(rows, "g string, i int, w double, area double, total int")
    got = {(r.g, r.i): r.n for r in allocate.largest_remainder(df, ["g"], "w", "total", ["i"], "n", fallback="area").collect()}
    assert got == {("a", 1): 2, ("a", 2): 6, ("b", 1): 2, ("b", 2): 2, ("b", 3): 1, ("c", 1): 4}
    plain = {(r.g, r.i): r.n for r in allocate.largest_remainder(df, ["g"], "w", "total", ["i"], "n").collect()}
    assert plain["a", 1] == plain["a", 2] == 4


def test_drawn_areas_in_rules_and_tables(spark):
    from pyspark.sql import functions as F

    from terrane.operators import rule_tables, rules

    points = spark.createDataFrame([(0, 5.0, 5.0), (1, 1.0, 8.0), (2, 15.0, 5.0), (3, 30.2, 50.0), (4, None, 1.0)], "k int, x double, y double")
    area = "poly:0 0;10 0;5 10|box:14,4,16,6|circle:30,50,30"
    direct = {r.k for r in points.where(rules.geo(area, F.col("x"), F.col("y"))).collect()}
    kept = {r.k for r in points.withColumn("a", F.lit(area)).where(rule_tables.in_area(F.col("a"), F.col("x"), F.col("y"))).collect()}
    assert direct == kept == {0, 2, 3}


def test_member_lists_refuse_unknown_names(spark):
    import pytest

    from terrane.operators import rule_tables

    units = spark.createDataFrame([(1, "AAA", "P", "one"), (2, "AAA", "Q", "two"), (3, "BBB", "P", "one")], "unit_id int, iso3 string, parent string, name string")
    rows = "row_no int, iso3 string, name string, members string, start string, stop string"
    good = spark.createDataFrame([(1, "AAA", "x", "AAA/P:*;BBB:one", "1900", None), (2, "AAA", "*", "", "1910", "1920"), (3, "BBB", "y", "BBB:*;-one", None, None)], rows)
    got = {(r.row_no, r.unit_id) for r in rule_tables.members(good, units).collect()}
    assert got == {(1, 1), (1, 3), (2, 2)}
    with pytest.raises(Exception, match="unknown member"):
        rule_tables.members(spark.createDataFrame([(1, "AAA", "x", "three", None, None)], rows), units).collect()


def test_clusters_respect_their_units(spark):
    """Against a plain single linkage over all pairs, nearest first."""
    import math
    import random

    from terrane.operators import records

    r = random.Random(5)
    pts = [(r.choice("ab"), i, r.random() * 6, r.random() * 6, r.choice([None, None, 1, 2, 3])) for i in range(120)]
    df = spark.createDataFrame(pts, "name string, pid long, x double, y double, unit int")
    got = {x.pid: x.cluster for x in records.constrained_clusters(df, "name", 0.7).collect()}
    parent, sets = {p[1]: p[1] for p in pts}, {p[1]: set() if p[4] is None else {p[4]} for p in pts}
    find = lambda i: i if parent[i] == i else find(parent[i])
    pairs = sorted((math.hypot(a[2] - b[2], a[3] - b[3]), a[1], b[1]) for a in pts for b in pts if a[0] == b[0] and a[1] < b[1])
    for d, i, j in pairs:
        a, b = sorted((find(i), find(j)))
        if d <= 0.7 and a != b and not (sets[a] and sets[b] and not sets[a] & sets[b]):
            parent[b] = a
            sets[a] |= sets[b]
    assert got == {i: find(i) for i in parent}


def test_outline_streams_and_dictionaries(spark):
    import pytest

    from terrane.sources import store

    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    tiny = [(5.0, 5.0), (5.0001, 5.0), (5.0, 5.0001)]
    raw = store._stream(store._quantised([[square, [(0.2, 0.2), (0.4, 0.2), (0.2, 0.4)]]], 0.01)) + store._stream(store._quantised([[tiny]], 0.01))
    units = list(store.decode_stream(raw))
    assert [u[0] for u in units] == [0, 1]
    assert units[-1][1] == len(raw)
    assert [len(p) for p in units[0][2]] == [2]
    assert len(units[1][2][0][0]) == 3  # a tiny unit stays, as a triangle
    for bad in (raw[:-1], b"\x01\x01\x01" + b"\xff" * 11):
        with pytest.raises(ValueError):
            list(store.decode_stream(bad))
    base = spark.createDataFrame([(0, "a"), (1, None), (2, "b")], "n long, value string")
    mark = store.Appended.record(base)
    grown = store.Appended.append(base, spark.createDataFrame([("c",), ("a",)], "value string"))
    assert store.Appended.strip(grown, mark).count() == 3
    with pytest.raises(ValueError, match="changed"):
        store.Appended.strip(grown.na.fill("x"), mark)


def test_components_keep_kinds_apart(spark, tmp_path):
    """A part whose number is that of a price class is another node."""
    from terrane.plans import registry

    parts = [(7, 30.0), (1000001, 50.0), (1000002, 30.0)]
    spark.createDataFrame(parts, "p_partkey long, p_retailprice double").write.parquet(f"file://{tmp_path}/part.parquet")
    got = sorted((r.node, r.label) for r in registry.queries()["connected_components"](spark, f"file://{tmp_path}").collect())
    assert got == [(7, 7), (1000001, 7), (1000001, 1000001), (1000002, 7), (1000002, 1000001)]


def test_pairs_at_the_radius(spark):
    """Squares are compared with that of the radius as written, 0.16, to which 0.4 * 0.4 isn't equal. Groups meet inside themselves."""
    rows = [(1, "a", 0.0, 0.0), (2, "a", 0.4, 0.0), (3, "a", 0.0, 5.0), (4, "a", 0.375, 5.0), (5, "b", 0.375, 5.0)]
    points = spark.createDataFrame(rows, "k int, name string, x double, y double")
    assert {(r.a, r.b) for r in one(spatial.pairs_within(points, "k", "x", "y", 0.4))} == {(3, 4), (3, 5), (4, 5)}
    assert {(r.a, r.b, r.dist) for r in one(spatial.pairs_within(points, "k", "x", "y", 0.4, "name"))} == {(3, 4, 0.375)}


def test_nearest_named_of_equally_near_places(spark):
    """Distances are roots of sums of squares, by which the smaller id is as near here; hypot finds the other one nearer."""
    from terrane.operators import records

    points = spark.createDataFrame([(1795, "n", 0.95, 1.7)], "pid long, name string, x double, y double")
    places = spark.createDataFrame([(2001796, "n", 0.9600000000000023, 1.5), (6011794, "n", 0.9399999999999977, 1.9)], "place_id long, name string, x double, y double")
    assert [r.place_id for r in records.nearest_named(points, places, "name", 1.5).collect()] == [2001796]


def test_points_per_box_of_equal_ones(spark):
    """100,000 equal points in 100,000 equal boxes: counted, not spelled out as pairs."""
    points = spark.range(100000).select(F.lit(1.5).alias("x"), F.lit(2.0).alias("y")).unionByName(spark.createDataFrame([(9.0, 9.0), (None, 1.0)], "x double, y double"))
    boxes = spark.range(100000).select("id", F.lit(1.0).alias("x1"), F.lit(1.0).alias("y1"), F.lit(2.0).alias("x2"), F.lit(2.0).alias("y2"))
    boxes = boxes.unionByName(spark.createDataFrame([(0, 8.0, 8.0, 9.0, 9.0), (-1, 3.0, 3.0, 4.0, 4.0)], boxes.schema))
    got = {r.id: r.n for r in spatial.points_per_box(points, boxes, "id", "x", "y", 4.0).collect()}
    assert got == {i: 100000 + (i == 0) for i in range(100000)}


def test_adjacency_tells_pairs_once(spark):
    """Keys of equal, overlapping and touching cells against all pairs; no pair is made twice and taken out again."""
    cells = [(k, g, h) for k in range(60) for g in range(k % 5, k % 5 + 1 + k % 3) for h in range(k % 4, k % 4 + 2)]
    df = spark.createDataFrame([(g, h, k) for k, g, h in cells] + [(1, 1, None), (1, 1, 6)], "gx long, gy long, k long")
    done = spatial.adjacency(df, "k")
    of = {k: {(g, h) for j, g, h in cells if j == k} for k in range(60)}
    of[6].add((1, 1))
    assert sorted((r.a, r.b) for r in done.collect()) == sorted((a, b) for a in of for b in of if a < b and of[a] & of[b])
    assert done._jdf.queryExecution().optimizedPlan().toString().startswith("Project")


def test_overlap_totals_of_equal_boxes(spark):
    """100,000 equal boxes a side: counted, not spelled out as pairs; touching boxes and boxes over several cells count once."""
    box = [F.lit(v).alias(c) for c, v in (("x1", 1.0), ("y1", 1.0), ("x2", 9.0), ("y2", 9.0))]
    left = spark.range(100000).select(F.col("id").alias("a"), *box)
    right = spark.range(100000).select(F.col("id").alias("b"), *box).unionByName(spark.createDataFrame([(-7, 9.0, 9.0, 9.0, 9.0), (-8, 9.5, 9.0, 9.5, 9.0)], "b long, x1 double, y1 double, x2 double, y2 double"))
    got = spatial.overlap_totals(left, right, 4.0).groupBy("n", "keys").count().collect()
    assert [tuple(r) for r in got] == [(100001, sum(range(100000)) - 7, 100000)]


def test_outline_streams_in_batches(spark):
    """Streams of many rows and an outline of many points come back whole; no outline gives no points."""
    from terrane.sources import store

    ring = lambda n, k: [[float(i), float(k + (i % 2) * 0.5 + (i == n - 1))] for i in range(n)]
    rows = [(k, None if k % 10 == 3 else [[ring(30000 if k == 5 else 4, k)]]) for k in range(40)]
    df = spark.createDataFrame(rows, "k int, units array<array<array<array<double>>>>").coalesce(1)
    got = {(r.k, r.part, r.ring, r.point): (r.x, r.y) for r in store.decode_outlines(df.select("k", store.encode_outlines(0.01)("units").alias("data")), "k", "data").collect()}
    assert got == {(k, 0, 0, i): tuple(p) for k, u in rows if u for i, p in enumerate(u[0][0])}


def test_clusters_hold_few_pairs(spark, monkeypatch):
    """With at most 50 pairs at once, and many equal places and distances, clusters equal a plain single linkage."""
    import random

    import numpy as np

    from terrane.operators import records

    monkeypatch.setattr(records, "MOST_PAIRS", 50)
    r = random.Random(4)
    x, y = (np.array([r.randint(0, 12) / 10 for _ in range(120)]) for _ in "xy")
    unit = np.array([r.choice([-1, -1, 0, 1, 2]) for _ in range(120)])
    parent, sets = list(range(120)), [set() if u < 0 else {u} for u in unit]
    find = lambda i: i if parent[i] == i else find(parent[i])
    for d, i, j in sorted((float(np.hypot(x[i] - x[j], y[i] - y[j])), i, j) for i in range(120) for j in range(i + 1, 120)):
        a, b = sorted((find(i), find(j)))
        if d <= 0.3 and a != b and not (sets[a] and sets[b] and not sets[a] & sets[b]):
            parent[b] = a
            sets[a] |= sets[b]
    assert records._linked(x, y, unit, 0.3).tolist() == [find(i) for i in range(120)]


def test_nearest_named_in_crowds(spark, monkeypatch):
    """Crowds of near places, equal ones, and points far from all of them, against all pairs; cells are first as
    narrow as the crowd asks for."""
    import math
    import random

    from terrane.operators import records

    r = random.Random(6)
    spot = lambda k: (r.choice("ab"), k % 3 + r.randint(0, 400) / 2000, r.randint(0, 400) / 2000)
    points = [(i, *spot(i)) for i in range(1500)] + [(9001, "a", 1.2, 1.1), (9002, "b", 9.0, 9.0), (9003, None, 0.0, 0.0), (9004, "a", None, 0.0)]
    places = [(-i, *spot(i)) for i in range(1500)] + [(-5000, "a", None, 1.0)]
    want = {}
    for i, name, x, y in points:
        found = [(math.sqrt((x - u) * (x - u) + (y - v) * (y - v)), k) for k, n, u, v in places if n == name and x is not None and u is not None]
        found = [f for f in found if f[0] < 1.5]
        if found:
            want[i] = min(found)
    p = spark.createDataFrame(points, "pid long, name string, x double, y double")
    q = spark.createDataFrame(places, "place_id long, name string, x double, y double")
    widths, cell = [], records.cell
    monkeypatch.setattr(records, "cell", lambda x, y, size: widths.append(size) or cell(x, y, size))
    assert {x.pid: (x.dist, x.place_id) for x in records.nearest_named(p, q, "name", 1.5).collect()} == want
    assert widths[13] < 0.1 and 1.5 < widths[-1] < 1.6  # after the 13 widths that are counted


def test_pairs_of_a_group_carry_its_name(spark):
    """Points are neither broadcast nor joined again to their names, whatever Spark takes for small."""
    from terrane.plans import registry

    plan = registry.queries()["nearest_pairs_first"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert plan.count("SortMergeJoin") == 1
