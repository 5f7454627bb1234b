"""Ring stitching and polygon assembly on small relations."""

import pandas as pd

from plotwise.operators import osm


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def frame(*ways):
    return pd.DataFrame([(1, role, [{"lon": x, "lat": y} for x, y in pts]) for role, pts in ways], columns=["relation_id", "role", "pts"])


def test_open_ways_are_joined_whatever_their_direction():
    ring = square(0, 0, 4)
    rings, left = osm._stitch([ring[:3], ring[2:][::-1]])
    assert len(rings) == 1 and not left and rings[0][0] == rings[0][-1] and set(rings[0]) == set(ring)


def test_unclosed_lines_are_rows():
    out = osm._assemble(frame(("outer", square(0, 0, 4)), ("outer", [(9.0, 9.0), (10.0, 9.0), (10.0, 10.0)])))
    assert list(out["role"]) == ["outer", "unclosed outer"] and out["area"].iloc[0] == 16 and pd.isna(out["area"].iloc[1])


def test_a_hole_belongs_to_one_outer_ring():
    # two nested outer rings: the hole in both goes to the first; one across the border to none
    out = osm._assemble(frame(("outer", square(0, 0, 10)), ("outer", square(1, 1, 8)), ("inner", square(2, 2, 1)), ("inner", square(9, 9, 3))))
    assert list(zip(out["polygon_no"], out["role"])) == [(0, "outer"), (0, "inner"), (1, "outer"), (-1, "stray inner")]


def test_many_ways_in_linear_time():
    n = 40_000
    pts = [(float(i), 0.0) for i in range(n)] + [(float(n), 1.0), (0.0, 1.0), (0.0, 0.0)]
    rings, left = osm._stitch([list(p) for p in zip(pts, pts[1:])][::-1])
    assert len(rings) == 1 and not left


XML = """<osm><node id="1" lat="3.0" lon="101.0"/><node id="2" lat="3.0" lon="101.4"/><node id="3" lat="3.4" lon="101.4"/>
<way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/></way><way id="11"><nd ref="3"/><nd ref="1"/></way>
<relation id="7"><member type="way" ref="10" role="outer"/><member type="way" ref="11" role="outer"/><member type="node" ref="1" role="label"/>
<tag k="name" v="Triangle"/></relation></osm>"""
JSON = '{"type": "relation", "id": 7, "members": [{"type": "way", "ref": 10, "role": "outer"}, {"type": "way", "ref": 11, "role": "outer"}, {"type": "node", "ref": 1, "role": "label"}], "tags": {"name": "Triangle"}}'


def test_relations_from_xml_and_json_into_polygons(spark, tmp_path):
    from plotwise.operators.geocode import way_lines
    from plotwise.sources import files
    (tmp_path / "x.osm").write_text(XML)
    (tmp_path / "x.jsonl").write_text(JSON)
    members, tags = files.scan_osm_relations(spark, str(tmp_path / "x.osm"))
    again, _ = files.scan_osm_relations(spark, str(tmp_path / "x.jsonl"), "json")
    rows = [(7, 0, "way", 10, "outer"), (7, 1, "way", 11, "outer"), (7, 2, "node", 1, "label")]
    assert sorted(map(tuple, members.collect())) == rows == sorted(map(tuple, again.collect()))
    assert tags.first()["tags"] == {"name": "Triangle"}
    nodes, way_nodes, _ = files.scan_osm_xml(spark, str(tmp_path / "x.osm"))
    out = osm.polygon_assembly(osm.member_ways(members, way_lines(way_nodes, nodes))).collect()
    assert len(out) == 1 and out[0]["role"] == "outer" and abs(out[0]["area"] - 0.08) < 1e-9
