"""A small network by hand."""

import functools

from pyspark.sql import functions as F

from chainmark.operators import network as N
from chainmark.operators import scale
from chainmark.plans import standins as S
from chainmark.schemas import EDGES, NODES
from pyspark.sql import types as T

SPECS = [("oh-terminal", 0, 10, "8-port"), ("oh-terminal", 10, None, "16-port")]


def node(node_id, cand, tags, src, demand=1, access=None, size=0, parcel=None, duct=None):
    return (node_id, cand, tags, demand, src, f"in-{node_id}", size, None, None, parcel, access, duct, (0.0, 0.0))


def nodes(spark):
    return spark.createDataFrame([
        node("a", "1", ["ug-closure"], "", 3), node("b", "1", ["oh-closure"], "a", 4), node("c", "1", ["splitter"], "a", 5),
        node("d", "2", ["oh-terminal"], "b", size=12, access="x,y", duct=("g1", None)), node("e", "3", ["splitter"], "d"),
        node("x", "4", ["demand", "ug"], "q", parcel="p1"), node("y", "5", ["demand", "oh"], "d"), node("z", "6", ["demand"], "d"),
    ], NODES)


def test_devices(spark):
    table, ids = N.devices(nodes(spark), SPECS)
    rows = {r["node_id"]: r for r in table.collect()}
    assert {k: r["id"] for k, r in rows.items()} == {"a": "fd-00001", "c": "fd-00002", "d": "fd-00003", "e": "fd-00004", "x": "fd-00005", "y": "fd-00006"}
    assert {r["node_id"]: r["device_id"] for r in ids.collect()}["b"] == "fd-00001"
    a, d, e, x, y = (rows[k] for k in "adexy")
    assert (a["specification"], a["demand"], a["area"]) == ("96-port", 12, "fd-00001")
    assert (d["specification"], d["source"], d["area"], d["duct_group"], d["duct_assignment"]) == ("16-port", "fd-00001", "fd-00001", "g1", "")
    # e hangs on d; d hangs on b, which became the hybrid device
    assert (e["source"], e["area"], e["duct_group"]) == ("fd-00003", "fd-00001", None)
    # x is served by d through the list, y hangs on d itself
    assert [(r["specification"], r["source"], r["area"], r["placement"]) for r in (x, y)] == [("niu", "fd-00003", "fd-00001", "ug"), ("niu", "fd-00003", "fd-00001", "oh")]
    areas = spark.createDataFrame([("p1", 2, [[(9.0, 9.0)]]), ("p1", 1, [[(1.0, 1.0)]])], "parcel_id string, seq int, rings array<array<struct<x:double,y:double>>>")
    parcel = N.parcels(table, areas).collect()
    assert len(parcel) == 1 and parcel[0]["id"] == "p-00001" and tuple(parcel[0]["geometry"][0][0]) == (1.0, 1.0)
    assert "specification" not in parcel[0].asDict() and parcel[0]["source"] == "fd-00003"


def test_edges_and_paths(spark):
    schema = T.StructType([T.StructField("edge_id", T.IntegerType())] + EDGES.fields)
    arcs = [("n2", "n1"), ("n2", "n3")]
    edges = spark.createDataFrame([
        (1, "a", "d", ["lead"], "a", 1, 1.005, None, None, None, None, [(0.0, 0.0)]),
        (2, "a", "nowhere", ["duct"], "a", 5, 2.125, "oh", None, arcs, ("g", "t"), [(0.0, 0.0)]),
        (3, "d", "a", ["ug-dist", "duct"], "b", 5, 7.0, None, "L", [("n1", "n2")], ("g", None), [(0.0, 0.0)]),
        (4, "a", "d", ["oh-drop"], "a", 5, 8.0, None, None, [("n8", "n9")], None, [(0.0, 0.0)]),
        (5, "a", "d", ["duct"], "a", 99, 8.0, None, None, [("n8", "n9")], None, [(0.0, 0.0)]),
    ], schema)
    _, ids = N.devices(nodes(spark), SPECS)
    roles = N.solution_tags([{"SOLUTION_ASSIGN": "lead", "SOLUTION_DUCT": "duct"}, {"SOLUTION_EDGE": "ug-dist, oh-drop", "DEMAND": None}])
    assert roles == {"SOLUTION_ASSIGN": {"lead"}, "SOLUTION_DUCT": {"duct"}, "SOLUTION_EDGE": {"ug-dist", "oh-drop"}}
    tables = N.edge_tables(edges, ids, roles, [("ug-dist", 0, None, "48f")], [("duct", 0, 50, "7-way")])
    assign = tables["assignments"].collect()
    assert [(r["id"], r["start_id"], r["end_id"], r["specification"], r["placement"]) for r in assign] == [("a-00001", "fd-00001", "fd-00003", "leadin", "ug")]
    ducts = {r["edge_id"]: r for r in tables["ducts"].collect()}
    assert sorted(ducts) == [2, 3] and (ducts[2]["end_id"], ducts[2]["length"], ducts[3]["duct_assignment"]) == ("", 2.12, "")
    # edge 3 carries both tags and is in both tables; a cable without a specification stays
    cables = {r["edge_id"]: r for r in tables["cables"].collect()}
    assert {k: r["specification"] for k, r in cables.items()} == {3: "48f", 4: ""} and cables[3]["source"] == "fd-00001"
    assert sorted(r["id"] for r in N.path_from_cables(tables["cables"]).collect()) == ["path-00001", "path-00002"]
    base = spark.createDataFrame([(1, "n2", "n1", ["ug"], 3.0, [(0.0, 0.0)])], "edge_id int, a string, b string, tags array<string>, length double, geometry array<struct<x:double,y:double>>")
    path, lost = N.path_from_arcs(tables["ducts"], tables["cables"], base, add_counts=True)
    row = path.collect()
    assert [(r["a"], r["b"], r["placement"], r["dist_duct_bundle_cnt"], r["dist_duct_cnt"], r["feeder_duct_cnt"], r["oh_cable_cnt"]) for r in row] == [("n1", "n2", "ug", 1, 2, 0, 0)]
    assert [tuple(r) for r in lost.collect()] == [("n2", "n3")]


def test_group_tags(spark):
    rows = {r["cand_id"]: r["tags"] for r in N.group_tags(nodes(spark)).collect()}
    assert rows["1"] == ["oh-closure", "splitter", "ug-closure"]
    assert N.colocated_groups(nodes(spark)).where(F.col("is_hybrid")).first()["group_demand"] == 12


def test_lookups_in_a_row_read_their_rows_once(spark, sf_dir, monkeypatch):
    """Beyond the broadcast limit the lookups of sources and areas do not work the lookups before them out again."""
    plain = N.devices(S.nodes(spark, sf_dir), S.HUB_SPECS)[0].collect()
    joins = {}

    def counted(df):
        if "_ways" in df.columns:
            joins[df.columns[0]] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return checkpointed(df)

    checkpointed = scale.checkpointed
    monkeypatch.setattr(scale, "checkpointed", counted)
    monkeypatch.setattr(N, "BROADCAST_BYTES", 0, raising=False)
    monkeypatch.setattr(N, "lookup_join", functools.partial(scale.lookup_join, limit_bytes=0))
    shuffled = N.devices(S.nodes(spark, sf_dir), S.HUB_SPECS)[0].collect()
    assert sorted(map(repr, shuffled)) == sorted(map(repr, plain))
    assert {"_self", "_source", "_second"} <= set(joins)
    assert max(joins[c] for c in ("_self", "_source", "_second")) <= 1
