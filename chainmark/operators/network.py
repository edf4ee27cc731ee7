"""Flat export tables of a network solution: devices, parcels, assignments, ducts, cables and path.

References between rows are resolved over the whole table, so they do not depend on row order. Ids follow
``node_id`` for devices and (start, end, geometry) order given by ``edge_id`` for edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.constants import ASSIGNMENT_SPEC, DEMAND_SPEC, HYBRID_SPEC, HYBRID_TAGS, ID_PREFIXES
from chainmark.functions.columns import half_even, has_all, has_any, or_default, pair
from chainmark.operators.scale import BROADCAST_BYTES, lookup_join, measured_bytes, numbered, padded_id, shuffled
from chainmark.session import checkpointed


def solution_tags(solve_configs: Sequence[Mapping]) -> dict[str, set[str]]:
    """Tags per role over all solve configurations; DEMAND may be comma text."""
    roles: dict[str, set[str]] = {}
    for config in solve_configs:
        for role, tags in config.items():
            for tag in (tags.split(",") if isinstance(tags, str) else tags or []):
                if tag.strip():
                    roles.setdefault(role, set()).add(tag.strip())
    return roles


def spec_of(tags: Column, size: Column, specs: Sequence[tuple[str, int, int | None, str]]) -> Column:
    """Specification by tag and size range ``min <= size < max``; the first tag by name wins, else empty.

    ``specs`` is the configured list of (tag, min size, max size or None, specification).
    """
    out, amount = None, F.coalesce(size, F.lit(0))
    for tag, low, high, name in sorted(specs, key=lambda s: (s[0], s[1])):
        hit = F.array_contains(tags, tag) & (amount >= low)
        if high is not None:
            hit = hit & (amount < high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit("") if out is None else out.otherwise("")


def colocated_groups(nodes: DataFrame) -> DataFrame:
    """Nodes at one candidate place: how many, their demand, and whether they form a hybrid device."""
    tag_seen = [F.max(F.array_contains("tags", t)).alias(f"_has_{i}") for i, t in enumerate(HYBRID_TAGS)]
    grouped = nodes.groupBy("cand_id").agg(
        F.count(F.lit(1)).alias("node_count"), F.sum("demand").alias("group_demand"), *tag_seen)
    both = F.col("node_count") > 1
    for i in range(len(HYBRID_TAGS)):
        both = both & F.coalesce(F.col(f"_has_{i}"), F.lit(False))
    return grouped.withColumn("is_hybrid", both).drop(*[f"_has_{i}" for i in range(len(HYBRID_TAGS))])


def group_tags(nodes: DataFrame) -> DataFrame:
    """All tags at a candidate place, distinct and sorted; pairs are made distinct before grouping."""
    return (
        nodes.select("cand_id", F.explode("tags").alias("tag")).distinct()
        .groupBy("cand_id").agg(F.array_sort(F.collect_list("tag")).alias("tags"))
    )


def hybrid_members(nodes: DataFrame) -> DataFrame:
    """Every node with ``hybrid`` (member of a hybrid device) and ``leader`` (node whose row it becomes)."""
    groups = colocated_groups(nodes).where("is_hybrid")
    member = has_any(F.col("tags"), HYBRID_TAGS)
    leaders = (
        nodes.where(member & ~has_any(F.col("tags"), ["demand"])).groupBy("cand_id").agg(F.min("node_id").alias("_leader"))
    )
    hybrids = groups.select("cand_id", "group_demand").join(shuffled(leaders), "cand_id")
    joined = lookup_join(nodes, hybrids, ["cand_id"])
    hybrid = F.col("_leader").isNotNull() & member & ~has_any(F.col("tags"), ["demand"])
    return joined.withColumn("hybrid", hybrid).withColumn(
        "leader", F.when(hybrid, F.col("_leader")).otherwise(F.col("node_id"))).drop("_leader")


def served_by(nodes: DataFrame) -> DataFrame:
    """Demand node to the node that serves it, from the comma list; the last serving node by id wins."""
    return (
        nodes.where(F.col("access_demand_ids").isNotNull() & (F.col("access_demand_ids") != ""))
        .select(F.explode(F.split("access_demand_ids", ",")).alias("demand_node_id"), "node_id")
        .groupBy("demand_node_id").agg(F.max("node_id").alias("serving_node_id"))
    )


def _duct(out: dict[str, Column], always: bool = False) -> dict[str, Column]:
    info = F.col("duct_info")
    for name, field in (("duct_group", "group_id"), ("duct_assignment", "tube_ids")):
        value = or_default(info[field], "")
        out[name] = value if always else F.when(info.isNotNull(), value)
    return out


def devices(nodes: DataFrame, specs: Sequence[tuple[str, int, int | None, str]]) -> tuple[DataFrame, DataFrame]:
    """The device table, and the map (node_id, device_id) that other tables refer by.

    Devices of non-demand nodes are numbered first, demand devices after them.
    """
    marked = hybrid_members(nodes)
    tags = F.col("tags")
    is_demand = has_any(tags, ["demand"])
    kind = (
        F.when(~is_demand & (F.col("leader") == F.col("node_id")), 0)
        .when(has_all(tags, ["demand", "ug"]), 1).when(has_all(tags, ["demand", "oh"]), 2)
    )
    rows = numbered(marked.withColumn("kind", kind).where("kind is not null").withColumn("stage", F.least("kind", F.lit(1))),
                    ["stage", "node_id"], "number")
    rows = rows.withColumn("device_id", padded_id(ID_PREFIXES["devices"], F.col("number")))
    ids = rows.select("node_id", "device_id")
    followers = marked.where(F.col("hybrid") & (F.col("leader") != F.col("node_id"))).select("node_id", F.col("leader").alias("_leader"))
    ids = ids.unionByName(
        lookup_join(followers, ids.withColumnRenamed("node_id", "_leader"), ["_leader"], how="inner").select("node_id", "device_id"))

    # A demand node's source is the node serving it; any other placed node's source is its own ``src``.
    placed = rows.where("kind = 0")
    own = placed.select(F.col("node_id").alias("_child"), F.col("src").alias("_parent"), F.lit(0).alias("_rank"))
    served = served_by(placed).select(F.col("demand_node_id").alias("_child"), F.col("serving_node_id").alias("_parent"), F.lit(1).alias("_rank"))
    parents = checkpointed(own.unionByName(served).groupBy("_child").agg(F.min_by("_parent", "_rank").alias("_parent")))
    ids = checkpointed(ids)
    parent_bytes, id_bytes = measured_bytes(parents), measured_bytes(ids)

    def parent_of(df: DataFrame, child: str, out: str) -> DataFrame:
        return lookup_join(df, parents.select(F.col("_child").alias(child), F.col("_parent").alias(out)), [child], dim_bytes=parent_bytes)

    def id_of(df: DataFrame, node: str, out: str) -> DataFrame:
        return lookup_join(df, ids.select(F.col("node_id").alias(node), F.col("device_id").alias(out)), [node], dim_bytes=id_bytes)

    def once(df: DataFrame, dim_bytes: int) -> DataFrame:
        """A join beyond the broadcast limit reads its large side twice, so in a row of joins each is written once."""
        return checkpointed(df) if dim_bytes > BROADCAST_BYTES else df

    # The four lookups move only what they need; a row's number is its own.
    links = parent_of(rows.select("number", "kind", "src", F.col("node_id").alias("_self")), "_self", "_served")
    links = links.withColumn("_source", F.when(F.col("kind") == 1, F.col("_served")).otherwise(F.col("src"))).drop("_self", "_served", "src")
    links = parent_of(once(links, parent_bytes), "_source", "_second")
    links = links.withColumn("_second", F.when(F.col("kind") == 0, F.coalesce("_second", "_source")).otherwise(F.col("_second"))).drop("kind")
    links = id_of(once(links, max(parent_bytes, id_bytes)), "_source", "_source_id")
    links = id_of(once(links, id_bytes), "_second", "_second_id")
    full = rows.join(shuffled(links), "number")
    plain = F.col("kind") == 0
    source = F.when(plain, F.coalesce("_source_id", "_source")).otherwise(or_default(F.col("_source_id"), ""))
    beyond = F.when(plain, F.coalesce("_second_id", "_second")).otherwise(or_default(F.col("_second_id"), ""))
    area = (
        F.when(plain & has_any(tags, HYBRID_TAGS), F.col("device_id"))
        .when(plain & has_any(tags, ["oh-terminal", "oh-joint", "access-pt"]), source).otherwise(beyond)
    )
    out = {
        "id": F.col("device_id"), "node_id": F.col("node_id"), "input_id": F.col("input_id"),
        "specification": F.when(~plain, DEMAND_SPEC).when(F.col("hybrid"), HYBRID_SPEC).otherwise(spec_of(tags, F.col("size"), specs)),
        "source": source, "area": area,
        "demand": F.when(plain & F.col("hybrid"), F.col("group_demand")).otherwise(F.col("demand")),
        "placement": F.when(F.col("kind") == 1, "ug").when(F.col("kind") == 2, "oh").otherwise(or_default(F.col("placement"), "")),
        "geometry": F.col("geometry"), "leg": or_default(F.col("leg"), ""),
    }
    table = full.select(*[c.alias(n) for n, c in _duct(out).items()], F.col("kind").alias("kind"), "number", "parcel_id")
    return table, ids


def parcels(device_table: DataFrame, areas: DataFrame) -> DataFrame:
    """Demand devices that have a parcel, with the parcel's shape; of several shapes the smallest ``seq``."""
    shapes = areas.groupBy("parcel_id").agg(F.min_by("rings", "seq").alias("rings"))
    joined = device_table.where("kind > 0").drop("geometry").join(shuffled(shapes), "parcel_id")
    out = numbered(joined, ["number"], "_number")
    return out.withColumn("id", padded_id(ID_PREFIXES["parcels"], F.col("_number"))).withColumnRenamed("rings", "geometry").drop(
        "specification", "placement", "kind", "number", "_number", "parcel_id", "node_id")


def _with_ids(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Device ids of both ends and of the source, empty where there is none."""
    size = measured_bytes(ids)
    for column, out in (("start", "start_id"), ("end", "end_id"), ("src", "source")):
        names = ids.select(F.col("node_id").alias(column), F.col("device_id").alias(out))
        edges = lookup_join(edges, names, [column], dim_bytes=size).withColumn(out, or_default(F.col(out), ""))
    return edges


def _edge_rows(edges: DataFrame, prefix: str, specification: Column, leg: bool, always_duct: bool) -> DataFrame:
    rows = numbered(edges.withColumn("specification", specification).where("specification <> ''"), ["edge_id"], "number")
    out = {
        "id": padded_id(prefix, F.col("number")), "edge_id": F.col("edge_id"), "start_id": F.col("start_id"),
        "end_id": F.col("end_id"), "specification": F.col("specification"), "source": F.col("source"),
        "placement": or_default(F.col("placement"), "ug"), "length": half_even(F.col("length"), 2),
        "geometry": F.col("geometry"),
    }
    if leg:
        out["leg"] = or_default(F.col("leg"), "")
    return rows.select(*[c.alias(n) for n, c in _duct(out, always_duct).items()], "tags", "arcs")


def edge_tables(
    edges: DataFrame, ids: DataFrame, roles: Mapping[str, set[str]],
    cable_specs: Sequence[tuple[str, int, int | None, str]], duct_specs: Sequence[tuple[str, int, int | None, str]],
    wanted: Sequence[str] = ("assignments", "ducts", "cables"),
) -> dict[str, DataFrame]:
    """Assignments, ducts and cables as independent projections of the edges; ``tags`` and ``arcs`` are kept."""
    named = checkpointed(_with_ids(edges, ids))

    def having(role: str) -> DataFrame:
        return named.where(has_any(F.col("tags"), sorted(roles.get(role, set()))) if roles.get(role) else F.lit(False))

    def assignments() -> DataFrame:
        return _edge_rows(having("SOLUTION_ASSIGN"), ID_PREFIXES["assignments"], F.lit(ASSIGNMENT_SPEC), False, False)

    def ducts() -> DataFrame:
        spec = spec_of(F.col("tags"), F.col("size"), duct_specs)
        return _edge_rows(having("SOLUTION_DUCT"), ID_PREFIXES["ducts"], spec, False, True)

    def cables() -> DataFrame:
        # A cable without a specification stays in the table; the blank keeps it through the filter.
        spec = spec_of(F.col("tags"), F.col("size"), cable_specs)
        rows = _edge_rows(having("SOLUTION_EDGE"), ID_PREFIXES["cables"], F.when(spec == "", " ").otherwise(spec), True, False)
        return rows.withColumn("specification", F.trim("specification"))

    makers = {"assignments": assignments, "ducts": ducts, "cables": cables}
    return {name: makers[name]() for name in wanted}


def used_edges(
    edges: DataFrame, roles: Mapping[str, set[str]], duct_specs: Sequence[tuple[str, int, int | None, str]],
) -> tuple[DataFrame, DataFrame]:
    """The ducts and cables that arcs are counted from, straight from the edges: counting needs no devices and no numbers."""
    def having(role: str) -> DataFrame:
        return edges.where(has_any(F.col("tags"), sorted(roles[role])) if roles.get(role) else F.lit(False))

    ducts = having("SOLUTION_DUCT").where(spec_of(F.col("tags"), F.col("size"), duct_specs) != "")
    return (ducts.select("tags", "arcs", or_default(F.col("duct_info")["group_id"], "").alias("duct_group")),
            having("SOLUTION_EDGE").select("tags", "arcs"))


def path_from_cables(cables: DataFrame) -> DataFrame:
    """One path row per cable."""
    number = F.regexp_extract("id", r"(\d+)$", 1)
    return cables.select(
        F.concat(F.lit(ID_PREFIXES["path"] + "-"), number).alias("id"), "start_id", "end_id", "placement", "length", "geometry")


def arc_usage(ducts: DataFrame, cables: DataFrame) -> DataFrame:
    """Arcs in use, each once whatever its direction, with usage counts.

    One pass of partial counts; distinct duct groups are counted in two steps by Spark, so that a busy arc
    is not one task.
    """
    oh, dist, feeder = (has_any(F.col("tags"), [t]) for t in ("oh-dist", "ug-dist", "ug-feeder"))
    kind = F.when(oh, "oh").when(dist, "ug-dist").when(feeder, "ug-feeder").otherwise("other")
    used = ducts.select(F.explode("arcs").alias("arc"), F.lit("duct").alias("kind"), "duct_group").unionByName(
        cables.where(~has_any(F.col("tags"), ["oh-drop"]))
        .select(F.explode("arcs").alias("arc"), kind.alias("kind"), F.lit(None).cast("string").alias("duct_group")))
    ordered = used.select(pair(F.col("arc.a"), F.col("arc.b")).alias("p"), "kind", "duct_group").select("p.a", "p.b", "kind", "duct_group")
    # Counting per (arc, kind, group) first makes the distinct count a plain count.
    first = ordered.groupBy("a", "b", "kind", "duct_group").agg(F.count(F.lit(1)).alias("n"))

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("kind") == name, F.col("n")).otherwise(0))

    return first.groupBy("a", "b").agg(
        F.sum(F.when((F.col("kind") == "duct") & F.col("duct_group").isNotNull(), 1).otherwise(0)).alias("dist_duct_bundle_cnt"),
        total("duct").alias("dist_duct_cnt"), total("ug-dist").alias("dist_cable_cnt"),
        total("ug-feeder").alias("feeder_duct_cnt"), total("oh").alias("oh_cable_cnt"))


def path_from_arcs(ducts: DataFrame, cables: DataFrame, base_edges: DataFrame, add_counts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Path rows of the arcs in use with their base edge, and the arcs that have none."""
    usage = arc_usage(ducts, cables)
    base = (
        base_edges.select(pair(F.col("a"), F.col("b")).alias("p"), F.struct("length", "tags", "geometry").alias("_e"), "edge_id")
        .groupBy("p").agg(F.min_by("_e", "edge_id").alias("_e")).select("p.a", "p.b", "_e.*")
    )
    found = numbered(usage.join(shuffled(base), ["a", "b"]), ["a", "b"], "number")
    counts = ["dist_duct_bundle_cnt", "dist_duct_cnt", "feeder_duct_cnt", "oh_cable_cnt"] if add_counts else []
    rows = found.select(
        padded_id(ID_PREFIXES["path"], F.col("number")).alias("id"), "a", "b",
        F.when(has_any(F.col("tags"), ["ug"]), "ug").otherwise("oh").alias("placement"),
        half_even(F.col("length"), 2).alias("length"), "geometry", *counts)
    return rows, usage.join(shuffled(base), ["a", "b"], "left_anti").select("a", "b")
