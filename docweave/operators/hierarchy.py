"""E18, H1–H8, J3–J7, A3, A7 — the class hierarchy and hierarchy-ordered output.

The hierarchy may be split over many pages (one per shard); each page yields
edges by position intervals, edges from all pages are unioned and
de-duplicated, and every graph operator after that is joins and aggregates in
rounds that grow with the logarithm of the depth (``operators/forest.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import markup as M
from docweave.functions import nodes as N
from docweave.operators import forest
from docweave.operators.skew import salted_join
from docweave.session import materialize


def hierarchy_edges(pages: DataFrame, max_depth: int | None = 10) -> DataFrame:
    """``table.hierarchy-table#hrch`` → one row per label cell
    ``(source_path, pos, name, link, parent, depth)``.

    A label cell (``td.hierarchy-label-cell``) names its node by its first
    ``a[href]``; its parent is the innermost enclosing label cell and its
    depth the number of enclosing label cells.  Cells deeper than
    ``max_depth`` are cut (0 = roots only, None = no limit).  A cell with no
    link of its own is named by the first link inside it (descendant
    semantics); a cell with no link at all, and so everything under it, is
    skipped, as in the recursive walk.

    Linear in the page at any depth: the shredder gives every label cell its
    enclosing cell, depth and first link, cells become rows, and a row finds its
    parent's name by a join on (page, position).
    """
    nodes = N.NODES
    table = N.find(nodes, N.matcher("table", id=M.HIERARCHY_TABLE_ID, cls=M.HIERARCHY_TABLE_CLASS))
    cells = N.find_all(N.descendants(nodes, table), lambda v: f"{v}.lnk IS NOT NULL")
    rows = N.map_rows(cells, lambda c: N.let(N.node_at(nodes, f"{c}.lnk"), lambda a: N.struct(
        pos=f"{c}.pos", up=f"{c}.up", depth=f"{c}.lvl", name=N.text(nodes, a), link=f"{a}.href")))
    cell = (pages.filter(F.col("nodes").isNotNull()).select("source_path", F.explode_outer(F.expr(rows)).alias("_c"))
            .filter(F.col("_c").isNotNull()).select("source_path", "_c.*"))
    if max_depth is not None:
        cell = cell.filter(F.col("depth") <= max_depth)
    # Written: both sides of the join read the pages once.
    cell = materialize(cell)
    above = cell.select("source_path", F.col("pos").alias("up"), F.col("name").alias("parent"))
    return cell.join(above, ["source_path", "up"], "left").select("source_path", "pos", "name", "link", "parent", "depth")


def hierarchy_pages(pages: DataFrame, all_pages: bool = False, root: str = "ClassHierarchy") -> DataFrame:
    """The hierarchy page (``<root>/index.html``), or with ``all_pages``
    every ``index.html`` under ``<root>/`` (one shard per page)."""
    if all_pages:
        return pages.filter(F.startswith("source_path", F.lit(root + "/")))
    return pages.filter(F.col("source_path") == f"{root}/index.html")


def hierarchy_flat(edges: DataFrame) -> DataFrame:
    """H1: one row per tree position ``(name, link, parent, depth, ord)`` over
    all shards (a node repeated on several shard pages is one row).  ``ord`` is
    its first place ``(source_path, pos)``: siblings and roots follow each other
    in that order."""
    place = F.struct("source_path", "pos")
    return edges.groupBy("name", "parent").agg(
        F.min_by("link", place).alias("link"), F.min("depth").alias("depth"), F.min(place).alias("ord")
    )


def hierarchy_children(flat: DataFrame) -> DataFrame:
    """A3: per parent — number of children and its first and last child in
    document order (partial aggregates; no child list is collected, so a parent
    with millions of children costs no more than any other group)."""
    return flat.filter(F.col("parent").isNotNull()).groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_children"), F.min_by("name", "ord").alias("first_child"), F.max_by("name", "ord").alias("last_child")
    )


def hierarchy_child_rows(flat: DataFrame) -> DataFrame:
    """A3 as rows ``(parent, ord, name)``: a parent's children in document order
    are its rows by ``ord``."""
    return flat.filter(F.col("parent").isNotNull()).select("parent", "ord", "name")


def hierarchy_sink_rows(flat: DataFrame) -> DataFrame:
    """K4 rows: ``(name, link, parent, depth, ord, n_children)`` — a ``children[]``
    list is carried as rows (each child row names its parent and its place) plus
    a count, so no parent's children are ever collected into one row."""
    kids = flat.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    return flat.select("name", "link", "parent", "depth", "ord").join(kids, "name", "left").select(
        "name", "link", "parent", "depth", "ord", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")
    )


def hierarchy_roots(flat: DataFrame) -> DataFrame:
    """Names that are nobody's child."""
    names = flat.select("name").distinct()
    kids = flat.filter(F.col("parent").isNotNull()).select("name").distinct()
    return names.join(kids, "name", "left_anti")


def hierarchy_walk(spark: SparkSession, flat: DataFrame, max_depth: int | None = None, paths: bool = True) -> DataFrame:
    """H3: pre-order walk from every root, one row per path (D6), with a cycle
    guard and, only if asked, a depth limit: ``(root, name, depth, places, size)``
    and, with ``paths``, ``path``, the array of names from the root.

    ``places`` is the row's pre-order number, after those of the nodes with
    several parents above it, where the walk enters their part again; ``ORDER BY
    places`` is the pages' own order.  ``size`` is the number of rows that the
    row's subtree has in its part.  ``flat`` without ``ord`` is ordered by name.
    Rounds grow with the logarithm of the depth (``operators/forest.py``).
    """
    if "ord" not in flat.columns:
        flat = flat.withColumn("ord", F.struct(F.col("name").alias("source_path"), F.lit(0).alias("pos")))
    flat = materialize(flat.select("name", "parent", "ord"))
    return forest.walk(flat, hierarchy_roots(flat), max_depth, paths)


def hierarchy_closure(spark: SparkSession, flat: DataFrame) -> DataFrame:
    """H4: every ancestor/descendant pair once, ``(anc, name, depth)`` with the
    shortest distance ``depth ≥ 1``; a name is no ancestor of its own.  Distances
    double from round to round; cycles end by themselves."""
    return forest.closure(flat)


# --------------------------------------------------------------------------
# Organise entities by the hierarchy
# --------------------------------------------------------------------------
def split_entities(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Named entities only; classes (last row per name wins, A2) and the rest."""
    from docweave.operators.curate import last_wins

    named = entities.filter(F.col("name").isNotNull() & (F.col("name") != ""))
    classes = last_wins(named.filter(F.col("entity_type") == "class"), "name", "line")
    first_seen = (
        named.filter(F.col("entity_type") == "class").groupBy("name").agg(F.min("line").alias("first_line"))
    )
    classes = classes.join(first_seen, "name")
    others = named.filter(F.coalesce(F.col("entity_type") != "class", F.lit(True)))
    return classes, others


def entity_crumbs(others: DataFrame) -> DataFrame:
    """Each entity × each of its crumbs, ``(…, nav_pos, crumb)``, written: the
    hot crumbs are counted before the rows are joined.  Crumbs are bounded per
    entity, so the explode is narrow."""
    return materialize(others.select("*", F.posexplode("navigation").alias("nav_pos", "crumb")))


def related_entities(others: DataFrame, class_names: DataFrame) -> DataFrame:
    """Each non-class entity × each crumb equal to a hierarchy class name
    (a crumb repeated on one page attaches twice).  Popular crumbs are hot keys:
    they are measured and salted by the entity."""
    names = class_names.select(F.col("name").alias("crumb")).distinct()
    return salted_join(entity_crumbs(others), names, "crumb", ["source_path", "nav_pos"], "left_semi").withColumnRenamed("crumb", "class_name")


def related_counts(related: DataFrame) -> DataFrame:
    """The size of each class's related-entity group (partial aggregate)."""
    return related.groupBy("class_name").agg(F.count(F.lit(1)).alias("n_related"))


def organize_by_hierarchy(spark: SparkSession, entities: DataFrame, flat: DataFrame, max_depth: int | None = None) -> DataFrame:
    """H8: hierarchy-ordered output as rows with an explicit sort key.

    ``entities`` needs ``name, entity_type, navigation, source_path, line``
    (``line`` = input order, unique); all its other columns are carried to the
    output.  Output: ``segment`` (1 = walk, 2 = classes the walk never reached,
    3 = other entities that the walk did not write), ``path`` and ``places`` (of
    the walk, ``[]`` outside segment 1), ``kind`` (0 = the class row, 1 = a
    related entity), ``ord`` (input order inside a group), then the whole
    entity.  ``ORDER BY segment, places, kind, ord`` is the output order; no
    dense rank is computed (that would need a single-task window).

    The placement is worked out on narrow rows (name, type, crumbs, line); the
    records join at the end.  A class whose ancestors form a ring without a root
    is never reached: it goes to segment 2 and what is attached to such classes
    only goes to segment 3, so that nothing is lost.
    """
    entities = materialize(entities)
    narrow = entities.select("name", "entity_type", "navigation", "line")
    classes, others = split_entities(narrow)
    walk = materialize(hierarchy_walk(spark, flat, max_depth))
    visited = walk.select("name").distinct()
    key = lambda segment, kind, ord_: [F.lit(segment).alias("segment"), F.lit(kind).alias("kind"), ord_.alias("ord"), F.col("line").alias("_line")]

    # H5: per visited node, the class row then its related entities; hot crumbs are salted.
    in_walk = walk.select("name", "path", "places")
    rel = materialize(salted_join(entity_crumbs(others.select("navigation", "line")).drop("navigation"), in_walk.withColumnRenamed("name", "crumb"),
                                  "crumb", ["line", "nav_pos"]))
    placed = in_walk.join(classes.select("name", "line"), "name").select(*key(1, 0, F.col("line")), "path", "places").unionByName(
        rel.select(*key(1, 1, F.col("line")), "path", "places"))
    # Classes not written by the walk, in first-seen order; H7 / J5: other entities it did not write, in input order.
    loose = classes.join(visited, "name", "left_anti").select(*key(2, 0, F.col("first_line"))).unionByName(
        others.join(rel.select("line").distinct(), "line", "left_anti").select(*key(3, 1, F.col("line"))))
    types = {f.name: f.dataType for f in in_walk.schema}
    placed = placed.unionByName(loose.select("*", *[F.array().cast(types[c]).alias(c) for c in ("path", "places")]))
    record = entities.withColumnRenamed("line", "_line")
    return placed.join(record, "_line").select("segment", "path", "places", "kind", "ord", *[c for c in entities.columns if c != "line"])
