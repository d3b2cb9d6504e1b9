"""E1–E11 — the generic entity extractor, as projections over ``nodes``.

One ``select`` finds the page's anchor elements (first ``h1``, first ``h2``,
``div.crumbs``, ``div#references`` …) once each; the next ones build the
fields from them.  Everything is narrow (no shuffle) and JVM-side; the
expressions are Spark SQL text from ``functions/nodes.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import markup as M
from docweave.functions import nodes as N
from docweave.functions.nodes import NODES, lit

VARIABLE_T = T.StructType([T.StructField(k, T.StringType()) for k in ("type", "name", "description")])
OVERLOAD_T = T.StructType(
    [T.StructField(k, T.StringType()) for k in ("return_type", "name", "link", "arguments", "description")]
)
VALUE_T = T.StructType([T.StructField(k, T.StringType()) for k in ("name", "description")])

# Superset entity schema, fields in the order the extractor emits them.
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("short_description", T.StringType()),
        T.StructField("navigation", T.ArrayType(T.StringType())),
        T.StructField("module", T.StringType()),
        T.StructField("header", T.StringType()),
        T.StructField("include", T.StringType()),
        T.StructField("syntax", T.StringType()),
        T.StructField("remarks", T.StringType()),
        T.StructField("variables", T.ArrayType(VARIABLE_T)),
        T.StructField("overloads", T.ArrayType(OVERLOAD_T)),
        T.StructField("values", T.ArrayType(VALUE_T)),
        T.StructField("entity_type", T.StringType()),
        T.StructField("source_path", T.StringType()),
    ]
)
ENTITY_FIELDS = [f.name for f in ENTITY_SCHEMA.fields]

# Entity-type keywords tested against the lower-cased h1 text,
# in this order (first match wins); "function" also matches "overload".
TYPE_KEYWORDS = [("class", ["class"]), ("function", ["function", "overload"]), ("enum", ["enum"]),
                 ("struct", ["struct"]), ("module", ["module"])]
# Reference-table keys, tested as substrings in this order.
REFERENCE_KEYS = ["module", "header", "include"]


#: What these selectors read of a node.
NODE_FIELDS = ["pos", "last", "tag", "id", "cls", "href", "txt"]


def entity_type_expr(nodes: str, h1: str, variables: str, members: str, values: str) -> str:
    """Keyword in the lower-cased first ``h1``; else by the section present
    (``variables``/``members``/``values`` are the already-located anchors, so
    a section test is a null check, not another pass over the page)."""
    t = f"lower({N.text(nodes, h1)})"
    whens = " ".join(
        f"WHEN {' OR '.join(f'contains({t}, {lit(w)})' for w in words)} THEN {lit(name)}" for name, words in TYPE_KEYWORDS
    )
    fallback = (
        f"CASE WHEN {variables} IS NOT NULL THEN 'class' WHEN {members} IS NOT NULL THEN 'function' "
        f"WHEN {values} IS NOT NULL THEN 'enum' ELSE 'unknown' END"
    )
    return f"coalesce(CASE WHEN ({h1}) IS NOT NULL THEN CASE {whens} END END, {fallback})"


def reference_pairs_expr(nodes: str, refs_div: str, first_table: bool, exact_two: bool,
                         missing_value: str | None) -> str:
    """E5 part 1: one ``(kind, value)`` per reference row.

    Key = first ``p`` of cell 0, lower-cased ('' when there is none);
    value = first ``p`` of cell 1 (``missing_value`` when none).  The first
    keyword contained in the key is the row's kind."""

    def kv(cs):
        key = f"lower({N.text_or(nodes, N.find_in(nodes, N.cell(cs, 0), N.matcher('p')), '')})"
        val = N.text(nodes, N.find_in(nodes, N.cell(cs, 1), N.matcher("p")))
        if missing_value is not None:
            val = f"coalesce({val}, {lit(missing_value)})"
        kind = "CASE " + " ".join(f"WHEN contains({key}, {lit(k)}) THEN {lit(k)}" for k in REFERENCE_KEYS) + " END"
        return N.struct(kind=kind, value=val)

    return N.map_rows(N.row_cells(nodes, refs_div, 2, first_table=first_table, exact=exact_two), kv)


def reference_field(pairs: str, kind: str) -> str:
    """E5 part 2: the last row of a kind wins."""
    v = N.fresh()
    return f"{N.last(f'filter({pairs}, {v} -> {v}.kind = {lit(kind)})')}.value"


def syntax_expr(nodes: str, syntax_div: str, sep: str) -> str:
    """``div#syntax`` → ``div.simplecode_api`` → first ``p``, texts joined by ``sep``."""
    api = N.find_in(nodes, syntax_div, N.matcher("div", cls=M.SYNTAX_BLOCK_CLASS))
    p = N.find_in(nodes, api, N.matcher("p"))
    return N.text(nodes, p, sep)


def navigation_expr(nodes: str, nav_div: str) -> str:
    """Text of every ``a`` inside the crumbs element; ``[]`` when absent."""
    links = N.find_all_in(nodes, nav_div, N.matcher("a"))
    return f"coalesce({N.map_rows(links, lambda a: N.text(nodes, a))}, {N.empty_array('STRING')})"


def variables_expr(nodes: str, section: str) -> str:
    """Rows with ≥3 cells of the first table → (type, name, description)."""
    return N.map_rows(
        N.row_cells(nodes, section, 3),
        lambda cs: N.struct(type=N.text(nodes, N.cell(cs, 0)), name=N.text(nodes, N.cell(cs, 1)),
                            description=N.text(nodes, N.cell(cs, 2))),
    )


def overloads_expr(nodes: str, section: str) -> str:
    """Rows with ≥4 cells; cell 0 ignored; the name cell's first ``a[href]``."""

    def one(cs):
        def with_cell(name_cell):
            def with_link(link):
                args = N.find_in(nodes, name_cell, N.matcher("div", cls=M.ARGUMENTS_CLASS))
                return N.struct(
                    return_type=N.text(nodes, N.cell(cs, 1)),
                    name=f"CASE WHEN {link} IS NOT NULL THEN {N.text(nodes, link)} ELSE {N.text(nodes, name_cell)} END",
                    link=f"{link}.href",
                    arguments=N.text(nodes, args),
                    description=N.text(nodes, N.cell(cs, 3)),
                )

            return N.let(N.find_in(nodes, name_cell, N.matcher("a", href=True)), with_link)

        return N.let(N.cell(cs, 2), with_cell)

    return N.map_rows(N.row_cells(nodes, section, 4), one)


def values_expr(nodes: str, section: str) -> str:
    """Rows with ≥2 cells → (name, description)."""
    return N.map_rows(
        N.row_cells(nodes, section, 2),
        lambda cs: N.struct(name=N.text(nodes, N.cell(cs, 0)), description=N.text(nodes, N.cell(cs, 1))),
    )


def with_anchors(df: DataFrame, anchors: dict) -> DataFrame:
    """Locate each anchor element once, each as its own column, so Catalyst
    prunes the anchors a query does not use.  They are looked for among the
    elements with an anchor's tag, found in one pass over the page."""
    tags = {pred.tag for pred in anchors.values()}
    if None in tags:
        scope = df.withColumn("_scope", F.col(NODES))
    else:
        v = N.fresh()
        scope = df.withColumn("_scope", F.expr(f"filter({NODES}, {v} -> {v}.tag IN ({', '.join(lit(t) for t in sorted(tags))}))"))
    return scope.select(*df.columns, *[F.expr(N.find("_scope", pred)).alias(name) for name, pred in anchors.items()])


GENERIC_ANCHORS = {
    "_h1": N.matcher(M.TITLE_TAG),
    "_h2": N.matcher(M.SUBTITLE_TAG),
    "_crumbs": N.matcher("div", cls=M.CRUMBS_CLASS),
    "_refs": N.matcher("div", id=M.REFERENCES_ID),
    "_syntax": N.matcher("div", id=M.SYNTAX_ID),
    "_descr": N.matcher("div", id=M.DESCRIPTION_ID),
    "_vars": N.matcher("div", id=M.VARIABLES_ID),
    "_members": N.matcher("div", cls=M.MEMBERS_CLASS),
    "_values": N.matcher("div", id=M.VALUES_ID),
}

_VARIABLES_T = "STRUCT<type: STRING, name: STRING, description: STRING>"
_OVERLOADS_T = "STRUCT<return_type: STRING, name: STRING, link: STRING, arguments: STRING, description: STRING>"
_VALUES_T = "STRUCT<name: STRING, description: STRING>"


def extract_entities(pages: DataFrame, keep: list[str] | None = None, failed: bool = False) -> DataFrame:
    """Shredded pages ``(…, source_path, nodes)`` → superset entity rows;
    of pages that could not be shredded none, or with ``failed`` a row without
    values (tell them by a kept ``shred_error``).

    ``variables``/``overloads``/``values`` are only set for class/function/enum
    pages (null otherwise, i.e. the key is absent), as the reference emits them.
    """
    keep = keep if keep is not None else [c for c in pages.columns if c not in ("nodes", "shred_error", "source_path")]
    a = with_anchors(pages if failed else pages.filter(F.col("nodes").isNotNull()), GENERIC_ANCHORS)
    a = a.select(
        *keep, "source_path", "nodes", *GENERIC_ANCHORS.keys(),
        F.expr(entity_type_expr(NODES, "_h1", "_vars", "_members", "_values")).alias("entity_type"),
        F.expr(reference_pairs_expr(NODES, "_refs", first_table=True, exact_two=True, missing_value=None)).alias("_pairs"),
    )
    e = "entity_type"
    out = a.select(
        *keep,
        F.expr(N.text(NODES, "_h1")).alias("name"),
        F.expr(N.text(NODES, "_h2")).alias("short_description"),
        F.expr(navigation_expr(NODES, "_crumbs")).alias("navigation"),
        *[F.expr(reference_field("_pairs", k)).alias(k) for k in REFERENCE_KEYS],
        F.expr(syntax_expr(NODES, "_syntax", "\n")).alias("syntax"),
        F.expr(N.text(NODES, "_descr")).alias("remarks"),
        F.expr(f"CASE WHEN {e} = 'class' THEN coalesce({variables_expr(NODES, '_vars')}, "
               f"{N.empty_array(_VARIABLES_T)}) END").alias("variables"),
        F.expr(f"CASE WHEN {e} = 'function' THEN coalesce({overloads_expr(NODES, '_members')}, "
               f"{N.empty_array(_OVERLOADS_T)}) END").alias("overloads"),
        F.expr(f"CASE WHEN {e} = 'enum' THEN coalesce({values_expr(NODES, '_values')}, "
               f"{N.empty_array(_VALUES_T)}) END").alias("values"),
        e,
        "source_path",
    )
    return out
