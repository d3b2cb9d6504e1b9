"""Selectors over the position-encoded ``nodes`` array, as Spark SQL expressions.

Every helper returns Spark SQL *expression text* built from higher-order
functions (``filter``/``transform``/``slice``/``exists``); callers turn the
finished expression into a Column with ``F.expr`` once.  Selection therefore
runs JVM-side with no Python and no shuffle, and building a query costs one
parser call per output column instead of thousands of gateway round trips.

Scopes are always narrowed with ``slice`` to an element's descendants before
filtering (linear per nesting level), never by filtering the whole page per
cell.  An *element* expression evaluates to one node struct (or null when
missing); a *scope* to an array of nodes.  ``pos`` is 0-based and ``slice``
1-based, so the descendants of ``e`` are ``slice(nodes, e.pos + 2, e.last - e.pos)``.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.markup import ROW_CLASS

TEXT = "#text"
NODES = "nodes"

_ids = itertools.count()


def fresh() -> str:
    """A lambda variable name unique within the process (nested lambdas never shadow)."""
    return f"lv{next(_ids)}"


def lit(s: str | None) -> str:
    """A Spark SQL string literal."""
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def col(sql: str) -> Column:
    return F.expr(sql)


_SIMPLE = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


def let(expr: str, body) -> str:
    """Evaluate ``expr`` once and use it in ``body`` as a lambda variable
    (``transform(array(expr), v -> body(v))[1]``).  SQL text would otherwise
    repeat — and Spark re-evaluate — an element lookup at every use, and
    common subexpressions are not shared inside lambda bodies."""
    if _SIMPLE.fullmatch(expr):
        return body(expr)
    v = fresh()
    return f"element_at(transform(array({expr}), {v} -> {body(v)}), 1)"


def first(arr: str) -> str:
    """First element, null on an empty or null array."""
    return f"try_element_at({arr}, 1)"


def last(arr: str) -> str:
    return f"try_element_at({arr}, -1)"


def descendants(nodes: str, e: str) -> str:
    """All nodes inside element ``e`` (null when ``e`` is null)."""
    return let(e, lambda x: f"(CASE WHEN {x} IS NOT NULL THEN slice({nodes}, {x}.pos + 2, {x}.last - {x}.pos) END)")


def node_at(nodes: str, pos: str) -> str:
    return f"(CASE WHEN ({pos}) >= 0 THEN try_element_at({nodes}, ({pos}) + 1) END)"


def matcher(tag: str | None = None, id: str | None = None, cls: str | None = None, href: bool = False):
    """A predicate like the CSS selector ``tag#id.cls[href]`` (``v -> condition``)."""

    def pred(v: str) -> str:
        conds = [f"{v}.tag = {lit(tag)}" if tag is not None else f"{v}.tag <> {lit(TEXT)}"]
        if id is not None:
            conds.append(f"{v}.id = {lit(id)}")
        if cls is not None:
            conds.append(f"instr({v}.cls, {lit(' ' + cls + ' ')}) > 0")
        if href:
            conds.append(f"{v}.href IS NOT NULL")
        return "(" + " AND ".join(conds) + ")"

    pred.tag = tag
    return pred


def find_all(scope: str, pred) -> str:
    v = fresh()
    return f"filter({scope}, {v} -> {pred(v)})"


def find(scope: str, pred) -> str:
    """First match in document order (``css_first`` / ``find``)."""
    return first(find_all(scope, pred))


def find_in(nodes: str, e: str, pred) -> str:
    """First descendant of ``e`` matching ``pred``."""
    return find(descendants(nodes, e), pred)


def find_all_in(nodes: str, e: str, pred) -> str:
    return find_all(descendants(nodes, e), pred)


def exists(scope: str, pred) -> str:
    v = fresh()
    return f"coalesce(exists({scope}, {v} -> {pred(v)}), false)"


def texts(nodes: str, e: str) -> str:
    """The stripped, non-empty text nodes inside ``e``."""
    v, w = fresh(), fresh()
    return f"transform(filter({descendants(nodes, e)}, {v} -> {v}.tag = {lit(TEXT)}), {w} -> {w}.txt)"


def text(nodes: str, e: str, sep: str | None = "") -> str:
    """E1 ``node_text``: text nodes stripped, empties dropped, joined by ``sep``;
    null when the element is missing.  With no separator, a short element's
    text comes precomputed in ``txt`` (see ``shred.py``); ``None`` joins with
    nothing and does not look there."""
    if sep == "":
        # nearly all elements are short: their text costs no lambda
        return f"coalesce(({e}).txt, {text(nodes, e, None)})"
    sep = sep or ""
    return let(e, lambda x: f"(CASE WHEN {x} IS NOT NULL THEN array_join({texts(nodes, x)}, {lit(sep)}) END)")


def text_or(nodes: str, e: str, default: str = "") -> str:
    return f"coalesce({text(nodes, e)}, {lit(default)})"


def rows(nodes: str, scope_elem: str, row_cls: str = ROW_CLASS) -> str:
    """``tr.<row_cls>`` descendants of an element (descendant semantics, so rows
    of nested tables are included, as a CSS ``tr`` selector does)."""
    return find_all_in(nodes, scope_elem, matcher("tr", cls=row_cls))


def cells(nodes: str, row: str) -> str:
    """The ``td`` descendants of a row."""
    return find_all_in(nodes, row, matcher("td"))


def table_rows(nodes: str, section: str, first_table: bool, row_cls: str = ROW_CLASS) -> str:
    """Rows of a section: of its first ``table`` when ``first_table`` (generic
    extractor), otherwise of the whole section (class-detail parser)."""
    scope = find_in(nodes, section, matcher("table")) if first_table else section
    return rows(nodes, scope, row_cls)


def row_cells(nodes: str, section: str, min_cells: int, first_table: bool = True, exact: bool = False) -> str:
    """``section_rows(id, min_cells)``: an array of cell arrays, keeping rows
    with at least (or exactly) ``min_cells`` cells."""
    r, cs = fresh(), fresh()
    op = "=" if exact else ">="
    return (f"filter(transform({table_rows(nodes, section, first_table)}, {r} -> {cells(nodes, r)}), "
            f"{cs} -> size({cs}) {op} {min_cells})")


def cell(cs: str, i: int) -> str:
    return f"try_element_at({cs}, {i + 1})"


def map_rows(arr: str, build) -> str:
    """``transform(arr, v -> build(v))``."""
    v = fresh()
    return f"transform({arr}, {v} -> {build(v)})"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"{lit(k)}, {v}" for k, v in fields.items()) + ")"


def empty_array(elem_type: str) -> str:
    return f"CAST(array() AS ARRAY<{elem_type}>)"


def explode_rows(df: DataFrame, keep: list, rows: Column | str, fields: list[str] | None = None) -> DataFrame:
    """One row per struct of an array, its fields (or ``fields`` by position)
    after the ``keep`` columns.  The outer explode with a filter evaluates the
    array once, where the inner one also tests its size."""
    out = df.select(*keep, F.explode_outer(rows).alias("__r")).filter(F.col("__r").isNotNull())
    names = [f.name for f in out.schema["__r"].dataType.fields]
    return out.select(*out.columns[:-1], *[F.col(f"__r.{n}").alias(m) for n, m in zip(names, fields or names)])
