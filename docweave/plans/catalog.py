"""The registered queries (one per SURVEY §2 operator) and their DuckDB oracles.

Every query takes ``(spark, sf_dir)``, reads the test tables (or pages Spark
renders from them, ``fixtures.py``) in full and returns a flat DataFrame.
Every oracle computes the same rows straight from the base tables — it never
sees the HTML — so the check is independent of the rendering.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import text as TX
from docweave.operators import curate as C
from docweave.operators import details as D
from docweave.operators import hierarchy as H
from docweave.operators import links as L
from docweave.operators import quality as Q
from docweave.functions import nodes as N
from docweave.operators.extract import NODE_FIELDS, extract_entities
from docweave.operators.shred import shred
from docweave.plans import fixtures as X
from docweave.session import ensure_checkpoint_dir, materialize
from docweave.sources import sinks as K
from docweave.streaming.progress import category_progress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def tbl(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------- shared frames
def shredded(pages: DataFrame, implied_ends: bool = False, fields: list[str] | None = None) -> DataFrame:
    """Rendered pages where they are: their rows were dealt before they were rendered."""
    return shred(pages, keep=["category", "source_path"], implied_ends=implied_ends, fields=fields)


# What several queries of a session share, worked out once per (application,
# tables, name) and kept as Parquet tables in the shared checkpoint folder.
_PARSED: dict[tuple, DataFrame] = {}


def _materialized(spark: SparkSession, d: str, name: str, build, partition_by=None) -> DataFrame:
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _PARSED:
        _PARSED[key] = materialize(build(), partition_by)
    return _PARSED[key]


def forget_parsed() -> None:
    """Drop the session's shared tables, so that the next query works them out again."""
    _PARSED.clear()


def doc_nodes(spark, d) -> DataFrame:
    """X1 ∪ X2 ∪ X3 ∪ X7 ∪ X8, shredded.  Node arrays are many times larger than
    their pages, so they are never written or shuffled: each query renders and
    parses its own pages and extracts from them in the same tasks."""
    return shredded(X.doc_pages(spark, d), fields=NODE_FIELDS)


def parsed(spark: SparkSession, d: str, fixture: str, fields: list[str] | None = None) -> DataFrame:
    """One page set, shredded; read it once in a query."""
    return shredded(getattr(X, fixture)(spark, d), fields=fields)


def doc_entities(spark, d) -> DataFrame:
    return extract_entities(doc_nodes(spark, d))


def flat_entities(ents: DataFrame) -> DataFrame:
    n = F.coalesce(F.size("variables"), F.size("overloads"), F.size("values")).cast("long")
    return ents.select(
        "category", "source_path", "entity_type", "name", "short_description",
        F.array_join("navigation", " > ").alias("navigation"), "module", "header", "include", "syntax", "remarks",
        F.when(F.col("entity_type").isin("class", "function", "enum"), n).alias("n_members"),
    )


def x6_parsed(spark, d) -> DataFrame:
    """X6 entity lines, parsed once per session (written)."""
    return _materialized(spark, d, "x6_parsed", lambda: C.parse_entity_lines(X.x6_entity_lines(spark, d)))


def hierarchy_flat(spark, d, max_depth: int | None = 10) -> DataFrame:
    return H.hierarchy_flat(H.hierarchy_edges(parsed(spark, d, "x5_hierarchy_pages"), max_depth))


def url_pages(spark, d) -> DataFrame:
    """``pages`` addressed like a page tree: category = first url path segment."""
    p = tbl(spark, d, "pages")
    return p.select(
        "page_id", "url", "html",
        F.regexp_extract("url", r"^[a-z]+://[^/]+/([^/?#]+)", 1).alias("category"),
        F.regexp_extract("url", r"^[a-z]+://[^/]+/[^/?#]+/?([^?#]*)", 1).alias("source_path"),
    )


# ---------------------------------------------------------------- SQL snippets
X1_CTE = """
x1_li AS (
  SELECT l.*, (l_orderkey * 32 + l_linenumber)
         % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY l_partkey) / 256.0) AS BIGINT)) AS chunk
  FROM lineitem l),
x1_cnt AS (SELECT l_partkey, chunk, count(*) AS n FROM x1_li GROUP BY l_partkey, chunk),
x1 AS (
  SELECT p.*, coalesce(c.chunk, 0) AS chunk, coalesce(c.n, 0) AS n, coalesce(nt.n_name, '') AS nat,
         'Part/' || p.p_partkey || CASE WHEN coalesce(c.chunk, 0) > 0 THEN '.' || c.chunk ELSE '' END
         || '/index.html' AS source_path
  FROM part p LEFT JOIN x1_cnt c ON c.l_partkey = p.p_partkey
  LEFT JOIN nation nt ON nt.n_nationkey = p.p_partkey % 25)"""

X2_CTE = """
x2_li AS (
  SELECT l.*, CAST('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 8) AS BIGINT)
         % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY l_orderkey) / 256.0) AS BIGINT)) AS chunk
  FROM lineitem l),
x2_cnt AS (SELECT l_orderkey, chunk, count(*) AS n FROM x2_li GROUP BY l_orderkey, chunk),
x2 AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, coalesce(nt.n_name, '') AS nat,
         coalesce(c.chunk, 0) AS chunk, coalesce(c.n, 0) AS n,
         CAST(o.o_orderkey AS VARCHAR) || CASE WHEN coalesce(c.chunk, 0) > 0 THEN '.' || c.chunk ELSE '' END AS folder,
         'Functions/' || o.o_orderkey || CASE WHEN coalesce(c.chunk, 0) > 0 THEN '.' || c.chunk ELSE '' END
         || '/index.html' AS source_path
  FROM orders o LEFT JOIN x2_cnt c ON c.l_orderkey = o.o_orderkey
  LEFT JOIN customer cu ON cu.c_custkey = o.o_custkey
  LEFT JOIN nation nt ON nt.n_nationkey = cu.c_nationkey)"""

X3_CTE = """
x3_c AS (
  SELECT c.*, c_custkey % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY c_nationkey) / 256.0) AS BIGINT)) AS chunk
  FROM customer c),
x3_cnt AS (SELECT c_nationkey, chunk, count(*) AS n FROM x3_c GROUP BY c_nationkey, chunk),
x3 AS (
  SELECT n.n_nationkey, n.n_name, coalesce(r.r_name, '') AS reg, coalesce(c.chunk, 0) AS chunk, coalesce(c.n, 0) AS n,
         'Enums/' || n.n_nationkey || CASE WHEN coalesce(c.chunk, 0) > 0 THEN '.' || c.chunk ELSE '' END
         || '/index.html' AS source_path
  FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN x3_cnt c ON c.c_nationkey = n.n_nationkey)"""

X7_CTE = """
x7 AS (
  SELECT nm, 'Node/' || kind || '/' || k || '/index.html' AS source_path FROM (
    SELECT r_name AS nm, 'R' AS kind, CAST(r_regionkey AS BIGINT) AS k FROM region
    UNION ALL SELECT n_name, 'N', CAST(n_nationkey AS BIGINT) FROM nation
    UNION ALL SELECT s_name, 'S', CAST(s_suppkey AS BIGINT) FROM supplier))"""

X8_CTE = """
x8 AS (
  SELECT DISTINCT c_mktsegment AS seg, CASE WHEN c_nationkey % 5 = 0 THEN 'Nowhere' ELSE 'Tier' || (c_nationkey % 13) END AS crumb,
         'Tiers/' || c_nationkey || '/' || c_mktsegment || '/index.html' AS source_path FROM customer)"""

X4_CTE = """
x4_p AS (
  SELECT p.*, p_partkey % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY p_brand) / 256.0) AS BIGINT)) AS chunk
  FROM part p),
x4_links AS (
  SELECT 'Index/' || replace(p_brand, '#', '_') || CASE WHEN chunk > 0 THEN '.' || chunk ELSE '' END || '/index.html'
           AS index_path,
         p_name AS name, '../Part/' || p_partkey AS relative_url, p_partkey % 10 = 3 AS no_first_href, p_partkey
  FROM x4_p
  UNION ALL
  SELECT DISTINCT 'Index/' || replace(p_brand, '#', '_') || '/index.html', 'Ghost ' || p_brand,
         '../Part/missing-' || p_brand, false, NULL
  FROM part)"""

X5_CTE = """
x5_s AS (
  SELECT s.*, s_suppkey % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY s_nationkey) / 256.0) AS BIGINT)) AS chunk
  FROM supplier s),
x5_pg AS (
  SELECT nk, 'ClassHierarchy/' || nk || CASE WHEN chunk > 0 THEN '.' || chunk ELSE '' END || '/index.html' AS source_path, chunk
  FROM (SELECT DISTINCT s_nationkey AS nk, chunk FROM x5_s
        UNION ALL SELECT n_nationkey, 0 FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier))),
x5_cells AS (
  SELECT p.source_path, 0 AS place, r.r_name AS name, '../R/' || r.r_regionkey AS link, CAST(NULL AS VARCHAR) AS parent, 0 AS depth
  FROM x5_pg p JOIN nation n ON n.n_nationkey = p.nk JOIN region r ON r.r_regionkey = n.n_regionkey
  UNION ALL
  SELECT p.source_path, 1, n.n_name, '../N/' || n.n_nationkey, r.r_name, 1
  FROM x5_pg p JOIN nation n ON n.n_nationkey = p.nk JOIN region r ON r.r_regionkey = n.n_regionkey
  UNION ALL
  SELECT p.source_path, 2 + s_suppkey, s.s_name, '../S/' || s.s_suppkey, n.n_name, 2
  FROM x5_s s JOIN x5_pg p ON p.nk = s.s_nationkey AND p.chunk = s.chunk
  JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  UNION ALL
  SELECT 'ClassHierarchy/chain/index.html', n_nationkey, 'Tier' || n_nationkey, '../T/' || n_nationkey,
         CASE WHEN n_nationkey > 0 THEN 'Tier' || (n_nationkey - 1) END, n_nationkey FROM nation WHERE n_nationkey < 13),
x5_all AS (
  SELECT name, parent, min(link) AS link, min(depth) AS depth, min(source_path || '|' || lpad(CAST(place AS VARCHAR), 12, '0')) AS ord
  FROM x5_cells GROUP BY name, parent),
x5_nodes AS (SELECT * FROM x5_all WHERE depth <= 10)"""
#: Every node under every path from a root, with the places along it (``x5_all`` may be cut to ``x5_nodes``).
WALK_CTE = """
walk(root, name, depth, path, places) AS (
  SELECT name, name, 0, [name], [ord] FROM x5_all WHERE parent IS NULL
  UNION ALL
  SELECT w.root, n.name, w.depth + 1, list_append(w.path, n.name), list_append(w.places, n.ord)
  FROM walk w JOIN x5_all n ON n.parent = w.name)"""


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes)


# ============================================================ E0–E11 (generic)
ENTITIES_SQL = with_ctes(X1_CTE, X2_CTE, X3_CTE, X7_CTE, X8_CTE) + """
SELECT 'developer' AS category, source_path, 'class' AS entity_type,
       CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE 'class ' || p_name END AS name,
       p_type || ' part of size ' || p_size AS short_description,
       p_brand || ' > ' || p_type || ' > ' || nat AS navigation,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand || '-alt' ELSE p_brand END AS module,
       p_type || '.h' AS header, '#include "' || p_type || '.h"' AS include,
       'class ' || p_name || chr(10) || ': public ' || p_brand AS syntax,
       p_type || ' part, size ' || p_size || '.Made by' || p_brand || '.' AS remarks,
       CAST(n AS BIGINT) AS n_members
FROM x1
UNION ALL
SELECT 'runtime', source_path, 'function',
       CASE WHEN o_orderkey % 2 = 0 THEN 'function Order' || o_orderkey ELSE 'Order' || o_orderkey || ' overloads' END,
       'Order of customer ' || o_custkey, 'Orders > ' || o_orderpriority || ' > ' || nat,
       NULL, NULL, NULL, NULL, NULL, CAST(n AS BIGINT)
FROM x2
UNION ALL
SELECT 'plugins', source_path, 'enum',
       CASE WHEN n_nationkey % 2 = 0 THEN 'enum ' || n_name ELSE n_name END,
       'Customers of ' || n_name, reg || ' > ' || n_name, reg, NULL, NULL,
       'enum ' || n_name || chr(10) || '{ ' || n_nationkey || ' }', 'Region' || reg, CAST(n AS BIGINT)
FROM x3
UNION ALL
SELECT 'editor', source_path, 'class', nm, NULL, '', NULL, NULL, NULL, NULL, NULL, CAST(1 AS BIGINT)
FROM x7
UNION ALL
SELECT 'tiers', source_path, 'function', 'function ' || seg, NULL, crumb, NULL, NULL, NULL, NULL, NULL, CAST(0 AS BIGINT)
FROM x8
"""


@register("entities", ENTITIES_SQL)
def q_entities(spark, d):
    """E11 flagship: every rendered page → one typed entity row."""
    return flat_entities(doc_entities(spark, d))


@register("page_nodes", "SELECT page_id, CAST(len(regexp_extract_all(html, '<[a-zA-Z]')) AS BIGINT) AS n_elements FROM pages")
def q_page_nodes(spark, d):
    """E0 on real markup: element count per page."""
    sh = shred(tbl(spark, d, "pages").select("page_id", "html"), keep=["page_id"], spread=True)
    return sh.select("page_id", F.expr(f"CAST(size({N.find_all(N.NODES, N.matcher())}) AS BIGINT)").alias("n_elements"))


@register("page_titles", """
SELECT page_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1)),
    '&quot;?', '"', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g') AS title
FROM pages""")
def q_page_titles(spark, d):
    """E3 on real markup: text of the first h1."""
    sh = shred(tbl(spark, d, "pages").select("page_id", "html"), keep=["page_id"], spread=True)
    return sh.select("page_id", F.expr(N.text(N.NODES, N.find(N.NODES, N.matcher("h1")))).alias("title"))


@register("nav_links", """
SELECT page_id, CAST(len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a [^>]*href="[^#"][^"]*"'))
       AS BIGINT) AS n_links
FROM pages""")
def q_nav_links(spark, d):
    """Links inside the first ``nav`` with a non-empty href not starting with '#'."""
    sh = shred(tbl(spark, d, "pages").select("page_id", "html"), keep=["page_id"], spread=True)
    links = N.find_all_in(N.NODES, N.find(N.NODES, N.matcher("nav")), N.matcher("a", href=True))
    good = N.find_all(links, lambda a: f"({a}.href <> '' AND NOT startswith({a}.href, '#'))")
    return sh.select("page_id", F.expr(f"CAST(coalesce(size({good}), 0) AS BIGINT)").alias("n_links"))


@register("entity_type", with_ctes(X1_CTE, X2_CTE, X3_CTE, X7_CTE, X8_CTE) + """
SELECT category, entity_type, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'developer' AS category, 'class' AS entity_type FROM x1
  UNION ALL SELECT 'runtime', 'function' FROM x2
  UNION ALL SELECT 'plugins', 'enum' FROM x3
  UNION ALL SELECT 'editor', 'class' FROM x7
  UNION ALL SELECT 'tiers', 'function' FROM x8
  UNION ALL SELECT 'web', 'unknown' FROM pages) GROUP BY ALL""")
def q_entity_type(spark, d):
    """Entity types per category, over the rendered pages and the raw ``pages``."""
    ents = doc_entities(spark, d).select("category", "entity_type")
    web = extract_entities(
        shred(tbl(spark, d, "pages").select(F.lit("web").alias("category"), F.col("url").alias("source_path"), "html"),
              keep=["category", "source_path"], spread=True)
    ).select("category", "entity_type")
    return ents.unionByName(web).groupBy("category", "entity_type").agg(F.count(F.lit(1)).alias("n"))


def _x1_entities(spark, d):
    return extract_entities(parsed(spark, d, "x1_class_pages", NODE_FIELDS))


@register("breadcrumbs", with_ctes(X1_CTE) + """
SELECT source_path, CAST(pos AS BIGINT) AS pos, crumb FROM (
  SELECT source_path, 0 AS pos, p_brand AS crumb FROM x1 UNION ALL
  SELECT source_path, 1, p_type FROM x1 UNION ALL
  SELECT source_path, 2, nat FROM x1)""")
def q_breadcrumbs(spark, d):
    """One row per crumb with its position."""
    crumbs = F.transform("navigation", lambda c, i: F.struct(i.cast("long").alias("pos"), c.alias("crumb")))
    return N.explode_rows(_x1_entities(spark, d), ["source_path"], crumbs)


@register("entity_references", with_ctes(X1_CTE) + """
SELECT source_path, CASE WHEN p_partkey % 2 = 0 THEN p_brand || '-alt' ELSE p_brand END AS module,
       p_type || '.h' AS header, '#include "' || p_type || '.h"' AS include FROM x1""")
def q_entity_references(spark, d):
    """E5: module/header/include, last matching row wins."""
    return _x1_entities(spark, d).select("source_path", "module", "header", "include")


@register("entity_syntax", with_ctes(X1_CTE, X3_CTE) + """
SELECT source_path, 'class ' || p_name || chr(10) || ': public ' || p_brand AS syntax FROM x1
UNION ALL SELECT source_path, 'enum ' || n_name || chr(10) || '{ ' || n_nationkey || ' }' FROM x3""")
def q_entity_syntax(spark, d):
    """Syntax text nodes joined by a newline."""
    pages = parsed(spark, d, "x1_class_pages", NODE_FIELDS).unionByName(parsed(spark, d, "x3_enum_pages", NODE_FIELDS))
    return extract_entities(pages).select("source_path", "syntax")


@register("entity_remarks", with_ctes(X1_CTE, X3_CTE) + """
SELECT source_path, p_type || ' part, size ' || p_size || '.Made by' || p_brand || '.' AS remarks FROM x1
UNION ALL SELECT source_path, 'Region' || reg FROM x3""")
def q_entity_remarks(spark, d):
    """Description text (text nodes joined with no separator)."""
    pages = parsed(spark, d, "x1_class_pages", NODE_FIELDS).unionByName(parsed(spark, d, "x3_enum_pages", NODE_FIELDS))
    return extract_entities(pages).select("source_path", "remarks")


@register("class_variables", """
SELECT CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE 'class ' || p_name END AS name,
       l_returnflag AS var_type, l_orderkey || '-' || l_linenumber AS var_name,
       strftime(l_shipdate, '%Y-%m-%d') AS var_description
FROM part JOIN lineitem ON l_partkey = p_partkey""")
def q_class_variables(spark, d):
    """Member variables (rows with ≥3 cells) of class pages."""
    return N.explode_rows(_x1_entities(spark, d), ["name"], "variables", ["var_type", "var_name", "var_description"])


@register("function_overloads", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'function Order' || o_orderkey ELSE 'Order' || o_orderkey || ' overloads' END
         AS name,
       l_returnflag AS return_type,
       CASE WHEN l_linenumber % 3 = 0
            THEN 'L' || l_orderkey || '-' || l_linenumber || '(qty ' || CAST(l_quantity AS BIGINT) || ')'
            ELSE 'L' || l_orderkey || '-' || l_linenumber END AS overload_name,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE '../L/' || l_orderkey || '-' || l_linenumber END AS link,
       CASE WHEN l_linenumber % 3 <> 0 AND l_linenumber % 4 = 0 THEN NULL
            ELSE '(qty ' || CAST(l_quantity AS BIGINT) || ')' END AS arguments,
       strftime(l_shipdate, '%Y-%m-%d') AS description
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def q_function_overloads(spark, d):
    """Overload rows (≥4 cells) of function pages."""
    e = extract_entities(parsed(spark, d, "x2_function_pages", NODE_FIELDS))
    return N.explode_rows(e, ["name"], "overloads", ["return_type", "overload_name", "link", "arguments", "description"])


@register("enum_values", """
SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'enum ' || n_name ELSE n_name END AS name,
       c_name AS value_name, c_mktsegment AS value_description
FROM nation JOIN customer ON c_nationkey = n_nationkey""")
def q_enum_values(spark, d):
    """Enum values (rows with ≥2 cells)."""
    e = extract_entities(parsed(spark, d, "x3_enum_pages", NODE_FIELDS))
    return N.explode_rows(e, ["name"], "values", ["value_name", "value_description"])


# ============================================================ E12–E17 (specialised)
def _x1c_detail(spark, d, unclosed: bool = False):
    pages = _unclosed_classes(spark, d) if unclosed else parsed(spark, d, "x1c_class_detail_pages")
    return D.class_detail(pages, keep=["source_path"])


def _unclosed_classes(spark, d) -> DataFrame:
    """The class pages without the end tags of paragraphs, cells and rows."""
    pages = X.x1c_class_detail_pages(spark, d).withColumn("html", F.regexp_replace("html", "</(p|td|tr)>", ""))
    return shredded(pages, implied_ends=True)


@register("class_detail", """
SELECT 'Part/' || p_partkey || '/index.html' AS source_path, p_name AS class_name,
       CASE WHEN p_partkey % 2 = 0 THEN p_type || ' summary' ELSE p_type || ' intro' END AS short_description,
       p_brand || ' > ' || p_type AS navigation, p_brand || ' > ' || p_name AS inheritance,
       'Size ' || p_size AS remarks,
       CASE WHEN p_partkey % 3 <> 0 THEN 'class ' || p_name || ' | ' || p_brand ELSE p_name || 'type' END AS syntax,
       p_brand AS module, p_type || '.h' AS header, CAST(NULL AS VARCHAR) AS include
FROM part""")
def q_class_detail(spark, d, unclosed: bool = False):
    """Class-detail fields (summary / h1+p, breadcrumb, inheritance, list syntax)."""
    return _x1c_detail(spark, d, unclosed).select(
        "source_path", "class_name", "short_description", F.array_join("navigation", " > ").alias("navigation"),
        F.array_join("inheritance", " > ").alias("inheritance"), "remarks", F.array_join("syntax", " | ").alias("syntax"),
        "module", "header", "include",
    )


@register("class_members", """
SELECT 'Part/' || p_partkey || '/index.html' AS source_path, section, m_type, m_name, m_description, specifiers FROM (
  SELECT p_partkey, 'variables' AS section, p_type AS m_type, 'type' AS m_name, 'Part type' AS m_description,
         '' AS specifiers FROM part
  UNION ALL SELECT p_partkey, 'variables', 'UProperty ' || p_brand, 'brand', 'Brand', 'UProperty ' || p_brand FROM part
  UNION ALL SELECT p_partkey, 'variables', 'int', 'size', CAST(p_size AS VARCHAR), '' FROM part
  UNION ALL SELECT p_partkey, 'constructors', p_type, p_name, 'Makes a part', NULL FROM part
  UNION ALL SELECT p_partkey, 'functions', 'string', 'GetBrand', p_brand, NULL FROM part
  UNION ALL SELECT p_partkey, 'constants', NULL, 'SIZE', CAST(p_size AS VARCHAR), NULL FROM part)""")
def q_class_members(spark, d, unclosed: bool = False):
    """Variables / constructors / functions / constants of class pages."""
    none = F.lit(None).cast("string")

    def section(name, m_type="type", specifiers=None):
        return F.transform(name, lambda m: F.struct(
            F.lit(name).alias("section"), (m[m_type] if m_type else none).alias("m_type"), m["name"].alias("m_name"),
            m["description"].alias("m_description"), (m[specifiers] if specifiers else none).alias("specifiers")))

    members = F.concat(section("variables", specifiers="specifiers"), section("constructors"), section("functions"),
                       section("constants", m_type=None))
    return N.explode_rows(_x1c_detail(spark, d, unclosed), ["source_path"], members)


@register("class_detail_unclosed", ORACLES["class_detail"])
def q_class_detail_unclosed(spark, d):
    """The same fields from pages that leave optional end tags out."""
    return q_class_detail(spark, d, unclosed=True)


@register("class_members_unclosed", ORACLES["class_members"])
def q_class_members_unclosed(spark, d):
    """The same members from tables without the end tags of cells and rows."""
    return q_class_members(spark, d, unclosed=True)


@register("class_see_also", "SELECT 'Part/' || p_partkey || '/index.html' AS source_path, '../Part/' || (p_partkey + 1) AS href FROM part")
def q_class_see_also(spark, d):
    """Hrefs of linked anchors in ``div#seealso``."""
    hrefs = F.transform("see_also", lambda h: F.struct(h.alias("href")))
    return N.explode_rows(_x1c_detail(spark, d), ["source_path"], hrefs)


VALUE_DETAIL_SQL = with_ctes(X3_CTE) + """
SELECT source_path, CASE WHEN n_nationkey % 2 = 0 THEN 'enum ' || n_name ELSE n_name END AS {name},
       'Customers of ' || n_name AS short_description, reg || ' > ' || n_name AS navigation,
       reg AS module, '' AS header, CAST(NULL AS VARCHAR) AS include,
       'enum ' || n_name || '{{ ' || n_nationkey || ' }}' AS syntax, CAST(n AS BIGINT) AS n_values, 'Region' || reg AS remarks
FROM x3"""


def _value_detail(spark, d, name_col):
    det = D.value_page_detail(parsed(spark, d, "x3_enum_pages"), name_col, keep=["source_path"])
    return det.select("source_path", name_col, "short_description", F.array_join("navigation", " > ").alias("navigation"),
                      "module", "header", "include", "syntax", F.size("values").cast("long").alias("n_values"), "remarks")


@register("enum_detail", VALUE_DETAIL_SQL.format(name="enum_name"))
def q_enum_detail(spark, d):
    """Enum pages (syntax with no separator, missing reference p → '')."""
    return _value_detail(spark, d, "enum_name")


@register("constant_detail", VALUE_DETAIL_SQL.format(name="constant_name"))
def q_constant_detail(spark, d):
    """Constant pages (same parser, keyed ``constant_name``)."""
    return _value_detail(spark, d, "constant_name")


FUNCTION_DETAIL_SQL = with_ctes(X2_CTE) + """
SELECT folder,
       CASE WHEN o_orderkey % 2 = 0 THEN 'function Order' || o_orderkey ELSE 'Order' || o_orderkey || ' overloads' END
         AS function_name,
       'Order of customer ' || o_custkey AS short_description, 'Orders > ' || o_orderpriority || ' > ' || nat AS navigation,
       CAST(n AS BIGINT) AS n_overloads
FROM x2"""


def _function_rows(det: DataFrame) -> DataFrame:
    return det.select("folder", "function_name", "short_description", F.array_join("navigation", " > ").alias("navigation"),
                      F.size("overloads").cast("long").alias("n_overloads"))


@register("function_detail", FUNCTION_DETAIL_SQL)
def q_function_detail(spark, d):
    """Function pages with the folder they live in."""
    pages = parsed(spark, d, "x2_function_pages").withColumn(
        "folder", F.element_at(F.split("source_path", "/"), 2))
    return _function_rows(D.function_detail(pages, keep=["folder"]))


@register("function_folder_join", FUNCTION_DETAIL_SQL)
def q_function_folder_join(spark, d):
    """S6 + J2: folders (from the page listing, plus folders with no page) ⋈ pages."""
    pages = parsed(spark, d, "x2_function_pages")
    # the listing has the paths alone: no page is rendered for it
    listed = L.function_folders(X.x2_function_pages(spark, d).select("source_path"))
    ghosts = tbl(spark, d, "orders").select(F.concat(F.lit("empty-"), F.col("o_orderkey").cast("string")).alias("folder"))
    return _function_rows(L.function_folder_join(listed.unionByName(ghosts), pages))


# ============================================================ S5, F6, J1 (links)
def _x4_links(spark, d, require_href):
    return L.link_index(parsed(spark, d, "x4_index_pages"), require_href=require_href)


@register("link_index", with_ctes(X4_CTE) + "SELECT index_path, name, relative_url FROM x4_links WHERE NOT no_first_href")
def q_link_index(spark, d):
    """S5 (class index): first ``a#content_link`` per item, dropped without href."""
    return _x4_links(spark, d, False).select("index_path", "name", "relative_url")


@register("link_index_enum", with_ctes(X4_CTE) + "SELECT index_path, name, relative_url FROM x4_links")
def q_link_index_enum(spark, d):
    """S5 (enum/constant index): first ``a#content_link`` that has an href."""
    return _x4_links(spark, d, True).select("index_path", "name", "relative_url")


@register("resolve_links", with_ctes(X4_CTE) + """
SELECT relative_url, substr(relative_url, 4) || '/index.html' AS page_path FROM x4_links WHERE NOT no_first_href""")
def q_resolve_links(spark, d):
    """first ``../`` removed, joined with ``index.html``, normalised."""
    return _x4_links(spark, d, False).select("relative_url", TX.resolve_link(F.lit(""), F.col("relative_url")).alias("page_path"))


@register("index_detail_join", with_ctes(X4_CTE) + """
SELECT l.name AS class_name, l.relative_url,
       CASE WHEN p.p_partkey IS NULL THEN NULL WHEN p.p_partkey % 2 = 0 THEN p.p_type || ' summary'
            ELSE p.p_type || ' intro' END AS short_description,
       CAST(CASE WHEN p.p_partkey IS NULL THEN 0 ELSE 3 END AS BIGINT) AS n_variables,
       p.p_brand AS module
FROM x4_links l LEFT JOIN part p ON p.p_partkey = l.p_partkey
WHERE NOT l.no_first_href""")
def q_index_detail_join(spark, d):
    """Index links ⋈ class-detail pages, left outer (a dead link keeps its row)."""
    j = L.class_index_detail(parsed(spark, d, "x4_index_pages"), parsed(spark, d, "x1c_class_detail_pages"))
    return j.select("class_name", "relative_url", "short_description", F.size("variables").cast("long").alias("n_variables"),
                    "module")


def value_index_sql(name: str) -> str:
    return VALUE_DETAIL_SQL.format(name="page_name").replace("\nSELECT source_path", ", v AS (SELECT source_path", 1) + f""")
SELECT x3.n_name AS {name}, '../' || regexp_replace(source_path, '/index.html$', '') AS relative_url, source_path AS page_path,
       short_description, navigation, v.module, header, include, syntax, n_values, remarks
FROM v JOIN x3 USING (source_path) WHERE reg <> ''
UNION ALL
SELECT 'Ghost ' || r_name, '../Enums/missing-' || r_regionkey, 'Enums/missing-' || r_regionkey || '/index.html', NULL, '', NULL, NULL, NULL, NULL, 0, NULL
FROM region WHERE r_name IN (SELECT reg FROM x3)"""


def _value_index_detail(spark, d, name_col):
    j = L.value_index_detail(parsed(spark, d, "x9_value_index_pages"), parsed(spark, d, "x3_enum_pages"), name_col)
    return j.select(name_col, "relative_url", "page_path", "short_description", F.array_join("navigation", " > ").alias("navigation"), "module", "header",
                    "include", "syntax", F.size("values").cast("long").alias("n_values"), "remarks")


@register("enum_index_detail", value_index_sql("enum_name"))
def q_enum_index_detail(spark, d):
    """J1 (enums): index links ⋈ enum pages, left outer; the index's name wins."""
    return _value_index_detail(spark, d, "enum_name")


@register("constant_index_detail", value_index_sql("constant_name"))
def q_constant_index_detail(spark, d):
    """J1 (constants): the same join, keyed ``constant_name``."""
    return _value_index_detail(spark, d, "constant_name")


# ============================================================ S2, P1, U1, F5, J6 on pages
SCAN_SQL = """
SELECT regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) AS category,
       regexp_extract(url, '^[a-z]+://[^/]+/[^/?#]+/?([^?#]*)', 1) AS source_path, page_id
FROM pages WHERE regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) NOT IN ('es')"""


@register("scan_categories", SCAN_SQL)
def q_scan_categories(spark, d):
    """Pages per category (first url segment), excluded categories
    (trimmed, lower-cased, empties dropped) removed before anything else."""
    from docweave.sources.files import exclude_categories

    return exclude_categories(url_pages(spark, d), [" ES ", "", "  "]).select("category", "source_path", "page_id")


@register("safe_key", """
SELECT page_id, regexp_replace(replace(replace(url, '\\', '__'), '/', '__'), '[\\\\/:*?"<>|]', '_', 'g') AS safe_key
FROM pages""")
def q_safe_key(spark, d):
    """file-name-safe key of each url."""
    return tbl(spark, d, "pages").select("page_id", TX.safe_key(F.col("url")).alias("safe_key"))


URL_CATEGORY = "regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1)"


@register("incremental_pages", f"""
WITH p AS (SELECT page_id, url, {URL_CATEGORY} AS category FROM pages),
done AS (SELECT category, url FROM p WHERE page_id IN (SELECT doc_id FROM labels))
SELECT page_id, category, url FROM p WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.category = p.category AND d.url = p.url)""")
def q_incremental_pages(spark, d):
    """Pages whose output already exists (here: the labelled ones) are
    skipped, by their exact category and path."""
    pages = url_pages(spark, d).select("page_id", "category", F.col("url").alias("source_path"))
    done = pages.join(tbl(spark, d, "labels").select(F.col("doc_id").alias("page_id")), "page_id", "left_semi")
    return Q.only_new(pages, done).select("page_id", "category", F.col("source_path").alias("url"))


# ============================================================ curation on documents / X6
WS_DUCK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def duck_clean(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS_DUCK}', ' ', 'g'))"


@register("clean_text", f"SELECT doc_id, {duck_clean('text')} AS cleaned FROM documents")
def q_clean_text(spark, d):
    """Strip + collapse every whitespace run (Python's notion of whitespace)."""
    return tbl(spark, d, "documents").select("doc_id", TX.clean_text(F.col("text")).alias("cleaned"))


@register("dedupe_documents", "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def q_dedupe_documents(spark, d):
    """A1 on documents: one row per exact text, the first doc_id wins."""
    docs = tbl(spark, d, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    return C.dedupe(docs, key=["text_md5"], order=[F.col("doc_id")], unique_order=True).select("doc_id", "text_md5")


@register("dedupe_records", """
SELECT doc_id, source, lang, md5(text) AS text_md5, 'first' AS kept FROM documents WHERE source <> '' AND lang <> ''
QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1
UNION ALL SELECT doc_id, source, lang, md5(text), 'last' FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1
UNION ALL SELECT min(doc_id), NULL, NULL, md5(text), 'text' FROM documents WHERE text <> '' GROUP BY text""")
def q_dedupe_records(spark, d):
    """A1, A2 on whole documents and hot keys: the first of each source and
    language, the last of each source, the first of each text; the winners are
    read at their address."""
    docs = tbl(spark, d, "documents")
    first = C.dedupe(docs, key=["source", "lang"], order=[F.col("doc_id")], by_address=True)
    last = C.last_wins(docs, "source", "doc_id", by_address=True)
    text = C.dedupe(docs, key=["text"], order=[F.col("doc_id")], by_address=True).withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    out = [f.select("doc_id", "source", "lang", F.md5("text").alias("text_md5"), F.lit(n).alias("kept")) for f, n in ((first, "first"), (last, "last"), (text, "text"))]
    return out[0].unionByName(out[1]).unionByName(out[2])


X6_CTE = """
x6 AS (
  SELECT doc_id AS line_no, CASE WHEN lang IN ('en', 'de') THEN 'developer' ELSE 'runtime' END AS category,
         doc_id % 17 = 0 AS bad, lang, source, text,
         CASE WHEN doc_id % 23 = 0 THEN '' ELSE 'Docs/' || md5(text) END AS source_path,
         CASE doc_id % 3 WHEN 0 THEN 'class' WHEN 1 THEN 'function' ELSE 'enum' END AS entity_type
  FROM documents)"""


@register("read_entities_tolerant", with_ctes(X6_CTE) + """
SELECT category, line_no, text AS name, entity_type, source_path FROM x6 WHERE NOT bad""")
def q_read_entities_tolerant(spark, d):
    """Typed entities from NDJSON lines; malformed lines skipped, never fatal."""
    return C.good_entities(x6_parsed(spark, d)).select("category", "line_no", "name", "entity_type", "source_path")


@register("dead_letters", with_ctes(X6_CTE) + """
SELECT category, line_no, 'malformed JSON line' AS error FROM x6 WHERE bad
UNION ALL SELECT 'web', page_id, 'no content' FROM pages WHERE url LIKE '%#top'""")
def q_dead_letters(spark, d):
    """Q5: which line failed and why (shredder errors and bad JSON lines)."""
    bad_json = C.bad_lines(x6_parsed(spark, d)).select("category", "line_no", "error")
    # pages addressed by a fragment count as fetched without content
    html = F.when(~F.endswith("url", F.lit("#top")), F.col("html"))
    bad_pages = shred(tbl(spark, d, "pages").select(F.lit("web").alias("category"), F.col("page_id").alias("line_no"), html.alias("html")),
                      keep=["category", "line_no"], spread=True)
    bad_pages = bad_pages.filter(F.col("shred_error").isNotNull()).select("category", "line_no", F.col("shred_error").alias("error"))
    return Q.dead_letters(bad_json, bad_pages)


@register("sanitize_entities", with_ctes(X6_CTE) + f"""
SELECT category, line_no,
       {duck_clean('text')} AS name,
       lang || ' doc ' || line_no AS short_description,
       CASE WHEN line_no % 10 = 2 THEN '' ELSE lang || '|' || source END AS navigation,
       CASE line_no % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE {duck_clean('source')} END AS module,
       '' AS header, '' AS include, '' AS syntax,
       CASE line_no % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE source || ' ' || lang END AS remarks,
       entity_type, source_path
FROM x6 WHERE NOT bad""")
def q_sanitize_entities(spark, d):
    """Fixed 10 fields, defaults only for missing keys, strings cleaned."""
    s = C.sanitize(x6_parsed(spark, d))
    return s.select("category", "line_no", "name", "short_description", F.array_join("navigation", "|").alias("navigation"),
                    "module", "header", "include", "syntax", "remarks", "entity_type", "source_path")


@register("sanitize_errors", with_ctes(X6_CTE) + """
SELECT category, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_errors
FROM x6 GROUP BY category""")
def q_sanitize_errors(spark, d):
    """Lines that could not be parsed, per category."""
    return C.sanitize_errors(x6_parsed(spark, d), by=["category"])


DEDUPE_SQL = with_ctes(X6_CTE) + """
SELECT source_path, arg_min(category, (CASE category WHEN 'developer' THEN 1 ELSE 3 END, line_no)) AS category,
       arg_min(line_no, (CASE category WHEN 'developer' THEN 1 ELSE 3 END, line_no)) AS line_no
FROM x6 WHERE NOT bad AND source_path <> '' GROUP BY source_path"""


@register("dedupe_entities", DEDUPE_SQL)
def q_dedupe_entities(spark, d):
    """A1 + P5: one entity per source_path, first by (category precedence, line)."""
    good = C.good_entities(x6_parsed(spark, d)).select("source_path", "category", F.col("line_no").alias("line"))
    return C.dedupe(good, key=["source_path"], unique_order=True).select("source_path", "category", F.col("line").alias("line_no"))


@register("position_index", with_ctes(X6_CTE) + """
SELECT category, source_path, max(line) AS line FROM (
  SELECT category, source_path, CAST(row_number() OVER (PARTITION BY category ORDER BY line_no) - 1 AS BIGINT) AS line
  FROM x6 WHERE NOT bad) GROUP BY category, source_path""")
def q_position_index(spark, d):
    """K6: 0-based line of each source_path in its category's output; last wins."""
    good = C.good_entities(x6_parsed(spark, d)).select("category", "source_path", "line_no")
    return K.position_index(good, "category", order=["line_no"])


@register("resume_from_line", with_ctes(X6_CTE) + """
SELECT category, source_path, line FROM (
  SELECT category, source_path, CAST(row_number() OVER (PARTITION BY category ORDER BY line_no) - 1 AS BIGINT) AS line
  FROM x6 WHERE NOT bad) WHERE line >= 100""")
def q_resume_from_line(spark, d):
    """K7: restart at output line 100 of each category (rows from there on)."""
    good = C.good_entities(x6_parsed(spark, d)).select("category", "source_path", "line_no")
    numbered = K.line_numbers(good, "category", ["line_no"])
    return K.resume(numbered, 100).select("category", "source_path", "line")


@register("dataset_counts", with_ctes(X6_CTE) + """
SELECT category, 'part-' || (line_no % 7) AS file, CAST(count(*) AS BIGINT) AS n_records,
       CAST(count(DISTINCT category || (line_no % 7)) AS BIGINT) AS n_files
FROM x6 GROUP BY ROLLUP (category, 'part-' || (line_no % 7))""")
def q_dataset_counts(spark, d):
    """A4: records per file, per category and in all (null keys), and the number of files."""
    lines = X.x6_entity_lines(spark, d).withColumn("file", F.concat(F.lit("part-"), F.pmod("line_no", F.lit(7)).cast("string")))
    return Q.record_counts(lines, "category", "file")


@register("run_metrics", with_ctes(X6_CTE) + """
SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_errors,
       CAST(count(*) FILTER (WHERE NOT bad AND source_path = '') AS BIGINT) AS n_empty_key,
       CAST(count(DISTINCT source_path) FILTER (WHERE NOT bad AND source_path <> '') AS BIGINT) AS n_unique_keys
FROM x6""")
def q_run_metrics(spark, d):
    """Run counters (lines, parse errors, empty keys, kept after dedupe)."""
    p = x6_parsed(spark, d).select("_bad", F.col("_e.source_path").alias("sp"))
    return p.agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("_bad").cast("long").alias("n_errors"),
        F.count_if(~F.col("_bad") & (F.col("sp") == "")).cast("long").alias("n_empty_key"),
        F.countDistinct(F.when(~F.col("_bad") & (F.col("sp") != ""), F.col("sp"))).cast("long").alias("n_unique_keys"),
    )


@register("run_metrics_stream", with_ctes(X6_CTE) + """
SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_errors,
       CAST(count(*) FILTER (WHERE NOT bad AND source_path = '') AS BIGINT) AS n_empty_key FROM x6""")
def q_run_metrics_stream(spark, d):
    """A6 of a stream: the counters of each micro-batch, added up as it reports."""
    from docweave.streaming.metrics import StreamMetrics, observed

    src, base = _scratch(spark, "metric_lines"), _scratch(spark, "metric_stream")
    X.x6_entity_lines(spark, d).repartition(6).write.parquet(src)
    lines = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 2).parquet(src)
    keyed = C.parse_entity_lines(lines).select("_bad", F.col("_e.source_path").alias("sp"))
    counted = observed(keyed, "lines", n_lines=F.count(F.lit(1)), n_errors=F.count_if("_bad"), n_empty_key=F.count_if(~F.col("_bad") & (F.col("sp") == "")))
    metrics = StreamMetrics("lines")
    spark.streams.addListener(metrics)
    try:
        counted.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
        totals = metrics.totals()
    finally:
        spark.streams.removeListener(metrics)
    # counters of the run, read from its reports: one row
    return spark.createDataFrame([totals], "n_lines long, n_errors long, n_empty_key long")


@register("class_last_wins", with_ctes(X1_CTE) + """
SELECT name, max(source_path) AS source_path FROM (
  SELECT CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE 'class ' || p_name END AS name, source_path FROM x1)
GROUP BY name""")
def q_class_last_wins(spark, d):
    """A2: per class name, the last entity (in output order) wins."""
    e = _x1_entities(spark, d).filter(F.col("entity_type") == "class").select("name", "source_path")
    return C.last_wins(e, "name", "source_path", unique_order=True)


@register("sample_records", """
SELECT doc_id + 1 AS line_no, substr(regexp_replace(text, '^[\\s]+|[\\s]+$', '', 'g'), 1, 500) AS snippet
FROM documents ORDER BY md5('42:' || doc_id) LIMIT 10""")
def q_sample_records(spark, d):
    """10 lines by a seeded hash, numbered from 1, stripped and cut to 500
    characters (the table's ids are its line numbers from 0)."""
    return Q.sample_records(tbl(spark, d, "documents"), "doc_id", "text", k=10, seed=42, width=500)


# ============================================================ hierarchy
@register("hierarchy_edges", with_ctes(X5_CTE) + """
SELECT source_path, name, link, parent, CAST(depth AS BIGINT) AS depth FROM x5_cells WHERE depth <= 10""")
def q_hierarchy_edges(spark, d):
    """One row per label cell of each hierarchy page (each shard page
    repeats the region and nation rows above its suppliers)."""
    e = H.hierarchy_edges(parsed(spark, d, "x5_hierarchy_pages"), 10)
    return e.select("source_path", "name", "link", "parent", F.col("depth").cast("long").alias("depth"))


@register("hierarchy_deep", with_ctes(X5_CTE) + """
SELECT name, parent, CAST(depth AS BIGINT) AS depth FROM x5_all""")
def q_hierarchy_deep(spark, d):
    """E18 without a depth limit."""
    return hierarchy_flat(spark, d, None).select("name", "parent", F.col("depth").cast("long").alias("depth"))


@register("hierarchy_flat", with_ctes(X5_CTE) + "SELECT name, link, parent, CAST(depth AS BIGINT) AS depth FROM x5_nodes")
def q_hierarchy_flat(spark, d):
    """H1: the tree as one row per position (all shards merged)."""
    return hierarchy_flat(spark, d).select("name", "link", "parent", F.col("depth").cast("long").alias("depth"))


@register("hierarchy_depth", with_ctes(X5_CTE) + """
SELECT CAST(depth AS BIGINT) AS depth, CAST(count(*) AS BIGINT) AS n_nodes FROM x5_nodes WHERE depth <= 1 GROUP BY depth""")
def q_hierarchy_depth(spark, d):
    """H2: depth-limited parse (max_depth = 1): nodes per depth."""
    f = hierarchy_flat(spark, d, max_depth=1)
    return f.groupBy(F.col("depth").cast("long").alias("depth")).agg(F.count(F.lit(1)).alias("n_nodes"))


@register("hierarchy_children", with_ctes(X5_CTE) + """
SELECT parent, CAST(count(*) AS BIGINT) AS n_children, arg_min(name, ord) AS first_child, arg_max(name, ord) AS last_child
FROM x5_nodes WHERE parent IS NOT NULL GROUP BY parent""")
def q_hierarchy_children(spark, d):
    """A3: fan-out per parent with its first and last child in document order."""
    return H.hierarchy_children(hierarchy_flat(spark, d))


@register("hierarchy_child_rows", with_ctes(X5_CTE) + """
SELECT parent, name, CAST(row_number() OVER (PARTITION BY parent ORDER BY ord) - 1 AS BIGINT) AS nth
FROM x5_all WHERE parent IS NOT NULL""")
def q_hierarchy_child_rows(spark, d):
    """A3/H1: the children of every parent in document order, numbered without a
    window over a parent's children."""
    rows = H.hierarchy_child_rows(hierarchy_flat(spark, d, None))
    return K.line_numbers(rows, "parent", ["ord"], out="nth").select("parent", "name", "nth")


@register("hierarchy_roots", with_ctes(X5_CTE) + "SELECT name FROM x5_nodes WHERE depth = 0")
def q_hierarchy_roots(spark, d):
    """Names that are nobody's child."""
    return H.hierarchy_roots(hierarchy_flat(spark, d))


@register("hierarchy_walk", with_ctes(X5_CTE, WALK_CTE) + """
SELECT root, name, CAST(depth AS BIGINT) AS depth, array_to_string(path, '/') AS path FROM walk""")
def q_hierarchy_walk(spark, d):
    """H3: pre-order walk from every root (recursive CTE), path as text."""
    w = H.hierarchy_walk(spark, hierarchy_flat(spark, d, None))
    return w.select("root", "name", F.col("depth").cast("long").alias("depth"), F.array_join("path", "/").alias("path"))


@register("hierarchy_intervals", with_ctes(X5_CTE, WALK_CTE) + """,
numbered AS (SELECT name, path, row_number() OVER (ORDER BY places) AS pre FROM walk)
SELECT a.name, CAST(a.pre AS BIGINT) AS pre, CAST(count(*) AS BIGINT) AS size
FROM numbered a JOIN numbered b ON b.path[1:len(a.path)] = a.path GROUP BY a.name, a.path, a.pre""")
def q_hierarchy_intervals(spark, d):
    """Every node's pre-order number and its subtree's size; a node lies
    below another where its number is in the other's interval.  No path is built."""
    w = H.hierarchy_walk(spark, hierarchy_flat(spark, d, None), paths=False)
    return w.select("name", F.col("places")[0].alias("pre"), "size")


@register("hierarchy_closure", with_ctes(X5_CTE, WALK_CTE) + """
SELECT anc, name, CAST(min(len(path) - i) AS BIGINT) AS depth
FROM (SELECT name, path, unnest(path) AS anc, generate_subscripts(path, 1) AS i FROM walk) WHERE i < len(path) GROUP BY anc, name""")
def q_hierarchy_closure(spark, d):
    """H4: every ancestor/descendant pair with its distance."""
    c = H.hierarchy_closure(spark, hierarchy_flat(spark, d, None))
    return c.select("anc", "name", F.col("depth").cast("long").alias("depth"))


# --- organise by hierarchy (J3–J5, H5–H8) ---------------------------------
def _organize_inputs(spark, d):
    """The entities with their line, and the tree; extracted once per session (written)."""
    ents = _materialized(spark, d, "organize_entities", lambda: doc_entities(spark, d).withColumn(
        "line", F.struct(C.category_rank(F.col("category")).alias("c"), F.col("source_path").alias("p"))).select(*C.SANITIZED_FIELDS, "line"))
    return ents, _materialized(spark, d, "organize_tree", lambda: hierarchy_flat(spark, d, None))


RELATED_SQL = with_ctes(X2_CTE, X3_CTE, X5_CTE, X8_CTE) + """,
hn AS (SELECT DISTINCT name FROM x5_all),
rel AS (
  SELECT nat AS class_name, source_path, 'function' AS entity_type,
         CASE WHEN o_orderkey % 2 = 0 THEN 'function Order' || o_orderkey ELSE 'Order' || o_orderkey || ' overloads' END AS name,
         2 AS nav_pos, 3 AS seg_rank
  FROM x2 WHERE nat IN (SELECT name FROM hn)
  UNION ALL
  SELECT reg, source_path, 'enum', CASE WHEN n_nationkey % 2 = 0 THEN 'enum ' || n_name ELSE n_name END, 0, 2
  FROM x3 WHERE reg IN (SELECT name FROM hn)
  UNION ALL
  SELECT n_name, source_path, 'enum', CASE WHEN n_nationkey % 2 = 0 THEN 'enum ' || n_name ELSE n_name END, 1, 2
  FROM x3 WHERE n_name IN (SELECT name FROM hn)
  UNION ALL
  SELECT crumb, source_path, 'function', 'function ' || seg, 0, 4 FROM x8 WHERE crumb IN (SELECT name FROM hn))"""


@register("related_entities", RELATED_SQL + " SELECT class_name, source_path, CAST(nav_pos AS BIGINT) AS nav_pos FROM rel")
def q_related_entities(spark, d):
    """Non-class entities × crumbs that name a hierarchy class."""
    ents, flat = _organize_inputs(spark, d)
    _, others = H.split_entities(ents)
    r = H.related_entities(others, flat.select("name"))
    return r.select("class_name", "source_path", F.col("nav_pos").cast("long").alias("nav_pos"))


@register("related_counts", RELATED_SQL + " SELECT class_name, CAST(count(*) AS BIGINT) AS n_related FROM rel GROUP BY class_name")
def q_related_counts(spark, d):
    """Size of each class's related-entity group."""
    ents, flat = _organize_inputs(spark, d)
    _, others = H.split_entities(ents)
    return H.related_counts(H.related_entities(others, flat.select("name")))


CLS_CTE = """
cls AS (
  SELECT name, arg_max(source_path, (c, source_path)) AS source_path FROM (
    SELECT nm AS name, source_path, 0 AS c FROM x7
    UNION ALL
    SELECT CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE 'class ' || p_name END, source_path, 1 FROM x1)
  GROUP BY name)"""
CLASSES_SQL = with_ctes(X1_CTE, X7_CTE, X5_CTE, CLS_CTE)


@register("hier_classes", CLASSES_SQL + " SELECT name, source_path FROM cls WHERE name IN (SELECT name FROM x5_all)")
def q_hier_classes(spark, d):
    """Hierarchy nodes ⋈ their class entity (after last-wins by name)."""
    ents, flat = _organize_inputs(spark, d)
    classes, _ = H.split_entities(ents)
    return classes.join(flat.select("name").distinct(), "name").select("name", "source_path")


@register("hier_unattached_classes", CLASSES_SQL + " SELECT name, source_path FROM cls WHERE name NOT IN (SELECT name FROM x5_all)")
def q_hier_unattached_classes(spark, d):
    """Classes the walk never reaches."""
    ents, flat = _organize_inputs(spark, d)
    classes, _ = H.split_entities(ents)
    return classes.join(flat.select("name").distinct(), "name", "left_anti").select("name", "source_path")


@register("hier_unattached_other", RELATED_SQL + """,
others AS (SELECT source_path FROM x2 UNION ALL SELECT source_path FROM x3 UNION ALL SELECT source_path FROM x8)
SELECT source_path FROM others WHERE source_path NOT IN (SELECT source_path FROM rel)""")
def q_hier_unattached_other(spark, d):
    """Non-class entities attached to no class."""
    ents, flat = _organize_inputs(spark, d)
    _, others = H.split_entities(ents)
    attached = H.related_entities(others, flat.select("name")).select("source_path").distinct()
    return others.select("source_path").join(attached, "source_path", "left_anti")


ORGANIZE_SQL = with_ctes(X1_CTE, X2_CTE, X3_CTE, X7_CTE, X8_CTE, X5_CTE, WALK_CTE, CLS_CTE) + """,
ent AS (""" + ENTITIES_SQL[ENTITIES_SQL.index("SELECT 'developer' AS category"):] + """),
crumbs AS (SELECT source_path, unnest(string_split(navigation, ' > ')) AS crumb FROM ent WHERE entity_type <> 'class'),
rel AS (SELECT crumb, source_path FROM crumbs WHERE crumb IN (SELECT name FROM walk)),
placed AS (
  SELECT 1 AS segment, array_to_string(w.path, '/') AS path, array_to_string(w.places, '/') AS places, 0 AS kind, c.source_path
  FROM walk w JOIN cls c ON c.name = w.name
  UNION ALL
  SELECT 1, array_to_string(w.path, '/'), array_to_string(w.places, '/'), 1, r.source_path FROM walk w JOIN rel r ON r.crumb = w.name
  UNION ALL
  SELECT 2, '', '', 0, source_path FROM cls WHERE name NOT IN (SELECT name FROM walk)
  UNION ALL
  SELECT 3, '', '', 1, source_path FROM ent WHERE entity_type <> 'class' AND source_path NOT IN (SELECT source_path FROM rel))
SELECT CAST(segment AS BIGINT) AS segment, path, CAST(kind AS BIGINT) AS kind, ent.* EXCLUDE (n_members, category)
FROM placed JOIN ent USING (source_path)"""


def _organized(spark, d):
    """H8's rows, worked out once per session (written)."""
    ents, flat = _organize_inputs(spark, d)
    return _materialized(spark, d, "organized", lambda: H.organize_by_hierarchy(spark, ents, flat)), C.SANITIZED_FIELDS


@register("organize_by_hierarchy", ORGANIZE_SQL)
def q_organize_by_hierarchy(spark, d):
    """H8: the hierarchy-ordered output with the whole record;
    ``ORDER BY segment, places, kind, ord`` is the write order."""
    o, fields = _organized(spark, d)
    return o.select(F.col("segment").cast("long").alias("segment"), F.array_join("path", "/").alias("path"),
                    F.col("kind").cast("long").alias("kind"),
                    *[F.array_join(f, " > ").alias(f) if f == "navigation" else f for f in fields])


@register("organize_order", ORGANIZE_SQL[:ORGANIZE_SQL.rindex("SELECT CAST(segment")] + """
SELECT CAST(row_number() OVER (ORDER BY segment, places, kind, CASE WHEN segment = 2 THEN f.c ELSE e.c END,
                               CASE WHEN segment = 2 THEN f.source_path ELSE e.source_path END) - 1 AS BIGINT) AS nth, e.source_path
FROM placed JOIN (SELECT source_path, name, CASE category WHEN 'editor' THEN 0 WHEN 'developer' THEN 1 WHEN 'plugins' THEN 2
                  WHEN 'runtime' THEN 3 ELSE 4 END AS c FROM ent) e USING (source_path)
LEFT JOIN (SELECT name, min(struct_pack(c := CASE category WHEN 'editor' THEN 0 WHEN 'developer' THEN 1 ELSE 2 END,
                  source_path := source_path)) AS f FROM ent WHERE entity_type = 'class' GROUP BY name) USING (name)""")
def q_organize_order(spark, d):
    """The line on which each record of the hierarchical output is written."""
    o, _ = _organized(spark, d)
    rows = o.select(F.lit(0).alias("_g"), "segment", "places", "kind", "ord", "source_path")
    return K.line_numbers(rows, "_g", ["segment", "places", "kind", "ord"], out="nth").select("nth", "source_path")


# ============================================================ quality on tables
@register("manifest_missing", """
WITH exp AS (SELECT DISTINCT source AS folder, CAST(doc_id AS VARCHAR) AS file FROM documents),
act AS (SELECT DISTINCT 'src' || ((doc_id + quality) % 20) AS folder, CAST(doc_id AS VARCHAR) AS file FROM labels),
pf AS (SELECT DISTINCT folder FROM act)
SELECT DISTINCT folder, CAST(NULL AS VARCHAR) AS file, 'missing folder' AS issue FROM exp WHERE folder NOT IN (SELECT folder FROM pf)
UNION ALL
SELECT folder, file, 'missing file' FROM exp e
WHERE folder IN (SELECT folder FROM pf) AND NOT EXISTS (SELECT 1 FROM act a WHERE a.folder = e.folder AND a.file = e.file)""")
def q_manifest_missing(spark, d):
    """Q1: expected (source folder, doc) vs present (labelled docs, some filed in the next folder)."""
    exp, act = _manifest(spark, d)
    return Q.manifest_missing(exp, act)


def _manifest(spark, d):
    exp = tbl(spark, d, "documents").select(F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("file")).distinct()
    act = tbl(spark, d, "labels").select(
        F.concat(F.lit("src"), F.pmod(F.col("doc_id") + F.col("quality"), F.lit(20)).cast("string")).alias("folder"),
        F.col("doc_id").cast("string").alias("file")).distinct()
    return exp, act


@register("manifest_misplaced", """
WITH exp AS (SELECT DISTINCT source AS folder, CAST(doc_id AS VARCHAR) AS file FROM documents),
act AS (SELECT DISTINCT 'src' || ((doc_id + quality) % 20) AS folder, CAST(doc_id AS VARCHAR) AS file FROM labels)
SELECT folder, file, 'misplaced file' AS issue FROM act a
WHERE folder IN (SELECT folder FROM exp) AND NOT EXISTS (SELECT 1 FROM exp e WHERE e.folder = a.folder AND e.file = a.file)""")
def q_manifest_misplaced(spark, d):
    """Q2: present files not expected, in folders that have an expected list."""
    exp, act = _manifest(spark, d)
    return Q.manifest_misplaced(exp, act)


@register("missing_inputs", with_ctes(X6_CTE) + """,
req AS (SELECT * FROM (VALUES ('entities', 'editor'), ('entities', 'developer'), ('entities', 'plugins'),
        ('entities', 'runtime'), ('pages', 'en'), ('pages', 'fr'), ('pages', 'de'), ('pages', 'es'), ('pages', 'it'))
        t(dataset, category)),
pres AS (SELECT DISTINCT 'entities' AS dataset, category FROM x6
         UNION SELECT DISTINCT 'pages', regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) FROM pages)
SELECT dataset, category, true AS blocks_stage FROM req
WHERE NOT EXISTS (SELECT 1 FROM pres p WHERE p.dataset = req.dataset AND p.category = req.category)""")
def q_missing_inputs(spark, d):
    """Q3: required (dataset, category) partitions that are absent."""
    req = spark.createDataFrame(
        [("entities", c) for c in C.CATEGORY_ORDER] + [("pages", c) for c in ("en", "fr", "de", "es", "it")],
        "dataset string, category string")
    pres = X.x6_entity_lines(spark, d).select(F.lit("entities").alias("dataset"), "category").unionByName(
        url_pages(spark, d).select(F.lit("pages").alias("dataset"), "category"))
    return Q.missing_inputs(req, pres)


@register("folder_counts", """
WITH f AS (SELECT regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) AS folder FROM pages),
c AS (SELECT folder, count(*) AS n FROM f GROUP BY folder)
SELECT e.folder, CAST(coalesce(c.n, 0) AS BIGINT) AS n_files
FROM (VALUES ('de'), ('en'), ('es'), ('fr'), ('it')) e(folder) LEFT JOIN c ON c.folder = e.folder""")
def q_folder_counts(spark, d):
    """A5: files per expected folder, 0 for a folder with none."""
    files = url_pages(spark, d).select(F.col("category").alias("folder"))
    folders = spark.createDataFrame([(f,) for f in ("de", "en", "es", "fr", "it")], "folder string")
    return Q.folder_counts(files, folders)


# events as progress reports: every third has no status; one category never reports
REPORTS_SQL = """
r AS (SELECT event_type AS category, ts, event_id, user_id AS count,
             CASE WHEN event_id % 3 <> 0 THEN 'Extracting ' || user_id END AS status FROM events),
cats AS (SELECT DISTINCT event_type AS category FROM events UNION SELECT 'archive'),
latest AS (
  SELECT category, arg_max(count, (ts, event_id)) AS count, arg_max(status, (ts, event_id)) FILTER (WHERE status IS NOT NULL) AS status,
         max(ts) AS heartbeat FROM r GROUP BY category)"""


def _reports(events: DataFrame) -> DataFrame:
    status = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("Extracting "), F.col("user_id").cast("string")))
    return events.select(F.col("event_type").alias("category"), "ts", "event_id", F.col("user_id").alias("count"), status.alias("status"))


def _categories(spark, d) -> DataFrame:
    never = spark.range(1).select(F.lit("archive").alias("category"))
    return tbl(spark, d, "events").select(F.col("event_type").alias("category")).distinct().unionByName(never)


HEARTBEAT_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', heartbeat)"


@register("category_progress", "WITH " + REPORTS_SQL.strip() + """,
a AS (SELECT max(heartbeat) AS as_of FROM latest)
SELECT c.category, coalesce(l.count, 0) AS count, coalesce(l.status, 'Idle') AS status, epoch_us(l.heartbeat) AS heartbeat_us,
       CAST(epoch_us(a.as_of) - epoch_us(l.heartbeat) AS BIGINT) AS age_us,
       coalesce(epoch_us(a.as_of) - epoch_us(l.heartbeat) > 30000000, false) AS stale,
       coalesce(strftime(l.heartbeat, '%Y-%m-%d %H:%M:%S'), '-') AS last_update
FROM cats c LEFT JOIN latest l USING (category), a""")
def q_category_progress(spark, d):
    """W1 (batch form): latest count, last given status and heartbeat of every
    listed category, stale after 30 s."""
    p = category_progress(_reports(tbl(spark, d, "events")), _categories(spark, d))
    return p.select("category", "count", "status", F.expr(HEARTBEAT_US).alias("heartbeat_us"),
                    (F.col("age_seconds") * 1_000_000).cast("long").alias("age_us"), "stale", "last_update")


@register("stream_extract", "WITH RECURSIVE e AS (" + ENTITIES_SQL + """)
SELECT * FROM e
UNION ALL SELECT 'mirror', source_path, entity_type, name, short_description, navigation, module, header, include, syntax, remarks, n_members
FROM e WHERE category = 'editor'
UNION ALL SELECT 'mirror', replace(source_path, '/', '__'), entity_type, name, short_description, navigation, module, header, include, syntax,
       remarks, n_members FROM e WHERE category = 'editor'""")
def q_stream_extract(spark, d):
    """The flagship extraction run incrementally (file stream, availableNow,
    checkpointed, several micro-batches); must equal the batch result.  Some
    pages arrive twice, some paths occur in two categories, and some paths are
    equal but for ``/`` and ``__``."""
    from docweave.streaming.incremental import run_incremental

    base = os.path.join(ensure_checkpoint_dir(spark), "stream_extract", uuid.uuid4().hex)
    src = os.path.join(base, "pages")
    nodes = X.x7_hierarchy_class_pages(spark, d)
    mirror = nodes.withColumn("category", F.lit("mirror"))
    for part in (X.doc_pages(spark, d), nodes, mirror, mirror.withColumn("source_path", F.replace("source_path", F.lit("/"), F.lit("__")))):
        part.write.mode("append").parquet(src)
    files = spark.read.parquet(src).select(F.input_file_name().alias("f")).distinct().count()
    out = run_incremental(spark, src, os.path.join(base, "out"), os.path.join(base, "checkpoint"), max(1, files // 3))
    return flat_entities(out)


# ============================================================ S4, T2, H5
@register("entity_pages", SCAN_SQL.replace("page_id\nFROM pages", "page_id, CAST(length(html) AS BIGINT) AS n_chars\nFROM pages"))
def q_entity_pages(spark, d):
    """The indexed pages with their decoded text (here: its length); an
    unreadable page would carry a null text and drop to the dead letters."""
    from docweave.sources.files import exclude_categories

    pages = exclude_categories(url_pages(spark, d), [" ES ", "", "  "])
    return pages.select("category", "source_path", "page_id", F.length("html").cast("long").alias("n_chars"))


@register("hier_order", with_ctes(X5_CTE, WALK_CTE) + """
SELECT name, array_to_string(path, '/') AS path, CAST(row_number() OVER (ORDER BY places) - 1 AS BIGINT) AS preorder
FROM walk""")
def q_hier_order(spark, d):
    """Depth-first pre-order position of every walk row in document order,
    numbered without a single-task window."""
    w = H.hierarchy_walk(spark, hierarchy_flat(spark, d, None)).select("name", "path", "places", F.lit(0).alias("_g"))
    n = K.line_numbers(w, "_g", ["places"], out="preorder")
    return n.select("name", F.array_join("path", "/").alias("path"), "preorder")


@register("hier_attached", ORGANIZE_SQL + " WHERE segment = 1")
def q_hier_attached(spark, d):
    """H5: segment 1 only — per visited node its class row, then its related entities."""
    return q_organize_by_hierarchy(spark, d).filter(F.col("segment") == 1)


@register("category_progress_stream", "WITH " + REPORTS_SQL.strip() + """
SELECT category, count, status, epoch_us(heartbeat) AS heartbeat_us FROM latest""")
def q_category_progress_stream(spark, d):
    """W1 (streaming form): the events file read as a stream, aggregated per
    category in complete mode with a checkpoint; equals the batch result."""
    from docweave.streaming.progress import progress_to_table

    base = os.path.join(ensure_checkpoint_dir(spark), "progress_stream", uuid.uuid4().hex)
    events = tbl(spark, d, "events")
    # a one-character class in the glob makes the single file a stream source
    src = f"{d}/events.parque[t]"
    out = progress_to_table(spark, src, events.schema, os.path.join(base, "out"), os.path.join(base, "checkpoint"), _reports)
    return out.select("category", "count", "status", F.expr(HEARTBEAT_US).alias("heartbeat_us"))


@register("category_progress_live", "WITH " + REPORTS_SQL.strip() + """,
a AS (SELECT max(heartbeat) AS as_of FROM latest)
SELECT c.category, coalesce(l.count, 0) AS count, coalesce(l.status, 'Idle') AS status, epoch_us(l.heartbeat) AS heartbeat_us,
       coalesce(epoch_us(a.as_of) - epoch_us(l.heartbeat) > 30000000, false) AS stale,
       coalesce(strftime(l.heartbeat, '%Y-%m-%d %H:%M:%S'), '-') AS last_update
FROM cats c LEFT JOIN latest l USING (category), a""")
def q_category_progress_live(spark, d):
    """W1 (live form): the events read as a stream into keyed state whose timers
    turn a category stale 30 s after its last report."""
    from docweave.streaming.live import live_progress, start_live_progress

    base = _scratch(spark, "progress_live")
    stream = spark.readStream.schema(tbl(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")
    start_live_progress(_reports(stream), f"{base}/log", f"{base}/checkpoint").awaitTermination()
    live = live_progress(spark, f"{base}/log", _categories(spark, d))
    return live.select("category", "count", "status", F.expr(HEARTBEAT_US).alias("heartbeat_us"), "stale", "last_update")


CYCLIC_EDGES_SQL = """
e AS (
  SELECT r.r_name AS parent, n.n_name AS name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
  UNION ALL
  SELECT a.n_name, b.n_name FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 1) % 25)"""


@register("hierarchy_walk_cyclic", "WITH RECURSIVE " + CYCLIC_EDGES_SQL.strip() + """,
walk(root, name, depth, path) AS (
  SELECT r_name, r_name, 0, [r_name] FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
  UNION ALL
  SELECT w.root, e.name, w.depth + 1, list_append(w.path, e.name)
  FROM walk w JOIN e ON e.parent = w.name
  WHERE w.depth < 8 AND NOT list_contains(w.path, e.name))
SELECT root, name, CAST(depth AS BIGINT) AS depth, array_to_string(path, '/') AS path FROM walk""")
def q_hierarchy_walk_cyclic(spark, d):
    """H3 / D6 on a graph with cycles and two-parent nodes: regions → nations
    plus a successor ring over the nations.  One row per path, cycle guard,
    a depth limit of 8 as asked."""
    nation, region = tbl(spark, d, "nation"), tbl(spark, d, "region")
    tree = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_name").alias("name"), F.col("r_name").alias("parent"))
    a, b = nation.alias("a"), nation.alias("b")
    ring = a.join(b, F.col("b.n_nationkey") == F.pmod(F.col("a.n_nationkey") + 1, F.lit(25))).select(
        F.col("b.n_name").alias("name"), F.col("a.n_name").alias("parent"))
    roots = region.join(nation, region["r_regionkey"] == nation["n_regionkey"], "left_semi").select(
        F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent"))
    w = H.hierarchy_walk(spark, tree.unionByName(ring).unionByName(roots), max_depth=8)
    return w.select("root", "name", F.col("depth").cast("long").alias("depth"), F.array_join("path", "/").alias("path"))


@register("hierarchy_depth_zero", with_ctes(X5_CTE) + """
SELECT name, link FROM x5_nodes WHERE depth = 0""")
def q_hierarchy_depth_zero(spark, d):
    """H2 at max_depth 0: the parse stops at the roots."""
    return hierarchy_flat(spark, d, max_depth=0).select("name", "link")


# ============================================================ round trips through files
def _scratch(spark, what: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), what, uuid.uuid4().hex)


TREE_SQL = f"""
SELECT {URL_CATEGORY} AS category, 'P' || page_id || '/index.html' AS source_path, md5(html) AS html_md5 FROM pages
WHERE {URL_CATEGORY} <> 'es'"""


def _page_tree(spark, d) -> tuple[str, DataFrame]:
    """``pages`` written as a tree of ``<category>/P<id>/index.html`` files."""
    root = _scratch(spark, "tree")
    pages = url_pages(spark, d).select("category", F.concat(F.lit("P"), F.col("page_id").cast("string"), F.lit("/index.html")).alias("source_path"), "html")
    K.write_page_tree(pages, root)
    return root, pages


@register("page_tree", TREE_SQL)
def q_page_tree(spark, d):
    """A page tree written to files, listed per category
    without the excluded one, and read."""
    from docweave.sources.files import read_pages

    root, _ = _page_tree(spark, d)
    cats = {c: f"{root}/{c}" for c in ("en", "fr", "de", "es")}
    return read_pages(spark, cats, exclude=[" ES "]).select("category", "source_path", F.md5("html").alias("html_md5"))


@register("page_tree_hidden", f"""
SELECT category, CASE page_id % 4 WHEN 0 THEN '_internal/' WHEN 1 THEN '.draft/a b%20/' ELSE '' END || 'P' || page_id || '/index.html' AS source_path,
       CASE WHEN page_id % 5 = 0 THEN '' ELSE html END AS html
FROM (SELECT {URL_CATEGORY} AS category, page_id, html FROM pages) WHERE category IN ('en', 'fr')""")
def q_page_tree_hidden(spark, d):
    """Pages in folders that begin with ``_`` or ``.``, empty
    pages, and roots given with and without a scheme."""
    from docweave.sources.files import read_pages

    root = _scratch(spark, "hidden")
    folder = F.when(F.col("page_id") % 4 == 0, "_internal/").when(F.col("page_id") % 4 == 1, ".draft/a b%20/").otherwise("")
    pages = url_pages(spark, d).filter(F.col("category").isin("en", "fr")).select(
        "category", F.concat(folder, F.lit("P"), F.col("page_id").cast("string"), F.lit("/index.html")).alias("source_path"),
        F.when(F.col("page_id") % 5 == 0, "").otherwise(F.col("html")).alias("html"))
    K.write_page_tree(pages, root)
    bare = re.sub(r"^file:/+", "/", root)
    return read_pages(spark, {"en": f"{bare}/en", "fr": f"{root}/fr/"})


@register("page_index_file", TREE_SQL.replace(", md5(html) AS html_md5", ""))
def q_page_index_file(spark, d):
    """K1, S3: the page index written as JSON string lines and read back."""
    from docweave.sources.files import page_index_lines, read_page_index, scan_pages

    root, _ = _page_tree(spark, d)
    path = _scratch(spark, "index")
    listing = scan_pages(spark, {c: f"{root}/{c}" for c in ("en", "fr", "de", "es")}, exclude=["es"])
    page_index_lines(listing, keep=["category"]).write.partitionBy("category").text(path)
    return read_page_index(spark, path, keep=["category"]).select("category", "source_path")


@register("entity_files", with_ctes(X6_CTE) + """
SELECT category, source_path, CAST(max(line_no) AS BIGINT) AS line_no, true AS found FROM x6 WHERE NOT bad GROUP BY category, source_path""")
def q_entity_files(spark, d):
    """Entities written in input order, and each position
    looked up in the written files."""
    good = C.good_entities(x6_parsed(spark, d)).select("category", "line_no", "source_path", "name")
    path = _scratch(spark, "entities")
    K.write_sorted_ndjson(good, path, ["line_no"], ["category"])
    at = K.written_positions(spark, path)
    lines = spark.read.text(path).select(
        "category", "value", F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0).alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_at"),
        F.concat_ws("/", "category", F.col("_metadata.file_name")).alias("_file"))
    numbered = K.line_numbers(lines, "_file", ["_at"]).select(
        "category", "file", "line", F.get_json_object("value", "$.source_path").alias("there"), F.get_json_object("value", "$.line_no").cast("long").alias("line_no"))
    return at.join(numbered, ["category", "file", "line"], "left").select(
        "category", "source_path", "line_no", (F.col("there") == F.col("source_path")).alias("found"))


@register("seek_lines", with_ctes(X6_CTE) + """
SELECT category, CAST(row_number() OVER (PARTITION BY category ORDER BY line_no) - 1 AS BIGINT) AS line, source_path, CAST(line_no AS BIGINT) AS line_no FROM x6 WHERE NOT bad""")
def q_seek_lines(spark, d):
    """K6, K7: a run that stopped after 100 lines of each category goes on where
    the files end; then every record is looked up by its line number."""
    from docweave.sources import seekable

    good = C.good_entities(x6_parsed(spark, d)).select("category", "line_no", "source_path")
    numbered = materialize(K.line_numbers(good, "category", ["line_no"]).select("category", "line", "source_path", "line_no"))
    path = _scratch(spark, "seekable")
    K.write_sorted_ndjson(numbered.filter("line < 100"), path, ["line"], ["category"])
    seekable.append_lines(numbered, path)
    found = seekable.read_lines(numbered.select("category", "line"), path)
    return found.select("category", "line", F.get_json_object("value", "$.source_path").alias("source_path"),
                        F.get_json_object("value", "$.line_no").cast("long").alias("line_no"))


@register("published_files", with_ctes(X6_CTE) + """
SELECT category, CAST(line_no AS BIGINT) AS line_no, source_path,
       CAST(count(*) OVER (PARTITION BY category) AS BIGINT) AS n_published FROM x6 WHERE NOT bad""")
def q_published_files(spark, d):
    """Entities and their counts published together, run by run, as
    JSON lines; a run repeats one that was published, another stops before its
    manifest; then the small sets are merged."""
    from docweave.sources.published import PublishedTables

    good = materialize(C.good_entities(x6_parsed(spark, d)).select("category", "line_no", "source_path"))
    tables = PublishedTables(spark, _scratch(spark, "published"))
    for run in (0, 1, 1, 2, 3):
        lines = good.filter(F.pmod("line_no", F.lit(4)) == run)
        counts = lines.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
        tables.publish({"entities": lines, "counts": counts}, "runs", run, fmt="json")
    tables.stage("entities", good, fmt="json")
    for table in ("entities", "counts"):
        tables.compact(table, fan=2)
    n = tables.read("counts").groupBy("category").agg(F.sum("n").alias("n_published"))
    return tables.read("entities").join(n, "category").select("category", "line_no", "source_path", "n_published")


@register("hierarchy_file", with_ctes(X5_CTE) + """
SELECT n.name, n.link, n.parent, CAST(n.depth AS BIGINT) AS depth,
       CAST(row_number() OVER (ORDER BY n.ord, n.name) - 1 AS BIGINT) AS nth FROM x5_all n""")
def q_hierarchy_file(spark, d):
    """The hierarchy written with its order and read back."""
    from docweave.sources.files import read_hierarchy

    path = _scratch(spark, "hierarchy")
    K.write_ndjson(H.hierarchy_sink_rows(hierarchy_flat(spark, d, None)), path)
    back = read_hierarchy(spark, path).withColumn("_g", F.lit(0))
    return K.line_numbers(back, "_g", ["ord", "name"], out="nth").select("name", "link", "parent", F.col("depth").cast("long").alias("depth"), "nth")


@register("run_pipeline_files", with_ctes(X3_CTE, X7_CTE, X8_CTE, X5_CTE, WALK_CTE) + """,
ent AS (
  SELECT 'editor' AS category, source_path, nm AS name, 'class' AS entity_type, [] AS crumbs FROM x7
  UNION ALL SELECT 'runtime', source_path, 'function ' || seg, 'function', [crumb] FROM x8
  UNION ALL SELECT 'plugins', source_path, CASE WHEN n_nationkey % 2 = 0 THEN 'enum ' || n_name ELSE n_name END, 'enum', [reg, n_name] FROM x3),
rel AS (SELECT c.crumb, e.source_path FROM ent e, unnest(e.crumbs) c(crumb) WHERE e.entity_type <> 'class' AND c.crumb IN (SELECT name FROM walk))
SELECT 1 AS segment, array_to_string(w.path, '/') AS path, e.name, e.source_path FROM walk w JOIN ent e ON e.entity_type = 'class' AND e.name = w.name
UNION ALL
SELECT 1, array_to_string(w.path, '/'), e.name, e.source_path FROM walk w JOIN rel r ON r.crumb = w.name JOIN ent e ON e.source_path = r.source_path
UNION ALL
SELECT 2, '', name, source_path FROM ent WHERE entity_type = 'class' AND name NOT IN (SELECT name FROM walk)
UNION ALL
SELECT 3, '', name, source_path FROM ent WHERE entity_type <> 'class' AND source_path NOT IN (SELECT source_path FROM rel)""")
def q_run_pipeline_files(spark, d):
    """The whole pipeline over a tree of files; its hierarchical
    output."""
    from docweave.plans.pipeline import PipelineConfig, run_pipeline

    root, out = _scratch(spark, "api"), _scratch(spark, "out")
    pages = (X.x7_hierarchy_class_pages(spark, d).withColumn("category", F.lit("Editor"))
             .unionByName(X.x8_tier_pages(spark, d).withColumn("category", F.lit("Runtime")))
             .unionByName(X.x3_enum_pages(spark, d).withColumn("category", F.lit("Plugins")))
             .unionByName(X.x5_hierarchy_pages(spark, d).select(
                 F.lit("ClassHierarchy").alias("category"), F.expr("substring(source_path, 16)").alias("source_path"), "html")))
    K.write_page_tree(pages, root)
    report = run_pipeline(spark, PipelineConfig(api_root=root, out=out, exclude=("developer",), max_depth=None, extra={"all_hierarchies": True}))
    if report["skipped"]:
        raise RuntimeError(f"skipped: {report['skipped']}")
    rows = spark.read.schema("segment int, path array<string>, name string, source_path string").json(os.path.join(out, "hierarchical"))
    return rows.select("segment", F.array_join("path", "/").alias("path"), "name", "source_path")


@register("run_pipeline_details", with_ctes(X2_CTE, X3_CTE, X4_CTE) + """
SELECT 'classes' AS sink, l.name, '../Classes' || substr(l.relative_url, 3) AS place, CAST(CASE WHEN p.p_partkey IS NULL THEN 0 ELSE 3 END AS BIGINT) AS n_members, p.p_brand AS module
FROM x4_links l LEFT JOIN part p ON p.p_partkey = l.p_partkey WHERE NOT l.no_first_href
UNION ALL
SELECT lower(f), name, '../' || f || '/' || place, n, reg
FROM (SELECT 'Enums' AS f UNION ALL SELECT 'Constants') t, (
  SELECT n_name AS name, substr(regexp_replace(source_path, '/index.html$', ''), 7) AS place, CAST(n AS BIGINT) AS n, reg FROM x3 WHERE reg <> ''
  UNION ALL SELECT 'Ghost ' || r_name, 'missing-' || r_regionkey, 0, NULL FROM region WHERE r_name IN (SELECT reg FROM x3))
UNION ALL
SELECT 'functions', CASE WHEN o_orderkey % 2 = 0 THEN 'function Order' || o_orderkey ELSE 'Order' || o_orderkey || ' overloads' END, folder, CAST(n AS BIGINT), NULL
FROM x2""")
def q_run_pipeline_details(spark, d):
    """The pipeline over a tree with class, enum, constant and
    function folders, their pages in packs; the four detail sinks read back."""
    from docweave.plans.pipeline import PipelineConfig, run_pipeline

    root, out = _scratch(spark, "api"), _scratch(spark, "out")

    def under(pages: DataFrame, folder: str, path: str = "source_path", **moved: str) -> DataFrame:
        html = F.col("html")
        for old, new in moved.items():
            html = F.replace(html, F.lit(f"../{old}/"), F.lit(f"../{new}/"))
        return pages.select(F.lit(folder).alias("category"), F.expr(path).alias("source_path"), html.alias("html"))

    values, index = X.x3_enum_pages(spark, d), X.x9_value_index_pages(spark, d)
    parts = [under(X.x7_hierarchy_class_pages(spark, d), "Editor"),
             under(X.x5_hierarchy_pages(spark, d), "ClassHierarchy", "substring(source_path, 16)"),
             under(X.x4_index_pages(spark, d), "Classes", Part="Classes/Part"), under(X.x1c_class_detail_pages(spark, d), "Classes"),
             under(X.x2_function_pages(spark, d), "Functions", "substring(source_path, 11)")]
    for folder in ("Enums", "Constants"):
        parts += [under(values, folder, "substring(source_path, 7)"), under(index, folder, Enums=folder)]
    pages = parts[0]
    for p in parts[1:]:
        pages = pages.unionByName(p)
    K.write_page_tree(pages, root, packed=True)
    report = run_pipeline(spark, PipelineConfig(api_root=root, out=out, exclude=("developer", "plugins", "runtime"), max_depth=None,
                                                extra={"all_hierarchies": True, "all_indexes": True}))
    if report["skipped"]:
        raise RuntimeError(f"skipped: {report['skipped']}")

    def sink(folder: str, name: str, at: str, members: str) -> DataFrame:
        rows = spark.read.schema(f"{name} string, {at} string, {members} array<string>, module string").json(os.path.join(out, folder))
        return rows.select(F.lit(folder).alias("sink"), F.col(name).alias("name"), F.col(at).alias("place"), F.size(members).cast("long").alias("n_members"), "module")

    return (sink("classes", "class_name", "relative_url", "variables").unionByName(sink("enums", "enum_name", "relative_url", "values"))
            .unionByName(sink("constants", "constant_name", "relative_url", "values")).unionByName(sink("functions", "function_name", "folder", "overloads")))
