"""X1–X6 — documentation pages rendered from the relational test tables.

Pages are built with Spark SQL string functions, so the fixture grows with the
tables and is rendered in parallel.  The oracle never reads this HTML: it
computes the expected rows straight from the base tables.

Member tables are *paginated* (sharding of the fixture only) so that no page
(and no ``collect_list`` group) grows with the data: an entity with ``n`` member
rows gets ``ceil(n / ROWS_PER_PAGE)`` pages and row ``r`` lands on page
``pmod(row_id(r), pages)``.  Counting is a partial aggregate.  Keys that fill one
page are dealt by the key, as their entities are; the rows of larger ones are
dealt by ``(key, chunk)``, so that a hot key (one part holding a third of all
lineitems) is spread over many tasks, and their entities are broadcast.  Members
are dealt as narrow rows and rendered where they arrive: no HTML is shuffled.
Continuation pages get the path suffix ``.<chunk>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.shred import TASKS_PER_CORE

ROWS_PER_PAGE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The characters escaped in rendered text, in application order.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))


def esc(c) -> Column:
    """HTML-escape ``& < > "`` in a rendered value (null renders as '')."""
    if isinstance(c, str):
        sql = f"coalesce(CAST(`{c}` AS STRING), '')"
        for a, b in HTML_ESCAPES:
            sql = f"replace({sql}, '{a}', '{b}')"
        return F.expr(sql)
    c = F.coalesce(c, F.lit("")).cast("string")
    for a, b in HTML_ESCAPES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def day(c: str) -> Column:
    return F.expr(f"date_format(`{c}`, 'yyyy-MM-dd')")


def row_hash(c: Column) -> Column:
    """The first 32 bits of the md5 of a row's key."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def deal_tasks(spark: SparkSession) -> int:
    """Tasks that rendered pages are dealt over: the session's own number for
    shuffles, or a few per core where that is more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * TASKS_PER_CORE)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of one small file, dealt anew before pages are rendered from them."""
    return rows.repartition(deal_tasks(rows.sparkSession))


class Pages:
    """The members of each key as ordered HTML, a page chunk at a time:
    ``(key, chunk, body)``.

    ``small`` holds the keys that fill one page, dealt by the key; ``large`` the
    others, dealt by key and chunk.  ``large_keys`` (``key, _pages``) has more
    than ``rows_per_page`` member rows for each of its own.
    """

    def __init__(self, members: DataFrame, key: str, row_id: Column, fragment: Column, order: list[Column],
                 rows_per_page: int = ROWS_PER_PAGE) -> None:
        self.key, self.tasks = key, deal_tasks(members.sparkSession)
        counts = members.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        self.large_keys = counts.filter((F.col("_n") > rows_per_page) & F.col(key).isNotNull()).select(
            key, F.ceil(F.col("_n") / F.lit(rows_per_page)).cast("long").alias("_pages"))
        m = members.filter(F.col(key).isNotNull()).join(F.broadcast(self.large_keys), key, "left")
        chunk = F.pmod(row_id.cast("long"), F.coalesce("_pages", F.lit(1).cast("long"))).alias("chunk")
        m = m.select("*", chunk)
        row = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], fragment.alias("frag"))
        body = F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["frag"]), "").alias("body")
        self.small = m.filter(F.col("_pages").isNull()).repartition(self.tasks, key).groupBy(key, "chunk").agg(body)
        self.large = m.filter(F.col("_pages").isNotNull()).repartition(key, "chunk").groupBy(key, "chunk").agg(body)

    def bodies(self) -> DataFrame:
        return self.small.unionByName(self.large)

    def of(self, entities: DataFrame) -> DataFrame:
        """Every entity with its pages: chunk 0 even with no members, plus one row per extra chunk."""
        key = self.key
        e = entities.join(F.broadcast(self.large_keys), key, "left")
        one = e.filter(F.col("_pages").isNull()).drop("_pages").repartition(self.tasks, key).join(self.small, key, "left")
        many = self.large.join(F.broadcast(e.filter(F.col("_pages").isNotNull()).drop("_pages")), key)
        columns = [*entities.columns, F.coalesce("chunk", F.lit(0).cast("long")).alias("chunk"), F.coalesce("body", F.lit("")).alias("body")]
        return one.select(*columns).unionByName(many.select(*columns))


def suffix() -> Column:
    return F.when(F.col("chunk") > 0, F.concat(F.lit("."), F.col("chunk").cast("string"))).otherwise(F.lit(""))


def page_frame(category: str, path: Column, html: Column) -> list[Column]:
    return [F.lit(category).alias("category"), path.alias("source_path"), html.alias("html")]


# --------------------------------------------------------------------------
# Generic class pages, one per part (+ chunks of its lineitems)
# --------------------------------------------------------------------------
def x1_class_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    frag = F.concat(
        F.lit('<tr class="normal-row"><td>'), esc("l_returnflag"), F.lit("</td><td>"),
        F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
        F.lit("</td><td>"), day("l_shipdate"), F.lit("</td></tr>\n"),
    )
    bodies = Pages(
        li.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey",
        F.col("l_orderkey") * 32 + F.col("l_linenumber"), frag,
        [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_shipdate")],
    )
    # nation is a fixed 25-row dimension (TPC-H), safe to broadcast.
    p = part.join(F.broadcast(nation), F.pmod(part["p_partkey"], F.lit(25)) == nation["n_nationkey"], "left")
    p = bodies.of(p.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "n_name"))
    k = F.col("p_partkey")
    name = esc("p_name")
    h1 = F.when(k % 7 == 0, name).otherwise(F.concat(F.lit("class "), name))
    alias_row = F.when(
        k % 2 == 0,
        F.concat(F.lit('<tr class="normal-row"><td><p>Module (alias)</p></td><td><p>'), esc("p_brand"), F.lit("-alt</p></td></tr>\n")),
    ).otherwise(F.lit(""))
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), name,
        F.lit('</title><script>var s="</td></tr>";</script><style>td{padding:0}</style></head><body>\n'),
        F.lit('<div class="crumbs"><a href="../../B">'), esc("p_brand"), F.lit('</a> &gt; <a href="../../T">'),
        esc("p_type"), F.lit('</a> &gt; <a href="../../N">'), esc("n_name"), F.lit("</a></div>\n"),
        F.lit("<h1>"), h1, F.lit("</h1>\n<h2>"), esc("p_type"), F.lit(" part of size "), F.col("p_size").cast("string"),
        F.lit("</h2>\n<!-- references -->\n"),
        F.lit('<div id="references"><table>\n<tr class="normal-row"><td><p>Module</p></td><td><p>'), esc("p_brand"),
        F.lit('</p></td></tr>\n<tr class="normal-row"><td><p>Header</p></td><td><p>'), esc("p_type"),
        F.lit(".h</p></td></tr>\n"), alias_row,
        F.lit('<tr class="normal-row"><td><p>Include</p></td><td><p>#include &quot;'), esc("p_type"),
        F.lit('.h&quot;</p></td></tr>\n<tr class="normal-row"><td>Note</td><td><p>free</p></td></tr>\n</table></div>\n'),
        F.lit('<div id="syntax"><div class="simplecode_api"><p>class '), name, F.lit("<br>: public "), esc("p_brand"),
        F.lit("</p></div></div>\n"),
        F.lit('<div id="description"><p>'), esc("p_type"), F.lit(" part, size "), F.col("p_size").cast("string"),
        F.lit(".</p><p>Made by <b>"), esc("p_brand"), F.lit("</b>.</p></div>\n"),
        F.lit('<div id="variables"><table>\n<tr class="header-row"><th>Type</th><th>Name</th><th>Description</th></tr>\n'),
        F.col("body"), F.lit('<tr class="normal-row"><td>end</td><td>-</td></tr>\n</table></div>\n</body></html>'),
    )
    path = F.concat(F.lit("Part/"), k.cast("string"), suffix(), F.lit("/index.html"))
    return p.select(*page_frame("developer", path, html))


# --------------------------------------------------------------------------
# Function pages, one per order (+ chunks of its lineitems)
# --------------------------------------------------------------------------
def x2_function_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_shipdate")
    ln = F.col("l_linenumber")
    label = F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string"))
    args = F.concat(F.lit('<div class="name-cell-arguments">(qty '), F.col("l_quantity").cast("long").cast("string"), F.lit(")</div>"))
    href = F.concat(F.lit('<a href="../L/'), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string"), F.lit('">'))
    name_cell = (
        F.when(ln % 3 == 0, F.concat(F.lit("<a>"), label, F.lit("</a>"), args))
        .when(ln % 4 == 0, F.concat(href, label, F.lit("</a>")))
        .otherwise(F.concat(href, label, F.lit("</a>"), args))
    )
    frag = F.concat(
        F.lit('<tr class="normal-row"><td>'), ln.cast("string"), F.lit("</td><td>"), esc("l_returnflag"),
        F.lit("</td><td>"), name_cell, F.lit("</td><td>"), day("l_shipdate"), F.lit("</td></tr>\n"),
    )
    bodies = Pages(
        li.withColumn("o_orderkey", F.col("l_orderkey")), "o_orderkey", row_hash(F.concat_ws("-", "l_orderkey", "l_linenumber")), frag,
        [F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_quantity"), F.col("l_shipdate")],
    )
    o = orders.join(cust, orders["o_custkey"] == cust["c_custkey"], "left").join(
        F.broadcast(nation), F.col("c_nationkey") == nation["n_nationkey"], "left"
    ).select("o_orderkey", "o_custkey", "o_orderpriority", "n_name")
    o = bodies.of(o)
    k = F.col("o_orderkey")
    h1 = F.when(k % 2 == 0, F.concat(F.lit("function Order"), k.cast("string"))).otherwise(
        F.concat(F.lit("Order"), k.cast("string"), F.lit(" overloads"))
    )
    html = F.concat(
        F.lit("<html><body>\n<div class=\"crumbs\"><a href=\"#\">Orders</a><a href=\"#\">"), esc("o_orderpriority"),
        F.lit('</a><a href="#">'), esc("n_name"), F.lit("</a></div>\n<h1>"), h1,
        F.lit("</h1>\n<h2>Order of customer "), F.col("o_custkey").cast("string"), F.lit("</h2>\n"),
        F.lit('<div class="members"><table>\n'), F.col("body"),
        F.lit('<tr class="normal-row"><td>x</td><td>y</td><td>only three</td></tr>\n</table></div>\n</body></html>'),
    )
    path = F.concat(F.lit("Functions/"), k.cast("string"), suffix(), F.lit("/index.html"))
    return o.select(*page_frame("runtime", path, html))


# --------------------------------------------------------------------------
# Enum / constant pages, one per nation (+ chunks of its customers)
# --------------------------------------------------------------------------
def x3_enum_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    frag = F.concat(
        F.lit('<tr class="normal-row"><td>'), esc("c_name"), F.lit("</td><td>"), esc("c_mktsegment"), F.lit("</td></tr>\n")
    )
    bodies = Pages(cust.withColumnRenamed("c_nationkey", "n_nationkey"), "n_nationkey", F.col("c_custkey"), frag,
                      [F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")])
    n = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"], "left").select(
        "n_nationkey", "n_name", "r_name"
    )
    n = bodies.of(n)
    k = F.col("n_nationkey")
    h1 = F.when(k % 2 == 0, F.concat(F.lit("enum "), esc("n_name"))).otherwise(esc("n_name"))
    html = F.concat(
        F.lit('<html><body>\n<div class="crumbs"><a href="#">'), esc("r_name"), F.lit('</a><a href="#">'), esc("n_name"),
        F.lit("</a></div>\n<h1>"), h1, F.lit("</h1>\n<h2>Customers of "), esc("n_name"), F.lit("</h2>\n"),
        F.lit('<div id="references"><table>\n<tr class="normal-row"><td><p>Module</p></td><td><p>'), esc("r_name"),
        F.lit('</p></td></tr>\n<tr class="normal-row"><td><p>Header</p></td><td>none</td></tr>\n</table></div>\n'),
        F.lit('<div id="syntax"><div class="simplecode_api"><p>enum '), esc("n_name"), F.lit("<br>{ "),
        k.cast("string"), F.lit(" }</p></div></div>\n"),
        F.lit('<div id="values"><table>\n'), F.col("body"), F.lit("</table></div>\n"),
        F.lit('<div id="description">Region <i>'), esc("r_name"), F.lit("</i></div>\n</body></html>"),
    )
    path = F.concat(F.lit("Enums/"), k.cast("string"), suffix(), F.lit("/index.html"))
    return n.select(*page_frame("plugins", path, html))


# --------------------------------------------------------------------------
# Class-detail pages, one per part (bounded content, no member group)
# --------------------------------------------------------------------------
def x1c_class_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    k = F.col("p_partkey")
    name, brand, ptype = esc("p_name"), esc("p_brand"), esc("p_type")
    size = F.col("p_size").cast("string")
    summary = F.when(k % 2 == 0, F.concat(F.lit('<div class="summary">'), ptype, F.lit(" summary</div>"))).otherwise(
        F.concat(F.lit("<p>"), ptype, F.lit(" intro</p>"))
    )
    syntax = F.when(
        k % 3 != 0, F.concat(F.lit('<div id="syntax"><pre>class '), name, F.lit("</pre><pre>"), brand, F.lit("</pre></div>"))
    ).otherwise(F.concat(F.lit('<div id="type"><div class="simplecode_api"><p>'), name, F.lit("<br>type</p></div></div>")))
    row3 = lambda a, b, c: F.concat(F.lit('<tr class="normal-row"><td>'), a, F.lit("</td><td>"), b, F.lit("</td><td>"), c, F.lit("</td></tr>"))
    html = F.concat(
        F.lit('<html><body>\n<div class="breadcrumb"><a href="#">'), brand, F.lit('</a><a href="#">'), ptype,
        F.lit("</a></div>\n<h1>"), name, F.lit("</h1>"), summary,
        F.lit('\n<div id="hierarchy"><span class="hierarchyitem">'), brand, F.lit('</span> &gt; <span class="hierarchyitem">'),
        name, F.lit("</span></div>\n"),
        F.lit('<div id="remarks"><p>Size '), size, F.lit("</p></div>\n"), syntax, F.lit("\n"),
        F.lit('<div id="references"><table><tr class="normal-row"><td><p>Module</p></td><td><p>'), brand,
        F.lit('</p></td></tr><tr class="normal-row"><td><p>Header</p></td><td><p>'), ptype,
        F.lit('.h</p></td></tr><tr class="normal-row"><td>Include</td><td><p>x</p></td></tr></table></div>\n'),
        F.lit('<div id="variables"><table>'), row3(ptype, F.lit("type"), F.lit("Part type")),
        row3(F.concat(F.lit("UProperty "), brand), F.lit("brand"), F.lit("Brand")), row3(F.lit("int"), F.lit("size"), size),
        F.lit("</table></div>\n"),
        F.lit('<div id="constructors"><table>'), row3(ptype, name, F.lit("Makes a part")), F.lit("</table></div>\n"),
        F.lit('<div id="functions"><table>'), row3(F.lit("string"), F.lit("GetBrand"), brand),
        F.lit('<tr class="normal-row"><td>x</td><td>short</td></tr></table></div>\n'),
        F.lit('<div id="constants"><table><tr class="normal-row"><td>SIZE</td><td>'), size,
        F.lit('</td></tr><tr class="normal-row"><td>lonely</td></tr></table></div>\n'),
        F.lit('<div id="seealso"><a href="../Part/'), (k + 1).cast("string"), F.lit('">next</a> <a>none</a></div>\n</body></html>'),
    )
    path = F.concat(F.lit("Part/"), k.cast("string"), F.lit("/index.html"))
    return part.select(*page_frame("classes", path, html))


# --------------------------------------------------------------------------
# Index pages, one per brand (+ chunks of its parts)
# --------------------------------------------------------------------------
def x4_index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    k = F.col("p_partkey")
    url = F.concat(F.lit("../Part/"), k.cast("string"))
    href = F.when(k % 5 == 1, F.concat(F.lit(" "), url, F.lit(" "))).otherwise(url)
    a_open = F.concat(F.lit('<a id="content_link" href="'), href, F.lit('">'))
    link = (
        F.when(k % 10 == 3, F.concat(F.lit('<a id="content_link">'), esc("p_name"), F.lit("</a>"), a_open, esc("p_name"), F.lit("</a>")))
        .when(k % 2 == 0, F.concat(a_open, F.lit("<span>"), esc("p_name"), F.lit("</span></a>")))
        .otherwise(F.concat(a_open, esc("p_name"), F.lit("</a>")))
    )
    frag = F.concat(F.lit('<div class="memberindexitem">'), link, F.lit("</div>\n"))
    bodies = Pages(part, "p_brand", k, frag, [k])
    brands = bodies.bodies()
    extras = F.when(
        F.col("chunk") == 0,
        F.concat(
            F.lit('<div class="memberindexitem"><a id="content_link" href="#top"><span>Top</span></a></div>\n'),
            F.lit('<div class="memberindexitem"><a id="content_link" href="../Part/missing-'), esc("p_brand"),
            F.lit('"><span>Ghost '), esc("p_brand"), F.lit("</span></a></div>\n"),
        ),
    ).otherwise(F.lit(""))
    html = F.concat(
        F.lit('<html><body><div id="header"><a id="content_link" href="../Part/0">outside</a></div>\n<div id="maincol">\n'),
        F.col("body"), extras, F.lit("</div></body></html>"),
    )
    path = F.concat(F.lit("Index/"), F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")), suffix(), F.lit("/index.html"))
    return brands.select(*page_frame("classes", path, html))


# --------------------------------------------------------------------------
# Index pages of the enum pages (X3), one per region (+ chunks)
# --------------------------------------------------------------------------
def x9_value_index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name", "r_regionkey")
    listed = x3_enum_pages(spark, sf_dir).select("source_path")
    key = F.regexp_extract("source_path", r"^Enums/(\d+)", 1).cast("long")
    items = listed.withColumn("n_nationkey", key).join(F.broadcast(named.withColumn("n_nationkey", F.col("n_nationkey").cast("long"))), "n_nationkey")
    # the anchor without an href comes first and is passed over
    url = F.concat(F.lit("../"), F.regexp_replace("source_path", "/index.html$", ""))
    frag = F.concat(F.lit('<div class="memberindexitem"><a id="content_link">no link</a><a id="content_link" href="'), url,
                    F.lit('"><span>'), esc("n_name"), F.lit("</span></a></div>\n"))
    bodies = Pages(items, "r_name", row_hash(F.col("source_path")), frag, [F.col("source_path")]).bodies().join(
        F.broadcast(region.select("r_name", "r_regionkey")), "r_name")
    ghost = F.when(F.col("chunk") == 0, F.concat(
        F.lit('<div class="memberindexitem"><a id="content_link" href="../Enums/missing-'), F.col("r_regionkey").cast("string"), F.lit('"><span>Ghost '),
        esc("r_name"), F.lit("</span></a></div>\n"))).otherwise(F.lit(""))
    html = F.concat(F.lit('<html><body><div id="maincol">\n'), F.col("body"), ghost, F.lit("</div></body></html>"))
    path = F.concat(F.lit("Index/"), F.col("r_name"), suffix(), F.lit("/index.html"))
    return bodies.select(*page_frame("enums", path, html))


# --------------------------------------------------------------------------
# Class-hierarchy pages region → nation → supplier, one per nation chunk
# --------------------------------------------------------------------------
def x5_hierarchy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    frag = F.concat(
        F.lit('<tr><td class="hierarchy-label-cell"><a href="../S/'), F.col("s_suppkey").cast("string"), F.lit('">'),
        esc("s_name"), F.lit("</a></td></tr>\n"),
    )
    bodies = Pages(supp.withColumnRenamed("s_nationkey", "n_nationkey"), "n_nationkey", F.col("s_suppkey"), frag,
                      [F.col("s_suppkey")])
    n = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_regionkey", "r_name"
    )
    n = bodies.of(n)
    label = lambda kind, key, nm: F.concat(
        F.lit(f'<td class="hierarchy-label-cell"><a href="../{kind}/'), key.cast("string"), F.lit('">'), nm, F.lit("</a>")
    )
    html = F.concat(
        F.lit('<html><body><table class="hierarchy-table" id="hrch">\n<tr>'),
        label("R", F.col("r_regionkey"), esc("r_name")),
        F.lit('\n<table class="hierarchy-table-collapsed">\n<tr>'),
        label("N", F.col("n_nationkey"), esc("n_name")),
        F.lit('\n<table class="hierarchy-table-collapsed">\n'), F.col("body"),
        F.lit("</table></td></tr>\n</table></td></tr>\n</table></body></html>"),
    )
    path = F.concat(F.lit("ClassHierarchy/"), F.col("n_nationkey").cast("string"), suffix(), F.lit("/index.html"))
    return n.select(*page_frame("hierarchy", path, html)).unionByName(x5_chain_page(spark, sf_dir))


TIERS = 13


def x5_chain_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain ``Tier0 → Tier1 → …`` of the first nations, on one page: deeper
    than the parse's usual limit of 10."""
    cell = F.concat(F.lit('<tr><td class="hierarchy-label-cell"><a href="../T/'), F.col("n_nationkey").cast("string"),
                    F.lit('">Tier'), F.col("n_nationkey").cast("string"), F.lit("</a><table>"))
    # nation is a fixed 25-row dimension (TPC-H): one page of nested cells.
    cells = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < TIERS).select(F.struct("n_nationkey", cell.alias("c")).alias("r")).agg(
        F.array_sort(F.collect_list("r")).alias("rs"))
    html = F.concat(
        F.lit('<html><body><table class="hierarchy-table" id="hrch">'), F.array_join(F.transform("rs", lambda r: r["c"]), ""),
        F.expr("repeat('</table></td></tr>', size(rs))"), F.lit("</table></body></html>"))
    return cells.select(*page_frame("hierarchy", F.lit("ClassHierarchy/chain/index.html"), html))


# --------------------------------------------------------------------------
# Class pages for the hierarchy nodes (regions, nations, suppliers)
# --------------------------------------------------------------------------
def x7_hierarchy_class_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class pages named exactly like the hierarchy labels (h1 without a type
    keyword; detected as classes by their ``div#variables`` section)."""
    region = table(spark, sf_dir, "region").select(F.col("r_name").alias("nm"), F.lit("R").alias("kind"), F.col("r_regionkey").alias("k"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("nm"), F.lit("N").alias("kind"), F.col("n_nationkey").alias("k"))
    supp = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("nm"), F.lit("S").alias("kind"), F.col("s_suppkey").alias("k"))
    allc = dealt(region.unionByName(nation).unionByName(supp))
    html = F.concat(
        F.lit("<html><body><h1>"), esc("nm"), F.lit('</h1>\n<div id="variables"><table><tr class="normal-row"><td>key</td><td>'),
        F.col("kind"), F.lit("</td><td>"), F.col("k").cast("string"), F.lit("</td></tr></table></div></body></html>"),
    )
    path = F.concat(F.lit("Node/"), F.col("kind"), F.lit("/"), F.col("k").cast("string"), F.lit("/index.html"))
    return allc.select(*page_frame("editor", path, html))


# --------------------------------------------------------------------------
# Pages whose crumbs name a deep class, or none
# --------------------------------------------------------------------------
def x8_tier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function page per nation and market segment of its customers; the crumb
    is the nation's ``Tier`` class, or ``Nowhere`` for every fifth nation."""
    cust = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    k = F.col("c_nationkey")
    crumb = F.when(k % 5 == 0, F.lit("Nowhere")).otherwise(F.concat(F.lit("Tier"), (k % TIERS).cast("string")))
    html = F.concat(F.lit('<html><body><div class="crumbs"><a href="#">'), crumb, F.lit("</a></div><h1>function "), esc("c_mktsegment"),
                    F.lit("</h1></body></html>"))
    path = F.concat(F.lit("Tiers/"), k.cast("string"), F.lit("/"), F.col("c_mktsegment"), F.lit("/index.html"))
    return cust.select(*page_frame("tiers", path, html))


# --------------------------------------------------------------------------
# Raw entity lines (JSON text) built from documents
# --------------------------------------------------------------------------
def jstr(c: Column) -> Column:
    """JSON-encode a string value (with quotes); JSON ``null`` for null."""
    enc = F.to_json(F.array(c))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(enc, F.lit(2), F.length(enc) - 2))


X6_CATEGORIES = ("developer", "runtime")


def x6_entity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One NDJSON line per document: ``(category, line_no, value)``.

    * ``name`` is the whole document text (multi-line, messy whitespace)
    * ``doc_id % 10 == 0``: keys ``module``/``remarks`` missing
    * ``doc_id % 10 == 1``: explicit nulls for ``module``/``remarks``
    * ``doc_id % 10 == 2``: ``navigation`` is a string
    * ``doc_id % 17 == 0``: the closing brace is missing (invalid JSON)
    * ``doc_id % 23 == 0``: empty ``source_path``
    * ``source_path`` = ``Docs/<md5(text)>``: exact text copies collide
    * category: ``developer`` for lang en/de, else ``runtime``
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    i = F.col("doc_id")
    sp = F.when(i % 23 == 0, F.lit("")).otherwise(F.concat(F.lit("Docs/"), F.md5(F.col("text"))))
    nav = F.when(i % 10 == 2, jstr(F.col("source"))).otherwise(
        F.concat(F.lit("["), jstr(F.col("lang")), F.lit(", "), jstr(F.col("source")), F.lit("]"))
    )
    etype = F.when(i % 3 == 0, F.lit("class")).when(i % 3 == 1, F.lit("function")).otherwise(F.lit("enum"))
    kv = lambda k, v: F.concat(F.lit(f'"{k}": '), v)
    opt = lambda k, v: F.when(i % 10 == 0, F.lit(None)).when(i % 10 == 1, kv(k, F.lit("null"))).otherwise(kv(k, v))
    parts = F.array(
        kv("name", jstr(F.col("text"))),
        kv("short_description", jstr(F.concat(F.lit("  "), F.col("lang"), F.lit("\t doc  "), i.cast("string"), F.lit(" ")))),
        kv("navigation", nav),
        opt("module", jstr(F.col("source"))),
        opt("remarks", jstr(F.concat(F.col("source"), F.lit(" \n\t "), F.col("lang"), F.lit("\u2003")))),
        kv("entity_type", jstr(etype)),
        kv("source_path", jstr(sp)),
    )
    body = F.concat(F.lit("{"), F.array_join(F.filter(parts, lambda x: x.isNotNull()), ", "))
    line = F.when(i % 17 == 0, body).otherwise(F.concat(body, F.lit("}")))
    cat = F.when(F.col("lang").isin("en", "de"), F.lit("developer")).otherwise(F.lit("runtime"))
    return d.select(cat.alias("category"), i.alias("line_no"), line.alias("value"))


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 ∪ X2 ∪ X3 ∪ X7 ∪ X8: the pages the generic extractor runs on."""
    return (
        x1_class_pages(spark, sf_dir)
        .unionByName(x2_function_pages(spark, sf_dir))
        .unionByName(x3_enum_pages(spark, sf_dir))
        .unionByName(x7_hierarchy_class_pages(spark, sf_dir))
        .unionByName(x8_tier_pages(spark, sf_dir))
    )
