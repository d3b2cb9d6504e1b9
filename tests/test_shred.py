import random
import sys

import pyarrow as pa

from docweave.operators.shred import _plain_nodes, _shred_batch, _shred_pages, shred, shred_html


def nodes(html):
    r = shred_html(html)
    return [dict((k, r[k][i]) for k in r) for i in range(len(r["pos"]))]


def test_intervals_and_text():
    ns = nodes("<div id='a' class='x y'><p>one <b>two</b></p>tail</div>")
    div = ns[0]
    assert div["tag"] == "div" and div["id"] == "a" and div["cls"] == " x y "
    assert div["last"] == len(ns) - 1
    texts = [n["txt"] for n in ns if n["tag"] == "#text"]
    assert texts == ["one", "two", "tail"]


def test_void_and_unclosed():
    ns = nodes("<p>a<br>b<p>c<b>d</div>")
    tags = [n["tag"] for n in ns]
    assert tags == ["p", "#text", "br", "#text", "p", "#text", "b", "#text"]
    # unmatched </div> is ignored; nothing is implied, so the second p nests in the first
    assert ns[4]["parent"] == 0 and ns[0]["last"] == 7


def test_end_tag_pops_to_match():
    ns = nodes("<div><span><i>x</div>y")
    assert ns[0]["last"] == 3  # div closes over span and i
    assert ns[-1]["txt"] == "y" and ns[-1]["parent"] == -1


def test_script_style_comment_dropped():
    ns = nodes('<body><script>var t="</p>";</script><style>p{}</style><!-- c --><p>x</p></body>')
    assert [n["txt"] for n in ns if n["tag"] == "#text"] == ["x"]
    assert [n["tag"] for n in ns if n["tag"] != "#text"] == ["body", "script", "style", "p"]


def test_charrefs_and_unicode_strip():
    ns = nodes("<p>&nbsp;a &amp; b&copy;\x1c</p>")
    assert ns[1]["txt"] == "a & b©"


def test_prev_sibling_ignores_text():
    ns = nodes("<div><h1>T</h1> text <p>P</p></div>")
    p = [n for n in ns if n["tag"] == "p"][0]
    assert ns[p["prev"]]["tag"] == "h1"


def test_href_presence():
    ns = nodes('<a href>x</a><a>y</a><a href="#t">z</a>')
    hrefs = [n["href"] for n in ns if n["tag"] == "a"]
    assert hrefs == ["", None, "#t"]


def test_self_closing_non_void():
    ns = nodes("<div/><p>x</p>")
    assert ns[0]["last"] == 0 and ns[1]["parent"] == -1


def test_element_text_cached_when_short():
    from docweave.operators.shred import TEXT_CACHE_CHARS

    long = "x" * (TEXT_CACHE_CHARS + 1)
    ns = nodes(f"<div><p> a <b>b</b> </p><br><span>{long}</span><i></i></div>")
    by_tag = {n["tag"]: n for n in ns if n["tag"] != "#text"}
    assert by_tag["p"]["txt"] == "ab" and by_tag["b"]["txt"] == "b"
    assert by_tag["br"]["txt"] == "" and by_tag["i"]["txt"] == ""
    assert by_tag["span"]["txt"] is None and by_tag["div"]["txt"] is None


def test_spread_only_when_asked(spark):
    from docweave.operators.shred import shred

    df = spark.range(0, 100).selectExpr("CAST(id AS STRING) AS html")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(shred(df)) and "RoundRobinPartitioning" in plan(shred(df, spread=True))


def test_selected_text_is_equal_on_both_sides_of_the_cache_limit(spark):
    from pyspark.sql import functions as F

    from docweave.functions import nodes as N
    from docweave.operators.shred import TEXT_CACHE_CHARS, shred

    sizes = [TEXT_CACHE_CHARS - 1, TEXT_CACHE_CHARS, TEXT_CACHE_CHARS + 1]
    df = spark.createDataFrame([(n, f"<p>{'a' * (n - 2)}<b> bc </b></p>") for n in sizes], "n int, html string")
    got = shred(df, keep=["n"]).select("n", F.expr(N.text(N.NODES, N.find(N.NODES, N.matcher("p")))).alias("t")).collect()
    assert {r.n: r.t for r in got} == {n: "a" * (n - 2) + "bc" for n in sizes}


def test_label_cells_know_their_place():
    cell = '<td class="hierarchy-label-cell x">'
    r = shred_html(f"<table><tr>{cell}<table><tr>{cell}<a>no</a><a href=x>l</a></td></tr></table></td>{cell}none</td><td>plain</td></tr></table>")
    at = [i for i, u in enumerate(r["up"]) if u is not None]
    assert [(r["up"][i], r["lvl"][i]) for i in at] == [(-1, 0), (at[0], 1), (-1, 0)]
    link = r["href"].index("x")
    assert [r["lnk"][i] for i in at] == [link, link, None]


CLOSED_AND_NOT = [
    ("<ul><li>a</li><li>b<ul><li>c</li><li>d</li></ul></li><li>e</li></ul>", "<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>"),
    ("<dl><dt>a</dt><dd>b</dd><dd>c<p>x</p></dd><dt>d</dt></dl>", "<dl><dt>a<dd>b<dd>c<p>x<dt>d</dl>"),
    ("<div><p>a <b>b</b></p><p>c</p><table><tr><td>d</td></tr></table></div>", "<div><p>a <b>b</b><p>c<table><tr><td>d</table></div>"),
    ("<p>a</p><h2>b</h2><p>c</p><ul><li><p>d</p></li><li>e</li></ul>", "<p>a<h2>b</h2><p>c<ul><li><p>d<li>e</ul>"),
    ("<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>c</td><td><p>d</p></td></tr><tr><td>e</td></tr></tbody></table><p>f</p>",
     "<table><thead><tr><th>a<th>b<tbody><tr><td>c<td><p>d<tr><td>e</table><p>f"),
    ("<table><tr><td>a<table><tr><td>b</td><td>c</td></tr></table></td><td>d</td></tr></table>", "<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>"),
    ("<select><optgroup><option>a</option><option>b</option></optgroup><optgroup><option>c</option></optgroup></select>",
     "<select><optgroup><option>a<option>b<optgroup><option>c</select>"),
    # a list item inside a cell does not end the item around the table
    ("<ul><li><table><tr><td><ul><li>x</li></ul></td></tr></table></li></ul>", "<ul><li><table><tr><td><ul><li>x</table></ul>"),
    # an end tag does not reach out of its cell
    ("<div><table><tr><td>a</td><td>b</td></tr></table></div>", "<div><table><tr><td>a</div><td>b</table></div>"),
]


def test_implied_ends():
    for closed, unclosed in CLOSED_AND_NOT:
        assert shred_html(unclosed, implied_ends=True) == shred_html(closed), unclosed
        # pages that close everything are the same either way
        assert shred_html(closed, implied_ends=True) == shred_html(closed), closed


def test_plain_markup_is_cut_as_the_parser_does():
    """Pages in plain markup are taken by one expression, others by HTMLParser: the nodes are the same."""
    import random

    from docweave.operators.shred import _Shredder

    bits = ["<p>", "</p>", "<td>", "</TD>", "<tr class=' a  b '>", "<table>", "</table>", "<li>", '<a href="x&amp;y">', "<A HREF='q' id=i>", "</a>", "<br/>",
            '<div id="r" class="x"/>', "<!-- c -->", "<!-->", "<!-- a--b -->", "<!DOCTYPE html>", "<script>", "</script>", "</script >", "<style>x</style>",
            '<script src="a">if(a<b){"</td>"}</script>', "<script><!-- x --></script>", "<title>a &amp; b</title>", "&lt;", "&amp", " text ", "\n", "\x85", "<p a>",
            "<?pi?>", '<td class="q hierarchy-label-cell">', '<p id="a"b="c">', '<p class="x" class="y">', "</p x>", "< p>", "<", ">", "</"]
    rnd, plain = random.Random(7), 0
    for _ in range(4000):
        html = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 8)))
        for implied in (False, True):
            s = _Shredder(implied)
            taken = s.feed_plain(html)
            s.finish()
            t = _Shredder(implied)
            t.feed(html)
            t.finish()
            plain += taken
            if taken:
                assert (s.cols, s.last, s.txt, s.labels) == (t.cols, t.last, t.txt, t.labels), html
    assert plain > 500
    assert _Shredder().feed_plain('<!DOCTYPE html><html><body class="a"><!-- c --><h1 id=\'t\'>a &lt; b</h1><br/><script>"</td>"</script></body></html>')


def test_batch_equals_page_by_page():
    rng = random.Random(5)
    pieces = ["<div>", "</div>", "<p class=' a  b'>", "</p>", "<P ID=x>", "<td id='q' CLASS=\"z\">", "</td>", "</TD >", "<br>", "<br/>", "<i/>",
              "<a href='../x?a=1&amp;b'>", "<a href>", "</a>", "a", " b ", "\n", "  \x1c", "&amp; c &nbsp;", "&copy", "é" * 100, "x" * 300, "",
              "<script>var s=\"</td></tr>\";</script>", "<script>a</script >", "<style>p{}</style>", "<script>", "</script>", "<style><script></style>",
              "<script></SCRIPT></script>", "<script>é</script>", "<SCRIPT>x</SCRIPT>", "<script src=x>", "<!-- c -->", "<!-- a > b -->", "<!-->",
              "<!DOCTYPE html>", "<?pi?>", "a < b", "a > b", "<a title='>'>", "<a title='<script>'>", "</br>", "<td class='hierarchy-label-cell'>", "<"]
    plain = [p for p in pieces if "<" not in p or p in ("<br>", "<br/>", "<i/>", "<style>p{}</style>", "<!-- c -->", "<!DOCTYPE html>", pieces[23])]

    def page(depth=0):
        inner = "".join(page(depth + 1) if rng.random() < 0.5 and depth < 5 else rng.choice(plain) for _ in range(rng.randint(0, 4)))
        tag = rng.choice(["div", "td", "tr class=normal", "a href='../x'", "p id='k' class=\"u v\""])
        return f"<{tag}>{inner}</{tag.split()[0]}>" if rng.random() < 0.9 else inner

    left = 0
    for _ in range(150):
        html = [None if rng.random() < 0.03 else page() + page() if rng.random() < 0.6 else "".join(rng.choices(pieces, k=rng.randint(0, 12)))
                for _ in range(rng.randint(0, 30))]
        column = pa.array(["cut off", *html, "cut off"], pa.string()).slice(1, len(html))
        nodes, errors = _shred_batch(column, False)
        expected, expected_errors = _shred_pages(html, False)
        nodes.validate(full=True)
        for h, got, want in zip(html, nodes.to_pylist(), expected.to_pylist(), strict=True):
            assert got == want, h
        assert errors.to_pylist() == expected_errors.to_pylist()
        left += _plain_nodes(column)[1].sum() if len(html) else 0
    assert 300 < left < 1800  # both ways were taken


def test_batch_of_members_costs_no_python_per_node():
    rows = "".join(f'<tr class="normal-row"><td>R</td><td>{i}-1</td><td>1995-01-0{i % 9}</td></tr>\n' for i in range(20_000))
    html = pa.array([f"<html><body><table>{rows}</table></body></html>"] * 2)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    try:
        nodes, _ = _shred_batch(html, False)
    finally:
        sys.setprofile(None)
    assert len(nodes[0]) == 3 + 7 * 20_000
    assert calls < 5_000


def test_only_the_fields_asked_for(spark):
    html = ['<a href="../A/1">x</a><p>&amp; y</p><a href="">e</a><a href="a&amp;b">z</a>', "<p>open", None, '<A HREF="U">u</A><a href=\'q\'>q</a>',
            '<td class="hierarchy-label-cell"><a href="l">L</a></td>', '<div id="d" class="c d"><a href="../A/1">ü' + "t" * 300 + "</a></div>"]
    column = pa.array(html)
    full, errors = _shred_batch(column, False)
    fields = ["pos", "last", "tag", "id", "cls", "href", "txt"]
    for implied in (False, True):
        full, errors = _shred_batch(column, implied)
        some, some_errors = _shred_batch(column, implied, fields)
        want = [None if p is None else [{k: n[k] for k in fields} for n in p] for p in full.to_pylist()]
        assert some.to_pylist() == want and some_errors.equals(errors)
    assert [n["href"] for n in full.to_pylist()[0] if n["tag"] == "a"] == ["../A/1", "", "a&b"]
    df = shred(spark.createDataFrame([(h,) for h in html], "html string"), keep=[], fields=fields)
    assert [f.name for f in df.schema["nodes"].dataType.elementType.fields] == fields
    assert sorted(str(r.nodes and [n.href for n in r.nodes]) for r in df.collect()) == sorted(str(p and [n["href"] for n in p]) for p in want)
