"""Hand-written pages for the traps listed in SURVEY §2.13 and FIXTURES.md."""

from conftest import page_df

from docweave.operators.details import class_detail, value_page_detail
from docweave.operators.extract import extract_entities


def one(spark, html):
    return extract_entities(page_df(spark, html)).collect()[0].asDict(recursive=True)


def test_no_h1_falls_back_to_sections(spark):
    e = one(spark, '<div id="values"><table><tr class="normal-row"><td>A</td><td>a</td></tr></table></div>')
    assert e["entity_type"] == "enum" and e["name"] is None
    assert e["values"] == [{"name": "A", "description": "a"}]
    assert e["navigation"] == [] and e["variables"] is None


def test_h1_with_inner_tags_joins_without_separator(spark):
    e = one(spark, "<h1>My <b>Class</b> Foo</h1>")
    assert e["name"] == "MyClassFoo" and e["entity_type"] == "class"


def test_keyword_order_class_before_function(spark):
    assert one(spark, "<h1>Subclass function</h1>")["entity_type"] == "class"
    assert one(spark, "<h1>Foo Overloads</h1>")["entity_type"] == "function"
    assert one(spark, "<h1>Struct FVector</h1>")["entity_type"] == "struct"
    assert one(spark, "<h1>Plain</h1>")["entity_type"] == "unknown"


def test_reference_row_without_p_keeps_page(spark):
    e = one(spark, '<h1>class X</h1><div id="references"><table>'
                   '<tr class="normal-row"><td>Module</td><td><p>M</p></td></tr>'
                   '<tr class="normal-row"><td><p>Header</p></td><td><p>H</p></td></tr>'
                   '<tr class="normal-row"><td><p>Module</p></td><td><p>A</p></td><td>3</td></tr>'
                   "</table></div>")
    assert e["module"] is None and e["header"] == "H" and e["include"] is None


def test_nested_table_rows_are_descendants(spark):
    e = one(spark, '<h1>class N</h1><div id="variables"><table><tr class="normal-row"><td>int</td><td>x</td>'
                   '<td>desc<table><tr class="normal-row"><td>a</td><td>b</td><td>c</td></tr></table></td></tr>'
                   "</table></div>")
    assert e["variables"] == [
        {"type": "int", "name": "x", "description": "descabc"},
        {"type": "a", "name": "b", "description": "c"},
    ]


def test_nbsp_and_separator_whitespace(spark):
    e = one(spark, "<h1>&nbsp;class X\x1f</h1><h2> short </h2>")
    assert e["name"] == "class X" and e["short_description"] == "short"


def test_script_text_inside_section_ignored(spark):
    e = one(spark, '<h1>class S</h1><div id="description"><script>var a = "<p>";</script>Real</div>')
    assert e["remarks"] == "Real"


def test_unclosed_td_nests(spark):
    e = one(spark, '<h1>enum E</h1><div id="values"><table><tr class="normal-row"><td>A<td>a</tr></table></div>')
    assert e["values"] == [{"name": "Aa", "description": "a"}]


def test_several_classes_and_overloads(spark):
    e = one(spark, '<h1>F</h1><div class="members extra"><table>'
                   '<tr class="normal-row other"><td>0</td><td>int</td><td><a href="f">F</a>'
                   '<div class="name-cell-arguments">(x)</div></td><td>d</td></tr>'
                   '<tr class="normal-row"><td>0</td><td>void</td><td>G<a>g</a></td><td>e</td></tr>'
                   '<tr class="normal-row"><td>0</td><td>void</td><td>short</td></tr>'
                   "</table></div>")
    assert e["entity_type"] == "function"
    assert e["overloads"] == [
        {"return_type": "int", "name": "F", "link": "f", "arguments": "(x)", "description": "d"},
        {"return_type": "void", "name": "Gg", "link": None, "arguments": None, "description": "e"},
    ]


def test_generic_syntax_newline_vs_specialised_none(spark):
    html = '<h1>enum E</h1><div id="syntax"><div class="simplecode_api"><p>enum E<br>{ A }</p></div></div>'
    assert one(spark, html)["syntax"] == "enum E\n{ A }"
    v = value_page_detail(page_df(spark, html), "enum_name").collect()[0]
    assert v["syntax"] == "enum E{ A }"


def test_class_detail_h1_plus_p_and_type_syntax(spark):
    html = ('<h1>C</h1> <p>Intro</p><div class="breadcrumb"><a>A</a><a>B</a></div>'
            '<div id="type"><div class="simplecode_api"><p>T<br>x</p></div></div>'
            '<div id="references"><tr class="normal-row"><td>Module</td><td><p>M</p></td></tr></div>'
            '<div id="variables"><tr class="normal-row"><td>UProperty int</td><td>v</td><td>d</td></tr></div>'
            '<div id="seealso"><a href="../X">x</a><a>y</a></div>')
    d = class_detail(page_df(spark, html)).collect()[0].asDict(recursive=True)
    assert d["short_description"] == "Intro" and d["navigation"] == ["A", "B"]
    assert d["syntax"] == ["Tx"] and d["module"] is None
    assert d["variables"] == [{"type": "UProperty int", "name": "v", "description": "d", "specifiers": "UProperty int"}]
    assert d["see_also"] == ["../X"]


def test_empty_and_null_pages(spark):
    from docweave.operators.shred import shred

    df = spark.createDataFrame([("t", "a", ""), ("t", "b", None)], "category string, source_path string, html string")
    sh = shred(df, keep=["category", "source_path"], spread=False)
    rows = {r["source_path"]: r for r in sh.collect()}
    assert rows["a"]["nodes"] == [] and rows["a"]["shred_error"] is None
    assert rows["b"]["nodes"] is None and rows["b"]["shred_error"] == "no content"
    ents = extract_entities(sh).collect()
    assert [r["source_path"] for r in ents] == ["a"] and ents[0]["entity_type"] == "unknown"
