"""Invariants from SURVEY §5: coverage of the organised output, shredder
intervals on random well-formed trees."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from docweave.operators.shred import shred_html

TAGS = ["div", "p", "span", "td", "b"]


@st.composite
def tree(draw, depth=0):
    tag = draw(st.sampled_from(TAGS))
    n = draw(st.integers(0, 3 if depth < 3 else 0))
    kids = []
    for _ in range(n):
        if draw(st.booleans()):
            kids.append(draw(st.text(alphabet="ab c", min_size=1, max_size=4)))
        else:
            kids.append(draw(tree(depth + 1)))
    return (tag, kids)


def render(t):
    if isinstance(t, str):
        return t
    tag, kids = t
    return f"<{tag}>" + "".join(render(k) for k in kids) + f"</{tag}>"


def texts(t):
    """Text nodes as the parser sees them: adjacent strings form one node,
    which is then stripped; empty ones vanish."""
    out, buf = [], []
    for k in t[1]:
        if isinstance(k, str):
            buf.append(k)
            continue
        if buf and "".join(buf).strip():
            out.append("".join(buf).strip())
        buf = []
        out += texts(k)
    if buf and "".join(buf).strip():
        out.append("".join(buf).strip())
    return out


def elements(t, acc):
    if not isinstance(t, str):
        acc.append(t)
        for k in t[1]:
            elements(k, acc)
    return acc


@settings(max_examples=200, deadline=None)
@given(tree())
def test_shred_intervals_match_tree(t):
    r = shred_html(render(t))
    els = [i for i, tag in enumerate(r["tag"]) if tag != "#text"]
    want = elements(t, [])
    assert [r["tag"][i] for i in els] == [w[0] for w in want]
    for i, w in zip(els, want):
        got = [r["txt"][j] for j in range(i + 1, r["last"][i] + 1) if r["tag"][j] == "#text"]
        assert got == texts(w)
        assert r["txt"][i] is None or r["txt"][i] == "".join(texts(w))


def test_organize_covers_every_named_entity(spark):
    from docweave.operators import hierarchy as H
    from docweave.plans import catalog as CAT

    ents, flat = CAT._organize_inputs(spark, SF_SMALL)
    out = H.organize_by_hierarchy(spark, ents, flat)
    named = ents.filter((F.col("name").isNotNull()) & (F.col("name") != "")).select("name", "entity_type")
    classes = named.filter("entity_type = 'class'").select("name").distinct()
    others = named.filter("entity_type <> 'class'").select("name")
    got_classes = out.filter("kind = 0").select("name").distinct()
    assert classes.join(got_classes, "name", "left_anti").count() == 0
    got_others = out.filter("kind = 1").select("name").distinct()
    assert others.distinct().join(got_others, "name", "left_anti").count() == 0
