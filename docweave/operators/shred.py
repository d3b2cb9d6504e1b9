"""E0 — shred HTML pages into a position-encoded node array.

This is the engine's only Python stage.  Each page is tokenised once with the
standard-library ``html.parser`` inside ``mapInArrow`` (narrow, no shuffle,
Arrow batches in and out) and becomes one array column::

    nodes ARRAY<STRUCT<pos INT, last INT, parent INT, prev INT, tag STRING,
                       id STRING, cls STRING, href STRING, txt STRING,
                       up INT, lvl INT, lnk INT>>

``pos`` is the node's 0-based index in document order; an element's
descendants are exactly the nodes ``pos+1 .. last``.  ``parent`` is the
position of the enclosing element (-1 at the top) and ``prev`` the position of
the previous *element* sibling (-1 if none).  ``cls`` holds the class tokens
space-padded (``' a b '``), so a class test is ``instr(cls, ' a ') > 0`` — no
nested array to convert per node.  An element's ``txt`` holds its text (the
stripped text nodes inside it, joined with nothing) when that is at most
``TEXT_CACHE_CHARS`` long, else null; selectors read it directly and walk the
text nodes only for longer elements.  Text nodes have tag ``#text``
and carry the Unicode-stripped text in ``txt``; empty ones are dropped, as are
script/style bodies and comments.  The label cells of a class hierarchy carry
what only the stack of open elements knows cheaply: ``up`` is the position of
the label cell that encloses them (-1 if none), ``lvl`` how many enclose them
and ``lnk`` the position of the first linked anchor inside (null if none); all
three are null for other nodes.  Every selector of the engine is then a
Catalyst higher-order function over this array (see ``functions/nodes.py``).

Tree-building rules (those of a non-correcting stdlib tokenizer): void elements
close at once; an end tag pops to its most recent match or is ignored when
nothing matches; no end tag is ever implied; character references are decoded;
whatever is still open closes at end of input.

With ``implied_ends`` optional end tags are implied as HTML defines it: a start
tag closes the open elements that can't hold it (``_IMPLIED``), up to the nearest
element that bounds the search, and no end tag but a table's own reaches out of
a cell.
"""

from __future__ import annotations

import re
import sys
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.functions.markup import HIERARCHY_LABEL_CLASS

# The Arrow stage's code is shipped with the task (pickled by value), so
# executors need only the standard library, numpy and pyarrow — not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_TYPE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("prev", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("href", T.StringType()),
        T.StructField("txt", T.StringType()),
        T.StructField("up", T.IntegerType()),
        T.StructField("lvl", T.IntegerType()),
        T.StructField("lnk", T.IntegerType()),
    ]
)
NODES_TYPE = T.ArrayType(NODE_TYPE)

TEXT = "#text"

# The HTML void elements (never have content or an end tag).
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)
# Elements whose body is raw data, never document text.
RAW_TEXT_ELEMENTS = frozenset(["script", "style"])

# Elements that end an open paragraph when they begin.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
# Elements that an open list item is not looked for beyond.
BOUNDS_ITEM = frozenset(
    "article aside blockquote body button caption center details dir dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup html main menu nav object ol pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
_BOUNDS_PARAGRAPH = frozenset("button caption html marquee object table td template th".split())
_CELLS = frozenset(["td", "th"])
_ROWS = _CELLS | {"tr"}
_SECTIONS = frozenset(["tbody", "tfoot", "thead"])
_BOUNDS_TABLE = frozenset(["table", "template", "html"])
_TABLE_PARTS = _ROWS | _SECTIONS | {"table", "caption"}
_BOUNDS_END = _CELLS | {"caption", "table", "template"}
# Start tag → what it closes, and what bounds the search.
_IMPLIED = {
    "li": (frozenset(["li"]), BOUNDS_ITEM | {"dt", "dd"}),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), BOUNDS_ITEM | {"li"})),
    **dict.fromkeys(["td", "th"], (_CELLS, _BOUNDS_TABLE | _SECTIONS | {"tr"})),
    "tr": (_ROWS | {"caption"}, _BOUNDS_TABLE | _SECTIONS),
    **dict.fromkeys(["tbody", "tfoot", "thead"], (_ROWS | _SECTIONS | {"caption"}, _BOUNDS_TABLE)),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
_PARAGRAPH = (frozenset(["p"]), _BOUNDS_PARAGRAPH)

_ARROW_NODE = pa.struct(
    [
        ("pos", pa.int32()),
        ("last", pa.int32()),
        ("parent", pa.int32()),
        ("prev", pa.int32()),
        ("tag", pa.string()),
        ("id", pa.string()),
        ("cls", pa.string()),
        ("href", pa.string()),
        ("txt", pa.string()),
        ("up", pa.int32()),
        ("lvl", pa.int32()),
        ("lnk", pa.int32()),
    ]
)


# Elements whose text is at most this long carry it in ``txt``.
TEXT_CACHE_CHARS = 256

# Plain markup, which nearly all pages are made of, is cut by one expression: a
# text and the tag, comment, doctype or whole script or style after it.  What
# else begins with ``<`` is left to ``HTMLParser``, together with its page.
_WS = r"[ \t\n\r\f]"
_VALUE = r"(?:[^{q}&]|&(?:amp|lt|gt|quot|\#39);)*"
_ATTRIBUTE = rf"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:=(?:"({_VALUE.format(q='"')})"|'({_VALUE.format(q="'")})'))?"""
_ATTRIBUTES = rf"(?:{_WS}+{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)})*+"
_TOKEN = re.compile(
    rf"([^<]*)(?:</([a-zA-Z][a-zA-Z0-9]*){_WS}*>|<(?!(?i:script|style)\b)([a-zA-Z][a-zA-Z0-9]*)({_ATTRIBUTES}){_WS}*(/?)>"
    rf"|<(script|style)({_ATTRIBUTES}){_WS}*>(?:[^<]|<(?!!--|/\s*(?i:script|style)))*+</\6>"
    r"|(<!--(?:[^->]|-(?!-))(?:[^-]|-(?!-))*+-->|<!(?i:doctype)[^<>]*>)|(<)|\Z)")
# The same tags one by one, as ``_plain_nodes`` cuts them, and the bodies that it blanks.
_TAG = re.compile(
    rf"</([a-zA-Z][a-zA-Z0-9]*){_WS}*>|<(?!(?i:script|style)\b)([a-zA-Z][a-zA-Z0-9]*)({_ATTRIBUTES}){_WS}*(/?)>"
    rf"|<(script|style)({_ATTRIBUTES}){_WS}*>|<!--(?:[^->]|-(?!-))(?:[^-]|-(?!-))*+-->|<!(?i:doctype)[^<>]*>")
_RAW_BODY = re.compile(rf"<(script|style){_ATTRIBUTES}{_WS}*>((?:[^<]|<(?!!--|/\s*(?i:script|style)))*+)</\1>".encode())
_ATTRIBUTE = re.compile(_ATTRIBUTE)
# Links with one plain attribute, of which most are distinct: read in bulk.
_LINK_START, _LINK_END = '<a href="', '">'
_LINK = rf"^{_LINK_START}[^\"&<>]*{_LINK_END}$"
# What ``str.strip`` takes away.
_SPACES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


# Attributes as written → ``(id, cls, href)``: most tags repeat a few.
_SEEN: dict[str, tuple] = {}
_SEEN_MAX = 4096


def _plain_attributes(raw: str) -> tuple:
    """``(id, cls, href)`` of a plain tag's attributes as they are written."""
    kept = _SEEN.get(raw)
    if kept is None:
        values = ((m[1].lower(), m[2] if m[2] is not None else m[3]) for m in _ATTRIBUTE.finditer(raw))
        kept = _kept_attributes([(k, v and unescape(v)) for k, v in values])
        if len(_SEEN) >= _SEEN_MAX:
            _SEEN.clear()
        _SEEN[raw] = kept
    return kept


def _kept_attributes(attrs: list) -> tuple:
    """``(id, cls, href)``, the class tokens space-padded; of an attribute given twice the last."""
    id_ = cls = href = None
    for k, v in attrs:
        if k == "class":
            cls = v
        elif k == "id":
            id_ = "" if v is None else v
        elif k == "href":
            href = "" if v is None else v
    return id_, f" {' '.join(cls.split())} " if cls else " ", href


_LABEL_TOKEN = f" {HIERARCHY_LABEL_CLASS} "


class _Shredder(HTMLParser):
    """Builds the flat node table for one page.

    ``cols`` are the lists of the nodes' parents, previous siblings, tags, ids,
    classes and hrefs (a node's position is its index); ``last`` and ``txt`` are
    kept apart because an element's values are only known when it closes.  Text
    lengths are kept as running sums, so an element's text length is known in
    O(1) at close.
    """

    def __init__(self, implied_ends: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.implied_ends = implied_ends
        self.cols: tuple[list, ...] = ([], [], [], [], [], [])
        self.parents, self.prevs, self.tags, self.ids, self.classes, self.hrefs = self.cols
        self.last: list[int] = []
        self.txt: list[str | None] = []
        self.texts: list[str] = []        # all text nodes so far
        self.tcum: list[int] = [0]        # running text length
        self.tstart: list[int] = []       # first text index per open element
        self.stack: list[int] = []        # open element positions
        self.stack_tags: list[str] = []
        self.prev_elem: list[int] = [-1]  # previous element sibling per level
        self.buf: list[str] = []
        self.labels: dict[int, list] = {}  # label cell → [up, lvl, lnk]
        self.open_labels: list[int] = []

    def _flush(self) -> None:
        buf = self.buf
        if not buf:
            return
        text = "".join(buf).strip() if len(buf) > 1 else buf[0].strip()
        self.buf = []
        if text and not (self.stack_tags and self.stack_tags[-1] in RAW_TEXT_ELEMENTS):
            self._add_text(text)

    def _add_text(self, text: str) -> None:
        self.last.append(len(self.last))
        self.parents.append(self.stack[-1] if self.stack else -1)
        self.prevs.append(-1)
        self.tags.append(TEXT)
        self.ids.append(None)
        self.classes.append(None)
        self.hrefs.append(None)
        self.txt.append(text)
        self.texts.append(text)
        self.tcum.append(self.tcum[-1] + len(text))

    def _close_top(self) -> None:
        p = self.stack.pop()
        if self.open_labels and self.open_labels[-1] == p:
            self.open_labels.pop()
        self.stack_tags.pop()
        self.prev_elem.pop()
        self.last[p] = len(self.last) - 1
        start = self.tstart.pop()
        texts = self.texts
        if self.tcum[-1] - self.tcum[start] <= TEXT_CACHE_CHARS:
            self.txt[p] = texts[start] if start == len(texts) - 1 else "".join(texts[start:]) if start < len(texts) else ""

    def _close_up_to(self, closes: frozenset, bounds: frozenset) -> None:
        """Close the outermost element of ``closes`` that is open within the bounds."""
        tags, cut = self.stack_tags, None
        for i in range(len(tags) - 1, -1, -1):
            if tags[i] in closes:
                cut = i
            elif tags[i] in bounds:
                break
        while cut is not None and len(self.stack) > cut:
            self._close_top()

    # -- tokenizer callbacks ---------------------------------------------
    def handle_starttag(self, tag, attrs):
        if self.buf:
            self._flush()
        self._open(tag, *_kept_attributes(attrs))

    def _open(self, tag: str, id_: str | None, cls: str, href: str | None) -> None:
        if self.implied_ends:
            if tag in _IMPLIED:
                self._close_up_to(*_IMPLIED[tag])
            if tag in ENDS_PARAGRAPH:
                self._close_up_to(*_PARAGRAPH)
        p = len(self.last)
        prev_elem = self.prev_elem
        stack = self.stack
        self.parents.append(stack[-1] if stack else -1)
        self.prevs.append(prev_elem[-1])
        self.tags.append(tag)
        self.ids.append(id_)
        self.classes.append(cls)
        self.hrefs.append(href)
        self.last.append(p)
        prev_elem[-1] = p
        if tag == "td" and _LABEL_TOKEN in cls:
            self.labels[p] = [self.open_labels[-1] if self.open_labels else -1, len(self.open_labels), None]
            self.open_labels.append(p)
        elif tag == "a" and href is not None:
            # a cell that has its first link passed it to all cells around it
            for label in reversed(self.open_labels):
                if self.labels[label][2] is not None:
                    break
                self.labels[label][2] = p
        if tag in VOID_ELEMENTS:
            self.txt.append("")
        else:
            self.txt.append(None)
            stack.append(p)
            self.stack_tags.append(tag)
            prev_elem.append(-1)
            self.tstart.append(len(self.texts))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_ELEMENTS:
            self._close_top()

    def handle_endtag(self, tag):
        if self.buf:
            self._flush()
        tags = self.stack_tags
        if tags and tags[-1] == tag:
            self._close_top()
            return
        for i in range(len(tags) - 1, -1, -1):
            if tags[i] == tag:
                while len(self.stack) > i:
                    self._close_top()
                return
            if self.implied_ends and tags[i] in _BOUNDS_END and tag not in _TABLE_PARTS:
                return

    def handle_data(self, data):
        self.buf.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()

    def feed_plain(self, html: str) -> bool:
        """Build the node table of a page in plain markup, as ``feed`` and ``close``
        would; False where the page has other markup (then the table is of no use)."""
        add_text, open_, end, tags = self._add_text, self._open, self.handle_endtag, self.stack_tags
        for text, closed, tag, attrs, empty, raw, raw_attrs, _, other in _TOKEN.findall(html):
            if other:
                return False
            if text:
                if "&" in text:
                    text = unescape(text)
                text = text.strip()
                if text:
                    add_text(text)
            if tag:
                tag = tag.lower()
                open_(tag, *_plain_attributes(attrs))
                if empty and tag not in VOID_ELEMENTS:
                    self._close_top()
            elif closed:
                if tags and tags[-1] == closed:
                    self._close_top()
                else:
                    end(closed.lower())
            elif raw:
                open_(raw, *_plain_attributes(raw_attrs))
                self._close_top()
        return True

    def finish(self) -> None:
        self.close()
        self._flush()
        while self.stack:
            self._close_top()


def shred_page(html: str, implied_ends: bool = False) -> tuple[tuple[list, ...], list[int], list, dict[int, list]]:
    """Tokenise one page → (node columns, last positions, texts, label cells)."""
    s = _Shredder(implied_ends)
    if not s.feed_plain(html):
        s = _Shredder(implied_ends)
        s.feed(html)
    s.finish()
    return s.cols, s.last, s.txt, s.labels


_COLUMNS = ("parent", "prev", "tag", "id", "cls", "href")


def shred_html(html: str, implied_ends: bool = False) -> dict:
    """Tokenise one page; returns the column lists of its node table."""
    cols, last, txt, labels = shred_page(html, implied_ends)
    n = len(last)
    return {"pos": list(range(n)), "last": last, **dict(zip(_COLUMNS, cols, strict=True)), "txt": txt,
            **{k: [labels[i][j] if i in labels else None for i in range(n)] for j, k in enumerate(("up", "lvl", "lnk"))}}


def _shred_pages(html_values: list, implied_ends: bool) -> tuple[pa.Array, pa.Array]:
    """Page by page → (nodes, errors)."""
    cols: dict[str, list] = {k: [] for k in ("pos", "last", *_COLUMNS, "txt")}
    label_cols: list[list] = [[], [], []]
    offsets = [0]
    valid = []
    errors = []
    for h in html_values:
        if h is None:
            valid.append(False)
            errors.append("no content")
            offsets.append(offsets[-1])
            continue
        try:
            page, lst, tx, labels = shred_page(h, implied_ends)
        except Exception as e:  # a page that cannot be tokenised goes to the dead letters
            valid.append(False)
            errors.append(f"{type(e).__name__}: {e}")
            offsets.append(offsets[-1])
            continue
        n = len(lst)
        cols["pos"].extend(range(n))
        cols["last"].extend(lst)
        for k, col in zip(_COLUMNS, page, strict=True):
            cols[k].extend(col)
        cols["txt"].extend(tx)
        for j, col in enumerate(label_cols):
            col.extend([None] * n)
            for at, values in labels.items():
                col[at - n] = values[j]
        valid.append(True)
        errors.append(None)
        offsets.append(offsets[-1] + n)
    struct = pa.StructArray.from_arrays(
        [
            pa.array(cols["pos"], pa.int32()),
            pa.array(cols["last"], pa.int32()),
            pa.array(cols["parent"], pa.int32()),
            pa.array(cols["prev"], pa.int32()),
            pa.array(cols["tag"], pa.string()),
            pa.array(cols["id"], pa.string()),
            pa.array(cols["cls"], pa.string()),
            pa.array(cols["href"], pa.string()),
            pa.array(cols["txt"], pa.string()),
            *(pa.array(col, pa.int32()) for col in label_cols),
        ],
        fields=list(_ARROW_NODE),
    )
    mask = pa.array([not v for v in valid], pa.bool_())
    nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct, mask=mask)
    return nodes, pa.array(errors, pa.string())


_SKIP, _OPEN, _CLOSE, _EMPTY, _OTHER = range(5)
_TAGS: dict[str, tuple] = {}


def _plain_tag(raw: str) -> tuple:
    """``(kind, name, raw text element, id, cls, href)`` of a tag as it is written."""
    kept = _TAGS.get(raw)
    if kept is None:
        m = _TAG.fullmatch(raw)
        if m is None:
            kept = (_OTHER, "", False, None, None, None)
        elif m[1]:
            name = m[1].lower()
            # a script ends at its exact end tag only
            kept = (_OTHER if name in RAW_TEXT_ELEMENTS and raw != f"</{name}>" else _CLOSE, name, False, None, None, None)
        elif m[2] or m[5]:
            name = (m[2] or m[5]).lower()
            id_, cls, href = _plain_attributes(m[3] if m[2] else m[6])
            kind = _EMPTY if m[4] or name in VOID_ELEMENTS else _OPEN
            # label cells need the stack of open elements
            kept = (_OTHER if name == "td" and _LABEL_TOKEN in cls else kind, name, bool(m[5]), id_, cls, href)
        else:
            kept = (_SKIP, "", False, None, None, None)
        if len(_TAGS) >= _SEEN_MAX:
            _TAGS.clear()
        _TAGS[raw] = kept
    return kept


def _segments(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings at ``data[start:end]``; segments in order that don't overlap."""
    bounds = np.empty(2 * len(start), np.int32)
    bounds[0::2], bounds[1::2] = start, end
    if not len(start):
        return pa.array([], pa.string())
    whole = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
    return whole.take(pa.array(np.arange(0, len(bounds), 2)))


def _before(events: int, at: np.ndarray) -> np.ndarray:
    """How many of the events ``at`` come before each event."""
    n = np.zeros(events + 1, np.int64)
    n[at + 1] = 1
    return np.cumsum(n)


def _plain_nodes(html: pa.Array, fields: list[str] | None = None) -> tuple[pa.Array, np.ndarray]:
    """The node tables of a batch's pages in plain markup, all at once → (nodes of
    all or the given fields, pages left out).  Left out are pages with other markup, with end tags that
    don't match, and with label cells; what ``nodes`` has of them is of no use.

    The pages' bytes are cut at ``<`` and ``>``; each distinct tag is read once.
    Elements nest, so at each depth start and end tags alternate: sorted by depth
    they pair up.
    """
    n = len(html)
    html = html.cast(pa.string())
    left = html.is_null().to_numpy(zero_copy_only=False)
    offs = np.frombuffer(html.buffers()[1], np.int32)[html.offset:html.offset + n + 1].astype(np.int64)
    raw = html.buffers()[2]
    data = np.frombuffer(raw or b"", np.uint8)[offs[0]:offs[-1]]
    offs -= offs[0]
    ends = offs[1:]

    text = data.tobytes()
    bodies = list(_RAW_BODY.finditer(text)) if b"<script" in text or b"<style" in text else []
    if bodies:
        data = data.copy()
        for m in bodies:
            a, b = np.searchsorted(offs, (m.start(), m.end() - 1), "right") - 1
            if a != b or not m[0].isascii():
                left[a:b + 1] = True
            data[m.start(2):m.end(2)] = ord(" ")

    # tags: from each "<" to the next ">", before another "<" and within the page
    lt, gt = np.flatnonzero(data == ord("<")), np.flatnonzero(data == ord(">"))
    end = np.append(gt, len(data))[np.searchsorted(gt, lt)] + 1
    page = np.searchsorted(offs, lt, "right") - 1
    left[page[(end > np.append(lt[1:], len(data))) | (end > ends[page])]] = True
    at = ~left[page]
    lt, end, page = lt[at], end[at], page[at]
    distinct = _segments(data, lt, end).dictionary_encode()
    written = distinct.indices.to_numpy().astype(np.int64)
    # one link stands for all, whose hrefs are cut at the end
    links = pc.match_substring_regex(distinct.dictionary, _LINK)
    alike = pc.if_else(links, f"{_LINK_START}{_LINK_END}", distinct.dictionary).dictionary_encode()
    seen = [_plain_tag(t) for t in alike.dictionary.to_pylist()]
    code = alike.indices.to_numpy().astype(np.int64)[written]
    names = {name: i for i, name in enumerate(dict.fromkeys([TEXT, *(t[1] for t in seen)]))}
    kind = np.array([t[0] for t in seen], np.int8)[code]
    name = np.array([names[t[1]] for t in seen], np.int32)[code]
    body = np.flatnonzero(np.array([t[2] for t in seen], bool)[code])
    ended = np.append(kind, _OTHER)[body + 1] == _CLOSE
    ended &= (np.append(name, -1)[body + 1] == name[body]) & (np.append(page, -1)[body + 1] == page[body])
    left[page[body[~ended]]] = True
    left[page[kind == _OTHER]] = True
    # pages whose start and end tags don't balance
    open_ = np.append(0, np.cumsum((kind == _OPEN).astype(np.int64) - (kind == _CLOSE)))
    starts = np.searchsorted(page, np.arange(n + 1))
    left |= open_[starts[1:]] != open_[starts[:-1]]
    left[page[open_[1:] < open_[starts[page]]]] = True

    at = ~left[page]
    lt, end, page, written, code, kind, name = lt[at], end[at], page[at], written[at], code[at], kind[at], name[at]
    open_ = np.append(0, np.cumsum((kind == _OPEN).astype(np.int64) - (kind == _CLOSE)))
    starts = np.searchsorted(page, np.arange(n + 1))
    tags, pages = np.arange(len(lt)), np.arange(n)
    opens, closes = np.flatnonzero(kind == _OPEN), np.flatnonzero(kind == _CLOSE)
    opens = opens[np.argsort(open_[opens], kind="stable")]
    closes = closes[np.argsort(open_[closes + 1], kind="stable")]
    left[page[opens[name[opens] != name[closes]]]] = True

    # texts: before, between and after a page's tags
    text_start, text_end = np.empty((2, len(lt) + n), np.int64)
    text_start[tags + page + 1], text_start[starts[:-1] + pages] = end, offs[:-1]
    text_end[tags + page], text_end[starts[1:] + pages] = lt, ends
    text_page = np.repeat(pages, np.diff(starts) + 1)
    at = np.flatnonzero((text_end > text_start) & ~left[text_page])
    found = _segments(data, text_start[at], text_end[at])
    texts = pc.utf8_trim(found, characters=_SPACES)
    coded = pc.match_substring(found, "&")
    if pc.any(coded).as_py():
        texts = pc.replace_with_mask(texts, coded, pa.array([unescape(t).strip() for t in found.filter(coded).to_pylist()], pa.string()))
    some = pc.greater(pc.binary_length(texts), 0)
    at, texts = at[some.to_numpy(zero_copy_only=False)], pa.concat_arrays([texts.filter(some)])

    # texts and tags in turn; nodes are the texts kept and the elements' tags
    events = 2 * len(lt) + n
    tag_at, text_at = 2 * tags + page + 1, 2 * at - text_page[at]
    elements = np.flatnonzero((kind == _OPEN) | (kind == _EMPTY))
    texts_before = _before(events, text_at)
    nodes_before = texts_before + _before(events, tag_at[elements])
    first = nodes_before[np.append(2 * starts[:-1] + pages, events)]
    size = int(first[-1])
    base = np.repeat(first[:-1], np.diff(first))
    pos, element_pos, text_pos = np.arange(size), nodes_before[tag_at[elements]], nodes_before[text_at]
    open_pos = nodes_before[tag_at[opens]]
    last = pos.copy()
    last[open_pos] = nodes_before[tag_at[closes]] - 1
    depth = np.empty(size, np.int64)
    depth[element_pos], depth[text_pos] = open_[elements], open_[at - text_page[at]]
    is_element = np.zeros(size, bool)
    is_element[element_pos] = True
    parent, prev = np.full((2, size), -1, np.int64)
    if fields is None or "parent" in fields or "prev" in fields:
        # by depth: the last element opened one level up is the parent
        order = np.argsort(depth.astype(np.uint16) if depth.max(initial=0) < 1 << 16 else depth, kind="stable")
        above = np.searchsorted(open_[opens] * size + open_pos, (depth[order] - 1) * size + order) - 1
        inner = depth[order] > 0
        parent[order[inner]] = open_pos[above[inner]]
        order = order[is_element[order]]
        same = (parent[order[1:]] == parent[order[:-1]]) & (base[order[1:]] == base[order[:-1]])
        prev[order[1:][same]] = order[:-1][same]

    # an element's text is one stretch of all texts
    text_from, text_to = np.zeros((2, size), np.int64)
    text_from[text_pos], text_to[text_pos] = np.arange(len(at)), np.arange(1, len(at) + 1)
    text_from[open_pos], text_to[open_pos] = texts_before[tag_at[opens]], texts_before[tag_at[closes]]
    chars = np.append(0, np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False)))
    long = is_element & (chars[text_to] - chars[text_from] > TEXT_CACHE_CHARS)
    text_offs = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(at) + 1].astype(np.int64) if len(at) else np.zeros(1, np.int64)
    text_data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(at) else np.zeros(0, np.uint8)
    length = np.where(long, 0, text_offs[text_to] - text_offs[text_from])
    offsets = np.append(0, np.cumsum(length))
    if offsets[-1] >= 1 << 31:
        raise OverflowError("texts of a batch beyond 2 GB")
    letters = text_data[np.repeat(text_offs[text_from] - offsets[:-1], length) + np.arange(offsets[-1])]
    txt = pa.StringArray.from_buffers(size, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters),
                                      pa.py_buffer(np.packbits(~long, bitorder="little")))

    at_tag = np.full(size, len(seen), np.int64)
    at_tag[element_pos] = code[elements]
    tag = np.zeros(size, np.int32)
    tag[element_pos] = name[elements]
    by_tag = pa.array(at_tag)
    ids, classes, hrefs = (pa.array([t[i] for t in seen], pa.string()) for i in (3, 4, 5))
    hrefs = pc.if_else(links, pc.utf8_slice_codeunits(distinct.dictionary, len(_LINK_START), -len(_LINK_END)), hrefs.take(alike.indices))
    at_written = np.full(size, len(distinct.dictionary), np.int64)
    at_written[element_pos] = written[elements]
    relative = lambda v: pa.array(np.where(v < 0, -1, v - base).astype(np.int32))
    of_tag = lambda values, at: pa.concat_arrays([values, pa.nulls(1, pa.string())]).take(at)
    columns = {"pos": lambda: relative(pos), "last": lambda: relative(last), "parent": lambda: relative(parent), "prev": lambda: relative(prev),
               "tag": lambda: pa.array(list(names), pa.string()).take(pa.array(tag)), "id": lambda: of_tag(ids, by_tag), "cls": lambda: of_tag(classes, by_tag),
               "href": lambda: of_tag(hrefs, pa.array(at_written)), "txt": lambda: txt, **dict.fromkeys(("up", "lvl", "lnk"), lambda: pa.nulls(size, pa.int32()))}
    kept = [f for f in _ARROW_NODE if fields is None or f.name in fields]
    struct = pa.StructArray.from_arrays([columns[f.name]() for f in kept], fields=kept)
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), struct), left


def _only(nodes: pa.Array, fields: list[str] | None) -> pa.Array:
    """The same node tables with the given fields only."""
    if fields is None:
        return nodes
    kept = [f for f in _ARROW_NODE if f.name in fields]
    struct = pa.StructArray.from_arrays([nodes.values.field(f.name) for f in kept], fields=kept)
    return pa.ListArray.from_arrays(nodes.offsets, struct, mask=nodes.is_null())


def _shred_batch(html: pa.Array, implied_ends: bool, fields: list[str] | None = None) -> tuple[pa.Array, pa.Array]:
    """Pages → (nodes, errors): those in plain markup at once, the others page by page."""
    if implied_ends or not len(html):
        nodes, errors = _shred_pages(html.to_pylist(), implied_ends)
        return _only(nodes, fields), errors
    nodes, left = _plain_nodes(html, fields)
    errors = pa.nulls(len(html), pa.string())
    if left.any():
        more, more_errors = _shred_pages(html.filter(pa.array(left)).to_pylist(), implied_ends)
        more = _only(more, fields)
        at = np.arange(len(html))
        at[left] = len(html) + np.arange(len(more))
        nodes, errors = (pa.concat_arrays(pair).take(pa.array(at)) for pair in ((nodes, more), (errors, more_errors)))
    return nodes, errors


# Bound on the HTML handled per output batch (rows and bytes).
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20


def _slices(batch: pa.RecordBatch, html_idx: int):
    """Split an input batch into slices of ≤ SLICE_ROWS rows and, past the
    first row, ≤ SLICE_BYTES of HTML."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(html_idx)), 0).to_pylist()
    start, acc = 0, 0
    for i, sz in enumerate(sizes):
        if i > start and (i - start >= SLICE_ROWS or acc + sz > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, acc = i, 0
        acc += sz
    yield batch.slice(start, n - start)


# The tokenizer is CPU-bound Python: where a caller asks for it, the input is
# dealt over this many tasks per core.
TASKS_PER_CORE = 4


def shred(df: DataFrame, html_col: str = "html", keep: list[str] | None = None, spread: bool = False,
          implied_ends: bool = False, fields: list[str] | None = None) -> DataFrame:
    """``df(keep..., html)`` → ``df(keep..., nodes, shred_error)``.

    Only the ``keep`` columns and the HTML cross into Python (column pruning
    does not reach through the Arrow stage, so callers select first).  Filters
    must also be applied *before* this call; Catalyst cannot push them through.
    The stage is narrow.  ``spread`` deals the pages anew first, for inputs that
    come in few partitions (one file, rendered fixtures); files at scale come
    in enough splits.  ``implied_ends`` closes elements whose end tag HTML lets
    pages leave out; the specialised folders' parsers ask for it.  ``fields``
    names those of a node that the caller reads (column pruning does not reach
    them either); the others are not worked out or passed on.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != html_col]
    src = df.select(*keep, html_col)
    if spread:
        src = src.repartition(src.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE)
    out_schema = T.StructType(
        [src.schema[c] for c in keep]
        + [T.StructField("nodes", NODES_TYPE if fields is None else T.ArrayType(T.StructType([f for f in NODE_TYPE if f.name in fields]))), T.StructField("shred_error", T.StringType())]
    )
    html_idx = len(keep)

    names = [f.name for f in out_schema.fields]

    def run(batches):
        for b in batches:
            # Node arrays are several times larger than the HTML: emit one
            # output batch per slice of at most SLICE_BYTES of input.
            for part in _slices(b, html_idx):
                nodes, errs = _shred_batch(part.column(html_idx), implied_ends, fields)
                arrays = [part.column(i) for i in range(len(keep))] + [nodes, errs]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return src.mapInArrow(run, out_schema)
