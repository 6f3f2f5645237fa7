"""Tokenising of HTML pages: the one function that runs in Python.

It reports where things are (blocks, table lines, list items, offsets) and decides nothing; every
rule on what they mean is a Spark expression over its result. A caller names the parts it reads, and
only these are kept track of, built and sent back.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inflecta.functions.scan import scan

# Ship this module with the function, so that executors need no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, and which open elements a start tag closes, up to which.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "tr": ({"td", "th", "tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
CLOSES.update({tag: ({"p"}, {"div", "td", "li", "article", "body"}) for tag in ("p", "div", "ul", "ol", "table", "article", "h4")})

_STRINGS = pa.list_(pa.string())
_SPAN = [("start", pa.int32()), ("end", pa.int32())]
_LINE = pa.struct(
    [(name, pa.string()) for name in ("pronoun", "refl", "aux", "full", "main")]
    + [("has_or", pa.bool_()), ("rectifs", _STRINGS)]
)
_HEADING = pa.struct([("text", pa.string()), ("relation", pa.bool_())])
_BLOCK = pa.struct(
    [("ord", pa.int32()), ("tag", pa.string()), ("id", pa.string()), ("classes", _STRINGS), ("anc", pa.list_(pa.int32()))]
    + _SPAN
    + [("text_start", pa.int32()), ("text_end", pa.int32())]
)
_TENSE = pa.struct(
    [("ord", pa.int32()), ("anc", pa.list_(pa.int32()))]
    + _SPAN
    + [("headings", pa.list_(_HEADING)), ("first_aux", pa.string()), ("lines", pa.list_(_LINE))]
)
_TITLED = pa.struct([field for field in _TENSE if field.name not in ("first_aux", "lines")])
_ITEM = pa.struct([("href", pa.string()), ("text", pa.string()), ("within", _STRINGS)])
#: What a page has: its text, its blocks, its tense blocks whole or with their headings only, its list items.
PARTS = {
    "text": pa.string(),
    "blocks": pa.list_(_BLOCK),
    "tenses": pa.list_(_TENSE),
    "headings": pa.list_(_TITLED),
    "items": pa.list_(_ITEM),
}


def _spark_type(arrow: pa.DataType) -> T.DataType:
    if pa.types.is_struct(arrow):
        return T.StructType([T.StructField(field.name, _spark_type(field.type)) for field in arrow])
    if pa.types.is_list(arrow):
        return T.ArrayType(_spark_type(arrow.value_type))
    return {pa.string(): T.StringType(), pa.int32(): T.IntegerType(), pa.bool_(): T.BooleanType()}[arrow]


# Plain markup: what the standard parser reads as the same events, without its tolerance for anything else.
_SPACE = r"[ \t\n\r\f]"
_ATTRIBUTE = rf"""{_SPACE}+([a-zA-Z][-a-zA-Z0-9_:]*)=(?:"([^"<>&]*)"|'([^'<>&]*)')"""
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_INSIDE = f"((?:{re.sub('[(](?![?])', '(?:', _ATTRIBUTE)})*){_SPACE}*"
# Elements whose content is not read as tags: the first three are plain up to their first end tag, others are not.
_RAW = "script|style|title"
_NAME = rf"(?!(?:{_RAW}|textarea|xmp|iframe|noembed|noframes|noscript|plaintext|svg|math)\b)([a-zA-Z][a-zA-Z0-9]*)"
_COMMENT = "!--(?:[^-<>]|-(?!-))*--"
_MARKUP = rf"/{_NAME}{_SPACE}*|{_NAME}{_INSIDE}(/?)"
_PLAIN = re.compile(rf"<(?:{_COMMENT}|({_RAW}){_INSIDE}>(.*?)</\1{_SPACE}*|{_MARKUP})>", re.IGNORECASE | re.DOTALL)
_TAG = re.compile(f"{_COMMENT}|{_MARKUP}", re.IGNORECASE)
_DOCTYPE = re.compile(r"<!DOCTYPE [a-zA-Z]+>", re.IGNORECASE)


class _Tag:
    """A start tag and what it can mean: its ``role``, and the ``field`` of a table line that it holds."""

    __slots__ = ("name", "id", "classes", "href", "closes", "void", "role", "field")

    def __init__(self, name: str, attributes: list[tuple[str, str | None]]):
        values = dict(attributes)
        self.name, self.id, self.classes = name, values.get("id"), (values.get("class") or "").split()
        self.href = values.get("href") or None
        self.closes, self.void = CLOSES.get(name), name in VOID
        self.field = self._field()
        if name in ("div", "article"):
            self.role = "block"
        elif name in ("li", "a", "h4", "table"):
            self.role = name
        elif name == "tr":
            self.role = "line" if "conj_line" in self.classes else None
        else:
            variant = name == "span" and ("or" in self.classes or "forme_rectif" in self.classes)
            self.role = "part" if self.field or variant else None

    def _field(self) -> str | None:
        # Class names of the table cells.
        if self.name == "span":
            return "pronoun" if "conj_pp" in self.classes else None
        if self.name == "td":
            for name, field in (("conj_refl-pron", "refl"), ("conj_auxil", "aux"), ("conj_verb", "full")):
                if name in self.classes:
                    return field
        return None


#: Plain tags by their text: pages repeat few. A start tag, whether it is empty and the name of an end tag.
_KNOWN: dict[str, tuple[_Tag | None, bool, str | None]] = {}
_NO_TAG = (None, False, None)
#: Tags and characters of a tag that are kept.
_KNOWN_TAGS, _KNOWN_LENGTH = 4096, 200


def _plain_tag(text: str) -> tuple[_Tag | None, bool, str | None] | None:
    """A tag (its text without the brackets) or comment of plain markup, None for anything else."""
    found = _KNOWN.get(text)
    if found is None and (match := _TAG.fullmatch(text)):
        closed, opened, attributes, empty = match.groups()
        tag = _Tag(opened.lower(), _attributes(attributes)) if opened else None
        found = tag, bool(empty), closed and closed.lower()
        if len(text) <= _KNOWN_LENGTH:
            if len(_KNOWN) >= _KNOWN_TAGS:
                _KNOWN.clear()
            _KNOWN[text] = found
    return found


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name.lower(), one or other) for name, one, other in _ATTRIBUTES.findall(text)] if text else []


class _Walker(HTMLParser):
    """Collects the wanted parts of one page while keeping a stack of open elements.

    A page of plain tags only is split at them, one of plain markup only is cut by one pattern; any other goes
    through the standard parser.
    """

    def __init__(self, html: str, parts: frozenset[str], plain: bool = True):
        self.html = html
        self.lined, self.listed = "tenses" in parts, "items" in parts
        self.titled = self.lined or "headings" in parts
        self.placed = self.titled or "blocks" in parts
        self.worded = self.titled or "text" in parts
        self.parts = parts
        wanted = (("block", self.placed), ("li", self.listed), ("a", self.listed), ("h4", self.titled), *((r, self.lined) for r in ("table", "line", "part")))
        self.openers = {role: getattr(_Walker, f"_open_{role}") for role, on in wanted if on}
        self.at: int | None = None  # where plain markup starts
        # Open elements: their names, and beside them their tags, where their text starts and what ends with them.
        self.names: list[str] = []
        self.opened: list[tuple[_Tag, int, list[tuple[str, object]] | None]] = []
        self.open: dict[str, list[dict]] = {kind: [] for kind in ("block", "tense", "line", "cell", "item")}
        self.tables: list[list[dict]] = []
        self.skipped = 0
        self.pieces: list[str] = []
        self.length = 0
        self.count = 0
        self.blocks: list[dict] = []
        self.tenses: list[dict] = []
        self.items: list[dict] = []
        if not (plain and (self._read_tags() or self._read_plain())):
            super().__init__(convert_charrefs=True)
            self.line_starts = [0, *(at.end() for at in re.finditer("\n", html))] if self.placed else []
            self.feed(html)
            self.close()
        self._close_down_to(0, len(html))

    def _read_tags(self) -> bool:
        """Whether all markup of the page is plain tags and comments; if so, it has been read."""
        html = self.html
        first, *pieces = html.split("<")
        start = _DOCTYPE.match(html)
        read = []
        for piece in pieces:
            text, closed, data = piece.partition(">")
            tag = _KNOWN.get(text) or _plain_tag(text) or (start and not read and _NO_TAG)
            if not tag or not closed:
                return False
            read.append((tag, len(text) + 2, data))
        if "&" in (read[-1][2] if read else first):
            return False
        if first:
            self.handle_data(unescape(first) if "&" in first else first)
        names, opened, worded, items, cells = self.names, self.opened, self.worded, self.open["item"], self.open["cell"]
        at = len(first)
        for (tag, empty, closed), length, data in read:
            self.at = at
            if tag is not None:
                self._start(tag)
                if empty and not tag.void:
                    self.handle_endtag(tag.name)
            elif closed is not None:
                if names and names[-1] == closed:
                    if opened[-1][2] is None:
                        names.pop()
                        opened.pop()
                    else:
                        self._close_down_to(len(names) - 1, at + length)
                else:
                    self.handle_endtag(closed)
            if data:
                at += len(data)
                if "&" in data:
                    data = unescape(data)
                if items or cells:
                    self.handle_data(data)
                else:
                    if worded:
                        self.pieces.append(data)
                    self.length += len(data)
            at += length
        return True

    def _read_plain(self) -> bool:
        """Whether all markup of the page is plain; if so, it has been read."""
        html = self.html
        start = _DOCTYPE.match(html)
        tags = list(_PLAIN.finditer(html))
        contents = [(tag[1].lower(), tag[3]) for tag in tags if tag[1]]
        if any("<" in content and (name == "title" or "<!--" in content or f"</{name}" in content.lower()) for name, content in contents):
            return False
        if len(tags) + (start is not None) + sum(1 + content.count("<") for _, content in contents) != html.count("<"):
            return False
        end = start.end() if start else 0
        if "&" in html[tags[-1].end() if tags else end :]:
            return False
        for tag in tags:
            self.at = tag.start()
            if end < self.at:
                self.handle_data(unescape(html[end : self.at]))
            end = tag.end()
            raw, raw_attributes, content, closed, opened, attributes, empty = tag.groups()
            if opened:
                (self.handle_startendtag if empty else self.handle_starttag)(opened.lower(), _attributes(attributes))
            elif closed:
                self.handle_endtag(closed.lower())
            elif raw:
                raw = raw.lower()
                self.handle_starttag(raw, _attributes(raw_attributes))
                if content:
                    self.handle_data(unescape(content) if raw == "title" else content)
                self.at = html.rindex("</", self.at, end)
                self.handle_endtag(raw)
        if end < len(html):
            self.handle_data(html[end:])
        return True

    def nodes(self) -> dict:
        text = "".join(self.pieces)
        for item in self.items:
            item["text"] = " ".join(piece for piece in (p.strip() for p in item.pop("pieces")) if piece)
        for tense in self.tenses:
            # A block within another shares its headings and lines with it.
            for heading in tense["headings"]:
                if "span" in heading:
                    heading["text"] = text[slice(*heading.pop("span"))]
            if not self.lined:
                continue
            tense["first_aux"] = None if tense["aux_span"] is None else text[slice(*tense["aux_span"])]
            for line in tense["lines"]:
                if "spans" not in line:
                    continue
                for name, (start, end) in line.pop("spans").items():
                    line[name] = text[start:end]
                line["main"] = None if line["main"] is None else "".join(line["main"])
                line["rectifs"] = [text[start:end] for start, end in line["rectifs"]]
        found = {"text": text, "blocks": self.blocks, "tenses": self.tenses, "headings": self.tenses, "items": self.items}
        return {part: found[part] for part in self.parts}

    def _offset(self) -> int:
        if not self.placed:
            return 0
        if self.at is not None:
            return self.at
        line, column = self.getpos()
        return self.line_starts[line - 1] + column

    def _start(self, tag: _Tag) -> None:
        names = self.names
        if tag.closes is not None:
            closed, until = tag.closes
            if names and names[-1] not in until:
                for depth in range(len(names) - 1, -1, -1):
                    name = names[depth]
                    if name in until:
                        break
                    if name in closed:
                        self._close_down_to(depth, self._offset())
        if tag.void:
            return
        opener = self.openers.get(tag.role)
        ends = opener(self, tag) if opener else None
        names.append(tag.name)
        self.opened.append((tag, self.length, ends))

    def handle_starttag(self, tag, attrs):
        self._start(_Tag(tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        names = self.names
        for depth in range(len(names) - 1, -1, -1):
            if names[depth] == tag:
                start = self._offset()
                self._close_down_to(depth + 1, start)
                self._close_down_to(depth, self.html.find(">", start) + 1 if self.placed else 0)
                return

    def handle_data(self, data):
        if self.names and self.names[-1] in ("script", "style"):
            return
        if self.worded:
            self.pieces.append(data)
        self.length += len(data)
        for item in self.open["item"]:
            item["pieces"].append(data)
        if not self.skipped:
            for cell in self.open["cell"]:
                cell["main"].append(data)

    def _path(self) -> list[str]:
        path = []
        for tag, _, _ in self.opened:
            path.append(tag.name)
            path += [f"{tag.name}.{name}" for name in tag.classes]
            if tag.id:
                path.append(f"{tag.name}#{tag.id}")
        return path

    # What a start tag opens: each returns what ends with its element, as pairs of a kind and a node.

    def _enter(self, kind: str, node: dict) -> tuple[str, dict]:
        self.open[kind].append(node)
        return kind, node

    def _open_block(self, tag: _Tag) -> list:
        block = {
            "ord": self.count,
            "tag": tag.name,
            "id": tag.id,
            "classes": tag.classes,
            "anc": [b["ord"] for b in self.open["block"]],
            "start": self._offset(),
            "text_start": self.length,
        }
        self.count += 1
        self.blocks.append(block)
        ends = [self._enter("block", block)]
        if self.titled and "tense" in tag.classes:
            tense = {
                "ord": block["ord"], "anc": block["anc"], "start": block["start"],
                "headings": [], "lines": [], "tables": 0, "aux_span": None,
            }
            self.tenses.append(tense)
            ends.append(self._enter("tense", tense))
        return ends

    def _open_li(self, tag: _Tag) -> list:
        item = {"href": None, "first": True, "pieces": [], "within": self._path()}
        self.items.append(item)
        return [self._enter("item", item)]

    def _open_a(self, tag: _Tag) -> None:
        for item in self.open["item"]:
            if item["first"]:
                item["first"], item["href"] = False, tag.href

    def _open_h4(self, tag: _Tag) -> list | None:
        if not self.open["tense"]:
            return None
        heading = {"relation": "relation" in tag.classes}
        for tense in self.open["tense"]:
            tense["headings"].append(heading)
        return [("heading", heading)]

    def _open_table(self, tag: _Tag) -> list | None:
        if not self.open["tense"]:
            return None
        for tense in self.open["tense"]:
            tense["tables"] += 1
        first_of = [tense for tense in self.open["tense"] if tense["tables"] == 1]
        self.tables.append(first_of)
        return [("table", first_of)]

    def _open_line(self, tag: _Tag) -> list | None:
        if not self.open["tense"]:
            return None
        line = {"main": None, "has_or": False, "rectifs": [], "spans": {}}
        for tense in self.open["tense"]:
            tense["lines"].append(line)
        return [self._enter("line", line)]

    def _open_part(self, tag: _Tag) -> list | None:
        """A cell of a table line, or a span in one."""
        if not self.open["tense"]:
            return None
        ends, lines, name = [], self.open["line"], tag.field
        if tag.name == "td" and "conj_auxil" in tag.classes:
            ends = [("first_aux", t) for tenses in self.tables for t in tenses if t["aux_span"] is None]
        if lines:
            line = lines[-1]
            if name and name not in line["spans"]:
                line["spans"][name] = None
                ends.append((name, line))
                if name == "full":
                    line["main"] = []
                    ends.append(self._enter("cell", line))
            elif tag.name == "span" and self.open["cell"]:
                ends += self._open_variant(tag)
        return ends or None

    def _open_variant(self, tag: _Tag) -> list:
        """A span in a verb cell; text of a variant directly under the cell is not part of the main form."""
        ends, cell = [], self.open["cell"][-1]
        is_or, is_reform = "or" in tag.classes, "forme_rectif" in tag.classes
        cell["has_or"] = cell["has_or"] or is_or
        if is_reform:
            ends.append(("rectif", cell))
        if (is_or or is_reform) and any(kind == "cell" for kind, _ in self.opened[-1][2] or ()):
            ends.append(("skip", cell))
            self.skipped += 1
        return ends

    def _close_down_to(self, depth: int, offset: int) -> None:
        while len(self.names) > depth:
            self.names.pop()
            _, at, ends = self.opened.pop()
            for kind, node in ends or ():
                if kind == "block":
                    self.open[kind].pop()
                    node["end"], node["text_end"] = offset, self.length
                elif kind == "tense":
                    self.open[kind].pop()
                    node["end"] = offset
                elif kind in ("line", "cell", "item"):
                    self.open[kind].pop()
                elif kind == "skip":
                    self.skipped -= 1
                elif kind == "table":
                    self.tables.pop()
                elif kind == "heading":
                    node["span"] = (at, self.length)
                elif kind == "rectif":
                    node["rectifs"].append((at, self.length))
                elif kind == "first_aux":
                    node["aux_span"] = (at, self.length)
                else:
                    node["spans"][kind] = (at, self.length)


def _walk(html: str | None, parts: frozenset[str]) -> dict | None:
    if html is None:
        return None
    try:
        return _Walker(html, parts).nodes()
    except (AssertionError, ValueError, IndexError):  # what the standard parser raises on malformed declarations
        return None


#: Pages whose nodes are held as Python objects at a time.
PAGES_AT_ONCE = 32


def _kind(parts: Iterable[str]) -> pa.DataType:
    return pa.struct([(part, arrow) for part, arrow in PARTS.items() if part in parts])


#: Pages that are scanned at a time, and their bytes unless one page has more.
PAGES_SCANNED, BYTES_SCANNED = 512, 4 << 20


def _walked(pages: pa.Array, parts: frozenset[str], kind: pa.DataType) -> list[pa.Array]:
    few = []
    for at in range(0, max(len(pages), 1), PAGES_AT_ONCE):
        few.append(pa.array([_walk(page, parts) for page in pages.slice(at, PAGES_AT_ONCE).to_pylist()], type=kind))
    return few


def _is_doctype(text: str) -> bool:
    return _DOCTYPE.fullmatch(f"<{text}>") is not None


def _scanned(pages: pa.Array, parts: frozenset[str], kind: pa.DataType) -> pa.Array:
    """Nodes of pages; those that are not to be scanned are walked."""
    there = pages.is_valid().to_numpy(zero_copy_only=False)
    if not there.any():
        return pa.nulls(len(pages), kind)
    found, other = scan(pages.drop_null(), kind, PARTS, _plain_tag, _is_doctype, CLOSES)
    walked = ~there
    walked[there] = other
    if not walked.any():
        return found
    place = np.cumsum(there) - 1
    place[walked] = len(found) + np.arange(walked.sum())
    return pa.concat_arrays([found, *_walked(pages.filter(pa.array(walked)), parts, kind)]).take(pa.array(place))


def arrow_nodes(pages: pa.Array, parts: frozenset[str]) -> pa.Array:
    """The nodes of a batch. It may hold ten thousand pages: those of a few are Python objects at a time."""
    kind, few = _kind(parts), []
    if "blocks" not in parts or "items" in parts or not len(pages):
        return pa.concat_arrays(_walked(pages, parts, kind))
    before = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False))])
    at = 0
    while at < len(pages):
        fitting = int(np.searchsorted(before, before[at] + BYTES_SCANNED, side="right")) - 1
        size = max(1, min(fitting - at, PAGES_SCANNED))
        few.append(_scanned(pages.slice(at, size), parts, kind))
        at += size
    return pa.concat_arrays(few)


def page_nodes(html: str | Column, *parts: str) -> Column:
    """A struct of the named ``PARTS`` of each page, NULL for a malformed one."""
    kind, wanted = _kind(parts), frozenset(parts)
    if not wanted or wanted - PARTS.keys():
        raise ValueError(f"parts are {', '.join(PARTS)}")

    @F.arrow_udf(_spark_type(kind))
    def nodes(pages: pa.Array) -> pa.Array:
        return arrow_nodes(pages, wanted)

    # Marked non-deterministic so that the optimizer never evaluates it twice for one page.
    return nodes.asNondeterministic()(html)
