"""Plain, well nested pages read as columns: the nodes of many pages from a few passes over all their tags.

The nodes are those of ``html._Walker``, page by page. Pages that the passes cannot tell the nodes of (markup that is not
plain, tags that do not close each other, implied ends, tables or tenses within their like) are named, for the walker to read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fields of a table line that are the text of a cell.
FIELDS = ["pronoun", "refl", "aux", "full"]


class _Tags:
    """What each distinct tag text means, by its number; the last number stands for no tag."""

    def __init__(self, texts: list[str], plain_tag: Callable, is_doctype: Callable, closes: dict):
        size = len(texts) + 1
        self.known, self.doctype = np.ones(size, bool), np.zeros(size, bool)
        self.step, self.name = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.rule, self.field = np.full(size, -1), np.full(size, -1)
        flags = ("block", "tense", "h4", "relation", "table", "line", "aux", "either", "rectif")
        self.flags = {flag: np.zeros(size, bool) for flag in flags}
        self.tags = [None] * size
        numbers: dict[str, int] = {}
        for i, text in enumerate(texts):
            found = plain_tag(text)
            if not found:
                self.known[i], self.doctype[i] = False, is_doctype(text)
                continue
            tag, empty, closed = found
            if closed is not None:
                self.step[i], self.name[i] = -1, numbers.setdefault(closed, len(numbers))
            if tag is None or tag.void:
                continue
            self.step[i], self.name[i], self.tags[i] = 1, numbers.setdefault(tag.name, len(numbers)), tag
            variant = tag.name == "span" and bool({"or", "forme_rectif"} & set(tag.classes))
            self.known[i] = not empty and not (variant and tag.field)
            for flag, held in (
                ("block", tag.role == "block"), ("tense", tag.role == "block" and "tense" in tag.classes), ("h4", tag.role == "h4"),
                ("relation", "relation" in tag.classes), ("table", tag.role == "table"), ("line", tag.role == "line"),
                ("aux", tag.name == "td" and "conj_auxil" in tag.classes),
                ("either", variant and "or" in tag.classes), ("rectif", variant and "forme_rectif" in tag.classes),
            ):
                self.flags[flag][i] = held
            if tag.field:
                self.field[i] = FIELDS.index(tag.field)
        # What a start tag ends (by rule and name of an open element), and the names that it does not look past.
        rules = {name: number for number, name in enumerate(closes)}
        self.ends, self.until = np.zeros((len(closes), len(numbers) + 1), bool), np.zeros((len(closes), len(numbers) + 1), bool)
        for name, number in rules.items():
            for table, names in ((self.ends, closes[name][0]), (self.until, closes[name][1])):
                table[number, [numbers[other] for other in names if other in numbers]] = True
        for i, tag in enumerate(self.tags):
            if tag is not None and tag.name in rules:
                self.rule[i] = rules[tag.name]

    def columns(self) -> list[pa.Array]:
        names, ids = [tag and tag.name for tag in self.tags], [tag and tag.id for tag in self.tags]
        classes = [tag and tag.classes for tag in self.tags]
        return [pa.array(names, pa.string()), pa.array(ids, pa.string()), pa.array(classes, pa.list_(pa.string()))]


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(_ints(_before(counts)), values)


def _before(counts: np.ndarray) -> np.ndarray:
    """Sums of the counts before each place, and of all."""
    return np.concatenate([[0], np.cumsum(counts)])


def _struct(kind: pa.DataType, **columns: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays([columns[field.name] for field in kind], fields=list(kind))


def _offsets(texts: pa.Array) -> np.ndarray:
    if not len(texts):
        return np.zeros(1, np.int32)
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def _bytes(texts: pa.Array) -> pa.Buffer:
    return texts.buffers()[2] or pa.py_buffer(b"")


def _by_level(level: np.ndarray) -> np.ndarray:
    # Short numbers are sorted by their digits.
    return np.argsort(level.astype(np.int16) if level.size and level.max() < 1 << 15 else level, kind="stable")


def _parents(places: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Number of the element around each one, -1 for none; ``places`` of elements are in order and ``level`` counts those open."""
    if not len(places):
        return np.zeros(0, np.int64)
    by_level, width = _by_level(level), places[-1] + 1
    keys = (level * width + places)[by_level]
    at = np.searchsorted(keys, (level - 1) * width + places) - 1
    return np.where(level > 1, by_level[np.maximum(at, 0)], -1)


class _Pages:
    """Tags of pages one after the other. A piece is a tag with the text up to the next one; the first of a page has no tag."""

    def __init__(self, pages: pa.Array, plain_tag: Callable, is_doctype: Callable, closes: dict):
        bounds, html = _offsets(pages), np.frombuffer(_bytes(pages), np.uint8)
        opening = np.flatnonzero(html[bounds[0] : bounds[-1]] == ord("<")).astype(np.int32) + bounds[0]
        closing = np.flatnonzero(html[bounds[0] : bounds[-1]] == ord(">")).astype(np.int32) + bounds[0]
        self.first = np.searchsorted(opening, bounds[:-1]) + np.arange(len(pages))
        self.size = len(opening) + len(pages)
        self.counts = np.diff(np.append(self.first, self.size))
        self.page = np.repeat(np.arange(len(pages)), self.counts)
        leading = np.zeros(self.size, bool)
        leading[self.first] = True
        # A tag ends at the first bracket after it, before the next one begins.
        start = np.empty(self.size + 1, np.int32)
        start[:-1][leading], start[:-1][~leading], start[-1] = bounds[:-1], opening, bounds[-1]
        if len(opening) != len(closing) or (closing < opening).any() or (closing[:-1] > opening[1:]).any():
            closing = np.append(closing, bounds[-1])[np.searchsorted(closing, opening)]
        stop = start[:-1].copy()
        stop[~leading] = closing + 1
        wrong = stop > start[1:]
        pairs = np.empty(2 * self.size + 1, np.int32)
        pairs[::2], pairs[1::2] = start, np.minimum(stop, start[1:])
        both = pa.Array.from_buffers(pa.string(), 2 * self.size, [None, pa.array(pairs).buffers()[1], _bytes(pages)])
        tags = both.take(pa.array(np.flatnonzero(~leading) * 2)).dictionary_encode()
        self.tags = _Tags([text[1:-1] for text in tags.dictionary.to_pylist()], plain_tag, is_doctype, closes)
        self.none = len(tags.dictionary)
        self.code = np.full(self.size, self.none)
        self.code[~leading] = tags.indices.to_numpy()
        # A document type is no tag where a page begins with it.
        begins = np.zeros(self.size, bool)
        texts = both.take(pa.array(np.arange(self.size) * 2 + 1))
        width = pc.utf8_length(both).to_numpy()
        lengths = width[1::2]
        begins[1:] = leading[:-1] & ~leading[1:] & (lengths[:-1] == 0)
        wrong |= ~(self.tags.known[self.code] | (begins & self.tags.doctype[self.code]))
        self.bad = np.zeros(len(pages), bool)
        self.bad[self.page[wrong]] = True
        # Characters of the page before each tag and of the tag.
        self.at, self.length = self._of_page(width[::2] + lengths), width[::2]
        # Text with its entities read; a page that ends with one may end within it.
        coded = pc.match_substring(texts, "&").to_numpy(zero_copy_only=False)
        if coded.any():
            last = np.append(self.first[1:], self.size) - 1
            self.bad |= coded[last]
            read = [unescape(text) for text in texts.filter(pa.array(coded)).to_pylist()]
            texts = pc.replace_with_mask(texts, pa.array(coded), pa.array(read, pa.string()))
            lengths = pc.utf8_length(texts).to_numpy()
        self.texts = texts
        self.byte, self.bytes = _offsets(texts).astype(np.int64), np.frombuffer(_bytes(texts), np.uint8)
        self.text_at = self._of_page(lengths)
        self._nest()

    def _of_page(self, lengths: np.ndarray) -> np.ndarray:
        """Sums of the lengths before each piece in its page."""
        before = _before(lengths.astype(np.int64))[:-1]
        return before - before[self.first][self.page]

    def _drop(self, pages: np.ndarray) -> None:
        self.bad[pages] = True
        kept = ~self.bad[self.page[self.opens]]
        self.opens, self.ends, self.level = self.opens[kept], self.ends[kept], self.level[kept]

    def _nest(self) -> None:
        """Start tags (``opens``, in order), the end tag of each (``ends``) and how many elements are open with it (``level``)."""
        self.code[self.bad[self.page]] = self.none
        step = self.tags.step[self.code]
        total = np.cumsum(step)
        depth = total - (total - step)[self.first][self.page]
        last = np.append(self.first[1:], self.size) - 1
        self.bad |= (np.minimum.reduceat(depth, self.first) < 0) | (depth[last] != 0)
        self.code[self.bad[self.page]] = self.none
        step = self.tags.step[self.code]
        opens, closes = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.opens, self.level = opens, depth[opens]
        self.ends = np.empty(len(opens), np.int64)
        self.ends[_by_level(self.level)] = closes[_by_level(depth[closes] + 1)]
        name = self.tags.name[self.code]
        self._drop(self.page[opens[name[opens] != name[self.ends]]])
        self._drop(self._implied_ends())

    def _implied_ends(self) -> np.ndarray:
        """Pages in which a start tag ends open elements."""
        rule = self.tags.rule[self.code[self.opens]]
        name = self.tags.name[self.code[self.opens]]
        # Those around which something is open that they could end.
        doubtful = np.zeros(len(self.opens), bool)
        for ends in np.unique(self.tags.ends, axis=0):
            ended = ends[name]
            if ended.any():
                ending = (self.tags.ends == ends).all(axis=1)[rule] & (rule >= 0)
                doubtful |= ending & (self.level_of(np.flatnonzero(ended))[self.opens] > ended)
        if not doubtful.any():
            return np.zeros(0, np.int64)
        parent = _parents(self.opens, self.level)
        child = np.flatnonzero(doubtful)
        around, found = parent[child], []
        while len(child):
            past = ~self.tags.until[rule[child], name[around]]
            child, around = child[past], around[past]
            ended = self.tags.ends[rule[child], name[around]]
            found.append(self.page[self.opens[child[ended]]])
            around = parent[around]
            child, around = child[~ended & (around >= 0)], around[~ended & (around >= 0)]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def where(self, flag: str) -> np.ndarray:
        """Numbers of the elements that have a flag."""
        return np.flatnonzero(self.tags.flags[flag][self.code[self.opens]])

    def level_of(self, elements: np.ndarray) -> np.ndarray:
        """How many of ``elements`` are open after each piece."""
        step = np.zeros(self.size, np.int64)
        step[self.opens[elements]] += 1
        step[self.ends[elements]] -= 1
        return np.cumsum(step)

    def within(self, elements: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """Place in ``outer`` of the last one that begins before each of ``elements`` and ends after it, -1 for none; ``outer`` are not nested."""
        at = np.searchsorted(self.opens[outer], self.opens[elements]) - 1
        if not len(outer):
            return np.full(len(elements), -1)
        return np.where((at >= 0) & (self.ends[outer[at]] > self.opens[elements]), at, -1)

    def slices(self, elements: np.ndarray) -> pa.Array:
        """Text of each element, NULL for the number -1."""
        there = elements >= 0
        if not there.any():
            return pa.nulls(len(elements), pa.string())
        start = np.where(there, self.byte[self.opens[elements]], 0)
        sizes = np.where(there, self.byte[self.ends[elements]], 0) - start
        before = _before(sizes)
        found = self.bytes[np.repeat(start - before[:-1], sizes) + np.arange(before[-1])]
        valid = None if there.all() else pa.array(there).buffers()[1]
        return pa.Array.from_buffers(pa.string(), len(elements), [valid, _ints(before).buffers()[1], pa.py_buffer(found)])

    def text(self) -> pa.Array:
        offsets = self.byte[np.append(self.first, self.size)]
        return pa.Array.from_buffers(pa.string(), len(self.first), [None, _ints(offsets).buffers()[1], _bytes(self.texts)])

    def per_page(self, elements: np.ndarray) -> np.ndarray:
        return np.bincount(self.page[self.opens[elements]], minlength=len(self.first))


def _first_of(groups: np.ndarray, elements: np.ndarray, count: int) -> np.ndarray:
    """The first of ``elements`` in each group, -1 where there is none."""
    found = np.full(count, -1)
    found[groups[::-1]] = elements[::-1]
    return found


def _of_groups(groups: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(groups, minlength=count)


def scan(pages: pa.Array, kind: pa.StructType, parts: dict, plain_tag: Callable, is_doctype: Callable, closes: dict) -> tuple[pa.Array, np.ndarray]:
    """Nodes of pages, none of them NULL, as structs of ``kind``, and which pages they are not to be taken for."""
    p = _Pages(pages, plain_tag, is_doctype, closes)
    wanted = {field.name for field in kind}
    lined = "tenses" in wanted
    tenses = p.where("tense")
    tables, lines = p.where("table"), p.where("line")
    if wanted & {"tenses", "headings"}:
        # Within their like they share nodes.
        nested = [tenses, tables, lines] if lined else [tenses]
        within = np.concatenate([p.page[p.level_of(elements) > 1] for elements in nested])
        if len(within):
            p._drop(within)
            tenses, tables, lines = p.where("tense"), p.where("table"), p.where("line")
    columns: dict[str, pa.Array] = {"text": p.text()} if "text" in wanted else {}

    blocks = p.where("block")
    starts, ends = p.opens[blocks], p.ends[blocks]
    level = p.level_of(blocks)[starts]
    parent = _parents(starts, level)
    per_page = p.per_page(blocks)
    order = np.arange(len(blocks)) - _before(per_page)[:-1][p.page[starts]]
    offsets = _before(level - 1)
    above = np.zeros(offsets[-1], np.int64)
    around, at = parent[parent >= 0], offsets[1:][parent >= 0] - 1
    while len(around):
        above[at] = order[around]
        around = parent[around]
        around, at = around[around >= 0], at[around >= 0] - 1
    anc = pa.ListArray.from_arrays(_ints(offsets), _ints(above))
    tag_code = pa.array(p.code[starts])
    name, ident, classes = (column.take(tag_code) for column in p.tags.columns())
    end = p.at[ends] + p.length[ends]
    if "blocks" in wanted:
        nodes = _struct(
            parts["blocks"].value_type, ord=_ints(order), tag=name, id=ident, classes=classes, anc=anc, start=_ints(p.at[starts]),
            end=_ints(end), text_start=_ints(p.text_at[starts]), text_end=_ints(p.text_at[ends]),
        )
        columns["blocks"] = _lists(per_page, nodes)
    if wanted & {"tenses", "headings"}:
        place = np.searchsorted(blocks, tenses)
        count, per_page = len(tenses), p.per_page(tenses)
        titles = p.where("h4")
        of_tense = p.within(titles, tenses)
        titles, of_tense = titles[of_tense >= 0], of_tense[of_tense >= 0]
        relation = pa.array(p.tags.flags["relation"][p.code[p.opens[titles]]])
        heading = parts["headings"].value_type.field("headings").type.value_type
        about = {
            "ord": _ints(order[place]), "anc": anc.take(pa.array(place)), "start": _ints(p.at[starts[place]]), "end": _ints(end[place]),
            "headings": _lists(_of_groups(of_tense, count), _struct(heading, text=p.slices(titles), relation=relation)),
        }
        if "headings" in wanted:
            columns["headings"] = _lists(per_page, _struct(parts["headings"].value_type, **about))
    if lined:
        tense = parts["tenses"].value_type
        first_aux = _first_aux(p, tenses, tables)
        of_tense = p.within(lines, tenses)
        lines, of_tense = lines[of_tense >= 0], of_tense[of_tense >= 0]
        found = _lists(_of_groups(of_tense, count), _lines(p, lines, tense.field("lines").type.value_type))
        columns["tenses"] = _lists(per_page, _struct(tense, **about, first_aux=p.slices(first_aux), lines=found))
    return _struct(kind, **columns), p.bad


def _first_aux(p: _Pages, tenses: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The first auxiliary cell in the first table of each tense."""
    of_tense = p.within(tables, tenses)
    first = _first_of(of_tense[of_tense >= 0], tables[of_tense >= 0], len(tenses))
    holder = np.flatnonzero(first >= 0)
    firsts = first[holder]
    cells = p.where("aux")
    of_table = p.within(cells, firsts)
    return _first_of(holder[of_table[of_table >= 0]], cells[of_table >= 0], len(tenses))


def _lines(p: _Pages, lines: np.ndarray, kind: pa.StructType) -> pa.Array:
    count = len(lines)
    code = p.code[p.opens]
    fields = {}
    for number, field in enumerate(FIELDS):
        cells = np.flatnonzero(p.tags.field[code] == number)
        of_line = p.within(cells, lines)
        fields[field] = _first_of(of_line[of_line >= 0], cells[of_line >= 0], count)
    of_cell = np.flatnonzero(fields["full"] >= 0)
    verbs = fields["full"][of_cell]
    spans = np.flatnonzero(p.tags.flags["either"][code] | p.tags.flags["rectif"][code])
    verb = p.within(spans, verbs)
    spans, verb = spans[verb >= 0], verb[verb >= 0]
    has_or = np.zeros(count, bool)
    has_or[of_cell[verb[p.tags.flags["either"][code[spans]]]]] = True
    # Text of a variant directly under the cell is not part of the main form.
    skipped = p.level_of(spans[_parents(p.opens, p.level)[spans] == verbs[verb]])
    kept = (p.level_of(verbs) > 0) & (skipped == 0)
    texts = p.texts.filter(pa.array(kept))
    stop, there = np.zeros(count, np.int64), np.zeros(count, bool)
    stop[of_cell], there[of_cell] = _offsets(texts)[_before(kept)[p.ends[verbs]]], True
    # Texts follow each other; a line without a verb cell ends where the one before it does.
    bounds = _ints(np.maximum.accumulate(np.append(0, stop)))
    main = pa.Array.from_buffers(pa.string(), count, [pa.array(there).buffers()[1], bounds.buffers()[1], _bytes(texts)])
    rectif = p.tags.flags["rectif"][code[spans]]
    reforms, of_line = spans[rectif], of_cell[verb[rectif]]
    by_end = np.argsort(p.ends[reforms], kind="stable")
    rectifs = _lists(_of_groups(of_line, count), p.slices(reforms[by_end]))
    return _struct(kind, **{field: p.slices(cells) for field, cells in fields.items()}, main=main, has_or=pa.array(has_or), rectifs=rectifs)
