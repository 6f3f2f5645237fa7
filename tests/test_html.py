"""The tokeniser: plain pages are read as the standard parser reads them, and a caller gets the parts it names."""

import random

import pyarrow as pa
import pytest

from inflecta.functions import html as h
from tests.pages import alternative, line, mood, page, reform, tense, voice

FRAGMENTS = [
    "<div>", "</div>", '<div id="a" class="tense x">', "<DIV ID='b'>", '<div class="grid" >', "</div >", "<article>", "</article>", "<ul>", "</ul>", "<li>", "</li>",
    '<a href="/x/y">', "<a href=''>", "</a>", "<p>", "</p>", "<br>", "<br/>", "<hr />", "<table>", "</table>", '<tr class="conj_line">', "</tr>", '<td class="conj_verb">', "<td>",
    "<!-- ad 0 -->", "<!---->", "<title>a &amp; b</title>", "<style>p{margin:0}</style>", '<script>var t="</p>";</script>', "<SCRIPT></script >", '<script src="x"> </script>',
    "</td>", '<td class="conj_auxil">', '<td class="conj_refl-pron">', '<span class="conj_pp">', '<span class="or">', '<span class="forme_rectif">', "<span>", "</span>",
    '<h4 class="relation">', "<h4>", "</h4>", "je ", "parlé", "\n", " ", " ou ", "a &amp; b", "&lt;", "&nbsp;", "&", "&copy", "x > y",
]
ODD = [
    "<!-- <div> -->", "<!--->", "<!-- a --->", "<!-- a -- b -->", "<script><!-- <script> </script>", "<script></scripts></script>", "</script>", "<title>", "</title>", "<script>", "<!DOCTYPE html>", "<script>if (a<b) {}</script>", "<style>", "<title>a<b></title>", "<", "< div>", "<div", "<div id=a>", '<div id="a&amp;b">', "<div a b>",
    '<div id="x>y">', '<div id="x"id="y">', "<![CDATA[x]]>", "<?x?>", "</>", "</div x>", "<1>", "<x-y>", "<div\x0bid='a'>", '<div id = "s">', "<textarea><p></textarea>", "<div/>", "\r\n", "<svg>",
]


def read(html, parts, plain):
    try:
        return h._Walker(html, frozenset(parts), plain).nodes()
    except (AssertionError, ValueError, IndexError) as error:
        return type(error)


@pytest.mark.parametrize("odd", [0.0, 0.06])
def test_plain_pages_are_read_alike(odd):
    draw, plain = random.Random(17), 0
    for _ in range(3000):
        parts = [draw.choice(ODD if draw.random() < odd else FRAGMENTS) for _ in range(draw.randint(0, 40))]
        text = draw.choice(["", "<!doctype html>", "\n"]) + "".join(parts)
        plain += h._Walker(text, frozenset(["text"])).at is not None
        assert read(text, h.PARTS, True) == read(text, h.PARTS, False), text
    assert plain > 300


def test_parts_are_those_of_the_whole():
    draw = random.Random(19)
    for _ in range(300):
        text = "".join(draw.choice(FRAGMENTS + ODD[:3]) for _ in range(40))
        whole = read(text, h.PARTS, True)
        for part in h.PARTS:
            got = read(text, [part], True)
            if part == "headings":
                fields = {"ord", "anc", "start", "end", "headings"}
                assert [{k: v for k, v in t.items() if k in fields} for t in got[part]] == [{k: v for k, v in t.items() if k in fields} for t in whole["tenses"]]
            else:
                assert got == {part: whole[part]}


def test_parts_of_a_column(spark):
    text = page("A9X", voice("voix_prono", mood("prono_ind", tense("Présent", line("assieds" + alternative("assois"), "je ", "m’"), line("naît" + reform("nait"), "il "))))) + "<ul><li><a href='/a/b'>x</a></li></ul>"
    pages = spark.createDataFrame([(text,), (None,), ("<![foo[bar]]>",)], "html string")
    got = [r.n for r in pages.select(h.page_nodes("html", "items").alias("n")).collect()]
    assert got[0].asDict(recursive=True) == {"items": [{"href": "/a/b", "text": "x", "within": ["ul"]}]} and got[1] is None and got[2] is None
    assert pages.select(h.page_nodes("html", "headings", "text").alias("n")).schema["n"].dataType.names == ["text", "headings"]
    for parts in ((), ("links",)):
        with pytest.raises(ValueError, match="parts are"):
            h.page_nodes("html", *parts)


def test_nodes_of_few_pages_are_held_at_a_time(monkeypatch):
    held, most = [], []

    def walk(page, parts):
        held.append(page)
        return {"text": page}

    class Arrow:
        def __getattr__(self, name):
            return getattr(pa, name)

        def array(self, values, **more):
            most.append(len(held))
            held.clear()
            return pa.array(values, **more)

    monkeypatch.setattr(h, "_walk", walk)
    monkeypatch.setattr(h, "pa", Arrow())
    pages = pa.array([f"p{i}" for i in range(1000)])
    assert h.arrow_nodes(pages, frozenset(["text"])).field("text").to_pylist() == pages.to_pylist()
    assert max(most) <= h.PAGES_AT_ONCE and h.arrow_nodes(pages.slice(0, 0), frozenset(["text"])).to_pylist() == []


def test_tags_that_repeat_are_read_once():
    h._KNOWN.clear()
    assert read('<div class="a">x</div><div class="a">y</div>', ["text"], True) == {"text": "xy"}
    assert set(h._KNOWN) == {'div class="a"', "/div"}
    h._Walker("".join(f'<p id="{i}">' for i in range(2 * h._KNOWN_TAGS)), frozenset(["text"]))
    assert len(h._KNOWN) <= h._KNOWN_TAGS


def nested(draw, depth=0):
    """Well nested markup of tags that mean something where they stand, and anywhere else."""
    names = ["div", "div", "article", "p", "table", "span", "h4", "ul", "li", "tr", "td", "b"]
    attributes = [
        "", ' id="a"', ' class="tense x"', ' class="tense"', " class='grid' id='b'", ' class="conj_line"', ' class="conj_verb"', ' class="conj_auxil"', ' class="conj_refl-pron conj_verb"',
        ' class="conj_pp"', ' class="or"', ' class="forme_rectif"', ' class="relation"', ' class="or forme_rectif"',
    ]
    parts = []
    for _ in range(draw.randint(0, 4 if depth else 8)):
        if depth < 6 and draw.random() < 0.6:
            name = draw.choice(names)
            parts.append(f"<{name}{draw.choice(attributes)}>{nested(draw, depth + 1)}</{name}>")
        else:
            parts.append(draw.choice(["je ", "é, ée", " ", "\n", " x > y ", "&amp;", "&nbsp;a", "<br>", "<hr/>", "<!-- n -->", "𝄞", tense(*["x"], line("va" + reform("v") + alternative("u"), "je ", "s’", "a"), line(), line(None, "tu "))]))
    return "".join(parts)


@pytest.mark.parametrize("parts", [("text", "blocks", "tenses"), ("blocks",), ("blocks", "headings")])
def test_scanned_pages_have_the_nodes_of_walked_ones(parts, monkeypatch):
    draw, wanted, walked = random.Random(23), frozenset(parts), []
    kind, walk = h._kind(wanted), h._walk
    pages = [None, "", "x", "a > b", "<", ">", "<!doctype html>", "x<!doctype html>", "<!doctype html><!doctype html>", "<div", "<![foo[bar]]>", "a &amp; b", "<p>a</p>&amp", "<div/>", "<br/>"]
    pages += [draw.choice(["", "<!DOCTYPE html>", "\n"]) + nested(draw) for _ in range(400)]
    pages += ["".join(draw.choice(ODD if draw.random() < 0.02 else FRAGMENTS) for _ in range(draw.randint(0, 12))) for _ in range(300)]
    pages += [indicative(draw) for _ in range(100)]
    draw.shuffle(pages)
    expected = pa.array([walk(text, wanted) for text in pages], type=kind)
    monkeypatch.setattr(h, "_walk", lambda text, parts: walked.append(text) or walk(text, parts))
    for scanned, size in ((512, 4 << 20), (7, 4 << 20), (512, 3000)):
        monkeypatch.setattr(h, "PAGES_SCANNED", scanned)
        monkeypatch.setattr(h, "BYTES_SCANNED", size)
        walked.clear()
        got = h.arrow_nodes(pa.array([None, *pages, None]).slice(1, len(pages)), wanted)
        got.validate(full=True)
        assert got.type == kind and got.to_pylist() == expected.to_pylist()
        # Markup that is not plain, not well nested or tables and tenses within their like are left to the walker.
        assert len(pages) - len(walked) > 200


def indicative(draw):
    lines = [line("connaît" + reform("connait"), "il, elle "), line("dû, due" + reform("du"), "nous ", refl="nous", aux="avons"), line("a" + alternative("b")), line(None, "je ")]
    tenses = [tense(title, *draw.sample(lines, draw.randint(0, 4))) for title in ("Présent", "Passé composé", "Imparfait")]
    return page("A9X", "<p>(H aspiré)</p>", voice("voix_prono", mood("prono_ind", *tenses), mood("prono_imp", tenses[0])))


def test_pages_of_conjugations_are_scanned(monkeypatch):
    pages = pa.array([indicative(random.Random(i)) for i in range(50)])
    expected = pa.concat_arrays(h._walked(pages, frozenset(["text", "blocks", "tenses"]), h._kind(["text", "blocks", "tenses"])))
    monkeypatch.setattr(h, "_walk", None)
    assert h.arrow_nodes(pages, frozenset(["text", "blocks", "tenses"])).equals(expected)
