from inflecta.operators import headwords as hw
from inflecta.sources import files, sinks


def lines(spark, text):
    return spark.createDataFrame(list(enumerate(text.split("\n"))), "line_no long, value string")


def test_line_formats(spark, rows):
    assert rows(files.parse_headwords(lines(spark, "aller:A9A1\n\n  être \nx: A:9 "))) == [("aller", "A9A1"), ("x", "A:9"), ("être", None)]
    assert rows(files.parse_exclusions(lines(spark, "# no\nforhuir:A9F1266*\n\nnul\nnul:x\n:A9"))) == [("forhuir",), ("nul",)]
    assert rows(files.parse_remaps(lines(spark, "a:A8D1*\nb:\n#c:d\na: A8D2**\nd"))) == [("a", "A8D2")]
    assert files.count_lines(lines(spark, "a\n \nb")).first()[:] == (3, 2)


def test_files(spark, rows, tmp_path):
    (tmp_path / "naître.html").write_text("<p>é</p>", encoding="utf-8")
    (tmp_path / "other.txt").write_text("x")
    pages = files.scan_pages(spark, str(tmp_path))
    assert rows(pages) == [("naître", "<p>é</p>")]
    heads = files.parse_headwords(lines(spark, "naître:A9N1\nx:A9X1"))
    # A headword without a page stays, to be reported.
    assert rows(files.pages_of_headwords(pages, heads)) == [("naître", "A9N1", "<p>é</p>"), ("x", "A9X1", None)]
    (tmp_path / "list.txt").write_text("b:2\na:1", encoding="utf-8")
    assert rows(files.parse_headwords(files.read_lines(spark, str(tmp_path / "list.txt")))) == [("a", "1"), ("b", "2")]
    (tmp_path / "doc.json").write_text('{"a": {"h_aspire": true}, "b": {}}', encoding="utf-8")
    assert rows(files.read_document(spark, str(tmp_path / "doc.json"))) == [("a", '{"h_aspire":true}'), ("b", "{}")]


def test_store_and_document(spark, rows, tmp_path):
    old = spark.createDataFrame([("a", '{"a":{"x":1}}'), ("b", '{"b":{}}')], "verb string, data string")
    new = spark.createDataFrame([("b", '{"b":{"y":2}}'), ("é", '{"é":{}}')], "verb string, data string")
    store = sinks.upsert_store(old, new)
    store.write.parquet(str(tmp_path / "store"))
    store = files.read_store(spark, str(tmp_path / "store"))
    assert [r.verb for r in store.collect()] == ["a", "b", "é"]
    sinks.write_document(store, str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*"))).replace("\n", "")
    assert text == '{"a":{"x":1},"b":{"y":2},"é":{}}'


def test_search(spark, rows):
    response = (
        '{"result":[{"nature":"n. m.","label":"partir","url":"/a/1"},{"nature":"v. intr. Défectif","label":"partir","url":"/a/2"},'
        '{"nature":"v. intr.","label":"partir (se)","url":"/a/3"},{"nature":"v.","label":"repartir","url":"/a/4"},{"nature":"v.","label":"partir","url":"/a/5"}]}'
    )
    data = [("partir", response), ("seul", '{"result":[{"nature":"v. défectif","label":"seul","url":"u/7"}]}'), ("rien", "{}"), ("s'x", '{"result":[{"nature":"v.","label":"s’x (s\')","url":"9"}]}')]
    responses = spark.createDataFrame(data, "verb string, response string")
    assert rows(files.resolve_entries(files.search_candidates(responses))) == [("partir", "3"), ("s'x", "9"), ("seul", "7")]


LISTING = """<div id="colGaucheResultat"><ul class="listColGauche x"><li><a href="/a/A9P2">I. <b>partir</b></a>, v. intr.</li>
<li><a href="/a/A9P1">II. partir (se), v.<li><a href="/a/A9P3">parler, v.</a></li><li><a href="/a/A8P4">pâtir, v.</a></li><li>none</li>
<li><a href="/a/A9N0806">nul, v.</a></li><li><a href="/a/A9P9">s’empêtrer (s’), v.</a></li><li><a href="/a/A9P7">paître, v.</a></ul></div><ul><li><a href="/x">out</a></ul>"""


def test_headword_list(spark, rows, tmp_path):
    pages = spark.createDataFrame([("p", LISTING)], "letter string, html string")
    items = hw.listing_items(pages)
    assert ("p", "/a/A9P2", "I. partir , v. intr.") in rows(items)
    hits = hw.search_hits(items)
    exclude = spark.createDataFrame([("nul",)], "verb string")
    remap = spark.createDataFrame([("paître", "A8X"), ("pâtir", "A8P4"), ("absent", "A8")], "verb string, verb_id string")
    words = hw.headword_list(hits, exclude, remap)
    assert rows(words, "verb", "verb_id") == [
        ("parler", "A9P3"), ("partir_1", "A9P1"), ("partir_2", "A9P2"), ("paître", "A8X"), ("s'empêtrer", "A9P9"),
    ]
    sinks.write_headwords(words, str(tmp_path / "words"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "words").glob("part-*")))
    assert text.split() == ["parler:A9P3", "partir_1:A9P1", "partir_2:A9P2", "paître:A8X", "s'empêtrer:A9P9"]
    store = spark.createDataFrame([("parler",)], "verb string")
    assert hw.pending(words, store).count() == 4 and hw.pending(words, store, ignore_store=True).count() == 5
