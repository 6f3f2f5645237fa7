"""Readers and writers over real files."""

import csv

from inflecta.operators.documents import store_records
from inflecta.sources import files, sinks


def test_lines_rise_by_file_name_not_size(spark, rows, tmp_path):
    (tmp_path / "part-0.txt").write_text("x:OLD\n")
    (tmp_path / "part-1.txt").write_text("# long\n" * 500 + "x:NEW*\n")
    assert rows(files.parse_remaps(files.read_lines(spark, str(tmp_path)))) == [("x", "NEW")]


def test_flagged_report_keeps_blanks_and_doubles_quotes(spark, tmp_path):
    kind = "verb string, voice string, mood string, tense string, status string, flags array<struct<person:string,note:string>>, note string, auditor string, ts string"
    log = spark.createDataFrame([("v", "a", "m", "t", "flagged", [], ' say "no" ', "", "1")], kind)
    sinks.write_flagged_report(log, str(tmp_path / "report"))
    text = next((tmp_path / "report").glob("part-*")).read_text()
    assert '" say ""no"" "' in text
    assert list(csv.DictReader(text.splitlines()))[0]["note"] == ' say "no" '


def test_homonyms_are_listed_by_entry_id(spark, tmp_path):
    lines = [("x", "x", f"x_{i}", f"A{i:02d}") for i in (10, 2, 1, 11)]
    sinks.write_headwords(spark.createDataFrame(lines, "letter string, rank_verb string, verb string, verb_id string"), str(tmp_path / "list"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "list").glob("part-*")))
    assert text.split() == ["x_1:A01", "x_2:A02", "x_10:A10", "x_11:A11"]


def test_record_key_has_plain_apostrophes(spark, rows):
    entries = spark.createDataFrame([("s\u2019asseoir", "{}")], "verb string, entry string")
    assert rows(store_records(entries), "data") == [('{"s\'asseoir":{}}',)]


def test_document_is_read_by_lines(spark, rows, tmp_path):
    store = spark.createDataFrame([(v, f'{{"{v}":{{"n":{i}}}}}') for i, v in enumerate("abc")], "verb string, data string")
    sinks.write_document(store, str(tmp_path / "document"))
    assert rows(files.read_document(spark, str(tmp_path / "document"))) == [("a", '{"n":0}'), ("b", '{"n":1}'), ("c", '{"n":2}')]
