import random
import zipfile
from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import workbook_files
from replivote.sources import images, tables, workbook_sink, workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def test_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'he said "a, b"\nthen left'), (2, "x;y")], "id int, text string")
    tables.write_table(df, str(tmp_path / "c"), "csv")
    assert sorted(tables.scan_csv(spark, str(tmp_path / "c"), df.schema).collect()) == sorted(df.collect())
    assert tables.scan_csv(spark, str(tmp_path / "c")).schema["id"].dataType.simpleString() == "int"


def test_union_and_positions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, `a.b` string")
    b = spark.createDataFrame([(2, True)], "id int, flag boolean")
    assert sorted(tuple(r) for r in tables.union_by_name([a, b]).collect()) == [(1, "x", None), (2, None, True)]
    assert tables.select_by_position(a, {1: "author"}).first()["author"] == "x"


def test_names():
    name = tables.dataset_name
    assert name("text", "/in/data.csv", 10) == "data_text_analysis_10runs"
    assert name("text", "data.xlsx", 3, models=2) == "data_text_analysis_3runs_multi"
    assert name("image", runs=4, images=12) == "image_analysis_12images_4runs_multi"
    assert name("single", "d.csv", 2) == "d_custom_analysis_2runs"
    assert name("abstracts", "d.csv", theme="methods") == "d_methods_ai_responses"
    assert name("aggregate", "d.xlsx") == "d_aggregated_data"


def foreign_workbook(path):
    """A workbook as spreadsheet programs write it: shared strings, styles, gaps, two sheets."""
    sheet = f"""<worksheet {MAIN}><sheetData>
      <row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>when</t></is></c>
        <c r="E1" t="str"><v>ok</v></c></row>
      <row r="2"><c r="A2"><v>7</v></c><c r="B2" t="s"><v>2</v></c><c r="D2" s="1"><v>45292.5</v></c><c r="E2" t="b"><v>1</v></c></row>
      <row r="3"/>
      <row r="4"><c r="A4"><v>8.5</v></c><c r="D4" s="2"><v>45293</v></c><c r="E4" t="e"><v>#N/A</v></c></row>
    </sheetData></worksheet>"""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
            '<sheet name="Sheet1" sheetId="1" r:id="rId5"/><sheet name="Other" sheetId="2" r:id="rId6"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId6" Target="worksheets/b.xml"/><Relationship Id="rId5" Target="/xl/worksheets/a.xml"/></Relationships>',
        )
        z.writestr(
            "xl/sharedStrings.xml",
            f"<sst {MAIN}><si><t>id</t></si><si><t>text</t></si><si><r><t>rich </t></r><r><t>text_x000D_</t></r><rPh><t>no</t></rPh></si></sst>",
        )
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        )
        z.writestr("xl/worksheets/a.xml", sheet)
        z.writestr("xl/worksheets/b.xml", f'<worksheet {MAIN}><sheetData><row><c t="inlineStr"><is><t>id</t></is></c></row><row><c><v>99</v></c></row></sheetData></worksheet>')


def test_foreign_workbook(spark, tmp_path):
    foreign_workbook(tmp_path / "a.xlsx")
    schema = "id double, text string, `when` timestamp, ok boolean, absent string"
    got = [tuple(r) for r in workbooks.scan_workbooks(spark, str(tmp_path), schema).orderBy("id").collect()]
    assert got == [
        (7.0, "rich text\r", datetime(2024, 1, 1, 12), True, None),
        (8.5, None, datetime(2024, 1, 2), None, None),
    ]
    assert [r.id for r in workbooks.scan_workbooks(spark, str(tmp_path), "id long", "Other").collect()] == [99]
    with pytest.raises(Exception, match="not found"):
        workbooks.scan_workbooks(spark, str(tmp_path), "id long", "Absent").collect()


def test_workbook_roundtrip(spark, tmp_path):
    rows = [(1, "a <b> & \"c\"\r\n\tü\x01_x0041_", 1.5, True), (2, None, None, False), (3, " spaces ", 1e300, None)]
    df = spark.createDataFrame(rows, "n long, s string, d double, b boolean").repartition(2, "n")
    assert workbook_files.write_workbooks(df, str(tmp_path / "w")) == 3
    assert workbook_files.write_workbooks(df, str(tmp_path / "w")) == 3  # a repeat replaces its own files
    got = workbooks.scan_workbooks(spark, str(tmp_path / "w"), df.schema).orderBy("n").collect()
    assert [tuple(r) for r in got] == rows
    with pytest.raises(Exception, match="32767"):
        workbook_files.write_workbooks(spark.createDataFrame([("x" * 40000,)], "s string"), str(tmp_path / "too_long"))


def test_folder_reads_all_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("id,text\n2,y\n")
    (tmp_path / "c.txt").write_text("id,text\n3,z\n")
    workbook_files.write_workbooks(spark.createDataFrame([(4, "w")], "id int, text string"), str(tmp_path))
    got = tables.scan_folder(spark, str(tmp_path), "id int, text string")
    assert sorted((r.id, r.text) for r in got.collect()) == [(1, "x"), (2, "y"), (4, "w")]


def test_images(spark, tmp_path):
    names = ["b.JPG", "a b+%20.png", "c.jpeg.txt", "d", "e.webp", "f.tiff", "g.tif"]
    for n in names:
        (tmp_path / n).write_bytes(n.encode())
    (tmp_path / "folder.png").mkdir()
    (tmp_path / "folder.png" / "inner.png").write_bytes(b"x")
    got = {r.image: r.length for r in images.scan_images(spark, str(tmp_path)).select("image", "length").collect()}
    assert got == {n: len(n) for n in ("b.JPG", "a b+%20.png", "e.webp", "f.tiff")}


def test_bucketed_answers_vote_without_a_shuffle(spark, tmp_path):
    from replivote.operators.consensus import consensus_exact

    df = spark.range(100).select("id", F.lit("m").alias("model"), F.lit(1).alias("run"), F.lit("a").alias("response"))
    tables.write_responses(df, "bucketed_answers", str(tmp_path / "b"), "id", 4)
    voted = consensus_exact(spark.table("bucketed_answers"), ["id", "model"])
    plan = voted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and voted.count() == 100
    spark.sql("drop table bucketed_answers")


def test_csv_columns_go_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("text,id\ny,2\n")
    (tmp_path / "c.csv").write_text('id,more,text\n3,zzz,"a\nb"\n')
    (tmp_path / "d.csv").write_text("id\nnone\n")
    want = [(None, None), (1, "x"), (2, "y"), (3, "a\nb")]
    got = tables.scan_csv(spark, str(tmp_path), "id long, text string")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0] or 0) == want
    found = tables.scan_csv(spark, str(tmp_path))
    assert sorted(found.columns) == ["id", "more", "text"] and found.where("more = 'zzz'").first()["id"] == "3"
    (tmp_path / "empty").mkdir()
    assert tables.scan_csv(spark, str(tmp_path / "empty"), "id long").count() == 0


def test_workbook_columns_and_types_are_found(spark, tmp_path):
    workbook_files.write_workbooks(spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.0)], "id long, text string, v double").coalesce(1), str(tmp_path))
    workbook_files.write_workbooks(spark.createDataFrame([("x", 7)], "text string, extra long").coalesce(1), str(tmp_path / "more"))
    (tmp_path / "more" / "part-00000-0.xlsx").rename(tmp_path / "second.xlsx")
    got = workbooks.scan_workbooks(spark, str(tmp_path))
    assert dict(got.dtypes) == {"id": "bigint", "text": "string", "v": "double", "extra": "bigint"}
    assert got.where("extra = 7").first()["text"] == "x" and got.count() == 3


def test_cells_of_another_type_are_null(spark, tmp_path):
    df = spark.createDataFrame([("1.7", 1.7, 3), ("text", 2.0, 4)], "a string, b double, c long").coalesce(1)
    workbook_files.write_workbooks(df, str(tmp_path))
    got = workbooks.scan_workbooks(spark, str(tmp_path), "a double, b long, c string").collect()
    assert sorted(map(tuple, got), key=str) == [(1.7, None, "3"), (None, 2, "4")]


def test_workbook_sink_cuts_full_sheets_and_appends(spark, tmp_path):
    df = spark.range(10).select("id", F.concat(F.lit("t"), "id").alias("t")).coalesce(1)
    folder = tmp_path / "w"
    assert workbook_sink.write_workbooks(df, str(folder), max_rows=5) == 10
    assert sorted(f.name for f in folder.iterdir() if f.suffix == ".xlsx") == [f"part-00000-{k}.xlsx" for k in range(3)]
    (folder / "mine.xlsx").write_bytes((folder / "part-00000-2.xlsx").read_bytes())
    assert workbook_sink.write_workbooks(df, str(folder), mode="append") == 10
    got = workbooks.scan_workbooks(spark, str(folder), df.schema)
    assert sorted(r.id for r in got.collect()) == sorted([*range(10), *range(10), 8, 9])
    assert workbook_sink.write_workbooks(df, str(folder)) == 10
    assert sorted(f.name for f in folder.iterdir() if f.suffix == ".xlsx") == ["mine.xlsx", "part-00000-0.xlsx"]
    assert not [f for f in folder.iterdir() if f.name.startswith("_writing")]


def test_workbook_sink_empty_table_dates_and_odd_values(spark, tmp_path):
    schema = "d date, t timestamp, x double, m decimal(10,2), s string"
    day, time = datetime(2024, 2, 29).date(), datetime(2024, 2, 29, 13, 5, 7)
    rows = [(day, time, float("inf"), Decimal("1.25"), ""), (None, None, float("nan"), None, None)]
    df = spark.createDataFrame(rows, schema)
    workbook_sink.write_workbooks(df.coalesce(1), str(tmp_path / "a"))
    got = workbooks.scan_workbooks(spark, str(tmp_path / "a"), "d timestamp, t timestamp, x double, m double, s string").collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 2, 29), time, float("inf"), 1.25, "")]  # a row of empty cells is no row
    assert workbook_sink.write_workbooks(df.limit(0), str(tmp_path / "b")) == 0
    assert workbooks.scan_workbooks(spark, str(tmp_path / "b")).count() == 0 and (tmp_path / "b" / "part-00000-0.xlsx").exists()
    with pytest.raises(Exception, match="nested"):
        workbook_sink.write_workbooks(spark.createDataFrame([([1],)], "a array<int>"), str(tmp_path / "c"))


def test_a_failed_workbook_write_leaves_what_was_there(spark, tmp_path):
    good = spark.createDataFrame([("kept",)], "s string")
    workbook_sink.write_workbooks(good, str(tmp_path / "w"))
    bad = spark.createDataFrame([("fine",), ("x" * 40000,)], "s string").repartition(2)
    with pytest.raises(Exception, match="32767"):
        workbook_sink.write_workbooks(bad, str(tmp_path / "w"))
    assert [r.s for r in workbooks.scan_workbooks(spark, str(tmp_path / "w"), "s string").collect()] == ["kept"]
    assert not [f for f in (tmp_path / "w").iterdir() if f.name.startswith("_writing")]


def test_long_cells_and_back(spark, tmp_path):
    texts = ["", None, "a" * 16383, "b" * 16384, "\U0001f600" * 40000, " x\n" * 20000]
    df = spark.createDataFrame([(i, t, "k", None if i % 2 else t) for i, t in enumerate(texts)], "id long, `t.t` string, k string, u string")
    cut = workbook_sink.long_cells(df, ["t.t", "u"])
    assert cut.count() == 1 + 1 + 1 + 2 + 3 + 4
    workbook_sink.write_workbooks(cut, str(tmp_path / "w"))
    back = workbook_sink.whole_cells(workbooks.scan_workbooks(spark, str(tmp_path / "w"), cut.schema), "id", ["t.t", "u"])
    assert back.columns == df.columns and sorted(back.collect()) == sorted(df.collect())


def odd_table(spark, rows=400):
    """Cells of quotes, commas, line breaks of both kinds, and nothing."""
    import random

    local = random.Random(5)
    bits = ["a", "b c", '"', '""', ",", "\n", "\r\n", '","', '"\n"', " ", "é", "\U0001f600", ""]
    cells = [("".join(local.choices(bits, k=local.randint(0, 8))), local.choice([None, "x", '5" pipe', "line\nbreak" * 9])) for _ in range(rows)]
    return [(i, a or None, b) for i, (a, b) in enumerate(cells)]


@pytest.mark.parametrize("split, block", [("150b", 16), ("400b", 1 << 20), ("1m", 50)])
def test_one_csv_file_is_read_by_several_tasks(spark, tmp_path, split, block):
    import csv
    import io

    from replivote.sources.csv_records import csv_records

    rows = odd_table(spark, 60)
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n")):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as out:
            csv.writer(out, lineterminator=end).writerows([("id", "long\nname", "c"), *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = csv_records(spark, str(tmp_path), block)  # the lines are split and stored here
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    parsed = sorted((r.file[-5:], r.header, *next(csv.reader(io.StringIO(r.record, newline="")))) for r in got.collect())
    want = [(f, False, str(i), a or "", b or "") for f in ("a.csv", "b.csv") for i, a, b in rows]
    assert parsed == sorted(want + [(f, True, "id", "long\nname", "c") for f in ("a.csv", "b.csv")])


def test_csv_values_equal_those_of_a_whole_file_scan(spark, tmp_path):
    rows = spark.createDataFrame(odd_table(spark), "id long, a string, b string")
    tables.write_table(rows.coalesce(1), str(tmp_path / "t"), "csv")
    got = tables.scan_csv(spark, str(tmp_path / "t"), rows.schema)
    plain = spark.read.option("multiLine", True).option("escape", '"').option("header", True).schema(rows.schema).csv(str(tmp_path / "t"))
    assert sorted(got.collect()) == sorted(plain.collect()) and got.count() == 400


def test_quotes_of_a_line():
    from replivote.sources.csv_records import ends_inside

    outside = {b"": False, b'a,"b': True, b'a"b': False, b'5" pipe,x': False, b'"a""': True, b'"a"""': False, b'"a"b",c': False, b'"a", "b': False, b'x,"': True}
    assert {line: ends_inside(line, False) for line in outside} == outside
    inside = {b"": True, b'a"': False, b'a""': True, b'a","b': True, b'a",b': False, b'",""': False, b'"': False}
    assert {line: ends_inside(line, True) for line in inside} == inside


def test_csv_headers_that_lack_repeat_or_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,,id,text\r\n1,2,3,x\r\n\r\n4,,,\r\n".encode())
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "only.csv").write_bytes(b"text,id\n")
    for multi_line in (True, False):
        got = tables.scan_csv(spark, str(tmp_path), "id long, _c1 int, text string, absent date", multi_line)
        assert sorted(map(tuple, got.collect())) == [(1, 2, "x", None), (4, None, None, None)]


def test_workbooks_are_bounded_by_bytes(spark, tmp_path):
    local = random.Random(4)
    df = spark.createDataFrame([(i, "".join(local.choices("abcdefgh", k=3000))) for i in range(200)], "id long, t string").coalesce(1)
    assert workbook_sink.write_workbooks(df, str(tmp_path / "w"), max_bytes=50_000) == 200
    sizes = [f.stat().st_size for f in (tmp_path / "w").iterdir() if f.suffix == ".xlsx"]
    assert len(sizes) > 3 and max(sizes) < 100_000
    assert sorted(workbooks.scan_workbooks(spark, str(tmp_path / "w"), df.schema).collect()) == sorted(df.collect())
    assert workbook_sink.write_workbooks(df.limit(3), str(tmp_path / "v"), max_bytes=1) == 3  # a row a file at least


def test_rows_of_a_workbook_leave_in_bounded_batches():
    rows = iter([["t"], *[["x" * 1_000_000] for _ in range(9)]])
    found = [b.num_rows for b in workbooks._batches(rows, [("t", "string")], pa.schema([("t", pa.string())]))]
    assert sum(found) == 9 and max(found) <= 3
