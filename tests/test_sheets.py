"""Sheets cut into records by many tasks, against a sequential parser."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from codespan.sources import files, sheets


def sequential(text, comments):
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if comments == "top":
        while lines and lines[0].startswith("#"):
            lines.pop(0)
    out = []
    for row in csv.reader(io.StringIO("\n".join(lines), newline="")):
        if row and not (comments == "anywhere" and row[0].startswith("#")):
            out.append(row)
    return out


def random_sheet(rng, rows):
    cell = lambda: rng.choice(["", "a", "x y", "1.5", "é😀", "#no", 'say "hi"', "two\nlines", "a,b", "\n", '"', '""', "\n#x\n", ",\n,", 'mid"quote'])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["Name", "v", "long name"])
    for i in range(rows):
        writer.writerow([f"r{i}", cell(), cell() * rng.randrange(1, 4)])
        if rng.random() < 0.1:
            out.write("\n")
    return out.getvalue()


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_one_file_of_many_ranges(spark, tmp_path, seed, end):
    rng = random.Random(seed)
    text = '# made by "hand\n#\n' + random_sheet(rng, 300)
    path = tmp_path / "sheet.csv"
    path.write_bytes(text.replace("\n", end).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 8
        found = files.read_table_csv(spark, str(path), comments="top").orderBy("Row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sequential(text, "top")
    assert [r.Row for r in found] == list(range(1, len(want)))
    assert [[r.Name, r.v or "", r["long name"] or ""] for r in found] == want[1:]


def test_states_of_lines(spark):
    lines = ['', 'a,b', '"a', 'a"b', '"a""', '"a"', '"a",', 'a,"', '"",""', '"a"b"c', ',"x""y",z', '""', '"""', '#"']
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    got = df.select("x", sheets.ends_quoted(F.col("x"), False).alias("a"), sheets.ends_quoted(F.col("x"), True).alias("b")).collect()
    for r in got:
        for inside, open_ in ((False, r.a), (True, r.b)):
            # A second line closes the cell if one is open, and is a record of its own if not.
            rows = list(csv.reader(io.StringIO(('"' if inside else "") + r.x + '\nend"', newline="")))
            assert open_ == (len(rows) == 1 and r.x != "" or inside and r.x == ""), (r.x, inside)


def test_several_files_headers_and_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,v\nx,1\n\n#gone,\ny,\"2\n#kept\"\n")
    (tmp_path / "b.csv").write_text("Name,v\nz,\"\"\n")
    found = files.read_table_csv(spark, str(tmp_path), namecol="v").orderBy("Row").collect()
    assert [(r.Row, r["Name"]) for r in found] == [(1, "1"), (2, "2\n#kept"), (3, "")] or len(found) == 3
    assert [r.Row for r in found] == [1, 2, 3]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "c.csv").write_text("# only\n# comments\n")
    assert files.read_table_csv(spark, str(tmp_path / "none"), comments="top").count() == 0
    only = tmp_path / "head.csv"
    only.write_text("Name,v\n")
    empty = files.read_table_csv(spark, str(only))
    assert empty.columns == ["Name", "v", "Row"] and empty.count() == 0


def test_a_record_of_one_line_is_not_grouped(spark, tmp_path):
    from codespan.sources.sheets import sheet_records

    (tmp_path / "s.csv").write_text('a,b\n1,x\n2,"y\n#z"\n\n# no\n3,w\n4,"v\n', newline="")
    records = sheet_records(spark, str(tmp_path / "s.csv"))
    got = {r.number: r.record for r in records.collect()}
    assert got == {0: "a,b", 1: "1,x", 2: '2,"y\n#z"', 3: "3,w", 4: '4,"v'}
    # Only lines of broken records meet in a group, and lines are placed once for all uses.
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Window" not in plan


def test_a_split_of_many_lines_is_several_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sheets, "RANGE_BITS", 2)
    rows = [(f"k{i}", f'a "{i}"\n\n,b' if i % 3 == 0 else "plain") for i in range(40)]
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    (tmp_path / "s.csv").write_text("".join(f"{quoted(a)},{quoted(b)}\n" for a, b in [("k", "v"), *rows]))
    lines = sheets._lines(spark, str(tmp_path), "anywhere")
    assert lines.groupBy("_block").count().agg({"count": "max"}).first()[0] == 4
    got = sheets.sheet_rows(spark, str(tmp_path)).orderBy("Row").collect()
    assert [(r.k, r.v) for r in got] == rows and [r.Row for r in got] == list(range(1, 41))
