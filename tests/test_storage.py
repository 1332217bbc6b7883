"""Sinks and sources: code pages, objects, whole appends, ids, composite keys, parts, order."""

import os
import random

import pytest
from pyspark.sql import functions as F

from codespan.functions import text as T
from codespan.operators import diff, nested
from codespan.operators.report import Report
from codespan.plans.imagecoding import import_imagecoding
from codespan.schemas import FLATCODE, IMAGECODING
from codespan.sources import files, objects, project
from codespan.sources.project import conform, read_project, write_flatcode


@pytest.mark.parametrize("encoding", ["windows-1252", "cp437", "koi8-r", "iso-8859-15", "mac-roman", "ISO-8859-1", "utf-16le"])
def test_code_pages(spark, tmp_path, encoding):
    every = bytes(range(256)) * 2 if encoding != "utf-16le" else "aé日😀".encode(encoding)
    (tmp_path / "a.txt").write_bytes(every)
    got = files.read_source_files(spark, str(tmp_path), encoding).first()
    assert got.Content == every.decode(encoding, "replace") and bytes(got.Object) == every


def test_many_byte_character_sets_are_refused(spark):
    with pytest.raises(ValueError, match="shift_jis"):
        files.decoded(F.lit(b"x"), "shift_jis")


def test_objects_of_one_name_are_all_kept(spark, tmp_path):
    rows = [("1", "a/b", "TXT", b"one"), ("2", "a_b", "txt", b"two"), ("3", "a_b", None, b"three"), ("4", "a/b", "TXT", b""),
            ("5", "a", "TXT", None), ("6", "other", "TXT", b"x"), ("7", "a:b", "TXT", b"seven")]
    df = spark.createDataFrame(rows, "Id string, Name string, ObjectType string, Object binary").repartition(3)
    out = str(tmp_path / "out")
    named = {r.Id: r.file for r in objects.export_objects(df, "a%", out).collect()}
    assert sorted(os.listdir(out)) == sorted(named.values()) and len(named) == 5
    for i, _, _, content in rows:
        if i in named:
            assert open(f"{out}/{named[i]}", "rb").read() == content
    assert sum(f == "a_b.txt" for f in named.values()) == 1 and named["3"] == "a_b.bin"


def test_a_failed_export_leaves_nothing(spark, tmp_path):
    df = spark.range(20).select(
        F.col("id").cast("string").alias("Id"), F.concat(F.lit("n"), "id").alias("Name"), F.lit("TXT").alias("ObjectType"),
        F.when(F.col("id") == 13, F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.encode(F.lit("x"), "UTF-8")).alias("Object"))
    out = tmp_path / "out"
    with pytest.raises(Exception, match="broken"):
        objects.export_objects(df, "n%", str(out))
    assert not out.exists() or not [f for f in os.listdir(out) if not f.startswith("_staging")] and not any(
        files for _, _, files in os.walk(out))


def test_many_small_objects_are_read_by_few_tasks(spark, tmp_path):
    most = objects.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    for i in range(35 * most):
        (tmp_path / f"{i}.txt").write_bytes(str(i).encode())
    back = objects.read_objects(spark, str(tmp_path))
    assert {bytes(r.content) for r in back.collect()} == {str(i).encode() for i in range(35 * most)}
    assert back.rdd.getNumPartitions() <= most < spark.read.format("binaryFile").load(str(tmp_path)).rdd.getNumPartitions()


def test_an_append_that_fails_shows_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "flat")
    row = lambda n: {"cases": spark.createDataFrame([(n,)], "name string"), "freecode": spark.createDataFrame([(n,)], "name string")}
    write_flatcode(row("first"), path)
    tables = row("second")
    broken = tables["freecode"].select(F.raise_error(F.lit("no more")).cast("string").alias("name"))
    with pytest.raises(Exception, match="no more"):
        write_flatcode(tables | {"freecode": broken}, path)
    shown = lambda: {t: sorted(r["name"] for r in read_project(spark, path, FLATCODE)[t].collect()) for t in ("cases", "freecode")}
    assert shown() == {"cases": ["first"], "freecode": ["first"]}
    write_flatcode(row("third"), path)
    assert shown() == {"cases": ["first", "third"], "freecode": ["first", "third"]}
    plain = str(tmp_path / "plain")
    spark.createDataFrame([("old",)], "name string").write.parquet(f"{plain}/cases")
    write_flatcode(row("new"), plain)
    kept = read_project(spark, plain, FLATCODE)
    assert sorted(r["name"] for r in kept["cases"].collect()) == ["new", "old"] and kept["freecode"].count() == 1
    assert project._current_version(spark, path)["number"] == 2


def test_equal_rectangles_and_memos_get_ids_of_their_own(spark):
    cells = "images_id long, codes_id long, x1 int, y1 int, x2 int, y2 int, owner string, memo string"
    rows = [(1, 2, 0, 0, 5, 5, "z", None), (1, 2, 0, 0, 5, 5, "z", ""), (1, 2, 0, 0, 5, 5, "z", "m"), (1, 2, 0, 0, 5, 5, "z", "m")]
    raw = conform({"imageCoding": spark.createDataFrame(rows, cells)}, IMAGECODING)
    taggings = import_imagecoding(raw)["Tagging"].collect()
    assert len(taggings) == 4 == len({t.Id for t in taggings})


def test_references_over_several_columns(spark):
    child = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), ("a", None), ("b", 1)], "x string, y int")
    parent = spark.createDataFrame([("a", 1), ("b", 2)], "p string, q int")
    found = diff.validate_keys({"C": child, "P": parent}, [("C", ["x", "y"], "P", ["p", "q"])])
    assert {tuple(r) for r in found.collect()} == {("C", "x|y", "a|2", 1), ("C", "x|y", "b|1", 2)}


def test_shifted_characters_come_back(spark):
    rng = random.Random(2)
    texts = ["", "plain\r\n", "é日😀\U0010f000", "".join(chr(rng.randrange(1, 0xD000)) for _ in range(200)),
             "".join(chr(rng.randrange(0x10000, 0x10F000)) for _ in range(50))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", T.shift_encode(F.col("t")).alias("up"), T.shift_decode(T.shift_encode(F.col("t"))).alias("back")).collect():
        assert r.back == r.t and r.up == "".join(chr(ord(c) + 0x377) for c in r.t)
    lost = spark.createDataFrame([("힣",), ("\U0010ffff",)], "t string").select(T.shift_encode(F.col("t"))).collect()
    assert [r[0] for r in lost] == ["�", "�"]


def test_documents_over_many_parts(spark):
    rows = spark.range(25_000).select(F.lit("d").alias("g"), F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    parts = nested.in_parts(rows, ["g"], ["k"], ["k", "v"], "Items", 10_000)
    assert parts.count() == 3
    back = nested.read_parts(parts, ["g"], "Items")
    assert back.count() == 25_000 and back.agg(F.min("Place"), F.max("Place"), F.count_distinct("Place")).first() == (0, 24_999, 25_000)
    again = nested.read_parts(nested.in_parts(rows, ["g"], ["k"], ["k", "v"], "Items", 7), ["g"], "Items")
    assert back.exceptAll(again).count() == 0


def test_order_survives_files(spark, tmp_path):
    rows = [(random.Random(i).randrange(500), i) for i in range(3000)] + [(None, -1)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small files would be put together
    try:
        files.write_ordered(df, ["a", F.desc("b")], str(tmp_path / "o"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len([f for f in os.listdir(tmp_path / "o") if f.startswith("part-")]) > 3
    got = [(r.a, r.b) for r in files.read_ordered(spark, str(tmp_path / "o")).orderBy("Row").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))


def test_reports_count_in_the_job_that_writes(spark, tmp_path):
    report = Report(spark)
    df = report.watch("numbers", spark.range(100), even=F.col("id") % 2 == 0, large=F.col("id") > 89)
    df.write.parquet(str(tmp_path / "n"))
    assert {(r.Operation, r.Outcome, r.n) for r in report.rows().collect()} == {("numbers", "even", 50), ("numbers", "large", 10)}
