import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from codespan.functions import text as T
from codespan.operators import match
from codespan.operators.nested import export_nested
from codespan.plans import load
from codespan.plans.common import Actions
from codespan.plans.conversions import flatcode_to_legacy, legacy_to_flatcode, legacy_to_legacy
from codespan.plans.flatcode import export_flatcode, import_flatcode
from codespan.plans.legacy_export import category_layouts, export_legacy
from codespan.plans.legacy_import import import_legacy
from codespan.schemas import CANONICAL, FLATCODE, LEGACY, SYSTEM_FOLDERS
from codespan.session import cut
from codespan.sources import files, objects
from codespan.sources.project import (
    conform, empty_project, read_flatcode, read_flatcode_project, read_project, require_format, write_flatcode, write_project,
)

NOW = datetime(2024, 6, 1, 10, 0, 0)
OLD = datetime(2020, 1, 2, 3, 4, 5)

NODE_SHEET = """# a comment
Name,Parent,Description,Category,Aggregate,Color,size,when,ok
all,,"two
lines",kind,TRUE,7,123,1967-12-10,TRUE
top,,,,,,,,
child,top,,,,,,,
leaf,child,,kind,,,,,
"""


@pytest.fixture(autouse=True, scope="module")
def small_plans(spark):
    """Many joins over a handful of rows: compiling code for each would take longest."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "1",
                "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def scenario(spark, small_plans, tmp_path_factory):
    """A small project made the way a user would make it."""
    tmp_path = tmp_path_factory.mktemp("scenario")
    sheet = tmp_path / "nodes.csv"
    sheet.write_text(NODE_SHEET)
    p = empty_project(spark)
    p["User"] = spark.createDataFrame([("u1", "Ann Lee")], "Id string, Name string")
    p["Project"] = conform({"Project": spark.createDataFrame(
        [("0.2", "T", "u1", OLD, "u1", OLD)],
        "Version string, Title string, CreatedBy string, CreatedDate timestamp, ModifiedBy string, ModifiedDate timestamp",
    )})["Project"]
    p = load.load_nodes(p, files.read_table_csv(spark, str(sheet)), "u1", OLD)
    sources = spark.createDataFrame(
        [(1, "hello", "Hello world\nagain", "talk", "17"), (2, "", "second", "", "")],
        "Row long, Name string, Text string, Category string, weight string")
    p = load.load_sources(p, sources, "u1", OLD)
    source, node = p["Source"].filter("Name = 'hello'").first().Id, {r.Name: r.Id for r in p["Node"].collect()}
    tags = spark.createDataFrame(
        [("t1", source, node["leaf"], "1:5", None), ("t2", source, None, "7:11", "note"), ("t3", source, node["all"], "13:17", None)],
        "Id string, Source string, Node string, Fragment string, Memo string",
    ).withColumns({"CreatedBy": F.lit("u1"), "CreatedDate": F.lit(OLD), "ModifiedBy": F.lit("u1"), "ModifiedDate": F.lit(OLD)})
    path = str(tmp_path / "scenario")
    write_project(conform(p | {"Tagging": tags}), path)
    return read_project(spark, path)


def base_project(spark, windows):
    enc = T.shift_encode if windows else (lambda c: c)
    folders = spark.createDataFrame([(f"f_{k}", v) for k, v in SYSTEM_FOLDERS.items()], "Id string, N string")
    return conform(empty_project(spark, LEGACY) | {
        "Item": folders.select("Id", F.lit(0).alias("TypeId"), enc(F.col("N")).alias("Name"), F.lit(True).alias("System")),
        "Project": spark.createDataFrame([("10.0", "Unassigned", "Not Applicable")],
                                         "Version string, UnassignedLabel string, NotApplicableLabel string"),
    }, LEGACY)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_scenario(scenario):
    node = {r.Name: r for r in scenario["Node"].collect()}
    assert node["leaf"].Parent == node["child"].Id and node["child"].Parent == node["top"].Id
    assert node["all"].Aggregate is True and node["all"].Color == 7
    assert rows(scenario["NodeAttribute"], "Name", "Type") == [("ok", "boolean"), ("size", "integer"), ("when", "date")]
    assert rows(scenario["NodeValue"], "Value") == [("123",), ("1967-12-10",), ("True",)]
    assert rows(scenario["Source"], "Name", "ObjectType") == [("2", "TXT"), ("hello", "TXT")]


def test_reloading_changes_nothing_but_modified(spark, scenario):
    sheet = spark.createDataFrame([(1, "all", "new text", "5")], "Row long, Name string, Description string, size string")
    again = load.load_nodes(scenario, sheet, "u2", NOW)
    before, after = ({r.Name: r for r in p["Node"].collect()} for p in (scenario, again))
    assert before["all"].Id == after["all"].Id and after["all"].CreatedBy == "u1" and after["all"].ModifiedBy == "u2"
    assert after["top"] == before["top"]
    assert rows(again["NodeValue"], "Value") == [("1967-12-10",), ("5",), ("True",)]


def test_values_too_long_are_refused(spark, scenario):
    p = scenario | {"NodeAttribute": scenario["NodeAttribute"].withColumn("Type", F.lit("text")).withColumn("Length", F.lit(2))}
    sheet = spark.createDataFrame([(1, "all", "long")], "Row long, Name string, size string")
    with pytest.raises(Exception, match="longer than attribute length"):
        load.load_nodes(p, sheet, "u1", NOW)["NodeValue"].collect()


def test_text_columns(spark):
    df = spark.createDataFrame([("x", "ab", "", "c")], "base string, p string, q string, r string")
    row = load.assemble_text(df, "base", ["p", "q", "r"]).first()
    assert row.Content == "x\n\np\n\nab\n\n\nr\n\nc\n"
    assert [(z.Column, row.Content[z.start0:z.end0]) for z in row.Pieces] == [("p", "ab\n"), ("r", "c\n")]


def test_publish_is_all_or_nothing(spark, scenario, tmp_path):
    path = str(tmp_path / "project")
    write_project(scenario, path)
    first = read_project(spark, path)
    assert rows(first["Tagging"], "Id", "Fragment") == rows(scenario["Tagging"], "Id", "Fragment")
    write_project({"User": scenario["User"]}, path)
    second = read_project(spark, path)
    assert second["Tagging"].count() == 0 and second["User"].count() == 1
    assert len(os.listdir(f"{path}/_manifest")) >= 2


def test_wrong_versions_are_refused(spark, scenario):
    other = scenario | {"Project": scenario["Project"].withColumn("Version", F.lit("0.1"))}
    with pytest.raises(Exception, match="incompatible version"):
        require_format(other)["Project"].collect()
    with pytest.raises(Exception, match="incompatible version"):
        read_flatcode({"project": spark.createDataFrame([("x",)], "databaseversion string")})["project"].collect()


def test_sheets_and_comments(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('# c1\n# c2\nThing,v\na,"1, ""x"""\n#b,2\n')
    anywhere = files.read_table_csv(spark, str(path), namecol="Thing").collect()
    assert [(r.Name, r.v, r.Row) for r in anywhere] == [("a", '1, "x"', 1)]
    top = files.read_table_csv(spark, str(path), namecol="Thing", comments="top").orderBy("Row").collect()
    assert [(r.Name, r.v, r.Row) for r in top] == [("a", '1, "x"', 1), ("#b", "2", 2)]
    assert files.read_table_csv(spark, str(path), limit=1, comments="top").count() == 1


def test_row_numbers_over_several_splits(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.txt").write_text("".join(f"{i}-{j}\n" for j in range(40)))
    df = files.with_row_numbers(spark.read.text(str(tmp_path))).orderBy("Row").collect()
    assert [r.Row for r in df] == list(range(1, 121))
    assert [r.value for r in df] == [f"{i}-{j}" for i in range(3) for j in range(40)]


def test_source_files_and_objects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes("héllo".encode("latin-1"))
    (tmp_path / "in" / "b.pdf").write_bytes(b"%PDF")
    got = {r.Name: r for r in files.read_source_files(spark, str(tmp_path / "in"), "ISO-8859-1").collect()}
    assert got["a"].Content == "héllo" and got["b"].Content is None and got["b"].ObjectType == "PDF"
    out = str(tmp_path / "out")
    sources = files.read_source_files(spark, str(tmp_path / "in")).withColumn("Id", F.col("ObjectFile"))
    objects.export_objects(sources, "b%", out)
    assert os.listdir(out) == ["b.pdf"] and open(f"{out}/b.pdf", "rb").read() == b"%PDF"


def test_query_output_keeps_the_old_one(spark, tmp_path):
    path = str(tmp_path / "q")
    df = spark.createDataFrame([("a", 1)], "Name string, x int")
    files.write_query_csv(df, ["x", "Missing", "Name"], path)
    files.write_query_csv(df, ["Name"], path)
    read = lambda p: [tuple(r) for r in spark.read.csv(p, header=True).collect()]
    assert read(path) == [("a",)] and read(f"{path}.bak") == [("1", None, "a")]


def test_flatcode_round_trip(spark, scenario, tmp_path):
    flat = export_flatcode(scenario, NOW)
    assert rows(flat["freecode"], "name") == [("child",), ("leaf",), ("top",)]
    assert rows(flat["cases"], "name") == [("all",)]
    assert rows(flat["caseAttr"], "variable", "value") == [("Category", "kind"), ("ok", "1"), ("size", "123"), ("when", "19671210")]
    assert rows(flat["coding"], "selfirst", "selend", "seltext") == [(1.0, 5.0, "ello ")]
    assert flat["project"].first().about.endswith("Imported Sat Jun  1 10:00:00 2024")
    path = str(tmp_path / "flat")
    write_flatcode(flat, path)
    back = import_flatcode(read_flatcode_project(spark, path))
    assert rows(back["Node"], "Name") == rows(scenario["Node"], "Name")
    names = {r.Id: r.Name for r in back["NodeCategory"].collect()}
    case = back["Node"].filter("Name = 'all'").first()
    assert names[case.Category] == "kind"
    assert rows(back["Tagging"], "Fragment") == [("13:17",), ("1:5",), ("7:7",)]
    assert back["Tagging"].first().CreatedDate == OLD


@pytest.mark.parametrize("platform", ["windows", "mac"])
def test_legacy_round_trip(spark, scenario, platform):
    base = base_project(spark, platform == "windows")
    raw = export_legacy(scenario, base, platform, actions=Actions(project="overwrite"))
    back = import_legacy(raw, platform)
    assert rows(back["Node"], "Id", "Name", "Parent", "Category") == rows(scenario["Node"], "Id", "Name", "Parent", "Category")
    assert rows(back["Source"], "Id", "Name", "Content") == rows(scenario["Source"], "Id", "Name", "Content")
    assert rows(back["Tagging"], "Id", "Node", "Fragment", "Memo") == rows(scenario["Tagging"], "Id", "Node", "Fragment", "Memo")
    assert back["Project"].first().Title == "T"
    assert {v for (v,) in rows(back["NodeValue"], "Value")} >= {"123"}
    layout = category_layouts(raw, "node_classification", member="item_category").first().Layout
    assert layout.count("<Row ") == 2 and layout.endswith("</CategoryLayout>")


@pytest.fixture(scope="module")
def exported(spark, scenario):
    """The scenario as graph tables, written once as a store would hold them."""
    raw = export_legacy(scenario, base_project(spark, True), actions=Actions(project="overwrite"))
    return {name: cut(df) for name, df in raw.items()}


def test_graph_to_flat_code(spark, exported, tmp_path):
    path = str(tmp_path / "flat")
    write_flatcode(legacy_to_flatcode(exported, NOW), path)
    flat = read_project(spark, path, FLATCODE)
    assert rows(flat["source"], "name") == [("2",), ("hello",)]
    assert rows(flat["cases"], "name") == [("all",)]
    assert flat["coding"].count() + flat["caselinkage"].count() == 2 and flat["annotation"].count() == 1


def test_flat_code_to_graph(spark, scenario, tmp_path):
    path = str(tmp_path / "flat")
    write_flatcode(export_flatcode(scenario, NOW), path)
    into = flatcode_to_legacy(read_project(spark, path, FLATCODE), base_project(spark, True))
    assert into["NodeReference"].count() == 2 and into["Annotation"].count() == 1


def test_graph_to_graph_of_another_platform(spark, exported):
    other = legacy_to_legacy(exported, base_project(spark, False), "windows", "mac")
    assert rows(other["Item"].filter("TypeId = 16"), "Name") == [("all",), ("child",), ("leaf",), ("top",)]


def test_compare_finds_a_renamed_and_an_edited_record(spark, scenario):
    base = base_project(spark, False)
    one = export_legacy(scenario, base, "mac")
    changed = scenario | {"Node": scenario["Node"].withColumn(
        "Description", F.when(F.col("Name") == "top", "edited").otherwise(F.col("Description")))}
    two = export_legacy(changed, base, "mac")
    found = match.compare_projects(one, two, ["Item", "ExtendedItem", "UserProfile"]).collect()
    assert [(r.Table, r.Status, r.Column, r.Value2) for r in found] == [("Item", "differs", "Description", "edited")]


def test_nested_export(spark, scenario, tmp_path):
    path = str(tmp_path / "nested")
    export_nested(scenario, path, rows_per_part=2)
    docs = []
    for f in os.listdir(f"{path}/sources"):
        if f.endswith(".json"):
            docs += [json.loads(line) for line in open(f"{path}/sources/{f}")]
    hello = sorted((d for d in docs if d["Name"] == "hello"), key=lambda d: d["Part"])
    assert [len(d["Taggings"]) for d in hello] == [2, 1]
    spans = {(t["offset"], t["length"]) for d in hello for t in d["Taggings"]}
    assert spans == {(0, 5), (6, 5), (12, 5)} and hello[0]["Taggings"][0]["author"] == "Ann Lee"


def test_structure_of_empty_projects(spark):
    p = empty_project(spark)
    assert {n: df.schema for n, df in p.items()} == CANONICAL
