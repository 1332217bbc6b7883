"""A project as a set of tables: reading, completing, publishing, emptying."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codespan.functions.guard import demand
from codespan.schemas import (
    CANONICAL, DELETE_ORDER, FLATCODE, FLATCODE_READ, FLATCODE_VERSION, FORMAT_VERSION,
    IMAGECODING, LEGACY,
)

Project = dict[str, DataFrame]
MANIFEST = "_manifest"


def shape(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a schema in its order and types; missing ones become null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and Spark knows it: joins and unions with this table vanish from a plan.

    A frame made from an empty list is of unknown size to Spark, and what is joined or
    united with it would never be small enough to broadcast.
    """
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).filter(F.lit(False)).select(*none)


def conform(tables: Project, schemas: dict[str, T.StructType] = CANONICAL) -> Project:
    """Give every table its schema; a missing table becomes an empty one."""
    spark = next(iter(tables.values())).sparkSession
    return {
        name: shape(tables[name], schema) if name in tables else empty(spark, schema)
        for name, schema in schemas.items()
    }


def empty_project(spark: SparkSession, schemas: dict[str, T.StructType] = CANONICAL) -> Project:
    """Structure without rows."""
    return {name: empty(spark, schema) for name, schema in schemas.items()}


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def _current_version(spark: SparkSession, path: str) -> dict | None:
    """The published manifest: its newest file names the folder of each table."""
    folder = f"{path}/{MANIFEST}"
    if not _exists(spark, folder):
        return None
    fs, p = _filesystem(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    if not names:
        return None
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{names[-1]}"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) | {"number": int(names[-1].split(".")[0])}


def read_project(
    spark: SparkSession, path: str, schemas: dict[str, T.StructType] = CANONICAL
) -> Project:
    """Load a project folder; tables it lacks come out empty.

    A folder written by :func:`write_project` is read through its manifest, any
    other folder as one Parquet table per sub-folder or ``<name>.parquet``.
    """
    version = _current_version(spark, path)
    out = {}
    for name, schema in schemas.items():
        places = _places(spark, path, name, version)
        out[name] = shape(spark.read.parquet(*places), schema) if places else empty(spark, schema)
    return out


def _places(spark: SparkSession, path: str, name: str, version: dict | None) -> list[str]:
    """The folders that hold a table: those the manifest names, or what lies there without one."""
    if version:
        return [f"{path}/{folder}/{name}" for folder in version["tables"].get(name, [])]
    return [p for p in (f"{path}/{name}", f"{path}/{name}.parquet") if _exists(spark, p)][:1]


def write_project(p: Project, path: str) -> None:
    """Publish all tables or none.

    Tables go to a fresh folder first; a reader sees them only once the small
    manifest file that names the folder is renamed into place.
    """
    folder = _stage(p, path)
    _publish(next(iter(p.values())).sparkSession, path, folder, {name: [folder] for name in p})


def _stage(p: Project, path: str) -> str:
    """Write tables into a fresh folder that nothing names yet."""
    folder = f"data-{uuid.uuid4().hex}"
    for name, df in p.items():
        df.write.parquet(f"{path}/{folder}/{name}")
    return folder


def _publish(spark: SparkSession, path: str, folder: str, tables: dict[str, list[str]]) -> None:
    """Make a state visible: one rename of a manifest that names the folders of each table."""
    before = _current_version(spark, path)
    number = (before["number"] + 1) if before else 1
    fs, target = _filesystem(spark, f"{path}/{MANIFEST}/{number:08d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}/{MANIFEST}.json")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps({"tables": tables}).encode()))
    finally:
        out.close()
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"another writer published version {number} of {path}")


def truncate_tables(p: Project) -> Project:
    """Every table without its rows, children listed before their parents."""
    order = [t for t in DELETE_ORDER if t in p] + [t for t in p if t not in DELETE_ORDER]
    return {name: p[name].limit(0) for name in order}


def read_tables(
    spark: SparkSession,
    url: str,
    tables: list[str],
    partition: dict[str, dict] | None = None,
    **options: str,
) -> Project:
    """Tables of a relational database; ``partition`` splits big ones over a column.

    ``partition[table]`` takes Spark's ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, without which a table is one read.
    """
    out = {}
    for table in tables:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for key, value in {**options, **(partition or {}).get(table, {})}.items():
            reader = reader.option(key, value)
        out[table] = reader.load()
    return out


def read_legacy(raw: Project) -> Project:
    """The nine graph tables, plus blob storage when the project has it.

    Later versions name the thumbnail and waveform columns after a location.
    """
    source = raw["Source"]
    for old, new in (("ThumbnailLocation", "Thumbnail"), ("WaveformLocation", "Waveform")):
        if old in source.columns and new not in source.columns:
            source = source.withColumnRenamed(old, new)
    kept = {**raw, "Source": source}
    return conform({k: v for k, v in kept.items() if k in LEGACY}, LEGACY)


def legacy_version(raw: Project) -> DataFrame:
    """One row: the major version the project row begins with."""
    return raw["Project"].select(F.substring_index("Version", ".", 1).alias("Major"))


def checked_project_row(project: DataFrame, column: str, expected: str) -> DataFrame:
    """The project row; any action fails when its version is another one."""
    message = F.concat(F.lit("incompatible version: "), F.coalesce(F.col(column), F.lit("none")))
    return demand(project, F.col(column) == expected, message)


def read_flatcode(raw: Project) -> Project:
    """The tables of a flat-code project, refusing other format versions."""
    known = {k: v for k, v in raw.items() if k in FLATCODE_READ}
    out = conform(known, {k: FLATCODE[k] for k in FLATCODE_READ})
    return out | {"project": checked_project_row(out["project"], "databaseversion", FLATCODE_VERSION)}


def read_imagecoding(raw: Project) -> Project:
    """The five tables of an image-coding project."""
    return conform({k: v for k, v in raw.items() if k in IMAGECODING}, IMAGECODING)


def require_format(p: Project) -> Project:
    """The project, failing on use when it has another format version."""
    return p | {"Project": checked_project_row(p["Project"], "Version", FORMAT_VERSION)}


def write_flatcode(tables: Project, path: str) -> None:
    """Append to the eighteen flat-code tables, creating absent ones: to all of them or to none.

    The rows go to a fresh folder; the manifest that then names it beside the
    folders there were is put in place by one rename.  Tables already at ``path``
    without a manifest are taken over where they lie.
    """
    new = conform(tables, FLATCODE)
    spark = next(iter(new.values())).sparkSession
    before = _current_version(spark, path)
    plain = [name for name in FLATCODE if before is None and _exists(spark, f"{path}/{name}")]
    folder = _stage(new, path)
    held = before["tables"] if before else {name: ["."] for name in plain}
    _publish(spark, path, folder, {name: [*held.get(name, []), folder] for name in FLATCODE})


def read_flatcode_project(spark: SparkSession, path: str) -> Project:
    """The flat-code tables under ``path``, as the last whole append left them."""
    return read_flatcode(read_project(spark, path, FLATCODE))
