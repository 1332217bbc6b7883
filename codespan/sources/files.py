"""Sheets, text files and exported objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codespan.sources.project import _exists, _filesystem
from codespan.sources.sheets import sheet_rows


def with_row_numbers(df: DataFrame, name: str = "Row") -> DataFrame:
    """Dense numbers from 1 in file order, for a table read from files.

    Each file split numbers its own rows; the sizes of the splits before it,
    one small row per split, are added.
    """
    placed = df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_at": F.monotonically_increasing_id(),
        }
    )
    splits = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    joined = placed.join(offsets, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return joined.select(*df.columns, (F.col("_offset") + F.col("_at") - F.col("_first") + 1).alias(name))


def read_table_csv(
    spark: SparkSession,
    path: str,
    namecol: str | None = None,
    limit: int | None = None,
    multiline: bool = True,
    comments: str = "anywhere",
) -> DataFrame:
    """A sheet as strings with its row numbers in ``Row``.

    Quoted cells may hold line ends; the file is still read by many tasks (see
    ``sheets``).  ``multiline=False`` leaves the search for such cells out.  Lines
    beginning with ``#`` are skipped; with ``comments="top"`` only those before
    the header are.
    """
    if multiline or comments == "top":
        df = sheet_rows(spark, path, comments)
    else:
        options = {"header": True, "escape": '"', "inferSchema": False, "comment": "#"}
        df = with_row_numbers(spark.read.options(**options).csv(path))
    if namecol:
        df = df.withColumnRenamed(namecol, "Name")
    return df.filter(F.col("Row") <= limit) if limit else df


# The character sets that Spark decodes itself.
SPARK_CHARSETS = {"us-ascii", "iso-8859-1", "utf-8", "utf-16be", "utf-16le", "utf-16", "utf-32"}


def decoded(content: Column, encoding: str) -> Column:
    """Bytes as text in Spark's own character sets or in any code page of one byte a character.

    A code page is a table of 256 characters.  Read as ISO 8859-1 every byte is one
    character, and those that stand for another are translated.  Bytes that the
    code page leaves open become U+FFFD.
    """
    if encoding.lower() in SPARK_CHARSETS:
        return F.decode(content, encoding)
    every = bytes(range(256))
    page = every.decode(encoding, "replace")
    if len(page) != 256 or any(bytes([b]).decode(encoding, "replace") != c for b, c in zip(every, page, strict=True)):
        raise ValueError(f"{encoding} is not a code page of one byte a character")
    moved = [(a, b) for a, b in zip(every.decode("iso-8859-1"), page, strict=True) if a != b]
    plain = F.decode(content, "ISO-8859-1")
    return F.translate(plain, "".join(a for a, _ in moved), "".join(b for _, b in moved)) if moved else plain


def read_source_files(spark: SparkSession, pattern: str, encoding: str = "UTF-8") -> DataFrame:
    """One source row per file; text files are decoded into Content."""
    files = spark.read.format("binaryFile").load(pattern)
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.upper(F.regexp_extract(name, r"\.([^.]*)$", 1))
    is_text = kind == "TXT"
    return files.select(
        F.regexp_replace(name, r"\.[^.]*$", "").alias("Name"),
        name.alias("ObjectFile"),
        kind.alias("ObjectType"),
        F.col("content").alias("Object"),
        F.when(is_text, decoded(F.col("content"), encoding)).alias("Content"),
    )


def write_ordered(df: DataFrame, order: list[str | Column], path: str) -> None:
    """Write rows so that their order survives: ranges of it in numbered files, each sorted.

    Spark cuts the order into ranges by sampling it, so no task sorts more than its
    share.  Nulls come first.
    """
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, name: str = "Row") -> DataFrame:
    """What :func:`write_ordered` wrote, with each row's place in the order."""
    return with_row_numbers(spark.read.parquet(path), name)


def write_query_csv(df: DataFrame, columns: list[str], path: str, order: list[str | Column] | None = None) -> None:
    """Columns in a fixed order, others left out, missing ones blank.

    Output already at ``path`` moves to ``path.bak`` first.  With ``order``, rows
    are sorted inside files and from file to file.
    """
    spark = df.sparkSession
    if _exists(spark, path):
        fs, old = _filesystem(spark, path)
        _, bak = _filesystem(spark, f"{path}.bak")
        if fs.exists(bak):
            fs.delete(bak, True)
        if not fs.rename(old, bak):
            raise RuntimeError(f"cannot keep {path} as {path}.bak")
    chosen = (df.orderBy(*order) if order else df).select(
        *[(F.col(c) if c in df.columns else F.lit("")).cast("string").alias(c) for c in columns]
    ).fillna("")
    chosen.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
