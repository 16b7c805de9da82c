"""Notebook exports to cells, and cells to one Python source per notebook.

Everything is a column expression on the notebook's own row, so splitting needs
no shuffle; only a table that already holds one row per cell has to be grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions.text import detect_cell_type, strip_blank

# The markers of the SOURCE export format and its comment magic.
SOURCE_HEADER = "# Databricks notebook source"
CELL_MARK = "# COMMAND ----------"
MAGIC_COMMENT = r"(?m)^# MAGIC ?"

_JUPYTER_DOC = "struct<cells: array<struct<cell_type: string, source: string>>>"


def _cell(content: Column, metadata: Column) -> Column:
    typed = detect_cell_type(content)
    return F.struct(typed["cell_type"].alias("cell_type"), typed["content"].alias("content"), metadata.alias("metadata"))


def decode_text(content: Column) -> Column:
    """UTF-8 text of the bytes; malformed bytes become the replacement character."""
    return F.make_valid_utf8(content.cast("string"))


def source_cells(text: Column, strip_magic_comment: bool = False) -> Column:
    """Cells of a SOURCE export as an array of struct(cell_type, content, metadata)."""
    parts = F.split(text, rf"(?mdU)^{CELL_MARK}\s*$")
    bodies = F.transform(parts, lambda p: strip_blank(F.regexp_replace(p, rf"(?mdU)^{SOURCE_HEADER}\s*\n", "")))
    if strip_magic_comment:
        bodies = F.transform(bodies, lambda b: F.regexp_replace(b, MAGIC_COMMENT, ""))
    metadata = F.create_map(F.lit("jupyter"), F.lit("false"))
    return F.transform(F.filter(bodies, lambda b: b != ""), lambda b: _cell(b, metadata))


def jupyter_cells(text: Column) -> Column:
    """Cells of a JUPYTER export; NULL when the text is not such a document."""

    def content(cell: Column) -> Column:
        pieces = F.from_json(cell["source"], "array<string>")
        joined = F.when(cell["source"].startswith("["), F.array_join(pieces, ""))
        return F.coalesce(joined, cell["source"], F.lit(""))

    def convert(cell: Column) -> Column:
        kind = F.coalesce(cell["cell_type"], F.lit("code"))
        flags = F.create_map(F.lit("jupyter"), F.lit("true"))
        other = F.struct(
            F.lit("python").alias("cell_type"),
            content(cell).alias("content"),
            F.map_concat(flags, F.create_map(F.lit("original_type"), kind)).alias("metadata"),
        )
        return F.when(kind == "code", _cell(content(cell), flags)).otherwise(other)

    cells = F.from_json(text, _JUPYTER_DOC)["cells"]
    kept = F.filter(cells, lambda c: ~c["cell_type"].eqNullSafe("markdown"))
    return F.transform(kept, convert)


def cells_of(format_name: Column, content: Column) -> Column:
    """The cells of one export; every format but JUPYTER is read as SOURCE."""
    text = decode_text(content)
    return F.when(format_name == "JUPYTER", jupyter_cells(text)).otherwise(source_cells(text))


def split_source_cells(exports: DataFrame, strip_magic_comment: bool = False) -> DataFrame:
    return _explode(exports, source_cells(decode_text(F.col("content")), strip_magic_comment))


def split_jupyter_cells(exports: DataFrame) -> DataFrame:
    return _explode(exports, jupyter_cells(decode_text(F.col("content"))))


def extract_cells(exports: DataFrame) -> DataFrame:
    """(path, format, content) to (path, cell_no, cell_type, content, metadata)."""
    return _explode(exports, cells_of(F.col("format"), F.col("content")))


def unreadable_exports(exports: DataFrame) -> DataFrame:
    """Exports no cell list could be read from."""
    cells = cells_of(F.col("format"), F.col("content"))
    return exports.where(cells.isNull()).select("path", "format", F.lit("not a notebook document").alias("error"))


def _explode(exports: DataFrame, cells: Column) -> DataFrame:
    # the outer form, since the optimizer would split the text again to filter for the inner one
    found = exports.select("path", F.posexplode_outer(cells).alias("cell_no", "cell")).where("cell_no IS NOT NULL")
    return found.select("path", "cell_no", "cell.cell_type", "cell.content", "cell.metadata")


def classify_cells(cells: DataFrame) -> DataFrame:
    """Replace raw content by its language and the text after the magic."""
    return cells.withColumn("cell", detect_cell_type(F.col("content"))).select(
        "path", "cell_no", "cell.cell_type", "cell.content"
    )


def _common_margin(lines: Column) -> Column:
    """Longest blank prefix all non-blank lines share."""
    blanks = F.transform(F.filter(lines, lambda l: l.rlike(r"\S")), lambda l: F.regexp_extract(l, r"^([ \t]*)", 1))

    def shared(left: Column, right: Column) -> Column:
        lengths = F.sequence(F.lit(0), F.least(F.length(left), F.length(right)))
        same = F.filter(lengths, lambda n: F.substr(left, F.lit(1), n) == F.substr(right, F.lit(1), n))
        return F.substr(left, F.lit(1), F.array_max(same))

    def narrow(margin: Column, blank: Column) -> Column:
        return F.when(blank.startswith(margin), margin).otherwise(shared(margin, blank))

    return F.aggregate(blanks, F.coalesce(F.get(blanks, F.lit(0)), F.lit("")), narrow)


def clean_python(code: Column) -> Column:
    """Drop magic lines, remove the common indent, trim."""

    def once(value: Column, use) -> Column:
        """``use`` of a value that is computed once: a lambda variable is not expanded again."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def flush(lines: Column, width: Column) -> Column:
        return F.array_join(F.transform(lines, lambda l: F.when(l.rlike(r"\S"), F.substr(l, width + 1)).otherwise(F.lit(""))), "\n")

    kept = F.filter(F.split(code, r"\r\n|\n|\r"), lambda l: ~l.rlike(r"^\s*%"))
    return strip_blank(once(kept, lambda lines: once(F.length(_common_margin(lines)), lambda width: flush(lines, width))))


def python_units(cells: Column) -> Column:
    """struct(source, units): the whole Python text and, apart, each cell's text as it is."""
    python = F.filter(cells, lambda c: c["cell_type"] == "python")
    return F.struct(
        clean_python(F.array_join(F.transform(python, lambda c: c["content"]), "\n\n")).alias("source"),
        F.transform(python, lambda c: F.struct(c["cell_no"].alias("cell_no"), c["content"].alias("text"))).alias("units"),
    )


def python_sources(exports: DataFrame) -> DataFrame:
    """One Python source per export row, without a shuffle."""
    cells = cells_of(F.col("format"), F.col("content"))
    numbered = F.transform(
        cells,
        lambda c, i: F.struct(i.alias("cell_no"), c["cell_type"].alias("cell_type"), c["content"].alias("content")),
    )
    return exports.select("path", python_units(numbered).alias("u")).select("path", "u.source", "u.units")


def assemble_python_source(cells: DataFrame) -> DataFrame:
    """One Python source per notebook from a table of cells.

    A group is one notebook. Its cells came out of one exported document, so a
    group is never larger than one value of the exports table. What follows is
    parsing, which costs time rather than bytes, so the number of tasks is stated and
    not left to be merged by size.
    """
    ordered = F.array_sort(F.collect_list(F.struct("cell_no", "cell_type", "content")))
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    python = cells.where(F.col("cell_type") == "python").repartition(tasks, "path")
    return (
        python.groupBy("path").agg(ordered.alias("cells"))
        .select("path", python_units(F.col("cells")).alias("u"))
        .select("path", "u.source", "u.units")
    )


def normalize_dict_cells(cells: DataFrame) -> DataFrame:
    """Cells kept under other field names, as (path, cell_no, cell_type, content).

    Python is what says ``cell_type = code``, else ``language = python``; the text is
    ``source`` for the first kind, ``content`` or else ``source`` for the second.
    """
    is_code = F.coalesce(F.col("cell_type") == "code", F.lit(False))
    is_python = F.coalesce(F.lower("language") == "python", F.lit(False))

    def text(value: Column) -> Column:
        pieces = F.from_json(value, "array<string>")
        return F.coalesce(F.when(value.startswith("["), F.array_join(pieces, "")), value)

    content = F.when(is_code, text(F.col("source"))).otherwise(
        text(F.coalesce(F.nullif(F.col("content"), F.lit("")), F.col("source")))
    )
    return cells.where(is_code | is_python).select(
        "path", "cell_no", F.lit("python").alias("cell_type"), content.alias("content")
    )
