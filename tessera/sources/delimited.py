"""Delimited-text scans.

* :func:`read_accidents` — header + ``;`` + explicit schema (no inference pass).
* :func:`parse_accident_lines` — raw lines parsed by field position.
* :func:`read_coordinates` / :func:`parse_coordinate_lines` — ``x,y[,label]`` files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import schemas


def read_table(spark: SparkSession, path: str, schema: T.StructType, columns=None, encoding: str = "UTF-8") -> DataFrame:
    """Scan ``;``-separated files with a header, columns found by name.

    The names and their order come from the files' header (one bounded read);
    known names get the type ``schema`` gives them, others stay text and are
    pruned. A missing column is an error, and so is a file whose header
    differs from the others' (``enforceSchema`` off).
    """
    options = {"header": "true", "sep": schemas.DELIMITER, "encoding": encoding, "mode": "PERMISSIVE"}
    names = [c.strip() for c in spark.read.options(**options).csv(path).columns]
    wanted = list(columns) if columns else [f.name for f in schema.fields]
    if missing := [c for c in wanted if c not in names]:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    known = {f.name: f.dataType for f in schema.fields}
    typed = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
    return spark.read.schema(typed).options(**options, enforceSchema="false").csv(path).select(*wanted)


def read_accidents(spark: SparkSession, path: str, columns=("X", "Y", "Vkpv"),
                   encoding: str = "UTF-8") -> DataFrame:
    """Scan accident files; only ``columns`` are materialised (pruned in the scan)."""
    return read_table(spark, path, schemas.ACCIDENT_SCHEMA, columns, encoding)


def _field(fields: Column, pos: int) -> Column:
    """Trimmed field at 0-based ``pos`` of a split line; missing or empty -> null."""
    return F.nullif(F.trim(F.try_element_at(fields, F.lit(pos + 1))), F.lit(""))


def parse_accident_lines(lines: DataFrame, value_col: str = "value",
                         x_pos: int | None = None, y_pos: int | None = None,
                         day_pos: int | None = None, sep: str = schemas.DELIMITER,
                         id_pos: int | None = None) -> DataFrame:
    """Lines already in a DataFrame -> (X double, Y double, Vkpv string) by
    field position (plus ``id`` bigint from ``id_pos`` when given).

    Header lines (first field equal to the first column name) are dropped
    wherever they occur. Non-numeric coordinates become null (``try_cast``)
    instead of failing the job. For files use :func:`read_accident_lines`,
    which lets the CSV reader tokenise each line once.
    """
    x_pos = schemas.position_of("X") if x_pos is None else x_pos
    y_pos = schemas.position_of("Y") if y_pos is None else y_pos
    day_pos = schemas.position_of("Vkpv") if day_pos is None else day_pos
    header_first = schemas.ACCIDENT_FIELDS[0][0]
    keep = [c for c in lines.columns if c != value_col]

    def body(f: Column) -> Column:
        return F.coalesce(_field(f, 0) != F.lit(header_first), F.lit(True))

    def record(f: Column) -> Column:
        extra = [] if id_pos is None else [_field(f, id_pos).try_cast("bigint").alias("id")]
        return F.struct(*extra, _field(f, x_pos).try_cast("double").alias("X"),
                        _field(f, y_pos).try_cast("double").alias("Y"), _field(f, day_pos).alias("Vkpv"))

    # one element of one line: a generator is evaluated once a row, and no
    # later filter or column is moved below it
    split = F.array(F.split(F.col(value_col), _regex_literal(sep), -1))
    return lines.select(*keep, F.inline(F.transform(F.filter(split, body), record)))


def read_accident_lines(spark: SparkSession, path: str, encoding: str = "UTF-8",
                        with_id: bool = True) -> DataFrame:
    """Header-less positional scan of accident files: the CSV reader maps
    fields to the 102-column layout by position (no header names needed),
    converts only the pruned columns, and a header line found in any file is
    dropped by its content. Unparseable numbers become null (PERMISSIVE)."""
    raw = (spark.read.schema(schemas.ACCIDENT_SCHEMA)
           .option("header", "false").option("sep", schemas.DELIMITER)
           .option("encoding", encoding).option("mode", "PERMISSIVE")
           .csv(path))
    body = raw.filter(F.coalesce(F.col("Vkpv") != F.lit("Vkpv"), F.lit(True)))
    cols = [F.col("Onnett_id").cast("bigint").alias("id")] if with_id else []
    return body.select(*cols, "X", "Y", F.nullif(F.trim("Vkpv"), F.lit("")).alias("Vkpv"))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$|?*+()[]{}\\" else ch for ch in sep)


def split_coordinate_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``x,y[,label]`` lines -> (x double, y double, label string), header
    lines (``x,y``, case-insensitive) left out; x or y is null where it is
    missing or no number. Fields after the third are ignored; a missing or
    blank label is null."""
    f = F.split(F.col(value_col), ",", -1)
    first = F.lower(F.trim(F.try_element_at(f, F.lit(1))))
    second = F.lower(F.trim(F.try_element_at(f, F.lit(2))))
    keep = [c for c in lines.columns if c != value_col]
    rows = (lines.select(*keep, f.alias("_f"), first.alias("_a"), second.alias("_b"))
            .filter(~F.coalesce((F.col("_a") == "x") & (F.col("_b") == "y"), F.lit(False))))
    label = F.trim(F.try_element_at(F.col("_f"), F.lit(3)))
    number = lambda c: F.nanvl(F.trim(c).try_cast("double"), F.lit(None).cast("double"))
    return rows.select(*keep, number(F.col("_a")).alias("x"), number(F.col("_b")).alias("y"),
                       F.when(F.length(label) > 0, label).alias("label"))


def parse_coordinate_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines of :func:`split_coordinate_lines` that have both x and y."""
    return split_coordinate_lines(lines, value_col).filter("x IS NOT NULL AND y IS NOT NULL")


def coordinate_reject_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: data lines, lines kept, lines without x, lines without y."""
    rows = split_coordinate_lines(lines, value_col)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.expr("x IS NOT NULL AND y IS NOT NULL")).alias("n_clean"),
        F.count_if(F.col("x").isNull()).alias("missing_x"), F.count_if(F.col("y").isNull()).alias("missing_y"))


def read_coordinates(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """Scan coordinate files. With ``check_header`` the first line of every
    file must start with ``x,y`` (one row a file is gathered)."""
    lines = spark.read.text(path)
    if check_header:
        own = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        first = own.filter("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "n").alias("head"))
        good = F.col("head").rlike(r"(?i)^\s*x\s*,\s*y\s*(,|$)")
        if bad := first.filter(~good).limit(1).collect():
            raise ValueError(f"expected a header starting with x,y in {bad[0]['file']}")
    return parse_coordinate_lines(lines)
