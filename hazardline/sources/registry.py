"""Reading the registry export, its data dictionary and the analysis sheet."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
LAB_MARKERS = [
    "diag_ldh_diag", "albumin", "b2mg", "bilirubin", "crp", "fibrinogen", "ggt", "hemoglobine", "neutrophils",
    "platelet", "lymphocytes", "kreatinin", "leukocytes", "harnsaeure", "harnstoff", "monocytes",
]
SECOND_COHORT_MARKERS = ["diag_hemo_diag", *LAB_MARKERS]
FIELD_NAME = "field_name"
# ----------------------------------------------------------------------------------------------


def guess_schema(text: DataFrame, as_text: Sequence[str] = ()) -> T.StructType:
    """Types that fit every value of an all-text table, in one aggregation over all its rows.

    Whole number (32 bits, else 64), then double, then ISO date, then text; an empty column is text, and so is one in which a
    whole number has a leading zero, which a number would lose, or a date that no calendar has.
    """
    names = [c for c in text.columns if c not in as_text]
    tests = {
        "int": "^(0|-?[1-9][0-9]{0,8})$",
        "long": "^(0|-?[1-9][0-9]{0,17})$",
        "double": r"^-?((0|[1-9][0-9]*)(\.[0-9]+)?|\.[0-9]+)([eE][-+]?[0-9]+)?$",
        "date": r"^\d{4}-\d{2}-\d{2}$",
    }
    aggs = [F.count(F.col(f"`{c}`")).alias(f"n_{i}") for i, c in enumerate(names)]
    for kind, pattern in tests.items():
        for i, c in enumerate(names):
            fits = F.col(f"`{c}`").rlike(pattern)
            if kind == "date":
                fits = fits & F.col(f"`{c}`").try_cast("date").isNotNull()
            aggs.append(F.count(F.when(fits, 1)).alias(f"{kind}_{i}"))
    row = text.agg(*aggs).first() if names else None
    types = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}
    chosen: dict[str, T.DataType] = {}
    for i, c in enumerate(names):
        fits = [k for k in tests if row[f"n_{i}"] and row[f"{k}_{i}"] == row[f"n_{i}"]]
        chosen[c] = types[fits[0]] if fits else T.StringType()
    return T.StructType([T.StructField(c, chosen.get(c, T.StringType())) for c in text.columns])


def read_registry(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    fmt: str = "csv",
    sep: str = ",",
    as_text: Sequence[str] = LAB_MARKERS,
    sequence: str | None = "row_seq",
) -> DataFrame:
    """The flat export as one wide table.

    Types are those of the schema; without one, those that fit all rows, at the cost of another read; lab markers then
    stay text. A value that does not fit its type is an error. CSV files are read in blocks where every line is a record, which
    is tested first, at the cost of another read; with quoted line breaks (see :func:`lines_are_records`) one file is one task,
    and large exports are better kept as many files, JSON lines or Parquet. ``row_seq`` numbers the rows from 0 in the
    order of the source (see :func:`in_source_order`), unless the export brings such a column itself or it is None.
    """
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": True, "nullValue": ""}
    if fmt == "parquet":
        out = spark.read.parquet(path)
    elif fmt == "json":
        out = (spark.read.schema(schema) if schema else spark.read).json(path)
    elif fmt == "csv":
        out = spark.read.options(**options).csv(path)
        if lines_are_records(spark, path, sep):
            out = spark.read.options(**options | {"multiLine": False}).schema(out.schema).csv(path)
        schema = schema or guess_schema(out, as_text)
    else:
        raise ValueError("fmt must be 'csv', 'json' or 'parquet'")
    if sequence is not None and sequence not in out.columns:
        out = in_source_order(out, sequence)
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField(sequence, T.LongType())])
    return apply_types(out, schema) if fmt == "csv" else out


def lines_are_records(spark: SparkSession, path: str, sep: str = ",") -> bool:
    """Whether every line of the CSV files is a record by itself: quotes only around whole values, closed on their line.

    Also false, to be on the safe side, where there are blank lines or carriage returns, on which readers differ.
    """
    line, mark, other = F.col("value"), "\u0001", f"[^\u0001{re.escape(sep)}]"
    bare = F.regexp_replace(line, '"[^"]*+"', mark)  # a doubled quote inside a value ends one pair and starts the next
    odd = line.rlike(f"[\r{mark}]") | (F.trim(line) == "") | ~line.rlike(r"[^\x00-\x20]")
    odd = odd | bare.contains('"') | bare.rlike(f"{other}{mark}|{mark}{other}")
    return not spark.read.option("lineSep", "\n").text(path).select("value").where(odd).limit(1).count()


def in_source_order(files: DataFrame, name: str = "row_seq") -> DataFrame:
    """``files``, a table just read from files, with its rows numbered from 0: by the path of the file, then by place in it.

    Rows are counted per file and block, from the blocks' metadata and the rows' places inside them; the blocks' offsets are
    added up in path order. So the numbers do not depend on which task reads which file. One small row per block is
    shuffled; the rows themselves are not.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    source = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = files.select("*", source.alias("_source"), place.alias("_place"))
    blocks = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_source").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(F.col("_source").alias("_block"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    joined = rows.join(offsets, rows["_source"] == offsets["_block"])
    return joined.select(*[F.col(f"`{c}`") for c in files.columns], (F.col("_offset") + F.col("_place")).alias(name))


def apply_types(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the given types; a value that does not fit is an error that names it, whatever the session's settings."""

    def typed(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if text.schema[f.name].dataType == f.dataType:
            return c
        value = c.try_cast(f.dataType)
        wrong = F.raise_error(F.concat(F.lit(f"column {f.name}: not of type {f.dataType.simpleString()}: "), c))
        return F.when(c.isNotNull() & value.isNull(), wrong).otherwise(value).alias(f.name)

    return text.select(*[typed(f) for f in schema.fields])


def text_override(schema: T.StructType, as_text: Sequence[str] = LAB_MARKERS) -> T.StructType:
    """The schema with the lab markers as text."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in as_text else f.dataType, f.nullable) for f in schema.fields]
    )


def snake_name(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()


def read_dictionary(spark: SparkSession, path: str, sequence: str | None = None) -> DataFrame:
    """The data dictionary; ``;`` or ``,`` by whichever is more common in the header, outside quotes.

    With ``sequence``, a column of that name has the order of the rows; ``dictionary_codes`` finds it as ``row_seq``.
    """
    header = re.sub('"[^"]*"', "", spark.read.text(path).limit(1).first()[0])
    sep = ";" if header.count(";") > header.count(",") else ","
    dd = spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=True).csv(path)
    dd = dd.toDF(*[snake_name(c) for c in dd.columns])
    if sequence is not None:
        dd = dd.withColumn(sequence, F.monotonically_increasing_id())  # one file with line breaks is one task: file order
    return dd if FIELD_NAME in dd.columns else dd.withColumnRenamed(dd.columns[0], FIELD_NAME)


def latest_file(spark: SparkSession, glob: str, pattern: str = r"_(\d{4}-\d{2}-\d{2})\.csv$") -> str:
    """Among dated files the one with the greatest date."""
    files = spark.read.format("binaryFile").load(glob).select("path")
    date = F.try_to_date(F.regexp_extract("path", pattern, 1), "yyyy-MM-dd")
    best = files.select("path", date.alias("d")).where("d IS NOT NULL").agg(F.max_by("path", "d")).first()[0]
    if best is None:
        raise FileNotFoundError(f"no dated file under {glob}")
    return best


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ",", types: Mapping[str, str] | None = None) -> DataFrame:
    """The wide analysis sheet, exported as CSV or Parquet."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    text = spark.read.options(header=True, sep=sep, quote='"', escape='"', nullValue="", multiLine=True).csv(path)
    if types is None:
        return apply_types(text, guess_schema(text))
    given = {c: T.StructType.fromDDL(f"x {t}")[0].dataType for c, t in types.items()}
    return apply_types(text, T.StructType([T.StructField(c, given.get(c, T.StringType())) for c in text.columns]))


def pseudonymise(df: DataFrame, salt: str, id_column: str = "record_id", name: str = "record_id_new") -> DataFrame:
    """A 12-character id per patient, from a salted digest: 72 bits, no shuffle, the same on every run."""
    digest = F.sha2(F.concat(F.lit(salt), F.col(id_column).cast("string")), 256)
    short = F.translate(F.substring(F.base64(F.unhex(digest)), 1, 12), "+/", "-_")
    return df.withColumn(name, short)


def id_mapping(df: DataFrame, id_column: str = "record_id", name: str = "record_id_new", check: bool = True) -> DataFrame:
    """Distinct pairs of old and new id; two patients on one new id is an error."""
    pairs = df.select(id_column, name).distinct()
    if check and pairs.groupBy(name).count().where("count > 1").limit(1).count():
        raise ValueError("two ids share a pseudonym; change the salt")
    return pairs
