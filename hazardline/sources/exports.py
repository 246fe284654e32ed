"""Writing cleaned tables: dated copies, the latest copy and plain CSV."""

from __future__ import annotations

import datetime as dt
import uuid
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ending of the folder that holds the marks of a table's copies.
MARKS = ".marks"


def results_path(kind: str, root: str = "results", day: dt.date | None = None) -> str:
    """``<root>/<date>_<kind>``."""
    return f"{root}/{(day or dt.date.today()).isoformat()}_{kind}"


def write_csv(df: DataFrame, path: str, sep: str = ",", decimal: str = ".") -> None:
    """One CSV folder with header; doubles use the given decimal mark."""
    if decimal != ".":
        doubles = [c for c, t in df.dtypes if t in ("double", "float") or t.startswith("decimal")]
        df = df.withColumns({c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(decimal)) for c in doubles})
    df.write.mode("overwrite").options(header=True, sep=sep, quote='"', escape='"').csv(path)


def save_cleaned(
    df: DataFrame,
    prefix: str = "cleaned_data",
    folder: str = "data/cleaned",
    *,
    csv2: bool = False,
    latest: bool = True,
    day: dt.date | None = None,
) -> dict[str, str]:
    """A dated Parquet and CSV copy, and with ``latest`` the mark that makes it the latest one.

    The table is computed and written once, as Parquet, under a name of its own; the CSV copy is read back from it. ``csv2``
    writes ``;`` with a decimal comma. The latest copy is a mark that names the Parquet copy: one small file, added when all
    data are there. So a run that fails leaves the mark of the run before, runs at the same time do not mix, and who reads
    the earlier copy keeps it.
    """
    stamp, run = (day or dt.date.today()).isoformat(), uuid.uuid4().hex[:12]
    name = f"{prefix}_{stamp}_{run}_data.parquet"
    paths = {"parquet": f"{folder}/{name}", "csv": f"{folder}/{prefix}_{stamp}_data.csv"}
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(paths["parquet"])
    write_csv(spark.read.schema(df.schema).parquet(paths["parquet"]), paths["csv"], ";" if csv2 else ",", "," if csv2 else ".")
    if latest:
        paths["latest"] = f"{folder}/latest_{prefix}{MARKS}"
        mark = spark.range(1).select(
            F.lit(prefix).alias("prefix"), F.lit(name).alias("name"), F.lit(run).alias("run"), F.unix_micros(F.current_timestamp()).alias("at")
        )
        mark.coalesce(1).write.mode("append").json(paths["latest"])
    return paths


def read_latest(spark: SparkSession, folder: str = "data/cleaned") -> dict[str, DataFrame]:
    """The latest table of each prefix saved in ``folder``: the one marked last."""
    try:
        marks = spark.read.schema("prefix string, name string, run string, at long").json(f"{folder}/latest_*{MARKS}")
        rows = marks.groupBy("prefix").agg(F.max_by("name", F.struct("at", "run")).alias("name")).collect()
    except AnalysisException:
        rows = []
    if not rows:
        warnings.warn(f"no latest_ table found under {folder}", stacklevel=2)
    return {r["prefix"]: spark.read.parquet(f"{folder}/{r['name']}") for r in sorted(rows)}
