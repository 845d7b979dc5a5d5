"""Daily price files (one symbol a file) read into one ``bars`` DataFrame, and written.

Columns are found by the names in each file's header, whatever their order; files with one header are read by one
scan. Lines that cannot be read whole are *refused*: too short or too long, a text where a number belongs, a date
that is none, a volume that is no count. They are kept with nulls or left out, as asked, and can be listed and
counted. Where files of one symbol overlap, the file written last has the day.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.schema import BARS_COLUMNS, CSV_SCHEMA

_CORRUPT = "_corrupt_line"
_NUMBERS = [f.name for f in CSV_SCHEMA if isinstance(f.dataType, T.DoubleType)]


def typed_bars(raw: DataFrame) -> DataFrame:
    """``bars`` from ``symbol`` and the columns of a price file, whose ``Date`` and ``Volume`` are texts.

    ``Date`` keeps the local day of texts like ``2019-08-18 00:00:00-04:00`` (the offset is ignored); texts
    that are not dates become null instead of failing the job. ``Volume`` is a count: ``123`` and ``123.0``
    are read exactly, and a text with a fraction or without a number becomes null (``missing_counts`` tells).
    """
    return raw.select("symbol", _day(), "Open", "High", "Low", "Close", _volume(), "Dividends", "Stock Splits").select(*BARS_COLUMNS)


def _day() -> Column:
    return F.col("Date").try_cast("date").alias("Date")


def _volume() -> Column:
    exact = F.col("Volume").try_cast("decimal(38,9)")
    whole = F.when(exact == F.floor(exact), exact).try_cast("bigint")
    return F.coalesce(F.col("Volume").try_cast("bigint"), whole).alias("Volume")


def _headers(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of each distinct header. A file without a header line, or whose header lacks a
    column, fails."""
    cells = "transform(split(replace(value, '﻿', ''), ','), c -> trim(both '\"' from trim(c)))"
    lines = spark.read.text(paths).selectExpr("_metadata.file_path as file", f"{cells} as cells")
    per_file = lines.groupBy("file").agg(F.max(F.when(F.array_contains("cells", "Date"), F.col("cells"))).alias("names"))
    # one row for each distinct header; the reader needs the names of its files on the driver in any case
    found = [(r["names"], sorted(r["files"])) for r in per_file.groupBy("names").agg(F.collect_list("file").alias("files")).collect()]
    for names, files in found:
        missing = [f.name for f in CSV_SCHEMA if f.name not in (names or ())]
        if missing:
            raise ValueError(f"{files[0]}: " + ("no header line" if names is None else f"no column {', '.join(missing)}"))
    return sorted(found)


def _schema(names: list[str]) -> T.StructType:
    """The columns in the order of a header, as texts; those that are not known, or named twice, by other names."""
    known = {f.name for f in CSV_SCHEMA}
    first = {name: i for i, name in reversed(list(enumerate(names))) if name in known}
    fields = [name if first.get(name) == i else f"_other_{i}" for i, name in enumerate(names)]
    return T.StructType([T.StructField(name, T.StringType()) for name in (*fields, _CORRUPT)])


def _path(uri: str) -> str:
    """A path for the reader from the percent-encoded name in a file's metadata, its glob characters escaped."""
    from urllib.parse import unquote

    return "".join("\\" + c if c in "*?[]{}\\" else c for c in unquote(uri))


def csv_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per line: the columns of ``bars``, ``refused`` (whether something in the line could not be read),
    ``line`` (its text, if it is refused) and ``written`` (time and name of its file)."""
    path_list = [paths] if isinstance(paths, str) else list(paths)
    headers = _headers(spark, path_list)
    if not headers:  # only empty files: no line has to be read by name
        headers = [([f.name for f in CSV_SCHEMA], [])]
    raws = []
    for names, files in headers:
        chosen = path_list if len(headers) == 1 else [_path(f) for f in files]
        # Whether a line is refused must not depend on the columns that a query reads.
        reader = spark.read.option("columnPruning", False).schema(_schema(names))
        raw = reader.csv(chosen, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT)
        written = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"))
        raws.append(raw.select(*[f"`{f.name}`" for f in CSV_SCHEMA], _CORRUPT, written.alias("written"), F.col("_metadata.file_name").alias("_name")))
    whole = raws[0]
    for raw in raws[1:]:
        whole = whole.unionByName(raw)
    # The metadata column has the name percent-encoded; a plus sign in it is a plus sign.
    name = F.url_decode(F.replace("_name", F.lit("+"), F.lit("%2B")))
    found = F.regexp_extract(name, r"([^/]+)\.[cC][sS][vV](\.[A-Za-z0-9]+)?$", 1)
    symbol = F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no symbol in the file name "), name)))
    numbers = [F.col(f"`{c}`").try_cast("double").alias(c) for c in _NUMBERS]
    unread = [F.col(_CORRUPT).isNotNull(), F.col("Date").isNotNull() & _day().isNull(), F.col("Volume").isNotNull() & _volume().isNull()]
    unread += [F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull() for c in _NUMBERS]
    refused = reduce(lambda x, y: x | y, unread)
    text = F.coalesce(_CORRUPT, F.concat_ws(",", *[F.coalesce(f"`{f.name}`", F.lit("")) for f in CSV_SCHEMA]))
    lines = whole.withColumn("symbol", symbol).withColumn("refused", refused).withColumn("line", F.when(refused, text))
    return lines.select("symbol", _day(), *numbers, _volume(), "refused", "line", "written").select(*[f"`{c}`" for c in BARS_COLUMNS], "refused", "line", "written")


def latest_written(lines: DataFrame) -> DataFrame:
    """One row per symbol and day: that of the file written last, by name where times are equal, and of several
    in one file the one with the largest values. Rows without a date all stay. The pick is a partial aggregate."""
    others = [c for c in BARS_COLUMNS if c not in ("symbol", "Date")]
    alone = F.when(F.col("Date").isNull(), F.monotonically_increasing_id()).alias("_alone")
    best = lines.groupBy("symbol", "Date", alone).agg(F.max(F.struct("written", *others)).alias("_best"))
    return best.select("symbol", "Date", *[F.col("_best")[c].alias(c) for c in others]).select(*BARS_COLUMNS)


def read_bars_csv(spark: SparkSession, paths: str | Iterable[str], refused: str = "keep", overlap: str = "latest") -> DataFrame:
    """``bars`` from one or many price CSV files (paths, directories or globs).

    Each file holds one symbol; the symbol is the file name without ``.csv`` and the suffix of its
    compression. A file whose name leaves no symbol fails the job, a missing column fails at once. Values are read
    as ``typed_bars`` says. Refused lines keep what could be read of them (``refused="keep"``) or are left out
    (``"drop"``). ``overlap="latest"`` gives each symbol and day one row (``latest_written``), ``"all"`` every line."""
    if refused not in ("keep", "drop") or overlap not in ("latest", "all"):
        raise ValueError("refused must be 'keep' or 'drop', overlap 'latest' or 'all'")
    lines = csv_lines(spark, paths)
    if refused == "drop":
        lines = lines.where(~F.col("refused"))
    return latest_written(lines) if overlap == "latest" else lines.select(*BARS_COLUMNS)


def refused_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """The lines that are refused: ``symbol, file, line``."""
    lines = csv_lines(spark, paths).where("refused")
    return lines.select("symbol", F.col("written.file").alias("file"), "line")


def line_counts(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Per symbol: ``accepted`` and ``refused`` lines."""
    lines = csv_lines(spark, paths)
    return lines.groupBy("symbol").agg(F.count_if(~F.col("refused")).alias("accepted"), F.count_if("refused").alias("refused"))


def write_bars_csv(bars: DataFrame, path: str, columns: Iterable[str] = BARS_COLUMNS[1:]) -> None:
    """Write ``bars`` as price files, one a symbol, named after it, in the folder ``path`` (which must not exist), sorted by date.

    Symbols must be fit for file names. Spark writes the files; the driver gives them their names."""
    spark = bars.sparkSession
    names = [f"`{c}`" for c in columns]
    parts = bars.select("symbol", *names).repartition("symbol").sortWithinPartitions("symbol", "Date")
    parts.write.partitionBy("symbol").option("maxRecordsPerFile", 0).csv(path, header=True, emptyValue="")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.csv").load(path)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in files.select("path").collect():
        part = fs_path(row["path"])
        symbol = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(part.getParent().getName().split("=", 1)[1])
        fs.rename(part, fs_path(fs_path(path), symbol + ".csv"))
        fs.delete(part.getParent(), True)
