"""Reading per-symbol bar files as one table, and writing bars back."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BAR_SCHEMA, CSV_COLUMNS, CSV_DATE_FORMAT, KEY, PRICES, TIME, staged

CORRUPT, FILE_SYMBOL = "_corrupt", "_file_symbol"
DOUBLES = [*PRICES, "Volume"]
# Both spellings of the adjusted close occur in files; a file has one of them.
ADJUSTED_NAMES = ["AdjClose", "Adj Close", "Adjusted Close"]


def _text(names: list[str]) -> T.StructType:
    """Files are read as text and cast here: whether a row is broken then depends on its
    values alone, not on which columns a query happens to read."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])


JSON_SCHEMA = _text(["Stock", "Date", *[c for c in DOUBLES if c != "AdjClose"], *ADJUSTED_NAMES])


def _path_part(column: str) -> Column:
    """Paths in file metadata are URI-encoded, except that a plus stands for itself.

    Decoding takes long, so paths without an encoded character are left as they are.
    """
    path = F.col(column)
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _symbol_from_file(path: str = "_metadata.file_path") -> Column:
    """``BRK.B.csv`` gives ``BRK.B``, as a file or as the folder that Spark writes for one."""
    name = F.regexp_extract(_path_part(path), r"([^/]+?)(?:/part-[^/]*)?$", 1)
    return F.regexp_replace(name, r"\.(csv|json|jsonl)(\.gz)?$", "")


def _symbol_from_folder() -> Column:
    """``.../GT-dataset.json/part-0`` gives ``GT``."""
    path = _path_part("_metadata.file_path")
    return F.regexp_extract(path, r"/([^/]+)-dataset\.json/[^/]+$", 1)


def _timestamp(date_format: str | None) -> Column:
    if date_format:
        return F.try_to_timestamp(F.col(TIME), F.lit(date_format))
    return F.try_to_timestamp(F.col(TIME))


def normalise(df: DataFrame, date_format: str | None = CSV_DATE_FORMAT) -> DataFrame:
    """Rename and cast any bar-shaped frame to the canonical schema.

    Unreadable values become NULL; ``AdjClose`` may arrive under another name, or be absent.
    """
    adjusted = [c for c in df.columns if c in ADJUSTED_NAMES]
    if not adjusted:
        df = df.withColumn("AdjClose", F.lit(None).cast("double"))
    elif len(adjusted) == 1:
        df = df.withColumnRenamed(adjusted[0], "AdjClose")
    else:
        df = df.withColumn("AdjClose", F.coalesce(*adjusted))
    is_text = df.schema[TIME].dataType.typeName() == "string"
    time = _timestamp(date_format) if is_text else F.col(TIME).cast("timestamp")
    return df.select(
        KEY, time.alias(TIME), *[F.col(c).try_cast("double").alias(c) for c in DOUBLES]
    )


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_file, _file_symbol, _header`` of every text file: its path as Spark gives it, the symbol
    that its name says, and the line that names the date and the open.

    A stored table with a row a file, found by a pass over the lines inside the JVM; only the
    header lines leave a task. A file without a header is not listed.
    """
    is_header = F.col("value").contains(TIME) & F.col("value").contains("Open")
    lines = spark.read.text(path).filter(is_header)
    first = F.min_by("value", F.col("_metadata.file_block_start")).alias("_header")
    found = lines.groupBy(F.col("_metadata.file_path").alias("_file")).agg(first)
    return staged(found.select("_file", _symbol_from_file("_file").alias(FILE_SYMBOL), "_header"))


def _csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files as text columns named by their own header, whatever its order.

    Where all files have one header, as those of one source do, only that header comes to the
    driver. Otherwise files with the same header are read together, by their names. A header that
    lacks a column is an error, as is a file without one.
    """
    headers = file_headers(spark, path)
    kinds = [r["_header"] for r in headers.select("_header").distinct().orderBy("_header").collect()]
    parts = []
    for header in kinds:
        own = headers.filter(F.col("_header") == header).select(_path_part("_file").alias("file"))
        names = next(csv.reader([header.lstrip("\ufeff")]), [])
        lacking = [c for c in CSV_COLUMNS if c != "Adj Close" and c not in names]
        if lacking or not any(c in ADJUSTED_NAMES for c in names):
            raise ValueError(f"{own.first()['file']}: the header lacks {lacking or 'the adjusted close'}")
        reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
        reader = reader.option("header", True).option("enforceSchema", False)
        given = path
        if len(kinds) > 1:
            given = [r["file"] for r in own.collect()]
            if isinstance(path, str) and any("=" in f for f in given):
                reader = reader.option("basePath", path)
        parts.append(reader.schema(_text(names)).csv(given))
    if not parts:
        lines = spark.read.text(path).select("_metadata.file_path").first()
        if lines is not None:
            raise ValueError(f"{lines['file_path']}: the header lacks {CSV_COLUMNS}")
        return spark.createDataFrame([], _text(["AdjClose", *CSV_COLUMNS[:-1], FILE_SYMBOL]))
    adjusted = [c for c in ADJUSTED_NAMES if any(c in p.columns for p in parts)]
    same = [*CSV_COLUMNS[:-1], *adjusted, CORRUPT]
    extra = [c for c in parts[0].columns if c == KEY]
    return reduce(
        DataFrame.unionByName,
        [
            p.select(
                *[F.col(c) if c in p.columns else F.lit(None).cast("string").alias(c) for c in same],
                *extra,
                _symbol_from_file().alias(FILE_SYMBOL),
            )
            for p in parts
        ],
    )


def read_bars(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    date_format: str | None = CSV_DATE_FORMAT,
    infer: bool = False,
    symbol: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(bars, rejects)`` from a folder of files, one per symbol, in one scan.

    ``fmt``: ``csv`` (symbol from the file name), ``json`` (JSON lines; symbol from a
    ``Stock`` field or ``Stock=`` folder, else from an ``X-dataset.json`` folder) or
    ``parquet`` as ``write_bars`` leaves it. CSV columns are bound by header name. ``infer``
    also accepts dates that Spark reads without a pattern. A row with too few or too many
    fields, or whose date or a value cannot be read, is in ``rejects``, with its symbol, date
    text and line, and not in ``bars``; so in every format.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    if fmt == "parquet":
        raw = spark.read.parquet(path).withColumn(CORRUPT, F.lit(None).cast("string"))
        name = symbol if symbol is not None else F.col(KEY)
    elif fmt == "json":
        raw = reader.schema(JSON_SCHEMA).json(path)
        name = symbol if symbol is not None else F.coalesce("Stock", _symbol_from_folder())
        date_format = None if date_format == CSV_DATE_FORMAT else date_format
    elif fmt == "csv":
        raw = _csv_text(spark, path)
        if infer:
            known = F.coalesce(_timestamp(date_format), _timestamp(None))
            raw = raw.withColumns({"_raw_date": F.col(TIME), TIME: known})
        name = symbol if symbol is not None else F.col(FILE_SYMBOL)
    else:
        raise ValueError(f"unknown format {fmt!r}")

    values = [c for c in raw.columns if c in DOUBLES or c in ADJUSTED_NAMES]
    is_text = raw.schema[TIME].dataType.typeName() == "string"
    parsed = _timestamp(date_format) if is_text else F.col(TIME).cast("timestamp")
    broken = F.col(CORRUPT).isNotNull() | parsed.isNull()
    for c in values:
        broken = broken | (F.col(c).isNotNull() & F.col(c).try_cast("double").isNull())
    raw = raw.withColumns({KEY: name, "_broken": broken})
    rejects = raw.filter("_broken").select(
        KEY,
        (F.col("_raw_date") if "_raw_date" in raw.columns else F.col(TIME)).cast("string").alias(TIME),
        F.coalesce(CORRUPT, F.to_json(F.struct(TIME, *values))).alias("line"),
    )
    return normalise(raw.filter("NOT _broken"), date_format), rejects


def write_bars(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    single_file: bool = False,
    key: str = KEY,
    time: str = TIME,
) -> None:
    """One folder per symbol, rows in time order inside each file.

    Rows are range-partitioned on ``(key, time)``: tasks are of equal size, a large
    symbol is written by many of them, and each file covers one span of time, so
    a later date filter skips files by their statistics. ``single_file`` gives one
    file per symbol instead, for small symbols only.
    """
    if single_file:
        placed = df.repartition(key)
    else:
        placed = df.repartitionByRange(key, time)
    placed = placed.sortWithinPartitions(key, time)
    placed.write.mode(mode).format(fmt).partitionBy(key).save(path)
