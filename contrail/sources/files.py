"""File and catalog sources and sinks.

Paths are parameters; nothing here lists local folders. CSV columns are found by
header name and read as text, so no inference pass runs over the data and dirty
text never shifts or fails a row; types come from ``try_cast``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S


def _missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """CSV columns are bound by header name, whatever their order, and read as text; each
    is then cast with ``try_cast``, so an unparsable cell becomes null (``unparsable``
    counts them) and '1.0' is a whole number. Other formats carry their own schema."""
    try:
        if fmt != "csv":
            return spark.read.format(fmt).load(path)
        text = csv_text(spark, path, [f.name for f in schema.fields])
        return text.select(*[_typed(f) for f in schema.fields])
    except AnalysisException as exc:  # A10: a missing input fails loudly
        if _missing(exc):
            raise FileNotFoundError(f"Input not found: {path}") from exc
        raise


def csv_text(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The named columns of CSV files with a header, as text; files whose header differs from the first one's fail."""
    header = spark.read.option("header", True).option("encoding", "UTF-8").csv(path).columns
    absent = [n for n in names if n not in header]
    if absent:
        raise ValueError(f"{path}: columns missing from the header: {', '.join(absent)}")
    reader = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
    return (reader.option("header", True).option("enforceSchema", False).option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").csv(path).select(*[F.col(f"`{n}`") for n in names]))


def _typed(f: T.StructField) -> Column:
    text = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.StringType):
        return text
    if isinstance(f.dataType, T.IntegerType):  # only whole numbers: 1.0 is 1, 1.5 is unparsable
        number = F.trim(text).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int")).alias(f.name)
    return F.trim(text).try_cast(f.dataType).alias(f.name)


#: Why a line goes to the rejects table, the first that applies.
REJECT_REASONS = ("bad encoding", "open quote", "too few cells", "too many cells", "unreadable")
_REPLACEMENT = "\ufffd"  # what a byte sequence that is no UTF-8 becomes on reading


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType = S.FLIGHTS_RAW) -> tuple[DataFrame, DataFrame]:
    """A1 with a rejects table: (rows of whole lines, rejected lines).

    The rows are those of ``_read``: columns bound by header name, typed with ``try_cast``.
    The rejects are (file, line, reason), one per broken line: bytes that are no UTF-8, a quote
    that is never closed, fewer or more cells than the header. Every line of the files but
    headers and empty ones is in exactly one of the two. An unparsable cell does not reject
    its line (``unparsable`` counts those).

    Both frames scan the files with the same reader; nothing is shuffled.
    """
    try:
        header = spark.read.option("header", True).option("encoding", "UTF-8").csv(path).columns
    except AnalysisException as exc:
        if _missing(exc):
            raise FileNotFoundError(f"Input not found: {path}") from exc
        raise
    absent = [f.name for f in schema.fields if f.name not in header]
    if absent:
        raise ValueError(f"{path}: columns missing from the header: {', '.join(absent)}")
    broken = "_broken"
    while broken in header:
        broken += "_"
    # the lines as they are: one column named like the header line (so that other headers fail), no quotes, and a
    # separator that no text holds
    plain = spark.read.option("sep", "\uffff").option("quote", "").option("encoding", "UTF-8")
    name = plain.option("header", True).csv(path).columns[0]
    lines = (plain.option("header", True).option("enforceSchema", False).schema(T.StructType([T.StructField(name, T.StringType())])).csv(path)
             .select(F.col(f"`{name.replace('`', '``')}`").alias("__line"), F.col("_metadata.file_path").alias("__file")).where("__line IS NOT NULL"))
    row = F.from_csv("__line", ", ".join(f"`{c}` string" for c in [*header, broken]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    parsed = lines.select("__line", "__file", row.alias("__row")).select("__line", "__file", "__row.*")
    quotes = F.length("__line") - F.length(F.replace(F.col("__line"), F.lit('"'), F.lit("")))
    n_cells = F.size(F.split(F.regexp_replace("__line", r'"(?:[^"\\]|\\.|"")*"', ""), ",", -1))
    reason = (F.when(F.contains("__line", F.lit(_REPLACEMENT)), REJECT_REASONS[0])
              .when(quotes % 2 == 1, REJECT_REASONS[1])
              .when(n_cells < len(header), REJECT_REASONS[2])
              .when(n_cells > len(header), REJECT_REASONS[3])
              .when(F.col(f"`{broken}`").isNotNull(), REJECT_REASONS[4]))
    judged = parsed.withColumn("__reason", reason)
    good = judged.where("__reason IS NULL").select(*[_typed(f) for f in schema.fields])
    rejects = judged.where("__reason IS NOT NULL").select(F.col("__file").alias("file"), F.col("__line").alias("line"), F.col("__reason").alias("reason"))
    return good, rejects


def unparsable(spark: SparkSession, path: str, schema: T.StructType = S.FLIGHTS_RAW) -> DataFrame:
    """Per typed column of a CSV source: cells with text that its type cannot hold."""
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    text = csv_text(spark, path, [f.name for f in typed])
    filled = lambda n: F.length(F.trim(F.col(f"`{n}`"))) > 0
    wide = text.agg(*[F.count_if(filled(f.name) & _typed(f).isNull()).alias(f.name) for f in typed])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("unparsable")) for f in typed])))


def read_flights(spark: SparkSession, path: str, fmt: str = "csv",
                 schema: T.StructType = S.FLIGHTS_RAW) -> DataFrame:
    """A1: raw flight records, header row, declared schema."""
    return _read(spark, path, schema, fmt)


def read_airlines(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A2: carrier lookup (IATA_CODE, AIRLINE)."""
    return _read(spark, path, S.AIRLINES, fmt)


def read_airports(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A3: airport lookup (IATA_CODE, AIRPORT, CITY, STATE, COUNTRY, LATITUDE, LONGITUDE)."""
    return _read(spark, path, S.AIRPORTS, fmt)


def lookup_keys(lookup: DataFrame, key: str = "IATA_CODE") -> DataFrame:
    """A4: distinct non-null key set of a lookup, as one string column ``key``."""
    return (lookup.select(F.col(key).cast("string").alias(key))
            .where(F.col(key).isNotNull()).distinct())


def use_catalog(spark: SparkSession, catalog: str | None = None, database: str | None = None) -> None:
    """Set current catalog / schema."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A5: catalog table scan."""
    return spark.table(name)


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Small literal table from tuples (all string columns)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame(list(rows), schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Iterable[str] | None = ("MONTH",), compression: str | None = None) -> None:
    """Write a result. Parquet partitioned by MONTH by default (later month
    filters prune files); CSV with a header and optional compression (e.g. gzip)."""
    writer = df.write.mode(mode)
    parts = [c for c in (partition_by or []) if c in df.columns]
    if parts:
        writer = writer.partitionBy(*parts)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        # white space is data: Spark's CSV writer would trim it
        writer = writer.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)


def rewrite_in_place(spark: SparkSession, path: str, fn: Callable[[DataFrame], DataFrame],
                     output: str | None = None, fmt: str = "parquet") -> str:
    """Read ``path``, transform, write to ``output`` or back over ``path``.

    In place, the result is first written to a staging folder beside the input; only when
    that is complete do the folders change names (through the Hadoop file system, so any
    store works) and the old one is deleted. A failed write leaves the input untouched.
    """
    result = fn(spark.read.format(fmt).load(path))
    if output and output != path:
        result.write.mode("overwrite").format(fmt).save(output)
        return output
    staged, old = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}" for kind in ("staged", "old"))
    result.write.format(fmt).save(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    here = hadoop.Path(path)
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(here, hadoop.Path(old)):
        raise OSError(f"cannot rename {path}; the result is in {staged}")
    if not fs.rename(hadoop.Path(staged), here):
        fs.rename(hadoop.Path(old), here)
        raise OSError(f"cannot put {staged} in place of {path}; {path} is as before")
    fs.delete(hadoop.Path(old), True)
    spark.catalog.refreshByPath(path)
    return path


def save_as_table(df: DataFrame, name: str, temp: bool = False, path: str | None = None) -> None:
    """Publish the result under a name: a temp view, or a catalog table (at ``path`` if given)."""
    if temp:
        df.createOrReplaceTempView(name)
    else:
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
