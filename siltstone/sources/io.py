"""Readers and writers of the exports: NDJSON, CSV and TSV, JDBC, Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import tsv_escape

CORRUPT = "_corrupt_record"


def _existing(spark: SparkSession, paths: str | Iterable[str]) -> list[str]:
    """Those of the paths that exist."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).globStatus(path):
            out.append(p)
    return out


def natural_order() -> list:
    """Sort columns that put file-2 ahead of file-10, then lines in their order."""
    name = F.col("file")
    number = F.coalesce(F.regexp_extract(name, r"(\d+)\D*$", 1).try_cast("long"), F.lit(-1))
    return [F.regexp_replace(name, r"\d+\D*$", ""), number, name, F.col("row")]


def read_ndjson(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType | str, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records and broken lines of a file, a directory, or several of which some may be missing.

    Records carry file and row, which grows within a file; empty lines are
    nothing. With fail_fast a broken line ends the job. Declare scalars of
    uncertain type as strings and cast them with try_cast: a value of another
    type makes its line a broken one.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    here = _existing(spark, paths)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if not here:
        empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file", T.StringType()), T.StructField("row", T.LongType())]))
        return empty, spark.createDataFrame([], "file string, line string")
    options = {"mode": "FAILFAST" if fail_fast else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = spark.read.text(here).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row"))
    lines = text.where(F.trim("value") != "")
    parsed = lines.withColumn("j", F.from_json("value", schema if fail_fast else full, options))
    if fail_fast:
        return parsed.select("j.*", "file", "row"), spark.createDataFrame([], "file string, line string")
    good = parsed.where(F.col(f"j.{CORRUPT}").isNull() & F.col("j").isNotNull()).select(*[F.col("j")[f.name].alias(f.name) for f in schema.fields], "file", "row")
    bad = parsed.where(F.col(f"j.{CORRUPT}").isNotNull() | F.col("j").isNull()).select("file", F.col("value").alias("line"))
    return good, bad


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A whole file as one document."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_dimension_csv(spark: SparkSession, path: str, required: Iterable[str] = (), seps: tuple[str, ...] = (",", "\t", ";")) -> DataFrame:
    """A CSV with header, its separator taken from the header line, names trimmed
    and freed of a byte-order mark; an error if a required column is missing."""
    first = spark.read.text(path).limit(1).collect()
    header = first[0][0] if first else ""
    sep = max(seps, key=header.count)
    df = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.replace("﻿", "").strip().strip('"') for c in df.columns])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} among {', '.join(df.columns)}")
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV without header, columns by position."""
    return spark.read.schema(schema).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, fetch: int = 10_000, properties: dict | None = None) -> DataFrame:
    """A database table by ranges of a key, one query for each partition."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties={"fetchsize": str(fetch), **(properties or {})})


def write_ndjson(df: DataFrame, path: str, rows_per_file: int = 10_000, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("ignoreNullFields", "false").json(path)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Texts without tabs and line breaks, doubles with two decimals."""
    cols = [F.format_string("%.2f", c).alias(c) if t in ("double", "float") else tsv_escape(F.col(c).cast("string")).alias(c) for c, t in df.dtypes]
    df.select(*cols).write.mode(mode).option("header", True).option("sep", "\t").option("quote", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def json_report(df: DataFrame, key: str) -> DataFrame:
    """One JSON text for each row, keyed, in key order."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, F.to_json(F.struct(*rest)).alias("json")).orderBy(key)


def document_batches(df: DataFrame, send, rows_per_batch: int = 100_000) -> None:
    """Hands batches of documents to send(list of dicts) on the executors."""

    def run(rows) -> None:
        batch = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) >= rows_per_batch:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(run)
