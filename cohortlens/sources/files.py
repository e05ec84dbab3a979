"""Claim-file sources and sinks.

Every reader declares its schema (no inference).  Files of one type are
read together as one DataFrame, so the scan is split across executors.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import schemas
from cohortlens.session import written

log = logging.getLogger(__name__)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the data files of a folder."""
    fs, hp = _hadoop_fs(spark, path)
    if not fs.exists(hp):
        raise FileNotFoundError(path)
    if fs.getFileStatus(hp).isFile():
        return [path]
    found = [st.getPath() for st in fs.listStatus(hp) if st.isFile() and not st.getPath().getName().startswith(("_", "."))]
    return sorted(p.toString() for p in found)


def _header(spark: SparkSession, path: str, sep: str) -> tuple[str, ...]:
    """Column names from a file's first line, read without a Spark job."""
    fs, hp = _hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(hp)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()).getCodec(hp)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    names = next(csv.reader([(line or "").lstrip("\ufeff")], delimiter=sep), [])
    return tuple(n.strip() for n in names)


def _by_header(spark: SparkSession, paths: Sequence[str], sep: str) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header; empty files are left out."""
    groups: dict[tuple[str, ...], list[str]] = {}
    files = [f for path in paths for f in _data_files(spark, path)]
    with ThreadPoolExecutor(16) as pool:  # one line a file, many files at a time
        heads = list(pool.map(lambda f: _header(spark, f, sep), files))
    for f, head in zip(files, heads):
        if head:
            groups.setdefault(head, []).append(f)
    return groups


def _read_by_name(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None, sep: str,
                  mode: str = "PERMISSIVE") -> DataFrame:
    """Every file's columns bound by its own header: typed where declared, text otherwise; files with different
    headers are unioned by name."""
    declared = {f.name: f for f in (schema.fields if schema else [])}
    out = None
    for head, files in _by_header(spark, paths, sep).items():
        fields = T.StructType([declared.get(c, T.StructField(c, T.StringType(), True)) for c in head])
        part = (spark.read.schema(fields).option("header", True).option("sep", sep).option("enforceSchema", False)
                .option("mode", mode).csv(files))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], schema or T.StructType([])) if out is None else out


def _declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their order; those a file lacks are NULL."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def load_file(spark: SparkSession, path: str | Sequence[str],
              required_columns: Sequence[str] | None = None,
              schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """One claim CSV (or several of one type) with header, columns bound by name.

    Missing files raise (FileNotFoundError), a missing required column raises
    ``ValueError('Missing required columns: [...]')``.  Columns named in the
    schema are typed, all others are text; malformed rows fail the job
    (FAILFAST) like a parser error.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for head in _by_header(spark, paths, sep):
        missing = [c for c in required_columns or () if c not in head]
        if missing:
            raise ValueError(f"Missing required columns: {missing}")
    return _read_by_name(spark, paths, schema, sep, "FAILFAST")


def _checked(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None, sep: str = ",") -> DataFrame | None:
    """Every row of the files with its file's name (``_file``) and ``_bad``: more fields than the header, or a value
    that the declared type cannot hold.  One scan a file."""
    declared = {f.name: f.dataType for f in (schema.fields if schema else [])}
    out = None
    for head, files in _by_header(spark, paths, sep).items():
        # a field beyond the header falls into one more column
        text = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(len(head) + 1)])
        raw = (spark.read.schema(text).option("header", True).option("sep", sep).option("mode", "PERMISSIVE").csv(files)
               .select("*", F.col("_metadata.file_path").alias("_file")))
        bad, cols = F.col(f"c{len(head)}").isNotNull(), []
        for i, name in enumerate(head):
            kind = declared.get(name, T.StringType())
            value = F.col(f"c{i}") if isinstance(kind, T.StringType) else F.col(f"c{i}").try_cast(kind)
            bad = bad | (F.col(f"c{i}").isNotNull() & value.isNull())
            cols.append(value.alias(name))
        part = raw.select("_file", bad.alias("_bad"), *cols)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def load_all(spark: SparkSession, data_dir: str, types: Sequence[str] = tuple(schemas.FILE_TYPES)
             ) -> dict[str, DataFrame]:
    """Every ``*.csv`` (a file, or a folder of data files) in ``data_dir``;
    it belongs to each type whose name occurs in its name (case-insensitive).
    All files of a type are unioned by column name (deterministic, trap K1).
    A file that lacks a required column, holds a row with too many fields or
    a value that its declared type cannot hold is skipped with a warning; an
    absent type is left out of the result.  No CSV at all raises
    FileNotFoundError.

    Each file is scanned once: the typed rows are written to the shared folder
    with their file's name, and those of bad files are left out of what is
    read back.
    """
    fs, hp = _hadoop_fs(spark, data_dir)
    if not fs.exists(hp):
        raise FileNotFoundError(data_dir)
    names = sorted(st.getPath().toString() for st in fs.listStatus(hp) if st.getPath().getName().endswith(".csv"))
    if not names:
        raise FileNotFoundError(f"no CSV files in {data_dir}")
    out: dict[str, DataFrame] = {}
    for ftype in types:
        matched = [f for n in names if ftype.upper() in n.rsplit("/", 1)[-1].upper() for f in _data_files(spark, n)]
        whole = []
        for head, files in _by_header(spark, matched, ",").items():
            lacking = [c for c in schemas.REQUIRED_ON_LOAD.get(ftype, ()) if c not in head]
            if lacking:
                log.warning("skipping %s (%s): columns not found: %s", files, ftype, lacking)
            else:
                whole += files
        if not whole:
            continue
        rows = written(_checked(spark, whole, schemas.SCHEMAS.get(ftype)), f"load_{ftype}")
        bad = [r["_file"] for r in rows.where("_bad").select("_file").distinct().collect()]  # at most one a file listed
        for f in bad:
            log.warning("skipping %s (%s): a row has more fields than the header, or a value of another type", f, ftype)
        if len(bad) < len(whole):
            out[ftype] = (rows.where(~F.col("_file").isin(bad)) if bad else rows).drop("_file", "_bad")
    missing = [t for t in types if t not in out]
    if missing:
        log.warning("no usable file of type: %s", missing)
    return out


def load_typed(spark: SparkSession, path: str | Sequence[str], file_type: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """S3: the declared columns, bound by header name, projected to ``columns`` (pruned in the scan)."""
    paths = [path] if isinstance(path, str) else list(path)
    schema = schemas.SCHEMAS[file_type]
    df = _declared(_read_by_name(spark, paths, schema, ","), schema)
    return df.select(*columns) if columns else df


def load_lookup(spark: SparkSession, path: str, code_col: str = "ICD9_CD",
                desc_col: str = "ICD9_DESC_LONG") -> DataFrame:
    """Tab-separated code-to-description file, renamed to (code, description)."""
    df = _read_by_name(spark, [path], schemas.LOOKUP, "\t")
    return df.select(F.col(code_col).alias("code"), F.col(desc_col).alias("description"))


def load_processed(spark: SparkSession, path: str, schema: T.StructType | str,
                   date_cols: Sequence[str] = (), fmt: str = "csv") -> DataFrame:
    """Re-read a stage output with its schema (bound by name), dates parsed."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    df = _declared(_read_by_name(spark, [path], declared, ","), declared)
    for c in date_cols:
        df = df.withColumn(c, F.to_date(F.col(c)))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
                partition_by: Sequence[str] = ()) -> str:
    """Overwrite a stage output (Parquet by default, CSV with header on request).

    ``single_file`` funnels the rows through one task and is only for small
    report tables.
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def load_fixed_width(spark: SparkSession, path: str, fields: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Fixed-width text to columns; ``fields`` = (name, start 1-based, length)."""
    raw = spark.read.text(path)
    return raw.select(*[F.trim(F.substring("value", start, length)).alias(name)
                        for name, start, length in fields])
