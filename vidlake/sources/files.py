"""Landed-file and lake-table readers (SRC-1, SRC-2, SRC-3, SRC-4, SRC-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlake.functions.clean import normalize_name, standardize_column_names
from vidlake.schemas import BRONZE_SCHEMA, REQUIRED_COLUMNS

CORRUPT_COLUMN = "_corrupt_record"


def escape_breaks(c: Column) -> Column:
    """Text without line breaks: a backslash doubled, line feed and carriage return as \\n and \\r.  A CSV
    file of such texts has one record per line and can be split anywhere."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def restore_breaks(c: Column) -> Column:
    """The inverse of ``escape_breaks``: doubled backslashes stand aside while the breaks are put back."""
    aside = F.lit("\u0000")
    c = F.replace(c, F.lit("\\\\"), aside)
    c = F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(c, aside, F.lit("\\"))


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def leaf_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders at or below ``path`` that hold files, without hidden ones (names that start with _ or a dot);
    a file is its own folder."""
    fs, root = hadoop_path(spark, path)
    if fs.getFileStatus(root).isFile():
        return [path]
    found, todo = [], [root]
    while todo:
        here, files = todo.pop(), False
        for s in fs.listStatus(here):
            name = s.getPath().getName()
            if not name.startswith(("_", ".")):
                if s.isDirectory():
                    todo.append(s.getPath())
                else:
                    files = True
        if files:
            found.append(here.toString())
    return sorted(found)


def first_line(spark: SparkSession, folder: str) -> str | None:
    """The first line of a folder's (or of a file) first file that is not empty, read on the driver; None if all are
    empty."""
    fs, at = hadoop_path(spark, folder)
    files = sorted((s.getPath().toString(), s.getLen()) for s in fs.listStatus(at) if s.isFile())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, size in files:
        if size and not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            path = jvm.org.apache.hadoop.fs.Path(name)
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
            stream = fs.open(path)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            try:
                return reader.readLine()
            finally:
                reader.close()
    return None


def read_bronze_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = BRONZE_SCHEMA,
                    keep_corrupt: bool = False, multi_line: bool = False, escaped: bool = True) -> DataFrame:
    """SRC-1: landed CSV with a header row, all text, nothing inferred.

    Columns are taken by the names in each folder's header (the files of one landing share it; a file whose
    header differs from its folder's is an error).  Folders are read together, one scan per distinct header, so
    the plan does not grow with the number of landings.  Names are normalised as in CLN-2.  With ``schema`` (default) the
    declared columns come in declared order, others are left out, a missing required column is an error and
    another missing one null; with ``schema=None`` all columns of the header.  Malformed lines are kept, with
    their raw text in ``_corrupt_record`` when ``keep_corrupt``.  ``escaped`` files (as ``write_bronze_csv``
    lands them) have their line breaks restored; files from elsewhere with line breaks inside quotes need
    ``multi_line``, which makes each file one task."""
    folders = [f for p in ([path] if isinstance(path, str) else path) for f in leaf_folders(spark, p)]
    headers: dict[str, list[str]] = {}
    for f in folders:
        line = first_line(spark, f)
        if line is not None:
            headers.setdefault(line, []).append(f)
    parts = [_read_folders(spark, fs, schema, keep_corrupt, multi_line, escaped) for fs in headers.values()]
    if not parts:
        raise FileNotFoundError(f"no landed files in {path}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=schema is None)
    return out


def _read_folders(spark, folders, schema, keep_corrupt, multi_line, escaped) -> DataFrame:
    """Landed folders (or files) of one header."""
    r = (spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
         .option("multiLine", multi_line).option("enforceSchema", False))
    declared = r.csv(folders[0]).schema
    if keep_corrupt:
        declared = T.StructType([*declared.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    raw = r.schema(declared).csv(folders)
    named = standardize_column_names(raw)
    if schema is not None:
        missing = [c for c in REQUIRED_COLUMNS if c in schema.fieldNames() and c not in named.columns]
        if missing:
            raise ValueError(f"{folders[0]} lacks the required columns {', '.join(missing)}")
        wanted = [normalize_name(c) for c in schema.fieldNames()] + ([CORRUPT_COLUMN] if keep_corrupt else [])
        named = named.select(*(F.col(f"`{c}`") if c in named.columns else F.lit(None).cast("string").alias(c)
                               for c in wanted))
    if escaped:
        named = named.select(*(restore_breaks(F.col(f"`{c}`")).alias(c) if c != CORRUPT_COLUMN else F.col(c)
                               for c in named.columns))
    return named


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2 / SRC-3 / SRC-4: a partitioned Parquet table (silver, a gold
    table, features).  Partition directories become typed columns and
    predicates on them prune directories."""
    return spark.read.option("basePath", path).parquet(path)


def peek(df: DataFrame, n: int = 10) -> DataFrame:
    """SRC-8: ``SELECT * ... LIMIT n``."""
    return df.limit(n)
