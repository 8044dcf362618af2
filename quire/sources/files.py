"""File sources (S1-S3) with bad-file rejects (X3) and the empty-listing check (H8).

Files are read with Spark's ``binaryFile`` source, so reading is distributed; text is
decoded on the executors and validated with built-in functions.  A file never ends the
job: one that is not valid UTF-8, and one that was listed but could not be read, go to a
reject table with the reason.  What was listed comes from Spark's own file index and
is anti-joined with the files that gave a row; only files left over are looked at again.  A
zero-byte file, for which Spark gives no row, is an empty document.  Like every
Spark file source, names starting with ``.`` or ``_`` are not listed (the reference's
``glob('*')`` would list them).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOT_UTF8 = "not valid UTF-8"
GONE = "listed but no longer there"
UNREADABLE = "could not be read"


def _reader(spark: SparkSession):
    """Whole files; one that vanishes or cannot be read after listing gives no row here
    and does not end the job (``_unread`` finds it)."""
    return (spark.read.format("binaryFile").option("ignoreMissingFiles", "true")
            .option("ignoreCorruptFiles", "true"))


def _local(encoded: Column) -> Column:
    """Spark writes local files with one or three slashes after the scheme: here with one."""
    return F.regexp_replace(encoded, r"\Afile:/+", "file:/")


def _listed(files: DataFrame) -> DataFrame:
    """(path, _enc): every file of the listing that Spark made for ``files``, as it is and with
    URL escapes; paths stay in the JVM."""
    spark = files.sparkSession
    jvm = spark._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    paths = spark._jsparkSession.createDataset(jvm.scala.jdk.javaapi.CollectionConverters.asJava(names),
                                               jvm.org.apache.spark.sql.Encoders.STRING())
    encoded = _local(F.col("value"))
    return DataFrame(paths.toDF(), spark).select(
        F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))).alias("path"), encoded.alias("_enc"))


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and name of a path as Spark writes it (local ones without URL escapes)."""
    if path.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def look_again(path: str, open_fs=open_path) -> tuple[bool, str | None]:
    """(empty, reason) of a listed file that gave no row."""
    try:
        fs, name = open_fs(path)
        info = fs.get_file_info(name)
        if info.type == pafs.FileType.NotFound:
            return False, GONE
        with fs.open_input_stream(name) as f:
            some = f.read(1)
        return (True, None) if not some and not info.size else (False, UNREADABLE)
    except FileNotFoundError:
        return False, GONE
    except (OSError, ValueError, NotImplementedError, pa.ArrowException) as e:
        return False, f"{UNREADABLE}: {type(e).__name__}"


def _unread(files: DataFrame, listed: DataFrame) -> DataFrame:
    """(path, empty, reason) of the listed files that gave no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [look_again(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([e for e, _ in told], type=pa.bool_()),
                 pa.array([r for _, r in told], type=pa.string())], names=["path", "empty", "reason"])

    # the content is asked for, so a file that cannot be opened gives no row
    read = files.where(F.length("content") >= 0).select(_local(F.col("_metadata.file_path")).alias("_enc"))
    return listed.join(read, "_enc", "left_anti").select("path").mapInArrow(run, "path string, empty boolean, reason string")


def _split(files: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((path, name, text), (path, reason)): text-mode decoding, CR and CRLF to LF."""
    raw = F.col("content").cast("string")
    ok = F.is_valid_utf8(raw)
    seen = files.select("path", raw.alias("_raw"), ok.alias("_ok"))
    unread = _unread(files, listed)
    docs = (seen.where("_ok").select("path", F.regexp_replace("_raw", "\r\n?", "\n").alias("text"))
            .unionByName(unread.where("empty").select("path", F.lit("").alias("text"))))
    rejects = (seen.where(~F.col("_ok")).select("path", F.lit(NOT_UTF8).alias("reason"))
               .unionByName(unread.where(~F.col("empty")).select("path", "reason")))
    return docs.select("path", T.file_name("path").alias("name"), "text"), rejects


def _parent(path: str) -> str:
    return path.rstrip("/")


# S1 + X3
def scan_text_dir(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Every file directly in ``directory`` (any suffix): ((path, name, text), rejects).

    Order is the ``name`` column (binary order = code-point order, as a sorted
    listing); sub-directories are not descended into.
    """
    files = _reader(spark).load(directory)
    folder = F.regexp_replace(F.lit(qualified(spark, directory)), "\\Afile:", "")

    def top(df: DataFrame) -> DataFrame:
        return df.where(F.regexp_replace(F.regexp_replace("path", "/[^/]*\\z", ""), "\\Afile:", "") == folder)

    return _split(top(files), top(_listed(files)))


def qualified(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_parent(path))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


# S2
def scan_markdown_tree(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A single file as given, or every ``*.md`` below a directory except ``sum_*`` outputs."""
    reader = _reader(spark)
    if _is_file(spark, path):
        files = reader.load(path)
        return _split(files, _listed(files))
    files = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(path)
    source = ~T.file_name("path").startswith("sum_")
    return _split(files.where(source), _listed(files).where(source))


# S3
def read_text_docs(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Whole files as documents: ((path, name, text), rejects)."""
    files = _reader(spark).load(paths)
    return _split(files, _listed(files))


# H8
def require_rows(df: DataFrame, message: str = "No files found") -> DataFrame:
    """Stop at the entry point when a listing is empty (one cheap ``isEmpty`` probe)."""
    if df.isEmpty():
        raise ValueError(message)
    return df
