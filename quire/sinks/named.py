"""Files under their own names (K1, K2, K3, K4): a data source writer with a two-phase commit.

Spark's own writers name files themselves, so a folder per document is the nearest they
get.  ``NamedFiles`` writes (path, text) rows to ``<out>/<path>``; with the option ``parts``, rows of
one path that follow each other in a task become one file.

Every task attempt writes into a folder of its own under ``<out>/_quire-<job>``; the
commit moves the files of the attempts that Spark accepted to their names and then
drops that folder.  A failed or repeated attempt leaves nothing behind, and a
file is seen whole or not at all.  Existing files of the same name are replaced, others are
left alone.  Texts are written as UTF-8 as they are, without added line ends.

``out`` is any path that ``pyarrow.fs`` opens (a shared folder, ``s3://``, ``hdfs://``).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions import text as T
from ..operators import summarize as SU
from ..sources.files import open_path, qualified

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "quire_named_files"
STAGE = "_quire-"


@dataclass
class Attempt(WriterCommitMessage):
    """Folder of one task attempt and the number of its files."""
    folder: str
    files: int


def check_path(path: str | None) -> str:
    """A relative file path without empty, hidden or upward parts."""
    parts = (path or "").split("/")
    if any(p in ("", ".", "..") or "\0" in p for p in parts) or parts[0].startswith(STAGE):
        raise ValueError(f"not a file name below the output folder: {path!r}")
    return "/".join(parts)


class NamedFileWriter(DataSourceArrowWriter):
    def __init__(self, out: str, parts: bool):
        self.out = out.rstrip("/")
        self.parts = parts       # consecutive rows of a path are one file
        self.stage = f"{STAGE}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        fs, root = open_path(self.out)
        attempt = f"{self.stage}/{TaskContext.get().taskAttemptId()}"
        seen: set[str] = set()
        now, stream = None, None
        try:
            for batch in iterator:
                for path, text in zip(batch.column(0), batch.column(1)):
                    path = path.as_py()
                    if path != now or not self.parts:
                        if stream is not None:
                            stream.close()
                            stream = None
                        now = check_path(path)
                        if now in seen:
                            raise ValueError(f"two files of the name {now!r}")
                        seen.add(now)
                        target = f"{root}/{attempt}/{now}"
                        fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                        stream = fs.open_output_stream(target)
                    stream.write((text.as_py() or "").encode("utf-8", "surrogatepass"))
            if stream is not None:
                stream.close()
                stream = None
        except BaseException:
            if stream is not None:
                stream.close()
            self._drop(fs, f"{root}/{attempt}")
            raise
        return Attempt(attempt, len(seen))

    def commit(self, messages: list[Attempt | None]) -> None:
        fs, root = open_path(self.out)
        done: set[str] = set()
        for m in messages:
            if m is None or not m.files:
                continue
            base = f"{root}/{m.folder}/"
            names = [i.path[len(base):] for i in fs.get_file_info(pafs.FileSelector(base, recursive=True))
                     if i.type == pafs.FileType.File]
            twice = done.intersection(names)
            if twice or len(names) != m.files:
                raise ValueError(f"two files of the name {min(twice)!r}" if twice else f"{m.folder} lost files")
            for name in names:
                if "/" in name:
                    fs.create_dir(f"{root}/{name.rsplit('/', 1)[0]}", recursive=True)
                fs.move(base + name, f"{root}/{name}")
            done.update(names)
        self._drop(fs, f"{root}/{self.stage}")

    def abort(self, messages: list[Attempt | None]) -> None:
        fs, root = open_path(self.out)
        self._drop(fs, f"{root}/{self.stage}")

    @staticmethod
    def _drop(fs: pafs.FileSystem, folder: str) -> None:
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class NamedFiles(DataSource):
    """``df.write.format("quire_named_files").mode("append").save(folder)`` for (path, text) rows."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> NamedFileWriter:
        if overwrite:
            raise ValueError("files are replaced by name; use mode('append')")
        return NamedFileWriter(self.options["path"], self.options.get("parts", "false") == "true")


def write_files(df: DataFrame, out: str, path: Column, text: str = "text", order: str | None = None) -> None:
    """One file per distinct ``path`` below ``out``; several rows of a path go in ``order``.

    Without ``order`` two rows of one path are an error, and nothing is written.  A path is one
    task's, so rows are dealt by path first; a file larger than memory is written row by row.
    """
    sort = [F.col(order).alias("_order")] if order else []
    rows = (df.select(path.alias("path"), F.col(text).cast("string").alias("text"), *sort)
            .repartition("path").sortWithinPartitions("path", *(["_order"] if order else [])))
    df.sparkSession.dataSource.register(NamedFiles)
    (rows.select("path", "text").write.format(FORMAT).option("parts", str(bool(order)).lower())
     .mode("append").save(qualified(df.sparkSession, out)))


def file_part(c: Column) -> Column:
    """A title as one part of a path: slashes and control characters become ``_``."""
    return F.regexp_replace(c, r"[/\x00-\x1f]", "_")


# K1
def default_name(source: Column, suffix: str = ".md") -> Column:
    """Name of the output of an input path: its base name without suffix, and ``suffix``."""
    return F.concat(T.base_name(source), F.lit(suffix))


def write_documents(df: DataFrame, out: str, source: str | None = "path", text: str = "text",
                    suffix: str = ".md", title: str | None = None) -> None:
    """One file per document: ``<base name of source><suffix>``, or ``<title><suffix>`` when ``title`` is named."""
    name = F.concat(file_part(F.col(title)), F.lit(suffix)) if title else default_name(F.col(source), suffix)
    write_files(df, out, name, text)


# K2
def chapter_folder(source: Column) -> Column:
    return F.concat(file_part(T.base_name(source)), F.lit("_chapters"))


def write_chapter_files(chapters: DataFrame, out: str, source: str = "doc_id", text: str = "rendered") -> None:
    """Chapters (after W5) as ``<source>_chapters/<slug>.md``."""
    folder = chapter_folder(F.col(source).cast("string"))
    write_files(chapters, out, F.concat(folder, F.lit("/"), "slug", F.lit(".md")), text)


# K3
def write_summary_files(stored: DataFrame, out: str, source: str = "doc_id") -> None:
    """Stored summaries (M3) as ``sum_<model>_<slug>.md`` beside the chapters of ``write_chapter_files``."""
    folder = chapter_folder(F.col(source).cast("string"))
    write_files(stored, out, F.concat(folder, F.lit("/"), "out_name"), "text")


def summary_path(model: str, path: Column) -> Column:
    """``sum_<model>_<name>`` in the folder of ``path``."""
    return F.concat(F.regexp_extract(path, r"\A(.*/)?[^/]*\z", 1), SU.summary_name(model, T.file_name(path)))


# K4
def write_combined_file(df: DataFrame, out: str, name: str = "all.md", order: str = "name",
                        text: str = "text", sep: str = "\n\n") -> None:
    """All texts in ``order`` as the one file ``out/name``, ``sep`` after each.

    One file is one writer: its task sorts with spill and writes row by row, so memory does not
    grow with it.  Where several files will do, ``write_ordered_parts`` writes in parallel.
    """
    rows = df.select(order, F.concat(F.coalesce(F.col(text), F.lit("")), F.lit(sep)).alias("_t"))
    write_files(rows, out, F.lit(name), "_t", order)
