"""Run folders written and read by the cluster: one file per row, at a path that the row names.

Spark's own writers name their files, but the app's layout is
``<root>/run-<digits>/<file>``.  Each task writes the files of its rows
through the file system of the root's URI (local, HDFS, object stores as
pyarrow knows them) and returns what it wrote, so nothing passes through the
driver but the inventory's location.

A file is first written under a hidden name in its folder, which Spark's
readers skip, and then renamed.  The same rows give the same files, so a task
that runs twice changes nothing.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# executors need the public libraries, not this repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INVENTORY = "folder string, file_name string, size_bytes long"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority of its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def _write(files: fs.FileSystem, path: str, text: bytes) -> None:
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as out:
        out.write(text)
    try:
        files.move(hidden, path)
    except OSError:  # some file systems do not rename onto a file: another run of the task was first
        if files.get_file_info(path).type != fs.FileType.File:
            raise
        files.delete_file(hidden)


def write_run_files(rows: DataFrame, root: str, inventory: str) -> DataFrame:
    """Write each row (folder, file_name, text) to ``<root>/<folder>/<file_name>``
    and the inventory of all files as a table at the path ``inventory``, which
    is returned.  Null texts are empty files; rows without a folder or a file
    name have no place and are left out; of rows with one path any one stays.
    """
    spark = rows.sparkSession
    uri = qualified(spark, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            folders, names = batch.column("folder"), batch.column("file_name")
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            made = None
            for folder, name, text in zip(folders.to_pylist(), names.to_pylist(), texts):
                if folder != made:  # a folder's files follow each other
                    files.create_dir(f"{base.rstrip('/')}/{folder}", recursive=True)
                    made = folder
                _write(files, f"{base.rstrip('/')}/{folder}/{name}", text)
            yield pa.RecordBatch.from_arrays([folders, names, pa.array([len(t) for t in texts], pa.int64())],
                                             ["folder", "file_name", "size_bytes"])

    placed = rows.select("folder", "file_name", "text").dropna(subset=["folder", "file_name"])
    placed.mapInArrow(write, INVENTORY).write.parquet(inventory)
    return spark.read.schema(INVENTORY).parquet(inventory)


# --- listed and read by the tasks -----------------------------------------------------
# Spark's file index brings the status of every file to the driver and plans each
# small file as four MB.  Where the names of the folders are a table, the tasks
# list and read them instead.

LISTED = "path string, length long, modificationTime timestamp"


def list_folders(names: DataFrame, root: str) -> DataFrame:
    """The files in the folders of ``root`` that ``names`` (its column
    ``folder``) has, at any depth: path, length, modificationTime.  As in
    Spark's file scans empty files and hidden ones (``.`` or ``_`` first) are
    left out; a folder that is not there has no files."""
    uri = qualified(names.sparkSession, root)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(uri)
        base = base.rstrip("/")
        for batch in batches:
            found = [i for folder in batch.column("folder").to_pylist()
                     for i in files.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True, recursive=True))
                     if i.type == fs.FileType.File and i.size and not any(p[0] in "._" for p in i.path[len(base) + 1:].split("/"))]
            yield pa.RecordBatch.from_arrays([
                pa.array([uri.rstrip("/") + i.path[len(base):] for i in found], pa.string()), pa.array([i.size for i in found], pa.int64()),
                pa.array([i.mtime_ns // 1000 for i in found], pa.int64()).cast(pa.timestamp("us", "UTC"))], ["path", "length", "modificationTime"])

    return names.select("folder").dropna().distinct().mapInArrow(listed, LISTED)


def read_texts(files: DataFrame, root: str) -> DataFrame:
    """(path, text) of the files that :func:`list_folders` found."""
    uri = qualified(files.sparkSession, root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(base.rstrip("/") + path[len(uri.rstrip("/")):]) as stream:
                    text = stream.read().decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([text], pa.string())], ["path", "text"])

    return files.select("path").mapInArrow(read, "path string, text string")
