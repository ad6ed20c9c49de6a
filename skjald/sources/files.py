"""Many files: a sink with one for each row, written by tasks and moved to their places when all have ended, and a walk over folders.

The sink is a data source of its own, `skjald_files`, for tables of `path` (relative to the option
`root`) and `content` (bytes). Each task writes to a folder of its own under
`root/_temporary/<job>`; what it reports is that folder's name alone. When all tasks are done
the files are moved; a task that fails, or runs twice, leaves nothing outside its folder,
which goes with the job's. write_files() lists, checks and moves them in tasks as well, so that
the driver meets folders of tasks alone, whatever the number of files; a writer by itself
moves them on the driver (a task that is still being killed then may leave files below
`_temporary`, never in their places).

Mode append fails before anything is moved if a file is there already, mode overwrite
replaces it. Of rows that have one path, those of the later task stay. Null paths or
contents, and paths that leave the root, are errors. Any file system that pyarrow opens
by its address will do, if all executors reach it.
"""

from __future__ import annotations

import fnmatch
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from skjald.sources.shared import batched, cut

TEMPORARY = "_temporary"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the folder in it."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root)


def relative(path: str | None) -> str:
    normal = posixpath.normpath(path) if path else ".."
    if normal.startswith(("/", "..")) or normal == "." or normal.split("/")[0] == TEMPORARY:
        raise ValueError(f"not a path below the root: {path!r}")
    return normal


@dataclass
class Written(WriterCommitMessage):
    folder: str


class FileWriter(DataSourceArrowWriter):
    def __init__(self, root: str, overwrite: bool, job: str | None):
        self.root, self.overwrite, self.job, self.staged = root, overwrite, job or uuid.uuid4().hex, job is not None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, top = opened(self.root)
        context = TaskContext.get()
        name = f"{context.partitionId()}-{context.taskAttemptId()}"
        made = set()
        for batch in iterator:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                to = f"{top}/{TEMPORARY}/{self.job}/{name}/{relative(path.as_py())}"
                if (folder := posixpath.dirname(to)) not in made:
                    store.create_dir(folder)
                    made.add(folder)
                if not content.is_valid:
                    raise ValueError(f"no content for {path}")
                with store.open_output_stream(to) as out:
                    out.write(content.as_buffer())
        return Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        if self.staged:  # whoever named the job moves its files
            return
        store, top = opened(self.root)
        base = f"{top}/{TEMPORARY}/{self.job}"
        places = sorted((m.folder for m in messages if m is not None), key=lambda x: int(x.split("-")[0]))
        for move in (False, True):  # looks for what is there before anything moves
            if not move and self.overwrite:
                continue
            for place in places:
                for found in store.get_file_info(fs.FileSelector(f"{base}/{place}", allow_not_found=True, recursive=True)):
                    if found.type != fs.FileType.File:
                        continue
                    to = f"{top}/{posixpath.relpath(found.path, f'{base}/{place}')}"
                    if move:
                        store.create_dir(posixpath.dirname(to))
                        store.move(found.path, to)
                    elif store.get_file_info(to).type != fs.FileType.NotFound:
                        self.abort(messages)
                        raise FileExistsError(to)
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Removes what the job's tasks have written and not moved."""
        forget(self.root, self.job)


def forget(root: str, job: str) -> None:
    """Removes what is left of a job, and the folder of all jobs if it is empty then."""
    store, top = opened(root)
    for folder in (f"{top}/{TEMPORARY}/{job}", f"{top}/{TEMPORARY}"):
        if store.get_file_info(folder).type == fs.FileType.Directory and (folder.endswith(job) or not store.get_file_info(fs.FileSelector(folder))):
            store.delete_dir(folder)


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "skjald_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["root"], overwrite, self.options.get("job"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileSink)


def write_files(rows: DataFrame, to: str, overwrite: bool = False) -> None:
    """A file below `to` for each row of path and content."""
    spark, job = rows.sparkSession, uuid.uuid4().hex
    register(spark)
    rows.select("path", "content").write.format(FileSink.name()).option("root", to).option("job", job).mode("overwrite" if overwrite else "append").save()
    try:
        place(spark, to, job, overwrite)
    finally:
        forget(to, job)


def place(spark: SparkSession, root: str, job: str, overwrite: bool) -> None:
    """Moves the files of a job's tasks to their places, by tasks; if one is there already and they aren't to be replaced, none is moved."""
    store, top = opened(root)
    base = f"{top}/{TEMPORARY}/{job}"
    folders = [x.base_name for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True))]
    if not folders:
        return

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = opened(root)[0]
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [x.path for x in store.get_file_info(fs.FileSelector(f"{base}/{folder}", recursive=True)) if x.type == fs.FileType.File]
                yield pa.RecordBatch.from_pydict({"path": pa.array([posixpath.relpath(x, f"{base}/{folder}") for x in found], pa.string()), "folder": pa.array([folder] * len(found), pa.string())})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = opened(root)[0]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for found in store.get_file_info([f"{top}/{x}" for x in batch.column(0)[at : at + 1000].to_pylist()]):
                    if found.type != fs.FileType.NotFound:
                        raise FileExistsError(found.path)
            yield batch.slice(0, 0)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, made = opened(root)[0], set()
        for batch in batches:
            for path, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                to = f"{top}/{path}"
                if (parent := posixpath.dirname(to)) not in made:
                    store.create_dir(parent)
                    made.add(parent)
                try:
                    store.move(f"{base}/{folder}/{path}", to)
                except FileNotFoundError:  # a task that ran before has moved it
                    if store.get_file_info(to).type == fs.FileType.NotFound:
                        raise
            yield batch.slice(0, 0)

    names = spark.createDataFrame([(x,) for x in folders], "folder string").repartition(len(folders))
    number = F.split("folder", "-").getItem(0).cast("int")
    rows = names.mapInArrow(written, "path string, folder string")
    rows = cut(rows.groupBy("path").agg(F.max_by("folder", number).alias("folder")))  # of one path, the later task's
    for step in (move,) if overwrite else (look, move):
        rows.mapInArrow(step, "path string, folder string").collect()


def hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


#: Files that a task lists or reads, some; folders aren't divided.
TASK_FILES = 5_000


def walked(spark: SparkSession, root: str, pattern: str) -> DataFrame | None:
    """path of all files below the folder `root` whose names fit, level by level: each folder is listed by a task.

    None if pyarrow can't open it as a folder, or the pattern isn't one of its own."""
    try:
        store, top = opened(root)
        if store.get_file_info(top).type != fs.FileType.Directory or set(pattern) & set("{\\^"):
            return None
    except (pa.ArrowException, OSError, ValueError):
        return None
    head = "file:" if isinstance(store, fs.LocalFileSystem) else root.rstrip("/").removesuffix(top.strip("/")).rstrip("/") + "/"

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = opened(root)[0]
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [x for x in store.get_file_info(fs.FileSelector(folder)) if not hidden(x.base_name)]
                found = [x for x in found if x.type == fs.FileType.Directory or fnmatch.fnmatchcase(x.base_name, pattern)]
                yield pa.RecordBatch.from_pydict({"path": pa.array([x.path for x in found], pa.string()), "deeper": pa.array([x.type == fs.FileType.Directory for x in found], pa.bool_())})

    level, files = spark.createDataFrame([(top,)], "path string"), None
    while True:
        found = cut(level.mapInArrow(entries, "path string, deeper boolean"))
        here = found.filter("NOT deeper").select("path")
        files = here if files is None else files.union(here)
        level = found.filter("deeper").select("path")
        if not (folders := level.count()):
            break
        level = level.repartition(min(folders, 10 * spark.sparkContext.defaultParallelism))
    return files.select(F.concat(F.lit(head), F.col("path") if head == "file:" else F.ltrim(F.col("path"), F.lit("/"))).alias("path"))


def contents(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path and content of the files below a folder."""
    files = walked(spark, root, pattern)
    if files is None:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = None
        for batch in batches:
            store = store or opened(root)[0]
            rows = ((path, _bytes(store, path)) for path in batch.column(0).to_pylist())
            yield from batched(rows, pa.schema([("path", pa.string()), ("content", pa.binary())]))

    return files.repartition(max(spark.sparkContext.defaultParallelism, -(-files.count() // TASK_FILES)), "path").mapInArrow(read, "path string, content binary")


def _bytes(store: fs.FileSystem, address: str) -> bytes:
    path = address.removeprefix("file:") if isinstance(store, fs.LocalFileSystem) else store.normalize_path(fs.FileSystem.from_uri(address)[1])
    with store.open_input_stream(path) as file:
        return file.read()
