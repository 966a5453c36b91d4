"""Object storage seen from tasks: a listing, folder by folder, without names on the driver (SRC-4, SRC-6).

``list_tree`` walks a tree level by level. The folders of a level are a table; tasks list them
through ``pyarrow.fs`` and their entries are written under the checkpoint folder, where the next level's folders are read.
The driver sees the number of folders of a level and nothing else, so neither millions of names nor
thousands of folders weigh on it. Folders of one level are dealt over tasks by a hash of their name.
One folder is one listing call, as storage lists a folder in order; its names stream on in batches, those of small folders together.
A level has at most `TASKS_PER_CORE` tasks a core, so a deal of a level among tasks stays small however many folders it has.
A folder that disappears while the walk runs counts as empty. A lost executor costs the listing of its folders.

Names that begin with ``_`` or ``.`` are left out with all below them, as in Spark's own file sources.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import qualified, work_dir

#: Folders that one task lists, and names in one batch.
FOLDERS_PER_TASK, NAMES, TASKS_PER_CORE = 64, 10_000, 8
ENTRY = "parent string, name string, is_folder boolean, length bigint, modificationTime timestamp"
LISTING = "path string, length bigint, modificationTime timestamp"


def opener():
    """A function from a URI to (file system, path), for use in a task; it needs only pyarrow there."""
    def opened(uri: str):
        from pyarrow import fs

        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        if uri.startswith("file://"):
            return fs.LocalFileSystem(), uri[len("file://"):]     # such names may hold spaces and other characters as they are
        scheme, rest = uri.split("://", 1)
        return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + "://" + rest)

    return opened


def glob_pattern(glob: str) -> str:
    """A file name pattern (``*``, ``?``, ``[..]``, ``{a,b}``) as a regular expression for the whole name."""
    out, depth, i = [], 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in glob[i + 1:]:
            end = glob.index("]", i + 2)
            body = glob[i + 1:end].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] in "!^" else body) + "]")
            i = end
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        i += 1
    return "^" + "".join(out) + "$"


def _entries(root: str):
    open_, most = opener(), NAMES

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        store, base = open_(root)
        base = base.rstrip("/")

        def batch(found: list):
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.string()), pa.array([f.base_name for _, f in found], pa.string()),
                 pa.array([f.type == fs.FileType.Directory for _, f in found], pa.bool_()),
                 pa.array([None if f.type == fs.FileType.Directory else f.size for _, f in found], pa.int64()),
                 pa.array([f.mtime_ns and f.mtime_ns // 1000 for _, f in found], pa.timestamp("us", tz="UTC"))],
                ["parent", "name", "is_folder", "length", "modificationTime"])

        held = []
        for b in batches:
            for parent in b.column(0).to_pylist():
                at = f"{base}/{parent}" if parent else base
                found = store.get_file_info(fs.FileSelector(at, recursive=False, allow_not_found=True))
                held += [(parent, f) for f in found if f.type in (fs.FileType.File, fs.FileType.Directory) and f.base_name[:1] not in ("_", ".")]
                if len(held) >= most:
                    for i in range(0, len(held), most):
                        yield batch(held[i:i + most])
                    held = []
        if held:
            yield batch(held)

    return run


def list_folders(folders: DataFrame, root: str) -> DataFrame:
    """The entries (`ENTRY`) directly in each folder of the first column (paths below ``root``)."""
    return folders.select(F.col(folders.columns[0]).alias("parent")).mapInArrow(_entries(qualified(folders.sparkSession, root)), ENTRY)


def list_tree(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every object below ``root`` whose name fits ``glob``; bytes are not read."""
    top = qualified(spark, root)
    levels, folders, n = [], spark.createDataFrame([("",)], "parent string"), 1
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    while n:
        dealt = folders.repartition(min(tasks, -(-n // FOLDERS_PER_TASK)), "parent") if n > 1 else folders.coalesce(1)
        path = work_dir(spark, "listing")
        list_folders(dealt, top).write.parquet(path)
        level = spark.read.schema(ENTRY).parquet(path)
        levels.append(level.where("NOT is_folder"))
        below = F.concat_ws("/", F.when(F.col("parent") != "", F.col("parent")), "name")
        folders = level.where("is_folder").select(below.alias("parent"))
        n = folders.count()
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    if glob:
        found = found.where(F.col("name").rlike(glob_pattern(glob)))
    return found.select(F.concat_ws("/", F.lit(top), F.when(F.col("parent") != "", F.col("parent")), "name").alias("path"), "length", "modificationTime")


def put_objects(objects: DataFrame, root: str) -> int:
    """Write each row's text (second column) as the object that the first column names below ``root``, in tasks; returns their number.

    A retried task writes the same bytes to the same names.
    """
    open_, spark = opener(), objects.sparkSession
    base = qualified(spark, root)

    def run(batches) -> Iterator:
        import pyarrow as pa

        store, top = open_(base)
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = f"{top}/{name}"
                store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(at) as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    dealt = objects.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return dealt.mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def remove_objects(paths: DataFrame) -> int:
    """Delete the objects named in the first column, in tasks; returns how many were there. A retried task finds them gone."""
    open_ = opener()

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        for b in batches:
            n = 0
            for uri in b.column(0).to_pylist():
                store, at = open_(uri)
                if store.get_file_info(at).type == fs.FileType.File:
                    store.delete_file(at)
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return paths.mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
