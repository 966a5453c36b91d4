"""Versioned manifests: several folders change at once, or not at all (SNK-1, SNK-2).

A root (a landing base, a warehouse) may have a folder ``_manifest`` with versions ``v000000000001``, ...
A version is a Parquet table (folder, file): the files that count, for each folder that is
managed; a managed folder without files has one row with a null file. Data files are written first, where they belong. Then the whole
next version is written to a temporary folder and renamed to its name, which fails if that version exists. That rename is the commit:
readers that resolve the manifest (``current``, ``stray``) see all of a change, over any
number of folders, or nothing of it, whenever the writer is lost. Files of a lost writer are never in a version; ``vacuum`` deletes
them and files that a later version dropped.

The rename has to be atomic and to fail on an existing name, as on HDFS and local file systems. Of two writers that
start from one version the second finds the name taken and commits on top of the other's version, unless they changed one folder.
Names stay in tables; only a version's number comes to the driver. Folders that no version names are read as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import qualified, remove_path
from ..sources.objects import list_folders, remove_objects

FOLDER = "_manifest"
ENTRIES = "folder string, file string"
KEPT = 20
#: The entries of marks, beside those of folders.
MARKS = "_marks"


class Conflict(RuntimeError):
    """The next version is there already."""


def _versions(spark: SparkSession, root: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{FOLDER}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path))      # at most KEPT versions and those of writers at work
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())


def version(spark: SparkSession, root: str) -> int:
    """The committed version; 0 without any."""
    return (_versions(spark, root) or [0])[-1]


def _path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/v{number:012d}"


def entries(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """(folder, file) of a version, the committed one by default."""
    number = version(spark, root) if number is None else number
    return spark.read.schema(ENTRIES).parquet(_path(root, number)) if number else spark.createDataFrame([], ENTRIES)


def managed(spark: SparkSession, root: str, folder: str) -> bool:
    return version(spark, root) > 0 and not entries(spark, root).where(F.col("folder") == folder).isEmpty()


def marked(spark: SparkSession, root: str, mark: str) -> bool:
    """Whether a change with this mark has been committed."""
    return version(spark, root) > 0 and not entries(spark, root).where((F.col("folder") == MARKS) & (F.col("file") == mark)).isEmpty()


def _listed(spark: SparkSession, root: str, folders: DataFrame) -> DataFrame:
    """(folder, file) of what lies directly in the folders (first column), listed in tasks."""
    found = list_folders(folders, root)
    return found.where("NOT is_folder").select(F.col("parent").alias("folder"), F.col("name").alias("file"))


def current(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """(file) of a folder's files that count: the manifest's, or all that lie there if no version names the folder."""
    if managed(spark, root, folder):
        return entries(spark, root).where((F.col("folder") == folder) & F.col("file").isNotNull()).select("file")
    return _listed(spark, root, spark.createDataFrame([(folder,)], "folder string")).select("file")


def stray(spark: SparkSession, root: str, below: str = "") -> DataFrame:
    """(folder, file) of files in managed folders under ``below`` that don't count: of a lost writer, or dropped by a version."""
    known = entries(spark, root).where(F.col("folder").startswith(below) & (F.col("folder") != MARKS))
    return _listed(spark, root, known.select("folder").distinct()).join(known, ["folder", "file"], "left_anti")


def _write(spark: SparkSession, root: str, number: int, rows: DataFrame) -> None:
    """Commit ``rows`` as that version, if it isn't there yet."""
    temp = f"{root.rstrip('/')}/{FOLDER}/_new-{uuid.uuid4().hex}"
    rows.select("folder", "file").write.parquet(temp)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    source, target = fs.Path(qualified(spark, temp)), fs.Path(qualified(spark, _path(root, number)))
    context = fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, gateway.new_array(getattr(fs, "Options$Rename"), 0))
    except Py4JJavaError as e:
        remove_path(spark, temp)
        if "Exist" in e.java_exception.getClass().getName():
            raise Conflict(f"version {number} of {root} is there already") from e
        raise


class Change:
    """A change of some folders of a root.

    ``Change(spark, root, folders)`` first makes the folders managed as they are, if they aren't yet. Then write
    new files into them, name those to ``drop``, and ``commit``. Until then, and if it never comes, readers see the old state.
    Changes of different folders don't disturb each other; of two changes of one folder the later to commit gets ``Conflict``.
    """

    def __init__(self, spark: SparkSession, root: str, folders: Iterable[str]):
        self.spark, self.root = spark, root
        self.names = spark.createDataFrame([(f,) for f in sorted(set(folders))], "folder string")
        self.dropped: list[DataFrame] = []
        self.mine_kept = True
        known = self._retried(self._adopt)
        # What lies there now, counted or not: anything else at the commit was written by this change.
        self._scratch = f"{root.rstrip('/')}/{FOLDER}/_before-{uuid.uuid4().hex}"
        lies = _listed(spark, root, self.names.repartition("folder")).withColumn("counts", F.lit(False))
        lies.unionByName(known.join(self.names, "folder").withColumn("counts", F.lit(True))).write.parquet(self._scratch)
        before = spark.read.schema(ENTRIES + ", counts boolean").parquet(self._scratch)
        self.before, self.mine = before.where("NOT counts").drop("counts"), before.where("counts").drop("counts")

    def _retried(self, step):
        while True:
            try:
                return step(version(self.spark, self.root))
            except Conflict:
                continue        # another folder's change came first: take its version into account

    def _adopt(self, base: int) -> DataFrame:
        known = entries(self.spark, self.root, base)
        new = self.names.join(known, "folder", "left_anti") if base else self.names
        if base and new.isEmpty():
            self.base = base
            return known
        lies = new.join(_listed(self.spark, self.root, new), "folder", "left").select("folder", "file")
        _write(self.spark, self.root, base + 1, known.unionByName(lies))
        self.base = base + 1
        return entries(self.spark, self.root, self.base)

    def drop(self, folder: str, files: DataFrame) -> None:
        """Files (names in the first column) of a folder that the next version no longer counts."""
        self.dropped.append(files.select(F.lit(folder).alias("folder"), F.col(files.columns[0]).alias("file")))

    def drop_all(self) -> None:
        """The next version counts only what this change wrote into its folders."""
        self.mine_kept = False

    def abandon(self) -> None:
        """End without a commit."""
        remove_path(self.spark, self._scratch)

    def commit(self, mark: str | None = None) -> int:
        """Make the files written since the beginning count, and the dropped ones no longer; returns the version.

        ``mark`` is remembered with it (``marked``), so that a writer that is retried knows that it is done.
        """
        spark = self.spark
        added = _listed(spark, self.root, self.names.repartition("folder")).join(self.before, ["folder", "file"], "left_anti")
        kept = self.mine.where("file IS NOT NULL" if self.mine_kept else "false")
        for gone in self.dropped:
            kept = kept.join(gone, ["folder", "file"], "left_anti")
        after = self.names.join(kept.unionByName(added), "folder", "left").select("folder", "file")

        def step(base: int) -> int:
            known = entries(spark, self.root, base)
            seen = known.join(self.names, "folder")
            if base != self.base and (not seen.exceptAll(self.mine).isEmpty() or not self.mine.exceptAll(seen).isEmpty()):
                raise RuntimeError(f"a folder of this change was changed by another writer: {self.root}")
            others = known.join(self.names, "folder", "left_anti")
            if mark is not None:
                others = others.unionByName(spark.createDataFrame([(MARKS, mark)], ENTRIES))
            _write(spark, self.root, base + 1, others.unionByName(after))
            return base + 1

        number = self._retried(step)
        remove_path(spark, self._scratch)
        for old in _versions(spark, self.root)[:-KEPT]:
            remove_path(spark, _path(self.root, old))
        return number


def refresh(spark: SparkSession, root: str, below: str) -> None:
    """Count what lies in the managed folders under ``below``, after a plain overwrite of them."""
    while version(spark, root):
        base = version(spark, root)
        known = entries(spark, root, base)
        own = known.where(F.col("folder").startswith(below) & (F.col("folder") != MARKS)).select("folder").distinct()
        if own.isEmpty():
            return
        lies = own.join(_listed(spark, root, own), "folder", "left").select("folder", "file")
        try:
            return _write(spark, root, base + 1, known.join(own, "folder", "left_anti").unionByName(lies))
        except Conflict:
            continue


def vacuum(spark: SparkSession, root: str, folders: Iterable[str]) -> int:
    """Delete, in tasks, the files in these managed folders that don't count; returns their number. Run it when no writer is at work there."""
    names = spark.createDataFrame([(f,) for f in folders], "folder string")
    known = entries(spark, root).join(names, "folder")
    lies = _listed(spark, root, known.select("folder").distinct()).join(known, ["folder", "file"], "left_anti")
    return remove_objects(lies.select(F.concat_ws("/", F.lit(qualified(spark, root)), "folder", "file").alias("path")))
