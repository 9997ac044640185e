"""Which folders make up the current tables of a root: whole days, seen at once or not at all.

Data goes into a folder of its own run.  A manifest, a small file with a running number, then
names the folder of every part (a table, a source and a day).  Readers follow the manifest with
the highest number, so they see all parts of a run or none, and a run that fails before it
leaves what was there.  A manifest is put in place by a rename that does not overwrite: of two
runs that started from the same number one succeeds, and the other starts from the new one.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FOLDER = "manifest"


class Conflict(RuntimeError):
    """Another run put a manifest in place first."""


class _Files:
    """The Hadoop file system that a root lies in, as Spark itself uses it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._spark = spark
        self.folder = self._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{FOLDER}")
        conf = spark._jsc.hadoopConfiguration()
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.folder.toUri(), conf)
        self._system = self.folder.getFileSystem(conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.folder, name)

    def names(self) -> list[str]:
        if not self._system.exists(self.folder):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self.folder)]

    def text(self, name: str) -> str:
        return self._spark.read.text(self.path(name).toString(), wholetext=True).first()[0]

    def put(self, name: str, text: str) -> None:
        """Make a file with this text, whole at once; fail if it is there."""
        draft = self.path(f".draft-{uuid.uuid4().hex}")
        stream = self._system.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        kinds = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._spark.sparkContext._gateway.new_array(kinds, 1)
        none[0] = kinds.NONE
        try:
            self._context.rename(draft, self.path(name), none)
        except Py4JJavaError as error:
            self._system.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(name) from error
            raise


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number of the current manifest (0: none yet), and the folder of each part."""
    files = _Files(spark, root)
    numbers = [int(name[: -len(".json")]) for name in files.names() if name.endswith(".json") and not name.startswith(".")]
    if not numbers:
        return 0, {}
    return max(numbers), json.loads(files.text(f"{max(numbers):012d}.json"))


def commit(spark: SparkSession, root: str, number: int, parts: dict[str, str]) -> int:
    """Make these the current parts, if `number` is still the current manifest; else `Conflict`."""
    _Files(spark, root).put(f"{number + 1:012d}.json", json.dumps(parts, indent=0, sort_keys=True))
    return number + 1


def change(spark: SparkSession, root: str, new: dict[str, str], replaced: tuple[str, ...]) -> int:
    """Add parts, and drop those that begin with one of `replaced`, whatever others do meanwhile."""
    while True:
        number, parts = current(spark, root)
        kept = {part: folder for part, folder in parts.items() if not part.startswith(replaced)} if replaced else parts
        try:
            return commit(spark, root, number, {**kept, **new})
        except Conflict:
            continue


def write_parts(rows: DataFrame, root: str, table: str, by: list[str]) -> dict[str, str]:
    """Write rows into a folder of their own; the parts of `table` that got rows, and their folders.

    Parts are named `table/value/value/`.  Nothing is current until `change` names it.
    """
    spark = rows.sparkSession
    folder = f"data/{table}-{uuid.uuid4().hex}"
    copies = {f"part_{name}": F.col(name).cast("string") for name in by}
    rows.withColumns(copies).write.partitionBy(*copies).parquet(f"{root.rstrip('/')}/{folder}")
    written = spark.read.schema(f"n int, {', '.join(f'{c} string' for c in copies)}").parquet(f"{root.rstrip('/')}/{folder}")
    found = written.select(*copies).distinct().collect()  # names of folders, not rows
    return {
        "/".join([table, *row]) + "/": "/".join([folder, *(f"{c}={v}" for c, v in zip(copies, row))])
        for row in map(tuple, found)
    }


def read_folders(spark: SparkSession, root: str, parts: dict[str, str], schema: StructType) -> DataFrame:
    """The rows of parts by their folders, whether they are current or not."""
    folders = [f"{root.rstrip('/')}/{folder}" for _, folder in sorted(parts.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_parts(spark: SparkSession, root: str, table: str, schema: StructType, prefix: str = "") -> DataFrame:
    """The rows of a table's current parts whose names go on with `prefix`."""
    _, parts = current(spark, root)
    return read_folders(spark, root, {p: f for p, f in parts.items() if p.startswith(f"{table}/{prefix}")}, schema)
