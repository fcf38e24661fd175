"""Tables read by snapshot (K2, K7, T2): a load is seen whole, and only once it is done.

Every load writes a folder of its own, ``data/<load>/<partition>``, which nothing refers to yet.  A snapshot
is a small list of (partition, load) that together make the table; it is written last, as version
n + 1, by moving a finished file to a name that must not exist.  So

* a reader takes one version and reads its folders, whatever is loaded meanwhile;
* a load that dies leaves folders without a mention, and running it again under its name replaces them;
* a load that is in the snapshot already is not added again;
* of two loads that end together, one finds its version taken and adds itself to that one;
* what an earlier version held can be read until ``vacuum`` deletes it.

The list holds one entry per partition and load still read, not per file or row, and the names of all loads.
A replacing load takes the entries of its partitions out.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL = "__HIVE_DEFAULT_PARTITION__"


class _Folder:
    """A folder through Hadoop's file system, wherever it lies."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop, self.path = spark._jvm.org.apache.hadoop.fs, path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(name))] if self.fs.exists(self.at(name)) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a whole file under a name that nobody has; whether it was this call that did."""
        staged = self.at(f"_staged/{uuid.uuid4().hex}")
        stream = self.fs.create(staged)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self.at(name)
        self.fs.mkdirs(target.getParent())
        files = self._hadoop.FileContext.getFileContext(target.toUri(), self.fs.getConf())
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:  # fails where the name is taken
            files.rename(files.makeQualified(staged), files.makeQualified(target), options)
        except Exception as refused:
            self.fs.delete(staged, False)
            if "FileAlreadyExists" not in str(refused):
                raise
            return False
        return True


def versions(spark: SparkSession, table: str) -> list[int]:
    """The versions that can be read, oldest first."""
    return sorted(int(n.removesuffix(".json")) for n in _Folder(spark, table).names("snapshots"))


def _entries(folder: _Folder, version: int) -> dict:
    if not version:
        return {"loads": [], "parts": [], "schema": None}
    return json.loads(folder.text(f"snapshots/{version}.json"))


def commit(rows: DataFrame, table: str, load: str, key: str, replace: bool = False,
           replaced: list[str] | None = None) -> int:
    """Add ``rows`` to the table as the load named ``load``; the version that has it.

    ``replace``: partitions (values of ``key``) that are in ``rows`` lose what was loaded before; ``replaced``
    names partitions that do, whether or not they are in ``rows``.  Without both the load is an addition.
    A load known by its name is not written again.
    """
    spark = rows.sparkSession
    folder = _Folder(spark, table)
    known = versions(spark, table)
    if known and load in _entries(folder, known[-1])["loads"]:  # a load stays named in all later versions
        return next(v for v in known if load in _entries(folder, v)["loads"])
    path = f"{folder.path}/data/{load}"
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(key).parquet(path)
    own = [_value(n) for n in folder.names(f"data/{load}") if "=" in n]
    gone = set(replaced or ()) | (set(own) if replace else set())
    while True:
        version = max(versions(spark, table), default=0)
        last = _entries(folder, version)
        if load in last["loads"]:
            return version
        parts = [p for p in last["parts"] if p[0] not in gone] + [[value, load] for value in sorted(own)]
        text = json.dumps({"key": key, "loads": [*last["loads"], load], "parts": parts, "schema": rows.schema.jsonValue()})
        if folder.put_new(f"snapshots/{version + 1}.json", text):
            return version + 1


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (the last one): exactly its folders, read once.

    The column ``key`` comes from the folders, as text.  A table without loads is an error.
    """
    folder = _Folder(spark, table)
    known = versions(spark, table)
    if not known or version is not None and version not in known:
        raise ValueError(f"{table} has no version {version if version is not None else ''}")
    found = _entries(folder, version or known[-1])
    schema, key = T.StructType.fromJson(found["schema"]), found["key"]
    used = {(value, load) for value, load in found["parts"]}
    paths = [f"{folder.path}/data/{load}/{n}" for load in sorted({load for _, load in used})
             for n in folder.names(f"data/{load}") if (_value(n), load) in used]
    if not paths:
        return spark.createDataFrame([], schema)
    plain = T.StructType([f for f in schema.fields if f.name != key])
    rows = spark.read.schema(plain).parquet(*map(_escaped, paths))
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"/{key}=([^/]*)/[^/]*$", 1)
    value = F.nullif(_decoded(_decoded(name)), F.lit(_NULL))  # files are named by URI, and the folder by an escaped value
    return rows.withColumn(key, value).select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def _value(name: str) -> str | None:
    """The value of a partition by its folder's name; None where it is no partition."""
    return unquote(name.split("=", 1)[1]) if "=" in name else None


def _decoded(name: Column) -> Column:
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _escaped(path: str) -> str:
    """Folder names are names here, not patterns."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def vacuum(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Forget all but the last ``keep`` versions and delete the partitions that none of these reads; their folders.

    To be run when no load is at work: the folders of a load that is not done yet are not in any version.
    """
    folder = _Folder(spark, table)
    known = versions(spark, table)
    used = {(value, load) for v in known[-keep:] for value, load in _entries(folder, v)["parts"]}
    for v in known[:-keep]:
        folder.fs.delete(folder.at(f"snapshots/{v}.json"), False)
    gone = []
    for load in folder.names("data"):
        for name in folder.names(f"data/{load}"):
            if "=" in name and (_value(name), load) not in used:
                folder.fs.delete(folder.at(f"data/{load}/{name}"), True)
                gone.append(f"{load}/{name}")
    return sorted(gone)
