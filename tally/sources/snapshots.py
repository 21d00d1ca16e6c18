"""Versions of stored tables: small manifests, published whole and one after another.

A table's rows lie in folders that are written once and never changed. A
version is a manifest, one small file that names the folders that make up the
table; it is written beside its place first and gets its number only if no
other writer has taken it, so a reader sees a version whole or not at all, and
of two writers of one number the second is told. A job killed while it
writes rows leaves a folder that no manifest names. Readers keep the version
they began with until ``vacuum`` removes its folders.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """(the cluster's file system of a path, the path as that takes it)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder (none if it is absent)."""
    fs, jpath = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, text: str, path: str) -> bool:
    """Write a file whole, or return False if there is one already.

    The text goes to a file beside it first, which is then given the name: a
    rename that refuses an existing target, or a hard link on a local disk.
    The store must be able to do that in one step, as HDFS and local disks are.
    """
    jvm = spark.sparkContext._jvm
    fs, target = file_system(spark, path)
    _, draft = file_system(spark, f"{os.path.dirname(path)}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0))
                     for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            plain = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
            options[0] = plain
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, target, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)


class Versions:
    """The manifests of one table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, os.path.join(folder, "_versions")

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in names_in(self.spark, self.folder) if n[:-5].isdigit() and n.endswith(".json"))

    def _path(self, number: int) -> str:
        return os.path.join(self.folder, f"{number:010d}.json")

    def read(self, number: int) -> dict:
        return json.loads(read_text(self.spark, self._path(number)))

    def latest(self) -> tuple[int, dict | None]:
        """(number, manifest) of the newest version; (0, None) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def commit(self, number: int, manifest: dict) -> bool:
        """Publish version ``number``; False if another writer has published it."""
        return publish(self.spark, json.dumps(manifest), self._path(number))

    def remove(self, number: int) -> None:
        fs, path = file_system(self.spark, self._path(number))
        fs.delete(path, False)


class SnapshotStore:
    """Tables that are rebuilt in full: each write is a new snapshot, the old one stays readable."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _folder(self, name: str) -> str:
        return os.path.join(self.root, name)

    def versions(self, name: str) -> Versions:
        return Versions(self.spark, self._folder(name))

    def write(self, df: DataFrame, name: str) -> int:
        """Write a snapshot and make it the newest version; of writers at once the last to end is the newest."""
        folder = f"snapshot-{uuid.uuid4().hex}"
        df.write.parquet(os.path.join(self._folder(name), folder))
        versions = self.versions(name)
        while True:
            number = versions.latest()[0] + 1
            if versions.commit(number, {"folder": folder, "schema": df.schema.jsonValue()}):
                return number

    def read(self, name: str, version: int | None = None) -> DataFrame:
        versions = self.versions(name)
        manifest = versions.read(version) if version else versions.latest()[1]
        if manifest is None:
            raise FileNotFoundError(f"no snapshot of {name} in {self.root}")
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(os.path.join(self._folder(name), manifest["folder"]))

    def vacuum(self, name: str, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` versions; their readers must be done."""
        versions = self.versions(name)
        for number in versions.numbers()[:-keep]:
            folder = versions.read(number)["folder"]
            versions.remove(number)
            fs, path = file_system(self.spark, os.path.join(self._folder(name), folder))
            fs.delete(path, True)
