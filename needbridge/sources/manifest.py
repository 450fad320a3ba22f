"""What a run has published: numbered manifest files, written whole and never changed.

``<root>/_manifests/00000001.json`` and so on; the highest number is the
current state.  A new one appears by a rename that fails if its name is
taken, so readers see either the old state or the new one, and of two
writers one fails.  All access goes through the cluster's file systems, so
the root may be any path Spark can write.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class PublishConflict(RuntimeError):
    """Another run published while this one was at work."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is absent."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with its whole content at once; ``PublishConflict`` if it exists."""
    fs, jvm = _fs(spark, path), spark.sparkContext._jvm
    draft = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target = fs.makeQualified(_path(spark, path))
    none = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = none
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), target, how)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise PublishConflict(path) from error
        raise


class Manifest:
    """Published stages of one output folder: name -> path, rows, fingerprint, checks."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_manifests"
        numbers = [n for n in children(spark, self.folder) if n.endswith(".json")]
        self.number = int(numbers[-1][:-5]) if numbers else 0
        self.stages: dict[str, dict] = json.loads(
            read_text(spark, f"{self.folder}/{numbers[-1]}"))["stages"] if numbers else {}

    def current(self, name: str, fingerprint: str) -> dict | None:
        """The published stage if it was made from the same inputs and its files are there."""
        entry = self.stages.get(name)
        if entry and entry["fingerprint"] == fingerprint and exists(self.spark, f"{entry['path']}/_SUCCESS"):
            return entry
        return None

    def publish(self, entries: Mapping[str, dict], run_id: str) -> None:
        """Switch to a state with ``entries`` added or replaced."""
        stages = {**self.stages, **entries}
        text = json.dumps({"run_id": run_id, "stages": stages}, indent=1, sort_keys=True)
        write_new_text(self.spark, f"{self.folder}/{self.number + 1:08d}.json", text)
        self.number, self.stages = self.number + 1, stages


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def input_fingerprint(df: DataFrame) -> str:
    """Digest of a source's schema and of the path, size and time of each file it reads.

    A source that reads no files is never the same twice.
    """
    files = sorted(df.inputFiles())
    if not files:
        return uuid.uuid4().hex
    spark = df.sparkSession
    status = [_fs(spark, f).getFileStatus(_path(spark, f)) for f in files]
    return digest(df.schema.json(), [(f, s.getLen(), s.getModificationTime()) for f, s in zip(files, status)])
