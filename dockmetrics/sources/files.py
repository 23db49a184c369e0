"""Listing and removing paths through the file system Spark itself uses.

These calls go through the JVM bridge of a classic session.
"""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; none if its folder does not exist."""
    fs, target = _resolve(spark, pattern)
    found = fs.globStatus(target)
    return [status.getPath().toString() for status in found] if found else []


def modified(spark: SparkSession, path: str) -> float:
    """When a file was last written, in epoch seconds."""
    fs, target = _resolve(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def set_modified(spark: SparkSession, path: str, seconds: float) -> None:
    """Give a file another time of writing."""
    fs, target = _resolve(spark, path)
    fs.setTimes(target, int(seconds * 1000), -1)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def read_small(spark: SparkSession, path: str) -> str:
    """Content of a marker file."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, content: str) -> None:
    """Create or replace a marker file."""
    fs, target = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.writeUTF(content)
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if it does not exist."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A whole file that is known to be of modest size."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Create or replace a file. Readers see the old one, none, or the whole new one:
    it is written under a hidden name and then renamed."""
    fs, target = _resolve(spark, path)
    folder, name = path.rsplit("/", 1)
    _, hidden = _resolve(spark, f"{folder}/.{name}.{uuid4().hex}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    if not fs.rename(hidden, target):  # not every store replaces what is there
        fs.delete(target, False)
        fs.rename(hidden, target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file to a name that is not taken; one step where the store allows."""
    fs, new = _resolve(spark, target)
    _, old = _resolve(spark, source)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not rename {source} to {target}")


def remove_file(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, False)


def files_below(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """All files below a folder whose names end in ``suffix``, relative to it."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    root = fs.getFileStatus(target).getPath().toString().rstrip("/") + "/"
    found, listed = [], fs.listFiles(target, True)
    while listed.hasNext():
        name = listed.next().getPath().toString()
        if name.endswith(suffix):
            found.append(name.removeprefix(root))
    return sorted(found)


def create_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create a file whole, unless it exists; whether it was this call that did. As atomic
    as the store's rename without overwriting."""
    fs, target = _resolve(spark, path)
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid4().hex}"
    write_bytes(spark, hidden, content)
    _, source = _resolve(spark, hidden)
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    try:
        context.rename(source, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass()):
            raise
        fs.delete(source, False)
        return False
    return True
