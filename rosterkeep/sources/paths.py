"""Directory listing on the file system Spark itself uses, and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def entries(spark: SparkSession, path: str) -> list[tuple[str, dt.datetime]]:
    """Names in a directory with their time of change, sorted; empty if it does not exist."""
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop):
        return []
    found = ((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(hadoop))
    return sorted((name, dt.datetime.fromtimestamp(millis / 1000, dt.timezone.utc)) for name, millis in found)


def names(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _ in entries(spark, path)]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    fs.mkdirs(hadoop)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all; one that exists is an error, also where two write it at a time.

    On a local folder a finished file gets its name by a link, on HDFS by a rename, which both refuse to replace a file;
    elsewhere (object stores) a file appears when it is closed, and creating it without overwriting is left to the store.
    """
    fs, hadoop = _fs(spark, path)
    fs.mkdirs(hadoop.getParent())
    scheme = fs.getUri().getScheme()
    if scheme not in ("file", "hdfs", "viewfs", "webhdfs"):
        try:
            _create(fs, hadoop, text)
        except Py4JJavaError as error:
            raise FileExistsError(path) from error
        return
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{hadoop.getParent()}/.{hadoop.getName()}.{uuid.uuid4().hex}")
    _create(fs, part, text)
    try:
        if scheme == "file":
            jvm = spark._jvm.java.nio.file
            names = [jvm.Path.of(p.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)) for p in (hadoop, part)]
            try:
                jvm.Files.createLink(*names)
            except Py4JJavaError as error:
                raise FileExistsError(path) from error
        elif not fs.rename(part, hadoop):
            raise FileExistsError(path)
    finally:
        fs.delete(part, False)


def _create(fs, path, text: str) -> None:
    out = fs.create(path, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, hadoop = _fs(spark, path)
    opened = fs.open(hadoop)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(opened)).decode()
    finally:
        opened.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; one that is not there is no error."""
    fs, hadoop = _fs(spark, path)
    fs.delete(hadoop, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the data files of a directory that a job wrote; none while a job is still writing it."""
    fs, hadoop = _fs(spark, path)
    if fs.getFileStatus(hadoop).isFile():
        return [path]
    found = sorted(s.getPath().getName() for s in fs.listStatus(hadoop))
    return [] if "_temporary" in found else [f"{path}/{n}" for n in found if not n.startswith(("_", "."))]


def first_line(spark: SparkSession, path: str, most: int = 1 << 20) -> str:
    """The first line of a text file, compressed or not, without reading the rest."""
    fs, hadoop = _fs(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(hadoop)
    opened = fs.open(hadoop)
    try:
        stream = codec.createInputStream(opened) if codec else opened
        line = jvm.org.apache.hadoop.io.Text()
        jvm.org.apache.hadoop.util.LineReader(stream).readLine(line, most)
        return line.toString()
    finally:
        opened.close()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 if it does not exist."""
    fs, hadoop = _fs(spark, path)
    return fs.getContentSummary(hadoop).getLength() if fs.exists(hadoop) else 0


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a scratch path when the session's JVM ends."""
    fs, hadoop = _fs(spark, path)
    fs.deleteOnExit(hadoop)


class NoSharedFolder(RuntimeError):
    """A cluster whose session names no folder that all its machines share."""


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or where it is unset the warehouse.

    A warehouse on a local disk will do on one machine only; on a cluster it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        on_disk = _fs(spark, folder)[0].getUri().getScheme() == "file"
        if on_disk and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise NoSharedFolder(f"set spark.checkpoint.dir: {folder} is local to each machine of {spark.sparkContext.master}")
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path
