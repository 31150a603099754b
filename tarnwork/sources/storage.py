"""Small metadata calls on whatever file system a path belongs to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF = "spark.checkpoint.dir"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory; empty when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced as a whole."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a directory with what it holds."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file, decompressed if its suffix names a codec. Reads
    one buffer of the file."""
    jvm = spark._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark._jsc.hadoopConfiguration()
        )
        codec = codecs.getCodec(p)
        data = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session. Only a local session that names none, as
    in tests, gets a temporary folder; on a cluster executors would not share it."""
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {_CONF} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tarnwork-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, empty place under the shared folder."""
    return f"{shared_dir(spark)}/tarnwork/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system. Without one it could mean another place to code that
    opens files by itself."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()
