"""Path layout of the zones, and the few file-system calls that Spark's reader lacks."""

from __future__ import annotations

from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Layout of a zone and format of a batch id.
DATA_DIR = "data"
MANIFEST_DIR = "manifest"
LOG_DIR = "logs"
REFUSED_DIR = "refused"
WATERMARK_DIR = "watermarks"
KEY_DIR = "keys"
BATCH_FORMAT = "%Y%m%d_%H%M%S"
LOG_FORMAT = "%Y-%m-%d_%H-%M-%S"


def batch_id(at: datetime) -> str:
    """Zero-padded, so that batch ids sort by time."""
    return at.strftime(BATCH_FORMAT)


def snapshot_key(table: str, batch: str, extension: str = "") -> str:
    return f"{DATA_DIR}/{batch}/{table}{extension}"


def snapshot_path(zone: str, batch: str, table: str) -> str:
    return f"{zone.rstrip('/')}/{snapshot_key(table, batch)}"


def manifest_path(zone: str, batch: str = "*") -> str:
    return f"{zone.rstrip('/')}/{MANIFEST_DIR}/{batch}"


def refusal_path(zone: str, batch: str = "*") -> str:
    return f"{zone.rstrip('/')}/{REFUSED_DIR}/{batch}"


def watermark_path(zone: str, batch: str) -> str:
    return f"{zone.rstrip('/')}/{WATERMARK_DIR}/{batch}"


def key_path(zone: str, table: str, batch: str) -> str:
    return f"{zone.rstrip('/')}/{KEY_DIR}/{table}/{batch}"


def log_path(zone: str, at: datetime) -> str:
    return f"{zone.rstrip('/')}/{LOG_DIR}/{at.strftime(LOG_FORMAT)}.log"


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    fs, target = _hadoop(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(target)] if fs.exists(target) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that must not be there yet; whether it was this call that did.

    Of several callers at once, one does. The local file system is asked by its own exclusive call, as Spark's handle
    to it looks first and writes then; others create exclusively as their own semantics allow.
    """
    fs, target = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    jvm = spark._jvm
    try:
        if fs.getScheme() == "file":
            local = jvm.java.io.File(target.toUri().getPath()).toPath()
            modes = jvm.java.util.EnumSet.of(
                jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
            )
            out = jvm.java.nio.channels.Channels.newOutputStream(
                jvm.java.nio.channels.FileChannel.open(
                    local, modes, spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
                )
            )
        else:
            out = fs.create(target, False)
    except Py4JJavaError as refused:
        if "FileAlreadyExists" in refused.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.mkdirs(target)


def discard(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)
