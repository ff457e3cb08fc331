"""Files and folders beside the data, through Hadoop's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """File system and qualified form of a path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(hadoop_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = located(spark, path)
    return files.exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ran to its end."""
    return path_exists(spark, f"{path}/_SUCCESS")


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table once nothing reads it any more."""
    files, place = located(spark, path)
    files.delete(place, True)


def require_new_path(spark: SparkSession, current: str, target: str) -> None:
    """Refuse to write a new table version over the one it is computed from.

    Qualified paths are compared, so ``file:/x`` and ``/x/`` are the same.
    """
    if located(spark, current)[1].equals(located(spark, target)[1]):
        raise ValueError(f"cannot overwrite the table being read: {target}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none when there is no such folder."""
    files, place = located(spark, path)
    if not files.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(place))


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file; without ``replace`` tells False where one is there already."""
    files, place = located(spark, path)
    if not replace and files.exists(place):
        return False
    out = files.create(place, replace)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None when there is none."""
    files, place = located(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` where ``path`` is; the old one goes only after that.

    A run that dies in between leaves the old folder beside it as ``<path>.old``.
    """
    files, place = located(spark, path)
    before = located(spark, f"{path}.old")[1]
    files.delete(before, True)
    if files.exists(place) and not files.rename(place, before):
        raise OSError(f"cannot rename {path}")
    files.mkdirs(place.getParent())
    if not files.rename(located(spark, new)[1], place):
        raise OSError(f"cannot rename {new} to {path}")
    files.delete(before, True)
