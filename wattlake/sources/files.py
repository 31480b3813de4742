"""Small file operations on any Hadoop-supported path; data itself goes through Spark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def join_path(*parts: str) -> str:
    first, *rest = (str(part) for part in parts)
    return "/".join([first.rstrip("/"), *(part.strip("/") for part in rest if part)])


def _open(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _open(spark, uri)
    return fs.exists(path)


def children(spark: SparkSession, uri: str) -> list[str]:
    """Names directly below a folder, without hidden ones; empty when there is no folder."""
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(name for name in names if not name.startswith(("_", ".")))


def read_text(spark: SparkSession, uri: str) -> str | None:
    fs, path = _open(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _open(spark, source)
    target_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if target_path.getParent() is not None:
        fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target}")


def delete(spark: SparkSession, uri: str) -> None:
    fs, path = _open(spark, uri)
    fs.delete(path, True)


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """Replace a small file; readers see the old text or the new one, never a part and never none.

    The new text is written aside and renamed over the old one, which Hadoop file systems do in
    one step.
    """
    fresh = f"{uri}.new"
    fs, path = _open(spark, fresh)
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    qualified, target = fs.makeQualified(path), fs.makeQualified(hadoop.Path(uri))
    hadoop.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(
        qualified, target, options
    )
