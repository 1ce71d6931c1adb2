"""Files of any file system that Spark reaches (local, hdfs, s3a, ...), through Hadoop's own interface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; a path that can't be asked for raises."""
    fs, p = _open(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder."""
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place as a whole: readers see the old one or the new one."""
    fs, p = _open(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    stream = fs.create(tmp, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark._sc._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(tmp), fs.makeQualified(p), over)


def write_merged(lines: DataFrame, path: str, order: list, head: str, tail: str, first: int = 0) -> None:
    """One file of all lines in order: tasks write their parts in parallel, then the bytes are joined.

    lines has one text column with whatever separates lines in it; `first` bytes of the first line are left out, as those of a separator.
    """
    spark = lines.sparkSession
    column = lines.columns[0]
    parts = path + ".parts"
    lines.orderBy(*order).select(column).write.mode("overwrite").option("lineSep", "\n").text(parts)
    fs, p = _open(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(head.encode("utf-8")))
    skip = first
    names = sorted(s.getPath().toString() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(parts)) if s.getPath().getName().startswith("part-"))
    for n in names:
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(n))
        if skip and fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(n)).getLen() > 0:
            stream.seek(skip)
            skip = 0
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
        stream.close()
    out.write(bytearray(tail.encode("utf-8")))
    out.close()
    fs.delete(p, True)
    fs.rename(tmp, p)
    fs.delete(jvm.org.apache.hadoop.fs.Path(parts), True)
