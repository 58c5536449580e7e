"""Small file-system actions through the session's Hadoop ``FileSystem``.

Works for any scheme the cluster is configured for (``file:``, ``hdfs:``,
``s3a:`` ...). Used for metadata moves and tiny files only: existence
checks, the staged-directory swap, the snapshot pointer and the run-log
records. Table data never passes through here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one visible data file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.isFile(p):
        return True
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst`` (parent created); ``dst`` must not exist."""
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Replace a small text file: write a sibling, then rename over. Without
    ``overwrite`` the file must not exist yet (FileExistsError if it does)."""
    fs, p = _fs(spark, path)
    if not overwrite:
        try:
            # a local file system looks for the file and creates it in two steps
            local = fs.getUri().getScheme() == "file"
            if local:
                fs.mkdirs(p.getParent())
                if not spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile():
                    raise FileExistsError(path)
            out = fs.create(p, local)
        except Exception as err:
            raise FileExistsError(path) from err
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), "." + p.getName() + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not publish {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def plain(spark: SparkSession, file: str) -> str:
    """A file as Spark lists it (an encoded URI) as a plain path."""
    jvm = spark.sparkContext._jvm
    return str(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).toString())


def read_head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first bytes of a file's contents, decompressed as Spark would."""
    fs, p = _fs(spark, path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codec = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    stream = fs.open(p)
    try:
        return bytes((codec.createInputStream(stream) if codec is not None else stream).readNBytes(size))
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()]


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]

