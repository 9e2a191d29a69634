"""Small files and folders of a lake, on any store that Spark reaches."""

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _place(spark, path)
    return store.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder; none if it is not there."""
    store, place = _place(spark, path)
    if not store.exists(place):
        return []
    return sorted(x.getPath().getName() for x in store.listStatus(place) if x.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    store, place = _place(spark, path)
    store.delete(place, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete the folder when the session's JVM ends."""
    store, place = _place(spark, path)
    store.deleteOnExit(place)


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _place(spark, path)
    stream = store.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in a folder; none if it is not there."""
    store, place = _place(spark, path)
    if not store.exists(place):
        return []
    return sorted(x.getPath().getName() for x in store.listStatus(place) if x.isFile())


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    store, place = _place(spark, path)
    return store.getContentSummary(place).getLength() if store.exists(place) else 0


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file, whole or not at all; False if there is one already.

    Of several writers one wins, and no reader meets half a file. A local disk gives that by a
    link to a finished file, HDFS and others with atomic renames by a rename that replaces
    nothing, and object stores by a conditional upload, which S3A has from Hadoop 3.4.2 on
    (``fs.s3a.create.conditional.enabled``). On a store with neither, let one job write at a time.
    """
    store, place = _place(spark, path)
    if store.exists(place):
        return False
    jvm, scheme = spark.sparkContext._jvm, store.getUri().getScheme()
    if scheme in ("s3a", "gs", "oss"):
        return _written(store, place, text, replace=False)
    _, new = _place(spark, f"{path}.{uuid4().hex}.new")
    _written(store, new, text, replace=True)
    try:
        if scheme == "file":
            named = jvm.java.nio.file.Paths.get
            link, there = (named(x.toUri().getPath(), _none(spark)) for x in (place, new))
            jvm.java.nio.file.Files.createLink(link, there)
        else:
            options = spark.sparkContext._gateway.new_array(_renames(spark), 1)
            options[0] = _renames(spark).NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                store.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
            )
            context.rename(new, place, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    finally:
        store.delete(new, False)
    return True


def _none(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)


def _renames(spark: SparkSession):
    return getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, "Options$Rename")


def _written(store, place, text: str, replace: bool) -> bool:
    try:
        stream = store.create(place, replace)
        stream.write(bytearray(text.encode()))
        stream.close()
    except Py4JJavaError as error:
        if not replace and "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True
