"""Files that bear names of one's own: tasks write them, or Spark writes them under names that it makes up, and they are moved."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Spark calls the directory of a value that is NULL or empty.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Characters that Spark writes as %XX in the names of directories.
_ESCAPED = "[\\x01-\\x1F\"#%'*/:=?\\\\\\x7F{\\[\\]^]"


def directory_value(value: Column) -> Column:
    """A value as the name of its file or directory."""
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(NO_VALUE))


def escaped(value: Column) -> Column:
    """A value as Spark escapes it in the name of a directory ``key=value``."""
    each = F.split(directory_value(value), "")
    return F.array_join(F.transform(each, lambda c: F.when(c.rlike(_ESCAPED), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)), "")


def write_files(rows: DataFrame, path: str, file: Column, text: Column, overwrite: bool = False) -> None:
    """One text file for each name under ``path``, with a line for each of its rows; a NULL text is an empty line.

    Tasks write and name the files themselves, each first under a name of its own. The driver sees one number for each task. Rows
    of one file meet in one task, which holds a row at a time; lines of a file are in the order of their text.
    """
    spark = rows.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if overwrite:
        store.delete(root, True)
    store.mkdirs(root)
    target = store.makeQualified(root).toString()

    # A function within: it goes to the executors with its values, which need no module of this package.
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(target)
        made, name, sink, count = set(), None, None, 0
        # Names that begin with "_" are not read.
        staged = f"{folder}/_staged-{uuid.uuid4().hex}"

        def close() -> None:
            if sink is not None:
                sink.close()
                system.move(staged, f"{folder}/{name}")

        for batch in batches:
            for own, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own != name:
                    close()
                    name, count = own, count + 1
                    parent = f"{folder}/{own}".rpartition("/")[0]
                    if parent not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    sink = system.open_output_stream(staged)
                sink.write(line.as_buffer() if line.is_valid else b"")
                sink.write(b"\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    named = rows.select(file.alias("file"), text.cast("string").alias("text"))
    ordered = named.repartition("file").sortWithinPartitions("file", "text")
    ordered.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


def move_parts(spark: SparkSession, staged: str, target: str, named: Callable[[dict[str, str], int], str]) -> None:
    """Move the files written under ``staged`` to what ``named`` makes of their partition values and number.

    Files with equal values are numbered from 0. Nothing is copied or read; the driver sees one name for each file.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(staged)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    listed, found = store.listFiles(root, True), []
    while listed.hasNext():
        path = listed.next().getPath()
        if path.getName().startswith("part-"):
            found.append(path.toString())
    numbers: dict[tuple, int] = {}
    made: set[str] = set()
    for path in sorted(found):
        values = {key: unquote(value) for key, _, value in (part.partition("=") for part in path.split("/")) if value}
        number = numbers[tuple(values.items())] = numbers.get(tuple(values.items()), -1) + 1
        to = hadoop.Path(f"{target}/{named(values, number)}")
        folder = to.getParent()
        if folder.toString() not in made:
            store.mkdirs(folder)
            made.add(folder.toString())
        if not store.rename(hadoop.Path(path), to):
            raise OSError(f"{path} can't be moved to {to.toString()}")
    store.delete(root, True)
