"""Reading back result files written per micro-batch (SRC6, SRC7, SET2, PRJ14)."""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.sources.tables import empty_table
from tarmac.streaming.runner import state_slots

#: Bytes of result files for each task that brings their rows together by key, on average: a split of a scan.
BYTES_PER_TASK = 128 << 20


def path_has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one data file (recursively)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def result_tasks(spark: SparkSession, path: str, bytes_per_task: int = BYTES_PER_TASK) -> int:
    """Tasks for a job that brings the rows of the result files below ``path`` together by key.

    They follow the files' size, not the session's shuffle width, so that a task holds no more of a larger
    result; the cluster's task slots at least.
    """
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(hpath).getLength() if fs.exists(hpath) else 0
    return max(state_slots(spark), -(-size // bytes_per_task))


def _first_split_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the split that starts each text file below ``path``, without blank ones."""
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
            .where("at = 0 AND trim(value) <> ''"))


def first_line_marks(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and the hashes ``h`` and ``c`` of its first line, for each text file below ``path`` that has one.

    Numbers aggregate by hash, a row a file; the lines themselves would all be sorted first.
    """
    # The split that starts a file has its first line first, and only that split is left.
    return _first_split_lines(spark, path).groupBy("file").agg(
        F.first(F.xxhash64("value")).alias("h"), F.first(F.crc32("value")).alias("c"))


def headers_of(spark: SparkSession, path: str, sep: str = ",") -> list[tuple[list[str], list[str]]]:
    """The different headers of the CSV files below ``path``, each with its files in order.

    Files are grouped by the hashes of their first lines, found by one distributed scan of the text; the line
    itself is read from one file of a group. What reaches the driver is a path a file, as a listing of the
    folder has, and a line a group.
    """
    groups: dict[tuple[int, int], list[str]] = {}
    for r in first_line_marks(spark, path).orderBy("file").toLocalIterator():
        groups.setdefault((r.h, r.c), []).append(unquote(r.file))  # a path again, not a URI
    found = sorted((_first_split_lines(spark, files[0]).first()["value"], files) for files in groups.values())
    return [(next(csv.reader([header], delimiter=sep), []), files) for header, files in found]


def read_results(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                 key_as_string: str | None = None) -> DataFrame:
    """Union of every result file below ``path`` (any depth, e.g. ``batch_<id>``
    folders), read with a declared schema so window bounds come back as
    timestamps. No files yields an empty frame with that schema.

    Columns are bound by name, also across CSV files with different headers: files of one
    header are read together, the groups are united by name, a column that a file lacks is NULL
    and one that the schema does not name is left out. Files without any line have no rows.
    """
    if not path_has_files(spark, path):
        return empty_table(spark, schema)
    if fmt == "csv":
        df = _union_by_name(spark, path, schema)
    else:
        df = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", True).load(path)
    if key_as_string:
        df = df.withColumn(key_as_string, F.col(key_as_string).cast("string"))
    return df


def _union_by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    out = empty_table(spark, schema)
    for header, files in headers_of(spark, path):
        # In the order of this header; what the schema does not name is read as text, under a name of its own, and dropped.
        bound = T.StructType([T.StructField(c if c in types else f"_unnamed_{i}", types.get(c, T.StringType()))
                              for i, c in enumerate(header)])
        part = spark.read.schema(bound).option("header", True).csv(files)
        out = out.unionByName(part.select(*(c for c in header if c in types)), allowMissingColumns=True)
    return out
