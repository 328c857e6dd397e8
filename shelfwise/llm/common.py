"""What the operators of this subpackage share: reading tables, shared storage, word splitting."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import shingles

#: The characters that part words: space and \t to \r.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: the session's checkpoint folder."""
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # without a configured folder a local master, as in tests, takes a local one
    sc.setCheckpointDir(base or f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}")
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The rows, written as Parquet to shared storage and read back: lineage is cut, losing an executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    spark.sparkContext._jvm.System.gc()  # shuffle files that nothing needs any more go at once
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path  # type: ignore[attr-defined]
    return out


def dropped(df: DataFrame) -> None:
    """Deletes what `written` wrote; only for tables that no later read needs."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.shared_path)  # type: ignore[attr-defined]
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows (doc_id, text) with doc, a long per document in the order of ids, nulls first; and whether doc is the id itself.

    It is where ids are whole numbers, none missing and none repeated. Otherwise rows of one id and one text are one document, and
    different texts of one id, or without an id, are different ones, in the order of their texts' digests.
    """
    whole = rows.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    if whole and rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").isEmpty():
        return rows.withColumn("doc", F.col("doc_id").cast("long")), True
    known = rows.withColumn("digest", F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256))
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    in_order = known.select("doc_id", "digest").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    numbers = written(in_order.select(F.col("doc_id").alias("id"), F.col("digest").alias("sha"), F.monotonically_increasing_id().alias("doc")), "numbers")
    return known.join(numbers, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("sha"))).select("doc_id", "text", "doc"), False


def release() -> None:
    """Gives memory that a task has let go back to the system: Spark keeps its Python workers, and each holds on to what its largest task took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow; when its task ends, what it took goes, also in workers that then stand idle."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            shingles.forget()
            release()

    return whole


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list] | None], schema: str, rows: int = 1000) -> DataFrame:
    """Applies `fn`, from lists by column to lists by column, to so many rows at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark_schema = _parse_datatype_string(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                if out := fn(batch.slice(k, rows).to_pydict()):
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(lean(run), spark_schema)
