"""What the operators share: shared tables, row ids, document columns and array helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.session import shared_dir

#: The white space that separates words: space and U+0009 to U+000D, as a regular expression of Java and Python.
SPACE = r"[\x20\x09-\x0D]"


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder of the cluster and read it back.

    The next job starts from files that every executor reaches, so a lost executor costs only its running tasks.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` written in buckets by ``key``: joins on it later read the table in place, without another shuffle of it."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    return _in_buckets(df.repartition(n, key), n, key, name)


def in_buckets(df: DataFrame, key: str, name: str) -> DataFrame:
    """``dealt`` without a shuffle: each task writes its rows to the files of their buckets, so let them be few and large."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _in_buckets(df, n, key, f"{name}_{uuid.uuid4().hex}")


def _in_buckets(df: DataFrame, n: int, key: str, name: str) -> DataFrame:
    """``df`` written in ``n`` buckets by ``key``. Only the plan knows the table: its entry in the catalog is dropped at
    once, and its files stay in the shared folder."""
    spark = df.sparkSession
    written = df.write.option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}")
    written.bucketBy(n, key).sortBy(key).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


#: Bits of a row's number that tell its place in the task that wrote it; those above tell the task.
PLACE_BITS = 33


def numbered_files(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written with a number for each row, and the name of that column (see ``kept_rows``).

    Rows stay in the task that read them: each task writes one bucket file, so nothing is shuffled.
    """
    row = free_name(df, "row")
    rows = df.withColumn(row, F.monotonically_increasing_id()).withColumn(f"{row}_task", F.shiftright(row, PLACE_BITS))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _in_buckets(rows, n, f"{row}_task", f"{name}_{uuid.uuid4().hex}"), row


def kept_rows(written: DataFrame, row: str, stay: DataFrame) -> DataFrame:
    """The rows of ``numbered_files`` whose numbers are in ``stay`` (column row), with the columns that they came with.

    ``stay`` becomes a map of bits for each task that wrote rows, and meets the files in place: only these bits move.
    """
    task = f"{row}_task"
    place = F.col("row").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    bits = stay.select(F.shiftright("row", PLACE_BITS).alias("t"), place.alias("p"))
    bits = bits.groupBy("t", F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b"))
    # a bit for each row of one task
    bits = bits.groupBy(F.col("t").alias(task)).agg(F.map_from_entries(F.collect_list(F.struct("k", "b"))).alias(f"{task}_bits"))
    own = F.col(row).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    position = F.bitmap_bit_position(own)
    octet = F.try_element_at(f"{task}_bits", F.bitmap_bucket_number(own))
    octet = F.conv(F.hex(F.substring(octet, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.bit_get(octet, (position % 8).cast("int")) == 1
    return written.join(bits, task).filter(is_set).drop(row, task, f"{task}_bits")


def remove(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in staged:
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` has the name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def numbered(docs: DataFrame, row: str = "row") -> DataFrame:
    """``docs`` with a number for each row, unique but not gapless.

    Stage the result before it is read twice: the numbers hold for one reading.
    """
    return docs.withColumn(row, F.monotonically_increasing_id())


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    """The texts of a batch one after another, null as empty."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array from its values in a row and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
