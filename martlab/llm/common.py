"""What several operators share: tables in the shared folder, bucketed blocks, bounded bit filters, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlab.session import shared_folder

BLOCK_BYTES = 16 << 20
FILTER_BITS, MOST_BITS = 20, 25  # a filter has 2 ** 20 to 2 ** 25 bits (four megabytes)


class Scratch:
    """Parquet tables in the cluster's shared folder that cut lineage; `drop` deletes one that nothing reads any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.made = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Blocks:
    """Documents written once as a bucketed table: a group-by on `block` reads it without moving a text again.

    A document's block is a hash of its id; the number of blocks follows the bytes of all texts. Rows with equal
    ids share a block. `close` drops the table.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, *columns: Column, text: str = "text"):
        size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
        self.count = max(partitions(spark), -(-size // BLOCK_BYTES))
        self.spark, self.name = spark, f"blocks_{uuid.uuid4().hex}"
        (docs.select(self.of("doc_id"), *columns).write.option("compression", "zstd")
         .bucketBy(self.count, "block").saveAsTable(self.name))

    def of(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.count)).alias("block")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds more than `limit` bytes of text, unless a single row does."""
    texts = batch.column(column)
    size = np.zeros(len(texts) + 1, np.int64)
    size[1:] = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(size, size[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


# Bit filters: two bits for each entry among at most 2 ** MOST_BITS, so a broadcast is bounded; a full filter only lets more rows through.

def filter_positions(hashes: np.ndarray, width: int = FILTER_BITS) -> list[np.ndarray]:
    keep = np.uint64((1 << width) - 1)
    return [(hashes & keep).astype(np.int64), ((hashes >> np.uint64(width)) & keep).astype(np.int64)]


def filter_width(count: int) -> int:
    """Bits of the position in a filter for so many entries: some 16 bits an entry, within bounds."""
    return min(max(FILTER_BITS, (16 * count).bit_length()), MOST_BITS)


def build_filter(df: DataFrame, column: str, width: int = FILTER_BITS) -> np.ndarray:
    """Bits of all 64-bit hashes in a column, or-ed on the executors into words of 64 bits."""
    mask = (1 << width) - 1
    bit = F.explode(F.array(F.col(column).bitwiseAND(F.lit(mask)),
                            F.shiftrightunsigned(column, width).bitwiseAND(F.lit(mask))))
    words = (df.select(bit.alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
             .collect())
    out = np.zeros(1 << (width - 6), np.int64)
    for word, bits in words:
        out[word] = bits
    return out.view(np.uint64)


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at in filter_positions(hashes, len(bits).bit_length() + 5):
        found &= (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return found


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, label) for every id in `edges` (u, v): ids share a label when links connect them; label is the least id.

    Each round joins every node to the neighbour that ranks lowest in an order drawn anew for the round, and contracts
    the graph. Rounds are written to the shared folder.
    """
    scratch = Scratch(spark, "components")
    edges = scratch.write(edges.where("u <> v").select("u", "v").distinct())
    members = scratch.write(edges.select(F.explode(F.array("u", "v")).alias("id")).distinct()
                            .select("id", F.col("id").alias("label")))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)), F.col(c))  # noqa: E731, B023
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = scratch.write(
            both.groupBy("u").agg(F.min(rank("v")).alias("best"))
            .select("u", F.when(F.col("best") < rank("u"), F.col("best.v")).otherwise(F.col("u")).alias("p")))
        later = scratch.write(
            edges.join(parents, "u").select("v", F.col("p").alias("a"))
            .join(parents.select(F.col("u").alias("v"), "p"), "v")
            .select(F.col("a").alias("u"), F.col("p").alias("v")).where("u <> v").distinct())
        renamed = scratch.write(members.join(parents.select(F.col("u").alias("label"), "p"), "label", "left")
                                .select("id", F.coalesce("p", "label").alias("label")))
        scratch.drop(edges, members, parents)
        edges, members = later, renamed
    least = members.groupBy("label").agg(F.min("id").alias("least"))
    return scratch.write(members.join(least, "label").select("id", F.col("least").alias("label")))
