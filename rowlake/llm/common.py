"""What the text operators share: inputs, lineage cuts, streams of whole documents.

Every operator reads ``doc_id`` and ``text`` alone, under names of its own, so
further columns may have any name. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowlake.workspace import shared_folder

#: Rows handed to Spark at once by a task that makes many rows of one document.
EMIT_ROWS = 50_000
#: Rows of a few numbers that a file of a checkpoint holds on average, where their number is known.
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row; null text becomes empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def cut(frame: DataFrame, most: int | None = None) -> DataFrame:
    """The frame, read back from the shared checkpoint folder.

    The files survive lost executors; Spark drops them with the frame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set. A frame of
    ``most`` small rows at most is kept in as many files as these need, not in
    one per partition: on a local disk without native Hadoop each file starts
    processes, which until they have a program of their own count with all the
    memory of the executor that starts them.
    """
    if most is not None:
        frame = frame.coalesce(max(1, -(-most // FILE_ROWS)))
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def per_batch(frame: DataFrame, of: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``of`` over each Arrow batch of a partition; a None is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := of(batch)) is not None:
                yield out

    return frame.mapInArrow(run, schema)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def free(frame: DataFrame, *names: str) -> list[str]:
    """Names for columns of our own that the frame does not have, whatever it has."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def dealt(spark: SparkSession, parts: int) -> list[int]:
    """For each partition a number that Spark's hash sends to it, so that no two parts meet in one task."""
    numbers = spark.range(32 * parts).selectExpr("cast(id as int) as id", f"pmod(hash(cast(id as int)), {parts}) as part")
    out = list(range(parts))
    for r in numbers.groupBy("part").agg(F.min("id").alias("id")).collect():
        out[r.part] = r.id
    return out


#: Total order of documents: rows without an id last, rows of one id by text.
ORDER = "struct(doc_id is null as no_id, doc_id, text_key)"


def in_order(docs: DataFrame) -> DataFrame:
    """``bucket, ahead, doc_id, text_key, text``: all documents dealt by ranges of ``ORDER``, sorted within a partition.

    Each bucket ends with a copy, marked ``ahead``, of the first document of the
    next bucket (after the last: the first), so a task that reads on sees every
    document beside its successor. Texts move once. The driver gets one key per
    partition, which is where the ranges begin.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("text_key", F.md5("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("doc_id", "text_key").withColumn("k", F.expr(ORDER))
    ranges = keys.repartitionByRange(n, "k").withColumn("part", F.spark_partition_id())
    found = ranges.groupBy("part").agg(F.min("k").alias("k")).collect()
    firsts = sorted((tuple(r.k) for r in found), key=lambda k: (k[0], k[1] if not k[0] else 0, k[2])) or [(True, None, "")]
    kind = docs.schema["doc_id"].dataType
    # As values, not as text, so that ids may be of any type and hold any characters.
    begins = F.array(*[
        F.struct(F.lit(no_id).alias("no_id"), F.lit(doc_id).cast(kind).alias("doc_id"), F.lit(key).alias("text_key"))
        for no_id, doc_id, key in firsts
    ])

    def halved(a: Column, _: Column) -> Column:
        """One step of a binary search for the last range that begins at or before the row."""
        middle = F.shiftright(a["lo"] + a["hi"], 1)
        after = F.get(begins, middle) <= F.col("k")
        lo, hi = F.when(after, middle).otherwise(a["lo"]), F.when(after, a["hi"]).otherwise(middle)
        return F.when(a["hi"] - a["lo"] <= 1, a).otherwise(F.struct(lo.alias("lo"), hi.alias("hi")))

    ends = F.struct(F.lit(0).alias("lo"), F.lit(len(firsts)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(firsts).bit_length())))
    bucket = F.aggregate(steps, ends, halved, lambda a: a["lo"])
    placed = rows.withColumn("k", F.expr(ORDER)).withColumn("range", bucket)
    # Each range goes to a partition of its own, under the number that is sent there.
    numbers = F.array(*[F.lit(x) for x in dealt(spark, n)[: len(firsts)]])

    def copy(of: Column, ahead: bool) -> Column:
        return F.struct(F.get(numbers, of).alias("bucket"), F.lit(ahead).alias("ahead"))

    own = copy(F.col("range"), False)
    before = copy(F.pmod(F.col("range") - 1, F.lit(len(firsts))).cast("int"), True)
    copies = F.when(F.col("k") == F.get(begins, F.col("range")), F.array(own, before)).otherwise(F.array(own))
    spread = placed.select("doc_id", "text_key", "text", F.explode(copies).alias("b")).select("b.bucket", "b.ahead", "doc_id", "text_key", "text")
    return spread.repartition(n, "bucket").sortWithinPartitions("bucket", "ahead", F.col("doc_id").isNull(), "doc_id", "text_key")
