"""The hourly rollup kept up to date incrementally, as additive deltas.

Counts add up, so a refresh needs no state and no watermark: every micro-batch of new
fact files is counted by itself and written to the ``batch_id`` partition of the rollup
table (dynamic partition overwrite, so a retried batch replaces its own rows).
``read_rollup`` sums the deltas; ``fold_rollup`` folds them into a base, ``compact_rollup`` into a new folder. Late rows
count whenever they arrive, and rows without ``posted_at`` form the NULL bucket, as in
the batch rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kwpulse.operators.growth import hourly_counts
from kwpulse.schemas import HOURLY
from kwpulse.sources.files import facts_schema, read_facts
from kwpulse.sources.runs import ATTEMPT, LEDGER, commits

GROUP = ["bucket", "keyword", "region", "category"]


def stream_hourly_counts(spark: SparkSession, facts_path: str, sink_path: str,
                         checkpoint_path: str, max_files_per_trigger: int | None = None) -> None:
    """Run one availableNow refresh (blocks until done): count the fact files that are new
    since the checkpoint. Only they are read, whatever hours their rows belong to."""
    src = spark.readStream.schema(read_facts(spark, facts_path).schema)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_delta(hourly_counts(batch), sink_path, batch_id)

    (src.parquet(facts_path).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True).start().awaitTermination())


def _write_delta(counts: DataFrame, sink_path: str, batch_id: int) -> None:
    (counts.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("batch_id").parquet(sink_path))


def _deltas(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.schema(T.StructType(HOURLY.fields + [T.StructField("batch_id", T.LongType())])).parquet(sink_path)


def read_rollup(spark: SparkSession, sink_path: str) -> DataFrame:
    """Mentions per (bucket, keyword, region, category): the sum of the deltas."""
    return _deltas(spark, sink_path).groupBy(*GROUP).agg(F.sum("mentions").alias("mentions")).where("mentions <> 0")


def stream_committed_counts(spark: SparkSession, facts_path: str, ledger: str, sink_path: str, checkpoint_path: str) -> None:
    """Run one availableNow refresh over the ledger of runs (``sources.runs``): the stream's rows are commits, and a
    batch counts the facts of the attempts that its commits made visible, less those of the attempts
    they replaced. So facts of dead attempts never count, and a repeated run counts once."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        last = Window.partitionBy("run_id").orderBy("committed_at")
        here = commits(spark, ledger).join(batch.select("run_id").distinct(), "run_id", "left_semi").withColumn(
            "prior", F.lag(ATTEMPT).over(last))
        new = here.join(batch.select(F.col(ATTEMPT).alias("own")), F.col(ATTEMPT) == F.col("own"), "left_semi")
        signs = new.select(ATTEMPT, F.lit(1).alias("sign")).unionByName(
            new.where("prior IS NOT NULL").select(F.col("prior").alias(ATTEMPT), F.lit(-1).alias("sign")))
        facts = spark.read.schema(facts_schema(ATTEMPT)).parquet(facts_path)
        deltas = [hourly_counts(facts.join(signs.where(F.col("sign") == s), ATTEMPT, "left_semi")).withColumn(
            "mentions", F.col("mentions") * s) for s in (1, -1)]
        _write_delta(deltas[0].unionByName(deltas[1]), sink_path, batch_id)

    (spark.readStream.schema(LEDGER).json(ledger).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start().awaitTermination())


POINTER = T.StructType([T.StructField("folded", T.LongType())])


def _folded(spark: SparkSession, sink_path: str) -> int | None:
    """The batch id up to which the current base holds the deltas, None before the first fold."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sink_path}_pointer")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(POINTER).json(f"{sink_path}_pointer").agg(F.max("folded")).first()[0]


def _base(spark: SparkSession, sink_path: str, upto: int) -> DataFrame:
    schema = T.StructType(HOURLY.fields + [T.StructField("base", T.LongType())])
    return spark.read.schema(schema).parquet(f"{sink_path}_base").where(F.col("base") == upto).select(*HOURLY.names)


def read_folded(spark: SparkSession, sink_path: str) -> DataFrame:
    """``read_rollup`` from the current base and the deltas above it (others are not read)."""
    upto = _folded(spark, sink_path)
    deltas = _deltas(spark, sink_path)
    if upto is not None:
        deltas = deltas.where(F.col("batch_id") > upto)
    rows = deltas.select(*HOURLY.names)
    if upto is not None:
        rows = rows.unionByName(_base(spark, sink_path, upto))
    return rows.groupBy(*GROUP).agg(F.sum("mentions").alias("mentions")).where("mentions <> 0")


def write_fold(spark: SparkSession, sink_path: str) -> int | None:
    """The first half of a fold: base and deltas as one new base of its own version, which no reader sees yet."""
    upto = _deltas(spark, sink_path).agg(F.max("batch_id")).first()[0]
    if upto is not None and upto != _folded(spark, sink_path):
        (read_folded(spark, sink_path).withColumn("base", F.lit(upto)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("base").parquet(f"{sink_path}_base"))
    return upto


def fold_rollup(spark: SparkSession, sink_path: str) -> None:
    """Fold the deltas into a new base and move the pointer to it: one small file, so readers see the old base and its
    deltas or the new one, and a crash between the two halves changes nothing. Refreshes go on as
    before: their batch ids are above the pointer."""
    upto = write_fold(spark, sink_path)
    if upto is not None and upto != _folded(spark, sink_path):
        spark.createDataFrame([(upto,)], POINTER).coalesce(1).write.mode("append").json(f"{sink_path}_pointer")


def compact_rollup(spark: SparkSession, sink_path: str, compacted_path: str) -> None:
    """Write the rollup as one delta to a new folder, which then takes the old one's place
    (with the same streaming checkpoint: later batch ids never meet the compacted one, -1)."""
    _write_delta(read_rollup(spark, sink_path), compacted_path, -1)
