"""Landed files loaded as they arrive: each micro-batch is one upsert.

The stream's own checkpoint remembers the files already taken, so no file is
skipped or read twice; the upsert makes a repeated batch harmless.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from adtally.fixed_values import LEVEL_IDS
from adtally.plans.loads import load_facts
from adtally.session import drop_stage, write_stage
from adtally.sources.landed import ARRIVAL_ORDER, UNREADABLE, arrival_columns, insight_schema, readable, with_unreadable


REJECTS = "etl_rejected_lines"
#: Why a line is rejected: its text can't be read, or is something else than a record.
REASONS = NO_JSON, NO_OBJECT = "no JSON", "no JSON object"
#: Of a staged batch a task reads so much.
TASK_READS = "16m"
#: One partition per stream and batch, so that a batch that runs again replaces what it rejected.
REJECT_SCHEMA = "line STRING, reason STRING, file STRING, arrived TIMESTAMP, stream STRING, batch BIGINT"


def read_landing(spark: SparkSession, path: str, level: str, breakdowns: Sequence[str] = (), files_per_batch: int = 1000) -> DataFrame:
    """Stream of delivery records with the arrival of their file for order; lines that are no object are skipped."""
    return readable(_lines(spark, path, level, breakdowns, files_per_batch))


def _lines(spark: SparkSession, path: str, level: str, breakdowns: Sequence[str], files_per_batch: int) -> DataFrame:
    """Every line: the fields of its record, its text where it doesn't fit them, and its file."""
    records = (
        spark.readStream.schema(with_unreadable(insight_schema(level, breakdowns)))
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return arrival_columns(records)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """What ``readable`` leaves out of landed lines: text, reason, file and its time."""
    shape = F.schema_of_variant(F.try_parse_json(UNREADABLE))
    reason = F.when(shape.isNull(), NO_JSON).when(~shape.startswith("OBJECT"), NO_OBJECT)
    text = F.col(UNREADABLE)
    return lines.select(
        text.alias("line"), reason.alias("reason"), F.col("_file").alias("file"), F.col("_arrived").alias("arrived")
    ).where(text.isNotNull() & reason.isNotNull())


def _keep_rejected(spark: SparkSession, lines: DataFrame, database: str, stream: str, batch: int) -> None:
    """Put a batch's rejected lines in their partition, in place of those of an earlier try."""
    table = f"{database}.{REJECTS}"
    rejected = rejected_lines(lines)
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], REJECT_SCHEMA).write.partitionBy("stream", "batch").saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (stream = '{stream}', batch = {batch})")
    # Found by many tasks; few lines make one file, many make several.
    gathered = rejected.hint("rebalance", "line")
    gathered.withColumns({"stream": F.lit(stream), "batch": F.lit(batch).cast("bigint")}).write.insertInto(table)
    spark.catalog.refreshTable(table)


def stream_facts(
    spark: SparkSession,
    path: str,
    level: str,
    database: str,
    checkpoint: str,
    breakdowns: Sequence[str] = (),
    files_per_batch: int = 1000,
    **known: object,
) -> StreamingQuery:
    """Upsert everything landed so far and stop; run again with the same ``checkpoint`` for what lands later.

    Lines that are no JSON object are kept with reason, file and batch in the database's table of rejected lines; a
    batch that runs again, after a failure, replaces its own.
    """
    if level not in LEVEL_IDS:
        raise ValueError(f"unknown level: {level}")
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load(batch: DataFrame, number: int) -> None:
        # Several jobs look at a batch; it is read from its files once.
        own = batch.sparkSession
        # The stream's own session. Staged lines are small, mostly NULL fields; a task that ranks them sorts what it reads.
        own.conf.set("spark.sql.files.maxPartitionBytes", TASK_READS)
        path = write_stage(batch.withColumn("_line", F.monotonically_increasing_id()), "landing-batch")
        lines = own.read.schema(batch.schema.add("_line", T.LongType())).parquet(path)
        _keep_rejected(own, lines, database, stream, number)
        table = load_facts(own, readable(lines), level, database, ARRIVAL_ORDER, breakdowns, **known)
        # Batches run in a session of their own; the caller's must forget the files they replaced.
        for name in (table, f"{database}.{REJECTS}"):
            spark.catalog.refreshTable(name)
        drop_stage(spark, path)

    return (
        _lines(spark, path, level, breakdowns, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
