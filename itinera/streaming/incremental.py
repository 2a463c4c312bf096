"""Cleaning of newly arrived files, appended to a target without duplicates.

A run has two halves. The stream parses what arrived, micro-batch by micro-batch, into the run's own folder; no decision is
made there, so it does not matter where a micro-batch ends. When nothing is left, one batch decides for all rows of the
run: of rows with one key the first by row id and route stays, and keys that earlier runs accepted are violations. Outputs
are folders by run that a repeated decision overwrites; a marker, written last, closes the run. A run that died in either
half is taken up by the next call under its old number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itinera.plans.clean import clean_staged, stage_rows
from itinera.session import short_methods
from itinera.sinks.versioned import StoreFiles
from itinera.spec import SourceSpec

RUN, BATCH = "run_id", "batch_id"


def _runs(files: StoreFiles, folder: str) -> set[int]:
    return {int(n.split("=")[1]) for n in files.names(folder) if n.startswith(f"{RUN}=")}


def incremental_clean(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    spec: SourceSpec,
    row_id: str,
    target: str,
    rejected: str,
    checkpoint: str,
    fmt: str = "parquet",
    trim_equal: Sequence[str] = (),
    max_files: int = 1000,
) -> int:
    """Clean every file that arrived since the last run; the number of the run, or 0 if nothing arrived. Eager.

    ``max_files`` bounds a micro-batch and has no influence on the result. One call at a time may work on a target.
    """
    files = StoreFiles(spark, checkpoint)
    staging, done = f"{checkpoint}/staged", f"{checkpoint}/finished"
    finished = _runs(files, done)
    open_runs = _runs(files, staging) - finished
    run = min(open_runs) if open_runs else max(finished, default=0) + 1

    def stage(batch: DataFrame, batch_id: int) -> None:
        # a file may be one row group, which one task reads; its rows are parsed by all
        tasks = max(spark.sparkContext.defaultParallelism, batch.rdd.getNumPartitions())
        stage_rows(batch.repartition(tasks), spec).write.mode("overwrite").parquet(f"{staging}/{RUN}={run}/{BATCH}={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(source)
    with short_methods(spark):  # the stream's session is a copy of this one
        query = stream.writeStream.foreachBatch(stage).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start()
        query.awaitTermination()
    if run not in _runs(files, staging):
        return 0
    finish_run(spark, run, schema, spec, row_id, target, rejected, checkpoint, trim_equal)
    return run


def finish_run(
    spark: SparkSession, run: int, schema: T.StructType, spec: SourceSpec, row_id: str, target: str, rejected: str, checkpoint: str, trim_equal: Sequence[str] = ()
) -> None:
    """Decide on the staged rows of a run; the same rows give the same outputs however often this is done."""
    files = StoreFiles(spark, checkpoint)
    folders = [f"{checkpoint}/staged/{RUN}={run}/{n}" for n in files.names(f"{checkpoint}/staged/{RUN}={run}")]
    parsed = stage_rows(spark.createDataFrame([], schema), spec).schema
    staged = spark.read.schema(parsed).parquet(*folders)
    earlier = [f"{target}/{RUN}={r}" for r in sorted(_runs(files, target)) if r < run]
    known = spark.read.parquet(*earlier) if earlier else None
    with short_methods(spark):
        result = clean_staged(staged.select(*schema.names), staged, spec, row_id, known, trim_equal, prune=True)
        for rows, path in ((result.accepted, target), (result.rejected, rejected)):
            rows.write.mode("overwrite").parquet(f"{path}/{RUN}={run}")
    files.write(f"{checkpoint}/finished/{RUN}={run}", "")
    files.remove(f"{checkpoint}/staged/{RUN}={run}")
