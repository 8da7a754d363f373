"""Update log with bounded reading, and late rows as a table.

An update-mode stream writes, per micro-batch, the windows that changed (``windows.batch_writer``). ``compact`` folds
what has been written so far into two parts: *closed* windows, which no later row can change, are written once and
never read again by a compaction; *open* ones are written anew. A manifest version (``sources.manifest``) names both
and the last micro-batch they hold, so a reader sees one version, and only the micro-batches after it. So the rows
read for the present state are the open windows and a few micro-batches, however long the stream has run. A compaction
that fails leaves parts that no version names; a repeated one writes its own.

Whether a window is closed follows from the log alone: no row's event time is below the latest window start that was
written, so the stream's watermark is at least that less its delay.

``late_writer`` counts the rows that a stream's windows leave out: in each micro-batch, rows of windows that had ended
by the watermark the batch began with. It keeps the latest event time of every micro-batch beside its output, so a
replayed one gives the same counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wirelake.functions.timeconv import instant_to_ntz
from wirelake.sources.manifest import Manifest
from wirelake.streaming.windows import batch_writer

KEYS = ["window_start", "window_end", "protocol"]
PARTS = "_parts"  # hidden from readers of the plain log


def _manifest(spark: SparkSession, sink: str) -> Manifest:
    return Manifest(spark, f"{sink}/{PARTS}/manifest")


def _newer(spark: SparkSession, sink: str, after: int, schema: T.StructType) -> DataFrame:
    """The rows of the micro-batches after ``after``; other folders are not opened."""
    manifest = _manifest(spark, sink)
    folder = manifest.path(sink)
    names = [s.getPath().getName() for s in manifest.fs.listStatus(folder)] if manifest.fs.exists(folder) else []
    batches = sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    new = [f"{sink}/batch_id={b}" for b in batches if b > after]
    rows = spark.read.schema(schema).option("basePath", sink).parquet(*new) if new else spark.createDataFrame([], schema)
    return rows if "batch_id" in rows.columns else rows.withColumn("batch_id", F.lit(-1).cast("long"))


def _present(spark: SparkSession, sink: str, schema: T.StructType) -> tuple[DataFrame, int, dict, int]:
    """(open windows as they are now, with the micro-batch that wrote them; version; its content; last micro-batch)"""
    version, content = _manifest(spark, sink).latest()
    after = content.get("upto", -1)
    rows = _newer(spark, sink, after, T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    if content:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{sink}/{PARTS}/open-{content['open']}"))
    values = [f.name for f in schema.fields if f.name not in KEYS]
    last = rows.groupBy(*KEYS).agg(F.max_by(F.struct("batch_id", *values), "batch_id").alias("now"))
    return last.select(*KEYS, "now.*"), version, content, after


def open_windows(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """Windows that are not archived yet, with the counts of their last micro-batch."""
    return _present(spark, sink, schema)[0].select(*schema.fieldNames())


def all_windows(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """Every window, the archived ones included."""
    rows, _, content, _ = _present(spark, sink, schema)
    rows = rows.select(*schema.fieldNames())
    closed = [f"{sink}/{PARTS}/closed-{name}" for name in content.get("closed", [])]
    return rows.unionByName(spark.read.schema(schema).parquet(*closed)) if closed else rows


def compact(spark: SparkSession, sink: str, schema: T.StructType, delay: str) -> int:
    """Fold the log into a new version; its number. ``delay``: the stream's watermark delay."""
    rows, version, content, after = _present(spark, sink, schema)
    name = f"{version + 1:08d}"
    staged = f"{sink}/{PARTS}/folded-{name}"
    rows.write.mode("overwrite").parquet(staged)
    folded = spark.read.schema(rows.schema).parquet(staged)
    last, top = folded.agg(F.max("batch_id"), F.max("window_start").cast("string")).first()
    upto = after if last is None else max(after, last)
    ended = F.col("window_end") <= F.lit(top).cast(schema["window_start"].dataType) - F.expr(f"INTERVAL {delay}")
    folded = folded.withColumn("closed", F.coalesce(ended, F.lit(False)))
    folded.filter("NOT closed").drop("closed").write.mode("overwrite").parquet(f"{sink}/{PARTS}/open-{name}")
    closed = list(content.get("closed", []))
    if folded.filter("closed").limit(1).count():
        folded.filter("closed").select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{sink}/{PARTS}/closed-{name}")
        closed.append(name)
    _manifest(spark, sink).publish(version + 1, {"upto": upto, "open": name, "closed": closed})
    return version + 1


def compacting_writer(sink: str, delay: str, every: int):
    """``foreachBatch`` function that writes a micro-batch's windows and folds the log after each ``every``-th."""
    write = batch_writer(sink, "update")

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if (batch_id + 1) % every == 0:
            compact(batch.sparkSession, sink, batch.schema, delay)

    return run


def late_writer(sink: str, length: str, slide: str, delay: str, time_col: str = "event_time"):
    """``foreachBatch`` function over the records of a stream (not its windows): per micro-batch, how many rows its
    windows leave out, by window and protocol."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        notes = _manifest(spark, sink)
        folder = notes.path(f"{sink}/_latest")
        seen = [s.getPath().getName() for s in notes.fs.listStatus(folder)] if notes.fs.exists(folder) else []
        before = [int(n.split("-")[1]) for n in seen if n.count("-") == 1 and int(n.split("-")[0]) < batch_id]
        late = batch.limit(0) if not before else batch
        ended = F.timestamp_micros(F.lit(max(before, default=0))) - F.expr(f"INTERVAL {delay}")
        spread = late.select(F.window(time_col, length, slide).alias("w"), "protocol").filter(F.col("w.end") <= ended)
        counts = spread.groupBy("w", "protocol").agg(F.count(F.lit(1)).alias("dropped"))
        counts.select(instant_to_ntz(F.col("w.start")).alias("window_start"), instant_to_ntz(F.col("w.end")).alias("window_end"), "protocol", "dropped").write.mode(
            "overwrite").parquet(f"{sink}/batch_id={batch_id}")
        top = batch.agg(F.max(F.unix_micros(time_col))).first()[0]
        if top is not None:
            notes.fs.mkdirs(folder)
            notes.fs.create(notes.path(f"{sink}/_latest/{batch_id}-{max([top, *before])}"), True).close()

    return run

