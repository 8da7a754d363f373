"""End-to-end flows: the batch analysis of a capture set and the live stream analysis.

``analyze_captures`` runs what a user of a capture analyser runs: ingest the
captures, compute per-capture features (captures without packets included),
cluster them, score the clustering, write the report, and return every
dashboard data set as a DataFrame. ``start_stream_analysis`` starts the
sliding-window counters on a line stream and keeps them running.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wirelake.operators import cluster, panels
from wirelake.operators.features import feature_table
from wirelake.operators.report import report_lines, write_report
from wirelake.plans.sql import register_views
from wirelake.schema import to_feature_schema
from wirelake.session import reliable_checkpoint, shared_dir
from wirelake.sources.capture import ingest_captures
from wirelake.sources.lines import parse_lines, with_event_time
from wirelake.streaming import windows as win

PANELS = {
    "packets_by_capture": panels.packets_by_capture,
    "protocol_share": panels.protocol_share,
    "endpoints_long": panels.endpoints_long,
    "avg_size_by_capture": panels.avg_size_by_capture,
    "traffic_by_protocol": panels.traffic_by_protocol,
    "protocol_long": panels.protocol_long,
    "protocol_count_by_capture": panels.protocol_count_by_capture,
    "protocol_percentage": panels.protocol_percentage,
    "protocol_comparison": panels.protocol_comparison,
    "protocol_trend": panels.protocol_trend,
    "summary": panels.summary,
}


@dataclass
class Analysis:
    packets: DataFrame
    features: DataFrame
    rejected: DataFrame
    predictions: DataFrame
    silhouette: DataFrame
    report_path: str
    panels: dict[str, DataFrame] = field(default_factory=dict)


def analyze_captures(spark: SparkSession, paths: list[str] | DataFrame, out_dir: str | None = None,
                     k: int | None = None, scale: bool = False) -> Analysis:
    """Captures -> packet table -> features -> K-Means -> report and dashboard data.

    ``out_dir`` must be a folder every executor can reach (default: below
    ``spark.checkpoint.dir``). The feature table is registered as the views
    ``network_features`` and ``network_traffic`` for SQL.
    """
    out_dir = out_dir or shared_dir(spark, "analysis")
    ingest = ingest_captures(spark, paths, f"{out_dir}/ingest")
    features = feature_table(ingest.packets, ["capture_index", "path", "filename"], captures=ingest.captures)
    features = reliable_checkpoint(to_feature_schema(features))
    register_views(features)
    _, predictions = cluster.fit_kmeans(features, k=k, scale=scale)
    score = cluster.silhouette(predictions)
    write_report(report_lines(features, score), f"{out_dir}/report")
    return Analysis(
        packets=ingest.packets, features=features, rejected=ingest.rejected,
        predictions=cluster.cluster_scatter(predictions), silhouette=score,
        report_path=f"{out_dir}/report", panels={n: f(features) for n, f in PANELS.items()},
    )


def start_stream_analysis(lines: DataFrame, out_dir: str, interval_seconds: int = 5,
                          watermark: str | None = None, console: bool = False) -> dict[str, StreamingQuery]:
    """Live counters on a streaming DataFrame of CSV lines (``value``).

    Windows are four intervals long and slide by one. One stateful query keeps the protocol counts; every
    trigger writes the windows it changed to its own ``batch_id=`` folder, so open windows are there too
    and a replayed batch isn't counted twice (``read_stream_analysis`` gives the present state, and the
    totals as sums of it). The watermark, one interval by default and so below the window, bounds the
    state. The label counters are a second query; each trigger writes a new ``batch_id=`` folder.
    With ``console`` both are also printed. Stop with ``windows.stop_gracefully``.
    """
    records = win.with_watermark(with_event_time(parse_lines(lines)), "event_time", watermark or f"{interval_seconds} seconds")
    length, slide = win.default_window(interval_seconds)
    outputs = {
        "protocol_counts": (win.protocol_window_counts(records, length, slide, "event_time"), "update"),
        "label_counters": (win.label_counters(records), "complete"),
    }

    def writer(name: str):
        store = win.batch_writer(f"{out_dir}/{name}", "update")

        def write(batch: DataFrame, batch_id: int) -> None:
            store(batch, batch_id)
            if console:
                batch.sparkSession.read.schema(batch.schema).parquet(f"{out_dir}/{name}/batch_id={batch_id}").show(50, truncate=False)

        return write

    return {
        name: (result.writeStream.queryName(name).outputMode(mode)
               .option("checkpointLocation", f"{out_dir}/_checkpoints/{name}")
               .foreachBatch(writer(name)).trigger(processingTime=f"{interval_seconds} seconds").start())
        for name, (result, mode) in outputs.items()
    }


def read_stream_analysis(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The present state of a live analysis: protocol_counts, window_totals, label_counters."""
    counts = win.latest_windows(spark, f"{out_dir}/protocol_counts")
    counters = spark.read.parquet(f"{out_dir}/label_counters")
    last = counters.agg(F.max("batch_id")).first()[0]
    return {"protocol_counts": counts, "window_totals": win.totals_of(counts), "label_counters": counters.filter(F.col("batch_id") == last).drop("batch_id")}
