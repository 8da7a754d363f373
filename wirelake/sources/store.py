"""An incremental feature store: captures are read once, however often they are listed (A3, C11).

A load lists captures, leaves out those that were committed before (same uri, size and modification time), reads the
others, and keeps their edge tables (one row per capture, source and destination) and their list. It counts when it
is committed: one manifest version names all loads that do. A load is named by what it reads, so a load that failed before
its commit, or is repeated after it, writes the same folder again and is committed once. A capture that changed
is read again, and its newest load replaces the older ones. Features are merged from the edges of committed loads;
no packet is read for that.

Two writers at once: one commit wins, the other reads the manifest again and commits after it (loads of the same
captures have the same name). Captures that can't be opened or aren't there are tried again by the next load; those
that are no captures, or break off, are committed with their status. Nothing new: no load, no version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wirelake.functions.headers import decode_packets
from wirelake.operators import features as feat
from wirelake.sources import capture as cap
from wirelake.sources.manifest import Manifest

IDENTITY = ["uri", "size", "modified"]
CAPTURES = "uri string, size long, modified long, path string, filename string, status string, load string"
AGAIN = ("missing", "unreadable")


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, f"{self.root}/manifest")

    def loads(self) -> list[str]:
        """Committed loads, in order."""
        return self.manifest.latest()[1].get("loads", [])

    def _read(self, part: str, schema) -> DataFrame:
        names = [f"{self.root}/loads/{name}/{part}" for name in self.loads()]
        return self.spark.read.schema(schema).parquet(*names) if names else self.spark.createDataFrame([], schema)

    def committed(self) -> DataFrame:
        """Every capture of every committed load."""
        return self._read("captures", CAPTURES)

    def captures(self) -> DataFrame:
        """The captures as they are now: of each uri, what its newest load says."""
        order = self.loads()
        place = self.spark.createDataFrame([(name, k) for k, name in enumerate(order)], "load string, place int")
        newest = Window.partitionBy("uri").orderBy(F.desc("place"))  # a row per load of the capture
        return self.committed().join(place, "load").withColumn("turn", F.row_number().over(newest)).filter("turn = 1").drop("turn", "place")

    def prepare(self, paths: list[str] | DataFrame, split_bytes: int = cap.SPLIT_BYTES) -> str | None:
        """Read what is new among ``paths`` and write its load; the load's name, None when nothing is new."""
        listed = cap.stat_captures(paths) if isinstance(paths, DataFrame) else cap.list_captures(self.spark, list(paths))
        listed = listed.filter(~F.col("status").isin("missing")).dropDuplicates(["uri"])
        known = self.committed().filter(~F.col("status").isin(*AGAIN)).select(*[F.col(c).alias(f"known_{c}") for c in IDENTITY])
        new = listed.join(known, [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in IDENTITY], "left_anti")
        work = f"{self.root}/incoming/{cap.token()}"
        new = cap._staged(new, f"{work}/new")
        count, mark = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*IDENTITY).cast("decimal(38,0)"))).first()
        if not count:
            return None
        name = f"{count}-{int(mark) % 2**64:016x}"
        captures, index, failed = cap.indexed(self.spark, new, work, split_bytes)
        frames = cap.read_frames(index.join(failed, "capture_index", "left_anti"))
        packets = decode_packets(frames.withColumn("ts", F.timestamp_micros("micros")).drop("micros"))
        edges = feat.edge_table(packets, ["capture_index"]).join(captures.select("capture_index", "uri", "path", "filename"), "capture_index")
        edges.drop("capture_index").withColumn("load", F.lit(name)).write.mode("overwrite").parquet(f"{self.root}/loads/{name}/edges")
        broken = failed.select("capture_index", F.coalesce(F.when(F.col("message").isNotNull(), "unreadable"), F.lit("framing_error")).alias("broken"))
        status = captures.join(broken, "capture_index", "left").withColumn("status", F.coalesce("broken", "status"))
        status.withColumn("load", F.lit(name)).select("uri", "size", "modified", "path", "filename", "status", "load").write.mode("overwrite").parquet(
            f"{self.root}/loads/{name}/captures")
        return name

    def commit(self, name: str) -> None:
        """Make a prepared load count; once, however often it is asked for."""
        while True:
            version, content = self.manifest.latest()
            if name in content.get("loads", []):
                return
            try:
                return self.manifest.publish(version + 1, {"loads": [*content.get("loads", []), name]})
            except FileExistsError:
                continue

    def load(self, paths: list[str] | DataFrame, split_bytes: int = cap.SPLIT_BYTES) -> str | None:
        name = self.prepare(paths, split_bytes)
        if name is not None:
            self.commit(name)
        return name

    def edges(self) -> DataFrame:
        """The edges of the captures as they are now: uri, path, filename and the edge table's columns."""
        kept = self.captures().filter("status = 'ok'").select(F.col("uri").alias("kept_uri"), F.col("load").alias("kept_load"))
        edges = self._read("edges", EDGES)
        return edges.join(kept, (F.col("uri") == F.col("kept_uri")) & (F.col("load") == F.col("kept_load"))).drop("kept_uri", "kept_load", "load")

    def features(self) -> DataFrame:
        """C10 over all captures that are held, those without packets included."""
        keys = ["uri", "path", "filename"]
        return feat.with_empty_captures(feat.features_from_edges(self.edges(), keys), self.captures().filter("status = 'ok'"), keys)


EDGES = ("src_ip string, dst_ip string, packets long, bytes long, tcp long, udp long, icmp long, http long, dns long, syn long, has_ip boolean, "
         "uri string, path string, filename string, load string")
