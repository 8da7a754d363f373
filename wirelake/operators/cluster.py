"""K-Means over capture features and its silhouette.

The model is Spark ML's K-Means (maxIter 10, seed 42, k from the row-count
rule) and its score Spark ML's evaluator. Assignment to given centres is also
written as DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from wirelake.schema import FEATURE_COLUMNS

MAX_K = 3  # the reference's rule: k = min(3, max(2, rows // 2))
MIN_K = 2


def assemble(features: DataFrame, scale: bool = False, out: str = "features") -> DataFrame:
    """The 13 feature columns as one vector, unscaled unless ``scale``."""
    assembled = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol=out if not scale else "_raw")
    df = assembled.transform(features)
    if scale:
        scaler = StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True)
        df = scaler.fit(df).transform(df).drop("_raw")
    return df


def choose_k(features: DataFrame) -> DataFrame:
    """One row (rows, distinct_vectors, k); k follows the rule, capped at distinct vectors."""
    agg = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(*[F.col(c) for c in FEATURE_COLUMNS]).alias("distinct_vectors"),
    )
    rule = F.least(F.lit(MAX_K), F.greatest(F.lit(MIN_K), (F.col("rows") / 2).cast("long")))
    return agg.select("rows", "distinct_vectors", F.least(rule, F.col("distinct_vectors")).cast("long").alias("k"))


FIT_PARTITIONS = 16  # fixed, so that the fit doesn't depend on the number of cores


def repeatable(features: DataFrame, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Fixed hash partitioning and order, so that K-Means initialisation repeats on any cluster. Captures are told
    apart by ``capture_index`` or ``path`` where there is one, as names may repeat."""
    keys = [c for c in ("capture_index", "path", "filename") if c in features.columns]
    return features.repartition(partitions, *keys).sortWithinPartitions(*keys, *FEATURE_COLUMNS)


def fit_kmeans(features: DataFrame, k: int | None = None, seed: int = 42, max_iter: int = 10,
               scale: bool = False, repeat: bool = True):
    """E3 + E4: fit and assign. Returns ``(model or None, predictions)``.

    A given ``k`` is capped at the number of distinct vectors, as the rule's is. With fewer than two
    there is nothing to separate: every capture gets cluster 0 and no model is fitted.
    """
    rule = choose_k(features).first()
    k = int(rule["k"]) if k is None else min(k, int(rule["distinct_vectors"]))
    data = assemble(repeatable(features) if repeat else features, scale=scale)
    if k < 2:
        return None, data.withColumn("prediction", F.lit(0))
    model = KMeans(k=k, featuresCol="features", predictionCol="prediction", maxIter=max_iter, seed=seed).fit(data)
    return model, model.transform(data)


def fit_pipeline(features: DataFrame, k: int | None = None, seed: int = 42, max_iter: int = 10) -> PipelineModel | None:
    """E1 + E3 as one model that can be saved: the assembler and K-Means. None where there is nothing to separate."""
    rule = choose_k(features).first()
    k = int(rule["k"]) if k is None else min(k, int(rule["distinct_vectors"]))
    if k < 2:
        return None
    kmeans = KMeans(k=k, featuresCol="features", predictionCol="prediction", maxIter=max_iter, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features"), kmeans]).fit(repeatable(features))


def save_model(model: PipelineModel, path: str) -> None:
    """To a shared folder; ``load_model`` reads it back in any session, and ``transform`` assigns new captures without a fit."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def centres_of(model: PipelineModel) -> list[list[float]]:
    return [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]


def matched_numbers(old: list[list[float]], new: list[list[float]]) -> list[int]:
    """For each new centre the number it goes by: that of the old centre it is matched with, nearest pairs first;
    centres without a partner get the numbers that are left. So clusters keep their numbers over a refit."""
    pairs = sorted((sum((x - y) ** 2 for x, y in zip(a, b)), i, j) for i, a in enumerate(old) for j, b in enumerate(new))
    numbers: dict[int, int] = {}
    for _, i, j in pairs:
        if j not in numbers and i not in numbers.values():
            numbers[j] = i
    free = (n for n in range(len(old) + len(new)) if n not in numbers.values())
    return [numbers[j] if j in numbers else next(free) for j in range(len(new))]


def renumbered(predictions: DataFrame, numbers: list[int]) -> DataFrame:
    """Predictions of a refit under the numbers from ``matched_numbers``."""
    return predictions.withColumn("prediction", F.get(F.array(*[F.lit(n) for n in numbers]), F.col("prediction")))


def cluster_scatter(predictions: DataFrame) -> DataFrame:
    """The scatter rows."""
    return predictions.select("filename", "packet_count", "total_bytes", "prediction")


def _sq_distance(centre: list[float]) -> Column:
    terms = [(F.col(c).cast("double") - F.lit(float(v))) * (F.col(c).cast("double") - F.lit(float(v)))
             for c, v in zip(FEATURE_COLUMNS, centre)]
    return reduce(lambda a, b: a + b, terms)


def assign_to_centres(features: DataFrame, centres: list[list[float]]) -> DataFrame:
    """E4 for given centres: nearest by squared distance, ties to the lower index."""
    dists = [_sq_distance(c) for c in centres]
    best = F.lit(len(centres) - 1)
    for i in range(len(centres) - 2, -1, -1):
        best = F.when(reduce(lambda a, b: a & b, [dists[i] <= d for d in dists[i + 1:]]), F.lit(i)).otherwise(best)
    return features.withColumn("prediction", best.cast("int"))


def extreme_centres(features: DataFrame) -> list[list[float]]:
    """Two fixed centres taken from the data: the smallest and the largest capture by packets (by name among equals)."""
    row = F.struct(*[F.col(c).cast("double") for c in FEATURE_COLUMNS])
    low = F.min_by(row, F.struct("packet_count", "filename"))
    high = F.min_by(row, F.struct(-F.col("packet_count"), "filename"))
    found = features.agg(low.alias("low"), high.alias("high")).first()
    return [list(found[c]) for c in ("low", "high") if found[c] is not None]


def silhouette(points: DataFrame, label: str = "prediction") -> DataFrame:
    """E5: mean silhouette with squared Euclidean distance by Spark ML's evaluator, one row ``silhouette``
    (eight decimals). NULL when there are fewer than two clusters."""
    spark = points.sparkSession
    value = None
    if points.select(label).distinct().limit(2).count() == 2:
        vectors = assemble(points.select(label, *FEATURE_COLUMNS), out="point").withColumn(label, F.col(label).cast("double"))
        value = round(ClusteringEvaluator(predictionCol=label, featuresCol="point").evaluate(vectors), 8)
    return spark.range(1).select(F.lit(value).cast("double").alias("silhouette"))
