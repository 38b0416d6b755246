"""Spectra of many species: feature vectors, PCA, k-means, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

# the 96 labels, sorted by name
LABELS = sorted(f"{x}[{y}>{v}]{z}" for x in "ACGT" for y in "CT" for z in "ACGT" for v in "ACGT" if v != y)


def feature_table(spectra: DataFrame, species: str, value: str, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per species, one column per label, by name; a species without one of the labels is an error."""
    wide = spectra.groupBy(species).pivot("mutType", list(labels)).agg(F.first(value))
    need = [F.coalesce(F.col(f"`{l}`"), F.raise_error(F.concat(F.lit(f"no {l} for "), F.col(species).cast("string"))).cast("double")).alias(l)
            for l in labels]
    return wide.select(species, *need)


def feature_vectors(table: DataFrame, species: str) -> DataFrame:
    labels = [c for c in table.columns if c != species]
    safe = [f"f{i}" for i in range(len(labels))]  # label brackets are not legal in vector inputs
    renamed = table.select(species, *[F.col(f"`{l}`").alias(s) for l, s in zip(labels, safe)])
    return VectorAssembler(inputCols=safe, outputCol="features").transform(renamed).select(species, "features")


def standardised(vectors: DataFrame) -> DataFrame:
    """`scaled`: every feature less its mean, over its sample deviation; constant features are 0."""
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(vectors).transform(vectors)


def principal_components(vectors: DataFrame, species: str, k: int = 2) -> tuple[DataFrame, list[float]]:
    """Standardised features projected on k components (signs are arbitrary), and the explained variance."""
    scaled = standardised(cut_lineage(vectors))  # one row per species, read by three fits
    model = PCA(k=k, inputCol="scaled", outputCol="pc").fit(scaled)
    return model.transform(scaled).select(species, "scaled", "pc"), [float(v) for v in model.explainedVariance]


def vector_columns(df: DataFrame, key: str, k: int, column: str = "pc") -> DataFrame:
    """A vector column of size k as pc1, pc2, ... doubles."""
    values = vector_to_array(column)
    return df.select(key, *[values[i].alias(f"{column}{i + 1}") for i in range(k)])


def best_kmeans(projected: DataFrame, species: str, column: str = "pc", k_min: int = 2, k_max: int = 10,
                seeds: Sequence[int] = range(1, 11)) -> tuple[DataFrame, dict[int, float]]:
    """k with the best silhouette (squared Euclidean) out of k_min..min(k_max, n - 1); best of several seeds per k."""
    # dozens of fits follow: start them from stored rows, not from the spectra
    data = cut_lineage(projected.select(species, F.col(column).alias("features")))
    n = data.count()
    data = data.cache()
    scores, fits = {}, {}
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")

    def fit(task: tuple[int, int]):
        return KMeans(k=task[0], seed=task[1], featuresCol="features", predictionCol="cluster").fit(data)

    ks = range(k_min, min(k_max, n - 1) + 1)
    try:
        with ThreadPoolExecutor(8) as pool:  # the fits don't depend on each other: their jobs share the cluster
            models = list(pool.map(fit, [(k, s) for k in ks for s in seeds]))
        for i, k in enumerate(ks):
            best = min(models[i * len(seeds):(i + 1) * len(seeds)], key=lambda m: m.summary.trainingCost)
            labelled = best.transform(data)
            if labelled.select("cluster").distinct().count() < 2:
                continue
            scores[k] = evaluator.evaluate(labelled)
            fits[k] = best
    finally:
        data.unpersist()
    chosen = max(scores, key=lambda k: (scores[k], -k))
    return fits[chosen].transform(data).select(species, "cluster"), scores


def cluster_table(projected: DataFrame, clusters: DataFrame, species: str, k: int = 2) -> DataFrame:
    """species, cluster, pc1, pc2 (and pc3), samples in the cluster."""
    size = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("samples"))
    return vector_columns(projected, species, k).join(clusters, species).join(size, "cluster")


# ---- labels and summaries --------------------------------------------------

def species_label(organism, infra, short_name, accession) -> Column:
    """`Genus_species_strain (short)`; `short (accession)` without an organism name."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    text = F.replace(c(organism), F.lit(" "), F.lit("_"))
    full = F.concat_ws("_", text, F.when(F.size(c(infra)) > 0, F.replace(F.array_join(c(infra), "_"), F.lit(" "), F.lit("_"))))
    name = F.when(F.length(c(organism)) > 0, F.concat(full, F.lit(" ("), c(short_name), F.lit(")")))
    return F.coalesce(name, F.concat(c(short_name), F.lit(" ("), c(accession), F.lit(")")))


def genus(organism) -> Column:
    o = F.col(organism) if isinstance(organism, str) else organism
    return F.when(F.length(o) > 0, F.split_part(o, F.lit(" "), F.lit(1))).otherwise(F.lit("Unknown"))


def with_metadata(species: DataFrame, metadata: DataFrame, key: str = "accession") -> DataFrame:
    """Left join with the metadata; genus and organism fall back to "Unknown" and the accession."""
    j = species.join(metadata, key, "left")
    return j.withColumns({"genus": genus("organism"), "organism": F.coalesce(F.nullif(F.col("organism"), F.lit("")), F.col(key))})


def species_summary(expected: DataFrame, metrics: Mapping[str, DataFrame], keys: Sequence[str], texts: Sequence[str] = ()) -> DataFrame:
    """One row per expected (trio, species) with every metric; texts show `(missing)` when absent.

    metrics: name -> DataFrame(keys, name).
    """
    out = reduce(lambda acc, kv: acc.join(kv[1].select(*keys, kv[0]), list(keys), "left"), metrics.items(), expected)
    return out.select(*[F.coalesce(F.col(c).cast("string"), F.lit("(missing)")).alias(c) if c in texts else F.col(c) for c in out.columns])


def missing_results(expected: DataFrame, metrics: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """(keys, metric) for which no value exists."""
    have = reduce(DataFrame.unionByName, [
        d.where(F.col(n).isNotNull()).select(*keys, F.lit(n).alias("metric")) for n, d in metrics.items()])
    want = expected.select(*keys, F.explode(F.array(*[F.lit(n) for n in metrics])).alias("metric"))
    return want.join(have, [*keys, "metric"], "left_anti")


def trio_statistics(trios: DataFrame, keys: Sequence[str] = ("taxon",), threshold: float = 80) -> DataFrame:
    i = F.col("identity")
    return trios.groupBy(*keys).agg(F.count(F.lit(1)).alias("pairs"), F.min(i).alias("lowest"), F.avg(i).alias("mean"), F.max(i).alias("highest"),
                                    F.bool_and(i >= threshold).alias("all_recommended"))
