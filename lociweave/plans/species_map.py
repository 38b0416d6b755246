"""Spectra of many species -> map and clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import multispecies as M
from ..operators import normalise as N


def species_map(spectra: DataFrame, species: str = "accession", components: int = 2, feature: str = "log_ratio",
                k_max: int = 10, seeds: Sequence[int] = range(1, 11)) -> DataFrame:
    """Projected and clustered species. feature: "log_ratio" (smoothed) or "rate"."""
    if feature == "log_ratio":
        values, column = N.log_ratio_smooth(spectra, [species]), "feature"
    else:
        values, column = N.normalised(spectra).na.fill(0.0, ["percentage"]), "percentage"
    vectors = M.feature_vectors(M.feature_table(values, species, column), species)
    projected, _ = M.principal_components(vectors, species, components)
    clusters, _ = M.best_kmeans(projected, species, k_max=k_max, seeds=seeds)
    return M.cluster_table(projected, clusters, species, components)
