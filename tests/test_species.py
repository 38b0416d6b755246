import random

import pytest

from lociweave.operators import multispecies as M
from lociweave.operators import normalise as N
from lociweave.plans.species_map import species_map
from lociweave.streaming.incremental import current_spectra, update_spectra


def spectra_of(spark, n=9):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        bias = i % 3
        for k, l in enumerate(M.LABELS):
            total = 1000 + rng.randrange(50)
            rows.append((f"s{i}", l, 20 + (400 if k % 3 == bias else 0) + rng.randrange(5), total))
    return spark.createDataFrame(rows, "accession string, mutType string, mutNum long, totalRootNum long")


def test_map_finds_planted_clusters(spark):
    out = {r["accession"]: r for r in species_map(spectra_of(spark), k_max=4, seeds=range(1, 4)).collect()}
    assert len({r["cluster"] for r in out.values()}) == 3
    for i in range(9):
        assert out[f"s{i}"]["cluster"] == out[f"s{(i + 3) % 9}"]["cluster"] and out[f"s{i}"]["samples"] == 3


def test_missing_label_is_an_error(spark):
    f = N.log_ratio_smooth(spectra_of(spark, 2).where("mutType <> 'A[C>A]A'"), ["accession"])
    with pytest.raises(Exception, match="no A"):
        M.feature_table(f, "accession", "feature").collect()


def test_components(spark):
    v = M.feature_vectors(M.feature_table(N.log_ratio_smooth(spectra_of(spark), ["accession"]), "accession", "feature"), "accession")
    projected, var = M.principal_components(v, "accession", 3)
    assert var == sorted(var, reverse=True) and 0 < sum(var) <= 1 + 1e-9
    mean = M.vector_columns(projected, "accession", 2).selectExpr("abs(avg(pc1))", "abs(avg(pc2))").head()
    assert max(mean) < 1e-9


def test_incremental_counts(spark, folder):
    spec = spectra_of(spark, 1).selectExpr("'B' as species", "mutType", "mutNum", "totalRootNum")
    schema = "species string, mutType string, mutNum long, totalRootNum long"
    for _ in range(2):
        spec.coalesce(1).write.mode("append").parquet(folder + "/in")
        update_spectra(spark, folder + "/in", folder + "/t", folder + "/ck", lambda d: d, lambda d: d, schema)
    update_spectra(spark, folder + "/in", folder + "/t", folder + "/ck", lambda d: d, lambda d: d, schema)
    total = current_spectra(spark, folder + "/t", []).selectExpr("sum(mutNum)").head()[0]
    assert total == 2 * spec.selectExpr("sum(mutNum)").head()[0]
