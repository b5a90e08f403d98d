"""Golden values: the published monthly changes and the sf0.01 flagship profile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import gold
from tessera.operators.joins import temporal_join
from tessera.plans.series import index_series, price_series

from table_dirs import SF01

# Index levels Jan-Aug and the published % changes Feb-Aug.
LEVELS = [0.16, 1.31, 0.56, 0.43, 0.26, 0.24, 0.26, -0.11]
CHANGES = [718.75, -57.25, -23.21, -39.53, -7.69, 8.33, -142.31]


def test_published_changes(spark):
    rows = [(dt.date(2025, m + 1, 1), 2025, m + 1, 100.0 + m, lvl) for m, lvl in enumerate(LEVELS)]
    df = spark.createDataFrame(rows, "data date, ano int, mes int, preco_boi_gordo double, ipca_mensal double")
    out = gold.analytic(df).orderBy("data").collect()
    assert out[0]["variacao_ipca"] is None and out[0]["destaque"] == "Empate"
    got = [round(r["variacao_ipca"], 2) for r in out[1:]]
    assert got == CHANGES


def test_combined_mean_rounding(spark):
    df = spark.createDataFrame([(2.0729, -0.0915)], "a double, b double")
    r = df.select(F.round((F.col("a") + F.col("b")) / 2, 4)).first()[0]
    assert r == 0.9907


def test_flagship_profile_sf001(spark):
    p = price_series(spark, SF01)
    i = index_series(spark, SF01).drop("series_id")
    a = gold.analytic(temporal_join(p, i, on=["data"], coalesce_cols=["ano", "mes"]))
    rows = a.collect()
    assert len(rows) == 80
    lead = {}
    cls = {}
    for r in rows:
        lead[r["destaque"]] = lead.get(r["destaque"], 0) + 1
        cls[r["classe_impacto"]] = cls.get(r["classe_impacto"], 0) + 1
    assert lead == {"Preço do boi cresce mais": 42, "Inflação cresce mais": 37, "Empate": 1}
    assert cls == {"Alta divergência": 48, "Média divergência": 21, "Baixa divergência": 11}
    g = rows[0]
    assert g["correlacao_global"] == pytest.approx(0.017042, abs=1e-6)
    assert g["media_ipca_global"] == pytest.approx(0.075094, abs=1e-6)
    assert g["media_boi_global"] == pytest.approx(0.639751, abs=1e-6)
    first = min(rows, key=lambda r: r["data"])
    assert first["data"] == dt.date(1995, 1, 1)
    assert first["variacao_ipca"] is None and first["classe_impacto"] == "Baixa divergência"
