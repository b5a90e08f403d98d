"""Registered queries with an SQL form against DuckDB on the small tables."""

import duckdb
import pytest

from tessera.llm import license_scan
from tessera.llm.queries import ORACLES, QUERIES, plain_license_digests

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted(str([r[columns.index(c)] for c in order]) for r in res.fetchall())
    assert sorted(str([r[c] for c in order]) for r in df.collect()) == expected


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_licence_sql_knows_the_full_texts(spark, tmp_path):
    """Each known text as a document, in capitals and with a copyright line: query and SQL name the same licence."""
    known = license_scan.KNOWN + license_scan.with_dress(license_scan.KNOWN)
    rows = [(i, f"Copyright (c) 2020 Some One\n{t.upper()}") for i, (_, t) in enumerate(known)]
    rows += [(-1, None), (-2, "no licence"), (-3, known[0][1] + " and more")]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").toPandas().to_parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    sql = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, text_digest, license_id, notice_ids FROM ({ORACLES['op4_license_scan']})").fetchall()}
    got = {r.doc_id: (r.text_digest, r.license_id, r.notice_ids) for r in QUERIES["op4_license_scan"](spark, folder).collect()}
    assert got == sql
    named = [got[i][1] for i in range(len(known))]
    assert None not in named and {i for i, _ in known} == set(named)
    assert got[-1][1] is got[-2][1] is got[-3][1] is None


def test_plain_licence_digests_are_the_known_ones(spark):
    assert plain_license_digests() == {r.digest: r.license_id for r in license_scan.known_digests(spark).collect()}
