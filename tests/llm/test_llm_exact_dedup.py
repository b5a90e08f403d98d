import hashlib

from pyspark.sql import functions as F

from tessera.llm import exact_dedup
from tessera.llm.queries import QUERIES

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UP), []).append(i)
    out = []
    for i, t in rows:
        key = (t or "").translate(UP)
        ids = [x for x in groups[key] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **kw):
    g = exact_dedup.exact_groups(df, **kw)
    rows = g.select("id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()
    return sorted(map(tuple, rows), key=str)


CASES = [
    (1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, "É"), (4, "é"), (5, None), (6, ""),
    (7, "ÀB"), (8, "Àb"), (10, "x" * 200_000), (11, "X" * 200_000), (12, "alone"), (12, "alone"), (None, "alone"),
    (None, "nobody"), (13, "İ"), (14, "K"), (15, "k"), (16, "K"),
]


def test_equals_brute_force_with_nulls_ties_and_long_texts(docs):
    assert got(docs(CASES, extra=True)) == brute(CASES)


def test_a_crowded_filter_only_costs_work(docs):
    rows = [(i, f"t{i % 40}") for i in range(200)] + [(1000 + i, f"u{i}") for i in range(300)]
    assert got(docs(rows), bits_per_row=1) == brute(rows)


def test_rows_found_unique_do_not_shuffle_by_digest(docs):
    rows = [(i, f"u{i}") for i in range(500)] + [(1000, "u1")]
    flagged = exact_dedup.possibly_repeated(exact_dedup.text_digests(docs(rows)))
    suspects = {r.id for r in flagged.filter("suspect").collect()}
    assert {1, 1000} <= suspects and len(suspects) < 60


def test_empty_table(docs):
    assert got(docs([])) == []
    assert exact_dedup.dedup(docs([])).count() == 0


def test_dedup_keeps_columns_and_one_of_each_text(docs):
    df = docs([(1, "a"), (2, "A"), (3, "b"), (4, None), (5, "")], extra=True)
    out = exact_dedup.dedup(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 5]


def test_dedup_removes_rows_not_ids(docs):
    rows = [(None, "Copied"), (9, "copied"), (None, "only here"), (None, None), (None, "twice"), (None, "twice")]
    rows += [(5, "copied"), (5, "a text of its own"), (4, "again"), (4, "again")]
    out = exact_dedup.dedup(docs(rows, extra=True)).collect()
    expected = [(9, "copied"), (None, "only here"), (None, None), (None, "twice"), (None, "twice")]
    expected += [(5, "a text of its own"), (4, "again"), (4, "again")]
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(expected, key=str)


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    src = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op1_exact_dedup"](spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, rows.collect()), key=str) == brute(src)


def test_dedup_keeps_columns_whose_names_clash_with_its_own(docs):
    from pyspark.sql import functions as F

    from tessera.llm import simhash

    df = docs([(1, "a b c"), (2, "a b c"), (3, "other words")])
    for c in ("__digest", "__gone", "__GONE_", "__text"):
        df = df.withColumn(c, F.lit("mine"))
    for out, kept in ((exact_dedup.dedup(df), [2, 3]), (simhash.dedup(df), [1, 3])):
        assert out.columns == df.columns
        assert sorted((r.doc_id, r["__digest"], r["__gone"], r["__text"]) for r in out.collect()) == [(i, *["mine"] * 3) for i in kept]


def test_hot_joins_are_between_plain_exchanges(spark, docs):
    """Skewed partitions can be split only if no operator stands between a join and its exchanges."""
    df = docs([(i, "hot text" if i % 3 else f"text {i}") for i in range(60)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hashed = exact_dedup.text_digests(df)
        plan = exact_dedup.possibly_repeated(hashed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Aggregate" not in plan
