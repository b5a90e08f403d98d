"""Registered queries over the given tables, each with an equivalent DuckDB SQL.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables.  Doubles are presented at 6 decimals (HALF_UP, Spark's
``round``); the SQL side reproduces that rounding exactly through a decimal
cast, so both engines present identical values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import LIMBS, content_hash
from tessera.session import materialize, shared_copy, shared_path
from tessera.sources import hash_tree
from tessera.functions.parse import (
    file_basename,
    format_ptbr_number,
    month_key,
    month_of,
    ntz_text,
    parse_br_date,
    parse_comma_decimal,
    parse_ptbr_number,
    year_of,
)
from tessera.operators import gold, panel, quality
from tessera.operators.basic import (
    dedupe_earliest,
    dedupe_latest,
    distinct_values,
    drop_header_rows,
    duplicate_keys,
    keep_series,
    layer_counts,
    union_ledger,
)
from tessera.operators.correlate import correlated_pairs
from tessera.operators.joins import first_of_new, temporal_join
from tessera.operators.scan import range_scan
from tessera.operators.silver import conform, dominant_series, gold_prep
from tessera.operators.states import StoredStates, metrics_from_states, pair_states
from tessera.plans.series import (
    cents,
    daily_events,
    index_series,
    month_of_ts,
    price_series,
    priority_panel,
    table,
)
from tessera.functions.rules import DEFAULT_LABELS as LABELS
from tessera.functions.rules import pct_change_expr
from tessera.sources.files import hash_files, landing_line, payload_items
from tessera.sources.hash_index import HashIndex
from tessera.sources.ingest import HEADER_NAMES, bronze_from_payload, canonicalize, payload_hash, with_lineage
from tessera.sources.sinks import split_write

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column to ``digits`` decimals (HALF_UP)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- SQL pieces


def hu(x: str, d: int) -> str:
    """Spark-compatible HALF_UP rounding of a DuckDB double expression."""
    return f"round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d})::DOUBLE"


def r6(x: str) -> str:
    return hu(x, 6)


def month(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS DATE)"


def mean_cents(c: str, scale: str = " / 100") -> str:
    return f"SUM(CAST(round({c} * 100) AS BIGINT)) / COUNT(*){scale}"


CTE_P = f"""P AS (
  SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, preco_boi_gordo
  FROM (SELECT {month('o_orderdate')} AS data, {mean_cents('o_totalprice')} AS preco_boi_gordo
        FROM orders GROUP BY 1))"""

CTE_I = f"""I AS (
  SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, ipca_mensal
  FROM (SELECT {month('l_shipdate')} AS data, {mean_cents('l_discount', '')} AS ipca_mensal
        FROM lineitem GROUP BY 1))"""

CTE_I7 = f"""I7 AS (
  SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, ipca_mensal, series_id
  FROM (SELECT {month('l_shipdate')} AS data, CAST(l_linenumber AS INTEGER) AS series_id,
               {mean_cents('l_discount', '')} AS ipca_mensal
        FROM lineitem GROUP BY 1, 2))"""

CTE_J = f"""{CTE_P}, {CTE_I},
J AS (SELECT p.data, coalesce(p.ano, i.ano) AS ano, coalesce(p.mes, i.mes) AS mes, p.preco_boi_gordo, i.ipca_mensal
      FROM P p JOIN I i ON p.data = i.data)"""

CTE_INS = f"""{CTE_J},
L AS (SELECT *, lag(ipca_mensal) OVER (ORDER BY data) AS ipca_ant,
                lag(preco_boi_gordo) OVER (ORDER BY data) AS boi_ant FROM J),
INS AS (SELECT data, ano, mes, preco_boi_gordo, ipca_mensal,
               (ipca_mensal - ipca_ant) / nullif(ipca_ant, 0) * 100 AS variacao_ipca,
               (preco_boi_gordo - boi_ant) / nullif(boi_ant, 0) * 100 AS variacao_boi FROM L)"""

SQL_DESTAQUE = f"""CASE WHEN variacao_boi > variacao_ipca THEN '{LABELS.price_leads}'
       WHEN variacao_ipca > variacao_boi THEN '{LABELS.index_leads}' ELSE '{LABELS.tie}' END"""
SQL_CLASSE = f"""CASE WHEN abs(variacao_boi - variacao_ipca) > {LABELS.hi} THEN '{LABELS.high}'
       WHEN abs(variacao_boi - variacao_ipca) BETWEEN {LABELS.lo} AND {LABELS.hi} THEN '{LABELS.medium}'
       ELSE '{LABELS.low}' END"""
SQL_MEDIA = hu("(variacao_ipca + variacao_boi) / 2", 2)

CTE_GLOBAL = f"""B AS (SELECT variacao_ipca AS i, variacao_boi AS p FROM INS
           WHERE variacao_ipca IS NOT NULL AND variacao_boi IS NOT NULL),
G0 AS (SELECT covar_pop(i, p) / nullif(stddev_pop(i) * stddev_pop(p), 0) AS correlacao_global,
              avg(i) AS media_ipca_global, avg(p) AS media_boi_global FROM B),
G AS (SELECT *, {hu('(media_ipca_global + media_boi_global) / 2', 4)} AS media_combinada_global FROM G0)"""

CTE_PANEL = f"""PN AS (SELECT o_orderpriority AS series, {month('o_orderdate')} AS data,
                  {mean_cents('o_totalprice')} AS valor FROM orders GROUP BY 1, 2)"""
CTE_DAILY = f"""DY AS (SELECT event_type AS series, CAST(ts AS DATE) AS data,
                  {mean_cents('value')} AS valor FROM events GROUP BY 1, 2)"""


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    """Gold-prep join of P and I; branches of a plan that both read it reuse its shuffled aggregates."""
    p = price_series(spark, sf)
    i = index_series(spark, sf).drop("series_id")
    return temporal_join(p, i, on=["data"], how="inner", coalesce_cols=["ano", "mes"])


# ------------------------------------------------------------ gold (flagship)


@register(
    "analytic",
    f"""WITH {CTE_INS}, {CTE_GLOBAL},
R AS (SELECT *, {SQL_MEDIA} AS media_variacoes, {SQL_DESTAQUE} AS destaque, {SQL_CLASSE} AS classe_impacto FROM INS)
SELECT data, ano, mes, {r6('preco_boi_gordo')} AS preco_boi_gordo, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {r6('media_variacoes')} AS media_variacoes, destaque, classe_impacto,
       {r6('correlacao_global')} AS correlacao_global, {r6('media_ipca_global')} AS media_ipca_global,
       {r6('media_boi_global')} AS media_boi_global, {r6('media_combinada_global')} AS media_combinada_global
FROM R CROSS JOIN G""",
)
def q_analytic(spark, sf):
    return gold.analytic(_joined(spark, sf))


@register(
    "insights",
    f"""WITH {CTE_INS}
SELECT data, ano, mes, {r6('preco_boi_gordo')} AS preco_boi_gordo, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi FROM INS""",
)
def q_insights(spark, sf):
    return gold.insights(_joined(spark, sf))


@register(
    "global_metrics",
    f"""WITH {CTE_INS}, {CTE_GLOBAL}
SELECT {r6('correlacao_global')} AS correlacao_global, {r6('media_ipca_global')} AS media_ipca_global,
       {r6('media_boi_global')} AS media_boi_global, {r6('media_combinada_global')} AS media_combinada_global FROM G""",
)
def q_global_metrics(spark, sf):
    return gold.global_metrics(gold.insights(_joined(spark, sf)))


@register(
    "mean_change",
    f"""WITH {CTE_INS}
SELECT data, {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {r6(SQL_MEDIA)} AS media_variacoes FROM INS""",
)
def q_mean_change(spark, sf):
    return gold.classify(gold.insights(_joined(spark, sf))).select(
        "data", "variacao_ipca", "variacao_boi", "media_variacoes"
    )


@register(
    "leader_flag",
    f"""WITH {CTE_INS}
SELECT data, {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {SQL_DESTAQUE} AS destaque FROM INS""",
)
def q_leader_flag(spark, sf):
    return gold.classify(gold.insights(_joined(spark, sf))).select(
        "data", "variacao_ipca", "variacao_boi", "destaque"
    )


@register(
    "impact_class",
    f"""WITH {CTE_INS}
SELECT data, {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {SQL_CLASSE} AS classe_impacto FROM INS""",
)
def q_impact_class(spark, sf):
    return gold.classify(gold.insights(_joined(spark, sf))).select(
        "data", "variacao_ipca", "variacao_boi", "classe_impacto"
    )


DASHBOARD_VIEW = "vw_gold_dashboard"


@register(
    "dashboard_view",
    f"""WITH {CTE_INS}
SELECT data, {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {SQL_DESTAQUE} AS destaque, {SQL_CLASSE} AS classe_impacto FROM INS""",
)
def q_dashboard_view(spark, sf):
    gold.analytic(_joined(spark, sf)).createOrReplaceTempView(DASHBOARD_VIEW)
    return gold.dashboard(spark.table(DASHBOARD_VIEW))


# ------------------------------------------------------- joins and windows


@register(
    "temporal_join",
    f"""WITH {CTE_J}
SELECT data, ano, mes, {r6('preco_boi_gordo')} AS preco_boi_gordo, {r6('ipca_mensal')} AS ipca_mensal FROM J""",
)
def q_temporal_join(spark, sf):
    return _joined(spark, sf)


@register(
    "temporal_join_left",
    f"""WITH {CTE_P}, {CTE_I}
SELECT i.data, coalesce(i.ano, p.ano) AS ano, coalesce(i.mes, p.mes) AS mes,
       {r6('i.ipca_mensal')} AS ipca_mensal, {r6('p.preco_boi_gordo')} AS preco_boi_gordo
FROM I i LEFT JOIN P p ON i.data = p.data""",
)
def q_temporal_join_left(spark, sf):
    i = index_series(spark, sf).drop("series_id")
    p = price_series(spark, sf)
    return temporal_join(i, p, on=["data"], how="left", coalesce_cols=["ano", "mes"])


@register(
    "gold_prep",
    f"""WITH {CTE_P}, {CTE_I7},
C AS (SELECT series_id, COUNT(*) AS n FROM I7 GROUP BY series_id),
CH AS (SELECT series_id FROM C ORDER BY n DESC, series_id ASC LIMIT 1),
X AS (SELECT * FROM I7 WHERE series_id IN (SELECT series_id FROM CH))
SELECT p.data, coalesce(p.ano, x.ano) AS ano, coalesce(p.mes, x.mes) AS mes,
       {r6('p.preco_boi_gordo')} AS preco_boi_gordo, {r6('x.ipca_mensal')} AS ipca_mensal
FROM P p JOIN X x ON p.data = x.data""",
)
def q_gold_prep(spark, sf):
    at = F.lit(RUN_TS).cast("timestamp_ntz").alias("ingested_at_utc")
    price = price_series(spark, sf).select("*", at, F.lit("orders").alias("file_hash"))
    index = materialize(index_series(spark, sf, by_line=True)).select("*", at, F.lit("lineitem").alias("payload_hash"))
    return gold_prep(price, index, how="inner")


@register(
    "dominant_series",
    f"""WITH {CTE_I7},
C AS (SELECT series_id, COUNT(*) AS n FROM I7 GROUP BY series_id),
CH AS (SELECT series_id FROM C ORDER BY n DESC, series_id ASC LIMIT 1)
SELECT data, ano, mes, {r6('ipca_mensal')} AS ipca_mensal, series_id
FROM I7 WHERE series_id IN (SELECT series_id FROM CH)""",
)
def q_dominant_series(spark, sf):
    return dominant_series(materialize(index_series(spark, sf, by_line=True)), "series_id")


@register(
    "lag_prev",
    f"""WITH {CTE_J}
SELECT data, ano, mes, {r6('preco_boi_gordo')} AS preco_boi_gordo, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('lag(ipca_mensal) OVER (ORDER BY data)')} AS ipca_ant,
       {r6('lag(preco_boi_gordo) OVER (ORDER BY data)')} AS boi_ant FROM J""",
)
def q_lag_prev(spark, sf):
    return gold.lag_prev(_joined(spark, sf), {"ipca_ant": "ipca_mensal", "boi_ant": "preco_boi_gordo"})


@register(
    "pct_change",
    f"""WITH {CTE_I},
L AS (SELECT data, ipca_mensal, lag(ipca_mensal) OVER (ORDER BY data) AS prev FROM I)
SELECT data, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('(ipca_mensal - prev) / nullif(prev, 0) * 100')} AS variacao_ipca FROM L""",
)
def q_pct_change(spark, sf):
    i = index_series(spark, sf).select("data", "ipca_mensal")
    return gold.pct_change(i, {"variacao_ipca": "ipca_mensal"})


# ---------------------------------------------------- silver and dedupe


@register(
    "silver_conform",
    """SELECT data, ano, mes, valor, serie, event_id, ingested_at_utc FROM (
  SELECT CAST(ts AS DATE) AS data, CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes,
         value AS valor, event_type AS serie, event_id, ts AS ingested_at_utc,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts IS NOT NULL) WHERE rn = 1""",
)
def q_silver_conform(spark, sf):
    e = table(spark, sf, "events")
    mapping = {
        "data": F.col("ts").cast("date"),
        "ano": F.year("ts"),
        "mes": F.month("ts"),
        "valor": F.col("value").cast("double"),
        "serie": F.col("event_type"),
        "event_id": F.col("event_id"),
        "ingested_at_utc": F.col("ts"),
    }
    return conform(e, mapping, key=["serie", "data"], order=["ingested_at_utc", "event_id"])


@register(
    "dedupe_latest",
    f"""SELECT event_id, ts, user_id, event_type, {r6('value')} AS value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def q_dedupe_latest(spark, sf):
    return dedupe_latest(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@register(
    "duplicate_keys",
    """SELECT sha256(text) AS file_hash, COUNT(*) AS n FROM documents GROUP BY 1 HAVING COUNT(*) > 1""",
)
def q_duplicate_keys(spark, sf):
    d = table(spark, sf, "documents").select(content_hash("text").alias("file_hash"))
    return duplicate_keys(d, "file_hash")


@register("distinct_hashes", """SELECT DISTINCT sha256(text) AS file_hash FROM documents""")
def q_distinct_hashes(spark, sf):
    d = table(spark, sf, "documents").select(content_hash("text").alias("file_hash"))
    return distinct_values(d, "file_hash")


@register(
    "content_hash",
    """SELECT doc_id, sha256(text) AS file_hash, CAST(strlen(text) AS BIGINT) AS length FROM documents""",
)
def q_content_hash(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id",
        content_hash("text").alias("file_hash"),
        F.octet_length("text").cast("bigint").alias("length"),
    )


@register(
    "layer_counts",
    f"""WITH {CTE_J}
SELECT 'bronze_price' AS layer, COUNT(*) AS n FROM orders
UNION ALL SELECT 'bronze_index', COUNT(*) FROM lineitem
UNION ALL SELECT 'silver_price', COUNT(*) FROM P
UNION ALL SELECT 'silver_index', COUNT(*) FROM I
UNION ALL SELECT 'gold', COUNT(*) FROM J""",
)
def q_layer_counts(spark, sf):
    """Two fact scans: the monthly aggregates carry their row counts, and one join meets them all."""
    p = price_series(spark, sf, rows="p_rows").select("data", "p_rows")
    i = index_series(spark, sf, rows="i_rows").select("data", "i_rows")
    return layer_counts(
        p.join(i, "data", "full"),
        {
            "bronze_price": F.coalesce(F.sum("p_rows"), F.lit(0)),
            "bronze_index": F.coalesce(F.sum("i_rows"), F.lit(0)),
            "silver_price": F.count("p_rows"),
            "silver_index": F.count("i_rows"),
            "gold": F.count_if(F.col("p_rows").isNotNull() & F.col("i_rows").isNotNull()),
        },
    )


# ------------------------------------------------------ ingestion stand-ins
# Two ingest batches of `documents`, both read whole: documents with an even
# number are in the ledger already, those with an odd one (or none) arrive now.


def ledgered():
    """True for rows of the batch that the ledger has."""
    return F.coalesce(F.pmod("doc_id", F.lit(2)) == 0, F.lit(False))


SQL_BATCHES = """D AS (SELECT doc_id, sha256(text) AS file_hash, source, coalesce(doc_id % 2 = 0, false) AS old FROM documents)"""


def _docs_hashed(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", "source", content_hash("text").alias("file_hash"), ledgered().alias("old")
    )


@register(
    "idempotent_ingest",
    f"""WITH {SQL_BATCHES},
F AS (SELECT * FROM D WHERE NOT old AND file_hash IS NOT NULL
      AND file_hash NOT IN (SELECT file_hash FROM D WHERE old AND file_hash IS NOT NULL))
SELECT doc_id, file_hash, source FROM (
  SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY doc_id, source) AS rn FROM F) WHERE rn = 1""",
)
def q_idempotent_ingest(spark, sf):
    """The ledgered batch becomes a hash index, and the arriving batch's hashes are anti-joined with it."""
    d = _docs_hashed(spark, sf)
    index = HashIndex(spark, shared_path(spark, "hash-index"))
    index.add(d.filter("old"))
    arriving = dedupe_earliest(
        d.filter(~F.col("old") & F.col("file_hash").isNotNull()).drop("old"), ["file_hash"], ["doc_id", "source"]
    )
    return index.new_only(arriving).select("doc_id", "file_hash", "source")


@register(
    "hash_exists",
    f"""WITH {SQL_BATCHES}
SELECT doc_id, EXISTS (SELECT 1 FROM D k WHERE k.old AND k.file_hash = d.file_hash) AS already_ingested
FROM D d WHERE NOT old""",
)
def q_hash_exists(spark, sf):
    d = _docs_hashed(spark, sf)
    known = distinct_values(d.filter("old"), "file_hash").withColumnRenamed("file_hash", "_h")
    return (
        d.filter(~F.col("old"))
        .join(known, F.col("file_hash") == F.col("_h"), "left")
        .select("doc_id", F.col("_h").isNotNull().alias("already_ingested"))
    )


@register(
    "hash_probe",
    f"""WITH {SQL_BATCHES}, L AS (SELECT * FROM D WHERE NOT old ORDER BY doc_id DESC LIMIT 1)
SELECT doc_id, file_hash, EXISTS (SELECT 1 FROM D k WHERE k.old AND k.file_hash = L.file_hash) AS already_ingested FROM L""",
)
def q_hash_probe(spark, sf):
    """Point probe (P9, O3) of the newest arrival's hash among the ledgered ones, in one lazy plan."""
    d = _docs_hashed(spark, sf)
    newest = d.filter(~F.col("old")).orderBy(F.desc("doc_id")).limit(1).select("doc_id", "file_hash")
    known = d.filter("old").select(F.col("file_hash").alias("_h"))
    found = newest.join(known, F.col("file_hash") == F.col("_h"), "left")
    return found.groupBy("doc_id", "file_hash").agg(F.bool_or(F.col("_h").isNotNull()).alias("already_ingested"))


def _ledger_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "file_hash",
        F.col("source").alias("source_file"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("csv_file"),
    )


@register(
    "manifest_union",
    f"""WITH {SQL_BATCHES},
F AS (SELECT * FROM D WHERE NOT old AND file_hash IS NOT NULL
      AND file_hash NOT IN (SELECT file_hash FROM D WHERE old AND file_hash IS NOT NULL)),
NEW AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY doc_id, source) AS rn FROM F) WHERE rn = 1)
SELECT file_hash, source AS source_file, 'doc_' || CAST(doc_id AS VARCHAR) || '.csv' AS csv_file FROM D WHERE old
UNION ALL
SELECT file_hash, source AS source_file, 'doc_' || CAST(doc_id AS VARCHAR) || '.csv' AS csv_file FROM NEW""",
)
def q_manifest_union(spark, sf):
    d = _docs_hashed(spark, sf)
    return union_ledger(_ledger_rows(d.filter("old")), _ledger_rows(first_of_new(d, "file_hash", "old", ["doc_id", "source"])))


PAYLOAD_COLS = ["event_id", "user_id", "event_type", "props"]


SQL_LIMBS = [
    f"CAST(SUM(CAST(('0x' || substr(h, {at}, {n}))::BIGINT AS HUGEINT)) AS VARCHAR)" for at, n in LIMBS
]


@register(
    "payload_hash",
    f"""WITH R AS (SELECT event_type,
    sha256(to_json({{'event_id': event_id, 'event_type': event_type, 'props': props, 'user_id': user_id}})) AS h
  FROM events)
SELECT event_type, COUNT(*) AS n_rows,
  sha256(CAST(COUNT(*) AS VARCHAR) || ':' || {" || ':' || ".join(SQL_LIMBS)}) AS payload_hash
FROM R GROUP BY event_type""",
)
def q_payload_hash(spark, sf):
    return payload_hash(table(spark, sf, "events"), PAYLOAD_COLS, batch=["event_type"])


RUN_ID = "run-0001"
RUN_TS = "2025-01-01 00:00:00"
PAYLOAD_META = {
    "source": "lineitem",
    "data_inicial": "01/01/1992",
    "data_final": "31/12/1998",
    "request_url": "parquet:lineitem",
    "payload_hash": "lineitem-discount",
    "ingest_run_id": RUN_ID,
}


@register(
    "bronze_payload",
    f"""SELECT CAST(l_shipdate AS DATE) AS data_ref, {r6('l_discount')} AS valor, 'lineitem' AS source,
       CAST(l_linenumber AS INTEGER) AS series_id, '01/01/1992' AS data_inicial, '31/12/1998' AS data_final,
       'parquet:lineitem' AS request_url, 'lineitem-discount' AS payload_hash, '{RUN_ID}' AS ingest_run_id,
       TIMESTAMP '{RUN_TS}' AS ingested_at_utc, CAST(year(l_shipdate) AS INTEGER) AS ano,
       CAST(month(l_shipdate) AS INTEGER) AS mes FROM lineitem""",
)
def q_bronze_payload(spark, sf):
    li = table(spark, sf, "lineitem")
    payload = li.select(
        ntz_text("l_shipdate", "dd/MM/yyyy").alias("data"),
        F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(",")).alias("valor"),
        F.col("l_linenumber").alias("series_id"),
    )
    meta = {**PAYLOAD_META, "series_id": F.col("series_id")}
    return bronze_from_payload(payload, meta, run_ts=RUN_TS)


def _landed_rows(spark, sf, month_layout: str, file_key: str = "l_orderkey") -> DataFrame:
    """lineitem rows as landed CSV rows: one "file" per key, month text, value."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.concat(F.lit("orders_"), F.col(file_key).cast("string"), F.lit(".csv")).alias("csv_file"),
        ntz_text("l_shipdate", month_layout).alias("mes_ano"),
        F.col("l_extendedprice").alias("valor"),
    )


def _orders_ledger(orders: DataFrame) -> DataFrame:
    """orders as the file ledger: one entry (name, source, content hash, time) per order."""
    name = F.col("o_orderkey").cast("string")
    return orders.select(
        F.concat(F.lit("orders_"), name, F.lit(".csv")).alias("csv_file"),
        F.concat(F.lit("orders_"), name, F.lit(".xlsx")).alias("source_file"),
        F.sha2(F.concat_ws("|", "o_orderstatus", "o_orderpriority", name), 256).alias("file_hash"),
        ntz_text("o_orderdate", "yyyy-MM-ddTHH:mm:ssZ").alias("converted_at_utc"),
    )


@register(
    "bronze_lineage",
    f"""WITH R AS (SELECT 'orders_' || CAST(l_orderkey AS VARCHAR) || '.csv' AS csv_file,
       strftime(l_shipdate, '%m/%Y') AS mes_ano, l_extendedprice AS valor FROM lineitem),
M AS (SELECT 'orders_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS csv_file,
       'orders_' || CAST(o_orderkey AS VARCHAR) || '.xlsx' AS source_file,
       sha256(o_orderstatus || '|' || o_orderpriority || '|' || CAST(o_orderkey AS VARCHAR)) AS file_hash,
       o_orderdate AS converted_at_utc FROM orders)
SELECT R.csv_file, R.mes_ano, {r6('R.valor')} AS valor, M.source_file, M.file_hash, M.converted_at_utc,
       '{RUN_ID}' AS ingest_run_id, TIMESTAMP '{RUN_TS}' AS ingested_at_utc,
       CAST(substr(R.mes_ano, 1, 2) AS INTEGER) AS mes, CAST(substr(R.mes_ano, 4, 4) AS INTEGER) AS ano
FROM R LEFT JOIN M ON R.csv_file = M.csv_file""",
)
def q_bronze_lineage(spark, sf):
    rows = _landed_rows(spark, sf, "MM/yyyy")
    return with_lineage(rows, _orders_ledger(table(spark, sf, "orders")), RUN_ID, run_ts=RUN_TS)


@register(
    "dq_bronze_rules",
    f"""WITH R AS (SELECT 'orders_' || CAST(l_partkey AS VARCHAR) || '.csv' AS csv_file,
       CAST(month(l_shipdate) AS VARCHAR) || '/' || strftime(l_shipdate, '%Y') AS mes_ano FROM lineitem),
M AS (SELECT 'orders_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS csv_file,
       sha256(o_orderstatus || '|' || o_orderpriority || '|' || CAST(o_orderkey AS VARCHAR)) AS file_hash,
       'orders_' || CAST(o_orderkey AS VARCHAR) || '.xlsx' AS source_file
      FROM orders),
B AS (SELECT R.mes_ano, M.file_hash, M.source_file FROM R LEFT JOIN M ON R.csv_file = M.csv_file)
SELECT 'mes_ano_format' AS rule,
       COUNT(*) FILTER (WHERE mes_ano IS NOT NULL AND NOT regexp_matches(mes_ano, '^(0[1-9]|1[0-2])/[0-9]{{4}}$')) AS n_violations,
       COUNT(*) AS n_rows FROM B
UNION ALL SELECT 'mes_ano_null', COUNT(*) FILTER (WHERE mes_ano IS NULL), COUNT(*) FROM B
UNION ALL SELECT 'file_hash_null', COUNT(*) FILTER (WHERE file_hash IS NULL), COUNT(*) FROM B
UNION ALL SELECT 'source_file_null', COUNT(*) FILTER (WHERE source_file IS NULL), COUNT(*) FROM B""",
)
def q_dq_bronze_rules(spark, sf):
    """Bronze rules in one pass over landed rows, one "file" per part number and
    month text 'M/yyyy': files whose number is no order key are not in the ledger."""
    rows = _landed_rows(spark, sf, "M/yyyy", file_key="l_partkey")
    bronze = with_lineage(rows, _orders_ledger(table(spark, sf, "orders")), RUN_ID, run_ts=RUN_TS)
    return quality.rule_report(bronze, quality.bronze_rules())


# ------------------------------------------------------- parsing functions


# Raw sheet cells of every order, dirtied by its key: repeated headers, cells that are no number,
# months that are none, empty cells; a no-break space and a one-digit month are still good.
SQL_RAW = f"""RAW AS (SELECT o_orderkey, o_orderdate, o_totalprice, o_orderkey % 16 AS k FROM orders)"""


def _raw_pairs(spark, sf) -> DataFrame:
    k = F.pmod("o_orderkey", F.lit(16))
    month, price = ntz_text("o_orderdate", "M/yyyy"), format_ptbr_number("o_totalprice")
    data = (
        F.when(k == 0, F.lit("Data"))
        .when(k == 1, F.concat(F.lit("13/"), F.year("o_orderdate").cast("string")))
        .when(k == 2, F.concat(F.lit("  "), ntz_text("o_orderdate", "MM/yyyy"), F.lit(" ")))
        .when(k == 3, F.lit(None))
        .otherwise(month)
    )
    valor = (
        F.when(k == 0, F.lit("VALOR"))
        .when(k == 4, F.lit("n/d"))
        .when(k == 5, F.concat(F.lit("\u00a0"), price, F.lit("\u00a0")))
        .when(k == 6, F.concat(price, F.lit(",00")))
        .when(k == 7, F.lit(""))
        .otherwise(price)
    )
    return table(spark, sf, "orders").select("o_orderkey", data.alias("data_raw"), valor.alias("valor_raw"))


@register(
    "landing_canonical",
    f"""WITH {SQL_RAW}
SELECT strftime(o_orderdate, '%m/%Y') AS mes_ano, {r6('round(o_totalprice, 2)')} AS valor
FROM RAW WHERE k NOT IN (0, 1, 3, 4, 6, 7)""",
)
def q_landing_canonical(spark, sf):
    return canonicalize(_raw_pairs(spark, sf))


@register(
    "header_rows",
    f"""WITH {SQL_RAW} SELECT o_orderkey FROM RAW WHERE k <> 0""",
)
def q_header_rows(spark, sf):
    """The header-row filter by itself (P6): bad cells that are no header stay."""
    return drop_header_rows(_raw_pairs(spark, sf), HEADER_NAMES).select("o_orderkey")


@register(
    "landing_lines",
    f"""SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%m/%Y') AS mes_ano, {r6('l_extendedprice')} AS valor FROM lineitem""",
)
def q_landing_lines(spark, sf):
    """Canonical landing lines parsed from text, FAILFAST."""
    line = F.concat_ws(",", ntz_text("l_shipdate", "MM/yyyy"), F.col("l_extendedprice").cast("string"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", line.alias("line"))
    return lines.select("l_orderkey", "l_linenumber", landing_line("line").alias("row")).select(
        "l_orderkey", "l_linenumber", "row.mes_ano", "row.valor"
    )


@register(
    "payload_items",
    """SELECT l_orderkey, strftime(l_shipdate, '%d/%m/%Y') AS data,
       replace(CAST(l_discount AS VARCHAR), '.', ',') AS valor FROM lineitem""",
)
def q_payload_items(spark, sf):
    """One JSON payload text per order, its items read back as rows."""
    item = F.struct(
        ntz_text("l_shipdate", "dd/MM/yyyy").alias("data"),
        F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(",")).alias("valor"),
    )
    payloads = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(item)).alias("payload"))
    return payloads.select("l_orderkey", F.inline(payload_items("payload")))


@register(
    "parse_ptbr_number",
    f"""SELECT o_orderkey, {r6('round(o_totalprice, 2)')} AS valor FROM orders""",
)
def q_parse_ptbr_number(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", parse_ptbr_number(format_ptbr_number("o_totalprice")).alias("valor"))


@register(
    "parse_comma_decimal",
    f"""SELECT l_orderkey, l_linenumber, {r6('l_discount')} AS valor FROM lineitem""",
)
def q_parse_comma_decimal(spark, sf):
    li = table(spark, sf, "lineitem")
    text = F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(","))
    return li.select("l_orderkey", "l_linenumber", parse_comma_decimal(text).alias("valor"))


@register("parse_br_date", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data FROM orders""")
def q_parse_br_date(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", parse_br_date(ntz_text("o_orderdate", "dd/MM/yyyy")).alias("data"))


@register(
    "derive_partitions",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
       CAST(year(o_orderdate) AS INTEGER) AS ano_d, CAST(month(o_orderdate) AS INTEGER) AS mes_d FROM orders""",
)
def q_derive_partitions(spark, sf):
    o = table(spark, sf, "orders")
    ma = ntz_text("o_orderdate", "MM/yyyy")
    dma = ntz_text("o_orderdate", "dd/MM/yyyy")
    return o.select(
        "o_orderkey",
        year_of(ma, "MM/yyyy").alias("ano"),
        month_of(ma, "MM/yyyy").alias("mes"),
        year_of(dma, "dd/MM/yyyy").alias("ano_d"),
        month_of(dma, "dd/MM/yyyy").alias("mes_d"),
    )


@register(
    "month_key",
    """SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS data FROM orders""",
)
def q_month_key(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", month_key(F.year("o_orderdate"), F.month("o_orderdate")).alias("data"))


@register(
    "file_basename",
    """SELECT page_id, url_decode(replace(regexp_extract(url, '([^/]+)$', 1), '+', '%2B')) AS file_name FROM pages""",
)
def q_file_basename(spark, sf):
    return table(spark, sf, "pages").select("page_id", file_basename("url").alias("file_name"))


@register(
    "hash_files",
    """SELECT regexp_extract(filename, '([^/]+)$', 1) AS file_name, sha256(content) AS file_hash,
       CAST(size AS BIGINT) AS length FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
)
def q_hash_files(spark, sf):
    return hash_files(spark, sf, "*.parquet").select("file_name", "file_hash", "length")


# ------------------------------------------------------------ data quality


@register(
    "dq_month_format",
    """SELECT o_orderpriority, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE t IS NOT NULL AND NOT regexp_matches(t, '^(0[1-9]|1[0-2])/[0-9]{4}$')) AS n_invalid,
       COUNT(*) FILTER (WHERE t IS NULL) AS n_null
FROM (SELECT o_orderpriority, CAST(month(o_orderdate) AS VARCHAR) || '/' || strftime(o_orderdate, '%Y') AS t FROM orders)
GROUP BY o_orderpriority""",
)
def q_dq_month_format(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderpriority", ntz_text("o_orderdate", "M/yyyy").alias("t")
    )
    return quality.pattern_report(o, "t", by=["o_orderpriority"])


@register(
    "quarantine_split",
    """SELECT o_orderkey, CASE WHEN r = '' THEN 'good' ELSE 'bad' END AS status, r AS reasons
FROM (SELECT o_orderkey, concat_ws(',',
        CASE WHEN t IS NULL OR NOT regexp_matches(t, '^(0[1-9]|1[0-2])/[0-9]{4}$') THEN 'invalid mes_ano' END,
        CASE WHEN v IS NULL THEN 'without valor' END) AS r
      FROM (SELECT o_orderkey, CAST(month(o_orderdate) AS VARCHAR) || '/' || strftime(o_orderdate, '%Y') AS t,
                   CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS v FROM orders))""",
)
def q_quarantine_split(spark, sf):
    """One write of all orders, split into good and bad rows; both sides are read back."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        ntz_text("o_orderdate", "M/yyyy").alias("mes_ano"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("valor"),
    )
    month = F.col("mes_ano")
    rules = {
        "invalid mes_ano": month.isNull() | ~month.rlike(quality.MONTH_TEXT),
        "without valor": F.col("valor").isNull(),
    }
    split = split_write(rows, shared_path(spark, "quarantine"), rules)
    good = split.good.select("o_orderkey", F.lit("good").alias("status"), F.lit("").alias("reasons"))
    bad = split.bad.select("o_orderkey", F.lit("bad").alias("status"), F.array_join("_reasons", ",").alias("reasons"))
    return good.unionByName(bad)


def _dirty_customers(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"),
    )


@register(
    "dq_not_null",
    """WITH C AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
                  nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
SELECT 'c_custkey' AS "column", COUNT(*) FILTER (WHERE c_custkey IS NULL) AS n_null, COUNT(*) AS n_rows FROM C
UNION ALL SELECT 'c_name', COUNT(*) FILTER (WHERE c_name IS NULL), COUNT(*) FROM C
UNION ALL SELECT 'c_nationkey', COUNT(*) FILTER (WHERE c_nationkey IS NULL), COUNT(*) FROM C
UNION ALL SELECT 'c_acctbal', COUNT(*) FILTER (WHERE c_acctbal IS NULL), COUNT(*) FROM C
UNION ALL SELECT 'c_mktsegment', COUNT(*) FILTER (WHERE c_mktsegment IS NULL), COUNT(*) FROM C""",
)
def q_dq_not_null(spark, sf):
    return quality.null_report(_dirty_customers(spark, sf))


ORDERS_CONTRACT = {
    "o_orderkey": "bigint",
    "o_custkey": "int",
    "o_totalprice": "double",
    "o_orderdate": "date",
    "o_orderpriority": "int",
    "o_comment": "string",
}


@register(
    "schema_contract",
    """WITH U AS (SELECT
    COUNT(*) FILTER (WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS INTEGER) IS NULL) AS u_custkey,
    COUNT(*) FILTER (WHERE o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS DATE) IS NULL) AS u_orderdate,
    COUNT(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS u_priority
  FROM orders)
SELECT 'o_orderkey' AS "column", 'ok' AS status, 'bigint' AS actual, 'bigint' AS expected, CAST(NULL AS BIGINT) AS n_uncastable
UNION ALL SELECT 'o_custkey', 'wrong_type', 'bigint', 'int', (SELECT u_custkey FROM U)
UNION ALL SELECT 'o_totalprice', 'ok', 'double', 'double', NULL
UNION ALL SELECT 'o_orderdate', 'wrong_type', 'timestamp_ntz', 'date', (SELECT u_orderdate FROM U)
UNION ALL SELECT 'o_orderpriority', 'wrong_type', 'string', 'int', (SELECT u_priority FROM U)
UNION ALL SELECT 'o_comment', 'missing', NULL, 'string', NULL
UNION ALL SELECT 'o_orderstatus', 'extra', 'string', NULL, NULL""",
)
def q_schema_contract(spark, sf):
    return quality.schema_contract(table(spark, sf, "orders"), ORDERS_CONTRACT)


# ------------------------------------------------------ roadmap operators


@register(
    "deflated_price",
    f"""WITH {CTE_J},
D AS (SELECT data, preco_boi_gordo, ipca_mensal,
        exp(sum(CASE WHEN ipca_mensal > -100 THEN ln(1 + ipca_mensal / 100) END)
            OVER (ORDER BY data ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS indice_acumulado FROM J)
SELECT data, {r6('preco_boi_gordo')} AS preco_boi_gordo, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('indice_acumulado')} AS indice_acumulado, {r6('preco_boi_gordo / indice_acumulado')} AS preco_deflacionado FROM D""",
)
def q_deflated_price(spark, sf):
    j = _joined(spark, sf).select("data", "preco_boi_gordo", "ipca_mensal")
    return panel.deflate(j, "preco_boi_gordo", "ipca_mensal")


@register(
    "accum_12m",
    f"""WITH {CTE_I},
A AS (SELECT data, ipca_mensal,
        count(CASE WHEN ipca_mensal > -100 THEN 1 END) OVER w AS n,
        sum(CASE WHEN ipca_mensal > -100 THEN ln(1 + ipca_mensal / 100) END) OVER w AS s
      FROM I WINDOW w AS (ORDER BY data ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT data, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('CASE WHEN n = 12 THEN (exp(s) - 1) * 100 END')} AS acumulado_12m FROM A""",
)
def q_accum_12m(spark, sf):
    i = index_series(spark, sf).select("data", "ipca_mensal")
    return panel.accumulate(i, "ipca_mensal", k=12)


def _period_sql(quarter: bool) -> str:
    q_sel = ", CAST(quarter(data) AS INTEGER) AS trimestre" if quarter else ""
    q_grp = ", 2" if quarter else ""
    return f"""WITH {CTE_P}
SELECT CAST(year(data) AS INTEGER) AS ano{q_sel}, {r6('avg(preco_boi_gordo)')} AS media,
       {r6('min(preco_boi_gordo)')} AS minimo, {r6('max(preco_boi_gordo)')} AS maximo,
       {r6('arg_max(preco_boi_gordo, data)')} AS ultimo, COUNT(*) AS n_meses
FROM P GROUP BY 1{q_grp}"""


@register("quarterly_agg", _period_sql(True))
def q_quarterly_agg(spark, sf):
    return panel.period_agg(price_series(spark, sf), "quarter", "preco_boi_gordo")


@register("yearly_agg", _period_sql(False))
def q_yearly_agg(spark, sf):
    return panel.period_agg(price_series(spark, sf), "year", "preco_boi_gordo")


@register(
    "period_rollup",
    f"""WITH {CTE_P}
SELECT CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre,
       {r6('avg(preco_boi_gordo)')} AS media, {r6('min(preco_boi_gordo)')} AS minimo,
       {r6('max(preco_boi_gordo)')} AS maximo, {r6('arg_max(preco_boi_gordo, data)')} AS ultimo,
       COUNT(*) AS n_meses
FROM P GROUP BY ROLLUP (1, 2) HAVING CAST(year(data) AS INTEGER) IS NOT NULL""",
)
def q_period_rollup(spark, sf):
    return panel.period_rollup(price_series(spark, sf), "preco_boi_gordo")


@register(
    "moving_avg",
    f"""WITH {CTE_DAILY},
M AS (SELECT *, count(*) OVER w AS n, avg(valor) OVER w AS a FROM DY
      WINDOW w AS (PARTITION BY series ORDER BY data ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT series, data, {r6('valor')} AS valor, {r6('CASE WHEN n = 3 THEN a END')} AS media_movel_3 FROM M""",
)
def q_moving_avg(spark, sf):
    return panel.moving_avg(daily_events(spark, sf), "valor", k=3, by=["series"])


@register(
    "volatility",
    f"""WITH {CTE_DAILY},
C AS (SELECT *, (valor - lag(valor) OVER (PARTITION BY series ORDER BY data))
                / nullif(lag(valor) OVER (PARTITION BY series ORDER BY data), 0) * 100 AS chg FROM DY)
SELECT series, data, {r6('valor')} AS valor,
       {r6('stddev_samp(chg) OVER (PARTITION BY series ORDER BY data ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS volatilidade_7
FROM C""",
)
def q_volatility(spark, sf):
    return panel.volatility(daily_events(spark, sf), "valor", k=7, by=["series"])


@register(
    "trend_slope",
    f"""WITH {CTE_PANEL}
SELECT series, {r6('regr_slope(valor, CAST(year(data) * 12 + month(data) AS DOUBLE))')} AS inclinacao,
       COUNT(valor) AS n_obs FROM PN GROUP BY series""",
)
def q_trend_slope(spark, sf):
    return panel.trend_slope(priority_panel(spark, sf), "valor", by=["series"])


@register(
    "rolling_corr",
    f"""WITH {CTE_INS},
M AS (SELECT *, CASE WHEN variacao_ipca IS NOT NULL AND variacao_boi IS NOT NULL THEN variacao_ipca END AS a,
                CASE WHEN variacao_ipca IS NOT NULL AND variacao_boi IS NOT NULL THEN variacao_boi END AS b FROM INS),
R AS (SELECT data, variacao_ipca, variacao_boi,
        covar_pop(a, b) OVER w / nullif(stddev_pop(a) OVER w * stddev_pop(b) OVER w, 0) AS c
      FROM M WINDOW w AS (ORDER BY data ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT data, {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {r6('c')} AS correlacao_12 FROM R""",
)
def q_rolling_corr(spark, sf):
    changes = (("variacao_ipca", "ipca_mensal"), ("variacao_boi", "preco_boi_gordo"))
    out = panel.rolling_change_corr(_joined(spark, sf), changes, k=12)
    return out.select("data", "variacao_ipca", "variacao_boi", "correlacao_12")


@register(
    "yoy_change",
    f"""WITH {CTE_PANEL}
SELECT a.series, a.data, {r6('a.valor')} AS valor,
       {r6('(a.valor - b.valor) / nullif(b.valor, 0) * 100')} AS variacao_12m
FROM PN a LEFT JOIN PN b ON a.series = b.series AND a.data = CAST(b.data + INTERVAL 12 MONTH AS DATE)""",
)
def q_yoy_change(spark, sf):
    return panel.yoy_change(priority_panel(spark, sf), "valor", by=["series"])


@register(
    "panel_pct_change",
    f"""WITH {CTE_PANEL},
L AS (SELECT *, lag(valor) OVER (PARTITION BY series ORDER BY data) AS prev FROM PN)
SELECT series, data, {r6('valor')} AS valor, {r6('(valor - prev) / nullif(prev, 0) * 100')} AS variacao FROM L""",
)
def q_panel_pct_change(spark, sf):
    return panel.panel_pct_change(priority_panel(spark, sf), "valor", "series")


@register(
    "panel_analytic",
    f"""WITH {CTE_PANEL}, {CTE_I},
J AS (SELECT p.series, p.data, p.valor AS preco_boi_gordo, i.ipca_mensal FROM PN p JOIN I i ON p.data = i.data),
L AS (SELECT *, lag(ipca_mensal) OVER w AS ipca_ant, lag(preco_boi_gordo) OVER w AS boi_ant
      FROM J WINDOW w AS (PARTITION BY series ORDER BY data)),
INS AS (SELECT series, data, preco_boi_gordo, ipca_mensal,
               (ipca_mensal - ipca_ant) / nullif(ipca_ant, 0) * 100 AS variacao_ipca,
               (preco_boi_gordo - boi_ant) / nullif(boi_ant, 0) * 100 AS variacao_boi FROM L),
B AS (SELECT series, variacao_ipca AS i, variacao_boi AS p FROM INS
      WHERE variacao_ipca IS NOT NULL AND variacao_boi IS NOT NULL),
G0 AS (SELECT series, covar_pop(i, p) / nullif(stddev_pop(i) * stddev_pop(p), 0) AS correlacao_global,
              avg(i) AS media_ipca_global, avg(p) AS media_boi_global FROM B GROUP BY series),
G AS (SELECT *, {hu('(media_ipca_global + media_boi_global) / 2', 4)} AS media_combinada_global FROM G0)
SELECT INS.series, INS.data, {r6('preco_boi_gordo')} AS preco_boi_gordo, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('variacao_ipca')} AS variacao_ipca, {r6('variacao_boi')} AS variacao_boi,
       {r6(SQL_MEDIA)} AS media_variacoes, {SQL_DESTAQUE} AS destaque, {SQL_CLASSE} AS classe_impacto,
       {r6('correlacao_global')} AS correlacao_global, {r6('media_ipca_global')} AS media_ipca_global,
       {r6('media_boi_global')} AS media_boi_global, {r6('media_combinada_global')} AS media_combinada_global
FROM INS LEFT JOIN G ON INS.series = G.series""",
)
def q_panel_analytic(spark, sf):
    """Every gold operator keyed by series (X9): each order-priority price series vs the index."""
    pn = priority_panel(spark, sf).withColumnRenamed("valor", "preco_boi_gordo")
    i = index_series(spark, sf).select("data", "ipca_mensal")
    j = temporal_join(pn, i, on=["data"], how="inner")
    return gold.analytic(j, gold.GoldSpec(by=("series",)))


@register(
    "panel_corr",
    f"""WITH {CTE_PANEL}, {CTE_I},
PC AS (SELECT series, data, (valor - lag(valor) OVER w) / nullif(lag(valor) OVER w, 0) * 100 AS chg
       FROM PN WINDOW w AS (PARTITION BY series ORDER BY data)),
IC AS (SELECT data, (ipca_mensal - lag(ipca_mensal) OVER (ORDER BY data))
                    / nullif(lag(ipca_mensal) OVER (ORDER BY data), 0) * 100 AS rchg FROM I),
X AS (SELECT series, CASE WHEN chg IS NOT NULL AND rchg IS NOT NULL THEN chg END AS a,
             CASE WHEN chg IS NOT NULL AND rchg IS NOT NULL THEN rchg END AS b
      FROM PC JOIN IC ON PC.data = IC.data)
SELECT series, {r6('covar_pop(a, b) / nullif(stddev_pop(a) * stddev_pop(b), 0)')} AS correlacao,
       COUNT(a) AS n_pares FROM X GROUP BY series""",
)
def q_panel_corr(spark, sf):
    ref = index_series(spark, sf).select("data", "ipca_mensal")
    return panel.panel_corr(priority_panel(spark, sf), ref, "valor", "ipca_mensal", "series")


# ------------------------------------------- roadmap operators, keyed by series


@register(
    "ordered_index",
    f"""WITH {CTE_I} SELECT data, {r6('ipca_mensal')} AS ipca_mensal FROM I ORDER BY data DESC""",
)
def q_ordered_index(spark, sf):
    """The index, latest month first (O1)."""
    return index_series(spark, sf).select("data", "ipca_mensal").orderBy(F.desc("data"))


@register(
    "one_series",
    f"""WITH {CTE_I7} SELECT data, ano, mes, {r6('ipca_mensal')} AS ipca_mensal, series_id FROM I7 WHERE series_id = 3""",
)
def q_one_series(spark, sf):
    """One series by equality."""
    return keep_series(index_series(spark, sf, by_line=True), "series_id", 3)


CTE_PANEL_RATE = f"""{CTE_PANEL}, {CTE_I},
PR AS (SELECT p.series, p.data, p.valor, i.ipca_mensal FROM PN p JOIN I i ON p.data = i.data)"""


def _panel_rate(spark, sf) -> DataFrame:
    i = index_series(spark, sf).select("data", "ipca_mensal")
    return temporal_join(priority_panel(spark, sf), i, on=["data"]).select("series", "data", "valor", "ipca_mensal")


@register(
    "panel_deflated",
    f"""WITH {CTE_PANEL_RATE},
D AS (SELECT series, data, valor, ipca_mensal, exp(sum(ln(1 + ipca_mensal / 100)) OVER (PARTITION BY series ORDER BY data
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS x FROM PR)
SELECT series, data, {r6('valor')} AS valor, {r6('ipca_mensal')} AS ipca_mensal, {r6('x')} AS indice_acumulado,
       {r6('valor / x')} AS preco_deflacionado FROM D""",
)
def q_panel_deflated(spark, sf):
    return panel.deflate(_panel_rate(spark, sf), "valor", "ipca_mensal", by=["series"])


@register(
    "panel_accum",
    f"""WITH {CTE_I7},
A AS (SELECT series_id, data, ipca_mensal, count(ipca_mensal) OVER w AS n, sum(ln(1 + ipca_mensal / 100)) OVER w AS s
      FROM I7 WINDOW w AS (PARTITION BY series_id ORDER BY data ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT series_id, data, {r6('ipca_mensal')} AS ipca_mensal,
       {r6('CASE WHEN n = 12 THEN (exp(s) - 1) * 100 END')} AS acumulado_12m FROM A""",
)
def q_panel_accum(spark, sf):
    i = index_series(spark, sf, by_line=True).select("series_id", "data", "ipca_mensal")
    return panel.accumulate(i, "ipca_mensal", k=12, by=["series_id"])


@register(
    "panel_rolling_corr",
    f"""WITH {CTE_PANEL_RATE},
L AS (SELECT series, data, (valor - lag(valor) OVER w) / nullif(lag(valor) OVER w, 0) * 100 AS a0,
             (ipca_mensal - lag(ipca_mensal) OVER w) / nullif(lag(ipca_mensal) OVER w, 0) * 100 AS b0
      FROM PR WINDOW w AS (PARTITION BY series ORDER BY data)),
M AS (SELECT *, CASE WHEN b0 IS NOT NULL THEN a0 END AS a, CASE WHEN a0 IS NOT NULL THEN b0 END AS b FROM L),
R AS (SELECT series, data, a0, b0, covar_pop(a, b) OVER w / nullif(stddev_pop(a) OVER w * stddev_pop(b) OVER w, 0) AS c
      FROM M WINDOW w AS (PARTITION BY series ORDER BY data ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT series, data, {r6('a0')} AS variacao, {r6('b0')} AS variacao_ipca, {r6('c')} AS correlacao_12 FROM R""",
)
def q_panel_rolling_corr(spark, sf):
    changes = (("variacao", "valor"), ("variacao_ipca", "ipca_mensal"))
    out = panel.rolling_change_corr(_panel_rate(spark, sf), changes, k=12, by=["series"])
    return out.select("series", "data", "variacao", "variacao_ipca", "correlacao_12")


@register(
    "panel_quarterly",
    f"""WITH {CTE_PANEL}
SELECT series, CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre, {r6('avg(valor)')} AS media,
       {r6('min(valor)')} AS minimo, {r6('max(valor)')} AS maximo, {r6('arg_max(valor, data)')} AS ultimo, COUNT(*) AS n_meses
FROM PN GROUP BY 1, 2, 3""",
)
def q_panel_quarterly(spark, sf):
    return panel.period_agg(priority_panel(spark, sf), "quarter", "valor", by=["series"])


@register(
    "panel_rollup",
    f"""WITH {CTE_PANEL}, Y AS (SELECT *, CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre FROM PN)
SELECT series, ano, trimestre, {r6('avg(valor)')} AS media, {r6('min(valor)')} AS minimo, {r6('max(valor)')} AS maximo,
       {r6('arg_max(valor, data)')} AS ultimo, COUNT(*) AS n_meses
FROM Y GROUP BY GROUPING SETS ((series, ano, trimestre), (series, ano))""",
)
def q_panel_rollup(spark, sf):
    return panel.period_rollup(priority_panel(spark, sf), "valor", by=["series"])


@register(
    "panel_null_keys",
    f"""WITH {CTE_PANEL}, PZ AS (SELECT nullif(series, '5-LOW') AS series, data, valor FROM PN),
L AS (SELECT *, lag(valor) OVER w AS prev, count(*) OVER f AS n, avg(valor) OVER f AS m
      FROM PZ WINDOW w AS (PARTITION BY series ORDER BY data),
                     f AS (PARTITION BY series ORDER BY data ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT a.series, a.data, {r6('a.valor')} AS valor, {r6('(a.valor - a.prev) / nullif(a.prev, 0) * 100')} AS variacao,
       {r6('CASE WHEN a.n = 3 THEN a.m END')} AS media_movel_3,
       {r6('(a.valor - b.valor) / nullif(b.valor, 0) * 100')} AS variacao_12m
FROM L a LEFT JOIN PZ b ON a.series IS NOT DISTINCT FROM b.series AND a.data = CAST(b.data + INTERVAL 12 MONTH AS DATE)""",
)
def q_panel_null_keys(spark, sf):
    """Frames and the yearly join over a panel whose key is NULL for one series."""
    pn = priority_panel(spark, sf).withColumn("series", F.nullif(F.col("series"), F.lit("5-LOW")))
    out = panel.moving_avg(panel.panel_pct_change(pn, "valor", "series"), "valor", k=3, by=["series"])
    return panel.yoy_change(out, "valor", by=["series"])


# ------------------------------------------------- long frames and raw-grained series

SQL_RAW_EVENTS = """E AS (SELECT event_id, nullif(event_type, 'purchase') AS series, ts,
        CASE WHEN event_id % 11 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS cents FROM events),
S AS (SELECT *, lag(cents) OVER w AS ant, sum(cents) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
      FROM E WINDOW w AS (PARTITION BY series ORDER BY ts, event_id))"""


@register(
    "lag_raw",
    f"""WITH {SQL_RAW_EVENTS}
SELECT event_id, series, cents, ant AS cents_ant, {r6('(cents - ant) / nullif(ant, 0) * 100')} AS variacao,
       CAST(total AS DOUBLE) AS acumulado FROM S""",
)
def q_lag_raw(spark, sf):
    """Lag, change and running sum over raw events, series and values NULL in places (W1, W2, X1): a prefix scan."""
    e = table(spark, sf, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("purchase")).alias("series"),
        "ts",
        F.when(F.col("event_id") % 11 != 0, F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
    )
    out = range_scan(e, ["ts", "event_id"], ["series"], {"cents_ant": "cents"}, {"acumulado": F.col("cents")})
    change = pct_change_expr(F.col("cents").cast("double"), F.col("cents_ant").cast("double"))
    return out.select("event_id", "series", "cents", "cents_ant", change.alias("variacao"), "acumulado")


LONG = 250

CTE_DAYS = f"""DOR AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS data, {mean_cents('o_totalprice')} AS valor,
               CAST(COUNT(*) AS DOUBLE) AS pedidos FROM orders GROUP BY 1, 2)"""


def _daily_orders(spark, sf) -> DataFrame:
    """Mean price and number of orders per priority and day: some thousands of days."""
    days = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("data"))
    return days.agg(
        (F.sum(cents("o_totalprice")) / F.count(F.lit(1)) / F.lit(100)).alias("valor"),
        F.count(F.lit(1)).cast("double").alias("pedidos"),
    )


@register(
    "long_frames",
    f"""WITH {CTE_DAYS},
C AS (SELECT *, (valor - lag(valor) OVER (PARTITION BY series ORDER BY data))
                / nullif(lag(valor) OVER (PARTITION BY series ORDER BY data), 0) * 100 AS chg FROM DOR),
M AS (SELECT series, data, valor, count(*) OVER w AS n, avg(valor) OVER w AS m, stddev_samp(chg) OVER w AS v,
             sum(ln(1 + valor / 1000000 / 100)) OVER w AS s
      FROM C WINDOW w AS (PARTITION BY series ORDER BY data ROWS BETWEEN {LONG - 1} PRECEDING AND CURRENT ROW))
SELECT series, data, {r6('valor')} AS valor, {r6(f'CASE WHEN n = {LONG} THEN m END')} AS media_movel,
       {r6('v')} AS volatilidade, {r6(f'CASE WHEN n = {LONG} THEN (exp(s) - 1) * 100 END')} AS acumulado FROM M""",
)
def q_long_frames(spark, sf):
    """Moving mean, volatility and accumulated rate over many rows, at a cost per row that k does not change."""
    d = _daily_orders(spark, sf).drop("pedidos")
    out = panel.moving_avg(d, "valor", LONG, by=["series"], out="media_movel", method="moments")
    out = panel.volatility(out, "valor", LONG, by=["series"], out="volatilidade", method="moments")
    out = panel.accumulate(out.withColumn("taxa", F.col("valor") / 1000000), "taxa", LONG, by=["series"], out="acumulado", method="moments")
    return out.drop("taxa")


@register(
    "long_corr",
    f"""WITH {CTE_DAYS},
L AS (SELECT series, data, (valor - lag(valor) OVER w) / nullif(lag(valor) OVER w, 0) * 100 AS a0,
             (pedidos - lag(pedidos) OVER w) / nullif(lag(pedidos) OVER w, 0) * 100 AS b0
      FROM DOR WINDOW w AS (PARTITION BY series ORDER BY data)),
M AS (SELECT *, CASE WHEN b0 IS NOT NULL THEN a0 END AS a, CASE WHEN a0 IS NOT NULL THEN b0 END AS b FROM L),
R AS (SELECT *, covar_pop(a, b) OVER w / nullif(stddev_pop(a) OVER w * stddev_pop(b) OVER w, 0) AS c
      FROM M WINDOW w AS (PARTITION BY series ORDER BY data ROWS BETWEEN {LONG - 1} PRECEDING AND CURRENT ROW))
SELECT series, data, {r6('a0')} AS variacao, {r6('b0')} AS variacao_pedidos, {r6('c')} AS correlacao FROM R""",
)
def q_long_corr(spark, sf):
    """Correlation of two daily changes over many rows."""
    changes = (("variacao", "valor"), ("variacao_pedidos", "pedidos"))
    out = panel.rolling_change_corr(_daily_orders(spark, sf), changes, LONG, by=["series"], out="correlacao", method="moments")
    return out.select("series", "data", "variacao", "variacao_pedidos", "correlacao")


CORRELATED = 0.3


@register(
    "correlated_pairs",
    f"""WITH S AS (SELECT l_suppkey AS series, {month('l_shipdate')} AS data, {mean_cents('l_extendedprice')} AS valor
      FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2),
C AS (SELECT series, data, (valor - lag(valor) OVER w) / nullif(lag(valor) OVER w, 0) * 100 AS chg
      FROM S WINDOW w AS (PARTITION BY series ORDER BY data)),
D AS (SELECT series, data, chg - avg(chg) OVER (PARTITION BY series) AS c FROM C WHERE chg IS NOT NULL),
Z AS (SELECT series, data, c / nullif(sqrt(sum(c * c) OVER (PARTITION BY series)), 0) AS z FROM D)
SELECT a.series AS series_a, b.series AS series_b, {r6('sum(a.z * b.z)')} AS correlacao
FROM Z a JOIN Z b ON a.data = b.data AND a.series < b.series GROUP BY 1, 2 HAVING sum(a.z * b.z) >= {CORRELATED}""",
)
def q_correlated_pairs(spark, sf):
    """Pairs of suppliers whose monthly price changes correlate, found by Fourier sketches in a grid."""
    months = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("series"), month_of_ts("l_shipdate").alias("data"))
    means = months.agg((F.sum(cents("l_extendedprice")) / F.count(F.lit(1)) / F.lit(100)).alias("valor"))
    return correlated_pairs(means, "valor", CORRELATED)


# ------------------------------------------------------------ change detection

SQL_VERSIONS = """V AS (SELECT o_orderpriority AS series, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
        o_orderkey % 997 = 0 AS edited, o_orderkey % 1009 = 0 AS lost,
        o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1995 AS dropped, o_orderpriority = '2-HIGH' AND month(o_orderdate) = 7 AS fresh
      FROM orders)"""


@register(
    "changed_months",
    f"""WITH {SQL_VERSIONS},
M AS (SELECT series, ano, mes, COUNT(*) FILTER (WHERE NOT fresh) AS n_old, COUNT(*) FILTER (WHERE NOT dropped AND NOT lost) AS n_new,
        COUNT(*) FILTER (WHERE NOT (fresh OR dropped OR lost) AND edited) + COUNT(*) FILTER (WHERE fresh <> (dropped OR lost)) AS touched
      FROM V GROUP BY 1, 2, 3)
SELECT series, ano, mes, CASE WHEN n_old = 0 THEN 'added' WHEN n_new = 0 THEN 'removed' ELSE 'changed' END AS status,
       nullif(n_old, 0) AS n_old, nullif(n_new, 0) AS n_new FROM M WHERE touched > 0 AND n_old + n_new > 0""",
)
def q_changed_months(spark, sf):
    """Months that differ between two versions of the orders, found down a hash tree."""
    o = table(spark, sf, "orders")
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    rows = o.select(
        F.col("o_orderpriority").alias("series"),
        F.year(date).alias("ano"),
        F.month(date).alias("mes"),
        "o_orderkey",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    fresh = (F.col("series") == "2-HIGH") & (F.col("mes") == 7)
    dropped = (F.col("series") == "1-URGENT") & (F.col("ano") == 1995)
    edited = F.when(key % 997 == 0, F.col("cents") + 1).otherwise(F.col("cents"))
    keys, cols = ["series", "ano", "mes"], ["o_orderkey", "cents"]
    old = hash_tree.leaves(rows.filter(~fresh), keys, cols)
    new = hash_tree.leaves(rows.filter(~dropped & (key % 1009 != 0)).withColumn("cents", edited), keys, cols)
    return hash_tree.changed_nodes(shared_copy(old, "leaves"), shared_copy(new, "leaves"), keys)


# ------------------------------------------------------------ stored states


@register(
    "state_metrics",
    f"""WITH V AS (SELECT l_linenumber AS series, CAST(round(l_extendedprice * 100) AS BIGINT) / 100 AS b,
        CASE WHEN l_orderkey % 13 <> 0 THEN l_quantity END AS a FROM lineitem),
G AS (SELECT series, covar_pop(CASE WHEN a IS NOT NULL THEN b END, a) AS co, stddev_pop(CASE WHEN b IS NOT NULL THEN a END) AS sa,
        stddev_pop(CASE WHEN a IS NOT NULL THEN b END) AS sb, avg(CASE WHEN b IS NOT NULL THEN a END) AS ma,
        avg(CASE WHEN a IS NOT NULL THEN b END) AS mb FROM V GROUP BY series)
SELECT series, {r6('co / nullif(sa * sb, 0)')} AS correlacao_global, {hu('ma', 4)} AS media_ipca_global, {hu('mb', 4)} AS media_boi_global,
       {hu('round((ma + mb) / 2, 4)', 3)} AS media_combinada_global FROM G""",
)
def q_state_metrics(spark, sf):
    """Metrics per line number from stored monthly states, after an insert of a year and corrections of another."""
    li = table(spark, sf, "lineitem")
    rows = li.select(
        F.col("l_linenumber").alias("series"),
        month_of_ts("l_shipdate").alias("data"),
        F.when(F.col("l_orderkey") % 13 != 0, F.col("l_quantity").cast("double")).alias("a"),
        (cents("l_extendedprice") / F.lit(100)).alias("b"),
    )
    year, keys = F.year("data"), ["series", "data"]
    stored = StoredStates(spark, shared_path(spark, "states"), keys)
    # the first version lacks a year and holds other prices in a second one
    wrong = F.when(year == 1995, F.col("b") * 2 + 1).otherwise(F.col("b"))
    stored.update(pair_states(rows.filter(year.isNull() | (year != 1997)).withColumn("b", wrong), keys, "a", "b"))
    stored.update(pair_states(rows.filter(year.isin(1995, 1997)), keys, "a", "b"))
    out = metrics_from_states(stored.current(), ["series"])
    means = {c: F.round(c, d) for c, d in (("media_ipca_global", 4), ("media_boi_global", 4), ("media_combinada_global", 3))}
    return out.withColumns(means)
