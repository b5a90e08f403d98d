"""Idempotent, hash-ledgered ingestion with lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import batch_hash_aggs
from tessera.functions.parse import (
    month_of,
    parse_br_date,
    parse_comma_decimal,
    parse_month,
    parse_ptbr_number,
    parse_utc,
    utc_now,
    year_of,
)
from tessera.operators.basic import dedupe_latest, with_constants
from tessera.operators.joins import new_only, with_ledger
from tessera.operators.quality import MONTH_TEXT, DataQualityError
from tessera.session import shared_copy, shared_path
from tessera.sources.files import MANIFEST_COLUMNS, load_if_exists
from tessera.sources.hash_index import HashIndex
from tessera.sources.sinks import append_partitioned, partitions_path, split_write

# Header texts of a repeated header row in the raw sheets, and the bronze columns.
HEADER_NAMES = {"data_raw": "data", "valor_raw": "valor"}
BRONZE_PRICE_COLUMNS = (
    "csv_file", "mes_ano", "valor", "source_file", "file_hash", "converted_at_utc",
    "ingest_run_id", "ingested_at_utc", "mes", "ano",
)
BRONZE_INDEX_COLUMNS = (
    "data_ref", "valor", "source", "series_id", "data_inicial", "data_final",
    "request_url", "payload_hash", "ingest_run_id", "ingested_at_utc", "ano", "mes",
)


def canonicalize(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw ``data_raw, valor_raw`` text -> canonical ``mes_ano, valor`` (Q1).

    pt-BR number parsed, month re-rendered "MM/yyyy", rows with a NULL month
    or value dropped.  Header rows go with them: "Data" is no month.  The
    texts are parsed once, in the array below; a filter on plain projected
    columns would be pushed under the projection and parse them again.
    ``keep`` columns ride along.
    """
    parsed = F.array(
        F.struct(parse_month("data_raw").alias("mes_ano"), parse_ptbr_number("valor_raw").alias("valor"))
    )
    return raw.select(*keep, F.inline(parsed)).na.drop(subset=["mes_ano", "valor"]).select("mes_ano", "valor", *keep)


def run_ts_col(run_ts) -> Column:
    """Injected run time (reproducible reruns) or the current UTC wall time."""
    if run_ts is None:
        return utc_now()
    return F.lit(run_ts).cast("timestamp_ntz")


def current_entries(ledger: DataFrame) -> DataFrame:
    """One ledger entry per file name: the latest ``(converted_at_utc, file_hash)``.

    A flat landing folder holds one content per name, that of the last
    conversion; entries it replaced describe files that are gone.
    """
    return dedupe_latest(ledger.select(*MANIFEST_COLUMNS), ["csv_file"], ["converted_at_utc", "file_hash"])


def with_lineage(
    rows: DataFrame,
    ledger: DataFrame,
    run_id: str,
    run_ts=None,
    on: Sequence[str] = ("csv_file",),
    how: str = "left",
) -> DataFrame:
    """Landed rows + ledger lineage + run constants + partition columns (Q8).

    ``rows`` carries ``csv_file, mes_ano, valor``; ``ledger`` the entries of
    :func:`read_manifest`.  A row meets one entry at most: by name the current
    one, and with ``on=("csv_file", "file_hash")`` (landing rows that carry
    their file's hash) the last of that name and hash.  With ``how="left"``
    rows of a file that is not in the ledger keep NULL lineage (reported by
    the not-null check); the ingest joins "inner".
    """
    on = list(on)
    if "file_hash" in on:
        led = dedupe_latest(ledger.select(*MANIFEST_COLUMNS), on, ["converted_at_utc", "source_file"])
    else:
        led = current_entries(ledger)
    joined = with_ledger(rows.select(*dict.fromkeys([*on, "csv_file", "mes_ano", "valor"])), led, on=on, how=how)
    return with_constants(
        joined,
        {
            "converted_at_utc": parse_utc("converted_at_utc"),
            "ingest_run_id": run_id,
            "ingested_at_utc": run_ts_col(run_ts),
            "mes": month_of("mes_ano", "MM/yyyy"),
            "ano": year_of("mes_ano", "MM/yyyy"),
        },
    ).select(*BRONZE_PRICE_COLUMNS)


def bronze_from_payload(payload: DataFrame, meta: Mapping[str, object], run_ts=None) -> DataFrame:
    """Typed bronze index rows from ``{data, valor}`` payload text (Q9).

    ``meta`` holds ``source, series_id, data_inicial, data_final,
    request_url, payload_hash, ingest_run_id``; a Column value is allowed
    (e.g. a per-row series id).
    """
    typed = payload.withColumns(
        {
            "data_ref": parse_br_date("data"),
            "_valor": parse_comma_decimal("valor"),
            "ano": year_of("data", "dd/MM/yyyy"),
            "mes": month_of("data", "dd/MM/yyyy"),
        }
    )
    out = with_constants(typed, {**meta, "ingested_at_utc": run_ts_col(run_ts)})
    return out.select(
        "data_ref", F.col("_valor").alias("valor"), "source",
        F.col("series_id").cast("int").alias("series_id"), "data_inicial", "data_final",
        "request_url", "payload_hash", "ingest_run_id", "ingested_at_utc", "ano", "mes",
    )


def payload_hash(df: DataFrame, cols: Sequence[str], batch: Sequence[str] = ()) -> DataFrame:
    """Order-insensitive content hash per batch: ``*batch, n_rows, payload_hash``."""
    aggs = batch_hash_aggs(cols)
    return df.groupBy(*batch).agg(*aggs) if batch else df.agg(*aggs)


def new_rows(
    df: DataFrame,
    existing: DataFrame | None,
    hash_col: str = "file_hash",
    dedupe_on: Sequence[str] = ("mes_ano", "file_hash"),
) -> DataFrame:
    """Rows whose ``hash_col`` is absent from ``existing``, one per ``dedupe_on`` (J3 + A4).

    Of rows that differ the greatest value wins (the other columns break
    ties), so every evaluation gives the same rows.  De-duplication runs
    first: ``dedupe_on`` contains the hash, so the two steps commute, and
    copies of one file collapse map-side before rows are shuffled by hash.
    """
    rest = [c for c in df.columns if c not in dedupe_on]
    order = sorted(rest, key=lambda c: c != "valor")
    deduped = dedupe_latest(df, list(dedupe_on), order)
    return deduped if existing is None else new_only(deduped, existing, hash_col)


class HashLedger:
    """What a bronze table has taken in, by content hash: one narrow row per file or payload.

    The hashes taken in are a :class:`HashIndex`: a run's new hashes are found
    without a shuffle of the known ones.  A batch's hashes are noted as
    *pending* before its rows are appended and as *done* after.  Pending
    hashes that never got done are in doubt: a run stopped in between, and the
    table itself is asked about those (only).
    """

    def __init__(self, spark: SparkSession, target: str, fmt: str = "parquet", hash_col: str = "file_hash", path: str | None = None):
        self.spark, self.target, self.fmt, self.hash_col = spark, target, fmt, hash_col
        self.done_path = path or f"{target.rstrip('/')}_ingested_hashes"
        self.pending_path = f"{self.done_path}_pending"
        self.done = HashIndex(spark, self.done_path, hash_col)

    def _adopt(self) -> None:
        """Index what there is to know already: a ledger of plain files, or (without any ledger) the table's own column."""
        if self.done.known() is not None:
            return
        plain = load_if_exists(self.spark, self.done_path)
        if plain is None and load_if_exists(self.spark, self.pending_path) is None:
            plain = load_if_exists(self.spark, self.target, self.fmt)
        if plain is not None:
            self.done.add(shared_copy(plain.select(self.hash_col).distinct(), "known-hashes"))

    def new(self, hashes: DataFrame) -> DataFrame:
        """Rows of ``hashes`` (few per hash) whose hash was not taken in."""
        self._adopt()
        return shared_copy(self.done.new_only(hashes), "new-hashes")

    def in_doubt(self, hashes: DataFrame) -> DataFrame | None:
        """Those of ``hashes`` that an earlier run noted as pending; None if there are none."""
        pending = load_if_exists(self.spark, self.pending_path)
        if pending is None or load_if_exists(self.spark, self.target, self.fmt) is None:
            return None
        found = hashes.select(self.hash_col).join(pending.select(self.hash_col).distinct(), self.hash_col)
        return None if found.isEmpty() else found

    def begin(self, hashes: DataFrame) -> None:
        hashes.select(self.hash_col).distinct().write.mode("append").parquet(self.pending_path)

    def commit(self, hashes: DataFrame) -> None:
        self.done.add(hashes)


def ingest_new(
    df: DataFrame,
    existing: DataFrame | None,
    target: str,
    hash_col: str = "file_hash",
    dedupe_on: Sequence[str] = ("mes_ano", "file_hash"),
    fmt: str = "parquet",
    by: Sequence[str] = ("ano", "mes"),
    check_month: str | None = "mes_ano",
    in_doubt: DataFrame | None = None,
    rejected: str | None = None,
) -> int:
    """Idempotent append of rows whose ``hash_col`` is not yet in the target (Q2).

    The sources are read once: one write to the shared folder splits the new
    rows into good and bad ones (no hash, no valid month text) and counts
    them.  Bad rows raise, unless ``rejected`` names a table for them: there
    they are kept with the names of the rules they broke, and the good rows go
    on.  Rows of ``in_doubt`` hashes that the target already has (a run
    stopped during or after its append) are left out; such a run may note
    rejected rows twice (:func:`rejected_rows` gives each once).  Returns the
    number of appended rows; a second run appends 0.
    """
    rules = {f"without {hash_col}": F.col(hash_col).isNull()}
    if check_month:
        c = F.col(check_month)
        rules[f"invalid {check_month}"] = c.isNull() | ~c.rlike(MONTH_TEXT)
    spark = df.sparkSession
    split = split_write(new_rows(df, existing, hash_col, dedupe_on), shared_path(spark, "staged"), rules)
    if split.n_bad:
        if rejected is None:
            found = ", ".join(f"{n} row(s) {rule}" for rule, n in split.broken.items() if n)
            raise DataQualityError(f"{found}; nothing was appended")
        split.bad.write.mode("append").parquet(rejected)
    good, n = split.good, split.n_good
    if in_doubt is not None:
        there = spark.read.format(fmt).load(target).select(*dedupe_on)
        there = there.join(in_doubt.select(hash_col).distinct(), hash_col, "left_semi").distinct()
        good = shared_copy(good.join(there, list(dedupe_on), "left_anti"), "staged")
        n = good.count()
    if not n:
        return 0
    _note_partitions(good, target, fmt, by)
    return append_partitioned(good, target, fmt, by)


def _note_partitions(rows: DataFrame, target: str, fmt: str, by: Sequence[str]) -> None:
    """Note the partitions of ``rows`` before their append: one that a stopped run did not reach is registered empty, none is missed."""
    spark, notes = rows.sparkSession, partitions_path(target)
    parts = rows.select(*by).distinct()
    if load_if_exists(spark, notes) is None:
        older = load_if_exists(spark, target, fmt)
        if older is not None:
            parts = parts.union(older.select(*by)).distinct()
    parts.write.mode("append").parquet(notes)


def rejected_path(target: str) -> str:
    """The table of rejected rows beside a bronze table."""
    return f"{target.rstrip('/')}_rejected"


def rejected_rows(spark: SparkSession, path: str, ignore: Sequence[str] = ("ingest_run_id", "ingested_at_utc")) -> DataFrame | None:
    """Rejected rows under ``path``, each once (runs that were repeated differ in ``ignore`` only); None if there are none."""
    found = load_if_exists(spark, path)
    return None if found is None else found.dropDuplicates([c for c in found.columns if c not in ignore])


def ingest_files(rows: DataFrame, entries: DataFrame, ledger: HashLedger, rejected: str | None = None) -> int:
    """Append the rows of the ledger entries that :meth:`HashLedger.new` gave; returns their number.

    ``rejected`` names the table for bad rows (without it they raise).

    Safe to run again after any stop: before the append nothing is in the
    table, during or after it the rows in doubt are compared with the table.
    """
    doubt = ledger.in_doubt(entries)
    ledger.begin(entries)
    n = ingest_new(rows, None, ledger.target, ledger.hash_col, fmt=ledger.fmt, in_doubt=doubt, rejected=rejected)
    ledger.commit(entries)
    return n


def ingest_payload(
    spark: SparkSession,
    bronze_rows: DataFrame,
    target: str,
    fmt: str = "parquet",
) -> bool:
    """Append a typed payload unless its ``payload_hash`` was taken in before (Q3).

    ``bronze_rows`` all carry one payload hash, which is looked up in the
    compact ledger, not in the table.  Returns True when appended.
    """
    ledger = HashLedger(spark, target, fmt, "payload_hash")
    entry = ledger.new(bronze_rows.select("payload_hash").limit(1))
    if entry.isEmpty():
        return False
    if bronze_rows.filter(F.col("data_ref").isNull()).limit(1).count() > 0:
        raise DataQualityError("payload rows with unparseable data_ref")
    doubt = ledger.in_doubt(entry)
    ledger.begin(entry)
    keys = ("series_id", "data_ref", "payload_hash")
    ingest_new(bronze_rows, None, target, "payload_hash", keys, fmt, check_month=None, in_doubt=doubt)
    ledger.commit(entry)
    return True
