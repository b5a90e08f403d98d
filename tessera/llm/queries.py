"""Registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib

import regex
from pyspark.sql import functions as F

from tessera.llm import (
    bpe,
    divergence,
    exact_dedup,
    fim,
    fingerprint,
    langid,
    license_scan,
    packing,
    secrets,
    sharding,
    simhash,
    toxicity,
    warc,
)
from tessera.llm.common import read_table, shared_path

SHARDS = [f"shard-{i:03d}" for i in range(100)]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark, sf_dir):
    groups = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_simhash(spark, sf_dir):
    groups = simhash.near_groups(read_table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op3_bpe(spark, sf_dir):
    rows = bpe.tokenized(read_table(spark, sf_dir, "documents"), tokenizer_path(), digests=True)
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.col("ids").alias("ids_sha256"),
        F.col("decoded").alias("decoded_sha256"),
    )


def op4_license_scan(spark, sf_dir):
    return license_scan.scan(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "text_digest", "license_id", F.array_join("notice_ids", ",").alias("notice_ids")
    )


def op5_packing(spark, sf_dir):
    return packing.packed(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_warc(spark, sf_dir):
    records = warc.round_trip(spark, read_table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_sharding(spark, sf_dir):
    return sharding.place(read_table(spark, sf_dir, "documents"), SHARDS).select("doc_id", "slot", "shard")


def op8_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(toxicity.fold() == 2, F.lit(False))
    labels = read_table(spark, sf_dir, "labels").filter(~held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        F.when(F.col("toxic_flag"), 1).otherwise(0).alias("predicted"),
        F.col("toxic_evidence").alias("evidence"),
    )


def op9_fingerprint(spark, sf_dir):
    rows = fingerprint.edited_and_next(read_table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.sketch_hex(F.col("sketch")).alias("fingerprint"),
        fingerprint.sketch_hex(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        F.col("next_id").alias("next_doc_id"),
    )


def op10_langid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.fold() == 0, F.lit(False))
    found = langid.identify(docs.select("doc_id", "text"), docs.filter(~held_out))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_reliable").alias("reliable"),
    )


def op11_divergence(spark, sf_dir):
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_secrets(spark, sf_dir):
    return secrets.scan(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"
    )


def op13_fim(spark, sf_dir):
    rows = fim.fill_in_middle(read_table(spark, sf_dir, "documents"), digests=True)
    return rows.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.col("output").alias("output_sha256"),
        F.col("restored").alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_simhash,
        op3_bpe,
        op4_license_scan,
        op5_packing,
        op6_warc,
        op7_sharding,
        op8_toxicity,
        op9_fingerprint,
        op10_langid,
        op11_divergence,
        op12_secrets,
        op13_fim,
    )
}


def _plain_license_digest(text: str) -> str | None:
    """The canonical digest of one known text, in plain Python."""
    t = text.lower().replace("\r\n", "\n").replace("\r", "\n")
    t = regex.sub(r"[^\p{L}\p{N}\n]+", "  ", regex.sub(license_scan.COPYRIGHT_LINE.replace("(?md)", "(?m)"), " ", t))
    for variant, one in license_scan.STEMS:
        t = t.replace(variant, one)
    t = "  ".join(["", *t.split(), ""])
    for variant, one in license_scan.PHRASES:
        t = t.replace(f" {'  '.join(variant.split())} ", f" {'  '.join(one.split())} ")
    t = t.strip(" ")
    return hashlib.sha256(t.encode()).hexdigest() if t else None


def plain_license_digests() -> dict[str, str]:
    """``{digest: license_id}`` of all known texts, the full ones too."""
    out: dict[str, str] = {}
    for license_id, text in license_scan.KNOWN + license_scan.with_dress(license_scan.KNOWN):
        digest = _plain_license_digest(text)
        if digest:
            out[digest] = min(license_id, out.get(digest, license_id))
    return out


def _license_sql() -> str:
    """The same canonical form in DuckDB: replacements nested in their order."""

    def lines(text: str) -> str:
        copyright_line = license_scan.COPYRIGHT_LINE.replace("(?md)", "(?m)")
        t = f"replace(replace(lower({text}), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
        t = f"regexp_replace(regexp_replace({t}, '{copyright_line}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}\\n]+', '  ', 'g')"
        for variant, one in license_scan.STEMS:
            t = f"replace({t}, '{variant}', '{one}')"
        return f"(' ' || replace({t}, chr(10), ' ' || chr(10) || ' ') || ' ')"

    def digest(canonical: str) -> str:
        t = f"regexp_replace({canonical}, '\\s+', '  ', 'g')"
        for variant, one in license_scan.PHRASES:
            t = f"replace({t}, '{license_scan._words(variant)}', '{license_scan._words(one)}')"
        return f"sha256(nullif(trim({t}, ' '), ''))"

    known = ", ".join(f"('{d}', '{i}')" for d, i in sorted(plain_license_digests().items()))
    return f"""
        WITH K AS (SELECT * FROM (VALUES {known}) v(digest, license_id)),
        C AS (SELECT doc_id, {lines("coalesce(text, '')")} AS c FROM documents),
        D AS (SELECT doc_id, {digest("c")} AS text_digest FROM C),
        L AS (SELECT doc_id, unnest(string_split(c, chr(10))) AS line FROM C),
        N AS (
          SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS notice_ids
          FROM (SELECT DISTINCT doc_id, license_id FROM L JOIN K ON {digest("line")} = K.digest) GROUP BY 1)
        SELECT D.doc_id, text_digest, license_id, notice_ids
        FROM D LEFT JOIN K ON text_digest = digest LEFT JOIN N ON D.doc_id = N.doc_id"""


def _audit_sql() -> str:
    """The whole audit with every kept term of every group, zero counts too."""
    p = divergence.AuditParams()

    def share(n: str, total: str, terms: str) -> str:
        return f"1 + ({divergence.SCALE}::HUGEINT * ({n} + {p.smooth})) // ({total} + {p.smooth} * {terms})"

    return f"""
        WITH D AS (SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          row_number() OVER () AS r FROM documents),
        T AS (SELECT lang, source, r, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM D),
        K AS (SELECT lang, term, count(*) AS n FROM T GROUP BY ALL HAVING count(DISTINCT r) >= {p.min_docs}),
        V AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM K GROUP BY lang),
        C AS (SELECT T.lang, source, term, count(*) AS n FROM T SEMI JOIN K USING (lang, term) GROUP BY ALL),
        S AS (SELECT DISTINCT lang, source FROM D),
        N AS (SELECT S.lang, S.source, coalesce(sum(n), 0) AS total FROM S LEFT JOIN C USING (lang, source) GROUP BY ALL),
        P AS (SELECT N.lang, N.source, K.term, coalesce(C.n, 0) AS n, {share("coalesce(C.n, 0)", "N.total", "V.terms")} AS p,
                     {share("K.n", "V.total", "V.terms")} AS q
              FROM N JOIN K USING (lang) JOIN V USING (lang)
              LEFT JOIN C ON C.lang = N.lang AND C.source = N.source AND C.term = K.term),
        R AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
              FROM S a JOIN S b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN P x ON x.lang = a.lang AND x.source = a.source
              LEFT JOIN P y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
        O AS (SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM R
              UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM P WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM O)
        WHERE part = 'pair' OR rank <= {p.top}"""


def _fim_sql() -> str:
    p = fim.FimParams()
    pre, suf, mid = p.marks
    held = " OR ".join(f"contains(t, '{m}')" for m in p.marks)
    number = [f"('0x' || substr(h, {i}, 8))::BIGINT" for i in (1, 9, 17, 25)]
    return f"""
        WITH D AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{p.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        L AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines FROM D),
        N AS (SELECT *, len(lines) AS n, {number[0]} % (len(lines) + 1) AS c1, {number[1]} % (len(lines) + 1) AS c2 FROM L),
        C AS (SELECT *, coalesce(array_to_string(lines[1:least(c1, c2)], ''), '') AS pre,
                coalesce(array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS mid,
                coalesce(array_to_string(lines[greatest(c1, c2) + 1:n], ''), '') AS suf,
                CASE WHEN t = '' OR {held} OR {number[2]} % 100 >= {p.fim_percent} THEN '{fim.PLAIN}'
                     WHEN {number[3]} % 100 < {p.spm_percent} THEN '{fim.SPM}' ELSE '{fim.PSM}' END AS form FROM N)
        SELECT doc_id, n, form, CASE WHEN form <> '{fim.PLAIN}' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> '{fim.PLAIN}' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN '{fim.PLAIN}' THEN t WHEN '{fim.PSM}' THEN '{pre}' || pre || '{suf}' || suf || '{mid}' || mid
                      ELSE '{suf}' || suf || '{pre}' || pre || '{mid}' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM C"""


ALPHABET_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES = {
    "op1_exact_dedup": """
        WITH d AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op4_license_scan": _license_sql(),
    "op6_warc": f"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h FROM p),
        k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM d)
        SELECT page_id, payload_bytes,
               list_reduce(list_transform(range(32), lambda i: substr('{ALPHABET_32}',
                 CAST((('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)),
                 lambda a, b: a || b) AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM keep THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
        FROM k""",
    "op11_divergence": _audit_sql(),
    "op13_fim": _fim_sql(),
}
