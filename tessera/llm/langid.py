"""Language identification by compression.

Every language gets a raw-content zstandard dictionary from a bounded sample
of its texts.  A text is compressed once per dictionary, in pieces of fixed
size so that a long text uses the dictionary all the way; the language whose
dictionary gives the fewest bytes wins.  The score is the relative margin to
the second; a text with a narrow margin is marked as not reliable.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

UNDETERMINED = "und"
#: Ends every piece.  zstd stores a block raw when compression gains too little, which would make
#: all languages tie on a short text; this run always gains, at the same cost for each of them.
RUN = b"\0" * 64


@dataclass(frozen=True)
class LangParams:
    """``sample_docs`` snippets of ``snippet_chars`` per language bound a dictionary's size."""

    sample_docs: int = 240
    snippet_chars: int = 300
    piece_bytes: int = 4096
    level: int = 5
    min_margin: float = 0.005


def letters_only(text: str) -> str:
    """Lower-cased words; digits, punctuation and symbols become single spaces."""
    return re.sub(r"[\W\d_]+", " ", text.lower()).strip()


def sample(train: DataFrame, p: LangParams, id_col: str, text_col: str, lang_col: str) -> dict[str, list[str]]:
    """Bounded sample per language: ``sample_docs`` distinct snippets (all, if there are fewer), picked by their hash."""
    length, span = F.char_length(text_col), F.lit(p.snippet_chars)
    begin = F.pmod(F.xxhash64(F.col(text_col), F.lit(8)), F.greatest(length - span, F.lit(0)) + 1) + 1
    rows = train.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.substring(text_col, begin.cast("int"), span).alias("snippet")
    )
    rows = rows.withColumn("pick", F.pmod(F.xxhash64("snippet", F.lit(7)), F.lit(1 << 30)))
    # distinct snippets are counted, not rows: copies share one hash and pass or fail together.
    # Only (language, hash) is shuffled, and one count per language comes back
    distinct = rows.select("lang", "pick").distinct()
    sizes = {r.lang: r.n for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 4.0 * p.sample_docs / n))])
    # thinned where it is read: only a few times the sample is shuffled by language
    thinned = rows.filter(F.col("pick") < share[F.col("lang")] * (1 << 30))
    ranked = thinned.dropDuplicates(["lang", "snippet"]).withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy("pick", "snippet"))
    )
    found: dict[str, list[str]] = {}
    for r in ranked.filter(F.col("r") <= p.sample_docs).orderBy("lang", "r").select("lang", "snippet").collect():
        found.setdefault(r.lang, []).append(r.snippet)
    return found


def dictionaries(samples: dict[str, list[str]]) -> dict[str, bytes]:
    """One dictionary per language, cut to one size so that the language with more sample text has no advantage.

    The size is that of the shortest among the dictionaries that have at least half the bytes of the
    longest, so the cut never takes more than half of any.  Shorter ones stay whole beside the others:
    a rare language costs the large ones nothing, and wins the texts that its own sample still fits best.
    """
    texts = {lang: " ".join(filter(None, map(letters_only, s))) for lang, s in sorted(samples.items())}
    whole = {lang: t.encode("utf-8", "replace") for lang, t in texts.items() if t}
    longest = max(map(len, whole.values()), default=0)
    size = min((len(d) for d in whole.values() if 2 * len(d) >= longest), default=0)
    return {lang: d[:size] for lang, d in whole.items()}


class Classifier:
    def __init__(self, dicts: dict[str, bytes], p: LangParams):
        import zstandard

        self.piece, self.langs = p.piece_bytes, sorted(dicts)
        self.compressors = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dicts[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=p.level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=p.level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = letters_only(text or "")
        if not self.langs or not any(map(str.isalpha, words)):
            return UNDETERMINED, 0.0
        data = words.encode("utf-8", "replace")
        pieces = [data[i : i + self.piece] + RUN for i in range(0, len(data), self.piece)]
        sizes = [sum(len(c.compress(x)) for x in pieces) for c in self.compressors]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)  # ties: alphabetical
        if len(order) == 1:
            return self.langs[0], 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        return self.langs[order[0]], (second - best) / second


def identify(
    docs: DataFrame,
    train: DataFrame,
    p: LangParams = LangParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_reliable``.

    Only ``text_col`` of ``docs`` enters a prediction.  ``und`` with score 0:
    null texts, texts without a letter, or nothing to learn from.  Columns of
    those three names are replaced.  With one learned language the score is 1.
    """
    dicts = dictionaries(sample(train, p, id_col, text_col, lang_col))
    model = docs.sparkSession.sparkContext.broadcast(dicts)
    out = ["lang_pred", "lang_score", "lang_reliable"]
    kept = docs.drop(*out)
    schema = T.StructType(
        [*kept.schema.fields, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType()), T.StructField(out[2], T.BooleanType())]
    )
    at = kept.columns.index(text_col)

    def run(batches):
        classify = Classifier(model.value, p)
        for b in batches:
            found = [classify(t.as_py()) for t in b.column(at)]
            pred, score = [x[0] for x in found], [x[1] for x in found]
            sure = [x[0] != UNDETERMINED and x[1] >= p.min_margin for x in found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sure, pa.bool_())],
                [*b.schema.names, *out],
            )

    return kept.mapInArrow(run, schema)


def fold(id_col: str = "doc_id", of: int = 5) -> Column:
    """crc32 of the id as text, modulo ``of`` (null id: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of))
