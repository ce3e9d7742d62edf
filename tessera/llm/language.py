"""Language identification by compression with per-language zstandard dictionaries.

One raw-content dictionary per language is filled from a bounded sample of labelled
texts.  A text is cut into pieces that together cover all of it; every piece is
compressed with every dictionary, and the language whose dictionary gives the fewest
bytes over all pieces wins.  The relative distance to the runner-up is the score; a
text whose score is below ``min_margin`` is rejected.

Null and letterless texts get ``und`` with score 0 and are rejected.  With no learned
language every text does.  Ties go to the language that is first by code point.
Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNDETERMINED = "und"
#: Bound of the sample that is brought to the driver: texts per language, characters of each,
#: and bytes of a language's dictionary.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 1500
DICT_BYTES = 64 << 10
#: A language's labels beyond this many languages raise, so the dictionaries stay bounded.
MAX_LANGUAGES = 500
PIECE_BYTES = 2000
#: Short matches tell languages apart; small hash tables keep the cost of one piece low.
PACKING = dict(window_log=17, hash_log=14, chain_log=14, search_log=1, min_match=3,
               target_length=16, strategy=zstandard.STRATEGY_FAST, write_content_size=0,
               write_dict_id=0)
#: Short texts get a thorough match search; few bytes pay for it.
SHORT_BYTES = 600
SHORT_PACKING = PACKING | dict(hash_log=15, chain_log=15, search_log=5,
                               strategy=zstandard.STRATEGY_GREEDY)
#: Texts whose best two languages are closer than this are rejected.
MIN_MARGIN = 0.002


def learn_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang",
                       key: str = "doc_id", sample_docs: int = SAMPLE_DOCS,
                       dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw dictionary content per language from at most ``sample_docs`` texts of each.

    The sample is the texts with the smallest key hash, an even draw whatever the order
    or layout of the table.  Each gives at most ``SAMPLE_CHARS``, so one very long text
    cannot fill a dictionary.
    """
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_draw", "_bit"))
    # the short form of a sampled text only fills the dictionary; predictions read whole texts
    picked = (labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
              .select(F.col(lang).cast("string").alias("_lang"),
                      F.xxhash64(F.lit(11), F.col(key).cast("string")).alias("_draw"),
                      F.substring(F.col(text), 1, SAMPLE_CHARS).alias("_bit"))
              .where(F.col("_bit").rlike("\\p{L}"))
              .withColumn("_rank", rank).where(F.col("_rank") <= sample_docs))
    by_lang: dict[str, list[tuple[int, bytes]]] = {}
    rows = picked.select("_lang", "_rank", "_bit").toLocalIterator()
    for row in rows:
        if row["_lang"] not in by_lang and len(by_lang) == MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages among the labels")
        by_lang.setdefault(row["_lang"], []).append((row["_rank"], _folded(row["_bit"])))
    return {name: b" ".join(bit for _, bit in sorted(bits))[-dict_bytes:]
            for name, bits in sorted(by_lang.items())}


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _folded(text: str) -> bytes:
    """Lower case, every run of other characters than letters one space."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


class _Scorer:
    """The compressors of one worker."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.packers = self._compressors(dictionaries, PACKING)
        self.short_packers = self._compressors(dictionaries, SHORT_PACKING)

    def _compressors(self, dictionaries: dict[str, bytes], settings: dict) -> list:
        packing = zstandard.ZstdCompressionParameters(**settings)
        out = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name],
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=packing)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=packing))
        return out

    def __call__(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        whole = _folded(text)
        if len(whole) < SHORT_BYTES:
            # a block that gains nothing is stored raw; the padding keeps tiny texts above that
            pieces, packers = [whole + b"\0" * SHORT_BYTES], self.short_packers
        else:
            pieces = [whole[i:i + PIECE_BYTES] for i in range(0, len(whole), PIECE_BYTES)]
            packers = self.packers
        sizes = [sum([len(pack.compress(p)) for p in pieces]) for pack in packers]
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        rest = [s for i, s in enumerate(sizes) if i != best]
        score = (min(rest) - sizes[best]) / min(rest) if rest else 1.0
        return self.names[best], float(min(1.0, max(0.0, score)))


def identify(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
             min_margin: float = MIN_MARGIN, prefix: str = "lang_") -> DataFrame:
    """Add ``<prefix>pred``, ``<prefix>score`` and ``<prefix>rejected`` to every row.

    The dictionaries travel with the task: at most ``DICT_BYTES`` for each language.
    """

    @F.pandas_udf("struct<pred string, score double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(dictionaries)
        for texts in batches:
            yield pd.DataFrame([scorer(t) for t in texts], columns=["pred", "score"])

    out = df.withColumn("_lid", predict(F.col(text)))
    pred, score = F.col("_lid.pred"), F.col("_lid.score")
    return out.withColumns({
        f"{prefix}pred": pred, f"{prefix}score": score,
        f"{prefix}rejected": (pred == UNDETERMINED) | (score < min_margin)}).drop("_lid")


def held_out(key: str = "doc_id"):
    """The rows whose labels are kept away from learning: crc32 of the key's text mod 5 is 0.

    A row without a key has no remainder and counts as held out.
    """
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))
