"""Language identification by compression.

Each language gets a Zstandard raw-content dictionary made of a bounded sample
of its labelled texts.  A text is normalised (lower case, runs of letters joined
by single spaces) and compressed in pieces with every language's dictionary; the
language whose dictionary gives the fewest bytes wins.  The score is the winner's
lead over the runner-up relative to the runner-up's size; narrow leads are rejected.

Bounds (parameters): a language's dictionary has ``DICTIONARY_BYTES`` at most, taken from
``SAMPLE_TEXTS`` texts at most, ``SAMPLE_CHARS`` from the start of each.  They
bound the training sample only; prediction reads whole texts.

Defined results
* null text, and text without a letter: ``und``, score 0, rejected;
* a tie goes to the language whose name sorts first, with score 0;
* no labelled text at all: every text is ``und``; one language only: that one with score 1;
* labelled rows with null language or no letter are left out of the training sample;
* rows stay one to one; extra columns pass through, an output column whose name
  is taken gets a leading underscore; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loanlife.llm.common import free_name, low_hash

UNKNOWN = "und"
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 1500
DICTIONARY_BYTES = 96 * 1024
LEAST_BYTES = 16 * 1024  # a smaller sample of one language doesn't shorten the others' dictionaries
PIECE_BYTES = 2048       # compressed on its own, so that a long text cannot become its own dictionary
SHORT_BYTES = 256        # a shorter text is repeated
LEVEL = 9
MIN_SCORE = 0.004        # a narrower lead is rejected

_letters = regex.compile(r"\p{L}+")


def normalise(text: str | None) -> bytes:
    return " ".join(_letters.findall((text or "").lower())).encode("utf-8")


def training_sample(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, text) of up to ``texts`` distinct labelled texts a language, chosen by a hash of the text."""
    pieces = (labelled.where(F.col(lang_col).isNotNull())
              .select(F.col(lang_col).cast("string").alias("lang"), F.substring(text_col, 1, chars).alias("text"))
              .where(F.col("text").rlike(r"\p{L}")).withColumn("pick", F.xxhash64("text")))
    # Only about three times the sample, copies once, leaves the tasks, at any size of the table.
    # The share is one of the different texts: all copies have one hash, and pass or go together.
    counts = pieces.groupBy("lang").agg(F.approx_count_distinct("pick").alias("n"))
    chosen = F.lit(False)
    for row in counts.collect():
        chosen = chosen | ((F.col("lang") == row["lang"]) & low_hash(F.col("pick"), 3 * texts / row["n"]))
    first = Window.partitionBy("lang").orderBy("pick")
    return (pieces.where(chosen).dropDuplicates(["lang", "pick"])
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= texts).select("lang", "text", "pick"))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary of each language; collects the bounded sample only."""
    rows = training_sample(labelled, text_col, lang_col).collect()
    texts: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["pick"], r["text"])):
        clean = normalise(row["text"])
        if clean:
            texts.setdefault(row["lang"], []).append(clean)
    if not texts:
        return {}
    # The same amount for every language, so that none wins by a larger dictionary; but a
    # language with next to no sample doesn't take the others' away.
    least = min(sum(map(len, t)) + len(t) for t in texts.values())
    size = min(DICTIONARY_BYTES, max(least, LEAST_BYTES))
    return {lang: b" ".join(t)[:size] for lang, t in sorted(texts.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False, window_log=18)
            content.precompute_compress(compression_params=params)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=content, compression_params=params))

    def sizes(self, clean: bytes) -> list[int]:
        # The encoder stores what it cannot shorten by a few bytes; repetition lets short texts
        # pass that bar, and only the first copy can gain from a dictionary.
        if len(clean) < SHORT_BYTES:
            clean = b" ".join([clean] * (SHORT_BYTES // len(clean) + 2))
        pieces = [clean[i:i + PIECE_BYTES] for i in range(0, len(clean), PIECE_BYTES)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float]:
        clean = normalise(text)
        if not clean or not self.langs:
            return UNKNOWN, 0.0
        sizes = self.sizes(clean)
        order = np.argsort(sizes, kind="stable")
        if len(order) == 1:
            return self.langs[0], 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        return self.langs[order[0]], (second - best) / second


def identify(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
             min_score: float = MIN_SCORE) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    The dictionaries (at most ``DICTIONARY_BYTES`` a language) go to the tasks in a broadcast variable.
    """
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    at = df.columns.index(text_col)
    names = [free_name(df.columns, n) for n in ("lang_pred", "score", "rejected")]
    schema = T.StructType(df.schema.fields + [T.StructField(names[0], T.StringType()),
                                              T.StructField(names[1], T.DoubleType()),
                                              T.StructField(names[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            told = [classifier.predict(t) for t in batch.column(at).to_pylist()]
            score = [s for _, s in told]
            new = [pa.array([lang for lang, _ in told], pa.string()), pa.array(score, pa.float64()),
                   pa.array([lang == UNKNOWN or s < min_score for lang, s in told], pa.bool_())]
            yield pa.RecordBatch.from_arrays(batch.columns + new, names=batch.schema.names + names)

    return df.mapInArrow(run, schema)
