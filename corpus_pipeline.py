"""From raw documents to token ids: five stages, each written as Parquet and read again.

1. language identification: texts without a letter and undecided texts go;
2. exact deduplication: of equal texts the largest id stays;
3. n-gram Jaccard join: of each group of near copies the smallest id stays;
4. mixing: documents are put in Pfair order.  The target weight of a source is the
   square root of its rows by now; every document stays, and when a source runs out
   the others go on at theirs.  The rows are written in order of their slots;
5. byte-level BPE: ids and offsets, decoded again and compared, and the ``position`` of
   each document in the mixture, taken from the files that stage 4 wrote: a row keeps
   its file and its number in it however a reader splits or packs the files.

All stages but the last return the columns that they get.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlife.llm import byte_bpe, exact_dedup, jaccard_join, language_id, mixing
from loanlife.llm.common import free_name, ship_package, table
from loanlife.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MIX_PERIOD = 1000     # slots of a period; more for over ten sources
MIX_BLOCK = 1         # documents of a block
MIX_TEMPERATURE = 2.0 # target share of a source: the square root of its rows


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The dictionaries are fitted on a bounded sample of the documents that carry a language."""
    ship_package(spark)
    told = language_id.identify(docs, language_id.fit(docs))
    return told.where(~F.col(told.columns[-1])).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return index.kept_rows(docs, index.append(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_join.kept_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, period=MIX_PERIOD, temperature=MIX_TEMPERATURE, block_rows=MIX_BLOCK)
    slot, place = (free_name(docs.columns, n) for n in ("slot", "place"))
    return mixed.repartitionByRange(slot, place).sortWithinPartitions(slot, place).select(*docs.columns)


def positioned(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``position``: the place of a row in the stored order, from 0 without gaps.

    Files count in the order of the tasks that wrote them.  Rows that were not read from
    Parquet files have increasing positions with gaps.
    """
    try:
        at = docs.metadataColumn("_metadata")
        rows = docs.select(*columns, at["file_path"].alias("mix_file"), at["row_index"].alias("mix_row"))
    except AnalysisException:
        return docs.select(*columns, F.monotonically_increasing_id().alias("position"))
    files = [(r["mix_file"], r["count"]) for r in rows.groupBy("mix_file").count().collect()]

    def written(file: tuple[str, int]) -> tuple[int, str]:
        name = file[0].rsplit("/", 1)[-1]
        task = re.match(r"part-(\d+)", name)
        return int(task[1]) if task else 0, name
    starts, before = [], 0
    for path, n in sorted(files, key=written):
        starts.append((path, before))
        before += n
    starts = docs.sparkSession.createDataFrame(starts, "mix_file string, mix_start bigint")
    return rows.join(F.broadcast(starts), "mix_file", "left").select(
        *columns, (F.col("mix_start") + F.col("mix_row")).alias("position"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, offsets, whether decoding gives the text back, and the place in the mixture."""
    ship_package(spark)
    coded = byte_bpe.decode(byte_bpe.encode(positioned(docs, "doc_id", "lang", "source", "text"), RANKS), RANKS)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "offsets",
                        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("round_trip"),
                        "position")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

ORACLE_SQL = None     # SQL cannot compress texts or merge byte pairs; tests hold brute force against it


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
