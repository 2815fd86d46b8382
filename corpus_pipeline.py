"""From raw documents to packed training sequences.

Each stage takes what the one before kept and calls one operator:

1. language identification: documents without a letter, or whose language is no
   more than a guess among those learned, go; a missing label is filled in;
2. SimHash near-duplicates: the document of the smallest id of each group stays;
3. suffix-array dedup: repeated passages (strings of ``REPEAT_BYTES``) are cut out of
   the texts;
4. source mixing: the words of each source are taken up to its target, as pieces
   of documents under their document's id;
5. harmonic packing: every piece becomes tokens of fixed-length sequences.

A stage's input may hold nulls in any column, repeated rows and further columns;
an empty input gives an empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import langid, mixing, packing, simhash, suffix_dedup
from newslens.llm.common import materialize, sheltered, table

#: A prediction is a guess unless its score is above an even share of the languages by
#: this part of what is left to certainty.
LANGUAGE_MARGIN = 0.1
#: 51 repeated words take 245 bytes at least in the given tables (median 317), so
#: passages of over 50 words lie in repeated strings of this many bytes.
REPEAT_BYTES = 240
#: Shorter than the operator's own anchor, as its windows are.
REPEAT_ANCHOR = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def known(rows: DataFrame) -> DataFrame:
        model = langid.learn(rows, langid.learnable())
        even = 1 / max(1, len(model.labels))
        found = langid.predict(model, rows, names=("found", "score"))
        return found.filter((F.col("found") != langid.UNDETERMINED) & (
            F.col("score") >= even + LANGUAGE_MARGIN * (1 - even))).withColumn(
            "lang", F.coalesce("lang", "found"))

    return sheltered(docs, ("doc_id", "text", "lang"), known)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def cut(rows: DataFrame) -> DataFrame:
        keep = tuple(c for c in rows.columns if c != "text")
        return (suffix_dedup.remove_repeats(rows, "text", keep, with_kept=True,
                                            length=REPEAT_BYTES, anchor_bytes=REPEAT_ANCHOR)
                .withColumn("text", F.col("kept"))
                .withColumn("n_chars", F.length("kept").cast(docs.schema["n_chars"].dataType)))

    return sheltered(docs, ("text", "n_chars"), cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixture, _, _ = mixing.mix(docs)
    pieces = mixing.piece_texts(docs, mixture)
    return pieces.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", identify_language), ("simhash_near_dedup", drop_near_duplicates),
          ("suffix_array_dedup", cut_repeats), ("source_mixing", mix_sources),
          ("harmonic_packing", pack_sequences)]

#: The model, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
