"""A corpus pipeline: language ID, line dedup, near duplicates, mixing, tokens.

``STAGES`` names the stages in order.  A stage takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``documents``.
``run`` applies them to ``documents``, each result written to the shared folder
and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast.llm import bpe, jaccard, langid, lines, mixing
from cohortcast.llm.common import OWN, staged, table

#: Each document is used once at most, a fifth of the tokens goes.
RECIPE = mixing.Recipe(weights=mixing.PRODUCTION.weights, share=0.8, max_epochs=1, seed=17)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: texts that are null or have no letter.

    The network learns from the documents' own ``lang``, and names the
    language of those without one.
    """
    model = langid.learn(docs)
    named = langid.predict(docs, model, label_col=f"{OWN}lang", score_col=f"{OWN}score")
    label = F.when(F.col(f"{OWN}lang") != langid.UNDETERMINED, F.col(f"{OWN}lang"))
    spoken = label.isNotNull() if model.languages else F.col("text").rlike(r"\p{L}")
    return named.where(spoken).select(*[F.coalesce("lang", label).alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later copies of three-line windows; a document that consists of
    copies alone goes, ``n_chars`` follows the text."""
    cut = lines.dedup_lines(docs, removed_col=f"{OWN}removed").where((F.col(f"{OWN}removed") == 0) | (F.length("text") > 0))
    return cut.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the smallest id."""
    return jaccard.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the documents that the weights of domains, languages and sources ask for."""
    return mixing.mix(docs, RECIPE, epoch_col=f"{OWN}epoch").drop(f"{OWN}epoch")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    both = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded_col="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("decoded"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("byte_bpe", byte_bpe)]

#: A trained network has no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
