"""One query per operator, over the whole tables of a folder."""

from __future__ import annotations

import os
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortair.llm import (
    collocations,
    decontaminate,
    language,
    language_model,
    licenses,
    quality,
    sentence_pieces,
    sharding,
    simhash,
    token_counts,
    toxicity,
    weighted_sampling,
    whitening,
)
from cohortair.llm.common import crc_fold, table
from cohortair.sources.session import tune

QUERIES = {}
# Vocabulary files lie in the folder of the package that brings them, unless this variable names another.
TOKENIZERS = "TOKENIZER_DIR"
SHINGLE, DISTANCE = 3, 3
TOKEN_LIMIT = 512
WINDOW = 10
MODEL_FOLDS = 10
LANGUAGE_FOLDS, HELD_OUT_LANGUAGE = 4, 2
SHARD_BYTES = 64 * 1024 * 1024
WHITENED = 16
PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.json"


def tokenizer(name: str) -> str:
    """Path of a vocabulary file, the same on every machine."""
    folder = os.environ.get(TOKENIZERS)
    if folder is None:
        folder = os.path.dirname(find_spec("public_tokenizers").origin)
    return os.path.join(folder, name)


def query(fn):
    """Registers a function of session and folder under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(tune(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def learned_trees(docs: DataFrame) -> language.Trees:
    """Trees of all rows but those held out."""
    return language.train(docs.where(crc_fold(F.col("doc_id"), LANGUAGE_FOLDS) != HELD_OUT_LANGUAGE))


@query
def op1_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), SHINGLE, DISTANCE)


@query
def op2_decontamination(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contamination(docs, items, WINDOW)


@query
def op3_licenses(spark, folder):
    return licenses.license_scan(table(spark, folder, "documents"))


@query
def op4_language_model(spark, folder):
    return language_model.lm_scores(table(spark, folder, "documents"), MODEL_FOLDS)


@query
def op5_sharding(spark, folder):
    return sharding.shards(table(spark, folder, "documents"), SHARD_BYTES)


@query
def op6_sentence_pieces(spark, folder):
    return sentence_pieces.digests(table(spark, folder, "documents"), tokenizer(PIECES))


@query
def op7_quality(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_language(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = crc_fold(F.col("doc_id"), LANGUAGE_FOLDS) == HELD_OUT_LANGUAGE
    return language.identify(docs, learned_trees(docs)).withColumn("held_out", held_out)


@query
def op9_weighted_sampling(spark, folder):
    return weighted_sampling.fingerprints(table(spark, folder, "documents"))


@query
def op10_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer(BYTES), TOKEN_LIMIT)


@query
def op12_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"), "embedding", "vec_id", WHITENED)


@query
def op13_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op11_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.scores(docs, table(spark, folder, "labels"))
