"""Registered queries of the text operators: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptally.llm import base as B
from snaptally.llm import chat, classifier, decontaminate, divergence, lm, mixing, pii, quality, secrets, simhash
from snaptally.llm import spelling, tokens, urls


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return pii.digest(pii.detect(B.table(spark, sf_dir, "documents")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return secrets.digest(secrets.scan(B.table(spark, sf_dir, "documents")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return mixing.report(mixing.mix(B.table(spark, sf_dir, "documents")))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    turns = chat.with_probe(B.table(spark, sf_dir, "conversations"))
    return chat.digest(chat.format_conversations(turns))


def op2_tokens(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """``tokenizer``: a file name of the public tokenizers, or the path of a tokenizer file."""
    import public_tokenizers
    B.prepare(spark)
    path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
    return tokens.digest(tokens.count_tokens(B.table(spark, sf_dir, "documents"), path))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return simhash.digest(simhash.near_duplicates(B.table(spark, sf_dir, "documents"), shingle=3, max_bits=3))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return quality.digest(quality.assess(B.table(spark, sf_dir, "documents")))


def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    docs, labels = B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "labels")
    return classifier.digest(classifier.score(docs, labels))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return lm.digest(lm.score(B.table(spark, sf_dir, "documents")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    docs, benchmark = B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.find_contamination(docs, benchmark))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return divergence.audit(B.table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    return spelling.variants(B.table(spark, sf_dir, "documents"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.prepare(spark)
    pages = B.table(spark, sf_dir, "pages")
    return urls.digest(urls.judge(pages, outcome_col=urls.outcome(F.col("html")), rules=urls.RULES))


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_tokens, op3_simhash, op4_quality, op5_secrets, op6_mixing, op7_classifier, op8_chat, op9_lm,
    op10_decontaminate, op11_divergence, op12_spelling, op13_urls)}

ORACLE: dict[str, str] = {"op10_decontaminate": decontaminate.ORACLE_SQL, "op11_divergence": divergence.ORACLE_SQL,
                          "op13_urls": urls.ORACLE_SQL}
