"""The corpus operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brookmart.llm import (alignment, decontamination, exact_dedup, importance, lexicon, licenses,
                           packing, quality, secrets, sharding, simhash, tokens, toxicity)
from brookmart.llm.common import prepare, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_simhash_components(spark, sf):
    """Connected near-duplicate fingerprints."""
    return simhash.near_components(read(spark, sf, "documents"))


@query
def op2_exact_dedup(spark, sf):
    """Groups of equal texts and the row of each that stays."""
    return exact_dedup.exact_dedup(read(spark, sf, "documents"))


@query
def op3_balanced_shards(spark, sf):
    """24 shards of nearly equal bytes."""
    return sharding.shard(read(spark, sf, "documents"))


@query
def op4_quality_grades(spark, sf):
    """Expected grade and tail probability of every document."""
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = quality.train(docs, labels.select("doc_id", quality.grade().alias("grade")))
    return quality.score(docs, model)


@query
def op5_compression_toxicity(spark, sf):
    """Toxicity score of every document."""
    docs = read(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf, "labels")))


@query
def op6_best_fit_packing(spark, sf):
    """Training sequences of four permitted lengths."""
    return packing.pack(read(spark, sf, "documents"))


@query
def op7_section_token_counts(spark, sf):
    """Tokens of every line of every document."""
    return tokens.count_sections(read(spark, sf, "documents"))


@query
def op8_license_scan(spark, sf):
    """License phrases and notices of every document."""
    return licenses.scan(read(spark, sf, "documents"), between=licenses.PARAGRAPH)


@query
def op9_secret_scan(spark, sf):
    """Secrets in every document."""
    docs = read(spark, sf, "documents")
    return secrets.scan(docs, secrets.train(docs))


@query
def op10_template_decontamination(spark, sf):
    """Documents that hold benchmark items, with the items."""
    return decontamination.contaminated(
        read(spark, sf, "documents"), read(spark, sf, "benchmark")).drop("row_key")


@query
def op11_importance_resampling(spark, sf):
    """A tenth of the documents, drawn towards the benchmark's words."""
    return importance.resample(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query
def op12_transducer_bpe(spark, sf):
    """Digests of every document's ids and of the text decoded from them."""
    return lexicon.digests(read(spark, sf, "documents"))


@query
def op13_cross_tokenizer_alignment(spark, sf):
    """How two tokenizers' tokens of every document overlap."""
    return alignment.aligned(read(spark, sf, "documents"), texts=False)


@query
def pipeline(spark, sf):
    """The five stages of the corpus pipeline."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)
