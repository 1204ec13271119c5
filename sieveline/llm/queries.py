"""The corpus operators as registered queries, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from sieveline.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    minhash_dedup,
    ngram_join,
    periodic_runs,
    ranked_search,
    sentencepiece_codec,
    substring_dedup,
    token_counts,
    token_output,
    warc,
)
from sieveline.llm.common import bound_batches
from sieveline.session import configure

Query = Callable[[SparkSession, str], DataFrame]
#: Rows per Arrow batch: texts are long, and a batch must fit a worker several times over.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return configure(spark)


def _query(build: Query) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    return call


def op1_language_id(spark, sf_dir):
    return language_id.predict(table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc(spark, sf_dir):
    kept = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.archive(table(spark, sf_dir, "pages")).select(*kept, "url_key", "captured")


def op4_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark, sf_dir):
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.summary(table(spark, sf_dir, "documents"))


def op10_token_output(spark, sf_dir):
    return token_output.write_and_index(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark, sf_dir):
    bound_batches(spark)
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark, sf_dir):
    bound_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.summary(periodic_runs.find_runs(docs, periodic_runs.repeating("doc_id", "text")))


def op13_minhash_dedup(spark, sf_dir):
    bound_batches(spark)
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


BUILDERS: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_ngram_join": op4_ngram_join,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_html_extraction": op7_html_extraction,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_token_output": op10_token_output,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_minhash_dedup": op13_minhash_dedup,
}


def queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in BUILDERS.items()}
