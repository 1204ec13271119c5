"""Token counts by an exact histogram of encoded lengths.

Documents are encoded where they lie and only (length, number of documents) is shuffled, combined
on the map side.  Running sums from the long end, built per block of lengths and over the blocks,
then answer for every context limit: documents that are longer, tokens in all, tokens left after
truncation, and quantiles.

A literal added token of the file in a text counts as that token, as in the library.  A null or empty text has length 0 and is counted.  An empty table has an empty histogram.
Repeated rows count as often as they occur; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import slices, stored
from sieveline.llm.encoder import default_path, worker_encoder

#: Lengths per block of the running sums.
BLOCK = 1024


def token_count(text: Column, path: str | None = None) -> Column:
    """Ids that the vocabulary file gives a text."""
    path = path or default_path()

    @arrow_udf(T.LongType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(path)
        for batch in batches:
            texts = batch.to_pylist()
            parts = [pa.array(encoder.lengths(texts[a:b])) for a, b in slices([(t or "").encode("utf-8", "replace") for t in texts])]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.int64())

    return count.asNondeterministic()(text.cast("string"))


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """n_tokens, n_docs: how many documents have each length."""
    return docs.select(token_count(F.col("text"), path).alias("n_tokens")).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def length_table(histogram: DataFrame) -> DataFrame:
    """Per length that occurs, as a context limit: what lies at, above and below it.

    n_tokens, n_docs, docs_longer, tokens_longer (tokens of the longer documents), docs_total,
    tokens_total, truncated_total (tokens left if every document is cut at this length), and
    quantile (share of the documents that are no longer).
    """
    tokens = F.col("n_docs") * F.col("n_tokens")
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    sums = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    everything = Window.partitionBy(F.lit(0))
    carried = sums.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(everything).alias("docs_total"),
        F.sum("t").over(everything).alias("tokens_total"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = rows.join(carried, "block").select(
        "n_tokens",
        "n_docs",
        (F.col("d_above") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).alias("docs_longer"),
        (F.col("t_above") + F.coalesce(F.sum(tokens).over(inside), F.lit(0))).alias("tokens_longer"),
        "docs_total",
        "tokens_total",
    )
    truncated = F.col("tokens_total") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")
    return longer.withColumns(
        {"truncated_total": truncated, "quantile": 1 - F.col("docs_longer") / F.col("docs_total")}
    )


def truncated_totals(table: DataFrame, limits: list[int]) -> DataFrame:
    """limit, truncated_total for any context limits, from the table of lengths: the next length below decides."""
    asked = table.sparkSession.createDataFrame([(int(x),) for x in limits], "limit long")
    below = table.groupBy().agg(*[F.max(F.when(F.col("n_tokens") <= x, F.col("n_tokens"))).alias(f"l{i}") for i, x in enumerate(limits)])
    pick = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("limit"), F.col(f"l{i}").alias("n_tokens")) for i, x in enumerate(limits)])
    base = below.select(F.inline(pick)).join(table, "n_tokens", "left")
    totals = table.agg(F.max("docs_total").alias("all_docs"))
    none_below = F.col("n_tokens").isNull()
    cut = F.when(none_below, F.col("all_docs") * F.col("limit")).otherwise(
        F.col("truncated_total") + F.col("docs_longer") * (F.col("limit") - F.col("n_tokens"))
    )
    found = base.join(totals).select("limit", F.coalesce(cut, F.lit(0)).cast("long").alias("truncated_total"))
    return asked.distinct().join(found.distinct(), "limit")


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the least length that at least this share of the documents does not exceed."""
    least = table.groupBy().agg(*[F.min(F.when(F.col("quantile") >= s, F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)])
    pick = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)])
    return least.select(F.inline(pick))


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    return length_table(stored(length_histogram(docs, path), "lengths"))
