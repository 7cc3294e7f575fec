"""Operator 5. Token counts from an exact length histogram.

Documents are encoded in Arrow batches and only their lengths leave the tasks; they are summed to a histogram of encoded
length. Suffix sums over the histogram answer, for every context limit, how many documents are longer, how many tokens remain
if texts are cut there, and the quantiles. The suffix sums run in two levels (blocks of lengths, then inside each block), so no
task sees the whole histogram.

Defined results: null and empty texts have length 0 and count as documents; special tokens' strings are ordinary text; an
empty table gives no rows; equal texts count once per row; extra columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that this vocabulary was made with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
BLOCK = 256


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def text_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of keep and n_tokens, the encoded length, of each document."""

    def run(batches):
        encode = encoder(vocabulary).encode_ordinary
        for b in batches:
            sizes = pa.array([len(encode(x)) if x else 0 for x in b.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], sizes], names=[*keep, "n_tokens"])

    df = docs.select(*keep, "text")
    schema = ", ".join(f"`{k}` {t}" for k, t in df.select(*keep).dtypes) + ", " * bool(keep) + "n_tokens long"
    return df.mapInArrow(run, schema)


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """From (n_tokens, n_docs): also docs_at_least, tokens_at_least, total_if_cut (all texts cut at this length), docs_up_to, total_docs, total_tokens."""
    h = histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / block).alias("block"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    after, every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", *[F.coalesce(F.sum(f"block_{x}").over(after), F.lit(0)).alias(f"{x}_after") for x in ("docs", "tokens")], *[F.sum(f"block_{x}").over(every).alias(f"total_{x}") for x in ("docs", "tokens")])
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = h.select("*", F.sum("n_docs").over(inside).alias("d"), F.sum("tokens").over(inside).alias("t")).join(blocks, "block")
    out = out.select("n_tokens", "n_docs", "tokens", (F.col("d") + F.col("docs_after")).alias("docs_at_least"), (F.col("t") + F.col("tokens_after")).alias("tokens_at_least"), "total_docs", "total_tokens")
    return out.select("*", (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("total_if_cut"), (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"))


def token_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return suffix_sums(cut_lineage(text_lengths(docs, vocabulary).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))))


def total_at(sums: DataFrame, limit: int) -> DataFrame:
    """One row: total_tokens when every text is cut at limit, for any limit; docs_cut, how many are longer."""
    longer = F.col("n_tokens") > limit
    return sums.agg(F.coalesce(F.sum(F.when(longer, limit * F.col("n_docs")).otherwise(F.col("tokens"))), F.lit(0)).alias("total_tokens"), F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("docs_cut"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the least length that at least the share q of the documents doesn't exceed; null for an empty table."""
    return sums.where(F.col("docs_up_to") >= q * F.col("total_docs")).agg(F.min("n_tokens").alias("n_tokens"))
