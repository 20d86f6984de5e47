"""Token counts of all documents as an exact histogram of encoded lengths.

Each document is encoded once; what is shuffled is a row for each length and task. Suffix sums over the
histogram then answer, for every context limit, how many documents and tokens lie beyond it, how many tokens
remain when longer documents are cut at it, and at which quantile of the documents it lies. A limit that no document
has as its length joins the histogram as a length of no documents; ``quantile_lengths`` asks the other way round.

Defined cases: a NULL or empty text has length 0; repeated rows count as often as they occur; an empty table
gives an empty histogram, zeros at the limits asked for, no quantile, and NULL as the length at a share; a text of any
length is encoded as a whole; columns other than ``text`` are ignored or passed on.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import running_before

#: Lengths whose suffix sums one task computes.
LENGTH_BLOCK = 4096


def read_ranks(path: str) -> bytes:
    """The vocabulary file: a line for each token, base64 of its bytes and its rank."""
    with open(path, "rb") as file:
        return file.read()


def token_lengths(docs: DataFrame, ranks: bytes, pattern: str, out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of ``text``; strings that look like special tokens are ordinary text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        for batch in batches:
            lengths = [len(encode(x.as_py() or "")) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.int64())], names=schema.names)

    return docs.mapInArrow(add, schema)


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """n_tokens and n_docs: how many documents have that length."""
    return lengths.groupBy(F.col(column).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def context_table(counts: DataFrame, limits: Sequence[int] = (), block: int = LENGTH_BLOCK) -> DataFrame:
    """For each length of the histogram and each of ``limits``, taken as the context limit:

    docs_over and tokens_over (documents beyond the limit), docs_within and tokens_within, cut_total (tokens left
    when every document is cut at the limit) and quantile (share of the documents within it).
    """
    if limits:
        asked = F.explode(F.array(*(F.lit(n).cast("long") for n in sorted(set(limits)))))
        rows = counts.sparkSession.range(1).select(asked.alias("n_tokens"), F.lit(0).cast("long").alias("n_docs"))
        counts = counts.unionByName(rows).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    blocked = counts.select(
        "n_tokens",
        "n_docs",
        (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        (-F.floor(F.col("n_tokens") / block)).cast("long").alias("block"),
        F.lit(0).alias("all"),
    )
    longest_first = [F.col("n_tokens").desc()]
    summed = running_before(blocked, ["all"], "block", longest_first, "n_docs", "docs_over")
    summed = running_before(summed, ["all"], "block", longest_first, "tokens", "tokens_over")
    totals = blocked.agg(F.sum("n_docs"), F.sum("tokens")).first()
    docs, total = (F.lit(x or 0).cast("long") for x in totals)
    return summed.select(
        "n_tokens",
        "n_docs",
        "docs_over",
        "tokens_over",
        (docs - F.col("docs_over")).alias("docs_within"),
        (total - F.col("tokens_over")).alias("tokens_within"),
        (total - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("cut_total"),
        F.when(docs > 0, (docs - F.col("docs_over")) / F.nullif(docs, F.lit(0))).alias("quantile"),
    )


def quantile_lengths(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share and n_tokens: the least length that holds at least that share of the documents.

    ``table`` is a ``context_table``, read once for all shares; a share of 0 gives the shortest document.
    """
    lengths = table.where(F.col("n_docs") > 0)
    least = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("quantile") >= F.lit(float(s)), F.col("n_tokens"))).alias("n_tokens")) for s in shares]
    return lengths.agg(F.array(*least).alias("asked")).select(F.inline("asked"))
