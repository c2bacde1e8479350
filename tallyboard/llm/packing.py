"""Length buckets of least padding, and batches of bounded size inside them (operator 4).

A text of n tokens becomes pieces of `max_tokens` tokens and a rest. The histogram of piece
lengths over all documents has `max_tokens` rows at most and goes to the driver, where
dynamic programming finds the bucket boundaries: with b[j] the j-th length and N, S the
running numbers of pieces and of tokens, a bucket of the lengths after i up to j pads
b[j] * (N[j] - N[i]) - (S[j] - S[i]), and the best k buckets up to j extend the best k - 1
up to some i.

A batch of a bucket holds as many pieces as its boundary allows within `token_budget`. Pieces get
their place in a bucket without a sort of the bucket: each is dealt to one of `shards` by a hash,
numbered within it, and moved by the number of pieces in the shards before. There are as many
shards as keep each at about `SHARD_ROWS` pieces, however many there are, and the hash is of the row
and not of its content, so repeated rows part. All batches of a bucket but its last are full.

Defined results: a text without tokens, null or empty, is one row with n_tokens 0 and no
bucket, batch or place; repeated rows are packed each by itself; null ids are packed like
others; further columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.sources.scratch import written

MAX_TOKENS, TOKEN_BUDGET, BUCKETS, SHARDS = 2048, 32768, 8, 256
SHARD_ROWS = 1 << 18


def words(text: Column) -> Column:
    """The default length: words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The upper lengths of at most `buckets` buckets that pad least; the least such set from the right on ties."""
    order = np.argsort(lengths)
    b, c = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    m = len(b)
    if m <= buckets:
        return b.tolist()
    n, s = (np.concatenate([[0], np.cumsum(x)]) for x in (c, b * c))
    ends = np.arange(1, m + 1)
    best = np.full(m + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    choice = []
    for _ in range(buckets):
        total = best[:, None] + b[None, :] * (n[ends][None, :] - n[:, None]) - (s[ends][None, :] - s[:, None])
        total[np.arange(m + 1)[:, None] >= ends[None, :]] = np.iinfo(np.int64).max // 2
        choice.append(np.argmin(total, axis=0))
        best = np.concatenate([[np.iinfo(np.int64).max // 4], np.min(total, axis=0)])
    out, j = [], m
    for k in range(buckets - 1, -1, -1):
        out.append(int(b[j - 1]))
        j = int(choice[k][j - 1])
    return out[::-1]


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    token_budget: int = TOKEN_BUDGET,
    buckets: int = BUCKETS,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: Column | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start and n_tokens, bucket and its length, batch within the bucket, place in the batch."""
    if token_budget < max_tokens:
        raise ValueError("a batch has to hold one piece of max_tokens")
    n = (words(F.col(text_col)) if length is None else length).alias("_pk_n")
    counted = docs.select(F.col(id_col).alias("_pk_id"), n, F.xxhash64(text_col).alias("_pk_h"))
    last = F.greatest(F.lit(0), F.floor((F.col("_pk_n") - 1) / max_tokens))
    pieces = counted.select("_pk_id", "_pk_h", "_pk_n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"))
    pieces = pieces.select(F.monotonically_increasing_id().alias("_pk_row"), "_pk_id", "_pk_h", "piece", F.least(F.lit(max_tokens), F.col("_pk_n") - F.col("piece") * max_tokens).cast("long").alias("n_tokens"))
    pieces = written(pieces)
    histogram = pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()
    bounds = boundaries(np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), buckets) if histogram else []
    bucket = F.coalesce(*(F.when(F.col("n_tokens") <= x, F.lit(k)) for k, x in enumerate(bounds)), F.lit(None).cast("int"))
    shards = max(shards, -(-sum(r[1] for r in histogram) // SHARD_ROWS))
    dealt = pieces.withColumn("bucket", F.when(F.col("n_tokens") > 0, bucket)).withColumn(
        "_pk_shard", F.pmod(F.xxhash64("_pk_row"), F.lit(shards)).cast("int")
    )
    full = dealt.where("bucket is not null")
    before = Window.partitionBy("bucket").orderBy("_pk_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = full.groupBy("bucket", "_pk_shard").count().select("bucket", "_pk_shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_pk_before"))
    number = F.row_number().over(Window.partitionBy("bucket", "_pk_shard").orderBy("n_tokens", "_pk_id", "piece", "_pk_h", "_pk_row"))
    sizes = F.element_at(F.array(*(F.lit(x).cast("long") for x in bounds or [1])), F.col("bucket") + 1)
    placed = full.withColumn("_pk_number", number).join(offsets, ["bucket", "_pk_shard"])
    rank, room = F.col("_pk_before") + F.col("_pk_number") - 1, F.floor(F.lit(token_budget) / F.col("bucket_length"))
    placed = placed.withColumn("bucket_length", sizes).withColumns({"batch": F.floor(rank / room).cast("long"), "place": F.pmod(rank, room).cast("long")})
    start = (F.col("piece") * max_tokens).alias("start")
    columns = [F.col("_pk_id").alias(id_col), "piece", start, "n_tokens", "bucket", "bucket_length", "batch", "place"]
    none = {c: F.lit(None).cast("long") for c in ("bucket_length", "batch", "place")}
    return placed.select(*columns).unionByName(dealt.where("bucket is null").withColumns(none).select(*columns))
