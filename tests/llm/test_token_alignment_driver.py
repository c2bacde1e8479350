"""What the driver of the token alignment holds: no tokenizer of side A, no texts of segments, no counts that are read to the end."""

from __future__ import annotations

import pyspark
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tallyboard.llm import token_alignment as T
from tallyboard.llm.queries import TOKENIZERS


def test_driver_holds_little(spark, monkeypatch):
    collected, lent, gone = [], [], []
    to_arrow, destroy, broadcast = DataFrame.toArrow, pyspark.Broadcast.destroy, pyspark.SparkContext.broadcast

    before = T._byte_bpe.cache_info()
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: collected.append(self.columns) or to_arrow(self))
    monkeypatch.setattr(pyspark.Broadcast, "destroy", lambda self, *a: gone.append(self) or destroy(self, *a))
    monkeypatch.setattr(pyspark.SparkContext, "broadcast", lambda self, value: lent.append((broadcast(self, value), type(value))) or lent[-1][0])
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("alpha the of "), F.col("id").cast("string")).alias("text"))
    found = T.align(docs, T.files(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"), block_pairs=20)
    assert len(found.collect()) == 60
    assert T._byte_bpe.cache_info() == before  # the driver asked for no tokenizer
    assert len(collected) > 3 and not any("seg" in columns for columns in collected)
    # The vocabularies and every block of counts; the segments and their sums are for the result that is read later.
    assert [b for b, kind in lent if kind is tuple] == gone and len(gone) > 2
