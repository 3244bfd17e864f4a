"""Token counts of texts, made by the tokenizer library in Arrow batches of even size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import tokenizers
from orderflow.llm.batches import even_batches


def token_counts(
    docs: DataFrame, tokenizer: str, *, id_column: str = "doc_id", text_column: str = "text", limit: int = 512
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer`` names a ``.json`` (tokenizers), ``.model`` (sentencepiece) or ``.tiktoken`` file. No
    token is added before or after a text; strings of special tokens inside it are handled as the
    library does by default. No shuffle: each task encodes its own rows and returns lengths only.

    A null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows give repeated
    rows; an empty table gives none; other columns are not read, whatever their names. A long text is cut
    at safe places, so that no batch grows with it.
    """
    shared = tokenizers.shipped(docs.sparkSession, tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = tokenizers.per_worker("counts", shared, tokenizers.count_memo)
        encode = None if memo else tokenizers.batch_ids(*shared.value)
        for batch in batches:
            texts = batch.column(1)
            totals = np.zeros(len(texts), np.int64)
            for part in even_batches(texts, cut=memo is not None):
                only = [text for _, text in part]
                counts = [sum(c) for c in memo.split_and_encode(only)] if memo else map(len, encode(only))
                np.add.at(totals, [row for row, _ in part], list(counts))
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(totals), pa.array(totals > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    counted = narrow.mapInArrow(count, "id long, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_column)
