"""Token counts with an exact count at every prefix (dynamic programming).

``prefix_token_counts`` encodes every text once and stores, per code point,
how many tokens the prefix ending there has more than the one before. Every
later question about prefixes (how long may a text be for a budget, how many
tokens are left after a cut) is a running sum over that column
(``longest_prefixes``), without the tokenizer.

Defined results: a NULL or empty text has 0 bytes, 0 tokens and an empty
prefix column; a NULL ``doc_id`` stays NULL; repeated rows give repeated
results; of the input's columns only ``doc_id`` and ``text`` are read, so
others may have any name; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import by_batch
from finlake.llm.tokens import PrefixCounts, default_path, worker_table

#: Texts handled at a time inside a task.
ROWS = 256


def prefix_token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, prefix_deltas (little-endian signed 16-bit integers,
    one per code point; their running sum is the token count of each prefix)."""
    path = path or default_path()
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        table = worker_table(PrefixCounts, path)
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = [table.of_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([int(np.frombuffer(f, "<i2").sum(dtype=np.int64)) for f in found], pa.int64()),
                    pa.array(found, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "prefix_deltas"],
            )

    schema = f"doc_id {key}, n_bytes long, n_tokens long, prefix_deltas binary"
    return by_batch(docs.select("doc_id", "text"), work, schema)


def longest_prefixes(counts: DataFrame, budget: int) -> DataFrame:
    """doc_id, n_chars long: the longest prefix, in code points, of at most ``budget``
    tokens, read off the stored counts. (A longer prefix can have fewer tokens than a
    shorter one, so the last that fits is taken.)"""
    key = counts.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        found = []
        for deltas in batch.column("prefix_deltas").to_pylist():
            running = np.cumsum(np.frombuffer(deltas or b"", "<i2"), dtype=np.int64)
            fits = np.flatnonzero(running <= budget)
            found.append(int(fits[-1]) + 1 if len(fits) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "n_chars"]
        )

    return by_batch(counts.select("doc_id", "prefix_deltas"), work, f"doc_id {key}, n_chars long")


def token_counts(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens (the count at the whole text), over_limit."""
    counts = prefix_token_counts(docs, path)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
