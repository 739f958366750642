"""Token counts of whole texts, as the tokenizers library gives them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import append, arrow_map, fields
from wardline.llm.encoding import counter


def with_token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """The frame without its text and with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Only lengths come back from the Arrow function. Texts are cut where the byte-level pattern ends a
    match whatever stands around it, long ones in blocks first, and each distinct piece goes to the library
    once, in batches of about equal length; special strings inside texts are whole pieces and handled
    as the library does by default. A null text counts as empty: 0 bytes, 0 tokens. Other columns pass through, but
    for ones with the names of the results, which are replaced.
    """
    kept = docs.drop("n_bytes", "n_tokens").withColumn(
        "n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    )

    def run(batches):
        library = counter(path)
        for batch in batches:
            yield append(batch, [text], {"n_tokens": pa.array(library.count(batch.column(text)), pa.int64())})

    counted = arrow_map(kept, run, f"{fields(kept, [text])}, n_tokens bigint")
    return counted.drop("over_limit").withColumn("over_limit", F.col("n_tokens") > limit)
