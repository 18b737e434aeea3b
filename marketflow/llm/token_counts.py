"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled.

A first pass over all documents finds the frequent pre-tokens: every task keeps
a bounded sketch, and the sketches are merged in a tree, each merge cut back to
its heaviest entries. Their token counts, a table of at most ``FREQUENT``
entries whatever the input, are broadcast. The second pass looks each pre-token
up there, then in a bounded cache of its worker, and only then encodes it. The
table affects speed alone: any pre-token missing from it is encoded.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import worker_state
from marketflow.llm.tokens import Counts, Encoder, default_path

FREQUENT = 1 << 15  # entries of the broadcast table (under 1 MB)
SKETCH = 1 << 13  # entries a task reports
_OUT = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def _heaviest(counts: dict[str, int], most: int) -> dict[str, int]:
    if len(counts) <= most:
        return dict(counts)
    return dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most])


def _merge(a: dict, b: dict) -> dict:
    both = Counter(a)
    both.update(b)
    return _heaviest(both, FREQUENT)


def frequent_pre_tokens(texts: DataFrame, path: str) -> dict[str, int]:
    """The heaviest pre-tokens of the one text column, with lower bounds of their counts."""

    def sketch(batches):
        encoder = worker_state(("encoder", path), lambda: Encoder(path))
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(encoder.split(text.as_py() or ""))
                if len(seen) > 32 * SKETCH:
                    seen = Counter(_heaviest(seen, 8 * SKETCH))
        top = _heaviest({t: n for t, n in seen.items() if n > 1 and len(t) <= 64}, SKETCH)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(top)])], ["sketch"])

    sketches = texts.mapInArrow(sketch, "sketch string").rdd.map(lambda r: json.loads(r[0]))
    return sketches.treeAggregate({}, _merge, _merge)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer_path: str | None = None, limit: int = 1024) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit`` (n_tokens above ``limit``).

    Counts equal the library's ``encode(text, add_special_tokens=False)``; a null
    text is empty and has 0 tokens. Ids may be null or repeat; further columns
    are ignored; an empty table gives no rows.
    """
    path = tokenizer_path or default_path()
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encoder = Encoder(path)
    lengths = {t: len(encoder.pre_token(t)) for t in frequent_pre_tokens(rows.select("text"), path)}
    run_key = uuid.uuid4().hex
    table = docs.sparkSession.sparkContext.broadcast(zlib.compress(json.dumps(lengths).encode()))

    def run(batches):
        counts = worker_state(("counts", run_key),
                              lambda: Counts(json.loads(zlib.decompress(table.value)), path))
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(counts.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, _OUT)
