"""Token counts: Arrow batch encoding that returns lengths only.

A text is split at safe boundaries: runs of ASCII white space, which the
tokenizer's own pre-tokenizer never joins over, so the counts of the fragments
add up to the count of the whole text.  A fragment longer than
``FRAGMENT_BYTES`` is split further where an ASCII digit follows an ASCII
letter or digit (digits are pre-tokens of their own); one without such a place
is encoded as it is.  Fragments that repeat are encoded once: each worker
remembers lengths of short fragments (a cache that is dropped when full, which
changes no result).  Unknown fragments are encoded in batches of about
``BATCH_BYTES`` bytes of text whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 18
FRAGMENT_BYTES = 1 << 14
CACHE_ENTRIES = 400_000
CACHED_BYTES = 64

_DIGIT_CUT = re.compile(rb"(?<=[A-Za-z0-9])(?=[0-9])")


def fragments(text: bytes) -> list[bytes]:
    """The fragments of a text whose token counts add up to that of the text."""
    parts = text.split()          # bytes.split() cuts at exactly space and 9 to 13
    if len(text) > FRAGMENT_BYTES and any(len(p) > FRAGMENT_BYTES for p in parts):
        parts = [q for p in parts for q in (_DIGIT_CUT.split(p) if len(p) > FRAGMENT_BYTES else (p,))]
    return parts


class Counter:
    """Counts tokens of fragments with one tokenizer, remembering short ones."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self.known: dict[bytes, int] = {}

    def learn(self, unknown: list[bytes]) -> dict[bytes, int]:
        """Encode fragments in batches of equal bytes."""
        got: dict[bytes, int] = {}
        batch, size = [], 0
        for p in unknown:
            batch.append(p)
            size += len(p)
            if size >= BATCH_BYTES:
                self._encode(batch, got)
                batch, size = [], 0
        if batch:
            self._encode(batch, got)
        return got

    def _encode(self, batch: list[bytes], got: dict[bytes, int]) -> None:
        out = self.encoder.encode_batch_fast([p.decode("utf-8") for p in batch], add_special_tokens=False)
        got.update(zip(batch, map(len, out)))

    def count(self, texts: list[bytes]) -> list[int]:
        known, total = self.known, []
        parts = [fragments(t) for t in texts]
        unknown = {p for ps in parts for p in ps if p not in known}
        if len(known) + len(unknown) > CACHE_ENTRIES:
            unknown.update(p for ps in parts for p in ps if p in known)
            known.clear()
        got = self.learn(list(unknown))
        long = {p: n for p, n in got.items() if len(p) > CACHED_BYTES}
        known.update((p, n) for p, n in got.items() if len(p) <= CACHED_BYTES)
        for ps in parts:
            total.append(sum([known[p] if p in known else long[p] for p in ps] if long else map(known.__getitem__, ps)))
        return total


def _blocks(col: pa.Array, limit: int = 1 << 22) -> Iterator[list[bytes]]:
    """The texts of a batch (null: empty) in runs of about ``limit`` bytes."""
    run, size = [], 0
    for x in col:
        b = x.as_buffer()
        b = b.to_pybytes() if b is not None else b""
        run.append(b)
        size += len(b)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Return ``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Row by row, without a shuffle.  Null and empty texts have 0 bytes and 0
    tokens; ids may be null or repeat (each row is counted); other columns are
    ignored; an empty table gives an empty result.  The counts equal encoding
    the whole text without added special tokens, truncation or padding."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in batches:
            counter = counter or Counter(tokenizer_path)
            ids, texts = b.column(0), b.column(1)
            n_bytes, n_tokens = [], []
            for run_ in _blocks(texts):
                n_bytes += map(len, run_)
                n_tokens += counter.count(run_)
            n = np.array(n_tokens, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
