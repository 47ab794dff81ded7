"""Token counts of whole texts, as the vocabulary's own library gives them.

Arrow batches go in and lengths alone come out.  A text is split at safe
boundaries: a single space between two non-white characters always opens a new
pre-token of the byte-level pattern (`` ?\\p{L}+`` and its like take the space
to their left, none takes one to its right), so the parts are encoded apart
and their lengths add up.  Words recur, so distinct parts are encoded once per
worker, in library batches balanced by bytes; the cache is emptied at
``CACHE_PARTS`` entries, which bounds memory and changes no count.

Special strings inside texts are handled by the library's default (they
contain no space, so no split goes through them).  Null and empty texts have 0
tokens; rows of equal doc_id are counted one by one.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.blocks import as_strings, bound_tables, bounded_batches

BATCH_BYTES = 1 << 18
CACHE_PARTS = 300_000
#: a space that is no safe boundary: at an end of the text or beside white space
_UNSAFE = re.compile(r"\A | \Z| \s|[^\S ] ")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def safe_parts(text: str) -> list[str]:
    """Parts whose token counts add up to the text's; each but the first begins
    with the space that it was split at, here left out."""
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


class TokenCounter:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[str, int] = {}

    def _learn(self, parts: list[str]) -> None:
        """Encode in batches of about ``BATCH_BYTES``, parts of like length together."""
        parts.sort(key=len)
        batch, held = [], 0
        for n, part in enumerate(parts):
            batch.append(part)
            held += 4 * len(part)
            if held >= BATCH_BYTES or n == len(parts) - 1:
                for p, e in zip(batch, self.library.encode_batch_fast(batch, add_special_tokens=False)):
                    self.known[p] = len(e)
                batch, held = [], 0

    def counts(self, texts: list[str]) -> list[int]:
        """Token counts of a few megabytes of texts."""
        split = [safe_parts(t) for t in texts]
        heads = {p[0] for p in split}
        spaced: set[str] = set()
        for p in split:
            spaced.update(p[1:])
        need = heads | {" " + s for s in spaced}
        if len(self.known) + len(need) > CACHE_PARTS:
            self.known.clear()
        self._learn([p for p in need if p not in self.known])
        tail = {s: self.known[" " + s] for s in spaced}
        return [self.known[p[0]] + sum(map(tail.__getitem__, p[1:])) for p in split]


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        counter = TokenCounter(path)
        for batch in batches:
            column = as_strings(batch.column(1))
            size = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            counts: list[int] = []
            texts, held = [], 0
            for n, text in zip(size.tolist(), column.to_pylist()):
                texts.append(text)
                held += n
                if held >= 8 * BATCH_BYTES:
                    counts += counter.counts(texts)
                    texts, held = [], 0
            counts += counter.counts(texts)
            tokens = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return bound_tables(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
