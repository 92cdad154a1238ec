"""Token counts with a SentencePiece model, in Arrow functions that return lengths only.

Pieces of the model never reach over the start of a run of spaces, so a text may be cut before any space
that follows another character and the parts counted apart: the part after the cut gets the model's own
leading space in place of the one cut away. Counting part by part keeps every call small however long a
text is, and equal parts are counted once for as long as they stay in a task's bounded store.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

MODEL = "piece_bpe_32k.model"
# Parts that a task remembers, and bytes that go to the library at once.
STORE_PARTS = 400_000
CALL_BYTES = 1 << 20

_CUT = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


def safe_parts(text: str) -> list[str]:
    """Parts of a text whose token counts add up to the text's."""
    if "▁" in text or "  " in text or text[:1] == " " or text[-1:] == " ":
        return _CUT.split(text)
    return text.split(" ")


def utf8_length(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


class PieceCounter:
    """Counts tokens part by part, with a store of bounded size."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.store: dict[str, int] = {"": 0}

    def learn(self, parts: list[str]) -> None:
        if len(self.store) + len(parts) > STORE_PARTS:
            self.store = {"": 0}
        batch, size = [], 0
        for part in parts:
            batch.append(part)
            size += utf8_length(part)
            if size >= CALL_BYTES:
                self.count(batch)
                batch, size = [], 0
        self.count(batch)

    def count(self, batch: list[str]) -> None:
        if batch:
            self.store.update(zip(batch, map(len, self.model.encode(batch, num_threads=1)), strict=True))

    def counts(self, texts: list[str]) -> Iterator[int]:
        """Counts of texts, taken together in groups of about equal bytes."""
        start = 0
        while start < len(texts):
            end, size = start + 1, utf8_length(texts[start])
            while end < len(texts) and size + (own := utf8_length(texts[end])) <= 4 * CALL_BYTES:
                size += own
                end += 1
            yield from self.group(texts[start:end])
            start = end

    def group(self, texts: list[str]) -> list[int]:
        split = [safe_parts(text) for text in texts]
        wanted: set[str] = set()
        for parts in split:
            wanted.update(parts)
        new = [part for part in wanted if part not in self.store]
        if len(self.store) + len(new) > STORE_PARTS:
            new = list(wanted)
        self.learn(new)
        known = self.store
        return [sum(map(known.__getitem__, parts)) for parts in split]


@cache
def piece_counter(path: str) -> PieceCounter:
    """One counter for a Python worker, kept from task to task."""
    return PieceCounter(path)


def token_count(text: Column | str = "text", model: str | None = None) -> Column:
    """How many tokens the library gives for the whole text, as a long.

    Without begin, end or other added tokens; strings that look like special tokens are ordinary text, as is
    the library's default. Null and empty texts have none. ``model`` is a model file that every executor can
    open. As a column expression it leaves rows and other columns alone, whatever they hold or are called.
    """
    path = model or public_tokenizers.path(MODEL)

    @F.arrow_udf("bigint")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = piece_counter(path)
        for batch in batches:
            yield pa.array(list(counter.counts(batch.to_pylist())), pa.int64())

    return lengths(text_or_empty(text))


def token_report(docs: DataFrame, limit: int = 4096) -> DataFrame:
    """Token counts of every whole text of ``documents``."""
    counted = docs.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), token_count().alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
