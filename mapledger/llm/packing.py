"""Packing of tokenised documents into sequences of a fixed length, by the sum-of-squares rule.

Documents are tokenised and cut in tasks that keep lengths and checksums only. A piece as long as a
sequence is one by itself. The others are dealt evenly to groups of bounded size, and each group is packed
by one task: pieces come by falling length, and each goes where the sum, over all gaps, of the squared
number of open sequences with that gap gets smallest. A group leaves a few sequences half empty at most,
so what grouping costs is a few sequences in many thousands.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.session import written

from .common import text_or_empty

TOKENIZER = "byte_bpe_50k.json"
# Bytes of a document's separator id, little-endian unsigned.
SEPARATOR = bytes(4)
# Parts that a task remembers.
STORE_PARTS = 600_000
# Pieces that one task packs, about.
GROUP_PIECES = 50_000

# A space between two spaces is the one place where cutting before a space could change tokens.
_UNSAFE = re.compile(r"\s \s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
# A line break beside other white space; one between words, or at an end, is a part by itself.
_BLANKS = re.compile(r"\s\n|\n\s")


# A word of plain or accented Latin letters, perhaps after a space, and marks that no contraction begins with.
_WORD = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")


def byte_letters() -> dict[int, str]:
    """What stands for a character below 256 in a byte-level vocabulary: a letter for each of its UTF-8
    bytes, which is the byte's own character if printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    letters = [chr(b) if b in plain else chr(next(free)) for b in range(256)]
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}


class PartEncoder:
    """Ids of whole texts, put together from the ids of parts that the tokenizer never joins.

    The tokenizer cuts a text before a single space that a word follows and a word precedes, and around a
    single line break between words, so the parts' ids in turn are the text's. Texts with one of its special tokens, and
    parts of other texts that are not yet in the bounded store, go to the library as they are.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model, self.letters = self.library.model, byte_letters()
        self.store: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def word(self, word: str) -> bytes:
        """Ids of one word of Latin letters, perhaps after a space, by the library's model alone."""
        return array("I", [t.id for t in self.model.tokenize(word.translate(self.letters))]).tobytes()

    def learn(self, parts: list[str]) -> None:
        others, store = [], self.store
        for part in parts:
            found = _WORD.fullmatch(part)
            if not found:
                others.append(part)
                continue
            word, marks = found.groups()
            ids = store.get(word)
            if ids is None:
                ids = store[word] = self.word(word)
            if marks:
                end = store.get(marks)
                if end is None:
                    end = store[marks] = self.encode([marks])[0]
                ids += end
            store[part] = ids
        if others:
            self.store.update(zip(others, self.encode(others), strict=True))

    def parts(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            return [text]
        if _UNSAFE.search(text) or "\0" in text:
            return _CUT.split(text)
        if "\n" in text and not _BLANKS.search(text):
            text = text.replace("\n", "\0\n\0")
        return text.replace(" ", "\0 ").split("\0")

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        store = self.store
        for text in texts:
            if len(store) > STORE_PARTS:
                store.clear()
            parts = self.parts(text)
            found = list(map(store.get, parts))
            if None in found:
                self.learn([part for part, ids in dict(zip(parts, found, strict=True)).items() if ids is None])
                found = list(map(store.__getitem__, parts))
            yield b"".join(found)


@cache
def part_encoder(path: str) -> PartEncoder:
    """One encoder for a Python worker, kept from task to task."""
    return PartEncoder(path)


def cut(ids: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids. Only a longer document is cut, and then its first
    piece is the one that may be shorter."""
    n = len(ids) // 4
    ends = list(range(n % size or size, n + 1, size)) if n > size else [n]
    starts = [0, *ends[:-1]]
    return [(i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(starts, ends, strict=True))]


def token_pieces(docs: DataFrame, size: int, path: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, the separator id last."""
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(path)
        for batch in batches:
            rows, values = [], []
            for row, ids in enumerate(encoder.ids(batch.column(1).to_pylist())):
                found = cut(ids + SEPARATOR, size)
                rows += [row] * len(found)
                values += found
            columns = list(zip(*values, strict=True)) or [()] * 4
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *arrays], ["doc_id", *[n for n, _ in fields]]
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut_batches, schema)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each of some lengths below ``size``, in the order given.

    ``open_count[g]`` is the number of open sequences with gap g. Putting a length s into one with gap g
    changes the sum of squares by 2 * (open_count[g - s] - open_count[g]) + 2, or by 1 - 2 * open_count[g]
    where the gap becomes zero, as a full sequence is not open. A new sequence is begun only if the length fits no open
    one, as few sequences are the aim. Of equally good places the smallest gap is taken.
    """
    open_count = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made, never = 0, np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        held, becomes = open_count[s:size], 2 * open_count[: size - s]
        becomes[0] = -1
        at = int(np.where(held > 0, becomes - 2 * held, never).argmin())
        if held[at]:
            gap = s + at
            own = stacks[gap].pop()
            open_count[gap] -= 1
        else:
            gap, own, made = size, made, made + 1
        sequence[i], offset[i] = own, size - gap
        if gap > s:
            stacks[gap - s].append(own)
            open_count[gap - s] += 1
    return sequence, offset


def pack_documents(
    docs: DataFrame, size: int = 2048, tokenizer: str | None = None, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``docs`` has columns doc_id and text; others are left out. Null text counts as empty, and an empty
    document is its separator id alone. Repeated rows and rows with null doc_id are packed one by one.
    An empty table gives no rows. ``tokenizer`` is a file that every executor can open.

    The pieces, without their ids, are written once to the shared folder, so a lost executor costs no second
    tokenising; a number stored with each deals it to a group.
    """
    pieces = token_pieces(docs, size, tokenizer or public_tokenizers.path(TOKENIZER))
    pieces = written(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == size
    full = pieces.where(whole).withColumns({"sequence_id": -1 - F.col("number"), "offset": F.lit(0).cast("long")})
    rest = pieces.where(~whole)
    groups = max(1, -(-rest.count() // group_pieces))
    rest = rest.withColumn("deal", F.pmod(F.xxhash64("number"), F.lit(groups)))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "number"], ascending=[False, True], kind="stable")
        sequence, offset = sum_of_squares(group["length"].to_numpy(), size)
        return group.assign(sequence_id=group["deal"] * (1 << 32) + sequence, offset=offset).drop(columns="deal")

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, number long, sequence_id long, offset long"
    packed = rest.groupBy("deal").applyInPandas(pack, schema)
    return full.unionByName(packed).drop("number")


def packing_report(docs: DataFrame) -> DataFrame:
    """The pieces of ``documents`` in sequences of 2048 tokens."""
    return pack_documents(docs.select("doc_id", "text"))
