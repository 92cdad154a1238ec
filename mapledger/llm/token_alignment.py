"""Alignment of two tokenizers over exact copies once: a byte-level vocabulary (A) and a SentencePiece model (B).

Documents meet by their full texts, and a distinct text is tokenised and aligned once, with the number of its copies.
What comes of it is stored: numbers, a digest of the groups, and the text's pairs of ids with how often each is linked.
Counts of pairs over the corpus are sums of these by the number of copies. To score a text its pairs have to meet
the corpus-wide counts: those of the most frequent pairs, a bounded number, go along with the tasks, and only the pairs
that are not among them are joined. Measures of texts go back to documents by the SHA-256 of the text.

Both tokenizers begin anew at a single space between other characters, and at most marks after a word, so texts are put
together from parts, and equal parts are aligned once for as long as they stay in a task's bounded store.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import written

from .common import text_or_empty
from .packing import byte_letters

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Parts that a task remembers; longer parts are not remembered.
STORE_PARTS = 300_000
STORE_LETTERS = 64
# Pairs of ids whose counts go along with tasks, at most: some 17 bytes each.
KNOWN_PAIRS = 1 << 17

LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
# Marks that no contraction begins with.
MARKS = ".,;:!?*#%&$"
_CUT = r"(?<=[^\s▁])(?= [^\s▁])"
_BORDER = re.compile(f"(?<=[{LATIN}])[{re.escape(MARKS)}]")
_WORD = re.compile(f" ?[{LATIN}]+")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def bytes_of_a(vocabulary: dict[str, int]) -> dict[int, bytes]:
    """The bytes of each entry of a byte-level vocabulary; special tokens stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain}
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {i: bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode() for entry, i in vocabulary.items()}


def bytes_of_b(pieces: list[str]) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, and <0xHH> one byte."""
    return [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]


def links_and_groups(a: list[int], b: list[int], width_a: list[int], width_b: list[int]) -> tuple[list[int], str, int]:
    """Pairs ``b << 32 | a`` of tokens that overlap, the groups as text, and their number, of one run of bytes.

    ``width_a`` and ``width_b`` give tokens' lengths in bytes, which add up to the same.
    """
    pairs, groups = [], []
    next_a, next_b = iter(a), iter(b)
    x, y = next(next_a), next(next_b)
    ahead = width_a[x] - width_b[y]  # how much further A's token reaches than B's
    text_a, text_b = f"{x}", f"{y}"
    while True:
        pairs.append(y << 32 | x)
        if ahead > 0:
            y = next(next_b)
            ahead -= width_b[y]
            text_b += f",{y}"
        elif ahead < 0:
            x = next(next_a)
            ahead += width_a[x]
            text_a += f",{x}"
        else:
            groups.append(f"{text_a}|{text_b}")
            x = next(next_a, None)
            if x is None:
                return pairs, ";".join(groups), len(groups)
            y = next(next_b)
            ahead = width_a[x] - width_b[y]
            text_a, text_b = f"{x}", f"{y}"


class Aligner:
    """Aligns texts part by part, with a store of bounded size.

    A part is what follows a cut at a single space, or marks after Latin letters where no piece of B holds a letter
    and such a mark side by side, as then nothing is ever joined there; A begins anew at such marks too.
    """

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.model, self.letters = self.a.model, byte_letters()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a, self.bytes_b = bytes_of_a(self.a.get_vocab(with_added_tokens=True)), bytes_of_b(pieces)
        self.width_a = [len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)]
        self.width_b = list(map(len, self.bytes_b))
        joined = {m for p in pieces for m in _BORDER.findall(p)}
        marks = "".join(m for m in MARKS if m not in joined)
        self.cut = re.compile(_CUT + (rf"|(?<=[{LATIN}])(?=[{re.escape(marks)}]+(?: [^\s▁]|\Z))" if marks else ""))
        self.lead = len(self.b.encode("a"))
        self.store: dict[str, tuple] = {}

    def learn(self, parts: list[str]) -> dict[str, tuple]:
        """(pairs, groups, n_a, n_b, n_groups) of parts, or None for one that a tokenizer does not give back.

        Parts begin with a space, or are marks.
        """
        ids_a, others = {}, []
        for part in parts:
            if _WORD.fullmatch(part):
                ids_a[part] = [t.id for t in self.model.tokenize(part.translate(self.letters))]
            else:
                others.append(part)
        ids_a.update(zip(others, [e.ids for e in self.a.encode_batch_fast(others, add_special_tokens=False)], strict=True))
        ids_b = self.b.encode([p[1:] if p[0] == " " else f"a{p}" for p in parts], num_threads=1)
        known, width_a, width_b = {}, self.width_a, self.width_b
        for part, b in zip(parts, ids_b, strict=True):
            a, data = ids_a[part], part.encode()
            if part[0] != " ":
                b = b[self.lead :]
            if b"".join(map(self.bytes_b.__getitem__, b)) != data or b"".join(map(self.bytes_a.__getitem__, a)) != data:
                known[part] = None
                continue
            pairs, groups, n = links_and_groups(a, b, width_a, width_b)
            known[part] = array("q", pairs).tobytes(), groups, len(a), len(b), n
        self.store.update((p, x) for p, x in known.items() if x is not None and len(p) <= STORE_LETTERS)
        return known

    def texts(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, digest, pairs, counts) of each text; all nothing where a text has no tokens."""
        for text in texts:
            if len(self.store) > STORE_PARTS:
                self.store = {}
            parts = self.cut.split(" " + text)
            found = list(map(self.store.get, parts))
            if None in found:
                new = self.learn(list({p: None for p, x in zip(parts, found, strict=True) if x is None}))
                found = [new[p] if x is None else x for p, x in zip(parts, found, strict=True)]
            if None in found or not text:
                yield 0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
                continue
            pairs, groups, n_a, n_b, n = zip(*found, strict=True)
            linked = np.frombuffer(b"".join(pairs), np.int64)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            yield sum(n_a), sum(n_b), sum(n), len(linked), digest, *np.unique(linked, return_counts=True)


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for a Python worker, kept from task to task."""
    return Aligner(path_a, path_b)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.empty(0, np.int64)]).astype(np.int64), kind))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and each list's length."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy(zero_copy_only=False))


def aligned_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each distinct text that is not empty, written once: sha, copies, its numbers, pairs and their counts."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            # A few texts at a time, as one may be very long.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                *plain, digest, pairs, counts = zip(*own.texts(part.column(2).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in plain], pa.array(digest, pa.string()),
                     _lists(pairs, pa.int64()), _lists(counts, pa.int64())],
                    ["sha", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"],
                )

    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    schema = (
        "sha binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, counts array<long>"
    )
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return written(texts.select(sha.alias("sha"), "copies", "text").mapInArrow(align, schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold a pair, and whether no pair of its B id has more; written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                pairs, lengths = _flat(part.column(1))
                times = _flat(part.column(2))[0] * np.repeat(part.column(0).to_numpy(), lengths)
                order = np.argsort(pairs, kind="stable")
                pairs, times = pairs[order], times[order]
                first = np.flatnonzero(np.diff(pairs, prepend=-1))
                sums = np.add.reduceat(times, first) if len(first) else times
                yield pa.RecordBatch.from_arrays([pa.array(pairs[first], pa.int64()), pa.array(sums, pa.int64())], ["pair", "n"])

    counted = aligned.select("copies", "pairs", "counts").mapInArrow(count, "pair long, n long")
    counted = written(counted.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.shiftright("pair", 32)), "pair-counts")
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return written(counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def frequent_pairs(pairs: DataFrame, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in order, their counts and whether they are best: all whose count is at least a power of two, the least
    power that leaves ``known`` of them or fewer."""
    sizes = dict(map(tuple, pairs.groupBy(F.floor(F.log2("n")).cast("int")).count().collect()))  # a row for each power
    power = max(sizes, default=0) + 1
    while power > 0 and sum(n for p, n in sizes.items() if p >= power - 1) <= known:
        power -= 1
    if power > 62:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    rows = pairs.where(F.col("n") >= 1 << power).orderBy("pair").toArrow()
    return tuple(rows.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best"))


def align_tokenizers(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None, known: int = KNOWN_PAIRS) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``docs`` has columns doc_id and text; others are left out. Texts that are null or empty, and those that the tokens
    of A or B do not give back byte by byte, have no tokens: zeros and an empty digest. Repeated rows and rows with null
    doc_id get a row each and count as often. An empty table gives no rows. ``known`` bounds how many counts go along with
    tasks; the result does not depend on it.
    """
    path_a, path_b = tokenizer_a or public_tokenizers.path(TOKENIZER_A), tokenizer_b or public_tokenizers.path(TOKENIZER_B)
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    aligned = aligned_texts(docs, path_a, path_b)
    pairs = pair_counts(aligned)
    frequent, times, best = frequent_pairs(pairs, known)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                own, lengths = _flat(part.column(1))
                counts = _flat(part.column(2))[0]
                at = np.searchsorted(frequent, own)
                at[at == len(frequent)] = 0
                held = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
                row = np.repeat(np.arange(part.num_rows), lengths)
                sums, bests = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                np.add.at(sums, row[held], counts[held] * times[at[held]])
                np.add.at(bests, row[held], counts[held] * best[at[held]])
                ends = np.cumsum(np.bincount(row[~held], minlength=part.num_rows))[:-1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sums), pa.array(bests), _lists(np.split(own[~held], ends), pa.int64()),
                     _lists(np.split(counts[~held], ends), pa.int64())],
                    ["sha", "count_sum", "n_best", "pairs", "counts"],
                )

    scored = aligned.select("sha", "pairs", "counts").mapInArrow(
        score, "sha binary, count_sum long, n_best long, pairs array<long>, counts array<long>"
    )
    scored = written(scored, "scored")
    others = scored.select("sha", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("held"))))
    others = others.toDF("sha", "pair", "held")
    others = split_join(others, pairs, ["pair"]).groupBy("sha").agg(
        F.sum(F.col("held") * F.col("n")).alias("other_sum"), F.sum(F.col("held") * F.col("best").cast("long")).alias("other_best")
    )
    measures = aligned.drop("copies", "pairs", "counts").join(scored.drop("pairs", "counts"), "sha").join(others, "sha", "left")
    measures = measures.withColumns({
        "count_sum": F.col("count_sum") + F.coalesce("other_sum", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("other_best", F.lit(0)),
    })
    named = docs.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return split_join(named, measures, ["sha"], "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )


def alignment_report(docs: DataFrame) -> DataFrame:
    """The alignment of every text of ``documents``."""
    return align_tokenizers(docs)
