"""Packing of related documents into windows, by lexical retrieval from a sharded BM25 inverted index.

Documents are tokenised once, and their ids are stored. Corpus statistics (documents, tokens, documents that hold
each id) are counted over all of them; they hold one number for each entry of the vocabulary. Documents are
put in order of their rarest ids, by the vocabulary's own order of merges, so related ones lie side by side, and shards are runs
of that order with a bounded number of tokens; a group of copies of any size is cut into as many shards as it needs. In a shard, an inverted index of
the documents is scored by BM25. The first unused document is the seed of a window; unused neighbours follow by
falling score until the window is full, and what a cut neighbour has left is the next seed. Documents longer than a window
fill windows of their own first. The end of a shard is laid out in sequences of powers of two, which are not padded.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.session import fresh_path

from .common import text_or_empty
from .packing import byte_letters

TOKENIZER = "word_bpe_49k.json"
SEPARATOR = 2
WINDOW = 4096
# Tokens of a shard, and of a task, about.
SHARD_TOKENS = 1 << 21
TASK_TOKENS = 1 << 26
# BM25's saturation of repeated terms, and its weight of lengths.
K1, B = 1.2, 0.75
# Terms that more than one document in so many holds are frequent.
FULL_LINE = 8
# Words of a task's store; it keeps two stores.
STORE_WORDS = 400_000
# Letters of texts that are taken together, and one text more.
GROUP_LETTERS = 1 << 23
# Longer words are not remembered.
STORE_LETTERS = 64

# White space to Python alone.
SEPARATORS = "\x1c\x1d\x1e\x1f"
_OTHERS = re.compile("[^\0-\u00ff]")
# ASCII marks that no contraction begins with.
MARKS = "".join(map(chr, [*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))



class KnownWords(dict):
    """Ids of words, found when first asked for and kept unless the word is long; those asked for lately come from
    the store before this one."""

    def __init__(self, find: Callable[[str], bytes], before: dict[str, bytes]):
        super().__init__()
        self.find, self.before = find, before

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.find(word)
        if len(word) <= STORE_LETTERS:
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts, word by word, as the tokenizer drops white space and never joins across it.

    Words of letters up to U+00FF, perhaps with marks after them, are put in lower case and given to the library's model, as the
    tokenizer does; it cuts before such marks. Other words go to the library, and so do whole texts with one of its
    special tokens or a separator that only Python takes as white space. Stores of what is known are bounded.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.kind = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = {"H": "=u2", "I": "=u4"}[self.kind]
        self.model, self.letters = self.library.model, byte_letters()
        self.store = KnownWords(self.word, {})
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def piece(self, piece: str) -> bytes:
        """Ids of lower-case letters or of marks, by the library's model alone."""
        shown = piece if piece.isascii() else piece.translate(self.letters)
        ids = self.pieces[piece] = array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def word(self, word: str) -> bytes:
        letters = word.rstrip(MARKS) if len(word) <= STORE_LETTERS else ""
        if not letters.isalpha() or not (letters.isascii() or max(letters) < "\u0100"):
            return self.encode([word])[0]
        marks, letters, known = word[len(letters) :], letters.lower(), self.pieces
        ids = known.get(letters)
        if ids is None:
            ids = self.piece(letters)
        if not marks:
            return ids
        more = known.get(marks)
        return ids + (self.piece(marks) if more is None else more)

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in the machine's order of bytes, of texts taken together in groups of bounded size."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_LETTERS:
                yield from self.group(group)
                group, size = [], 0
        yield from self.group(group)

    def group(self, texts: list[str]) -> Iterator[bytes]:
        """The distinct words of a group are looked up once, and Arrow puts the texts' ids together."""
        if len(self.store) > STORE_WORDS:
            self.store.before = {}
            self.store, self.pieces = KnownWords(self.word, self.store), {}
        odd = [any(s in text for s in self.special) or any(s in text for s in SEPARATORS) for text in texts]
        # Letters up to U+00FF have one lower case wherever they stand.
        plain = ["" if o else t.lower() if t.isascii() or not _OTHERS.search(t) else t for t, o in zip(texts, odd, strict=True)]
        words = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        known = pa.array(list(map(self.store.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist())), pa.large_binary())
        joined = known.take(coded.indices)
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2] or b"")
        starts = offsets[words.offsets.to_numpy()].tolist()
        for text, o, start, end in zip(texts, odd, starts, starts[1:], strict=False):
            yield self.encode([text])[0] if o else data[start:end].tobytes()


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for a Python worker, kept from task to task."""
    return WordEncoder(path)


def rarest_two(ids: np.ndarray) -> tuple[int, int]:
    """The two ids that come last in the vocabulary, whose merges are in order of falling frequency; -1 where there is none."""
    if not len(ids):
        return -1, -1
    first = ids.max()
    others = ids[ids < first]
    return int(first), int(others.max()) if len(others) else -1


def stored_ids(docs: DataFrame, path: str, separator: int) -> DataFrame:
    """(number, doc_id, n, first, second, ids): every document's ids with the separator last, and its two rarest ids, numbered
    and written once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = array(encoder.kind, [separator])
        for batch in batches:
            # A few documents at a time, as one may be very long.
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = [x + end.tobytes() for x in encoder.ids(part.column(1).to_pylist())]
                lengths = [len(x) // end.itemsize for x in ids]
                first, second = zip(*[rarest_two(_unpacked(x, encoder.dtype)[:-1]) for x in ids], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(ids, pa.binary())],
                    ["doc_id", "n", "first", "second", "ids"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(encode, f"doc_id {kind}, n long, first int, second int, ids binary")
    rows = rows.select(F.monotonically_increasing_id().alias("number"), "*")
    place = fresh_path(docs.sparkSession, "token-ids")
    rows.write.option("compression", "zstd").parquet(place)
    return docs.sparkSession.read.schema(rows.schema).parquet(place)


def _unpacked(ids: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(ids, dtype)


def term_counts(parts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, term, count) of every distinct term of every part, by part and term."""
    lengths = np.array([len(p) for p in parts], np.int64)
    rows = np.repeat(np.arange(len(parts), dtype=np.int64) * size, lengths)
    found, counts = np.unique(rows + np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64), return_counts=True)
    return found // size, found % size, counts


def held_counts(stored: DataFrame, size: int, dtype: str) -> np.ndarray:
    """How many documents hold each id of the vocabulary, the separator apart: one number for each entry."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                parts = [_unpacked(x, dtype)[:-1] for x in batch.column(0).slice(start, 512).to_pylist()]
                held += np.bincount(term_counts(parts, size)[1], minlength=size)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(held[term], pa.int64())], ["term", "n"])

    counted = stored.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    held = np.zeros(size, np.int64)
    for term, n in counted.collect():  # as many rows as the vocabulary has entries, at most
        held[term] = n
    return held


def rarity(held: np.ndarray, documents: int) -> np.ndarray:
    """BM25's weight of each term."""
    return np.log1p((documents - held + 0.5) / (held + 0.5))


class Shard:
    """Windows of a bounded run of documents, given as (first id, ids without separator) of their last parts."""

    def __init__(self, parts: list[np.ndarray], weights: np.ndarray, mean: float):
        lengths = np.array([len(p) for p in parts], np.int64)
        row, term, count = term_counts(parts, len(weights))
        # The inverted index: postings by term, a row and its weight in each.
        order = np.argsort(term, kind="stable")
        self.row, term, count = row[order], term[order], count[order]
        scale = K1 * (1 - B + B * lengths[self.row] / mean)
        self.weight = weights[term] * count * (K1 + 1) / (count + scale)
        self.begin = np.searchsorted(term, np.arange(len(weights) + 1))
        self.parts, self.n = parts, len(parts)
        # Postings of frequent terms are full lines instead, at most FULL_LINE numbers for each posting.
        self.line = np.full(len(weights), -1)
        frequent = np.flatnonzero(np.diff(self.begin) * FULL_LINE > self.n)
        self.line[frequent] = np.arange(len(frequent))
        self.lines = np.zeros((len(frequent), self.n))
        held = self.line[term] >= 0
        self.lines[self.line[term[held]], self.row[held]] = self.weight[held]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the distinct terms of one."""
        terms = np.unique(self.parts[seed]).astype(np.int64)
        line = self.line[terms]
        whole, terms = self.lines[line[line >= 0]].sum(axis=0), terms[line < 0]
        lists = [slice(*ends) for ends in zip(self.begin[terms].tolist(), self.begin[terms + 1].tolist(), strict=True)]
        if not lists:
            return whole
        return whole + np.bincount(np.concatenate([self.row[x] for x in lists]), np.concatenate([self.weight[x] for x in lists]), self.n)


def windows(shard: Shard, lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (document, start, length), each a full window but the last; starts count from a document's part."""
    unused = np.ones(shard.n, bool)
    open_list: list[tuple[int, int, int]] = []
    seed, start = -1, 0
    first = 0
    while True:
        if seed < 0:
            while first < shard.n and not unused[first]:
                first += 1
            if first == shard.n:
                break
            seed, start = first, 0
            unused[seed] = False
        open_list, room = [(seed, start, lengths[seed] - start)], window - lengths[seed] + start
        carried, start = -1, 0
        if room:
            left = np.flatnonzero(unused)
            score = shard.scores(seed)[left]
            for i in left[np.argsort(-score, kind="stable")].tolist():
                unused[i] = False
                held = min(room, lengths[i])
                open_list.append((i, 0, held))
                room -= held
                if held < lengths[i]:
                    carried, start = i, held
                if not room:
                    break
        seed = carried
        if room:
            break
        yield open_list
        open_list = []
    if open_list:
        yield open_list


def in_powers(pieces: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces in turn, as one list if they fill a window, else in lists whose lengths are powers of two."""
    total = sum(n for *_, n in pieces)
    size = total if total == window else 1 << total.bit_length() - 1
    own: list[tuple[int, int, int]] = []
    room = size
    for i, start, n in pieces:
        while n:
            held = min(room, n)
            own.append((i, start, held))
            start, n, room, total = start + held, n - held, room - held, total - held
            if not room:
                yield own
                own, room = [], 1 << total.bit_length() - 1 if total else 0


def packed_shard(ids: list[np.ndarray], weights: np.ndarray, mean: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """The sequences of a shard's documents: (document, start, length) of all their ids, in turn."""
    rest = []
    for i, own in enumerate(ids):
        whole = len(own) // window * window
        yield from ([(i, a, window)] for a in range(0, whole, window))
        if whole < len(own):
            rest.append((i, whole))
    # The separator is no term.
    shard = Shard([ids[i][a:-1] for i, a in rest], weights, mean)
    for pieces in windows(shard, [len(ids[i]) - a for i, a in rest], window):
        for own in in_powers(pieces, window):
            yield [(rest[k][0], rest[k][1] + start, n) for k, start, n in own]


def pack_related(
    docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, separator: int = SEPARATOR, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` has columns doc_id and text; others are left out. Null text counts as empty, and an empty document is its
    separator alone; it is nobody's neighbour and fills what is left. Repeated rows and rows with null doc_id are
    packed one by one; equal scores go by the order of the shard, and there equal terms by the stored number. An empty
    table gives no rows. Sequences hold ``window`` tokens, at a shard's end a power of two.

    The ids are written once to the shared folder, so a lost executor costs no second tokenising.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    encoder = word_encoder(path)
    size, dtype = encoder.library.get_vocab_size(), encoder.dtype
    stored = stored_ids(docs, path, separator)
    documents, tokens = stored.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = held_counts(stored, size, dtype)
    weights, mean = rarity(held, documents), max(1.0, tokens / max(1, documents))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        doc_ids, own, held_tokens = [], [], 0

        def shard() -> pa.RecordBatch:
            nonlocal made
            rows = []
            for pieces in packed_shard(own, weights, mean, window):
                offset = 0
                for i, start, n in pieces:
                    part = own[i][start : start + n].astype("<u4")
                    rows.append((i, start, n, zlib.crc32(part.tobytes()), len(own[i]), made, offset))
                    offset += n
                made += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            ids = pa.chunked_array(doc_ids, kind_of_id).combine_chunks() if doc_ids else pa.array([], kind_of_id)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [ids.take(pa.array(columns[0], pa.int64())), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            kind_of_id = batch.schema.field("doc_id").type
            start = 0
            for k, ids in enumerate(batch.column("ids").to_pylist()):
                own.append(_unpacked(ids, dtype))
                held_tokens += len(own[-1])
                if held_tokens >= shard_tokens:
                    doc_ids.append(batch.column("doc_id").slice(start, k + 1 - start))
                    start = k + 1
                    yield shard()
                    doc_ids, own, held_tokens = [], [], 0
            doc_ids.append(batch.column("doc_id").slice(start))
        if own:
            yield shard()

    kind = dict(docs.dtypes)["doc_id"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // TASK_TOKENS))
    order = ["first", "second", "number"]
    runs = stored.drop("n").repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return runs.mapInArrow(pack, schema)


def related_report(docs: DataFrame) -> DataFrame:
    """The pieces of ``documents`` in sequences of 4096 tokens."""
    return pack_related(docs.select("doc_id", "text"))
