"""SimHash near-duplicates through a positional byte index with count filtering.

Fingerprints of 64 bits are eight bytes with positions. Two that differ in at most three bits differ in at
most three bytes, so they share five positional bytes at least. Postings of single bytes would be far too
long, so each posting is of three positional bytes: split the eight positions into two halves of four; five
shared positions put three in one half, and all four triples of each half are indexed. Members of a posting
are compared in blocks of bounded size: the shared positional bytes of a pair are tallied, pairs with five
or more are kept, and their differing bits are counted. Of the links found in a block only a spanning
forest leaves it, so a crowd of like fingerprints costs no more rows than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import written

from .common import utf8

SHINGLE_WORDS, SEED, MOST_BITS = 3, 42, 3
# At most three of eight bytes differ.
LEAST_BYTES = 8 - MOST_BITS
# Byte positions of each indexed key: all triples of each half.
KEYS = tuple(t for half in (range(4), range(4, 8)) for t in combinations(half, 3))
# Members of a posting that one block holds; a pair of blocks is compared in one step of a task.
BLOCK = 1024

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes) -> int:
    """The SimHash of a text in UTF-8 as a signed long; 0 for one without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    # Big-endian bytes, so that the first counted bit is the highest; values per byte are counted first.
    spread = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(spread[:, i], minlength=256) @ _BIT_OF_BYTE for i in range(8)])
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(text: Column | str = "text") -> Column:
    """The fingerprint of a whole text, as a long; null and empty texts have 0."""

    @F.arrow_udf("bigint")
    def computed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t) for t in batch.to_pylist()], pa.int64())

    return computed(utf8(text))


def _postings(known: DataFrame) -> DataFrame:
    """(fp, key): a fingerprint for each indexed triple, with the triple's number above its three bytes."""
    def byte(i: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * (7 - i)).bitwiseAND(F.lit(255).cast("long"))

    keys = []
    for number, triple in enumerate(KEYS):
        key = F.lit(number).cast("long")
        for i in triple:
            key = key * 256 + byte(i)
        keys.append(key)
    return known.select("fp", F.explode(F.array(*keys)).alias("key"))


def _forest(left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of linked pairs (i, j), those that first join two parts."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    for a, b in zip(left[pairs[0]].tolist(), right[pairs[1]].tolist(), strict=True):
        x, y = top(a), top(b)
        if x != y:
            above[max(x, y)] = min(x, y)
            yield a, b


def _linked(left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links between members of two blocks, or of one with itself, thinned to a spanning forest."""
    found = []
    for start in range(0, len(left), 256):
        differ = left[start : start + 256, None] ^ right[None, :]
        shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2, dtype=np.uint8)
        at = np.nonzero(shared >= LEAST_BYTES)
        close = np.bitwise_count(differ[at]) <= MOST_BITS
        rows, columns = at[0][close] + start, at[1][close]
        if same:
            later = rows < columns
            rows, columns = rows[later], columns[later]
        found.append((rows, columns))
    pairs = np.array([np.concatenate(x) for x in zip(*found, strict=True)])
    return list(_forest(left.view(np.int64), right.view(np.int64), pairs))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every cell; rows come sorted by cell, which may go on from batch to batch."""
    def links(members: list[np.ndarray], sides: list[np.ndarray], same: bool) -> list[tuple[int, int]]:
        fps, side = np.concatenate(members), np.concatenate(sides)
        if same:
            return _linked(fps, fps, True) if len(fps) > 1 else []
        return _linked(fps[side == 0], fps[side == 1], False)

    def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    cell, members, sides, found = None, [], [], []
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        keys = np.stack(columns[:3], axis=1)
        cuts = np.concatenate([[0], np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, [len(keys)]])
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if start == end:
                continue
            own = tuple(keys[start].tolist())
            if own != cell:
                if cell is not None:
                    found += links(members, sides, cell[1] == cell[2])
                cell, members, sides = own, [], []
            members.append(columns[4][start:end].view(np.uint64))
            sides.append(columns[3][start:end])
        if len(found) > 10_000:
            yield out(found)
            found = []
    if cell is not None:
        found += links(members, sides, cell[1] == cell[2])
    yield out(found)


def links(known: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect all that are connected."""
    index = _postings(known)
    sizes = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = split_join(index, sizes, ["key"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = shared.select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    cells = dealt.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp",
    )
    # Equal blocks meet themselves once; pairs of blocks meet with the lower one on side 0.
    spread = cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return spread.mapInArrow(_cells, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of an edge list reaches, by alternating stars.

    Each round hangs larger neighbours, then smaller ones, onto the least neighbour of a node, and is
    written to the shared folder; the number of rounds grows with the logarithm of the nodes. A node with
    many neighbours combines before the shuffle and its rows are joined by a splittable join.
    """
    edges = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "edges")
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = split_join(both, least, ["a"]).where("b > a").select(F.col("m").alias("a"), "b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = split_join(large, least, ["b"])
        hung = small.select(F.col("m").alias("a"), "b").union(
            small.where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        ).distinct()
        edges = written(hung, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    least = edges.groupBy("b").agg(F.min("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return least.select(F.col("b").alias("node"), "component").union(roots)


def place(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` with ``component``, the smallest fingerprint reachable from ``fp``, and ``component_id``, the
    smallest ``key`` of its rows.

    Nothing is gathered by fingerprint but smallest keys, so a group of copies of any size is one row of the
    index. ``rows`` is read twice and should be a written table.
    """
    known = written(rows.groupBy("fp").agg(F.min(f"`{key}`").alias("first")), "fingerprints")
    nodes = components(links(known.select("fp"))).withColumnRenamed("node", "fp")
    placed = known.join(nodes, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    firsts = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    return split_join(rows, split_join(placed.drop("first"), firsts, ["component"]), ["fp"], "left")


def keep_one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each component: the one with the smallest key, and of rows that share it any one.

    Documents of one fingerprint are linked whatever their texts, those without words (fingerprint zero)
    too; null text counts as empty. Null keys come after all others: a component keeps a row with a null key
    only if it has no other. Columns are kept, whatever their names.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(whole, fingerprints(F.col(f"`{text}`")).alias("fp")).withColumn("own", F.col("row").getField(key))
    placed = place(written(rows, "simhash-rows"), "own")
    least = placed.where(F.col("own").eqNullSafe(F.col("component_id"))).dropDuplicates(["component"])
    return least.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def simhash_report(docs: DataFrame) -> DataFrame:
    """Fingerprints in hexadecimal and components of all ``documents``; repeated rows stay."""
    placed = place(written(docs.select("doc_id", fingerprints().alias("fp")), "simhash-ids"))
    return placed.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
