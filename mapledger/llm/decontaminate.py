"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if the document holds at least 0.8 of the item's distinct shingles of
five words. Items are partitioned by how many shingles they have, up to 8, 16, 32 and so on; the partition's
bounds set how many least hashes, its MinHash sketch, an item is indexed by. An item with q shingles may miss
floor(q / 5) of them, so of a sketch of that many and more, the surplus must be in the document: every
contained item is found. A sketch of a long document would lose a short item, so documents keep all their
shingles and look each one up, first in a filter of fixed size, then by a shuffled join.

Candidates are verified by the exact shingles as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import written

from .shingles import shingle_hashes, words

SHINGLE_WORDS = 5
# Surplus hashes of a sketch: how many of it a document must hold at least.
SURPLUS = 3
# Bits of the filter, which goes to every task: 4 MB whatever the tables hold.
FILTER_BITS = 1 << 25


def _missing(q: int, share: float) -> int:
    """How many of q shingles a document may miss."""
    return q - int(np.ceil(share * q - 1e-9))


def sketches(items: DataFrame, share: float) -> DataFrame:
    """(item, shingles, needed, hash): a row for each hash of each item's sketch.

    ``needed`` is how many hashes of the sketch any document that contains the item holds. Items with fewer
    than five words have no shingle and no row.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = np.unique(shingle_hashes(words(text or ""), SHINGLE_WORDS))
                q = len(hashes)
                if not q:
                    continue
                most = 1 << max(3, (q - 1).bit_length())
                size = min(q, _missing(most, share) + SURPLUS)
                needed = max(1, size - _missing(q, share))
                rows += [(item, q, needed, h) for h in hashes[:size].view(np.int64).tolist()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "shingles", "needed", "hash"])

    return items.select("item", "text").mapInArrow(sketch, "item long, shingles long, needed long, hash long")


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A bit for each hash by its lowest bits, set together in Spark; at most FILTER_BITS / 64 numbers."""
    bit = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long"))
    rows = hashes.groupBy(F.shiftright(bit, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("bits")
    ).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return held.view(np.uint64)


def contained_items(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.8, text: str = "text", key: str = "doc_id", item: str = "item_id"
) -> DataFrame:
    """(key, item, shingles, held, containment): a row for each document and item it contains.

    ``held`` counts the item's distinct shingles in the document. Words are runs of letters and digits in
    lower case. Null texts count as empty, and texts of fewer than five words, items or documents, contain
    nothing and are in nothing. Item and document keys may be null or repeated: each row is held by itself,
    and equal result rows of repeated rows stay. Empty tables give no rows. Other columns are not looked at.
    """
    # Numbers of rows are stored with them, so that no later plan can number them otherwise.
    named = benchmark.select(F.col(f"`{item}`").alias("name"), F.col(f"`{text}`").alias("text")).where("text is not null")
    items = written(named.withColumn("item", F.monotonically_increasing_id()), "items")
    sketch = written(sketches(items, share), "sketches")
    held = docs.sparkSession.sparkContext.broadcast(hash_filter(sketch.select("hash")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            rows, hits = [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                hashes = shingle_hashes(words(value), SHINGLE_WORDS)
                bit = hashes & np.uint64(FILTER_BITS - 1)
                found = hashes[(known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
                if len(found):
                    rows.append(row)
                    hits.append(np.unique(found).view(np.int64))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(hits, pa.list_(pa.int64()))],
                ["key", "text", "hits"],
            )

    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("text is not null")
    near = plain.mapInArrow(look_up, f"key {kind}, text string, hits array<long>")
    near = written(near.withColumn("doc", F.monotonically_increasing_id()), "look-up")
    hits = near.select("doc", F.explode("hits").alias("hash"))
    tallied = split_join(hits, sketch, ["hash"]).groupBy("doc", "item", "shingles", "needed").agg(F.count("*").alias("n"))
    candidates = written(tallied.where("n >= needed").select("doc", "item"), "candidates")
    of = benchmark.schema[item].dataType.simpleString()
    # A document's row comes before those of its candidates, so its shingles are made once, however many it has.
    held_by = split_join(candidates, items.select("item", "name", "text"), ["item"]).select(
        "doc", F.lit(1).alias("turn"), F.lit(None).cast(kind).alias("key"), "name", "text"
    )
    texts = split_join(near.select("doc", "key", "text"), candidates.select("doc").distinct(), ["doc"], "left_semi").select(
        "doc", F.lit(0).alias("turn"), "key", F.lit(None).cast(of).alias("name"), "text"
    )
    pairs = texts.unionByName(held_by).repartition("doc").sortWithinPartitions("doc", "turn").drop("doc")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def exact(value: str) -> set[str]:
            own = words(value)
            return {" ".join(own[i : i + SHINGLE_WORDS]) for i in range(len(own) - SHINGLE_WORDS + 1)}

        open_key, open_shingles = None, set()
        for batch in batches:
            rows, keys, shingles, kept = [], [], [], []
            values = batch.select(["turn", "key", "text"]).to_pylist()
            for row, value in enumerate(values):
                found = exact(value["text"])
                if not value["turn"]:
                    open_key, open_shingles = value["key"], found
                    continue
                rows.append(row)
                keys.append(open_key)
                shingles.append(len(found))
                kept.append(len(found & open_shingles))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field("key").type), batch.column("name").take(pa.array(rows, pa.int64())),
                 pa.array(shingles, pa.int64()), pa.array(kept, pa.int64())],
                ["key", "name", "shingles", "held"],
            )

    counted = pairs.mapInArrow(verify, f"key {kind}, name {of}, shingles long, held long")
    counted = counted.withColumn("containment", F.col("held") / F.col("shingles"))
    return counted.where(F.col("held") >= F.ceil(F.col("shingles") * share - 1e-9)).select(
        F.col("key").alias(key), F.col("name").alias(item), "shingles", "held", "containment"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """``docs`` without those that contain an item, all other rows with all their columns, whatever their names.

    Rows are told apart by the SHA-256 of doc_id and text, as rows that agree in both contain the same.
    """
    parts = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\n"), F.coalesce("text", F.lit("")))
    marked = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.unhex(F.sha2(parts.cast("binary"), 256)).alias("mark"))
    texts = marked.select("mark", F.col("row").getField("text").alias("text"))
    found = contained_items(texts, benchmark, share, key="mark").select("mark").distinct()
    kept = split_join(marked, found, ["mark"], "left_anti")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents and the benchmark items they contain."""
    return contained_items(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).select(
        "doc_id", "item_id", "shingles", "held"
    )
