"""A trie of conversation prefixes: ROLLUP over positional turn-id columns, block by block.

A turn's id is the SHA-256 of its role and text, so narrow rows go through the shuffles and texts do not. A
conversation is cut into blocks of ``BLOCK_TURNS`` columns. One GROUP BY over the key of the block's first node and
a ROLLUP of its columns gives all prefixes of all blocks of all conversations together; grouping_id tells how many
columns a prefix has. The last column of a full block holds the key of the node it ends at, which is what the next
block is keyed by. These keys do not depend on each other in turn: a key is the hash of the key of a run of blocks
before it and of the blocks since, run over run, so a conversation of any length takes a few joins, never one
task or one step for each block.

Sums over subtrees are sums over members, and so come from the same ROLLUP. Every node belongs to its smallest
member, and each conversation has its own nodes from some depth on. A leaf counts for the one it belongs to. Tokens
saved in a subtree are the words that its members other than the smallest have, below its top, at nodes which are
not their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import written

from .common import text_or_empty

# Turns in a block, blocks in a run, and neighbouring ids in a part of a list to be hashed.
BLOCK_TURNS = 8
RUN_BLOCKS = 64
LIST_IDS = 4096
# Conversations in a family, which share the first turns of the family's first conversation; fewer turns than SHARED.
FAMILY = 20
SHARED = 4

WORD = r"[^\x20\x09-\x0D]+"
# The end of a conversation that goes on in a further block.
_ON = BLOCK_TURNS + 1


def _key(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, words): every turn by its place in its conversation, from 1; written once.

    Turns are ordered by turn, null first, and repeated numbers by the turns' ids. Rows without conv_id take no part.
    Places come from one range-partitioned sort and a sum over one number per task, so a conversation of any length is
    spread over tasks.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    narrow = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", _key(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # Sorting by ranges looks at its rows twice; texts are hashed and their words counted once.
    narrow = written(narrow, "turn-ids")
    ordered = narrow.orderBy("conv_id", F.col("turn").asc_nulls_first(), "id", "words")
    stored = written(ordered.select("conv_id", "id", "words", F.spark_partition_id().alias("range_no"), within.alias("at")), "turns")
    # A conversation's rows before a range: one row for each range that holds some of it.
    parts = stored.groupBy("conv_id", "range_no").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("conv_id").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("conv_id", "range_no", "first", F.coalesce(ahead, F.lit(0)).alias("before"))
    placed = split_join(stored, parts, ["conv_id", "range_no"])
    return placed.select("conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("pos"), "id", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, own, shared), a row for each conversation, and the turns of all of them as rebuilt.

    Conversation c begins with the first crc32(c) % 4 turns of conversation c - c % 20, all if that has fewer, and
    goes on with its own turns after as many.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("shared", shared)
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED)).groupBy("conv_id")
    heads = heads.agg(F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("head"))  # SHARED - 1 turns at most
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = heads.withColumnRenamed("conv_id", "family")
    convs = lengths.withColumn("family", family).join(heads, "family", "left").drop("family")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,id:binary,words:bigint>>")), F.lit(1), F.col("shared").cast("int")))
    convs = convs.withColumn("begun", F.size("head").cast("long"))
    lent = convs.select("conv_id", F.inline("head"))
    after = turns.withColumn("shared", shared).where(F.col("pos") > F.col("shared"))
    after = split_join(after, convs.select("conv_id", "begun"), ["conv_id"])
    after = after.select("conv_id", (F.col("pos") - F.col("shared") + F.col("begun")).alias("pos"), "id", "words")
    total = F.col("begun") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    return convs.select("conv_id", total.alias("total")), lent.unionByName(after)


def path_keys(blocks: DataFrame, most: int) -> DataFrame:
    """(conv_id, idx, prior, after, words_before) of (conv_id, idx, digest, words), idx from 0 to ``most``.

    ``prior`` names all blocks of a conversation before a block and ``after`` those up to and with it. A key is made of
    the key of the whole runs before and of the digests in the open run.
    """
    if most < 0:
        raise ValueError("no blocks")
    run = F.floor(F.col("idx") / RUN_BLOCKS).cast("long")
    own = Window.partitionBy("conv_id", "run").orderBy("idx")
    to_here = own.rowsBetween(Window.unboundedPreceding, 0)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    # Every run holds RUN_BLOCKS rows at most.
    rows = blocks.withColumn("run", run).withColumns({
        "here": F.reduce(F.collect_list("digest").over(to_here), F.lit(b""), lambda a, x: F.concat(a, x)),
        "left": F.reduce(F.collect_list("digest").over(before), F.lit(b""), lambda a, x: F.concat(a, x)),
        "sum": F.coalesce(F.sum("words").over(before), F.lit(0)),
    })
    upper = rows.groupBy("conv_id", F.col("run").alias("idx")).agg(
        F.max_by("here", "idx").alias("digest"), F.sum("words").alias("words")
    ).withColumn("digest", _key(F.col("digest")))
    if most < RUN_BLOCKS:
        upper = upper.select("conv_id", "idx", F.lit(b"").alias("prior"), F.col("digest").alias("after"), F.lit(0).cast("long").alias("words_before"))
    else:
        upper = path_keys(written(upper, "runs"), most // RUN_BLOCKS)
    upper = upper.select("conv_id", F.col("idx").alias("run"), F.col("prior").alias("up"), F.col("after").alias("up_after"), "words_before")
    ends = F.col("idx") % RUN_BLOCKS == RUN_BLOCKS - 1
    return split_join(rows, upper, ["conv_id", "run"]).select(
        "conv_id", "idx", _key("up", "left").alias("prior"), F.when(ends, _key("up_after")).otherwise(_key("up", "here")).alias("after"),
        (F.col("words_before") + F.col("sum")).alias("words_before"),
    )


def block_rows(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each block of a conversation: its columns t1.. and w1.., how it ends, and what precedes it."""
    block, place = F.floor((F.col("pos") - 1) / BLOCK_TURNS).cast("long"), (F.col("pos") - 1) % BLOCK_TURNS + 1
    at = [F.col("place") == j for j in range(1, BLOCK_TURNS + 1)]
    filled = turns.select("conv_id", block.alias("idx"), place.alias("place"), "id", "words").groupBy("conv_id", "idx").agg(
        # One turn in each place.
        F.array_sort(F.collect_list(F.struct("place", "id"))).alias("ids"),
        *[F.sum(F.when(own, F.col("words"))).alias(f"w{j}") for j, own in enumerate(at, 1)],
        F.sum("words").alias("words"),
    )
    digest = _key(F.reduce("ids", F.lit(b""), lambda a, x: F.concat(a, x["id"])))
    filled = written(filled.withColumn("digest", digest).withColumn("end", F.size("ids").cast("long")), "blocks")
    most = filled.agg(F.max("idx")).first()[0]
    if most is None:
        keys = filled.select("conv_id", "idx", F.lit(b"").alias("prior"), F.lit(b"").alias("after"), F.lit(0).cast("long").alias("words_before"))
    elif most == 0:
        none = F.lit(b"")
        keys = filled.select("conv_id", "idx", _key(none).alias("prior"), _key(F.col("digest")).alias("after"), F.lit(0).cast("long").alias("words_before"))
    else:
        keys = path_keys(filled.select("conv_id", "idx", "digest", "words"), most)
    rows = split_join(filled, keys, ["conv_id", "idx"]) if most else filled.join(keys, ["conv_id", "idx"])
    rows = split_join(rows, convs, ["conv_id"])
    rows = rows.withColumn("end", F.when(F.col("total") > (F.col("idx") + 1) * BLOCK_TURNS, _ON).otherwise(F.col("end")))
    full = F.when(F.size("ids") == BLOCK_TURNS, F.col("after"))
    columns = {f"t{j}": F.get("ids", F.lit(j - 1))["id"] for j in range(1, BLOCK_TURNS)} | {f"t{BLOCK_TURNS}": full}
    rows = rows.withColumns(columns).drop("ids", "digest", "after", "total")
    empty = convs.where("total = 0").select(
        "conv_id", F.lit(0).cast("long").alias("idx"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end"),
        _key(F.lit(b"")).alias("prior"), F.lit(0).cast("long").alias("words_before"),
        *[F.lit(None).cast("binary").alias(f"t{j}") for j in range(1, BLOCK_TURNS + 1)],
        *[F.lit(None).cast("long").alias(f"w{j}") for j in range(1, BLOCK_TURNS + 1)],
    )
    return written(rows.unionByName(empty), "block-rows")


def node_key(depth: Column) -> Column:
    """The key of the node with the first ``depth`` columns of a block."""
    inner = [F.when(depth == j, _key(F.col("prior"), *[F.col(f"t{i}") for i in range(1, j + 1)])) for j in range(1, BLOCK_TURNS)]
    return F.coalesce(F.when(depth == 0, F.col("prior")), F.when(depth == BLOCK_TURNS, F.col(f"t{BLOCK_TURNS}")), *inner)


def rolled_up(rows: DataFrame, *sums: Column) -> DataFrame:
    """A row for each node: key, parent_key, depth, conv_id, n_convs, first_end, last_end, words, words_before and sums."""
    ids = [f"t{j}" for j in range(1, BLOCK_TURNS + 1)]
    words = [f"w{j}" for j in range(1, BLOCK_TURNS + 1)]
    session = rows.sparkSession
    aggregates = [
        "min(conv_id) AS conv_id", "count(*) AS n_convs", "min(end) AS first_end", "max(end) AS last_end", "max(words_before) AS words_before",
        *[f"max({w}) AS {w}" for w in words], *sums,
    ]
    found = session.sql(
        f"SELECT idx, prior, {', '.join(ids)}, grouping_id() AS open_columns, {', '.join(aggregates)} "
        f"FROM {{rows}} GROUP BY idx, prior, ROLLUP({', '.join(ids)})", rows=rows,
    )
    # grouping_id has a one for each column that is rolled up, the last column's being the lowest.
    found = found.withColumn("j", F.lit(BLOCK_TURNS) - F.bit_count("open_columns"))
    found = found.where((F.col("j") == 0) & (F.col("idx") == 0) | F.coalesce(*[F.when(F.col("j") == j, F.col(t).isNotNull()) for j, t in enumerate(ids, 1)], F.lit(False)))
    held = [F.when(F.col("j") >= j, F.col(w)).otherwise(0) for j, w in enumerate(words, 1)]
    last = F.coalesce(*[F.when(F.col("j") == j, F.col(w)) for j, w in enumerate(words, 1)], F.lit(0))
    total = held[0]
    for x in held[1:]:
        total = total + x
    names = [s.rpartition(" AS ")[2] for s in sums]
    return found.select(
        node_key(F.col("j")).alias("key"), F.when(F.col("j") > 0, node_key(F.col("j") - 1)).alias("parent_key"),
        (F.col("idx") * BLOCK_TURNS + F.col("j")).cast("long").alias("depth"), "j", "conv_id", "n_convs", "first_end", "last_end",
        last.alias("words"), (F.col("words_before") + total - last).alias("words_above"), *names,
    )


def hashed_lists(ids: DataFrame) -> DataFrame:
    """(key, sha): the SHA-256 of a key's ids, ascending and joined by commas, of (key, conv_id).

    Lists are put together in parts of neighbouring ids, and a task feeds a key's parts to the hash in turn, so it
    holds one batch of parts however long a list is. The hash itself takes its bytes in order.
    """
    part = F.floor(F.col("conv_id") / LIST_IDS)
    parts = ids.groupBy("key", part.alias("part")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("text"))
    parts = parts.repartition("key").sortWithinPartitions("key", "part").select("key", "text")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state = None, None
        for batch in batches:
            keys, out = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != open_key:
                    if state:
                        keys.append(open_key)
                        out.append(state.hexdigest())
                    open_key, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "sha"])
        if state:
            yield pa.record_batch([pa.array([open_key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "sha"])

    return parts.mapInArrow(digests, "key binary, sha string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    ``conversations`` has conv_id, turn, role and text; other columns are left out. Null role or text counts as empty.
    Rows without conv_id take no part, repeated rows are turns of their own, and repeated turn numbers are ordered by
    the hash of role and text. Without any conversation there is no node, not even the root.
    """
    table = conversations.select("conv_id", "turn", "role", "text")
    convs, turns = rebuilt(written(turn_rows(table), "places"))
    convs = written(convs, "conversations")
    rows = block_rows(convs, turns)

    # Whose nodes, and where the conversations end.
    nodes = written(rolled_up(rows).drop("n_convs", "words_above"), "nodes")
    own = nodes.groupBy("conv_id").agg(F.sum("words").alias("own_words"), F.sum((F.col("last_end") == F.col("j")).cast("long")).alias("leaf"))
    ends = rows.where(F.col("end") <= BLOCK_TURNS).select("conv_id", "end", "prior", *[f"t{j}" for j in range(1, BLOCK_TURNS + 1)], (F.col("words_before") + F.col("words")).alias("all_words"))
    facts = split_join(ends.select("conv_id", "all_words"), own, ["conv_id"], "left").select(
        "conv_id", F.coalesce("leaf", F.lit(0)).alias("leaf"), (F.col("all_words") - F.coalesce("own_words", F.lit(0))).alias("lent_words")
    )
    facts = written(facts, "facts")

    # The same prefixes with sums over members; a block's row has its conversation's numbers.
    marked = split_join(rows, facts, ["conv_id"])
    summed = rolled_up(marked, "sum(leaf) AS n_leaves", "sum(lent_words) AS lent_words", "min_by(lent_words, conv_id) AS first_lent")
    children = nodes.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    lists = hashed_lists(ends.select(node_key(F.col("end")).alias("key"), "conv_id"))
    out = summed.join(children, "key", "left").join(lists, "key", "left")
    out = out.withColumn("parent_tag", F.coalesce("parent_key", F.lit(b"")))
    parents = nodes.select(F.col("key").alias("parent_tag"), F.col("conv_id").alias("parent_conv_id"))
    out = split_join(out, parents, ["parent_tag"], "left")
    saved = F.col("lent_words") - F.col("first_lent") - (F.col("n_convs") - 1) * F.col("words_above")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        saved.cast("long").alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """The prefix trie of ``conversations``."""
    return prefix_trie(conversations)
