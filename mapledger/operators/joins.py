"""Joins that stay even under hot keys, and picks of one row that move only what is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` so that adaptive execution can split a hot key of ``left``.

    The runtime splits a hot partition only where both inputs arrive by an exchange made for
    this join. An aggregate on the same keys is partitioned already and gets none, so the
    keys are joined together with their hash, which no earlier step is partitioned by.
    """
    tag = "split_tag"
    tagged = [side.withColumn(tag, F.xxhash64(*on)) for side in (left, right)]
    return tagged[0].join(tagged[1], [*on, tag], how).drop(tag)


def picked(rows: DataFrame, keys: list[str], pick, order: Column) -> DataFrame:
    """One row of each group, chosen by ``pick``, which is ``F.max_by`` or ``F.min_by``, in ``order``.

    Every column is picked for itself by the same order, so all come from one row, and a column that nobody reads
    afterwards is neither sorted nor shuffled, as it would be inside a struct.
    """
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[pick(F.col(c), order).alias(c) for c in rest])


def digest(text: Column) -> Column:
    """128 bits of a text's SHA-256: a key to group and join long texts by, in 16 bytes."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


# Bits of the map that says which keys may meet a row: 4 MB, however many keys there are.
MARKS = 1 << 25


def seldom_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join of wide rows that mostly meet nothing: only rows that may meet one are moved.

    Keys of ``right`` are marked by hash in a bitmap, which is broadcast; rows of ``left`` whose mark is not set meet
    nothing and stay where they are. The more keys, the more other rows have a mark set by chance and are moved too.
    ``left`` is read twice, so it is to be a stored table.
    """
    place = F.pmod(F.xxhash64(on), F.lit(MARKS))
    # bitmap_bucket_number and bitmap_bit_position count from 1, 32,768 bits to a bucket.
    marks = right.select((place + 1).alias("place")).groupBy((F.bitmap_bucket_number("place") - 1).alias("marks_no")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("marks")
    )
    byte = F.conv(F.hex(F.substring("marks", F.expr("cast(marks_place % 32768 div 8 + 1 AS int)"), F.lit(1))), 16, 10).cast("int")
    marked = left.withColumn("marks_place", place).withColumn("marks_no", F.expr("marks_place div 32768"))
    may = F.coalesce(F.getbit(byte, F.expr("cast(marks_place % 8 AS int)")) == 1, F.lit(False)) & F.col(on).isNotNull()
    marked = marked.join(F.broadcast(marks), "marks_no", "left").withColumn("may_meet", may).select(*left.columns, "may_meet")
    met = split_join(marked.filter("may_meet").drop("may_meet"), right, [on], "left")
    return met.unionByName(marked.filter("NOT may_meet").drop("may_meet"), allowMissingColumns=True)
