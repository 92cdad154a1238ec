"""Licence scans by canonical digest.

A text is brought to a canonical form: ASCII lower case, copyright lines removed, equivalent spellings made
one, everything but letters and digits turned into single spaces. Its digest is joined by hash to the
digests of known licence texts, which are made in the same way. The same lookup, line by line, finds
licence notices that stand as a line of their own inside a longer document. DataFrame functions only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import written

from .common import free_names, text_or_empty
from .licence_texts import KNOWN

# Equivalent spellings, as commonly listed for comparing licence texts. They are replaced
# wherever they stand, also inside longer words: a canonical form has to be the same for equals, no more.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authoris": "authoriz", "cancelled": "canceled", "catalogue": "catalog", "categoris": "categoriz",
    "colour": "color", "emphasis": "emphasiz", "favour": "favor", "fulfill": "fulfil", "initialis": "initializ",
    "judgement": "judgment", "labour": "labor", "licence": "license", "maximis": "maximiz", "modelling": "modeling",
    "optimis": "optimiz", "organis": "organiz", "programme": "program", "realis": "realiz", "recognis": "recogniz",
    "utilis": "utiliz", "whilst": "while",
}

# Hexadecimal digits of a line's digest that are looked up: 128 bits.
MARK_DIGITS = 32

# A copyright line names its owner, so it differs between copies of one licence. Without a sign or year it is one if
# only such lines are between blank lines or begin the text: sentences may go on with "copyright" in a new line. The run
# of lines is possessive, so it takes no stack frame for each; as no such line is blank, it gives nothing back anyway.
COPYRIGHT_LINE = (
    r"(?m)(?:\A|^[^\p{L}\p{N}\n]*\n)(?:[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]{0,120}\n)++[^\p{L}\p{N}\n©]*$"
    r"|(?m)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*(?:\(c\)|©|\d{4})[^\n]*$|(?m)^[^\p{L}\p{N}\n]*all rights reserved\.?[^\p{L}\p{N}\n]*$"
)


def canonical_lines(text: Column) -> Column:
    """The canonical form of a text as an array of its lines that hold a letter or digit."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    plain = F.regexp_replace(plain, r"https?://", " ")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")
    for spelling, kept in SPELLINGS.items():
        plain = F.replace(plain, F.lit(spelling), F.lit(kept))
    return F.filter(F.transform(F.split(plain, "\n", -1), lambda line: F.trim(line)), lambda line: line != "")


def digest_of(lines: Column) -> Column:
    """The digest of a canonical text; line breaks count as spaces."""
    return F.sha2(F.array_join(lines, " "), 256)


def known_licences(spark: SparkSession, texts: dict[str, str] = KNOWN) -> DataFrame:
    """(digest, licence) of known texts, one row per digest: the first name in order of the alphabet."""
    given = json.dumps([{"licence": n, "words": t} for n, t in texts.items()])
    names = F.explode(F.from_json(F.lit(given), "array<struct<licence:string,words:string>>"))
    rows = spark.range(1).select(names.alias("known")).select("known.*")
    digests = rows.select("licence", digest_of(canonical_lines(F.col("words"))).alias("digest"))
    return written(digests.groupBy("digest").agg(F.min("licence").alias("licence")), "known-licences")


def find_licences(docs: DataFrame, known: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs``, with or without its texts, with licence_digest, licence and notices.

    ``licence`` is the known licence whose text the whole document is, else null. ``notices`` are the
    distinct names, sorted, of known texts that stand as a line of the document, empty if there are none.
    Null text counts as empty; a text without letters and digits has the digest of the empty text, which is
    no licence. Rows are kept one by one, repeated rows too, with all their columns; where one has the name of a new
    column, the new one gets ``_2`` and so on. ``known`` has columns digest and licence, one
    row per digest. Lines are looked up by the first half of their digests.
    """
    known = known.where(F.col("digest") != F.sha2(F.lit(""), 256)).select("digest", "licence")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns if keep_text or c != text), F.lit(0).alias("engine_pad")).alias("row")
    lines = docs.select(whole, canonical_lines(text_or_empty(F.col(f"`{text}`"))).alias("lines"))
    marks = F.transform("lines", lambda line: F.substring(F.sha2(line, 256), 1, MARK_DIGITS))
    # Canonical forms are made once; rows carry digests from here on, and a number of their own.
    rows = lines.select("row", digest_of(F.col("lines")).alias("digest"), F.array_distinct(marks).alias("marks"))
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "licence-digests")
    marked = known.select(F.substring("digest", 1, MARK_DIGITS).alias("mark"), "licence")
    single = rows.select("at", F.explode("marks").alias("mark"))
    notices = split_join(single, marked, ["mark"]).groupBy("at").agg(F.sort_array(F.collect_set("licence")).alias("notices"))
    found = split_join(rows.drop("marks"), known, ["digest"], "left")
    found = split_join(found, notices, ["at"], "left")
    kept = [c for c in docs.columns if keep_text or c != text]
    digest, licence, named = free_names(["licence_digest", "licence", "notices"], kept)
    return found.select(
        *(F.col("row").getField(c).alias(c) for c in kept),
        F.col("digest").alias(digest), F.col("licence").alias(licence),
        F.coalesce("notices", F.array().cast("array<string>")).alias(named),
    )


def licence_report(docs: DataFrame) -> DataFrame:
    """Licence and notices of every whole text of ``documents``."""
    found = find_licences(docs.select("doc_id", "text"), known_licences(docs.sparkSession), keep_text=False)
    return found.select("doc_id", "licence_digest", "licence", F.array_join("notices", ",").alias("notices"))
