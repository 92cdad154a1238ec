"""Secret scans through a trigram inverted index.

A rule is a regular expression. What any of its matches must contain is derived from the expression as a
Boolean query, an OR of ANDs of three-letter pieces. Postings say which texts hold which of these pieces;
the postings of an alternative are intersected by text, and only the texts that remain are searched with
the rule's expression. A rule with an alternative without any piece, such as a run of hex digits, has
nothing to look up and is searched in every text. All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as codes
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join

from .common import free_names, text_or_empty

# More alternatives than this are not kept apart: the query gets wider, never narrower.
MOST_ALTERNATIVES = 32
# Pieces of one alternative are bits of a long; further ones are not asked for.
MOST_PIECES = 60


@dataclass(frozen=True)
class Rule:
    """``kind`` names the rule. Matches are leftmost and do not overlap; one whose ``group`` has fewer than
    ``least`` characters is dropped after it has taken its place. ``any_case`` is about ASCII letters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# The three base rules. A run that is long enough is the whole run there is, so rules whose length
# is that of the match ask for it in the expression, and the many short runs of hex digits in words are no matches.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)


# A break in a run of known characters.
_GAP = "\0"


def _shapes(nodes) -> list[str]:
    """Texts that a match contains, one for each alternative, with a gap for what is not known."""
    shapes = [""]
    for code, value in nodes:
        if code is codes.LITERAL:
            parts = [chr(value)]
        elif code is codes.SUBPATTERN:
            parts = _shapes(value[-1])
        elif code is codes.BRANCH:
            parts = [shape for branch in value[1] for shape in _shapes(branch)]
        elif code in (codes.MAX_REPEAT, codes.MIN_REPEAT):
            low, high, inner = value
            inside = _shapes(inner)
            if (low, high) == (0, 1) and _GAP not in "".join(inside):
                parts = ["", *inside]
            elif low == 0:
                parts = [_GAP]
            elif low == high == 1:
                parts = inside
            else:
                parts = [shape + _GAP + shape for shape in inside]
        elif code is codes.AT:
            parts = [""]
        else:
            parts = [_GAP]
        if len(shapes) * len(parts) > MOST_ALTERNATIVES:
            parts = [_GAP]
        shapes = [shape + part for shape in shapes for part in parts]
    return shapes


def trigram_query(rule: Rule) -> list[list[str]]:
    """The alternatives of the rule's query, each a sorted list of lower-case pieces of three characters.

    Empty if some match need not contain any piece: the rule has to be searched everywhere.
    """
    query = []
    for shape in _shapes(parser.parse(rule.pattern)):
        runs = shape.lower().split(_GAP)
        pieces = sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)})[:MOST_PIECES]
        if not pieces:
            return []
        query.append(pieces)
    return [list(x) for x in dict.fromkeys(map(tuple, query))]


def postings(docs: DataFrame, pieces: list[str], key: str, text: str = "text") -> DataFrame:
    """The inverted index (piece, key) of the wanted pieces: one row for each text and piece it contains."""
    lower = F.lower(F.col(text))
    held = F.array_compact(F.array(*(F.when(F.contains(lower, F.lit(p)), F.lit(p)) for p in pieces)))
    return docs.select(key, held.alias("held")).select(key, F.explode("held").alias("piece"))


def candidates(index: DataFrame, queries: dict[str, list[list[str]]], key: str) -> DataFrame:
    """Texts (key, kinds) that satisfy at least one query, from postings alone.

    A bit for each piece of an alternative, joined by OR over the postings of a text, intersects them with
    a buffer of fixed size that combines before the shuffle.
    """
    columns, tests = [], []
    for kind, query in queries.items():
        full = []
        for i, pieces in enumerate(query):
            bit = F.lit(0).cast("long")
            for n, piece in enumerate(pieces):
                bit = F.when(F.col("piece") == piece, F.lit(1 << n).cast("long")).otherwise(bit)
            columns.append(F.bit_or(bit).alias(f"{kind}_{i}"))
            full.append(F.col(f"{kind}_{i}") == F.lit((1 << len(pieces)) - 1).cast("long"))
        test = full[0]
        for other in full[1:]:
            test = test | other
        tests.append(F.when(test, F.lit(kind)))
    kinds = F.array_compact(F.array(*tests))
    return index.groupBy(key).agg(*columns).select(key, kinds.alias("kinds")).where(F.size("kinds") > 0)


def rule_spans(rule: Rule, text: Column) -> Column:
    """The kept matches of a rule in a text as an array of (start, end) in code points, end exclusive.

    The text is what lies between matches and the matches in turn, so positions are running sums of lengths.
    """
    pattern = F.lit(rule.java)
    parts = F.arrays_zip(
        F.split(text, rule.java, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"))
        kept = F.when(F.length(x["part"]) >= rule.least, F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), kept.otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    searched = F.aggregate(parts, zero, step, lambda state: state["spans"])
    return F.when(F.rlike(text, pattern), searched).otherwise(none)


def _named(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
    ))


def _count(kind: str) -> Column:
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _scanned(docs: DataFrame, text: str, key: tuple[str, ...], rules: tuple[Rule, ...]) -> DataFrame:
    """(row, words, secrets): every row as a struct, its text, and its spans.

    Texts are moved once, in their rows, and stream past the candidates of their part: those are numbers, and the smaller
    side by far, so texts are not sorted.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    at = F.xxhash64(*(F.col(f"`{k}`") for k in key), F.col(f"`{text}`")).alias("at")
    keyed = docs.select(at, whole)
    queries = {rule.kind: query for rule in rules if (query := trigram_query(rule))}
    if queries:
        pieces = sorted({p for query in queries.values() for alternative in query for p in alternative})
        index = postings(docs.select(at, text_or_empty(F.col(f"`{text}`")).alias("words")), pieces, "at", "words")
        keyed = split_join(keyed, candidates(index, queries, "at").hint("shuffle_hash"), ["at"], "left")
    else:
        keyed = keyed.withColumn("kinds", F.array().cast("array<string>"))
    keyed = keyed.withColumn("words", text_or_empty(F.col("row").getField(text)))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    found = []
    for rank, rule in enumerate(rules):
        spans = rule_spans(rule, F.col("words"))
        if rule.kind in queries:
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(nothing)
        found.append(_named(spans, rank, rule.kind))
    secrets = F.array_sort(F.concat(*found)).alias("secrets")
    return keyed.select("row", "words", secrets)


def scan_secrets(
    docs: DataFrame, text: str = "text", key: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` with a column ``secrets``: array of (start, rank, end, kind), by start and then by rule.

    ``key`` names columns that tell rows apart well; rows that agree in key and text share their postings,
    which changes nothing, as they have the same spans. Null text counts as empty and has no spans; empty
    tables give empty results. All other columns are kept as they are, whatever their names; where one is called
    ``secrets``, the new column is ``secrets_2``, and so on.
    """
    name, = free_names(["secrets"], docs.columns)
    return _scanned(docs, text, key, rules).select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns), F.col("secrets").alias(name)
    )


def redact_secrets(
    docs: DataFrame, text: str = "text", mask: str = "[SECRET]", key: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans become one. Null text stays null, and all other
    columns stay as they are, whatever their names."""
    words = F.col("words")

    def step(state, s):
        before = F.when(s["start"] > state["at"], F.substring(words, state["at"] + 1, s["start"] - state["at"]))
        begun = F.concat(state["out"], F.coalesce(before, F.lit("")), F.lit(mask))
        fresh = (s["start"] >= state["at"]) | (state["at"] == 0)
        return F.struct(
            F.greatest(s["end"], state["at"]).alias("at"), F.when(fresh, begun).otherwise(state["out"]).alias("out")
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(
        "secrets", zero, step,
        lambda state: F.concat(state["out"], F.substring(words, state["at"] + 1, F.length(words))),
    )
    own = F.col("row").getField(text)
    clean = F.when(F.size("secrets") > 0, masked).otherwise(own)
    return _scanned(docs, text, key, rules).select(
        *(clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest columns of a scan of ``documents`` with the base rules."""
    scanned = scan_secrets(docs.select("doc_id", "text"))
    listed = F.array_join(
        F.transform("secrets", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
    counts = [_count(rule.kind) for rule in RULES]
    return scanned.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))
