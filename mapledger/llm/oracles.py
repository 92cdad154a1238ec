"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .licence_texts import KNOWN
from .licences import COPYRIGHT_LINE, SPELLINGS

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""
SELECT doc_id, row, '{kind}' AS kind, {rank} AS rank,
       list_sum([length(g) for g in gaps[1:i]]) + coalesce(list_sum([length(m) for m in whole[1:i - 1]]), 0) AS a,
       length(whole[i]) AS n
FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i
      FROM (SELECT doc_id, row, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS whole,
                   regexp_extract_all(t, '{pattern}', {group}) AS part FROM d))
WHERE length(part[i]) >= {least}"""


# A run of at least so many characters is a maximal run that is long enough.
SECRETS = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents),
s AS ({_spans('assign', 0, _ASSIGN, 2, 12)}
UNION ALL {_spans('access', 1, 'AKIA[A-Z0-9]{14,}', 0, 18)}
UNION ALL {_spans('hex', 2, '[0-9a-f]{16,}', 0, 16)}),
g AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, rank) AS spans FROM s GROUP BY row)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)"""


def _digit(i: int, j: int) -> str:
    """The j-th base-32 digit of the i-th five hexadecimal digits."""
    value = " + ".join(f"(strpos('0123456789abcdef', x[{5 * i + k + 1}]) - 1) * {16 ** (4 - k)}" for k in range(5))
    return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({value}) // {32 ** (3 - j)}) % 32, 1)"


CAPTURES = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS x FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS response FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       {' || '.join(_digit(i, j) for i in range(8) for j in range(4))} AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM r"""


def _canonical(text: str) -> str:
    """List of canonical lines of a text expression."""
    # DuckDB's expressions have no possessive quantifiers and need none.
    plain = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE.replace(')++', ')+')}', '', 'g')"
    plain = f"regexp_replace({plain}, 'https?://', ' ', 'g')"
    plain = f"regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for old, new in SPELLINGS.items():
        plain = f"replace({plain}, '{old}', '{new}')"
    return f"[trim(l) for l in string_split({plain}, chr(10)) if trim(l) <> '']"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENCES = f"""
WITH k AS (SELECT min(name) AS licence, sha256(array_to_string(lines, ' ')) AS digest
           FROM (SELECT name, {_canonical('words')} AS lines
                 FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(t)})' for n, t in KNOWN.items())}) v(name, words))
           GROUP BY digest),
d AS (SELECT doc_id, row_number() OVER () AS row, {_canonical("coalesce(text, '')")} AS lines FROM documents),
n AS (SELECT row, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
      FROM (SELECT row, unnest(lines) AS line FROM d) JOIN k ON k.digest = sha256(line) GROUP BY row),
w AS (SELECT doc_id, row, sha256(array_to_string(lines, ' ')) AS digest FROM d)
SELECT w.doc_id, w.digest AS licence_digest, k.licence, coalesce(n.notices, '') AS notices
FROM w LEFT JOIN k ON k.digest = w.digest LEFT JOIN n USING (row)"""


def _shingles(table: str, key: str) -> str:
    return f"""
SELECT DISTINCT {key}, row, array_to_string(w[i:i + 4], ' ') AS s
FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i
      FROM (SELECT {key}, row_number() OVER () AS row, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w
            FROM {table} WHERE text IS NOT NULL))"""


CONTAMINATION = f"""
WITH d AS ({_shingles('documents', 'doc_id')}), i AS ({_shingles('benchmark', 'item_id')}),
n AS (SELECT row, count(*) AS shingles FROM i GROUP BY row)
SELECT d.doc_id, i.item_id, n.shingles, count(*) AS held
FROM d JOIN i USING (s) JOIN n ON n.row = i.row
GROUP BY d.doc_id, d.row, i.item_id, i.row, n.shingles
HAVING count(*) >= ceil(n.shingles * 0.8 - 1e-9)"""

TOP_K = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5"""

# CRC-32 of a number's decimal digits, bit by bit.
_BITS = "list_reduce(list_concat([xor(a, x)], range(8)), lambda b, i: xor(b >> 1, (b & 1) * 3988292384))"
_CRC = (
    "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(y)::BIGINT for y in string_split(conv_id::VARCHAR, '')]), "
    f"lambda a, x: {_BITS}))"
)

TRIE = rf"""
WITH t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(words ORDER BY turn NULLS FIRST, id) AS words FROM t GROUP BY conv_id),
h AS (SELECT *, {_CRC} % 4 AS h FROM own),
f AS (SELECT h.conv_id, list_concat(coalesce(b.ids[1:h.h], []), h.ids[h.h + 1:]) AS ids,
             list_concat(coalesce(b.words[1:h.h], []), h.words[h.h + 1:]) AS words
      FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, len(ids) AS n, d, ids[1:d] AS path, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
      FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM f)),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM p GROUP BY path, d),
children AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
k AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
below AS (SELECT path[1:a] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
          FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM k) GROUP BY 1)
SELECT k.conv_id, k.d AS depth, parent.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, k.ends_sha256
FROM k JOIN below USING (path) LEFT JOIN k parent ON k.d > 0 AND parent.path = k.path[1:k.d - 1]"""

ORACLES: dict[str, str] = {
    "op1_secret_scan": SECRETS, "op3_warc": CAPTURES, "op5_licences": LICENCES, "op6_decontamination": CONTAMINATION,
    "op9_topk": TOP_K, "op12_prefix_trie": TRIE,
}
