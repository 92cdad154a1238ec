"""Plain versions of the operators, one row at a time, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

KINDS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
)


def secret_spans(text: str | None) -> list[tuple[int, int, str]]:
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern, group, least) in enumerate(KINDS)
        for m in pattern.finditer(text or "") if len(m[group]) >= least
    ]
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def simhash(text: str | None) -> int:
    data = (text or "").encode().lower()
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", data) if w]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def reachable(nodes: list, linked) -> dict:
    """The smallest node that each reaches, over all pairs."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(nodes):
            for b in nodes[i + 1 :]:
                if linked(a, b) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return least


def capture(pages: list[tuple]) -> set[tuple]:
    rows = [(i, (h or "").encode()) for i, _, h in pages]
    largest = defaultdict(list)
    for i, p in rows:
        if i is not None:
            largest[p].append(i)
    out = []
    for i, p in rows:
        top = max(largest[p], default=None)
        revisit = top is not None and i != top
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


def shingles(text: str | None) -> set[str]:
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def contained(docs: list[tuple], items: list[tuple], share: float = 0.8) -> list[tuple]:
    out = []
    for d, text in docs:
        for i, item in items:
            want = shingles(item)
            held = len(want & shingles(text))
            if want and held >= share * len(want) - 1e-9:
                out.append((d, i, len(want), held))
    return sorted(out, key=repr)


def top_k(rows: list[tuple], k: int = 5, every: int = 50) -> list[tuple]:
    sound = [
        (i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, q in sound:
        if i % every == 0:
            scores = sorted((-int(q @ v), j) for j, v in sound if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def prefix_trie(rows: list[tuple], family: int = 20) -> list[tuple]:
    """The nodes of the trie of (conv_id, turn, role, text), with every prefix of every conversation at hand."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members, full = defaultdict(list), {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = (own.get(c - c % family, [])[:h]) + own[c][h:]
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * words[p]
    return sorted((
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in m if len(full[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    ), key=repr)


def alignment(rows: list[tuple], encode_a, bytes_a, encode_b, bytes_b) -> list[tuple]:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), whole texts and all pairs of tokens.

    ``encode_a`` and ``encode_b`` give the ids of space+text and of text, ``bytes_a`` and ``bytes_b`` an id's bytes.
    """
    linked, counts, seen = [], defaultdict(int), []
    for _, text in rows:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, a)) != want or b"".join(map(bytes_b, b)) != want:
            a, b = [], []
        ends = [list(np.cumsum([len(w(i)) for i in ids], dtype=int)) for ids, w in ((a, bytes_a), (b, bytes_b))]
        spans = [list(zip([0, *e[:-1]], e)) for e in ends]
        pairs = [(x, y) for (s, e), x in zip(spans[0], a) for (t, f), y in zip(spans[1], b) if s < f and t < e]
        for p in pairs:
            counts[p] += 1
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = [
            "|".join(",".join(str(i) for (s, e), i in zip(sp, ids) if lo <= s and e <= hi) for sp, ids in zip(spans, (a, b)))
            for lo, hi in zip([0, *both[:-1]], both)
        ]
        linked.append(pairs)
        seen.append((len(a), len(b), groups))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted((
        (i, n_a, n_b, len(groups), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for (i, _), (n_a, n_b, groups), pairs in zip(rows, seen, linked)
    ), key=repr)


def main_texts(pages: list[tuple], parse, least: int = 3) -> tuple[dict, int]:
    """Texts of pages and how many blocks went: a subtree goes if that many contents of its host hold it."""
    parsed = [(i, url.split("/")[2], *parse(html)) for i, url, html in pages]
    held = defaultdict(set)
    for _, host, _, content, subtrees in parsed:
        for subtree, *_ in subtrees:
            held[host, subtree].add(content)
    texts, gone = {}, 0
    for i, host, blocks, _, subtrees in parsed:
        out = {k for x, first, behind in subtrees if len(held[host, x]) >= least for k in range(first, behind)}
        gone += len(out)
        texts[i] = "\n\n".join(t for k, (t, _) in enumerate(blocks) if k not in out)
    return texts, gone
