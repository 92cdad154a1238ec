"""Alignment of tokenizers, packing of related documents and the prefix trie, against plain versions."""

from __future__ import annotations

import random
import zlib
from array import array
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from mapledger.llm import prefix_trie, retrieval_packing, token_alignment

ODD = [
    *" \t\n\x0b\x0c\r\x85\xa0  　​﻿'’.,-0a9bZéÉé▁Σσςİıß日本ก็\U0001f600\x1c\x00",
    "'s", "'ll", " the", " and", "I'M", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
]


def odd_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(ODD, k=draw.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return lambda t: a.encode(t, add_special_tokens=False).ids, lambda i: bytes(back[c] for c in a.id_to_token(i)), b.encode, bytes_b


@pytest.mark.parametrize("known", [token_alignment.KNOWN_PAIRS, 5, 0])
def test_alignment(engine, rows, libraries, known):
    docs = [*enumerate(odd_texts(600, 1)), (700, None), (701, ""), (None, "a b"), (702, "x" * 3000)]
    docs += [(800 + i, "hello world  foo") for i in range(10)] + [(3, "hello world  foo")]
    table = engine.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS sha", "2 AS pair")
    assert rows(token_alignment.align_tokenizers(table, known=known)) == brute.alignment(docs, *libraries)


def test_alignment_of_nothing(engine):
    assert token_alignment.align_tokenizers(engine.createDataFrame([], "doc_id long, text string")).collect() == []


def conversations(engine, turns):
    return engine.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS idx", "2 AS prior", "3 AS words")


def test_trie(engine, rows):
    draw = random.Random(3)
    turns = [(None, 0, "u", "lost")]
    for c in (0, 1, 2, 3, 7, 20, 21, 25, 40, 41, 43, 44, 45, 46, 1000):
        for t in range(draw.choice([1, 3, 8, 9, 16, 17, 40])):
            turns.append((c, draw.choice([None, t]) if t < 3 else t, draw.choice(["u", "a", None]) if t < 2 else "u", "x y" if t > 1 else draw.choice(["", None, "x\x0by", " a  b "])))
    turns += [(61, 0, "u", "again")] * 3
    got = prefix_trie.prefix_trie(conversations(engine, turns))
    assert rows(got) == brute.prefix_trie(turns)


def test_trie_of_long_conversations(engine, rows):
    """Longer than a run of blocks, parting late, and one that ends where a run does."""
    most = prefix_trie.BLOCK_TURNS * prefix_trie.RUN_BLOCKS
    turns = [(c, t, "u", f"w {t if t < most + 5 else t * c}") for c in (60, 61, 62) for t in range(most + 20)]
    turns += [(80, t, "u", f"w {t}") for t in range(most)]
    assert rows(prefix_trie.prefix_trie(conversations(engine, turns))) == brute.prefix_trie(turns)


def test_trie_of_nothing(engine):
    assert prefix_trie.prefix_trie(conversations(engine, [])).collect() == []
    assert prefix_trie.prefix_trie(conversations(engine, [(None, 1, "u", "x")])).collect() == []


def test_lists_are_hashed_in_parts(engine, rows):
    ids = [(b"k", i) for i in range(3 * prefix_trie.LIST_IDS)] + [(b"l", -5), (b"l", 7)]
    got = dict(rows(prefix_trie.hashed_lists(engine.createDataFrame(ids, "key binary, conv_id long").repartition(3))))
    import hashlib

    assert {bytes(k): v for k, v in got.items()} == {
        b"k": hashlib.sha256(",".join(map(str, range(3 * prefix_trie.LIST_IDS))).encode()).hexdigest(),
        b"l": hashlib.sha256(b"-5,7").hexdigest(),
    }


def check_pieces(got, ids, window):
    """Every id in one piece, right checksums, gapless sequences without padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[doc])
            at += p.length
            assert p.ids_crc32 == zlib.crc32(array("I", ids[doc][p.start : at]).tobytes())
        assert at == len(ids[doc])
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or at < window and at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("shard_tokens", [500, 1 << 21])
def test_related_packing(engine, shard_tokens):
    texts = [*odd_texts(400, 2), None, "", "word " * 3000, "x" * 9000, "<|endoftext|> and <|startoftext|>", "日本" * 2000, *["copy of one text"] * 50]
    table = engine.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS first", "'x' AS ids", "2 AS number")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    check_pieces(retrieval_packing.pack_related(table, 256, shard_tokens=shard_tokens).collect(), ids, 256)


def test_packing_of_nothing(engine):
    assert retrieval_packing.pack_related(engine.createDataFrame([], "doc_id long, text string")).collect() == []


def plain_windows(parts, weights, mean, window):
    """BM25 term by term and document by document; the best unused document each time."""
    counts = [defaultdict(int) for _ in parts]
    for own, part in zip(counts, parts):
        for t in part.tolist():
            own[t] += 1
    lengths = [len(p) for p in parts]

    def score(a, b):
        scale = retrieval_packing.K1 * (1 - retrieval_packing.B + retrieval_packing.B * lengths[b] / mean)
        return sum(weights[t] * counts[b][t] * (retrieval_packing.K1 + 1) / (counts[b][t] + scale) for t in sorted(counts[a]) if t in counts[b])

    unused, out, seed = set(range(len(parts))), [], None
    while unused or seed:
        if seed is None:
            seed = (min(unused), 0)
            unused.remove(seed[0])
        own = [(seed[0], seed[1], lengths[seed[0]] + 1 - seed[1])]
        room, first, seed = window - own[0][2], seed[0], None
        while room and unused:
            i = min(unused, key=lambda i: (-round(score(first, i), 9), i))
            unused.remove(i)
            held = min(room, lengths[i] + 1)
            own.append((i, 0, held))
            room -= held
            if held <= lengths[i]:
                seed = (i, held)
        out.append(own)
    return out


def test_neighbours_are_the_best_unused():
    draw = np.random.default_rng(7)
    parts = [np.sort(draw.integers(0, 60, draw.integers(0, 40))) for _ in range(80)]
    held = np.array([sum(t in p for p in parts) for t in range(60)])
    weights = retrieval_packing.rarity(held, len(parts))
    shard = retrieval_packing.Shard(parts, weights, 20.0)
    got = list(retrieval_packing.windows(shard, [len(p) + 1 for p in parts], 128))
    assert got == plain_windows(parts, weights, 20.0, 128)


def test_related_documents_share_windows(engine):
    """Twenty subjects with words of their own, shuffled: most neighbours are of one subject."""
    draw = random.Random(5)
    words = [["".join(draw.choices("bcdfgklmnprst", k=6)) for _ in range(30)] for _ in range(20)]
    docs = [(i, " ".join(draw.choices(words[i % 20], k=12) + draw.choices(["the", "of", "and", "to"], k=12))) for i in range(2000)]
    draw.shuffle(docs)
    got = retrieval_packing.pack_related(engine.createDataFrame(docs, "doc_id long, text string"), 512).collect()
    sequences = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        sequences[r.sequence_id].append(r.doc_id % 20)
    pairs = [a == b for own in sequences.values() for a, b in zip(own, own[1:])]
    assert sum(pairs) > 0.8 * len(pairs)
