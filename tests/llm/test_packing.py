"""Tokens against the published tokenizer, and packing against its laws."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chatloom.llm import tokens
from chatloom.llm.packing import best_fit, pack_documents, pieces_of

PATH = public_tokenizers.path("byte_bpe_50k.json")

ODD_TEXTS = [
    "", " ", "  ", "a  b", "a   b \n c", "\n\nfoo\n bar  ", "x ", " y", "tab\t z", "it's  don't\n\n",
    "  z", "日本語 テスト　 x", "a\x1c b", "<|endoftext|> hi", "foo\n", "😀 😀", "\x85 a \x85", "a\x0b b",
    "a<|endoftext|> hi", "a <|endoftext|>", "x  <|endoftext|><|endoftext|>\n b", "<|endoftext|", "y <|endoftext|>z",
    "one two\nthree  four\t five", None, "  x", "ça va, très bien!", "1234 5678", "a\n b\n\n c",
]


def published(special):
    """The tokenizer as it is loaded, or with added tokens' strings as ordinary text."""
    loaded = Tokenizer.from_file(PATH)
    if not special:
        loaded.encode_special_tokens = True
    return lambda text: loaded.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer():
    return published(special=True)


def random_texts(count):
    rng = random.Random(11)
    parts = ["the", "ing", "Tion", " ", "  ", "\n", "\t", ".", ",", "'s", "12", "é", "ß", "***", " a", "\xa0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("special", [True, False])
def test_ids_equal_the_published_tokenizer(special, monkeypatch):
    texts = ODD_TEXTS + random_texts(1500)
    encoder, tokenizer = tokens.Encoder(PATH, special), published(special)
    assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))] == [
        tokenizer(t) for t in texts
    ]
    # Forgetting words and small blocks change nothing.
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 3)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 40)
    again = encoder.encode(pa.array(texts[:200], pa.string()))
    assert [x.tolist() for x in again] == [tokenizer(t) for t in texts[:200]]


def test_only_the_first_piece_may_be_shorter():
    assert pieces_of(3, 4) == [(0, 3)]
    assert pieces_of(4, 4) == [(0, 4)]
    assert pieces_of(8, 4) == [(0, 4), (4, 4)]
    assert pieces_of(9, 4) == [(0, 1), (1, 4), (5, 4)]


def plain_best_fit(lengths, capacity):
    """Longest first, each into the fullest sequence that holds it."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        able = [i for i, g in enumerate(gaps) if g >= length]
        if able:
            gaps[min(able, key=lambda i: gaps[i])] -= length
        else:
            gaps.append(capacity - length)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_best_fit_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 16, 60])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.choice([1, 40, 400]))]
    lengths += [capacity // 3] * rng.randrange(200)
    moves = best_fit(Counter(lengths), capacity)
    placed, ranks = defaultdict(list), defaultdict(list)
    for length, rank, many, first, offset in moves:
        for i in range(many):
            placed[first + i].append((offset, length))
            ranks[length].append(rank + i)
    assert {k: len(v) for k, v in ranks.items()} == Counter(lengths)
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    for own in placed.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    gaps = sorted(capacity - sum(n for _, n in own) for own in placed.values())
    assert gaps == plain_best_fit(lengths, capacity)


def check(rows, got, tokenizer, capacity):
    want = Counter()
    for key, text in rows:
        ids = np.array([*tokenizer(text), 0], dtype="<u4")
        for piece, (start, length) in enumerate(pieces_of(len(ids), capacity)):
            crc = zlib.crc32(ids[start : start + length].tobytes())
            want[key, piece, start, length, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(documents, awkward, tokenizer):
    rows = awkward + list(enumerate(ODD_TEXTS, 100)) + [(i, "same words") for i in range(300, 500)]
    got = pack_documents(documents(rows, clashing=True), PATH, 64).collect()
    used = check(rows, got, tokenizer, 64)
    total = sum(r.length for r in got)
    assert used <= -(-total // 64) + 1
    with_ids = pack_documents(documents(rows), PATH, 64, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)


def test_empty_table(documents):
    assert pack_documents(documents([]), PATH).count() == 0
