"""SentencePiece ids against the library, and alignments against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chatloom.llm import alignment, pieces
from chatloom.llm.alignment import align_tokens
from chatloom.llm.sentence_pieces import encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "   three", "one two\nthree\tfour", "▁", "a▁b", "▁▁ x",
    "日本語 テスト", "𝒜 x", "\0", "a\0b", "<s>", "</s> a", "<unk>", "<0x41>", "<|endoftext|> hi",
    "é é", "aaaa aaaaaaa", "\r\n", "ça va", "don't  ", "()));", " " * 40, "x" * 700, "ab" * 900,
    "nowhitespace" * 80, "的一是不了人我在有他这" * 90, "﻿bom", "word　wide",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return pieces.PieceEncoder(MODEL)


def random_texts(library, count, seed=5):
    rng = random.Random(seed)
    some = ["the", "ing", " ", "  ", "\n", "é", "日", "\0", "1", "(", ")", "x" * 5, "▁", "𝒜", "er", "S"]
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(library.get_piece_size())]
    return [
        "".join(rng.choice(some if rng.random() < 0.6 else names) for _ in range(rng.randrange(15)))
        for _ in range(count)
    ]


def test_ids_equal_the_library(own, library, monkeypatch):
    texts = ODD_TEXTS + random_texts(library, 3000)
    ids, bounds = own.flat(pa.array([*texts, None]))
    got = [ids[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:])]
    assert got == [*map(library.encode, texts), []]
    # The library's order, forgetting, and cutting early change nothing.
    monkeypatch.setattr(pieces, "LONGEST", 3)
    monkeypatch.setattr(pieces, "LONG", 2)
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 0)
    for at in range(0, len(texts), 500):
        ids, bounds = own.flat(pa.array(texts[at : at + 500]))
        got = [ids[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:])]
        assert got == [library.encode(t) for t in texts[at : at + 500]]


def test_decoding_equals_the_library(own, library):
    rng = random.Random(3)
    size = library.get_piece_size()
    for _ in range(4000):
        ids = [
            rng.randrange(size) if rng.random() < 0.5 else rng.randrange(1, 262)
            for _ in range(rng.randrange(9))
        ]
        assert own.decode(np.array(ids, dtype=int)) == library.decode(ids).encode()


def test_two_megabytes_without_a_space(own, library):
    rng = random.Random(2)
    for text in ("".join(rng.choices("ACGTacgt+/0123", k=2_000_000)), "的一是不了人" * 300_000):
        ids, _ = own.flat(pa.array([text]))
        assert ids.tolist() == library.encode(text)
        assert own.decode(ids) == text.encode()


def test_encoded_rows(spark, documents, awkward, library):
    rows = [*awkward, *((100 + i, t) for i, t in enumerate(ODD_TEXTS)), (999, "x" * 300_000)]
    for clashing in (False, True):
        got = encode_texts(documents(rows, clashing), MODEL).collect()
        want = Counter(
            (k, tuple(library.encode(t or "")), library.decode(library.encode(t or "")))
            for k, t in rows
        )
        assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    assert encode_texts(documents([]), MODEL).collect() == []


def plain_alignment(rows, library):
    """Every token's bytes and ends, group by group, all pairs looked at one by one."""
    published = Tokenizer.from_file(BYTES)
    published.encode_special_tokens = True
    shown = {c: b for b, c in _byte_characters().items()}
    vocabulary = published.get_vocab()
    names = {i: t for t, i in vocabulary.items()}
    links, groups, found = Counter(), {}, []
    for place, (key, text) in enumerate(rows):
        a = published.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = library.encode(text or "")
        bytes_a = [bytes(shown[c] for c in names[i]) for i in a]
        bytes_b = [
            bytes([int(library.id_to_piece(i)[3:5], 16)])
            if library.is_byte(i)
            else library.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = _ends(bytes_a), _ends(bytes_b)
        common = sorted(set(ends_a) & set(ends_b))
        own = [(x, y) for x, e in zip(a, ends_a) for y, f in zip(b, ends_b) if e == f]
        links.update(own)
        told, start = [], 0
        for end in common:
            told.append(
                ",".join(str(x) for x, e in zip(a, ends_a) if start < e <= end)
                + "|"
                + ",".join(str(x) for x, e in zip(b, ends_b) if start < e <= end)
            )
            start = end
        groups[place] = (key, len(a), len(b), len(common), own, ";".join(told))
    best = {}
    for (_, y), n in links.items():
        best[y] = max(best.get(y, 0), n)
    for key, n_a, n_b, n, own, told in groups.values():
        digest = hashlib.sha256(told.encode()).hexdigest() if n_a else ""
        tops = sum(links[p] == best[p[1]] for p in own)
        found.append((key, n_a, n_b, n, len(own), tops, sum(links[p] for p in own), digest))
    return Counter(found)


def _ends(parts):
    return np.cumsum(list(map(len, parts))).tolist()


def _byte_characters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def test_alignment_equals_brute_force(spark, documents, awkward, library, monkeypatch):
    rows = [(k, t) for k, t in awkward if not t or len(t) < 1000]
    rows += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(1000 + i, t) for i, t in enumerate(random_texts(library, 250, seed=8))]
    rows += [(5000 + i, "the same sentence, unbelievably often") for i in range(60)]
    want = plain_alignment(rows, library)
    for clashing in (False, True):
        got = align_tokens(documents(rows, clashing), BYTES, MODEL).collect()
        assert Counter(map(tuple, got)) == want


def test_small_blocks_change_nothing(library, monkeypatch):
    """Blocks of one text each hold the same links as one block."""
    texts = [t for t in random_texts(library, 120, seed=4) if t]
    own = alignment.aligner(BYTES, MODEL)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"]
    )

    def links():
        block, out = None, Counter()
        for kind, docs, a, b, times in _parts(own, batch):
            if kind == 1:
                out[a, b] += times
            elif kind == 2:
                out[a, int(own.identity[a])] += times
        return out

    one = links()
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1)
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 1)
    assert links() == one and len(one) > 100


def _parts(own, batch):
    block, number = alignment._Block(own), 0
    same = np.zeros(len(own.a_bytes), dtype=np.int64)
    out = []
    sizes = np.array([len(t.as_py().encode()) for t in batch.column("text")])
    for at in pieces.blocks_of(sizes, alignment.BLOCK_BYTES):
        part = batch.take(pa.array(at))
        simple = block.add(part.column("doc_id"), part.column("text"), int(sizes[at].sum()))
        same += np.bincount(simple, minlength=len(same))
        out.extend(block.parts(number))
        block, number = alignment._Block(own), number + 1
    out.append(alignment._rows(2, -1, a=np.flatnonzero(same), times=same[same > 0]))
    for piece in out:
        for row in piece.to_pylist():
            yield row["kind"], row["docs"], row["a"], row["b"], row["times"]


def test_no_rows_to_align(spark, documents):
    assert align_tokens(documents([]), BYTES, MODEL).collect() == []
    (row,) = align_tokens(documents([(1, None)]), BYTES, MODEL).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "")
