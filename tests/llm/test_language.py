"""Language-model scores against sums over every segmentation."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from chatloom.llm import language, lattice, queries
from chatloom.llm.lattice import START, Lattice, byte_pieces, vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "bab", "c", *(f"<0x{i:02X}>" for i in range(256))]


def segmentations(text, pieces):
    """(probability, pieces) of every way through a text."""
    if not text:
        yield 1.0, []
        return
    for size in range(1, len(text) + 1):
        piece = text[:size]
        if piece in pieces:
            for p, rest in segmentations(text[size:], pieces):
                yield pieces[piece] * p, [piece, *rest]
        elif size == 1:
            spelled = byte_pieces(piece)
            for p, rest in segmentations(text[1:], pieces):
                yield math.prod(pieces[b] for b in spelled) * p, spelled + rest


def test_lattice_equals_all_segmentations():
    rng = random.Random(2)
    weights = {p: rng.random() + 0.01 for p in PIECES}
    total = sum(weights.values())
    pieces = {p: w / total for p, w in weights.items()}
    own = Lattice({p: math.log(w) for p, w in pieces.items()})
    words = ["a", "ab", "babab", "cab", "aé", "日", "xyz", "abababababab", "ü", "a" * 9]
    sums = [sum(p for p, _ in segmentations(START + w, pieces)) for w in words]
    assert np.allclose(own.marginals(words), np.log(sums))


def test_long_words_by_windows(monkeypatch):
    """Windows of a few characters give the sums over all segmentations too."""
    rng = random.Random(6)
    weights = {p: rng.random() + 0.01 for p in PIECES}
    total = sum(weights.values())
    pieces = {p: w / total for p, w in weights.items()}
    own = Lattice({p: math.log(w) for p, w in pieces.items()})
    words = ["".join(rng.choices("abcé日", k=n)) for n in (1, 2, 7, 12, 15)]
    sums = [sum(p for p, _ in segmentations(START + w, pieces)) for w in words]
    monkeypatch.setattr(lattice, "LONG", 1)
    for window in (1, 2, 5, 100):
        monkeypatch.setattr(lattice, "WINDOW", window)
        assert np.allclose(own.marginals(words), np.log(sums))


def test_five_megabytes_without_a_space():
    rng = random.Random(1)
    published = Lattice({p: math.log(w) for p, w in vocabulary(PATH).items()})
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123+/", k=5 << 20))
    begin = time.perf_counter()
    (whole,) = published.marginals([word])
    assert time.perf_counter() - begin < 90
    assert math.isfinite(whole) and whole < -(5 << 20)


def test_vocabulary_is_a_distribution():
    weights = vocabulary(PATH)
    assert math.isclose(sum(weights.values()), 1.0)
    assert all(w > 0 for w in weights.values())
    assert all(f"<0x{i:02X}>" in weights for i in range(256))


def plain_score(text, ends, total):
    """Log10 of the sum over all segmentations, by one dictionary of prefix sums."""
    weights = vocabulary(PATH)
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    share = (ends + 0.1) / (total + 0.2)
    out = math.log10(share)
    for word in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table)):
        marked = START + word
        ways = {0: 1.0}
        for end in range(1, len(marked) + 1):
            ways[end] = sum(
                ways[start] * weights[marked[start:end]]
                for start in range(end)
                if marked[start:end] in weights
            )
            if marked[end - 1] not in weights:
                ways[end] += ways[end - 1] * math.prod(weights[b] for b in byte_pieces(marked[end - 1]))
        out += math.log10(ways[len(marked)]) + math.log10(1 - share)
    return out


def plain(rows):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(table)) for _, t in rows]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0 for k, _ in rows]
    seen = Counter(w for own, h in zip(words, held) if not h for w in own)
    ends = held.count(False)
    total, kinds = sum(seen.values()) + ends, len(seen) + (ends > 0)

    def base(count):
        return math.log10((count + 0.1) / (total + 0.1 * (kinds + 1)))

    for (key, _), own, h in zip(rows, words, held):
        known = sum(seen[w] > 0 for w in own) + (ends > 0)
        yield key, h, len(own) + 1, known, total, sum(base(seen[w]) for w in own) + base(ends)


def test_scores(documents, awkward, monkeypatch):
    rng = random.Random(4)
    vocabulary_ = ["The", "quick", "brown", "FOX", "été", "naïve", "x***", "日本", "12,5"]
    rows = awkward + [
        (i, " ".join(rng.choice(vocabulary_) for _ in range(rng.randrange(30)))) for i in range(10, 150)
    ]
    # Small blocks, so that one word stands in many dictionaries.
    monkeypatch.setattr(language, "BLOCK_BYTES", 500)
    got = language.language_scores(documents(rows, clashing=True), PATH).collect()
    want = sorted(plain(rows), key=repr)
    have = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got),
        key=repr,
    )
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert np.allclose([w[5] for w in want], [h[5] for h in have])
    ends = sum(not h[1] for h in have if h[0] is not None)
    scores = sorted((repr(k), plain_score(t, ends, want[0][4])) for k, t in rows)
    found = sorted((repr(r.doc_id), r.score) for r in got)
    assert [k for k, _ in scores] == [k for k, _ in found]
    assert np.allclose([s for _, s in scores], [s for _, s in found])
    again = language.language_scores(documents(rows), PATH).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert np.allclose([r.score for r in sorted(got, key=key)], [r.score for r in sorted(again, key=key)])


def test_empty_tables_and_no_training(documents):
    assert language.language_scores(documents([]), PATH).count() == 0
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    (row,) = language.language_scores(documents([(held, "alone")]), PATH).collect()
    assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, 0.0)
    assert math.isfinite(row.score) and row.score < 0


def pieces_of(rng):
    weights = {p: rng.random() + 0.01 for p in PIECES}
    return {p: w / sum(weights.values()) for p, w in weights.items()}


def test_expected_counts_equal_all_segmentations(monkeypatch):
    pieces = pieces_of(random.Random(3))
    own = Lattice({p: math.log(w) for p, w in pieces.items()})
    words = ["a", "ab", "babab", "cab", "aé", "日", "abababababab"]

    def counted(texts):
        want = Counter()
        for text in texts:
            ways = list(segmentations(text, pieces))
            for p, way in ways:
                for piece in way:
                    want[piece] += p / sum(q for q, _ in ways)
        return [want[p] for p in own.pieces]

    assert np.allclose(own.expected(words), counted([START + w for w in words]))
    # Every character of a long word is learned from, in stretches.
    monkeypatch.setattr(lattice, "LONG", 5)
    monkeypatch.setattr(lattice, "STRETCH", 4)
    short = [START + w for w in words if len(w) < 5]
    assert np.allclose(own.expected(words), counted([*short, START + "bab", "ab", START + "aba", "baba", "baba", "b"]))


def test_learned_scores(documents, monkeypatch):
    """The learned model equals its formula, and held-out texts of known and new words
    don't score far below the base."""
    rng = random.Random(8)
    stems = ["".join(rng.choices("aeioulnrst", k=rng.randrange(2, 8))) for _ in range(400)]
    rows = [
        (i, " ".join(rng.choice(stems) + rng.choice(["", "", "", "ing", "é"]) for _ in range(60)))
        for i in range(300)
    ]
    rows += [(1000, None), (1001, "x" * 5000), (1002, "日本 " * 3)]
    monkeypatch.setattr(language, "BLOCK_BYTES", 5000)
    got = language.language_scores(documents(rows), PATH, learned=True).collect()
    seen, ends = Counter(), 0
    for k, t in rows:
        if zlib.crc32(str(k).encode()) % 10:
            seen.update((t or "").split())
            ends += 1
    total, kinds = sum(seen.values()) + ends, len(seen) + 1
    prior = vocabulary(PATH)
    first = Lattice({p: math.log(w) for p, w in prior.items()})
    found = language.refitted(prior, dict(zip(first.pieces, first.expected(list(seen)))))
    assert math.isclose(sum(found.values()), 1.0)
    fitted = Lattice({p: math.log(w) for p, w in found.items()})
    new, share = kinds / (total + kinds), (ends + 0.1) / (total + 0.2)

    def plain_learned(text):
        words = (text or "").split()
        logs = fitted.marginals(words) / math.log(10) + math.log10(1 - share)
        counts = np.array([seen[w] for w in words] + [ends])
        return language.mixed(new, counts / total, np.append(logs, math.log10(share))).sum()

    texts = dict(rows)
    assert len(got) == len(rows)
    assert np.allclose([r.score for r in got], [plain_learned(texts[r.doc_id]) for r in got])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert len(held) > 10
    assert sum(r.score for r in held) > 1.15 * sum(r.base_score for r in held)
    own = {r.doc_id: r.score for r in language.language_scores(documents(rows), PATH).collect()}
    assert sum(own[r.doc_id] for r in held) < 1.5 * sum(r.base_score for r in held)


def test_learned_without_training(documents):
    assert language.language_scores(documents([]), PATH, learned=True).count() == 0
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    (row,) = language.language_scores(documents([(held, "alone")]), PATH, learned=True).collect()
    (own,) = language.language_scores(documents([(held, "alone")]), PATH).collect()
    assert math.isfinite(row.score) and math.isclose(row.score, own.score)


def test_query_scores_held_out_rows_near_the_base(spark):
    rows = queries.op10_language_scores(spark, "/root/testdata/sf0.001").where("held_out").collect()
    assert all(math.isfinite(r.score) for r in rows)
    assert sum(r.score for r in rows) > 1.25 * sum(r.base_score for r in rows)
