"""Benchmark passages against brute-force edit distances."""

import random

import numpy as np

from chatloom.llm import spans
from chatloom.llm.spans import (
    Index,
    codes_of,
    contaminated_spans,
    gram_hashes,
    item_of,
    search_texts,
    without_contaminated,
)

ITEMS = "item_id bigint, text string"


def least_edits(pattern, text):
    """Fewest edits of ``pattern`` against any part of ``text``: the full matrix."""
    above = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        row = [i]
        for j, t in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (p != t)))
        above = row
    return min(above)


def planted(rng, vocabulary, item, edits):
    text = list(item)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("xyzq")
        elif kind == 1:
            del text[at]
        else:
            text.insert(at, rng.choice("xyzq"))
    before = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))
    after = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))
    return f"{before} {''.join(text)} {after}"


def test_every_planted_match_is_found_and_none_invented():
    rng = random.Random(5)
    vocabulary = ["the", "tion", "ing", "ered", "shon", "nd", "thor", "ble", "en"]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (18, 25, 40, 60, 5, 1)]
    index = Index([item_of(i, t) for i, t in enumerate(items)])
    by_number = {i.number: i for i in index.items + index.short}
    texts = [planted(rng, vocabulary, rng.choice(items[:4]), e) for e in range(26) for _ in range(3)]
    for text, found in zip(texts, search_texts(index, texts)):
        codes = codes_of(text).tolist()
        want = {
            n for n, item in by_number.items() if least_edits(item.codes.tolist(), codes) <= item.edits
        }
        assert {s[0] for s in found} == want
        for number, start, end, edits in found:
            inside = codes_of(text[start:end]).tolist()
            assert least_edits(by_number[number].codes.tolist(), inside) == edits


def test_spans_are_the_places_of_the_text():
    item = "Some Passage that stands in a benchmark, word for word; long enough to be told."
    index = Index([item_of(4, item)])
    text = "x " * 500 + item.upper().replace(" ", "\n") + " y" * 500 + item
    (first, second) = search_texts(index, [text])[0]
    assert sorted([first[1:], second[1:]]) == [
        (1000, 1000 + len(item), 0),
        (len(text) - len(item), len(text), 0),
    ]


def test_gram_hashes_tell_grams_apart():
    codes = codes_of("abracadabra abracadabra, simsalabim")
    for q in (1, 3, 5, 8):
        hashes = gram_hashes(codes, q)
        grams = [tuple(codes[i : i + q]) for i in range(len(codes) - q + 1)]
        assert len(hashes) == len(grams)
        assert len(set(zip(hashes.tolist(), grams))) == len(set(grams)) == len(set(hashes.tolist()))


def test_batches_don_t_change_the_result(monkeypatch):
    rng = random.Random(1)
    items = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(20)) for _ in range(3)]
    texts = [planted(rng, ["delta", "beta"], rng.choice(items), 1) for _ in range(30)] + ["", "x"]
    index = Index([item_of(i, t) for i, t in enumerate(items)])
    whole = search_texts(index, texts)
    monkeypatch.setattr(spans, "BATCH_CHARS", 50)
    assert search_texts(index, texts) == whole


def test_frames(spark, documents, awkward, monkeypatch):
    item = "a benchmark passage of many words that nobody would write twice by chance"
    rows = awkward + [(30, f"before {item} after"), (30, f"{item}"), (31, item[:40]), (None, item)]
    items = spark.createDataFrame([(1, item), (2, None), (None, "x"), (3, ""), (1, item)], ITEMS)
    frame = documents(rows, clashing=True)
    want = [(None, 1, 0), (30, 1, 0), (30, 1, 7)]
    key = lambda r: (r[0] is not None, r)
    got = contaminated_spans(frame, items).collect()
    assert sorted([(r.doc_id, r.item_id, r.span_start) for r in got], key=key) == want
    clean = without_contaminated(frame, items)
    assert clean.columns == frame.columns
    assert clean.count() == len(awkward) + 1
    # One item a block: several passes, the same rows.
    monkeypatch.setattr(spans, "BLOCK_CHARS", 1)
    more = items.union(spark.createDataFrame([(9, "twice the same row")], ITEMS))
    assert without_contaminated(frame, more).count() == len(awkward) - 2 + 1


def test_nothing_to_search(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "some passage of a benchmark")], ITEMS)
    assert contaminated_spans(documents([(1, "x")]), none).count() == 0
    assert contaminated_spans(documents([]), some).count() == 0
    assert without_contaminated(documents([(1, "x")]), none).count() == 1
    assert np.array_equal(gram_hashes(codes_of("short")), np.zeros(0, np.uint64))


def test_items_cut_at_the_border_stay_in_their_text():
    rng = random.Random(8)
    item = "".join(rng.choice("abcdefgh ") for _ in range(120)).strip()
    index = Index([item_of(1, item)])
    budget = index.items[0].edits
    clean = "".join(rng.choice("abcdefgh ") for _ in range(200))
    texts = []
    for cut in range(1, budget + 1):
        # The neighbour begins or ends with what is left out, and with chance matches.
        texts += [clean + item[:-cut], item[-cut + 1 :] + clean, clean, clean + item[: cut - 1]]
        texts += [item[cut:] + clean, "", clean + item[: cut + 1], "", item[cut:-1] if cut > 1 else ""]
    alone = [search_texts(index, [t])[0] for t in texts]
    assert search_texts(index, texts) == alone
    pattern = index.items[0].codes.tolist()
    for text, found in zip(texts, alone):
        least = least_edits(pattern, codes_of(text).tolist())
        assert [e for *_, e in found] == ([least] if least <= budget else [])


def test_every_item_keeps_to_its_own_band():
    rng = random.Random(9)
    short = "".join(rng.choice("abcdefgh") for _ in range(60))
    long = "".join(rng.choice("abcdefgh") for _ in range(1500))
    edited = short[:20] + "z" + short[21:45] + "q" + short[46:]
    index = Index([item_of(1, short), item_of(2, long)])
    one = f"some words before {edited} then {short} and {long[:700]}x{long[700:]}"
    texts = ["it ends with " + edited, short + " begins it", one, "nothing"]
    got = search_texts(index, texts)
    assert [sorted((n, e) for n, _, _, e in own) for own in got] == [
        [(1, 2)], [(1, 0)], [(1, 0), (1, 2), (2, 1)], []
    ]
    for text, own in zip(texts, got):
        for number, start, end, _ in own:
            want = {edited, short} if number == 1 else {long[:700] + "x" + long[700:]}
            assert text[start:end] in want


def test_items_with_null_or_repeated_keys(spark, documents):
    keyless = "a passage of the benchmark whose key got lost on its long way here"
    first = "the first of two texts that stand under one and the same number there"
    second = "quite another sentence, longer than the one before it, under this number as well"
    items = spark.createDataFrame(
        [(None, keyless), (7, first), (7, second), (7, second.upper()), (8, " "), (None, None)], ITEMS
    )
    rows = [(1, f"x {keyless} y"), (2, f"xy {first}"), (3, f"{second} z"), (4, "none of them")]
    got = contaminated_spans(documents(rows), items).collect()
    assert sorted(map(tuple, got)) == [
        (1, None, 2, 2 + len(keyless), 0),
        (2, 7, 3, 3 + len(first), 0),
        (3, 7, 0, len(second), 0),
    ]
    clean = without_contaminated(documents(rows), items)
    assert [r.doc_id for r in clean.collect()] == [4]


def test_many_copies_in_one_text_overlap_nowhere():
    """A repetitive item matches at many shifts of each of its copies."""
    item = "ab ab ac " * 12
    for copies in (120, 300, 1000):
        text = " | ".join(item[:40] + "x" * (i % 3) + item[40:] for i in range(copies))
        index = Index([item_of(1, item), item_of(2, item[9:])])
        (found,) = search_texts(index, [text])
        for number in (1, 2):
            own = sorted((s, e) for n, s, e, _ in found if n == number)
            assert len(own) >= copies
            assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))


def test_budgets_as_stated():
    edits = {n: item_of(1, "".join(chr(97 + i % 26) for i in range(n))).edits for n in (17, 18, 50, 100, 1000)}
    assert edits == {17: 0, 18: 1, 50: 4, 100: 8, 1000: 93}
