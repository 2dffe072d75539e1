"""SimHash near copies against brute force."""

import random
from collections import Counter

import xxhash

from chatloom.llm.components import components
from chatloom.llm.simhash import (
    _at_most_three,
    _linked,
    fingerprints,
    simhash_classes,
    without_near_copies,
)
from chatloom.llm.tables import Scratch


def plain_print(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in (text or "").translate(table).replace("\x0b", " ").split(" ")]
    words = [w for part in words for w in part.replace("\x0c", " ").split() if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Smallest member of each component of prints within three bits."""
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    listed = sorted(parent)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    return {p: root(p) for p in parent}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_classes_of_prints_equal_brute_force(spark):
    rng = random.Random(7)
    prints = set()
    for _ in range(25):
        seed = rng.getrandbits(64)
        prints.add(seed)
        for _ in range(rng.randrange(12)):
            # Chains of one to four bits from the last, and dense clusters.
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                seed ^= 1 << bit
            prints.add(seed)
    prints |= {sum(1 << b for b in rng.sample(range(9), 4)) for _ in range(60)} | {0, (1 << 64) - 1}
    frame = spark.createDataFrame([(signed(p),) for p in prints], "print bigint")
    got = _linked(frame, Scratch(spark, "t")).collect()
    want = plain_classes(prints)
    groups = lambda pairs: sorted(sorted(p for p, c in pairs if c == k) for k in {c for _, c in pairs})
    assert groups([(r["print"], r["class"]) for r in got]) == groups(
        [(signed(p), signed(c)) for p, c in want.items()]
    )


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in components(frame, Scratch(spark, "t"), "c").collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(200, 400)]}
    assert got == want


def near_rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        words = [rng.choice(vocabulary) for _ in range(150)]
        for copy in range(4):
            changed = list(words)
            if copy:
                changed[rng.randrange(150)] = "x"
            rows.append((1000 - 10 * group - copy, " ".join(changed).upper() if copy == 2 else " ".join(changed)))
    return rows


def test_rows_equal_brute_force(documents, awkward):
    rows = awkward + near_rows() + [(60, "one\x0btwo\x0cthree Four"), (61, "é ß 日本")]
    got = simhash_classes(documents(rows, clashing=True)).collect()
    prints = [plain_print(t) for _, t in rows]
    classes = plain_classes(prints)
    least = {}
    for (key, _), p in zip(rows, prints):
        if key is not None:
            c = classes[p]
            least[c] = min(least.get(c, key), key)
    want = Counter((k, f"{p:016x}", least.get(classes[p])) for (k, _), p in zip(rows, prints))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_one_row_of_each_group_stays(documents, awkward):
    rows = awkward + near_rows()
    frame = documents(rows, clashing=True)
    kept = without_near_copies(frame)
    assert kept.columns == frame.columns
    prints = {plain_print(t) for _, t in rows}
    got = kept.collect()
    assert len(got) == len(set(plain_classes(prints).values()))
    assert (5, "twice the same row") in [(r.doc_id, r.text) for r in got]


def test_empty_table(documents):
    assert simhash_classes(documents([])).count() == 0
    assert without_near_copies(documents([])).count() == 0


def test_fingerprints_need_no_python_worker(spark, documents):
    rows = documents([(1, "one two three four"), (2, None)]).selectExpr("1L AS row", "doc_id", "text")
    plan = fingerprints(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_fingerprint_of_a_very_long_text(spark, documents):
    rng = random.Random(4)
    text = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(300_000))
    for value in (text, "x" * 3_000_000, "a b " * 200_000):
        frame = documents([(1, value)]).selectExpr("1L AS row", "doc_id", "coalesce(text, '') AS text")
        (row,) = fingerprints(frame).collect()
        assert row.print == signed(plain_print(value))


def test_no_lookup_of_prints_is_broadcast(spark):
    """A table of lookups is 34 times as long as Spark sizes it, so it would be sent to the
    driver while the prints are still few enough to look small."""
    scratch = Scratch(spark, "t")
    prints = spark.range(3000).selectExpr("xxhash64(id) AS print", "xxhash64(id) AS class")
    prints = scratch.put(prints, "prints")
    plan = _at_most_three(prints)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan
    assert "Broadcast" not in plan
