"""Source divergence against plain counting, with digests that collide."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.llm import divergence
from chatloom.llm.divergence import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain(rows, ranks):
    docs = [
        (lang or "", source or "", TERM.findall((text or "").translate(SMALL)))
        for _, text, lang, source in rows
    ]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, source in {d[:2] for d in docs}:
        kept = [t for t, n in seen[lang].items() if n >= 3]
        groups = {s: counts[lang, s] for other, s, _ in docs if other == lang}
        groups[None] = sum(groups.values(), Counter())

        def share(group, term):
            total = sum(groups[group][t] for t in kept)
            return 1 + 10**9 * (groups[group][term] + 1) // (total + len(kept))

        def excess(term, other):
            p, q = share(source, term), share(other, term)
            return (p - q) * (p - q) // q

        pairs = [
            (sum(excess(t, s) for t in kept), s) for s in groups if s not in (None, source)
        ]
        terms = [
            (excess(t, None), t)
            for t in kept
            if groups[source][t] and share(source, t) > share(None, t)
        ]
        for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
            found = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
            out += [(lang, source, part, s, v, i) for i, (v, s) in enumerate(found, start=1)]
    return Counter(out)


def some_rows(seed=7, many=160):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "ДОМ", "дом", "étoile", "日本", "x", "YY", "𝒜b", "rare"]
    joints = [" ", "  ", "_", "1", "-", "\n", "\0", "@"]
    rows = [
        (
            i,
            "".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.randrange(12))),
            rng.choice(["en", "en", "en", "de", None]),
            rng.choice(["hot"] * 6 + ["s1", "s2", "ß", None]),
        )
        for i in range(many)
    ]
    return rows + [
        (1, None, "en", "s1"),
        (2, "", "en", "only empty"),
        (3, "123 !!", "xx", "a"),
        (4, "one two", "xx", "b"),
        (None, "alpha", "en", "s1"),
        (5, "alpha", "en", "s2"),
        (5, "alpha", "en", "s2"),
        (6, "beta " * 40_000, "en", "long"),
        (7, "w" * 200_000, "en", "long"),
    ]


@pytest.mark.parametrize("ranks", [200, 2])
def test_equals_plain_counting(spark, ranks):
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = source_divergence(df, ranks=ranks).collect()
    assert Counter(map(tuple, got)) == plain(rows, ranks)


def test_colliding_digests_are_told_apart(spark):
    rows = some_rows(seed=9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for weak in (lambda term: len(term) % 3, lambda term: 1):
        got = source_divergence(df, ranks=3, digest=weak).collect()
        assert Counter(map(tuple, got)) == plain(rows, 3)


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert source_divergence(empty).collect() == []
    rows = some_rows(seed=3, many=30)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "digest", "split", "slice", "times", "p", "q", "rank", "item"):
        df = df.withColumn(name, F.lit("x"))
    assert Counter(map(tuple, source_divergence(df).collect())) == plain(rows, 200)


def test_only_digests_are_shuffled_with_the_counts(spark):
    """The counts come without terms; these travel once per task, for their spelling."""
    rows = spark.createDataFrame(some_rows(), SCHEMA).na.fill("").select("lang", "source", "text")
    parts = rows.mapInArrow(divergence._counting(divergence.term_digest, False), divergence._PARTS_DDL)
    assert parts.filter("times > 0 and term is not null").count() == 0
    assert parts.filter("term is not null and lang is not null").count() == 0


def test_passing_rows_on_early_changes_nothing(monkeypatch):
    rows = [(lang or "", source or "", text or "") for _, text, lang, source in some_rows()]
    columns = [pa.array(c) for c in zip(*rows)]
    batch = pa.RecordBatch.from_arrays(columns, names=["lang", "source", "text"])

    def counted():
        out, spelled = Counter(), set()
        for part in divergence._counting(divergence.term_digest, False)(iter([batch, batch])):
            for r in part.to_pylist():
                if r["term"] is None:
                    out[r["lang"], r["source"], r["digest"]] += r["times"] * 1000 + r["docs"]
                else:
                    spelled.add((r["digest"], r["term"]))
        return out, spelled

    whole = counted()
    monkeypatch.setattr(divergence, "HELD_ROWS", 3)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 50)
    assert counted() == whole


def test_counted_parts_are_shuffled_once_and_not_written_before(spark, monkeypatch):
    plans = {}

    def put(self, df, name, write=divergence.Scratch.put):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(divergence.Scratch, "put", put)
    df = spark.createDataFrame(some_rows(seed=11, many=40), SCHEMA)
    assert source_divergence(df).count()
    counting = [plan for plan in plans.values() if "MapInArrow" in plan]
    assert [plan.count("Exchange ") for plan in counting] == [1]
    assert not [name for name, plan in plans.items() if "SortAggregate" in plan]


def test_shares_of_counts_whose_product_leaves_a_bigint(spark):
    times = [0, 8, 9 * 10**9 - 1, 9 * 10**9, 9 * 10**9 + 1, 7 * 10**15, 4 * 10**18]
    rows = [(t, n, k) for t in times for n, k in ((t, 1), (4 * 10**18, 3 * 10**9), (0, 0))]
    df = spark.createDataFrame(rows, "times bigint, total bigint, kinds bigint")
    df = df.filter("total = 0 or total >= times")
    for t, n, k, got in df.select("*", divergence._share("times", "total", "kinds")).collect():
        assert got == (1 + 10**9 * (t + 1) // (n + k) if n + k else None)


@pytest.mark.parametrize("ranks", [1, 7, 60])
def test_terms_of_equal_value_go_by_their_text(spark, ranks):
    """Values from one to many steps apart, and more equal ones than ranks."""
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "aäzя" for b in "bcdefghijk"]
    rows = [(i, " ".join(words), "en", "level") for i in range(3)]
    rows += [
        (9, " ".join(w for n, w in enumerate(words) for _ in range(4 ** (n % 5))), "en", "steep"),
        (10, " ".join(rng.choices(words, k=300)), "en", "random"),
        (11, " ".join(words[:30]), "en", "part"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert Counter(map(tuple, source_divergence(df, ranks=ranks).collect())) == plain(rows, ranks)


def test_a_source_without_the_only_kept_term(spark):
    rows = [(i, "solo", "en", "a") for i in range(3)] + [(7, "other", "en", "b"), (8, "", "en", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(map(tuple, source_divergence(df).collect())) == plain(rows, 200)
