"""Exact vector search and replica audits against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import vafile
from chatloom.llm.fixity import audit, laid_out, levels_for
from chatloom.llm.vafile import nearest

VECTORS = "vec_id bigint, embedding array<float>, label int"
MANIFEST = "file bigint, start bigint, length bigint, digest string"


def plain_nearest(rows, k, step):
    taken = []
    for row, (key, vector) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            taken.append((row, key, [math.floor(256 * x) for x in vector]))
    out = []
    largest = 2**63 - 1
    for row, key, v in taken:
        if key is not None and key % step == 0:
            others = [
                (-sum(a * b for a, b in zip(v, w)), other is None, other or 0)
                for at, other, w in taken
                if at != row and len(v) == len(w)
            ]
            out += [
                (key, rank, None if none else other, min(max(-score, -largest - 1), largest))
                for rank, (score, none, other) in enumerate(sorted(others)[:k], 1)
            ]
    return sorted(out, key=repr)


def held(value):
    """A component as the table's float column holds it."""
    return None if value is None else float(np.float32(value))


def vector_rows():
    rng = random.Random(9)
    rows = [(i, [rng.randrange(-64, 64) / 256 for _ in range(6)]) for i in range(400)]
    hot = [0.25] * 6
    rows += [(1000 + i, hot) for i in range(300)]
    rows += [(2000, None), (2050, [0.1, None]), (2100, [float("nan")] * 6), (None, hot), (2150, [])]
    rows += [(2200, [0.5, 0.5]), (2201, [0.25, 0.5]), (2250, [1e30, -1.0]), (2300, [2e30, 3.0]), (2301, [-1e30, 0.0]), (50, hot), (50, hot), (-50, hot)]
    rows += [(3000 + i, [rng.choice([0.0, 0.5]) for _ in range(6)]) for i in range(120)]
    return rows


@pytest.mark.parametrize("block", [8192, 5])
def test_nearest_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vafile, "QUERY_BLOCK", block)
    rows = [(k, v and [held(x) for x in v]) for k, v in vector_rows()]
    frame = spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS)
    frame = frame.selectExpr("*", "1 AS row", "2 AS score", "3 AS entry")
    got = nearest(frame, F.col("vec_id") % 50 == 0, 5).collect()
    have = sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=repr)
    assert have == plain_nearest(rows, 5, 50)


def test_bounds_hold_with_coarse_cells(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 30) for _ in range(12)]) for i in range(500)]
    frame = spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS)
    held = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    got = nearest(frame, F.col("vec_id") % 25 == 0, 3).collect()
    have = sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=repr)
    assert have == plain_nearest(held, 3, 25)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert nearest(frame, F.col("vec_id") % 50 == 0, 5).count() == 0


def plain_audit(master, replica):
    states = []
    for spot in {r[:2] for r in master} | {r[:2] for r in replica}:
        a = sorted(r[2:] for r in master if r[:2] == spot)
        b = sorted(r[2:] for r in replica if r[:2] == spot)
        for x in list(a):
            if x in b:
                a.remove(x)
                b.remove(x)
        a.sort(key=lambda x: (x[1], x[0]))
        b.sort(key=lambda x: (x[1], x[0]))
        for i in range(max(len(a), len(b))):
            x = a[i] if i < len(a) else (None, None)
            y = b[i] if i < len(b) else (None, None)
            state = "missing" if i >= len(b) else "extra" if i >= len(a) else "changed"
            states.append((*spot, *x, *y, state))
    return sorted(states, key=repr)


def test_audit_equals_comparing_all_records(spark):
    rng = random.Random(3)
    master, replica = [], []
    for file in range(4):
        at = 0
        for i in range(120):
            length = rng.randrange(50, 40_000)
            master.append((file, at, length, f"{file}-{i}"))
            fate = rng.random() if file != 2 else 0.5
            if fate < 0.02:
                replica.append((file, at, length, "rot"))
            elif fate < 0.03:
                replica.append((file, at, length // 2, f"{file}-{i}"))
            elif fate > 0.02:
                replica.append((file, at, length, f"{file}-{i}"))
            at += length
    replica += [(3, 10**8, 10, "extra"), (9, 0, 5, "other file"), (9, 0, 5, "other file")]
    master += [(1, 0, 7, "shared"), (9, 0, 5, "other file")]
    frames = [spark.createDataFrame(x, MANIFEST) for x in (master, replica)]
    assert sorted((tuple(r) for r in audit(*frames).collect()), key=repr) == plain_audit(master, replica)
    assert audit(frames[0], frames[0]).count() == 0
    none = frames[0].limit(0)
    assert audit(none, none).count() == 0
    assert {r.state for r in audit(frames[0], none).collect()} == {"missing"}


def test_offsets_of_a_hot_file(spark):
    rows = [(0 if i % 3 else 1, i // 2, i, 10 + i % 4) for i in range(600)]
    frame = spark.createDataFrame(rows, "file bigint, page_id bigint, row bigint, length bigint")
    got = laid_out(frame, ["page_id", "row"], "t").collect()
    for file in (0, 1):
        at = 0
        for r in sorted((r for r in got if r.file == file), key=lambda r: (r.page_id, r.row)):
            assert r.start == at
            at += r.length


def test_levels_cover_the_longest_file():
    assert [levels_for(n) for n in (1, 1 << 16, (1 << 16) + 1, 1 << 20, (1 << 20) + 1)] == [1, 1, 2, 2, 3]
