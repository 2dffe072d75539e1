"""Sharding and licence scan: against plain Python and awkward inputs."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from chatloom.llm.licenses import BASE_PHRASES, license_scan
from chatloom.llm.sharding import jump_shard, shard_rows


def jump(key: int, shards: int) -> int:
    """The published loop, in plain integers."""
    key, bucket, at = key % (1 << 64), -1, 0
    while at < shards:
        bucket = at
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        at = int((bucket + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return bucket


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 1000])
def test_jump_equals_the_loop(spark, shards):
    keys = [0, 1, 2, 3, 12345, -1, -(1 << 63), (1 << 63) - 1, *range(100, 10_000, 371)]
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = frame.select("k", jump_shard(frame.k, shards).alias("s")).collect()
    assert {r.k: r.s for r in got} == {k: jump(k, shards) for k in keys}


def test_one_shard_more_only_fills_the_new_one(documents):
    rows = shard_rows(documents([(i, str(i)) for i in range(3000)]), 16).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {16}
    assert 0.5 < len(moved) / (3000 / 17) < 1.5


def test_slots_have_no_gaps_even_with_a_hot_key(documents):
    rows = [(9, "hot")] * 700 + [(i, "x" * (i % 7)) for i in range(900)]
    got = defaultdict(list)
    for r in shard_rows(documents(rows), 4).collect():
        got[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in got.values())
    assert sum(map(len, got.values())) == 1600


def test_digest_of_awkward_rows(documents, awkward):
    got = shard_rows(documents(awkward, clashing=True), 16).collect()
    want = Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(k or 0, 16))
        for k, t in awkward
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in got) == want


def plain_scan(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))
    places = []
    for phrase, label in BASE_PHRASES.items():
        needed = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(needed)] == needed:
                places.append((i, label))
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


LICENSED = [
    (20, "Released under the MIT License."),
    (21, "MIT\nLICENSE, mit-license mit license"),
    (22, "mit licenses; mit the license; Kmit license"),
    (23, "This work is licensed under the GNU General Public License, version 3."),
    (24, "Licensed under CC BY-NC 4.0."),
    (25, "general public license" * 3 + " general public license"),
    (26, "filler " * 40_000 + "Apache License and the MIT license"),
    (27, "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
         "software and associated documentation files"),
    (28, "gnu lesser general public license"),
]


def test_base_places_equal_plain_python(documents, awkward):
    rows = awkward + LICENSED
    got = license_scan(documents(rows, clashing=True)).collect()
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in got) == Counter(
        (k, *plain_scan(t)) for k, t in rows
    )
    labels = {r.doc_id: set(filter(None, r.labels.split(","))) for r in got}
    assert labels[24] == {"cc-by-nc"} and labels[27] == {"mit"} and "lgpl" in labels[28]
    assert all(0 <= r.score <= 1 for r in got)
    assert all(set(filter(None, r.base_labels.split(","))) <= labels[r.doc_id] for r in got)


def test_empty_tables(documents):
    empty = documents([])
    assert shard_rows(empty, 16).count() == 0
    assert license_scan(empty).count() == 0
