"""Shards by jump consistent hashing, in JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, gapless_ranks

# Fixed value: the multiplier of the published generator (Lamping and Veach, 2014).
MULTIPLIER = 2862933555777941757

# 64-bit arithmetic modulo 2^64 in limbs of 22, 22 and 20 bits: no product or
# sum of these leaves a signed long, so ANSI mode never sees an overflow.
LIMB, TOP = 22, 20
LOW_MASK, TOP_MASK = (1 << LIMB) - 1, (1 << TOP) - 1
M0, M1, M2 = (MULTIPLIER & LOW_MASK, (MULTIPLIER >> LIMB) & LOW_MASK, MULTIPLIER >> (2 * LIMB))

# Jumps that are tried before the exact loop over all shards takes over.
USUAL_JUMPS = 64


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _state(bucket, jump, r0, r1, r2) -> Column:
    return F.struct(
        bucket.alias("bucket"), jump.alias("jump"), r0.alias("r0"), r1.alias("r1"), r2.alias("r2")
    )


def _jump_once(s: Column) -> Column:
    low = s.r0 * _long(M0) + _long(1)
    middle = F.shiftright(low, LIMB) + s.r0 * _long(M1) + s.r1 * _long(M0)
    high = F.shiftright(middle, LIMB) + s.r0 * _long(M2) + s.r1 * _long(M1) + s.r2 * _long(M0)
    r1, r2 = middle.bitwiseAND(_long(LOW_MASK)), high.bitwiseAND(_long(TOP_MASK))
    # The upper 31 bits of the generator: all of r2 and the upper 11 bits of r1.
    drawn = F.shiftleft(r2, 11) + F.shiftright(r1, 11)
    jump = (s.jump + 1) * (F.lit(float(1 << 31)) / (drawn + 1).cast("double"))
    return _state(s.jump, jump.cast("bigint"), low.bitwiseAND(_long(LOW_MASK)), r1, r2)


def _walk(start: Column, steps: int, shards: int) -> Column:
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        start,
        lambda s, _: F.when(s.jump >= shards, s).otherwise(_jump_once(s)),
    )


def jump_state(key: Column, shards: int) -> Column:
    """The last ``bucket`` below ``shards`` and the ``jump`` that leaves it.

    A key jumps about ln(shards) times and at most once per shard. The first
    loop covers all but freak cases; the second one is exact for those.
    """
    key = F.coalesce(key.cast("bigint"), _long(0))
    start = _state(
        _long(-1),
        _long(0),
        key.bitwiseAND(_long(LOW_MASK)),
        F.shiftright(key, LIMB).bitwiseAND(_long(LOW_MASK)),
        F.shiftright(key, 2 * LIMB).bitwiseAND(_long(TOP_MASK)),
    )
    state = _walk(start, min(shards, USUAL_JUMPS), shards)
    if shards > USUAL_JUMPS:
        state = F.when(state.jump >= shards, state).otherwise(_walk(state, shards, shards))
    return state


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key, 0 to ``shards`` - 1; a null key counts as 0.

    Going from n to n + 1 shards moves about 1/(n + 1) of the keys, all of them
    into the new shard.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    return jump_state(key, shards).bucket.cast("int")


def shard_rows(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every row with its shard and its place in that shard.

    Columns: key, ``size`` (UTF-8 bytes plus 1), ``text_crc32`` (unsigned; a null
    text counts as empty), ``law`` (``key``), ``shard``, ``slot`` (gapless from 0
    in the order of key, nulls first, then checksum and size), ``grown_shard`` (with
    one shard more). Only the key decides the shard: copies of a text may part,
    repeated rows of a key meet. Repeated rows get slots of their own. Other
    columns of the input are ignored; an empty input gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "shards")
    body = F.coalesce(F.col(text), F.lit(""))
    digest = df.select(
        F.col(key).cast("bigint").alias("doc_id"),
        (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_state(F.col(key), shards).alias("state"),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("state.bucket").cast("int").alias("shard"),
        # The next jump lands on the new shard exactly if it equals the old count.
        F.when(F.col("state.jump") == shards, F.lit(shards))
        .otherwise(F.col("state.bucket"))
        .cast("int")
        .alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    digest = scratch.put(digest, "digest")
    ranked = gapless_ranks(digest, ["shard"], ["doc_id", "text_crc32", "size", "row"], "shards")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("rank").cast("bigint").alias("slot"),
        "grown_shard",
    )
