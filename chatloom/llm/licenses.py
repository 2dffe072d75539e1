"""Licence notices by a positional index of rare words, in DataFrame functions only."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Scratch, text_rows

# Words of a text: runs of digits, letters and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"

# The phrases whose every place counts, with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, notice, and the phrase that a notice can't lack.
NOTICES = [
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license",
    ),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public "
        "license",
        "gnu general public license",
    ),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    (
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        "creative commons attribution",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "mpl",
        "subject to the terms of the mozilla public license v 2 0",
        "mozilla public license",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "permission to use copy modify and or distribute",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
]

# A notice gives its label if so much of its weight stands around the key phrase.
LEAST_SHARE = 0.5


def templates(notices=NOTICES, phrases=BASE_PHRASES) -> list[tuple]:
    """(template, label, is a base phrase, place, word, is mandatory) for every template word."""
    rows = []
    whole = [(label, phrase, phrase, True) for phrase, label in phrases.items()]
    for number, (label, notice, key, base) in enumerate(whole + [(*n, False) for n in notices]):
        words, needed = notice.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(needed)] == needed)
        rows += [
            (number, label, base, i, word, at <= i < at + len(needed))
            for i, word in enumerate(words)
        ]
    return rows


def words_of(text: Column) -> Column:
    """Lower-cased words. Only A-Z may change: the two characters whose lower
    case is an ASCII letter are replaced by another letter beyond ASCII first."""
    kept = F.replace(F.replace(text, F.lit("K"), F.lit("ª")), F.lit("İ"), F.lit("ª"))
    return F.regexp_extract_all(F.lower(kept), F.lit(WORD), F.lit(0))


def _postings(spark: SparkSession, scanned: DataFrame, rows: list[tuple]) -> DataFrame:
    """Template words with integer IDF weights; ``rare`` marks the word to look up.

    That is the word of the key phrase found in the fewest files. Every place of
    the phrase holds it, so looking up this word alone finds all of them. The
    driver gets one count per word of the templates, a list of fixed size.
    """
    total = scanned.count()
    counted = (
        scanned.select(F.explode(F.array_distinct("hits.word")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("files"))
    )
    files = {r.word: r.files for r in counted.collect()}

    def weight(word: str) -> int:
        return math.floor(1000 * math.log((total + 2) / (files.get(word, 0) + 1)))

    listed = []
    for number, group in itertools.groupby(rows, key=lambda r: r[0]):
        own = list(group)
        needed = [(files.get(word, 0), word, place) for *_, place, word, must in own if must]
        whole = sum(weight(word) for *_, word, _ in own)
        for _, label, base, place, word, must in own:
            rare = (files.get(word, 0), word, place) == min(needed)
            listed.append(
                (number, label, base, place, word, must, rare, weight(word), whole, len(needed))
            )
    return spark.createDataFrame(
        listed,
        "template int, label string, base boolean, place int, word string, needed boolean, "
        "rare boolean, weight bigint, whole bigint, phrase int",
    )


def license_places(
    scanned: DataFrame, postings: DataFrame, rare_words: list[str]
) -> DataFrame:
    """Every place (row, template, start) whose key phrase is complete, with its share."""
    told = scanned.filter(F.exists("hits", lambda x: x.word.isin(rare_words)))
    hits = told.select("row", F.inline("hits"))
    rare = F.broadcast(postings.filter("rare").select("template", "place", "word"))
    starts = hits.join(rare, "word").select(
        "row", "template", (F.col("position") - F.col("place")).alias("start")
    )
    wanted = starts.join(F.broadcast(postings), "template").select(
        "row", "template", "label", "base", "start", "word", "needed", "weight", "whole", "phrase",
        (F.col("start") + F.col("place")).alias("position"),
    )
    there = wanted.join(hits, ["row", "position", "word"])
    return (
        there.groupBy("row", "template", "start")
        .agg(
            F.first("label").alias("label"),
            F.first("base").alias("base"),
            F.sum(F.col("needed").cast("int")).alias("met"),
            F.first("phrase").alias("phrase"),
            (F.sum("weight") / F.greatest(F.first("whole"), F.lit(1))).alias("share"),
        )
        .filter("met = phrase")
    )


def license_scan(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Licence labels of every row.

    Columns: key, ``n_words``, ``n_base`` (places of base phrases), ``first_word``
    and ``last_word`` (smallest and largest start of these, else null),
    ``base_labels``, ``labels`` (base labels and those of notices), ``score``
    (the best notice's share of IDF weight, 0 without a complete key phrase).
    A null text counts as empty: no words, no labels, empty strings, score 0.
    Rows are told apart by number, so repeated rows and null keys each give a row.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "licenses")
    rows = templates()
    vocabulary = sorted({r[4] for r in rows})
    words = text_rows(df, text, key).select("doc_id", words_of(F.col("text")).alias("words"))
    marked = F.transform("words", lambda w, i: F.struct(i.alias("position"), w.alias("word")))
    scanned = scratch.put(
        words.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("bigint").alias("n_words"),
            F.filter(marked, lambda x: x.word.isin(vocabulary)).alias("hits"),
        ),
        "scanned",
    )
    postings = _postings(spark, scanned, rows)
    rare_words = sorted({r.word for r in postings.filter("rare").select("word").collect()})
    places = license_places(scanned, postings, rare_words)
    found = places.groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("bigint").alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_set"),
        F.collect_set(
            F.when(F.col("base") | (F.col("share") >= LEAST_SHARE), F.col("label"))
        ).alias("all_set"),
        F.max("share").alias("score"),
    )
    listed = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
            "first_word",
            "last_word",
            listed("base_set").alias("base_labels"),
            listed("all_set").alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
