"""License scans: an exact set-similarity join of text blocks with license notices.

A notice of n words is looked for in blocks of 2n words that start every n words, so any
stretch of n + 1 words lies inside a block. A block meets a notice if it holds at least
CONTAINMENT of its different words. The join is exact:

  order       words of notices are ranked by how many texts hold them, rarest first
  prefix      of a notice with t words, o of them needed, one of the t - o + 1 rarest must be in the
              block; of a block with b words of notices, one of its b - o + 1 rarest must be shared
  length      a block of fewer than o words of notices is left out
  positional  a pair that meets at places p and q can share 1 + min(t - p - 1, b - q - 1) words at most
  check       the words of the pairs left are intersected

Words are runs of a-z, 0-9 and characters beyond ASCII, with A-Z in lower case. Each text is
cut into words once; only its words of notices are kept, with their places. The notices
are a parameter of the program and bounded by MAX_WORDS different words, so their tables and the counts of
their words may be broadcast. Blocks are keyed by row, notice length and place, so neither a long text
nor a common word gathers in one group. Everything is a DataFrame expression.

Base phrases are places where the words of a phrase stand consecutively. `score` is 1 where a
base phrase was found, else the highest containment of the blocks that meet a notice, else 0.
A null text is an empty one. Repeated rows are scanned one by one, null keys like any
others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.frames import store, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# The base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices that this scan adds, by label: (label, words).
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
)
# Share of the different words of a notice that a block must hold.
CONTAINMENT = 0.8
# Different words of all notices and phrases.
MAX_WORDS = 50_000

Notices = Sequence[tuple[str, str]]


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN, -1), lambda w: w != "")


def needed(words: int, containment: float) -> int:
    """Fewest different words of a notice of `words` different ones that meet it."""
    return math.ceil(containment * words - 1e-9)


def vocabulary(notices: Notices, phrases: dict[str, str]) -> list[str]:
    known = sorted({w for text in [*(t for _, t in notices), *phrases] for w in text.split()})
    if len(known) > MAX_WORDS:
        raise ValueError(f"the notices have {len(known)} different words, over {MAX_WORDS}")
    return known


def found_words(docs: DataFrame, known: list[str], key: str, text: str) -> DataFrame:
    """(uid, key, n_words, found): the known words of every row and their places, written."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).alias("key"), words_of(text_of(docs, text)).alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    found = F.filter(placed, lambda x: x["word"].isin(known))
    return store(rows.select("uid", "key", F.size("words").cast("long").alias("n_words"), found.alias("found")), "license-words")


def phrase_places(found: Column, phrase: str) -> Column:
    """Where the words of a phrase stand consecutively."""
    first, *rest = phrase.split()

    def here(x: Column, i: Column) -> Column:
        following = [
            (F.get(found, i + k)["word"] == word) & (F.get(found, i + k)["at"] == x["at"] + k) for k, word in enumerate(rest, 1)
        ]
        return reduce(lambda a, b: a & F.coalesce(b, F.lit(False)), following, x["word"] == first)

    return F.transform(F.filter(found, here), lambda x: x["at"])


def ranks(spark: SparkSession, rows: DataFrame, known: list[str]) -> dict[str, int]:
    """Place of every known word by the number of texts that hold it, rarest first."""
    held = rows.select(F.explode(F.array_distinct(F.transform("found", lambda x: x["word"]))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {word: i for i, word in enumerate(sorted(known, key=lambda w: (counts.get(w, 0), w)))}


def notice_table(spark: SparkSession, notices: Notices, rank: dict[str, int], containment: float) -> DataFrame:
    """(label, width, t, o, tokens, p, token) with a row for each token in the prefix of a notice."""
    rows = []
    for label, text in notices:
        tokens = sorted({rank[w] for w in text.split()})
        o = needed(len(tokens), containment)
        for p, token in enumerate(tokens[: len(tokens) - o + 1]):
            rows.append((label, len(text.split()), len(tokens), o, tokens, p, token))
    return spark.createDataFrame(rows, "label string, width int, t int, o int, tokens array<int>, p int, token int")


def token_blocks(rows: DataFrame, rank: dict[str, int], widths: dict[int, int]) -> DataFrame:
    """(uid, width, block, tokens): the ranked words of notices in each block, rarest first.

    `widths` has the fewest words any notice of that width needs.
    """
    spark = rows.sparkSession
    ranked = spark.createDataFrame(list(rank.items()), "word string, token int")
    grid = F.array(*[F.struct(F.lit(w).alias("width"), F.lit(o).alias("least")) for w, o in sorted(widths.items())])
    words = rows.select("uid", F.explode("found").alias("x")).select("uid", "x.*").join(F.broadcast(ranked), "word")
    spread = words.select("uid", "at", "token", F.inline(grid))
    last = F.floor(F.col("at") / F.col("width")).cast("int")
    blocks = spread.select("uid", "width", "least", "token", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)).alias("block"))
    grouped = blocks.groupBy("uid", "width", "block").agg(F.collect_set("token").alias("tokens"), F.max("least").alias("least"))
    return grouped.where(F.size("tokens") >= F.col("least")).select("uid", "width", "block", "least", F.array_sort("tokens").alias("tokens"))


def matches(
    rows: DataFrame, notices: Notices, rank: dict[str, int], containment: float = CONTAINMENT
) -> DataFrame:
    """(uid, block, label, containment) of every block that meets a notice."""
    table = notice_table(rows.sparkSession, notices, rank, containment)
    widths: dict[int, int] = {}
    rare = set()
    word_at = {i: w for w, i in rank.items()}
    for r in table.select("width", "o", "token").collect():
        widths[r["width"]] = min(r["o"], widths.get(r["width"], r["o"]))
        rare.add(word_at[r["token"]])
    able = rows.where(F.exists("found", lambda x: x["word"].isin(sorted(rare))))
    blocks = token_blocks(able, rank, widths)
    prefix = F.slice("tokens", 1, F.size("tokens") - F.col("least") + 1)
    probes = blocks.select("uid", "width", "block", F.col("tokens").alias("held"), F.posexplode(prefix).alias("q", "token"))
    bound = 1 + F.least(F.col("t") - F.col("p") - 1, F.size("held") - F.col("q") - 1)
    pairs = probes.join(F.broadcast(table), ["width", "token"]).where((F.size("held") >= F.col("o")) & (bound >= F.col("o")))
    shared = F.size(F.array_intersect("held", "tokens"))
    met = pairs.select("uid", "width", "block", "label", "t", "o", shared.alias("shared")).where(F.col("shared") >= F.col("o"))
    return met.select("uid", "width", "block", "label", (F.col("shared") / F.col("t")).alias("containment"))


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    notices: Notices = NOTICES,
    phrases: dict[str, str] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Per row: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    known = vocabulary(notices, phrases)
    rows = found_words(docs, known, key, text)
    met = matches(rows, notices, ranks(docs.sparkSession, rows, known), containment)
    best = met.groupBy("uid").agg(F.collect_set("label").alias("met"), F.max("containment").alias("best"))
    places = F.array(*[F.struct(F.lit(label).alias("label"), phrase_places(F.col("found"), p).alias("at")) for p, label in phrases.items()])
    based = rows.select("uid", "key", "n_words", F.filter(places, lambda x: F.size(x["at"]) > 0).alias("base"))
    joined = based.join(best, "uid", "left")
    at = F.flatten(F.transform("base", lambda x: x["at"]))
    base_labels = F.transform("base", lambda x: x["label"])
    more = F.coalesce(F.col("met"), F.array().cast("array<string>"))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, more))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
