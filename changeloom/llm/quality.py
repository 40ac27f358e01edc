"""Quality rules whose cutoffs are risk-controlled on labelled documents.

Each rule rejects texts whose metric exceeds a cutoff. Labelled good texts are a
holdout; a trial of the bound is a different text of a stratum, so a text counts once
however many documents carry it. Per stratum, a cutoff is allowed only if an exact
binomial bound says that it rejects less than a share of the good texts of the stratum,
at level DELTA divided by the number of all tests made (strata x rules x cutoffs). That
share is ALPHA divided by the number of rules, so all rules together reject less than
ALPHA of the good texts of a stratum at level DELTA. Every rule takes the lowest allowed
cutoff of its grid; where none is allowed it rejects nothing. Everything is a DataFrame
expression, the binomial tail included.

Words are runs without white space (blank, tab to carriage return). A null text
has no words. Repeated rows are judged one by one and are one trial; a document with
several labels is good if all of them say so, a text if all its labelled documents are;
strata without labels reject by the base rule
alone; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import bound, store, text_of

WHITE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Share of the good texts of a stratum that all rules together may reject, and the level of the bounds.
ALPHA = 0.01
DELTA = 0.05
# Cutoffs tried per rule: symbols per character, repeated lines per line, repeated words per word,
# characters per word (long words), words per character (short words).
GRIDS = {
    "symbol_share": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3),
    "dup_line_share": (0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.25),
    "word_length": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 40.0),
    "word_shortness": (0.3, 0.35, 0.4, 0.5, 0.7),
}


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """(key, digest, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every text."""
    body = text_of(docs, text)
    rows = docs.select(F.col(key).alias("key"), F.col(stratum).cast("string").alias("stratum"), body.alias("body"))
    words = F.filter(F.split("body", WHITE, -1), lambda w: w != "")
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    lines = F.filter(F.split("body", "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.withColumn("lines", lines)
    bare = F.length(F.regexp_replace("body", WHITE, ""))
    symbols = F.length("body") - F.length(F.translate("body", SYMBOLS, ""))
    return rows.select(
        F.col("key").alias(key),
        F.sha2("body", 256).alias("digest"),
        "stratum",
        F.col("n").cast("long").alias("n_words"),
        bare.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), F.col("n")).cast("long").alias("n_repeat_words"),
    )


def repeated_words(words: Column, n: Column) -> Column:
    """Words inside an 8-word window that occurs at least twice in the text.

    Window hashes tell which texts repeat anything at all; only those are
    compared window by window, on the words themselves.
    """
    starts = F.sequence(F.lit(1), n - WINDOW + 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    repeats = (n > WINDOW) & (F.size(F.array_distinct(hashes)) < n - WINDOW + 1)
    window = lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("at"))
    return F.when(repeats, bound(F.sort_array(F.transform(starts, window)), covered_words)).otherwise(0)


def covered_words(windows: Column) -> Column:
    """Words inside the windows that equal a neighbour, from (w, at) structs sorted by w."""
    word = lambda k: F.coalesce(F.get(windows, k)["w"], F.lit(""))
    flagged = F.filter(windows, lambda x, k: (word(k + 1) == x["w"]) | (word(k - 1) == x["w"]))
    return F.aggregate(
        F.sort_array(F.transform(flagged, lambda x: x["at"])),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("count")),
        lambda acc, at: F.struct(
            (at + WINDOW).alias("end"),
            (acc["count"] + WINDOW - F.greatest(acc["end"] - at, F.lit(0))).alias("count"),
        ),
        lambda acc: acc["count"],
    )


def metrics(rows: DataFrame) -> DataFrame:
    """Add the metric of each rule."""
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return rows.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "word_length": share("word_chars", "n_words"),
            "word_shortness": share("n_words", "word_chars"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1: Stirling's series, shifted by eight."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    shift = x
    for i in range(1, 8):
        shift = shift * (x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p).

    Terms are added from the largest, k, downwards. Beyond 40 standard deviations
    their sum is below 1e-300, so the number of terms grows as the root of n.
    """
    k, n = k.cast("double"), n.cast("double")
    top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p * (1 - p)) + 40)).cast("int")
    added = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda acc, j: F.struct(
            (acc["sum"] + acc["term"]).alias("sum"),
            (acc["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("term"),
        ),
        lambda acc: acc["sum"],
    )
    # Above the mean the tail is at least about a half; no bound can hold there.
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * added)


def trials(rows: DataFrame, labels: DataFrame, key: str, quality: str) -> DataFrame:
    """(stratum, one column per rule) of every different good text of a stratum, base failures left out."""
    marks = labels.where(F.col(quality).isNotNull() & F.col(key).isNotNull())
    marks = store(marks.groupBy(F.col(key).alias("labelled")).agg(F.min(quality).alias("good")), "labelled")
    labelled = rows.where(~F.col("base_failed")).join(marks, F.col(key) == F.col("labelled"))
    metric = [F.max(rule).alias(rule) for rule in GRIDS]
    return labelled.groupBy("stratum", "digest").agg(F.min("good").alias("good"), *metric).where("good = 1").drop("good", "digest")


def cutoffs(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one column per rule) from the metrics of good texts, one row for each trial.

    A cutoff c is allowed if P(X <= k) <= delta / tests for X ~ Binomial(n, alpha / rules),
    where k of the n good texts of the stratum exceed c: the upper end of the exact
    (Clopper-Pearson) interval of the rule's rejection rate is then below its part of alpha.
    """
    part = alpha / len(GRIDS)
    per_stratum = sum(map(len, GRIDS.values()))
    exceeding = [
        F.sum(F.when(F.col(rule) > c, 1).otherwise(0)).alias(f"{rule}_{i}") for rule, grid in GRIDS.items() for i, c in enumerate(grid)
    ]
    counts = good.groupBy("stratum").agg(F.count("*").alias("n"), *exceeding)
    strata = counts.agg(F.count("*").alias("strata"))
    tested = counts.join(strata.hint("broadcast"), F.lit(True))
    level = F.lit(delta) / (F.col("strata") * per_stratum)
    chosen = []
    for rule, grid in GRIDS.items():
        allowed = [
            F.when(binomial_tail(F.col(f"{rule}_{i}"), F.col("n"), part) <= level, F.lit(float(c))) for i, c in enumerate(grid)
        ]
        chosen.append(F.array_min(F.array(*allowed)).alias(f"max_{rule}"))
    return tested.select(F.col("stratum").alias("of"), *chosen)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    quality: str = "quality",
) -> DataFrame:
    """Base columns of every text and whether it is kept."""
    rows = store(metrics(measured(docs, key, text, stratum)).withColumn("base_failed", base_failed()), "quality")
    limits = cutoffs(trials(rows, labels, key, quality))
    judged = rows.join(limits, F.col("stratum").eqNullSafe(F.col("of")), "left")
    over = F.lit(False)
    for rule in GRIDS:
        over = over | F.coalesce(F.col(rule) > F.col(f"max_{rule}"), F.lit(False))
    return judged.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~over).alias("kept"),
    )
