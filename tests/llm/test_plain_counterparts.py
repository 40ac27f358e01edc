"""Language scores and quality verdicts recomputed in plain Python; repeated rows and clashing column names of pages and languages."""

import math
import random
import unicodedata
from collections import Counter, defaultdict
from math import comb

import pytest

from changeloom.llm import langid, pagetext, quality
from changeloom.llm.frames import ship

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def spread(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def buckets(text):
    """Hashed n-grams of one text, letter by letter."""
    low = []
    for c in text:
        if unicodedata.category(c)[0] != "L":
            low.append(" ")
        else:
            low.append(c.lower() if len(c.lower()) == 1 else c)
    found = Counter()
    for n in langid.ORDERS:
        for i in range(len(low) - n + 1):
            part = low[i : i + n]
            if part[0] != " " or part[-1] != " ":
                value = 0
                for c in part:
                    value = value << 21 | ord(c)
                found[spread((value & MASK) + n & MASK) % langid.BUCKETS] += 1
    return found


def test_language_model_and_scores_match_plain_counts(spark):
    ship(spark)
    # Repeated rows, null keys, and columns whose names the operator uses itself.
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    rows += rows[:20] + [(None, "Zażółć gęślą jaźń ИЖЕ", "xx")] * 5 + [(7, None, "xx"), (8, "", None), (9, "ÀÉ ß ŒUVRE", None), (9, "12 !", None)]
    docs = spark.createDataFrame(
        [(*r, "k", "n", "b", 1) for r in rows], "doc_id long, text string, lang string, key string, name string, body string, score int"
    )
    model = langid.train(docs)
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        if lang is not None:
            counts[lang] += buckets(text or "")
    assert model.languages == tuple(sorted(counts))
    weights = {}
    for lang in model.languages:
        total = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
        weights[lang] = lambda b, c=counts[lang], t=total: math.log((c[b] + 0.5) / t)
    found = Counter((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(docs, model).collect())
    expected = Counter()
    for key, text, _ in rows:
        here = buckets(text or "")
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            expected[key, "und", 0.0] += 1
            continue
        scores = [(sum(n * weights[lang](b) for b, n in here.items()), lang) for lang in model.languages]
        best = max(s for s, _ in scores)
        name = next(lang for s, lang in scores if s == best)
        expected[key, name, round(1 / sum(math.exp(s - best) for s, _ in scores), 9)] += 1
    assert found == expected


def test_pages_of_repeated_rows_and_clashing_columns(spark):
    ship(spark)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = pagetext.train(pagetext.lexicon_of(pages))
    plain = {r.page_id: (r.url, r.text, r.n_chars) for r in pagetext.extract(pages, model=model).collect()}
    doubled = pages.union(pages).selectExpr("*", "'x' AS body", "1 AS text", "2 AS n_chars", "'k' AS key")
    found = pagetext.extract(doubled, model=model)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = Counter((r.page_id, r.url, r.text, r.n_chars) for r in found.collect())
    assert rows == Counter({(k, *v): 2 for k, v in plain.items()})


def allowed(good, tests, part):
    """The lowest cutoff of each rule that the exact interval allows for the good texts of a stratum."""
    out, n = {}, len(good)
    for rule, grid in quality.GRIDS.items():
        for c in grid:
            over = sum(g[rule] > c for g in good)
            tail = 1.0 if over >= n * part else math.fsum(comb(n, i) * part**i * (1 - part) ** (n - i) for i in range(over + 1))
            if tail <= quality.DELTA / tests:
                out[rule] = c
                break
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_verdicts_match_plain_cutoffs(spark, seed):
    ship(spark)
    draw = random.Random(seed)
    texts = []
    for i in range(9000):
        words = [f"{'lo' * draw.randint(1, 3)}{draw.randrange(10**6)}" for _ in range(draw.randint(18, 30))]
        is_good = draw.random() < 0.95
        if draw.random() < 0.002:
            words[0] = "#" * 40
        if not is_good and i % 2:
            words = [w + "&" * 9 for w in words]
        texts.append((" ".join(words[:10]) + "\n" + " ".join(words[10:]), ("aa", "bb")[i % 3 == 0], is_good))
    # Copies under new keys, some labelled bad, which makes the text bad; a stratum without labels.
    rows = [(i, t, lang, int(good)) for i, (t, lang, good) in enumerate(texts)]
    rows += [(10_000 + k, *rows[0][1:3], 1) for k in range(2000)] + [(20_000 + k, *rows[k][1:3], 0) for k in range(0, 900, 3)]
    rows += [(30_000 + k, rows[k][1], None, None) for k in range(5)] + [(40_000, None, "aa", 1)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[3] is not None], "doc_id long, quality int")

    def measured(text):
        words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        size = sum(map(len, words))
        share = lambda a, b: a / b if b else 0.0
        return {
            "symbol_share": share(sum(text.count(c) for c in quality.SYMBOLS), size),
            "dup_line_share": share(len(lines) - len(set(lines)), len(lines)),
            "repeat_share": 0.0,
            "word_length": share(size, len(words)),
            "word_shortness": share(len(words), size),
            "failed": len(words) < 20,
        }

    metric = {i: measured(t or "") for i, t, _, _ in rows}
    good = defaultdict(lambda: True)
    for i, t, lang, label in rows:
        if label is not None and not metric[i]["failed"]:
            good[lang, t] &= label == 1
    first = {(lang, t): i for i, t, lang, _ in rows}
    strata = defaultdict(list)
    for pair, is_good in good.items():
        if is_good:
            strata[pair[0]].append(metric[first[pair]])
    tests = len(strata) * sum(map(len, quality.GRIDS.values()))
    limits = {lang: allowed(members, tests, quality.ALPHA / len(quality.GRIDS)) for lang, members in strata.items()}
    assert any(limits.values())
    expected = {}
    for i, _, lang, _ in rows:
        over = any(metric[i][rule] > c for rule, c in limits.get(lang, {}).items())
        expected[i] = not metric[i]["failed"] and not over
    assert {r.doc_id: r.kept for r in quality.judge(docs, labels).collect()} == expected
    assert 0 < sum(not kept and not metric[i]["failed"] for i, kept in expected.items())
