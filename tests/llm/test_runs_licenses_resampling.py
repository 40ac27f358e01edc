"""Periodic runs, license scans and importance resampling against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction
from zlib import crc32

import duckdb
import numpy as np
import pytest

from changeloom.llm import licenses, oracle, periodic, resample
from changeloom.llm.frames import ship

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, uid string, key string, words int, found string, rank int, score string, weight int"
ODD = [
    None,
    "",
    " \n\t ",
    "one",
    "été ÉTÉ A1-b2",
    "All Rights  Reserved all rights reserved",
    "rights reserved cc-by cc by CC\nBY",
    "the GNU general public\nlicense, general public licenses",
    "x " * 40,
    "a b " * 9 + "c " + "a b " * 30,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "software this of copy a obtaining person any to charge of free granted hereby is permission",
    "w " * 60 + "Licensed under the Apache License, Version 2.0" + " v" * 60,
    " ".join(f"n{i % 7}" for i in range(400)) + " " + " ".join(f"m{i}" for i in range(3000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Whole sf0.001 documents and odd rows, some twice; further columns clash with internal names."""
    ship(spark)
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = given + [(-i - 1, x) for i, x in enumerate(ODD)] + [(-6, ODD[5]), (-10, ODD[9]), (None, ODD[9]), (None, ODD[12])]
    return spark.createDataFrame([(*r, "u", "k", 1, "f", 2, "s", 3) for r in rows], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def given(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, expected):
    place = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted(map(tuple, df.collect()), key=place) == sorted(expected, key=place)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({i: i + 32 for i in range(65, 91)}))


# Periodic runs


def all_runs(words, least=24, periods=3):
    """Every period by itself: maximal stretches of equal words q apart, shortest period kept."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((a, size, q) for (a, size), q in found.items()), key=lambda r: (r[0], r[2]))


def test_least_prefix_covers_every_period():
    assert periodic.least_prefix() == 16
    assert all(max(24, 3 * q) - q >= 16 for q in range(1, 100))


def test_runs_match_every_period_tried():
    draw = random.Random(5)
    texts = []
    for _ in range(300):
        letters, words = draw.randint(1, 4), []
        while len(words) < draw.randint(10, 160):
            unit = [b"%d" % draw.randrange(letters) for _ in range(draw.randint(1, 12))]
            words += unit * draw.randint(1, 9)
        texts.append(words)
    texts += [[], [b"a"], [b"a"] * 23, [b"a"] * 24, [b"a"] * 500, [b"a", b"b"] * 12, texts[0], texts[0]]
    assert periodic.runs_of(texts) == [all_runs(t) for t in texts]
    assert periodic.runs_of(texts, 6, 2) == [all_runs(t, 6, 2) for t in texts]


def test_equal_hashes_do_not_change_runs(monkeypatch):
    monkeypatch.setattr(periodic.RangeHash, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    texts = [[b"%d" % (i % q) for i in range(n)] for q, n in ((3, 30), (5, 90), (97, 100), (8, 24))]
    assert periodic.runs_of(texts) == [all_runs(t) for t in texts]


def test_ordered_sets_split_and_find_neighbours(monkeypatch):
    monkeypatch.setattr(periodic, "LOAD", 4)
    draw, have = random.Random(2), [50]
    held = periodic.Positions(50)
    for x in draw.sample([i for i in range(100) if i != 50], 99):
        assert held.around(x) == (max((y for y in have if y < x), default=None), min((y for y in have if y > x), default=None))
        held.add(x)
        have.append(x)
    assert list(held) == sorted(have) and held.size == 100 and len(held.lists) > 10


def test_long_periodic_text_is_quick():
    words = [b"a"] * 300_000
    assert periodic.runs_of([words]) == [[(0, 300_000, 1)]]
    draw = random.Random(1)
    unit = [b"%d" % draw.randrange(50) for _ in range(40_000)]
    assert (0, 160_000, 40_000) in periodic.runs_of([unit * 4])[0]


def test_run_report_matches_brute_force(docs, given, empty):
    expected = []
    for key, text in given:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h = crc32(str(key).encode()) if key is not None else 1
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = all_runs(words) if len(words) < 6000 else periodic.runs_of([[w.encode() for w in words]])[0]
        best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
        shown = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
        dropped = {i for a, size, q in runs for i in range(a + q, a + size)}
        left = " ".join(w for i, w in enumerate(words) if i not in dropped)
        lines = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((key, len(runs), *shown, sha(lines), sha(left)))
    got = periodic.report(docs, change=periodic.planted).drop("n_words", "n_kept")
    same(got, expected)
    assert sum(r[1] > 0 for r in expected) > 20
    assert periodic.report(empty).count() == 0


# License scans


def test_license_sql_agrees(docs, spark):
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    got = licenses.scan(docs)
    rows = db.execute(f"SELECT {', '.join(got.columns)} FROM ({oracle.ORACLE_SQL['op13_license_scan']})").fetchall()
    same(got, rows)


@pytest.mark.parametrize("containment", [0.8, 0.5])
def test_licenses_match_brute_force(docs, given, empty, containment):
    expected = []
    for key, text in given:
        words = plain_words(text)
        places, base, more, best = [], set(), set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            w = phrase.split()
            at = [i for i in range(len(words) - len(w) + 1) if words[i : i + len(w)] == w]
            places += at
            base |= {label} if at else set()
        for label, notice in licenses.NOTICES:
            n, wanted = len(notice.split()), set(notice.split())
            for k in range(0, len(words), n):
                share = len(wanted & set(words[k : k + 2 * n])) / len(wanted)
                if share >= containment - 1e-12:
                    more.add(label)
                    best = max(best, share)
        ends = (min(places), max(places)) if places else (None, None)
        labels = [",".join(sorted(x)) for x in (base, base | more)]
        expected.append((key, len(words), len(places), *ends, *labels, 1.0 if places else best))
    same(licenses.scan(docs, containment=containment), expected)
    assert sum(e[-2] != e[-3] for e in expected) >= 4
    assert licenses.scan(empty).count() == 0


def test_license_scan_runs_no_python(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# Importance resampling


def resampled(given, wanted, percent=5, buckets=10_000):
    def features(text):
        w = plain_words(text)
        return [crc32(" ".join(w[i : i + n]).encode()) % buckets for i in range(len(w)) for n in (1, 2, 3) if i + n <= len(w)]

    found = [features(t) for _, t in given]
    source, target = Counter(b for f in found for b in f), Counter(b for t in wanted for b in features(t))
    all_s, all_t = sum(source.values()) + buckets, sum(target.values()) + buckets
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * all_s / ((source[b] + 1) * all_t))) for b in range(buckets)}
    rows = []
    for (key, text), f in zip(given, found, strict=True):
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text))])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    places = {id(r): i for i, r in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*r[:4], places.get(id(r)), r[4]) for r in rows]


@pytest.mark.parametrize("percent", [5, 100])
def test_resampling_matches_brute_force(spark, docs, given, percent):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = [r.text or "" for r in target.collect()]
    same(resample.resample(docs, target, percent=percent), resampled(given, wanted, percent))


def test_resampling_sql_agrees(spark, docs):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    db.register("benchmark", target.toPandas())
    got = resample.resample(docs, target).drop("n_words")
    same(got, db.execute(f"SELECT {', '.join(got.columns)} FROM ({oracle.ORACLE_SQL['op11_resample']})").fetchall())


def test_resampling_of_empty_tables(spark, docs, given, empty):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert resample.resample(empty, target).count() == 0
    same(resample.resample(docs, empty, percent=10), resampled(given, [], 10))


def test_overlapped_scan_emits_every_run_once():
    for text in ("", "a", "a b", "a b c", "a b c d", "é é é", "-A--B-"):
        w = plain_words(text)
        runs = [" ".join(w[i : i + n]) for i in range(len(w)) for n in (1, 2, 3) if i + n <= len(w)]
        found = resample.buckets_of(resample.collapsed(text.encode())).tolist()
        assert Counter(found) == Counter(crc32(r.encode()) % 10_000 for r in runs)


def test_places_are_spread_and_dense(spark):
    rows = spark.range(20_000).selectExpr("id AS uid", "id % 7 AS score")
    out = resample.ranked(rows, [rows.score.desc(), rows.uid.asc()]).orderBy("rank").collect()
    assert [r.rank for r in out] == list(range(1, 20_001))
    assert [(-r.score, r.uid) for r in out] == sorted((-r.score, r.uid) for r in out)
