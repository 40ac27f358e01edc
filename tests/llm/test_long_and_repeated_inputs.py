"""Very long texts take time in proportion to their length, repeated rows are spread or counted once, roles may be hidden."""

import hashlib
import random
import time
from math import comb

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.llm import bpe, chatformat, decontam, pagetext, quality, secretscan, tokenfile
from changeloom.llm.frames import running, ship

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
N = 200_000


def frame(spark, texts):
    ship(spark)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()


# Secret scans


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 2000])
def test_running_scan_in_chunks(spark, n):
    draw = random.Random(n)
    values = [draw.randrange(1000) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    sums, tops = df.select(running(F.col("v"), lambda a, b: a + b), running(F.col("v"), F.greatest)).first()
    assert sums == [sum(values[: i + 1]) for i in range(n)]
    assert tops == [max(values[: i + 1]) for i in range(n)]


def test_a_text_of_many_secrets(spark):
    draw = random.Random(4)
    parts, spans, at = [], [], 0
    for i in range(N):
        gap = " é" * draw.randint(1, 2) + " "
        parts += [gap, f"AKIA{i:020d}"]
        at += len(gap)
        spans.append(f"access:{at}:{at + 24}")
        at += 24
    docs = frame(spark, ["".join(parts), "password=abcdef0123456789abcdef0123456789 x"])
    start = time.time()
    rows = {r.doc_id: r for r in secretscan.report(docs).collect()}
    assert rows[0].n_access == N and rows[0].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    clean = {r.doc_id: r.text for r in secretscan.redact(docs).collect()}
    assert time.time() - start < 60
    assert clean[0] == "".join("[secret]" if p.startswith("AKIA") else p for p in parts)
    assert clean[1] == "[secret] x"


def test_redaction_joins_overlapping_spans(spark):
    draw = random.Random(9)
    pieces = ["token=", "AKIA" + "A1" * 9, "0af1" * 7, "secret : ", " ", "é", "abcdef12", "\n", "gh" + "p_" + "A" * 36, "x"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 60))) for _ in range(150)]
    docs = frame(spark, texts)
    found = {r.doc_id: r.spans for r in secretscan.report(docs).collect()}
    for r in secretscan.redact(docs).collect():
        out, at = [], 0
        for span in filter(None, found[r.doc_id].split(",")):
            _, a, b = span.split(":")
            if int(b) <= at:
                continue
            if int(a) >= at:
                out += [texts[r.doc_id][at : int(a)], "[secret]"]
            at = int(b)
        assert r.text == "".join(out) + texts[r.doc_id][at:]


# Page text


@pytest.mark.parametrize(
    "unit",
    ["<a ", '<a "', "<a b='", "<a", "<!", "<?", "</script ", "<!--", "<svg ", "<svg><", '<a "x" ', "<a '\"", "<a b=\"c'", "<p>x<a ", "<template>", "<"],
)
@pytest.mark.parametrize("tail", ["", ">", "'\">"])
def test_broken_pages_take_linear_time(unit, tail):
    start = time.time()
    pagetext.page_blocks("<p>text</p>" + unit * (1_000_000 // len(unit)) + tail)
    assert time.time() - start < 8


def test_tags_are_those_of_a_plain_search():
    draw = random.Random(6)
    for _ in range(4000):
        page = "".join(draw.choice(["<a ", "<", ">", '"', "'", " b=", "</p", "x", "<!--", "-->", "<!d", "/"]) for _ in range(draw.randint(1, 40)))
        for most in (0, 8):
            tags, at, mine = pagetext.Tags(page), 0, []
            tags.open = 8 - most
            while found := tags.search(at):
                mine.append(found.span())
                at = found.end()
            assert mine == [m.span() for m in pagetext.TAG.finditer(page)], page


def test_lexicon_reads_long_pages_too(spark):
    ship(spark)
    pages = spark.createDataFrame([(1, "<p>" + "lorem ipsum " * 5000)], "page_id long, html string")
    assert {"lorem", "ipsum"} <= set(pagetext.lexicon_of(pages))


# BPE


def test_long_pieces_are_merged_in_linear_time():
    draw = random.Random(8)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    codec = bpe.Codec(VOCABULARY)
    start = time.time()
    ids = codec.encode([text])[0]
    assert time.time() - start < 30
    assert ids.tolist() == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    assert "".join(codec.decode(ids)) == text


def test_both_merges_agree():
    draw = random.Random(3)
    merges = bpe.Merges(VOCABULARY)
    for _ in range(300):
        raw = "".join(draw.choice(["a", "aa", "the", "ing", "é", "漢", "0", "zz", " "]) for _ in range(draw.randint(1, 80))).encode()
        ids = [merges.single[b] for b in raw]
        assert bpe.merge_long(merges.ranks, list(ids)) == bpe.merge_short(merges.ranks, list(ids))


# Token files


@pytest.fixture
def fixed_partitions(spark):
    """Keep the planned number of partitions: small ones are merged otherwise."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_repeated_rows_are_spread_over_the_shards(spark, fixed_partitions, folder):
    rows = spark.range(40_000).selectExpr("7L AS doc_id", "'the same text' AS text").unionByName(
        spark.range(40_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    )
    ship(spark)
    tokenfile.write(rows.repartition(8), f"{folder}/t", tokenfile.LibraryTokenizer(VOCABULARY), 0)
    table = spark.read.schema(tokenfile.BLOCK_SCHEMA).parquet(f"{folder}/t/blocks")
    sizes = [r.n for r in table.groupBy("shard").agg(F.sum("n_docs").alias("n")).collect()]
    assert sum(sizes) == 80_000 and max(sizes) < 20_000
    index = tokenfile.read_index(spark, f"{folder}/t").orderBy("start").collect()
    assert [r.doc_id for r in index] == sorted(r.doc_id for r in index) and len(index) == 80_000


# Decontamination


def test_repeated_items_share_one_row_of_a_block(spark):
    items = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('i', id) END AS item_id", "'a b c' AS text")
    held = [pair for block in decontam.item_blocks(items, "item_id", "text", 1000) for pair in block]
    assert len(held) == len(set(held)) == 4001


# Quality rules


def strata(spark, good, more=()):
    texts = [*good, *more]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(good))], "doc_id long, quality int")
    return docs, labels


def test_copies_are_one_trial(spark):
    ship(spark)
    plain = " ".join(f"word{i}" for i in range(40))
    symbols = " ".join(f"word{i} ###" for i in range(40))
    docs, labels = strata(spark, [plain] * 1000 + [symbols])
    assert all(r.kept for r in quality.judge(docs, labels).collect())


def test_cutoffs_are_those_of_the_exact_interval(spark):
    draw = random.Random(12)
    good = []
    for i in range(6000):
        marks = draw.choices([0, 1, 2, 4, 8], [960, 25, 10, 4, 1])[0]
        good.append((f"s{i % 2}", *([marks / 20] + [draw.random() for _ in range(4)])))
    names = list(quality.GRIDS)
    rows = spark.createDataFrame(good, ", ".join(["stratum string", *(f"{n} double" for n in names)]))
    found = {r["of"]: r for r in quality.cutoffs(rows, alpha=0.25, delta=0.05).collect()}
    tests, part = 2 * sum(map(len, quality.GRIDS.values())), 0.25 / len(names)
    for stratum in ("s0", "s1"):
        mine = [g for g in good if g[0] == stratum]
        n = len(mine)
        for k, (name, grid) in enumerate(quality.GRIDS.items(), 1):
            allowed = []
            for c in grid:
                over = sum(g[k] > c for g in mine)
                # The interval's upper end is below `part` exactly where this tail is small.
                tail = 1.0 if over >= n * part else sum(comb(n, i) * part**i * (1 - part) ** (n - i) for i in range(over + 1))
                if tail <= 0.05 / tests:
                    allowed.append(c)
            assert found[stratum][f"max_{name}"] == (min(allowed) if allowed else None)


# Chat turns


@pytest.mark.parametrize(("share", "least"), [(1, 0.9), (2, 0.95)])
def test_hidden_roles_are_recovered(spark, share, least):
    ship(spark)
    talks = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    hidden = talks.withColumn("role", F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(share)) != 0, F.col("role")))
    found = chatformat.format_turns(hidden).where("part = 0").select("conv_id", "turn", F.col("role").alias("found"))
    joined = talks.join(found, ["conv_id", "turn"])
    assert joined.count() == talks.count()
    assert joined.where("role = found").count() >= least * joined.count()


def test_roles_from_markers_in_the_text_alone(spark):
    ship(spark)
    names = {"system": "System", "user": "Human", "assistant": "Assistant"}
    talks = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    marked = [(r.conv_id, None, None, f"{names[r.role]}: {r.text or ''}", r.turn, r.role) for r in talks.collect()]
    whole = {}
    for conv, _, _, text, turn, role in sorted(marked, key=lambda m: (m[0], m[4])):
        whole.setdefault(conv, []).append((role, text))
    rows = [(conv, 0, None, "\n".join(t for _, t in parts)) for conv, parts in whole.items()]
    frame_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {}
    for r in chatformat.format_turns(frame_).collect():
        found.setdefault(r.conv_id, {})[r.part] = r.role
    right = sum([found[c][k] for k in sorted(found[c])] == [role for role, _ in parts] for c, parts in whole.items())
    assert right >= 0.9 * len(whole)
