"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the hash of its content. The ledger
keeps one row per (blob, rule, rule version) that was scanned, with the spans
found, so content is scanned once however many paths and versions carry it, and
a new rule version reads old blobs again while unchanged rules do not. Findings
are joined back to all paths at the end. Everything is a DataFrame expression.

Positions are code points, end exclusive. Null texts are empty texts. Repeated
rows and equal contents share a blob and each keeps its row; an empty table gives
no rows; other columns, whatever their names, are ignored by `findings` and kept
by `redact`. A path may have any number of versions, and one content may hold
any share of the rows: it is reduced per input split before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.frames import SCAN_CHUNK, bound, running, store, text_of
from changeloom.session import shared_dir


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if group `group` has `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules in the order of their kinds.
BASE_RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Spans that this scan adds to the base ones.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, base=False),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<start:int,end:int>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches of one rule, as (start, end)."""
    # Runs of one class that are too short can't hide a longer one, so the length goes into the pattern.
    pattern, checked = rule.pattern, rule.group > 0
    if not checked and rule.pattern.endswith("]+"):
        prefix = len(rule.pattern.split("[")[0])
        pattern = f"{rule.pattern[:-1]}{{{rule.least - prefix},}}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    counts = (lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group)) >= rule.least) if checked else (lambda hit: F.lit(True))
    # The part after the last match has none.
    steps = F.filter(
        F.zip_with(gaps, found, lambda gap, hit: F.struct(gap.alias("gap"), F.length(hit).alias("size"), counts(hit).alias("ok"))),
        lambda x: x["size"].isNotNull(),
    )
    return F.when(text.rlike(pattern), bound(steps, placed)).otherwise(F.array().cast(SPAN))


def placed(steps: Column) -> Column:
    """(start, end) of the matches that count, from the size of each and the gap before it."""
    ends = bound(F.transform(steps, lambda x: x["gap"] + x["size"]), lambda moves: running(moves, lambda a, b: a + b))
    spans = F.zip_with(
        steps, ends, lambda x, end: F.struct((end - x["size"]).alias("start"), end.alias("end"), x["ok"].alias("ok"))
    )
    return F.transform(F.filter(spans, lambda x: x["ok"]), lambda x: F.struct(x["start"], x["end"]))


def blobs(versions: DataFrame, text: str = "text") -> DataFrame:
    """One row per content: (blob, body)."""
    body = text_of(versions, text)
    return versions.select(F.sha2(body, 256).alias("blob"), body.alias("body")).dropDuplicates(["blob"])


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scan the (blob, rule version) pairs that the ledger at `ledger` lacks and append them."""
    spark = versions.sparkSession
    content = blobs(versions, text)
    names = F.array(*[F.lit(r.name) for r in rules])
    known = read_ledger(spark, ledger)
    if known is None:
        todo = content.withColumn("todo", names)
    else:
        seen = known.where(F.col("rule").isin([r.name for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        missing = F.array_except(names, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
        todo = content.join(seen, "blob", "left").withColumn("todo", missing).where(F.size("todo") > 0)
    body = F.col("body")
    scanned = [
        F.when(
            F.array_contains("todo", r.name),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), spans_of(body, r).alias("spans")),
        )
        for r in rules
    ]
    pairs = todo.select("blob", F.explode(F.filter(F.array(*scanned), lambda x: x.isNotNull())).alias("pair"))
    pairs.select("blob", "pair.*").write.mode("append").parquet(ledger)


LEDGER_SCHEMA = f"blob string, rule string, kind string, spans {SPAN}"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """Scanned pairs, or None before the first scan."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, hits) of blobs with a span: all spans by start, then rule order."""
    order = {r.name: i for i, r in enumerate(rules)}
    place = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    current = ledger.where(F.col("rule").isin(list(order)) & (F.size("spans") > 0))
    hit = F.transform(
        "spans",
        lambda s: F.struct(s["start"].alias("start"), place[F.col("rule")].alias("place"), F.col("kind"), s["end"].alias("end")),
    )
    per_blob = current.groupBy("blob").agg(F.collect_set(hit).alias("sets"))
    # Spans of different rules differ, and a rule that was scanned twice has left one set.
    return per_blob.select("blob", F.sort_array(F.flatten("sets")).alias("hits"))


def with_findings(versions: DataFrame, text: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of `versions` as a struct `row`, with the hits of its content (may be null)."""
    spark = versions.sparkSession
    ledger = ledger or shared_dir(spark, "secret-ledger")
    scan(versions, ledger, rules, text)
    # Written first: the join with the paths can then be split at a blob with many of them.
    hits = store(findings(read_ledger(spark, ledger), rules), "findings")
    paths = versions.select(F.struct("*").alias("row"), F.sha2(text_of(versions, text), 256).alias("blob"))
    return paths.join(hits, "blob", "left")


def listed(hits: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(hits, lambda h: F.concat_ws(":", h["kind"], h["start"], h["end"])), ",")


def of_kind(kinds: list[str]) -> Callable[[Column], Column]:
    return lambda h: h["kind"].isin(kinds)


def report(versions: DataFrame, ledger: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the base kinds, hash of the base spans, all spans."""
    slim = versions.select(key, text)
    rows = with_findings(slim, text, ledger)
    hits = F.coalesce(F.col("hits"), F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>"))
    base_kinds = [r.kind for r in BASE_RULES]
    counts = [F.size(F.filter(hits, of_kind([k]))).cast("long").alias(f"n_{k}") for k in base_kinds]
    base = F.filter(hits, of_kind(base_kinds))
    return rows.select(
        F.col("row")[key].alias(key), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(hits).alias("spans")
    )


def islands(hits: Column) -> Column:
    """Disjoint (start, end) that cover the same places; spans that only touch stay apart."""

    def cut(reach: Column) -> Column:
        opens = F.filter(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: (i == 0) | (F.get(hits, i)["start"] >= F.get(reach, i - 1)))
        return bound(opens, lambda first: F.transform(first, lambda i, k: one(first, i, k, reach)))

    def one(first: Column, i: Column, k: Column, reach: Column) -> Column:
        last = F.coalesce(F.get(first, k + 1), F.size(hits)) - 1
        return F.struct(F.get(hits, i)["start"].alias("start"), F.get(reach, last).alias("end"))

    return bound(bound(F.transform(hits, lambda h: h["end"]), lambda ends: running(ends, F.greatest)), cut)


def marked(body: Column, cuts: Column, mark: str) -> Column:
    """`body` with `mark` in the place of every cut.

    A place in a text is found by walking to it, so the text is parted at every
    SCAN_CHUNK-th cut first and the places are looked up in the parts.
    """
    end_before = lambda list_, i, start: F.when(i == 0, start).otherwise(F.get(list_, i - 1)["end"])

    def part(k: Column) -> Column:
        start = end_before(cuts, k * SCAN_CHUNK, F.lit(0))
        return bound(F.slice(cuts, k * SCAN_CHUNK + 1, SCAN_CHUNK), lambda some: bound(start, lambda at: pieces(some, at)))

    def pieces(some: Column, at: Column) -> Column:
        end = F.get(some, F.size(some) - 1)["end"]

        def replaced(region: Column) -> Column:
            before = lambda i: end_before(some, i, at)
            return F.transform(
                some, lambda s, i: F.concat(F.substring(region, before(i) - at + 1, s["start"] - before(i)), F.lit(mark))
            )

        return F.array_join(bound(F.substring(body, at + 1, end - at), replaced), "")

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / SCAN_CHUNK).cast("int")), part)
    tail = F.substring(body, F.get(cuts, F.size(cuts) - 1)["end"] + 1, F.length(body))
    return F.concat(F.array_join(parts, ""), tail)


def redact(versions: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """`versions` with every span replaced by `mark`; overlapping spans become one mark."""
    rows = with_findings(versions, text)
    body, hits = F.col("row")[text], F.col("hits")
    clean = F.when(hits.isNull(), body).otherwise(bound(islands(hits), lambda cuts: marked(body, cuts, mark)))
    columns = [clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in versions.columns]
    return rows.select(*columns)
