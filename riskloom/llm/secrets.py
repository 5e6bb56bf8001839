"""Secret scans over a history of texts, with a ledger of scanned blobs.

Every version of every path is known by the SHA-256 of its text (its blob). The ledger is a table in the shared folder: one row per scanned blob and run, with
the rule versions that looked at it and what they found. A scan works out which pairs of blob and rule version the ledger lacks, reads one text of each such blob,
runs only the missing rules on it, appends the rows, and joins all findings of the wanted rules back to every path and version that holds the
blob. A copy is never scanned again, neither in the same run nor in a later one, and a new version of one rule rescans with that rule alone.

Only digests are shuffled to find the unseen blobs. Their texts are picked by (blob, path, version), so the copies of a frequent blob spread over all tasks; if few are unseen,
the picks are broadcast (after a count) and no text is shuffled. Rows are appended in one job; rows that a run wrote before it was lost do no harm, since findings are a set.

Rules give spans in code points, the end exclusive. Base rules state what a match must be; the others add common token formats, and are dropped where they overlap a
base span or an added one that starts before.

Defined results: a null text is the empty blob, without findings; repeated rows repeat their findings; a null path or version is a value like
any other; an empty history gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.functions.joins import fits_broadcast, freeze
from riskloom.llm.common import ship_package
from riskloom.session import materialize

PICKS_BROADCAST = 5_000  # unseen blobs whose places are sent to every executor, about 2 MB; more are joined by a shuffle
LEDGER_SCHEMA = "blob string, rules array<string>, findings array<struct<rule: string, start: long, end: long>>"


def bits_per_character(text: str) -> float:
    """Entropy of the characters of a token."""
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0


def _mixed(text: str) -> bool:
    """Random-looking: letters of both cases and digits, and many different characters."""
    return any(ch.islower() for ch in text) and any(ch.isupper() for ch in text) and any(ch.isdigit() for ch in text) and bits_per_character(text) >= 4.0


@dataclass(frozen=True)
class Rule:
    """A pattern under a name and a version; ``needs`` is a piece of text without which there is no match, ``keep`` judges a match."""

    name: str
    version: int
    pattern: str
    base: bool = False
    needs: str = ""
    keep: Callable[[re.Match], bool] | None = None

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The three base rules, in the order in which kinds are listed. Equal to the plain patterns followed by the tests of length, since their runs are maximal.
BASE_RULES = (
    Rule("assign", 1, r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, "", lambda m: len(m[2]) >= 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", True, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", True),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,20}PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    Rule("web_token", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="eyJ"),
    Rule("host_token", 1, r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})", needs=""),
    Rule("url_password", 1, r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:([^\s/:@]{3,100})@[^\s/@]+", needs="://"),
    Rule("bearer", 1, r"\b[Bb]earer\x20+([A-Za-z0-9+/_.=~-]{20,})", needs="earer ", keep=lambda m: _mixed(m[1])),
    Rule("random", 1, r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,200}={0,2}(?![A-Za-z0-9+/_=-])", keep=lambda m: _mixed(m[0])),
)
RULES = BASE_RULES + MORE_RULES
_compiled: dict[str, re.Pattern] = {}


def _pattern(rule: Rule) -> re.Pattern:
    if rule.pattern not in _compiled:
        _compiled[rule.pattern] = re.compile(rule.pattern)
    return _compiled[rule.pattern]


def find(text: str, rule: Rule) -> list[tuple[str, int, int]]:
    """(rule key, start, end), leftmost matches that do not overlap; matches that fail the rule's test are dropped without another try."""
    if rule.needs and rule.needs not in text:
        return []
    return [(rule.key, *m.span()) for m in _pattern(rule).finditer(text) if rule.keep is None or rule.keep(m)]


def apart(findings: list[tuple[str, int, int]], rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    """Base findings, and of the others those that touch neither a base finding nor an earlier kept one; by start, then rule order."""
    order = {r.key: i for i, r in enumerate(rules)}
    base = {r.key for r in rules if r.base}
    taken = sorted((s, e) for key, s, e in findings if key in base)
    bounds: list[list[int]] = []  # base findings merged where they overlap
    for s, e in taken:
        if bounds and s < bounds[-1][1]:
            bounds[-1][1] = max(bounds[-1][1], e)
        else:
            bounds.append([s, e])
    out, free_from, at = [], 0, 0
    for key, s, e in sorted(findings, key=lambda f: (f[1], order[f[0]])):
        if key in base:
            out.append((key, s, e))
            continue
        while at < len(bounds) and bounds[at][1] <= s:
            at += 1
        if s >= free_from and (at == len(bounds) or bounds[at][0] >= e):
            out.append((key, s, e))
            free_from = e
    return out


def _scan(todo: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of (blob, text, rules)."""
    by_key = {r.key: r for r in rules}
    finding = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, found = batch.column("rules").to_pylist(), []
            texts = batch.column("text")
            for i, keys in enumerate(wanted):
                text = texts[i].as_py()  # one text at a time
                found.append([{"rule": k, "start": s, "end": e} for key in keys for k, s, e in find(text, by_key[key])])
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(wanted, pa.list_(pa.string())), pa.array(found, pa.list_(finding))], ["blob", "rules", "findings"])

    ship_package(todo.sparkSession)
    return todo.select("blob", "text", "rules").mapInArrow(work, LEDGER_SCHEMA)


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger's rows; none before the first scan."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_history(history: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path_col: str = "path", version_col: str | None = "version", text_col: str = "text") -> DataFrame:
    """path, version, blob, findings (array of rule, start, end) for every row of ``history``; what was scanned is appended to the table at ``ledger``."""
    spark = history.sparkSession
    version = F.lit(None).cast("string") if version_col is None else c(version_col)
    texts = history.select(c(path_col).alias("path"), version.alias("version"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("blob", F.sha2("text", 256))
    versions = materialize(texts.select("path", "version", "blob"), "versions")
    place = F.struct(F.col("path").isNull().alias("a"), "path", F.col("version").isNull().alias("b"), "version")
    blobs = versions.groupBy("blob").agg(F.min(place).alias("place"))
    known = read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("known"))  # as many as there were rule versions
    missing = F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.coalesce("known", F.array().cast("array<string>")))
    unseen = materialize(blobs.join(known, "blob", "left").select("blob", "place.path", "place.version", missing.alias("rules")).where(F.size("rules") > 0), "unseen-blobs")
    picks = unseen.withColumnsRenamed({"blob": "__blob", "path": "__path", "version": "__version"})
    same = (F.col("blob") == F.col("__blob")) & F.col("path").eqNullSafe(F.col("__path")) & F.col("version").eqNullSafe(F.col("__version"))
    todo = texts.join(F.broadcast(picks) if fits_broadcast(picks.select("__blob", "__path", "__version"), PICKS_BROADCAST) else picks, same)
    _scan(todo, rules).write.mode("append").parquet(ledger)
    wanted = F.array(*[F.lit(r.key) for r in rules])
    found = read_ledger(spark, ledger).where(F.size("findings") > 0).select("blob", F.explode("findings").alias("f")).where(F.array_contains(wanted, F.col("f.rule")))
    found = found.groupBy(F.col("blob").alias("__blob")).agg(F.collect_set("f").alias("findings"))  # of one text
    return freeze(found, "findings").attach(versions, F.col("blob"), "__blob").withColumn("findings", F.coalesce("findings", F.array().cast("array<struct<rule: string, start: long, end: long>>")))


def secret_digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id (the path), counts of the base rules, hash of the base spans, and all spans, as text."""
    base = {r.key: r.name for r in rules if r.base}
    names = {r.key: r.name for r in rules}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base_spans, spans = [], [], []
            for found in batch.column("findings").to_pylist():
                kept = apart([(f["rule"], f["start"], f["end"]) for f in found], rules)
                n = Counter(key for key, _, _ in kept)
                counts.append([n[key] for key in base])
                base_spans.append(",".join(f"{names[key]}:{s}:{e}" for key, s, e in kept if key in base))
                spans.append(",".join(f"{names[key]}:{s}:{e}" for key, s, e in kept))
            yield pa.RecordBatch.from_arrays([batch.column("path"), *[pa.array([row[i] for row in counts], pa.int64()) for i in range(len(base))], pa.array(base_spans, pa.string()), pa.array(spans, pa.string())],
                                             ["doc_id", *[f"n_{name}" for name in base.values()], "base_spans", "spans"])

    ship_package(scanned.sparkSession)
    schema = ", ".join([f"doc_id {scanned.schema['path'].dataType.simpleString()}", *[f"n_{name} long" for name in base.values()], "base_spans string", "spans string"])
    out = scanned.select("path", "findings").mapInArrow(work, schema)
    return out.select("doc_id", *[f"n_{name}" for name in base.values()], F.sha2("base_spans", 256).alias("base_sha256"), "spans")
