"""Secrets in texts, found once for each content: an incremental ledger of blobs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tablecheck.functions.columns import fresh
from tablecheck.llm.common import in_batches, ship, texts
from tablecheck.session import staging_path

SPAN = "struct<kind:string,start:bigint,end:bigint>"
LEDGER = f"blob binary, rule_version string, spans array<{SPAN}>, cover array<struct<start:bigint,end:bigint>>"
MASK = "[SECRET]"
#: Up to so many blobs with findings are broadcast (some 100 bytes each), more are joined by a shuffle.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that do not overlap; one counts if `group` has `least` characters.
    A text without any of `needs` has none."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = 0
    needs: tuple[str, ...] = ()


# What counts as a secret. Runs of one class are maximal, so a least length
# inside the pattern finds the same matches as dropping short ones afterwards.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
        flags=re.IGNORECASE | re.ASCII,
        needs=("=", ":"),
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", needs=("AKIA",)),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# A private key goes to its END line, and not over another BEGIN. Where no END follows, it goes over
# the base64 words after the BEGIN, of which a last one in a line of its own may look like any word.
_GAP = r"(?:\s|\\[nr])*+"
_CODED = r"(?=[A-Za-z]*+[0-9+/=]|[A-Za-z]*[a-z][A-Z]|[A-Za-z]{16})[A-Za-z0-9+/=]++"
_OPEN = (
    rf"(?:{_GAP}(?:Proc-Type|DEK-Info):[^\n\\]*+)*+"
    rf"(?:(?:{_GAP}{_CODED})++(?:[^\S\n]*+\n[A-Za-z0-9+/=]++(?=\s*?(?:\n|\Z)))?)?"
)
ADDED = (
    Rule(
        "pem",
        r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
        rf"(?:(?:(?!-----BEGIN ).)*?-----END [A-Z ]{{0,40}}PRIVATE KEY-----|{_OPEN})",
        flags=re.DOTALL,
        needs=("PRIVATE KEY-----",),
    ),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs=("eyJ",)),
)
RULES = BASE + ADDED


def rule_version(rules: tuple[Rule, ...]) -> str:
    """Changes with any rule."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def find(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then by the order of the rules."""
    found = []
    for k, rule in enumerate(rules):
        if rule.needs and not any(x in text for x in rule.needs):
            continue
        for m in re.compile(rule.pattern, rule.flags).finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), k, m.end()))
    return [(rules[k].kind, start, end) for start, k, end in sorted(found)]


def covered(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The spans as disjoint stretches, last one first."""
    out: list[tuple[int, int]] = []
    for _, start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out[::-1]


def _scan(rules: tuple[Rule, ...], version: str):
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    stretch = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches):
            found = [find(t, rules) for t in batch.column("text").to_pylist()]
            names = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in found]
            cover = [[{"start": a, "end": b} for a, b in covered(x)] for x in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "blob": batch.column("blob"),
                    "rule_version": pa.array([version] * len(found), pa.string()),
                    "spans": pa.array(names, pa.list_(span)),
                    "cover": pa.array(cover, pa.list_(stretch)),
                }
            )

    return run


class Ledger:
    """What has been found in which blob by which version of the rules.

    A folder of Parquet files that only grows. It is read with one row for each pair of blob and
    rule version: writers that begin together may each add a blob, and what they add is the same.
    `path` must be in storage that all executors share; without one, a new folder below the
    shared staging folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules, self.version = spark, rules, rule_version(rules)
        self.path = path or staging_path(spark, "secret-ledger")

    def rows(self) -> DataFrame:
        """This rule version's part of the ledger, one row for each blob."""
        return self._written().dropDuplicates(["blob"])

    def _written(self) -> DataFrame:
        try:
            found = self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException:  # nothing was ever scanned
            found = self.spark.createDataFrame([], LEDGER)
        return found.filter(F.col("rule_version") == self.version)

    def _begun(self) -> bool:
        try:
            return not self._written().limit(1).isEmpty()
        except AnalysisException:
            return False

    def update(self, docs: DataFrame) -> None:
        """Scans each blob of `docs` that the ledger does not hold, once, and adds it.

        One shuffle of the texts by blob finds both what is known and what repeats; copies
        are combined before it. A run that fails adds nothing, and running it again is safe."""
        ship(self.spark)
        blobs = addressed(docs).select("blob", "text")
        if self._begun():
            blobs = blobs.join(self._written().select("blob"), "blob", "left_anti")
        new = blobs.groupBy("blob").agg(F.first("text").alias("text"))
        new.mapInArrow(_scan(self.rules, self.version), LEDGER).write.mode("append").parquet(self.path)

    def findings(self, docs: DataFrame) -> DataFrame:
        """(doc_id, spans): the ledger's findings for every row of `docs`, empty if none.

        Only blobs with findings are joined; a blob with many rows is no hot group, as the
        ledger has one row for it."""
        held = self.rows().filter(F.size("spans") > 0).select("blob", "spans")
        rows = addressed(docs).select("doc_id", "blob").join(held, "blob", "left")
        return rows.select("doc_id", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def addressed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, blob): the SHA-256 of each text. A NULL text is the empty blob."""
    docs = texts(docs)
    return docs.withColumn("blob", F.unhex(F.sha2("text", 256)))


def scan(docs: DataFrame, ledger: Ledger) -> DataFrame:
    """(doc_id, spans array of kind, start, end) for every row; code points, end exclusive.

    NULL and empty texts have no spans; equal texts, whatever their ids, have equal spans; a
    NULL id stays NULL."""
    ledger.update(docs)
    return ledger.findings(docs)


def redact(docs: DataFrame, ledger: Ledger, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """`docs` with every secret replaced by a mask, and their size in code points renewed.
    All rows and columns stay; texts without a secret, and NULL ones, stay as they are."""
    ledger.update(docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")))
    key, cover = fresh(docs.columns, "blob", "cover")
    held = ledger.rows().filter(F.size("spans") > 0).select(F.col("blob").alias(key), F.col("cover").alias(cover))
    if held.count() <= BROADCAST_ROWS:  # then the texts need not move again
        held = F.broadcast(held)
    blob = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    mask = f"""CASE WHEN {cover} IS NULL THEN `{text_col}` ELSE aggregate({cover}, `{text_col}`, (t, s) ->
        concat(substring(t, 1, int(s.start)), '{MASK}', substring(t, int(s.end) + 1))) END"""
    out = docs.withColumn(key, blob).join(held, key, "left")
    changed = {text_col: F.expr(mask)}
    if size_col and size_col in docs.columns:
        size = docs.schema[size_col].dataType
        renewed = F.when(F.col(cover).isNull(), F.col(size_col)).otherwise(F.length(F.expr(mask)).cast(size))
        changed[size_col] = renewed
    return out.withColumns(changed).select(*docs.columns)
