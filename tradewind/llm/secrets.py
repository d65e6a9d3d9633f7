"""Secret scans over a ledger of content-addressed blobs, with Spark expressions only.

Every text is a version of the file at its path (here: of its document) and is addressed by the SHA-256 of its
bytes.  The ledger holds one row per blob, rule and version of the rule, with the spans found, or none.  A scan takes the
pairs of blob and rule version that the ledger lacks, fetches one text per such blob, runs only the rules that are
due, and appends; findings are then joined back to all paths that ever held the blob.

Defined cases: a null text is the empty blob; paths may repeat and each gets its findings; an empty table
leaves the ledger as it is.  Places are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import stored, texts

SPANS = "array<struct<start:int,stop:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; a match whose ``group`` is shorter than ``least`` is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The three base rules.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 32),
)
RULES = BASE + MORE


def _can_match(rule: Rule) -> str:
    """A pattern that every text with a lasting match has."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.least > 1:
        fixed = len(rule.pattern[: rule.pattern.index("[")])
        return f"{rule.pattern[:-1]}{{{rule.least - fixed},}}" if rule.pattern.count("[") == 1 else rule.pattern
    return rule.pattern


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of the lasting matches; the gaps between matches and the matches add up to the places."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x) >= rule.least)
    matches = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), kept.alias("kept"))
    walked = F.aggregate(
        matches, F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")),
        lambda done, m: F.struct(
            (done["at"] + m["gap"] + F.coalesce(m["size"], F.lit(0))).alias("at"),
            F.when(m["kept"], F.concat(done["spans"], F.array(F.struct(
                (done["at"] + m["gap"]).alias("start"), (done["at"] + m["gap"] + m["size"]).alias("stop")))))
            .otherwise(done["spans"]).alias("spans")),
        lambda done: done["spans"])
    return F.when(text.rlike(_can_match(rule)), walked).otherwise(F.array().cast(SPANS))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.range(0).selectExpr("cast(id as string) blob", "cast(id as string) rule", "cast(id as int) version", f"cast(array() as {SPANS}) spans")


def paths_of(docs: DataFrame) -> DataFrame:
    """``doc_id, blob`` for every version of every document."""
    return texts(docs).select("doc_id", F.sha2("text", 256).alias("blob"))


def scan_unseen(docs: DataFrame, paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the blob and rule-version pairs that the ledger lacks."""
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
    due = (paths.groupBy("blob").agg(F.min("doc_id").alias("holder")).join(seen, "blob", "left")
           .select("blob", "holder", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<struct<rule:string,version:int>>"))).alias("due"))
           .where("size(due) > 0"))
    rows = texts(docs).select("doc_id", "text")
    # A holder's id may occur with several texts: the digest picks the version.
    blobs = rows.join(due, F.col("doc_id").eqNullSafe(F.col("holder"))).where(F.sha2("text", 256) == F.col("blob"))
    found = F.array(*[
        F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"),
                 F.when(F.exists("due", lambda d: (d["rule"] == r.kind) & (d["version"] == r.version)),
                        spans_of(F.col("text"), r)).alias("spans")) for r in rules])
    return (blobs.select("blob", F.explode(F.filter(found, lambda f: f["spans"].isNotNull())).alias("f"))
            .select("blob", "f.rule", "f.version", "f.spans").dropDuplicates(["blob", "rule", "version"]))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``doc_id, blob, findings`` for every path, and the ledger with what was scanned now."""
    past = empty_ledger(docs.sparkSession) if ledger is None else ledger
    paths = stored(paths_of(docs), "secret-paths")
    now = past.unionByName(stored(scan_unseen(docs, paths, past, rules), "secret-ledger"))
    current = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    by_blob = (now.where(F.array_contains(current, F.struct("rule", "version")) & (F.size("spans") > 0))
               .groupBy("blob").agg(F.collect_list(F.struct("rule", "spans")).alias("findings")))
    empty = F.array().cast(by_blob.schema["findings"].dataType)
    found = paths.join(by_blob, "blob", "left").select("doc_id", "blob", F.coalesce("findings", empty).alias("findings"))
    return found, now


def secret_digests(found: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    flat = F.array_sort(F.flatten(F.transform("findings", lambda f: F.transform(f["spans"], lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, f["rule"]).alias("place"), s["stop"].alias("stop"), f["rule"].alias("kind"))))))
    rows = found.select("doc_id", flat.alias("all"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    count = lambda r: F.size(F.filter("all", lambda s: s["kind"] == r.kind)).cast("long").alias(f"n_{r.kind}")
    return rows.select(
        "doc_id", *[count(r) for r in base],
        F.sha2(line(F.filter("all", lambda s: s["place"] <= len(base))), 256).alias("base_sha256"), line(F.col("all")).alias("spans"))
