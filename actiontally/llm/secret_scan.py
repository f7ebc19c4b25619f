"""Operator 1, secret scans over an incremental blob ledger. DataFrame functions only.

Every historical version of every path is addressed by the SHA-256 of its text. The ledger notes
which (blob, rule version) pairs were scanned and what they held; a run scans the missing pairs
only, one representative version per new blob, and joins the findings back to all versions.

A rule's version is the hash of its definition, so a changed rule is scanned anew and the others
are not. Offsets come from the text between the matches: the end of match i is the total length
of the first i gaps and matches, a running sum over the rows of one blob and rule.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.llm.common import fresh, stored


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


# The base patterns (a run of hexadecimal digits is as long as it can be, so its
# least length may stand in the pattern; likewise for access keys).
BASE_RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Public formats of issued credentials.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"://[A-Za-z0-9._~-]+:[^\x00-\x20/@:]+@"),
)
RULES = BASE_RULES + MORE_RULES


class Ledger:
    """Scanned pairs and findings under ``folder``, appended to by each run. Findings are written
    before the pairs that vouch for them; a run lost in between is scanned again, and repeated
    findings are dropped when read."""

    PAIRS = "blob string, rule string"
    FINDINGS = "blob string, rule string, kind string, start bigint, end bigint"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            # Of a list, executors would make it in Python, by a second daemon that stays (its environment differs).
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)))

    def scanned(self) -> DataFrame:
        return self._read("scanned", self.PAIRS).distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", self.FINDINGS).distinct()

    def append(self, findings: DataFrame, pairs: DataFrame) -> None:
        run = uuid.uuid4().hex
        findings.select("blob", "rule", "kind", "start", "end").write.parquet(f"{self.folder}/findings/{run}")
        pairs.select("blob", "rule").write.parquet(f"{self.folder}/scanned/{run}")


def blob_of(text: Column) -> Column:
    """SHA-256 of the text; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def scan_text(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings ``blob, rule, kind, start, end`` (code points, end exclusive) of ``blob, text,
    todo``, todo being the versions of the rules to apply."""
    def hits(i: int, r: Rule) -> Column:
        zipped = F.arrays_zip(F.transform(F.split("text", r.pattern, -1), F.length).alias("gap"),
                              F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)).alias("hit"))
        wanted = F.array_contains("todo", r.version) & F.col("text").rlike(r.pattern)
        return F.when(wanted, F.transform(zipped, lambda x, k: F.struct(
            F.lit(i).alias("r"), k.alias("k"), x["gap"].alias("gap"), x["hit"].alias("hit")))).otherwise(F.array())

    found = rows.select("blob", F.explode(F.concat(*(hits(i, r) for i, r in enumerate(rules)))).alias("x")).select("blob", "x.*")
    found = found.dropDuplicates(["blob", "r", "k"])  # of a version that was given more than once
    upto = Window.partitionBy("blob", "r").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    at = found.withColumn("end", F.sum(F.col("gap") + F.coalesce(F.length("hit"), F.lit(0))).over(upto)).filter("hit is not null")
    long_enough = reduce(lambda a, ir: F.when(F.col("r") == ir[0], F.length(
        F.regexp_extract("hit", ir[1].pattern, ir[1].group)) >= ir[1].least).otherwise(a), enumerate(rules), F.lit(False))
    name = lambda f: F.element_at(F.array(*(F.lit(f(r)) for r in rules)), F.col("r") + 1)
    return at.filter(long_enough).select("blob", name(lambda r: r.version).alias("rule"), name(lambda r: r.kind).alias("kind"),
                                         (F.col("end") - F.length("hit")).cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


def scan_versions(versions: DataFrame, ledger: Ledger, path_col: str, text_col: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Brings the ledger up to date with all ``versions`` and returns ``path, blob`` of each row.

    A null text is the empty blob. Equal texts, at one path or at many, are scanned once. Null and
    repeated paths are allowed. An empty table scans nothing. Other columns are not read."""
    path = F.col(path_col).alias("path")
    paths = stored(versions.select(path, blob_of(F.col(text_col)).alias("blob")), "blob-paths")
    todo = F.array(*(F.lit(r.version) for r in rules))
    seen = ledger.scanned().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    new = paths.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left").select(
        "blob", "path", F.array_except(todo, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")).filter("size(todo) > 0")
    new = stored(new, "blobs-unseen")
    # The representative's row brings the text: one shuffle of texts, by path, so copies don't meet.
    texts = versions.select(path, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    want = new.select(F.col("path").alias("at"), F.col("blob").alias("want"), "todo")
    here = texts.join(want, F.col("path").eqNullSafe(F.col("at"))).filter(blob_of(F.col("text")) == F.col("want"))
    found = scan_text(here.select(F.col("want").alias("blob"), "text", "todo"), rules).distinct()
    ledger.append(found, new.select("blob", F.explode("todo").alias("rule")))
    return paths


def findings_by_blob(ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, spans``: the rules' findings of each blob that has any, as an array of (start, rank,
    end, kind, before) in order of start, then rule; before: the furthest end of those ahead."""
    rank = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind"))
    ahead = Window.partitionBy("blob").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return ledger.findings().filter(F.col("rule").isin([r.version for r in rules])).withColumn("rank", rank).withColumn(
        "before", F.coalesce(F.max("end").over(ahead), F.lit(0))).groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "before"))).alias("spans"))


def scan_report(paths: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES,
                id_name: str = "doc_id") -> DataFrame:
    """Per path: counts of the base kinds, checksum of the base spans, all spans as text."""
    def joined(x: Column) -> Column:
        return F.concat_ws(",", F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    blobs = findings_by_blob(ledger, rules)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    kinds = [r.kind for r in base]
    found = blobs.select(F.col("blob"), *(of(k).alias(f"n_{k}") for k in kinds),
                         joined(F.filter("spans", lambda s: s["kind"].isin(kinds))).alias("base"), joined(F.col("spans")).alias("spans"))
    return paths.join(found, "blob", "left").select(
        F.col("path").alias(id_name), *(F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in kinds),
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, ledger: Ledger, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with each run of overlapping findings replaced by its first kind in brackets; texts
    without findings and null texts stay as they are. All other columns are kept."""
    blob, spans, key = fresh(docs, "blob", "spans", "found_blob")
    found = findings_by_blob(ledger, rules).select(F.col("blob").alias(key), F.col("spans").alias(spans))
    text = F.col(text_col)
    parts = F.transform(F.col(spans), lambda s: F.when(s["start"] >= s["before"], F.concat(
        text.substr((s["before"] + 1).cast("int"), (s["start"] - s["before"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))).otherwise(""))
    rest = text.substr((F.array_max(F.transform(F.col(spans), lambda s: s["end"])) + 1).cast("int"), F.length(text))
    clean = F.when(F.col(spans).isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest))
    return docs.withColumn(blob, blob_of(text)).join(found, F.col(blob) == F.col(key), "left").select(
        *(clean.alias(c) if c == text_col else F.col(c) for c in docs.columns))


def base_scan_sql(rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> str:
    """The report as DuckDB SQL over ``documents``."""
    import re

    q = lambda s: "'" + s.replace("'", "''") + "'"
    # RE2 has (?i) within a group; spelled out, so that it folds ASCII letters alone.
    fold = lambda m: "(" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in m[1]) + ")"
    re2 = lambda r: re.sub(r"\(\(\?i\)([^)]*)\)\(\?-i\)", fold, r.pattern)
    each = " union all ".join(
        f"select doc_id, {i} r, {q(r.kind)} kind, unnest(range(len(m) + 1)) k, unnest(g) gap, "
        f"unnest(list_append(m, null)) hit, {r.group} grp, {r.least} least, {q(re2(r))} pat from "
        f"(select doc_id, regexp_extract_all(t, {q(re2(r))}) m, string_split_regex(t, {q(re2(r))}) g from t)" for i, r in enumerate(rules))
    long_enough = " or ".join(f"(r = {i} and length(regexp_extract(hit, {q(re2(r))}, {r.group})) >= {r.least})" for i, r in enumerate(rules))
    text = "string_agg(kind || ':' || s || ':' || e, ',' order by s, r)"
    n = len(base)
    return (f"with t as (select doc_id, coalesce(text, '') t from documents), each as ({each}), "
            "pos as (select *, sum(length(gap) + coalesce(length(hit), 0)) over (partition by doc_id, r order by k) e from each), "
            f"ok as (select doc_id, r, kind, cast(e as bigint) e, cast(e as bigint) - length(hit) s from pos where hit is not null and ({long_enough})), "
            "f as (select doc_id, " + ", ".join(f"count(*) filter (kind = '{r.kind}') n_{r.kind}" for r in base) +
            f", {text} filter (r < {n}) b, {text} spans from ok group by doc_id) "
            "select t.doc_id, " + ", ".join(f"coalesce(n_{r.kind}, 0) n_{r.kind}" for r in base) +
            ", sha256(coalesce(b, '')) base_sha256, coalesce(spans, '') spans from t left join f using (doc_id)")
