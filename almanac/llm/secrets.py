"""Secret scans with a ledger of blobs, in DataFrame operations only.

Every historical version of a text is addressed by its content (SHA-256). The ledger records, per blob and rule
version, where secrets were found, also when there were none; a scan reads only pairs of blob and rule version that
the ledger does not have, appends them, and findings are joined back to every path that ever had the blob. A text
that a third of all paths share is scanned once: equal blobs are merged within each task before they are shuffled.

Offsets are code points. A rule's matches are leftmost and non-overlapping; a match whose checked group is too short
is dropped after matching, so it still uses up its characters.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from almanac.llm.common import spare_names, text_of
from almanac.session import shared_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a changed pattern needs a new version, so that old blobs are scanned again."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three kinds, in the order in which equal starts are listed. A run that is too short cannot hold
# a longer one, so for access and hex the least length stands in the pattern without changing any match.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"(AKIA[A-Z0-9]{16,})", 1, 20),
    Rule("hex", r"([0-9a-f]{24,})", 1, 24),
)

LEDGER = "blob string, rule string, kind string, spans array<struct<start:int,end:int>>"
MASK = "[SECRET]"


def blob_of(text: str = "text"):
    return F.sha2(text_of(text), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All recorded pairs; empty if nothing was scanned yet."""
    try:
        return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _matches(rule: Rule):
    """Per match of a rule in ``text``: characters since the match before, its length, and whether it is long enough."""
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    hits = F.transform(
        found,
        lambda m: F.struct(
            F.length(m).alias("size"), (F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least).alias("ok")
        ),
    )
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda p: F.length(p))
    return F.when(F.size(found) > 0, F.arrays_zip(gaps.alias("gap"), hits.alias("hit")))


def unseen_blobs(versions: DataFrame, known: DataFrame, rules, text: str) -> DataFrame:
    """(blob, text, todo): each content once, with the rule versions it was not scanned with; none if all are known.

    Equal contents are merged before the shuffle, which the ledger joins by the same key.
    """
    keys = [r.key for r in rules]
    seen = known.filter(F.col("rule").isin(keys)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    rows = versions.select(text_of(text).alias("text")).groupBy(F.sha2("text", 256).alias("blob"))
    wanted = F.array(*[F.lit(k) for k in keys])
    once = rows.agg(F.first("text").alias("text")).join(seen, "blob", "left")
    todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return once.select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0)


def scan(versions: DataFrame, ledger: str, rules=RULES, text: str = "text") -> None:
    """Scans what the ledger lacks and appends it. A failed or repeated run does no harm: files of a failed job are
    not visible, and a pair that was recorded twice has equal spans."""
    spark = versions.sparkSession
    todo = unseen_blobs(versions, read_ledger(spark, ledger), rules, text)
    each = F.array(
        *[
            F.struct(
                F.lit(r.key).alias("rule"),
                F.lit(r.kind).alias("kind"),
                F.array_contains("todo", r.key).alias("due"),
                F.when(F.array_contains("todo", r.key), _matches(r)).alias("found"),
            )
            for r in rules
        ]
    )
    pairs = todo.select("blob", F.inline(each)).filter("due")
    parts = pairs.select("blob", "rule", "kind", F.posexplode_outer("found").alias("i", "part"))
    upto = Window.partitionBy("blob", "rule").orderBy("i")
    # the last gap has no match behind it
    ends = F.sum(F.col("part.gap") + F.coalesce("part.hit.size", F.lit(0))).over(upto)
    placed = parts.select("blob", "rule", "kind", "part.hit.*", ends.cast("int").alias("end"))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "end")
    spans = F.array_sort(F.collect_list(F.when(F.col("ok"), span))).alias("spans")
    placed.groupBy("blob", "rule", "kind").agg(spans).write.parquet(f"{ledger}/scan-{uuid.uuid4().hex}")


def findings(spark: SparkSession, ledger: str, rules=RULES) -> DataFrame:
    """Per blob with any secret: spans of all rules by start, then in the rules' order, as (start, kind, end)."""
    order = {r.key: i for i, r in enumerate(rules)}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    rows = read_ledger(spark, ledger).filter(F.col("rule").isin(list(order)) & (F.size("spans") > 0))
    rows = rows.dropDuplicates(["blob", "rule"]).withColumn("rank", rank[F.col("rule")])
    flat = rows.select(
        "blob", F.transform("spans", lambda s: F.struct(s.start, F.col("rank"), s.end, F.col("kind"))).alias("s")
    )
    joined = flat.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("s"))
    return joined.select("blob", F.transform("s", lambda x: F.struct(x["start"], x["end"], x["kind"])).alias("spans"))


def new_ledger(spark: SparkSession) -> str:
    return shared_dir(spark, "llm-ledger")


def secrets_by_path(versions: DataFrame, ledger: str, rules=RULES, text: str = "text", path: str = "doc_id") -> DataFrame:
    """Per row of versions: path, blob and its spans (start, kind, end); brings the ledger up to date first.

    Null texts count as empty and have no spans. Null and repeated paths give a row each.
    """
    scan(versions, ledger, rules, text)
    found = findings(versions.sparkSession, ledger, rules)
    rows = versions.select(F.col(path).alias("path"), blob_of(text).alias("blob"))
    none = F.array().cast(found.schema["spans"].dataType)
    return rows.join(found, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))


def _masked(text, spans):
    """The text with each span, or run of overlapping spans, replaced by the mask."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(MASK)).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(longer)

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)


def redact(docs: DataFrame, ledger: str, rules=RULES, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows, in which secrets are replaced by the mask; other columns stay, but for the length of the text.
    A row without a secret is left as it is, null texts included."""
    scan(docs, ledger, rules, text)
    blob, spans, new = spare_names(docs.columns, "blob", "spans", "new")
    found = findings(docs.sparkSession, ledger, rules).toDF(blob, spans)
    joined = docs.join(found, blob_of(text) == F.col(blob), "left")
    hit = F.col(spans).isNotNull()
    masked = F.when(hit, _masked(F.col(text), F.col(spans))).otherwise(F.col(text))
    columns = {c: F.col(c) for c in docs.columns} | {text: F.col(new)}
    if n_chars in docs.columns:
        size = F.length(new).cast(docs.schema[n_chars].dataType)
        columns[n_chars] = F.when(hit, size).otherwise(F.col(n_chars))
    return joined.withColumn(new, masked).select(*[v.alias(c) for c, v in columns.items()])


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """The result columns of the registered query, from rows (path, spans)."""
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(r.kind).alias(f"n_{r.kind}") for r in rules]
    hexed = F.sha2(listed, 256).alias("base_sha256")
    return found.select(F.col("path").alias("doc_id"), *counts, hexed, listed.alias("spans"))
