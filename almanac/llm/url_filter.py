"""Verdicts on URLs from rules on hosts and paths, in DataFrame operations only.

Every URL is expanded into expressions, a host suffix followed by a path prefix that ends in "/" or is empty. A rule
is stored under one such expression: its host and the part of its path up to the last "/". URLs and rules meet by an
equi-join on the first digits of the expressions' digests; then the full digests are compared, the rest of the rule's
path is, and the longest rule that fits decides.

A rule can only meet expressions that are no longer than its own, so hosts are expanded to as many labels and paths to
as many characters as the rules have at most. Nothing is lost by this, and a URL of any length gives few expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import spare_names

ALLOW, BLOCK = "allow", "block"

#: Hexadecimal digits of the digest that the join goes by.
SHORT = 8
#: Rules that may be sent to every task (about 200 bytes each).
BROADCAST_RULES = 200_000
#: Beyond it, the parts into which the rows of one expression are dealt; each part gets its copy of the rules.
SALTS = 16

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, with A-Z in lower case; empty if there is none."""
    return _lowered(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(?s)(.*/)?", 1)


def _digest(host: Column, prefix: Column) -> Column:
    """Of an expression. No host holds a "/", so host and prefix cannot be read in two ways."""
    return F.sha2(F.concat(host, prefix), 256)


def _cut(text: Column, mark: str, count: Column) -> Column:
    """What stands before the count-th mark; with a negative count, after the count-th mark from the end."""
    return F.call_function("substring_index", text, F.lit(mark), count)


def _suffixes(host: Column, labels: int) -> Column:
    """The host and its parent domains, up to the given number of labels."""
    parts = F.split(host, r"\.", -1)
    sizes = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels)))
    return F.transform(sizes, lambda n: _cut(host, ".", -n))


def _prefixes(path: Column, length: int) -> Column:
    """The empty prefix and all that end in "/", up to the given length."""
    front = F.substring(path, 1, length)
    counts = F.sequence(F.lit(0), F.size(F.split(front, "/", -1)) - 1)
    return F.transform(counts, lambda n: F.when(n == 0, "").otherwise(F.concat(_cut(front, "/", n), F.lit("/"))))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their expression's digest; repeated ones once.

    A rule without a host or a verdict is left out; a missing path counts as empty.
    """
    host, path = _lowered(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    known = rules.filter("host != '' and verdict is not null")
    return (
        known.select(host.alias("rule_host"), path.alias("rule_path"), "verdict")
        .distinct()
        .withColumn("digest", _digest(F.col("rule_host"), _directory(F.col("rule_path"))))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )


def _best() -> Column:
    """The longest rule; of equally long ones that with the longer host, then a blocking one."""
    rule = F.concat("rule_host", "rule_path")
    order = F.struct(
        F.length(rule).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == BLOCK).alias("blocks"),
        rule.alias("rule"),
        "verdict",
    )
    return F.max(order)


def judged_addresses(addresses: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(host, path, best): the rule that decides, for the addresses that any rule fits. Addresses must be distinct."""
    ready = prepared_rules(rules)
    size = ready.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
        F.max(F.length(_directory(F.col("rule_path")))).alias("length"),
    ).first()
    suffixes, prefixes = _suffixes(F.col("host"), size.labels or 0), _prefixes(F.col("path"), size.length or 0)
    if not size.n:
        suffixes = F.array().cast("array<string>")
    expressions = (
        addresses.withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("url_digest"))
        .withColumn("short", F.substring("url_digest", 1, SHORT))
    )
    if size.n <= broadcast_rules:
        met = expressions.join(F.broadcast(ready), "short")
    else:
        salted = expressions.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
        copies = ready.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(copies, ["short", "salt"])
    fitting = met.filter((F.col("url_digest") == F.col("digest")) & F.col("path").startswith(F.col("rule_path")))
    return fitting.groupBy("host", "path").agg(_best().alias("best"))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = ALLOW,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """Every row with host, path, the rule that decides (null if none fits) and the verdict (else ``default``).

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains, where the URL's path begins with
    the rule's. A null URL, and one without "://", has an empty host and path, which no rule fits. Repeated rows stay;
    equal URLs are judged once. Columns of the input named host, path, rule or verdict are replaced. An empty table
    gives an empty one, and without rules all rows get the default.
    """
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    best, salt = spare_names([*kept, "host", "path"], "best", "salt")
    split = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).select(*kept, "host", "path")
    found = judged_addresses(split.select("host", "path").distinct(), rules, broadcast_rules).withColumnRenamed("best", best)
    # one URL may be that of a third of the rows: its rows are dealt by the file part they come from
    rows = split.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    copies = found.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(copies, ["host", "path", salt], "left").select(
        *kept,
        "host",
        "path",
        F.col(f"{best}.rule").alias("rule"),
        F.coalesce(f"{best}.verdict", F.lit(default)).alias("verdict"),
    )
