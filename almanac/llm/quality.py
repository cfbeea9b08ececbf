"""Quality rules whose thresholds follow each language and source.

Every document gets counts (words, symbols, repeated lines, repeated windows). Rates derived from the counts go
into quantile sketches, one per language, source and rate: log-linear histograms over integers, so merging two
sketches adds their counts, the order of merging cannot matter and the relative error stays below 1/64. Spark
merges them with a partial aggregation, so a source that holds a third of all rows moves one row per bucket and
task. Thresholds are read from the sketches and joined back to the documents.

Two rates vary inside clean text: word length and marks (neither letters, digits nor white space) a character. A
document strays if it lies more than SPREAD x (median - lower quantile) from the median of its source; a document of
fewer words than the median one scatters more and is given that much more room. Half of a source may be junk before
its median moves, and the upper half, where junk lies, has no say. No fixed number takes part but the fixed rules.

What a small source says of itself is uncertain, so its thresholds are read from a mixture of sketches: its own has the
weight n / (n + PRIOR_ROWS) for n documents, that of its language the same share of the rest, and that of all documents
what is left. The weights change document by document; there is no size at which another rule holds.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from almanac.llm.common import bound_batches, spare_names, stored, text_of

#: Fixed rules: a document below this many words, or with more than this share of words in repeated windows, fails.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Adaptive rules: distance of the threshold from the median in lower half-spreads; the quantile of that spread.
SPREAD = 6
LOWER = 0.1
#: At so many documents a group's own sketch weighs as much as that of the next larger group.
PRIOR_ROWS = 100
#: The adaptive rates, from documents that pass the fixed rules; true if both tails are cut, else the upper.
TAILS = {"word_length": True, "mark_rate": False}
#: Threshold rows (one per language and source) are broadcast up to this many; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Buckets double in width every 2**6 steps.
PRECISION = 6

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKS = re.compile(r"[^\w\s]")
_STATS = T.StructType([T.StructField(c, T.LongType()) for c in [*COUNTS, "n_marks"]])


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = text.encode().split()  # bytes split at space and \x09-\x0D only
    n = len(words)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        count: dict = {}
        for w in windows:
            count[w] = count.get(w, 0) + 1
        covered = bytearray(n)
        for i, w in enumerate(windows):
            if count[w] > 1:
                covered[i : i + 3] = b"\x01\x01\x01"
        repeated = sum(covered)
    blanks = sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    return (n, len(text) - blanks, len(_SYMBOLS.findall(text)), duplicates, repeated)


@F.pandas_udf(_STATS)
def _counts(texts: pd.Series) -> pd.DataFrame:
    rows = [(*text_counts(t), len(_MARKS.findall(t))) for t in texts]
    return pd.DataFrame(rows, columns=[*COUNTS, "n_marks"])


def with_counts(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """Adds one struct column of COUNTS and n_marks; a null text counts as empty."""
    bound_batches(docs.sparkSession)
    return docs.withColumn(into, _counts.asNondeterministic()(text_of(text)))


def tails(counts: str) -> dict:
    """The rates of TAILS in fine integer units, so that every engine gets the same values: characters per 1000 words,
    marks per 100,000 characters."""
    return {
        "word_length": F.expr(f"(1000 * {counts}.word_chars) div greatest({counts}.n_words, 1)"),
        "mark_rate": F.expr(f"(100000 * {counts}.n_marks) div greatest({counts}.word_chars, 1)"),
    }


def sketched(counts: str) -> dict:
    """All values that go into sketches; what is null is left out."""
    sound = ~base_failed(counts)
    own = tails(counts) | {"n_words": F.col(f"{counts}.n_words")}
    return {k: F.when(sound, v) for k, v in own.items()}


def bucket(value):
    """The least value of the sketch bucket that holds a value: all digits but the highest PRECISION + 1 are zero."""
    shift = F.greatest(F.length(F.bin(value)) - (PRECISION + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(rows: DataFrame, lang: str, source: str, values: dict) -> DataFrame:
    """Sketches as rows (lang, source, rate, bucket, n); adding up n over groups merges them."""
    pairs = F.array(*[F.struct(F.lit(k).alias("rate"), bucket(v).alias("bucket")) for k, v in values.items()])
    long = rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.inline(pairs))
    return long.filter("bucket is not null").groupBy("lang", "source", "rate", "bucket").agg(F.count("*").alias("n"))


def mixed_sketches(sketches: DataFrame, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """(lang, source, rate, bucket, weight): each source's sketch mixed with that of its language and of all documents."""
    group = ["lang", "source", "rate"]
    own = sketches.groupBy(*group, "bucket").agg(F.sum("n").alias("n"))
    groups = own.select(*group).distinct()
    wide = own.groupBy(F.col("lang").alias("l"), F.col("rate").alias("r"), "bucket").agg(F.sum("n").alias("n"))
    every = own.groupBy(F.col("rate").alias("r"), "bucket").agg(F.sum("n").alias("n"))
    of_lang = groups.join(wide, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rate") == F.col("r")))
    of_all = groups.join(F.broadcast(every), F.col("rate") == F.col("r"))  # at most one row per bucket and rate
    parts = {"own": own, "wide": of_lang, "every": of_all}

    def counted(name: str, part: DataFrame) -> DataFrame:
        return part.select(*group, "bucket", *[(F.col("n") if k == name else F.lit(0).cast("long")).alias(k) for k in parts])

    frames = [counted(k, p) for k, p in parts.items()]
    united = frames[0].unionByName(frames[1]).unionByName(frames[2])
    buckets = united.groupBy(*group, "bucket").agg(*[F.sum(k).alias(k) for k in parts])
    whole = Window.partitionBy(*group)
    totals = {k: F.sum(k).over(whole).cast("double") for k in parts}
    summed = buckets.withColumns({f"all_{k}": t for k, t in totals.items()})
    share = lambda k: F.col(f"all_{k}") / (F.col(f"all_{k}") + F.lit(float(prior_rows)))
    of = lambda k: F.col(k) / F.col(f"all_{k}")
    wider = share("wide") * of("wide") + (F.lit(1.0) - share("wide")) * of("every")
    return summed.select(*group, "bucket", (share("own") * of("own") + (F.lit(1.0) - share("own")) * wider).alias("weight"))


def quantile_bounds(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: median and lower quantile of the values, from the weights of its buckets."""
    upto = F.sum("weight").over(Window.partitionBy(*keys).orderBy("bucket"))
    ranked = weighted.select(*keys, "bucket", upto.alias("upto"))
    ranked = ranked.withColumn("whole", F.max("upto").over(Window.partitionBy(*keys)))
    at = lambda q: F.min(F.when(F.col("upto") >= F.lit(q) * F.col("whole"), F.col("bucket")))
    return ranked.groupBy(*keys).agg(at(0.5).alias("mid"), at(LOWER).alias("low"))


def thresholds(sketches: DataFrame, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """One row per language and source: for each of TAILS the median and the distance from it to the lower quantile,
    and the median number of words."""
    bounds = quantile_bounds(mixed_sketches(sketches, prior_rows), ["lang", "source", "rate"])
    pick = lambda k, value: F.max(F.when(F.col("rate") == k, value)).cast("double")
    picks = [pick(k, F.col("mid")).alias(f"mid_{k}") for k in [*TAILS, "n_words"]]
    picks += [pick(k, F.col("mid") - F.col("low")).alias(f"span_{k}") for k in TAILS]
    return bounds.groupBy("lang", "source").agg(*picks)


def base_failed(counts: str):
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def strays(counts: str, rate: str, value, limit: dict):
    """Whether a rate lies too far from the median of its group; never if the lower half of the mixture does not vary."""
    mid, span, typical = limit[f"mid_{rate}"], limit[f"span_{rate}"], limit["mid_n_words"]
    away = F.abs(value - mid) if TAILS[rate] else F.greatest(value - mid, F.lit(0.0))
    room = F.lit(float(SPREAD)) * span
    words = F.least(F.col(f"{counts}.n_words").cast("double"), typical)
    return (span > 0) & (away * away * words > room * room * typical)


def judged(counted: DataFrame, limits: DataFrame, counts: str, into: str, lang: str = "lang", source: str = "source"):
    """Joins the thresholds of a row's language and source and adds its verdict, true if it stays."""
    names = dict(zip(limits.columns, spare_names([*counted.columns, into], *limits.columns), strict=True))
    known = limits.select([F.col(c).alias(n) for c, n in names.items()])
    match = counted[lang].eqNullSafe(known[names["lang"]]) & counted[source].eqNullSafe(known[names["source"]])
    limit = {c: F.col(n) for c, n in names.items()}
    bad = base_failed(counts)
    for rate, value in tails(counts).items():
        bad = bad | F.coalesce(strays(counts, rate, value, limit), F.lit(False))
    return counted.join(known, match, "left").withColumn(into, ~bad).drop(*names.values())


def limits_of(counted: DataFrame, counts: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """The thresholds of all documents, stored: one row per language and source. The sketches are stored, too, as they
    are read for each group that they are mixed for."""
    sketches = stored(sketch(counted, lang, source, sketched(counts)), "sketches")
    return stored(thresholds(sketches), "limits")


def assess(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", doc_id: str = "doc_id"):
    """Per row: id, counts, base_failed, kept, language and source. Null or empty texts have no words and fail; null
    languages and sources form groups of their own; repeated rows are judged each; an empty table gives an empty one.
    The counts are stored once, without the texts.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    counted = stored(with_counts(slim, "counts").drop("text"), "counts")
    limits = limits_of(counted, "counts")
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    verdict = judged(counted, limits, "counts", "kept")
    own = [f"counts.{c}" for c in COUNTS]
    return verdict.select("doc_id", *own, base_failed("counts").alias("base_failed"), "kept", "lang", "source")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that pass, with their columns as they came, whatever their names. The texts are read twice and never
    shuffled. Rows with a null or empty text fail; null languages and sources form groups of their own; repeated rows
    are judged each, null ids are no matter, and an empty table gives an empty one."""
    counts, kept = spare_names(docs.columns, "counts", "kept")
    slim = docs.select(text, lang, source)
    limits = limits_of(with_counts(slim, counts, text), counts, lang, source)
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    counted = with_counts(docs, counts, text)
    return judged(counted, limits, counts, kept, lang, source).filter(kept).select(docs.columns)
