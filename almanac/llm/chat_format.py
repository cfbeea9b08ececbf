"""Conversations as training text under a small grammar, checked by reading them back, in DataFrame operations only.

    conversation := turn*
    turn         := "<s>[INST]" role "[/INST]" text "</s>"

Content conflicts with the template if it holds a control string, plain or already escaped, whether or not it would
be misread where it stands: training text must hold no control strings but the marks. In such a conversation one
backslash is added before the last bracket inside every control string of its roles and texts. Reading removes one.
Both steps are exact inverses on all texts, so one round of escaping always suffices. Then every rendered text is
parsed again and compared with the source; a conversation that did not come back identical would fail the job.

No control string has an opening bracket but at its start, so none can begin in a text and end in a mark, and the
parser never has a choice: a turn ends at the first "</s>", a role at the first "[/INST]".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import text_of

# The control strings, and the role that is trained on.
OPEN, CLOSE = "<s>[INST]", "</s>"
ROLE_END = "[/INST]"
TRAINED = "assistant"

_CONTROL = r"(</?s|\[/?INST)(\\*)([>\]])"
_ESCAPED = r"(</?s|\[/?INST)(\\*)\\([>\]])"


def escaped(text):
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescaped(text):
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def rendered(turns):
    """One string for an array of (role, text)."""
    whole = F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(ROLE_END), t["text"], F.lit(CLOSE)))
    return F.array_join(whole, "")


def _pieces(text):
    """The turns of a rendered text, each without its closing mark."""
    parts = F.split(text, CLOSE, -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def parsed(text):
    """The grammar's deterministic parser: (role, text) of each turn, unescaped, and the place of its raw text.

    ``start`` and ``length`` are code points of the raw text inside the whole.
    """
    width = len(OPEN)

    def turn(piece):
        head = F.substring_index(piece, ROLE_END, 1)
        raw = F.substring(piece, F.length(head) + 1 + len(ROLE_END), F.length(piece))
        role = F.substring(head, width + 1, F.length(head))
        return F.struct(role.alias("role"), raw.alias("raw"), F.length(piece).alias("size"))

    return F.transform(_pieces(text), turn)


def as_read(turns):
    """Parsed turns as (role, text)."""
    return F.transform(turns, lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(t["raw"]).alias("text")))


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per conversation: conv_id, formatted, turns (array of role and text, read back), loss_spans (start and end of
    the raw text of each trained turn inside formatted, in code points) and was_escaped.

    Turns are ordered by number; equal numbers by role and text, missing numbers first. Null roles and texts are
    empty. Rows without a conv_id form one conversation. Repeated rows are turns each.
    """
    slim = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("n"), text_of(role).alias("role"), text_of(text).alias("text")).alias("t"),
    )
    gathered = slim.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ordered"))
    source = gathered.select(
        "conv_id", F.transform("ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source")
    )
    conflicts = lambda t: t["role"].rlike(_CONTROL) | t["text"].rlike(_CONTROL)
    tried = source.withColumn("was_escaped", F.exists("source", conflicts))
    safe = F.transform(
        "source", lambda t: F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"))
    )
    chosen = tried.withColumn("formatted", F.when(F.col("was_escaped"), rendered(safe)).otherwise(rendered("source")))
    read = chosen.withColumn("raw", parsed("formatted")).withColumn("turns", as_read("raw"))
    same = F.assert_true(F.col("turns").eqNullSafe(F.col("source")), F.lit("a conversation does not read back"))
    checked = read.withColumn("turns", F.when(same.isNull(), F.col("turns")))
    return checked.select("conv_id", "formatted", "turns", loss_spans("raw").alias("loss_spans"), "was_escaped")


def loss_spans(raw):
    """(start, end) of the raw texts of trained turns."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        end = acc["at"] + t["size"]
        span = F.struct((end - F.length(t["raw"])).alias("start"), end.alias("end"))
        spans = F.when(t["role"] == TRAINED, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((end + len(CLOSE)).alias("at"), spans.alias("spans"))

    return F.aggregate(raw, first, step, lambda acc: acc["spans"])


def digest(formatted: DataFrame) -> DataFrame:
    """The result columns of the registered query, all read back from the formatted text."""
    listed = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = F.transform(
        "loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    )
    loss = formatted.withColumn("loss", F.array_join(under, ""))
    return loss.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
