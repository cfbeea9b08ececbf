"""Token counts of whole texts, also of huge ones, by overlap resynchronisation.

A text up to CHUNK characters is encoded as it is. A longer one is encoded in chunks of CHUNK characters that overlap
by OVERLAP, with offsets, a few chunks at a time. Two neighbouring encodings are spliced inside their overlap, at the
last place where both begin a token and where a word ends before white space. Such a place is stable whatever
stands around it: the tokenizer's splitting pattern lets no piece go on from a character that is not white space to
one that is, and special strings hold no white space. So every encoding of the text begins a token there, and what
follows depends on the following text alone. Where the overlap holds no such place, it is widened until it does, and
then the chunk itself, at last to the rest of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from almanac.llm.common import bound_batches, text_of

TOKENIZER = "byte_bpe_50k.json"
CHUNK = 32_768
OVERLAP = 512
#: Characters that are encoded at once, which bounds the memory of encodings.
AT_ONCE = 262_144
LIMIT = 1024

#: White space as every engine sees it; where a stable place begins.
_BLANKS = " \t\n\r\x0b\x0c"

_tokenizers: dict[str, Tokenizer] = {}


def _tokenizer(path: str) -> Tokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _token_at(encoding, place: int) -> int | None:
    """The number of the token that begins at a character, if one does."""
    n = encoding.char_to_token(place)
    return n if n is not None and encoding.token_to_chars(n)[0] == place else None


def splice(text: str, left, left_at: int, left_end: int, right, right_at: int) -> tuple[int, int, int] | None:
    """The last stable place in the overlap [right_at, left_end), and the token that begins there in either one."""
    for place in range(left_end - 1, right_at, -1):
        if text[place] in _BLANKS and not text[place - 1].isspace():
            a, b = _token_at(left, place - left_at), _token_at(right, place - right_at)
            if a is not None and b is not None:
                return place, a, b
    return None


def count_huge(tokenizer: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length; no more than a few chunks are encoded at a time."""
    encode = lambda at, end: tokenizer.encode(text[at:end], add_special_tokens=False)
    total, at, end, skip = 0, 0, min(len(text), chunk), 0
    left = encode(at, end)
    while end < len(text):
        joint, wide = None, overlap
        while joint is None and end < len(text):
            after = end - min(wide, end - at)
            right_end = min(len(text), after + max(chunk, 2 * wide))
            right = encode(after, right_end)
            joint = splice(text, left, at, end, right, after)
            if joint is None and after == at:  # no stable place in the whole chunk: make it longer
                left, end, wide = right, right_end, overlap
            else:
                wide *= 2
        if joint is None:
            break
        _, a, b = joint
        total += a - skip
        left, at, end, skip = right, after, right_end, b
    return total + len(left) - skip


def counts_of(tokenizer: Tokenizer, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Token counts, in the order of the texts."""
    counts = [0] * len(texts)
    for rows in _portions(texts, chunk):
        if len(texts[rows[0]]) > chunk:
            counts[rows[0]] = count_huge(tokenizer, texts[rows[0]], chunk, overlap)
            continue
        for row, e in zip(rows, tokenizer.encode_batch_fast([texts[r] for r in rows], add_special_tokens=False)):
            counts[row] = len(e)
    return counts


def _portions(texts: list[str], chunk: int) -> Iterator[list[int]]:
    """Row numbers in portions of bounded length; huge texts alone."""
    rows, held = [], 0
    for row, text in enumerate(texts):
        if len(text) > chunk:
            yield [row]
            continue
        if rows and held + len(text) > AT_ONCE:
            yield rows
            rows, held = [], 0
        rows.append(row)
        held += len(text)
    if rows:
        yield rows


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str = TOKENIZER,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    limit: int = LIMIT,
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens and over_limit. A null text is empty and has no tokens; null and
    repeated ids get a row each."""
    bound_batches(docs.sparkSession)
    path = public_tokenizers.path(tokenizer)

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        return pd.Series(counts_of(_tokenizer(path), texts.tolist(), chunk, overlap), dtype="int64")

    whole = text_of(text)
    counted = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        tokens.asNondeterministic()(whole).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
