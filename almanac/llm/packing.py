"""Documents packed into training sequences by bounded-space online best-fit.

A document becomes its token ids and an end mark. Ids beyond the capacity are cut into full pieces, each a sequence
of its own; what remains is packed. A packing task streams its pieces, window by
window, past a fixed number of open sequences, indexed by a bitset whose bit f says that one with f free places is
open: best-fit is the lowest bit at or above the need. When all places for open sequences are taken, the fullest one
closes first.

Pieces are numbered and stored before they are packed: a lost executor's task sees the same pieces in the same
order. How many tasks pack follows from the number of pieces, so that each leaves few sequences unfilled.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from almanac.llm.common import bound_batches, stored, text_of

CAPACITY = 2048
END_ID = 0
#: Sequences that a packing task keeps open.
OPEN = 8192
#: Pieces that a packing task looks at together, longest first; fewer than OPEN, so that the long ones stay open for
#: the short ones. On 360,000 pieces of 4,096-piece windows 0.01 % more sequences than the tokens need at least were
#: made, against 0.7 % in order of arrival, which a window of 1 gives.
WINDOW = 4096
#: Pieces that a packing task gets, about.
TASK_PIECES = 400_000
#: Words whose ids a tokenizing worker remembers, about 200 bytes each; half of them are older ones, which are forgotten
#: if they do not come again before the other half is full.
KNOWN_WORDS = 1_000_000
#: New words that are encoded at once.
LEARNT = 512
#: Characters of texts whose new words are looked for together, about.
GROUP_CHARS = 1 << 18
TOKENIZER = "word_bpe_49k.json"

_encoders: dict[str, WordEncoder] = {}


#: Pre-tokenizers by this pattern keep letters and signs apart; after lower-casing, so are the ids of words of both.
_LETTERS_APART = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SIGNS = string.punctuation.encode()
#: Letters beyond ASCII, up to Cyrillic, that NFC leaves as they are and that become one such letter when lower-cased,
#: whatever stands beside them: a large sigma does not in Python.
_SMALL = {c for c in map(chr, range(0xC0, 0x530)) if c.isalpha() and c.lower() == c and is_normalized("NFC", c)}
_LETTERS = "".join(c for c in map(chr, range(0xC0, 0x530)) if c.lower() in _SMALL and is_normalized("NFC", c) and c != "Σ")
_WORD = re.compile(f"[a-zA-Z{_LETTERS}]+")


def _letters_apart(tokenizer: Tokenizer) -> bool:
    """Whether a word of letters (ASCII or _LETTERS) and then ASCII signs, which holds no contraction or special string,
    has the ids of its lower-case letters, then those of its signs, and each of both is one pre-token."""
    found = json.loads(tokenizer.to_str())
    steps = [found["normalizer"] or {}, found["pre_tokenizer"] or {}]
    normalizers, splits = (s.get("normalizers") or s.get("pretokenizers") or [s] for s in steps)
    first = splits[0]
    return (
        any(n.get("type") == "Lowercase" for n in normalizers)
        and all(n.get("type") in ("NFC", "Replace", "Lowercase") for n in normalizers)
        and all(n["pattern"] == {"Regex": "\\s+"} for n in normalizers if n.get("type") == "Replace")
        and first.get("type") == "Split" and first["pattern"] == {"Regex": _LETTERS_APART}
        and all(s.get("type") == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in splits[1:])
    )


class WordEncoder:
    """Ids of texts for a tokenizer that drops white space, as little-endian 32-bit numbers.

    No token of such a tokenizer spans a blank, so a text's ids are those of its words in turn, and each distinct
    word goes through the tokenizer once while it is remembered. New words are encoded many at a time, with blanks
    between them; the offsets tell whose ids are whose. Where the tokenizer keeps letters and signs apart and does not
    tell cases apart, words that differ in these alone share the ids of their letters, and lower-case letters or signs,
    one pre-token each, go straight to the tokenizer's model, as normalizing would leave them as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.folds = _letters_apart(self.tokenizer)
        #: Letters as the pre-tokenizer spells them for the model; it leaves ASCII as it is.
        self.spelt = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LETTERS} if self.folds else {}

    def _encode(self, words: list[bytes], single: bool) -> None:
        if single:  # a pre-token each
            spelt = [w.decode() if w.isascii() else w.decode().translate(self.spelt) for w in words]
            found = [[t.id for t in self.model.tokenize(w)] for w in spelt]
            ends = [4 * n for n in accumulate(map(len, found))]
            ids = list(chain.from_iterable(found))
        else:
            encoding = self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False)
            starts = np.cumsum([0, *(len(w.decode()) + 1 for w in words[:-1])])
            owner = np.searchsorted(starts, [a for a, _ in encoding.offsets], "right") - 1
            ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
            ids = encoding.ids
        payload = np.array(ids, "<u4").tobytes()
        for word, a, b in zip(words, [0, *ends], ends):
            self.known[word] = payload[a:b]

    def _recall(self, words: Iterable[bytes]) -> list[bytes]:
        """Takes what is known of older words; the others."""
        new = []
        for word in words:
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.known[word] = ids
        return new

    def _learn(self, words: Iterable[bytes]) -> None:
        """words: distinct ones that are not known."""
        made, parts, single, other = [], {}, {}, []
        for word in self._recall(words):
            letters = word.rstrip(_SIGNS)
            if not self.folds or not letters:
                other.append(word)
                continue
            if letters.isalpha():  # of ASCII letters, as these are bytes
                low = letters.lower()
            elif _WORD.fullmatch(wide := letters.decode()):
                low = wide.lower().encode()
            else:
                other.append(word)
                continue
            if low == word:
                single[word] = None
            else:
                signs = word[len(letters) :]
                made.append((word, low, signs))
                parts[low] = parts[signs] = None
        single |= dict.fromkeys(self._recall(w for w in parts if w and w not in self.known))
        single = list(single)
        for i in range(0, len(single), LEARNT):
            self._encode(single[i : i + LEARNT], True)
        for i in range(0, len(other), LEARNT):
            self._encode(other[i : i + LEARNT], False)
        for word, low, signs in made:
            self.known[word] = self.known[low] + self.known[signs] if signs else self.known[low]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for group in _groups(texts, GROUP_CHARS):
            split = [text.encode().split() for text in group]  # at space and \x09-\x0D
            words = list(chain.from_iterable(split))
            ids = list(map(self.known.get, words))
            gaps = [i for i, found in enumerate(ids) if found is None]
            self._learn(dict.fromkeys(words[i] for i in gaps))
            for i in gaps:
                ids[i] = self.known[words[i]]
            rest = iter(ids)
            for own in split:
                yield b"".join(islice(rest, len(own)))
            if len(self.known) > KNOWN_WORDS // 2:
                self.known, self.older = {}, self.known


def _groups(texts: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in order, so many together as have about so many characters."""
    group, n = [], 0
    for text in texts:
        group.append(text)
        n += len(text)
        if n >= chars:
            yield group
            group, n = [], 0
    if group:
        yield group


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and with keep_ids the ids. A null text is empty and
    consists of the end mark alone; null and repeated ids are documents each."""
    bound_batches(docs.sparkSession)
    end = END_ID.to_bytes(4, "little")
    step = 4 * capacity
    path = public_tokenizers.path(tokenizer)
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            rows, numbers, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, payload in enumerate(encode(batch.column("text").to_pylist())):
                payload += end
                for n, at in enumerate(range(0, len(payload), step)):
                    part = payload[at : at + step]
                    rows.append(row)
                    numbers.append(n)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(memoryview(part).cast("i").tolist())
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int32())),
                "piece": pa.array(numbers, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return slim.mapInArrow(cut, schema + ", ids array<int>" * keep_ids)


class OpenSequences:
    """The open sequences of one packing task."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.at = [[] for _ in range(capacity + 1)]  # open sequences by free places
        self.free = 0  # bit f: one with f free places is open
        self.open = self.made = 0

    def _take(self, f: int) -> int:
        sequence = self.at[f].pop()
        if not self.at[f]:
            self.free ^= 1 << f
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece."""
        fits = self.free >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            sequence = self._take(f)
        else:
            f, sequence = self.capacity, self.made
            self.made += 1
        left = f - length
        fullest = (self.free & -self.free).bit_length() - 1
        if left and (self.open < self.limit or left > fullest):  # else it is itself the fullest, and closes
            if self.open == self.limit:
                self._take(fullest)
            self.at[left].append(sequence)
            self.free |= 1 << left
            self.open += 1
        return sequence, self.capacity - f


def pack(
    cut: DataFrame,
    capacity: int = CAPACITY,
    open_sequences: int = OPEN,
    window: int = WINDOW,
    task_pieces: int = TASK_PIECES,
) -> DataFrame:
    """Adds sequence_id and offset to pieces (column ``length``, 1 to capacity). Sequence ids are unique, not dense."""
    numbered = stored(cut.withColumn("__n", F.monotonically_increasing_id()), "pieces")
    tasks = max(1, -(-numbered.count() // task_pieces))
    dealt = numbered.repartition(tasks, F.xxhash64("__n")).sortWithinPartitions(F.xxhash64("__n"), "__n")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = OpenSequences(capacity, open_sequences)
        first = TaskContext.get().partitionId() << 40
        for table in _windows(batches, window):
            table = table.drop_columns(["__n"]).take(np.argsort(-table["length"].to_numpy(), kind="stable"))
            found = [room.place(n) for n in table["length"].to_pylist()]
            table = table.append_column("sequence_id", pa.array([first + s for s, _ in found], pa.int64()))
            yield from table.append_column("offset", pa.array([o for _, o in found], pa.int64())).to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def _windows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of the batches in order, so many at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            for at in range(0, n - rows + 1, rows):
                yield table.slice(at, rows)
            held = table.slice(n - n % rows).to_batches()
            n %= rows
    if n:
        yield pa.Table.from_batches(held)


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """All documents, cut and packed; options are those of ``pieces``."""
    return pack(pieces(docs, **options), options.get("capacity", CAPACITY))
