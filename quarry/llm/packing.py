"""Best-fit packing of tokenised documents into fixed sequences (operator 8), sum of squares.

Documents become token ids of a public tokenizer and one end id; only longer ones are cut, into
whole sequences and a rest. Rests are packed by the sum-of-squares rule: N(g) is the number
of open sequences with gap g; a piece goes where the sum over all gaps below the capacity of
N(g)^2 becomes smallest, a new sequence being one of the choices. Large pieces come first.
Pieces are dealt by hash over bounded bins of work; sequences that a bin leaves far from full
are dealt again, all together, until one bin of work holds them or no further two of them are
put together, so waste does not grow with the number of bins.

Defined results: a null or empty text is the end id alone; rows that repeat an id are packed
each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_blocks, text_of
from quarry.scale import materialize

CAPACITY = 4096
END_ID = 1
PACK_ROWS = 20_000
OPEN_BELOW = 0.98
CACHE_WORDS = 500_000
_COLUMNS = ("doc_id", "uid", "piece", "start", "length", "ids_crc32")
_ARROW = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
_PIECES = "doc_id long, uid long, piece int, start long, length long, ids_crc32 long"
# Texts of such characters are in composed form, lower character by character and have no
# white space on which Python and the tokenizer differ.
_PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
# What stands by itself even without white space around it: endings, marks, single digits.
_APART = re.compile("('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u024f]+)")
_WORD_END = "</w>"  # fixed value: how the tokenizer marks tokens at the end of a word
_LONG_WORD = 64
_TOGETHER = 512


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer(dict):
    """Token ids of whole texts, looked up chunk by chunk between white space once a chunk is known.

    The tokenizer drops white space and never joins tokens across words, so a text's ids are
    those of its chunks in order. Ids are kept as little-endian bytes. The new chunks of a run of
    texts are read together, without the normalizer, which changes nothing in them; the tokens that
    end a word tell where a chunk's ids end. Texts with characters outside the plain ones, or with
    marks of special tokens, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer, self._chunks = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self._chunks.normalizer = None
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._new: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        return self._new[chunk]

    def _encode(self, tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, chunks: list[str]) -> None:
        """``chunks``: lower case, no white space, not known yet."""
        self._new = {}
        for at in range(0, len(chunks), _TOGETHER):
            some = chunks[at : at + _TOGETHER]
            ids = self._encode(self._chunks, " ".join(some))
            parts = np.array([1 if chunk.isalpha() else len(_APART.sub(r" \1 ", chunk).split()) for chunk in some])
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == parts.sum():
                cuts = np.concatenate([[0], ends[np.cumsum(parts) - 1]]) * ids.itemsize
                raw = ids.tobytes()
                found = [raw[lo:hi] for lo, hi in zip(cuts.tolist(), cuts[1:].tolist())]
            else:
                found = [self._encode(self._chunks, chunk).tobytes() for chunk in some]
            self._new.update(zip(some, found))
        room = CACHE_WORDS - len(self)
        short = (item for item in self._new.items() if len(item[0]) <= _LONG_WORD)
        self.update(itertools.islice(short, max(room, 0)))

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        chunked = [text.lower().split() if _PLAIN.fullmatch(text) and "<|" not in text else None for text in texts]
        self._learn(list({chunk for chunks in chunked for chunk in chunks or () if chunk not in self}))
        for text, chunks in zip(texts, chunked):
            if chunks is None:
                yield self._encode(self._tokenizer, text)
            else:
                yield np.frombuffer(b"".join(map(self.__getitem__, chunks)), "<u4")


_CODERS: dict[str, WordTokenizer] = {}


def coder(path: str) -> WordTokenizer:
    """One per Python worker, so that later tasks find the known words."""
    if path not in _CODERS:
        _CODERS[path] = WordTokenizer(path)
    return _CODERS[path]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The pieces of every document with their checksums."""
    path = tokenizer or default_tokenizer()

    def cut(batches):
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "uid", "text")]
            for lo, hi, _, _ in text_blocks(batch.column(2)):
                rows = []
                doc_ids, uids, texts = (c[lo:hi] for c in columns)
                for doc_id, uid, ids in zip(doc_ids, uids, coder(path).ids(texts)):
                    ids = np.append(ids, np.array([end_id], "<u4"))
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append((doc_id, uid, piece, start, len(part), zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], list(_COLUMNS))

    read = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), text_of(text_column).alias("text"))
    return read.mapInArrow(cut, _PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Sequences as lists of positions in ``lengths``, filled by the sum-of-squares rule.

    Taking a piece of length s from gap g to g - s changes the sum by
    2 (N(g - s) - N(g)) + 2, with the empty and the full sequence counting nothing.
    """
    counts = np.zeros(capacity + 1, np.int64)  # by gap; the gaps 0 and capacity stay 0
    open_at: dict[int, list[int]] = {}
    sequences: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        gaps = np.flatnonzero(counts[s:]) + s
        after = 2 * counts[capacity - s] + 1 if s < capacity else 0
        best, gap = after, capacity
        if len(gaps):
            into = counts[gaps - s]
            change = 2 * (into - counts[gaps]) + 2
            change[gaps == s] = 1 - 2 * counts[s]
            at = int(change.argmin())
            # Small pieces come last and only fill gaps, else they would be left in sequences of their own.
            if change[at] <= best or s * 8 <= capacity:
                gap = int(gaps[at])
        if gap == capacity:
            sequence = len(sequences)
            sequences.append([])
        else:
            sequence = open_at[gap].pop()
            counts[gap] -= 1
        sequences[sequence].append(i)
        rest = gap - s
        if rest:
            open_at.setdefault(rest, []).append(sequence)
            counts[rest] += 1
    return sequences


def _pack_bin(capacity: int, open_below: float, final: bool):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "draw", "unit"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        lengths = part["length"].to_numpy(np.int64)
        sequence, offset, done = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), np.zeros(len(part), bool)
        fill = np.zeros(len(part), np.int64)
        for members in sum_of_squares(lengths, capacity):
            at, first = 0, part["unit"].iloc[members[0]]
            for i in members:
                sequence[i], offset[i] = first, at
                at += lengths[i]
            fill[members] = at
            done[members] = final or at >= open_below * capacity
        return pd.DataFrame({"unit": part["unit"], "sequence": sequence, "offset": offset, "fill": fill, "done": done})

    return run


_PLACED = "unit long, sequence long, offset long, fill long, done boolean"


def pack(lengths: DataFrame, capacity: int = CAPACITY, rows: int = PACK_ROWS, open_below: float = OPEN_BELOW) -> DataFrame:
    """unit, sequence_id and offset for every (unit, length, draw), lengths from 1 to ``capacity``.

    Every round packs bins of work of about ``rows`` units. What a round leaves in sequences
    that are nearly full is final, and so is one too full for even the shortest open one; the
    pieces of any other travel on as one unit, dealt anew. A round after which no fewer units
    travel on is the last one.
    """
    placed, turn = None, 0
    units, n = lengths, lengths.count()
    while True:
        turn += 1
        work = max(1, -(-n // rows))
        final = work == 1
        binned = units.withColumn("work", F.pmod("draw", F.lit(work)))
        packed = materialize(binned.groupBy("work").applyInPandas(_pack_bin(capacity, open_below, final), _PLACED), "packed")
        # A unit of this round holds the pieces that an earlier round put into its sequence.
        if placed is None:
            placed = packed.select("unit", F.col("sequence").alias("sequence_id"), "offset")
        else:
            moved = packed.select(F.col("unit").alias("sequence_id"), "sequence", F.col("offset").alias("shift"))
            placed = placed.join(moved, "sequence_id", "left").select(
                "unit", F.coalesce("sequence", "sequence_id").alias("sequence_id"),
                (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            )
        if final:
            return placed
        units = packed.filter("not done").groupBy(F.col("sequence").alias("unit")).agg(F.first("fill").alias("length"))
        units = materialize(units.withColumn("draw", F.xxhash64("unit", F.lit(turn))), "open")
        shortest = units.agg(F.min("length")).first()[0] or 0
        units = units.filter(F.col("length") <= capacity - shortest)
        before, n = n, units.count()
        if not 0 < n < before:
            return placed


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut = materialize(pieces(docs, tokenizer, capacity, end_id, **options), "pieces")
    cut = cut.withColumn("unit", F.monotonically_increasing_id())
    cut = materialize(cut, "units")
    draw = F.xxhash64("doc_id", "piece", "ids_crc32", "unit")
    full = F.col("length") == capacity
    placed = pack(cut.filter(~full).select("unit", "length", draw.alias("draw")), capacity)
    alone = cut.filter(full).withColumn("sequence_id", F.col("unit")).withColumn("offset", F.lit(0).cast("long"))
    together = cut.filter(~full).join(placed, "unit")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return alone.select(columns).unionByName(together.select(columns))
