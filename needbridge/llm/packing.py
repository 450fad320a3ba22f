"""Best-two-fit packing of tokenized documents into fixed-size sequences.

Tokenizing runs in Arrow batches and keeps only (document, piece, length,
checksum).  Packing needs no more than how many pieces there are of each
length: at most ``capacity`` numbers, whatever the corpus size.  The plan made
from that histogram lists bin patterns ("m bins that hold these lengths"); a
piece takes the slot given by its rank among pieces of its length, so placing
all pieces is one windowed rank and one join with the bounded slot table.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from needbridge.llm.common import materialize

CAPACITY = 4096
END_ID = 1
#: Chunks of text whose ids a worker keeps; the table is emptied beyond it (only a cache).
CACHED_CHUNKS = 700_000
#: Pieces that one rank window holds, about.
PIECES_PER_WINDOW = 50_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Marks of special tokens and letters whose lower case hangs on their context.
_ODD = ("<|", "\u03a3", "\u0130")


class _ChunkIds(dict):
    """Ids of chunks as bytes; a missing chunk is encoded and kept."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        self.ids_of = ids_of

    def __missing__(self, chunk: str) -> bytes:
        got = self.ids_of(chunk) if chunk else b""
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        self[chunk] = got
        return got


class ChunkEncoder:
    """Token ids of whole texts, with the ids of space-separated chunks cached.

    The vocabulary's pre-tokenizer never joins text across a space or line
    feed, so the ids of a text are those of its chunks in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cache = _ChunkIds(self._ids)
        self.word = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=-@\\[-`{-~]*)").fullmatch
        letters = [chr(c) for c in range(0xdf, 0x100) if c != 0xf7]
        self.spelled = str.maketrans({c: self.tok.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})

    def _ids(self, chunk: str) -> bytes:
        word = self.word(chunk)
        if word:  # small Latin letters, nothing to normalise; marks after them are split off (an apostrophe may not be)
            letters, marks = word.groups()
            if marks:
                return self.cache[letters] + self.cache[marks]
            ids = [t.id for t in self.tok.model.tokenize(letters if letters.isascii() else letters.translate(self.spelled))]
        elif chunk[-1:] in (".", ",") and unicodedata.normalize("NFC", chunk[:-1].lower()).isalpha():
            # all letters after lowering too: a mark that lowering leaves joins the punctuation after it
            return self.cache[chunk[:-1]] + self.cache[chunk[-1]]
        elif chunk.isalpha() and chunk.islower() and unicodedata.is_normalized("NFC", chunk):
            ids = [t.id for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(chunk)
                   for t in self.tok.model.tokenize(piece)]
        else:
            ids = self.tok.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not any(odd in text for odd in _ODD) and unicodedata.is_normalized("NFC", text):
            text = text.lower()  # the normaliser lowers too; more chunks are then equal
        return b"".join(map(self.cache.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32).

    A document is its ids and then ``end_id``; only one longer than
    ``capacity`` is cut.  Null and empty texts are the end id alone.
    """
    end = np.asarray([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = enc.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE_SCHEMA)


def _tightest_pair(free: np.ndarray, room: int) -> tuple[int, int]:
    """Two free lengths whose sum comes closest to ``room`` from below; (0, 0) if there are none."""
    sizes = np.arange(len(free))
    at_most = np.maximum.accumulate(np.where(free > 0, sizes, 0))  # longest free length <= x
    first = np.flatnonzero(free[:room] > 0)
    if not len(first):
        return 0, 0
    second = at_most[np.minimum(room - first, len(free) - 1)]
    single = (second == first) & (free[first] < 2)
    second[single] = at_most[first[single] - 1]
    total = np.where(second > 0, first + second, 0)
    k = int(total.argmax())
    return (int(first[k]), int(second[k])) if total[k] else (0, 0)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-two-fit over a histogram of lengths: [(bins, [(length, copies), ..]), ..].

    A bin is filled greedily with the longest pieces that fit; then its
    shortest piece is replaced by the two unpacked pieces that fill the gap it
    leaves most tightly, if they fill it better.  The same bin is made as often
    as the remaining counts allow, so each step uses up at least one length.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    bins: list[tuple[int, list[tuple[int, int]]]] = []
    while left.any():
        used: dict[int, int] = {}
        free, gap = left.copy(), capacity
        while gap and len(fit := np.flatnonzero(free[:gap + 1])):
            length = int(fit[-1])
            copies = int(min(free[length], gap // length))
            used[length] = used.get(length, 0) + copies
            free[length] -= copies
            gap -= copies * length
        if gap and sum(used.values()) > 1:
            shortest = min(used)
            pair = _tightest_pair(free, gap + shortest)
            if sum(pair) > shortest:
                used[shortest] -= 1
                for length in pair:
                    used[length] = used.get(length, 0) + 1
                used = {length: copies for length, copies in used.items() if copies}
        n = min(int(left[length]) // copies for length, copies in used.items())
        for length, copies in used.items():
            left[length] -= n * copies
        bins.append((n, sorted(used.items(), reverse=True)))
    return bins


def slot_rows(bins: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank_from, rank_to, copies, first_sequence, offset) for each item of each pattern."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for n, items in bins:
        offset = 0
        for length, copies in items:
            at = rank.get(length, 0)
            rows.append((length, at, at + n * copies, copies, sequence, offset))
            rank[length] = at + n * copies
            offset += length * copies
        sequence += n
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (gapless from 0 in each sequence).  Empty table: no
    rows.  Repeated rows are packed each.  The slot table is broadcast; it has
    at most a few rows per length, so its size does not grow with the corpus.
    """
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        slot_rows(plan_bins(counts, capacity)),
        "s_length long, rank_from long, rank_to long, copies long, first_sequence long, first_offset long")
    buckets = max(8, sum(counts.values()) // PIECES_PER_WINDOW)
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        F.col("length").alias("b_length"), F.col("bucket").alias("b_bucket"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = (keyed.withColumn("row", F.row_number().over(within) - 1)
              .join(before, (F.col("length") == F.col("b_length")) & (F.col("bucket") == F.col("b_bucket")))
              .withColumn("rank", F.col("before") + F.col("row")))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("s_length"))
                         & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    k = F.col("rank") - F.col("rank_from")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(k / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(k, F.col("copies")) * F.col("length")).cast("long").alias("offset"))
