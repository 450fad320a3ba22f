"""Phrase collocations per language, counted on a prefix-free parse.

Every text is cut where two neighbouring words hash to a multiple of ``EVERY``
(a trigger).  A chunk reaches from one trigger to the end of the next one, so
neighbouring chunks overlap by the trigger's two words, and equal passages give
equal chunks wherever they stand.  The distinct chunks with their frequencies
are the dictionary; n-grams are counted inside distinct chunks, weighted by the
frequency, and an n-gram belongs to the chunk in which it starts outside the
closing trigger, so overlaps count once.  With chunks that overlap by two words,
phrases have up to three words.

Phrases go to the task that sums them as sorted, compressed blocks.  What is
kept afterwards are the phrases that occur ``least`` times: every part of a
candidate occurs at least as often as the candidate.

Defined results: a null text is empty, a null ``lang`` is ``und``; equal rows
count each; an empty table gives no rows; other columns are not read.  A text is
worked through in slices, except where it holds no trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from needbridge.llm.common import materialize
from needbridge.llm.textkeys import mix, windows, word_hashes

#: Words of the longest phrase; overlap of chunks; mean number of words between triggers.
MAX_WORDS, OVERLAP, EVERY = 3, 2, 16
#: Least frequency of a candidate, rows per language, share (percent) at which a longer phrase takes over.
LEAST, TOP, SUBSUMED = 10, 2000, 50
#: Bytes of text per task of the dictionary and of the sums; bytes of a slice of a long text.
TASK_BYTES, SUM_BYTES, SLICE = 16 << 20, 4 << 20, 1 << 20
#: Chunk bytes that a task combines before it sends them; words whose n-grams it counts at once.
COMBINE, FLUSH = 8 << 20, 800_000
MAX_TASKS = 50_000
BREAK = b"\n"
# A-Z to a-z, separators of pieces to a line feed, tab to space.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def _token_slices(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text and breaks between pieces, in slices that end between words."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = len(text) if at + SLICE >= len(text) else text.find(b" ", at + SLICE)
        if end < 0:
            end = len(text)
        yield [w for w in text[at:end].replace(BREAK, b" \n ").split(b" ") if w]
        at = end


def chunks_of(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """(chunk, whether it is the text's last one) of the prefix-free parse."""
    open_words: list[bytes] = []
    for words in _token_slices(text):
        new = max(len(open_words) - 1, 0)
        open_words += words
        triggers = np.flatnonzero(windows(word_hashes(open_words[new:]), 2) % np.uint64(EVERY) == 0) + new
        start = 0
        for at in triggers.tolist():
            if at:
                yield b" ".join(open_words[start:at + OVERLAP]), False
                start = at
        open_words = open_words[start:]
    if open_words:
        yield b" ".join(open_words), True


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, int] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
            pa.array([k[2] for k in keys], pa.bool_()), pa.array(list(counts.values()), pa.int64())],
            names=["lang", "chunk", "ends", "freq"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for chunk, ends in chunks_of(text.as_py()):
                key = lang, chunk, ends
                known = counts.get(key)
                if known is None:
                    counts[key] = 1
                    size += len(chunk) + 100
                else:
                    counts[key] = known + 1
            if size > COMBINE:
                yield flush()
                counts.clear()
                size = 0
    if counts:
        yield flush()


class _Numbers(dict):
    """Numbers given to words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _weigh(code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct code, ascending: a place where it stands, its summed weight; and each place's rank."""
    order = np.argsort(code, kind="stable")
    new = np.ones(len(code), bool)
    new[1:] = code[order][1:] != code[order][:-1]
    rank = np.empty(len(code), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order[new], np.add.reduceat(weight[order], np.flatnonzero(new)), rank


def _count_block(rows: list[tuple[bytes, bool, int]], buckets: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(bucket, words, phrases, weights) of the n-grams that the chunks of one language hold."""
    numbers = _Numbers({BREAK: 0})
    token: list[int] = []
    lengths, weights, starts = [], [], []
    for chunk, ends, freq in rows:
        words = chunk.split(b" ")
        token += map(numbers.__getitem__, words)
        lengths.append(len(words))
        starts.append(len(words) if ends else len(words) - OVERLAP)
        weights.append(freq)
    words = list(numbers)
    tok, length = np.array(token, np.int64), np.array(lengths)
    row = np.repeat(np.arange(len(rows)), length)
    inside = np.arange(len(tok)) - np.repeat(np.cumsum(length) - length, length)
    left = length[row] - inside
    at = np.flatnonzero((inside < np.array(starts)[row]) & (tok != 0))
    weight = np.array(weights, np.int64)[row]
    compress = zstandard.ZstdCompressor(level=1).compress
    yield 0, 0, compress(b""), compress(np.array([weight[at].sum()], np.int64).tobytes())
    hashes = word_hashes(words)
    size = len(words)
    code, key = tok[at], hashes[tok[at]]
    for n in range(1, MAX_WORDS + 1):
        if n > 1:
            # phrases go on where the chunk does and no break follows
            on = left[at] >= n
            on[on] = tok[at[on] + n - 1] != 0
            at, rank, key = at[on], rank[on], key[on]
            code = rank * size + tok[at + n - 1]
            key = mix(key + hashes[tok[at + n - 1]] * np.uint64(2 * n + 1))
        if not len(at):
            return
        place, total, rank = _weigh(code, weight[at])
        bucket = (mix(key[place]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place, total, bucket = at[place[order]], total[order], bucket[order]
        parts = [map(words.__getitem__, tok[place + j].tolist()) for j in range(n)]
        phrases = list(parts[0]) if n == 1 else [b" ".join(p) for p in zip(*parts)]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(bucket)]):
            yield int(bucket[lo]), n, compress(BREAK.join(phrases[lo:hi])), compress(total[lo:hi].tobytes())


_BLOCK = "bucket int, lang string, words int, phrases binary, weights binary"


def _count(buckets: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        held: dict[str, int] = {}
        words = 0

        def blocks(lang: str) -> pa.RecordBatch:
            got = list(_count_block(waiting.pop(lang), buckets))
            return pa.RecordBatch.from_arrays([
                pa.array([b for b, _, _, _ in got], pa.int32()), pa.array([lang] * len(got), pa.string()),
                pa.array([n for _, n, _, _ in got], pa.int32()), pa.array([p for _, _, p, _ in got], pa.binary()),
                pa.array([w for _, _, _, w in got], pa.binary())], names=["bucket", "lang", "words", "phrases", "weights"])

        for batch in batches:
            for lang, chunk, ends, freq in zip(*(batch.column(c).to_pylist() for c in ("lang", "chunk", "ends", "freq"))):
                waiting.setdefault(lang, []).append((chunk, ends, freq))
                size = chunk.count(b" ") + 1
                held[lang] = held.get(lang, 0) + size
                words += size
                if words >= FLUSH:
                    most = max(held, key=held.get)
                    words -= held.pop(most)
                    yield blocks(most)
        for lang in list(waiting):
            yield blocks(lang)

    return count


def _sum(least: int) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come by bucket, language and number of words; one such group's phrases are held at a time."""
        expand = zstandard.ZstdDecompressor().decompress
        group, total = None, {}

        def frequent() -> pa.RecordBatch:
            _, lang, n = group
            kept = [(p, f) for p, f in total.items() if f >= least or n == 0]
            return pa.RecordBatch.from_arrays([
                pa.array([lang] * len(kept), pa.string()), pa.array([n] * len(kept), pa.int32()),
                pa.array([p for p, _ in kept], pa.binary()), pa.array([f for _, f in kept], pa.int64())],
                names=["lang", "words", "phrase", "f"])

        for batch in batches:
            for b, lang, n, phrases, weights in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (b, lang, n) != group:
                    if total:
                        yield frequent()
                    group, total = (b, lang, n), {}
                values = np.frombuffer(expand(weights), np.int64).tolist()
                for phrase, value in zip(expand(phrases).split(BREAK), values):
                    total[phrase] = total.get(phrase, 0) + value
        if total:
            yield frequent()

    return sums


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, words, phrase, f): phrases of up to three words that occur ``least`` times.

    The phrase of no words occurs as often as there are words in the language.
    ``phrase`` is binary.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks, buckets = (int(min(MAX_TASKS, max(1, -(-size // b)))) for b in (TASK_BYTES, SUM_BYTES))
    dictionary = texts.mapInArrow(_parse, "lang string, chunk binary, ends boolean, freq long").repartition(
        tasks, "lang", "chunk", "ends").groupBy("lang", "chunk", "ends").agg(F.sum("freq").alias("freq"))
    blocks = dictionary.mapInArrow(_count(buckets), _BLOCK)
    return blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang", "words").mapInArrow(
        _sum(least), "lang string, words int, phrase binary, f long")


def _quotient(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact integers."""
    def wide(x):
        return x.cast("decimal(15,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED) -> DataFrame:
    """Each language's first ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of two or three words with ``a >= least``.  A cut
    into a first and a last part scores floor(10^6 a a / (l r)); the lowest
    cut counts, the earliest among equals.  A candidate inside a longer one
    that has at least ``subsumed`` percent of its occurrences goes.
    """
    counts = materialize(phrase_counts(docs, least), "phrases")
    sizes = counts.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = counts.where("words > 0").withColumn("phrase", F.col("phrase").cast("string"))
    longer = counts.where("words > 1")

    def part(first, count) -> Column:
        """``count`` words from the ``first`` one on (from 0)."""
        return F.array_join(F.slice(F.split("phrase", " "), first + 1, count), " ")

    cuts = longer.select("lang", "phrase", "words", F.col("f").alias("a"),
                         F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", part(F.lit(0), F.col("k"))).withColumn(
        "rest", part(F.col("k"), F.col("words") - F.col("k")))
    lefts = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"]).withColumn(
        "score", _quotient(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = longer.where("words > 2").select("lang", "f", F.explode(F.array(
        part(F.lit(0), F.lit(MAX_WORDS - 1)), part(F.lit(1), F.lit(MAX_WORDS - 1)))).alias("phrase"))
    above = inner.groupBy("lang", "phrase").agg(F.max("f").alias("above"))
    left = best.join(above, ["lang", "phrase"], "left").where(
        F.col("above").isNull() | (100 * F.col("above") < subsumed * F.col("a"))).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # at most `top` rows of each of 64 parts of a language meet in its last window
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part_of = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = left.withColumn("part", part_of).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
