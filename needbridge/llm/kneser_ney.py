"""Quality classifier: interpolated modified Kneser-Ney character n-gram model.

The model of each language is trained on all trusted text.  Tasks count the
n-grams of their batches; the sums, the lower orders' continuation counts, the
discounts and the interpolated probabilities are Spark joins and aggregates
keyed by (language, n-gram).  Scoring asks for each n-gram once per chunk of
documents: the chunks' distinct n-grams, packed by shard, are joined with the
sharded model, and each chunk's answers meet its texts again in one co-group.  A document is
rejected when its perplexity is above its language's threshold: a high quantile
of the trusted documents' held-out perplexities.  For these, trusted documents
are dealt into folds by a hash of their id, and each fold is scored by a model
of the other folds, whose counts are all counts minus the fold's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from needbridge.llm import textkeys as tk
from needbridge.llm.common import materialize

ORDER = 4
#: Share of a language's trusted documents that lies below its threshold.
KEEP_QUANTILE = 0.995
#: Folds of the held-out perplexities; at most 9, one digit in a model's key.
FOLDS = 5
#: Characters of a chunk, about: what one scoring task holds.
CHUNK_CHARS = 24_000_000
#: Shards of a model's n-grams.
SHARDS = 64
#: Characters that a task turns into n-gram keys at once.
SLICE_CHARS = 1_000_000
#: Characters that a task scores at once, beside the answers of its chunk.
SCORE_CHARS = 250_000
#: Trusted ids are broadcast up to this many (8 bytes each); beyond it they are joined by shuffle.
BROADCAST_IDS = 4_000_000
#: Places of the uniform distribution that unknown characters share.
ALPHABET = 10_000
PAD = "\x02"
_PLAIN = bytes.maketrans(b"123456789\n" + PAD.encode(), b"0" * 9 + b"  ")


def prepared(text: str | None) -> str:
    """The text with its start marked, digits as 0 and line feeds as spaces; empty for no text."""
    if not text:
        return ""
    return PAD * (ORDER - 1) + text.encode("utf-8", "surrogatepass").translate(_PLAIN).decode("utf-8", "surrogatepass")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_keys(points: np.ndarray) -> np.ndarray:
    """Key of the ORDER characters that end at each character but the first ORDER - 1."""
    return tk.windows(points.astype(np.uint64), ORDER)


def slices(sizes: Iterable[int], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts of these sizes that hold about so many characters."""
    sizes = list(sizes)
    start = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= chars or i == len(sizes) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def distinct_grams(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """(n-grams, counts) of prepared texts; n-grams that end in a start mark are none."""
    keys, grams, counts = tk.EMPTY, np.zeros(0, object), np.zeros(0, np.int64)
    for start, stop in slices(map(len, texts)):
        joined = "".join(texts[start:stop])
        points = code_points(joined)
        if len(points) < ORDER:
            continue
        ends = np.flatnonzero(points[ORDER - 1:] != ord(PAD))
        new, first, n = np.unique(gram_keys(points)[ends], return_index=True, return_counts=True)
        both = np.concatenate([keys, new])
        keys, at, back = np.unique(both, return_index=True, return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        fresh = at >= len(grams)
        old = grams
        grams = np.empty(len(keys), object)
        grams[~fresh] = old[at[~fresh]]
        grams[fresh] = [joined[i:i + ORDER] for i in ends[first[at[fresh] - len(old)]]]
    return grams.tolist(), counts


def distinct_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, code points by row) of the distinct n-grams of prepared texts, ascending by key."""
    found = [(tk.EMPTY, np.zeros((0, ORDER), np.uint32))]
    for start, stop in slices(map(len, texts)):
        points = code_points("".join(texts[start:stop]))
        if len(points) >= ORDER:
            ends = np.flatnonzero(points[ORDER - 1:] != ord(PAD))
            keys, first = np.unique(gram_keys(points)[ends], return_index=True)
            found.append((keys, np.lib.stride_tricks.sliding_window_view(points, ORDER)[ends[first]]))
    return merged(found)


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Union of several (keys, code points by row)."""
    keys, first = np.unique(np.concatenate([k for k, _ in found]), return_index=True)
    return keys, np.concatenate([p for _, p in found])[first]


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that every label calls good and none calls toxic."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where(
        "q = 1 and t = 0").select(F.col("doc_id").cast("long").alias("trusted_id"))


def _language(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce("lang", F.lit("")).alias("lang"))


def _key(fold: F.Column | str) -> F.Column:
    """Key of a model: the fold it leaves out, none for the model of all folds, and the language."""
    return F.concat(fold if isinstance(fold, F.Column) else F.lit(fold), F.lit(":"), F.col("lang")).alias("lang")


def _fold() -> F.Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("string")


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) for each model: lang is its key, n counts all ``docs`` but those of the fold left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_key: dict[tuple[str, str], list[str]] = {}
            for lang, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                by_key.setdefault((lang, fold), []).append(prepared(text.as_py()))
            for (lang, fold), texts in by_key.items():
                grams, n = distinct_grams(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array([fold] * len(grams), pa.string()),
                     pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=["lang", "fold", "gram", "n"])

    folds = [str(f) for f in range(FOLDS)]
    sums = docs.select("lang", _fold().alias("fold"), "text").mapInArrow(
        run, "lang string, fold string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"n{f}") for f in folds])
    counts = F.array(F.struct(_key(""), F.col("total").alias("n")),
                     *[F.struct(_key(f), (F.col("total") - F.col(f"n{f}")).alias("n")) for f in folds])
    return sums.select("gram", F.explode(counts).alias("of")).select("of.lang", "gram", "of.n").where("n > 0")


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of one order, from how many n-grams occur once to four times."""
    n = [F.sum((F.col("n") == k).cast("int")).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def d(k: int) -> F.Column:
        raw = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.least(F.greatest(F.coalesce(raw, F.lit(0.5 * k)), F.lit(0.1 * k)), F.lit(0.95 * k)).alias(f"d{k}")

    return counts.groupBy(F.col("lang").alias("d_lang")).agg(*n).select("d_lang", d(1), d(2), d(3))


def model(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame], DataFrame]:
    """Interpolated modified Kneser-Ney tables from counts (lang, gram, n) of the highest order.

    Returns ({order: (lang, gram, p)}, {order: (lang, context, back-off weight)},
    (lang, p of an unknown character)).
    """
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: how many n-grams end in this one
        by_order[k] = by_order[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(
            F.count("*").alias("n"))
    probs: dict[int, DataFrame] = {}
    weights: dict[int, DataFrame] = {}
    unknown = None
    for k in range(1, ORDER + 1):
        discounts = _discounts(by_order[k])
        cut = by_order[k].join(discounts, F.col("lang") == F.col("d_lang")).select(
            "lang", "gram", "n", F.substring("gram", 1, k - 1).alias("context"),
            F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"))
        contexts = cut.groupBy(F.col("lang").alias("c_lang"), F.col("context").alias("c_context")).agg(
            F.sum("n").alias("total"), F.sum("d").alias("held"))
        weights[k] = contexts.select(F.col("c_lang").alias("w_lang"), F.col("c_context").alias("w_context"),
                                     (F.col("held") / F.col("total")).alias("weight"))
        own = cut.join(contexts, (F.col("lang") == F.col("c_lang")) & (F.col("context") == F.col("c_context"))).select(
            "lang", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"),
            (F.col("held") / F.col("total")).alias("weight"))
        if k == 1:
            unknown = weights[1].select(F.col("w_lang").alias("u_lang"), (F.col("weight") / ALPHABET).alias("p_unknown"))
            table = own.select("lang", "gram", (F.col("own") + F.col("weight") / ALPHABET).alias("p"))
        else:
            low = probs[k - 1].select(F.col("lang").alias("l_lang"), F.col("gram").alias("l_gram"),
                                      F.col("p").alias("l_p"))
            table = own.join(low, (F.col("lang") == F.col("l_lang"))
                             & (F.substring("gram", 2, k - 1) == F.col("l_gram"))).select(
                "lang", "gram", (F.col("own") + F.col("weight") * F.col("l_p")).alias("p"))
        probs[k] = materialize(table, f"kn{k}")
        weights[k] = materialize(weights[k], f"kn-weights{k}")
    return probs, weights, unknown


def gram_log_probs(grams: DataFrame, tables: tuple) -> DataFrame:
    """(lang, gram, logp) of distinct ``grams`` (lang, gram): back off until a known suffix is met.

    ``logp`` is null where the language has no model.
    """
    probs, weights, unknown = tables
    rows = grams.select(F.col("lang").alias("r_lang"), "gram", F.col("gram").alias("suffix"),
                        F.lit(1.0).alias("w"), F.lit(None).cast("double").alias("p"))
    for k in range(ORDER, 0, -1):
        known = probs[k].select(F.col("lang").alias("k_lang"), F.col("gram").alias("k_gram"), F.col("p").alias("k_p"))
        rows = rows.join(known, (F.col("r_lang") == F.col("k_lang")) & (F.col("suffix") == F.col("k_gram")), "left").select(
            "r_lang", "gram", "suffix", "w", F.coalesce("p", F.col("w") * F.col("k_p")).alias("p"))
        if k > 1:
            rows = rows.join(weights[k], (F.col("r_lang") == F.col("w_lang"))
                             & (F.substring("suffix", 1, k - 1) == F.col("w_context")), "left").select(
                "r_lang", "gram", F.substring("suffix", 2, k - 1).alias("suffix"),
                F.when(F.col("p").isNull(), F.col("w") * F.coalesce("weight", F.lit(1.0))).otherwise(F.col("w")).alias("w"),
                "p")
    return rows.join(unknown, F.col("r_lang") == F.col("u_lang"), "left").select(
        F.col("r_lang").alias("lang"), "gram",
        F.log(F.coalesce("p", F.col("w") * F.col("p_unknown"))).cast("float").alias("logp"))


class _Chunk(NamedTuple):
    """A task's documents of one language: number, language, ids, folds (of the trusted), sizes, what was made of their texts."""

    number: int
    lang: str
    ids: list
    folds: list
    sizes: list
    parts: list


def _chunks(batches: Iterator[pa.RecordBatch], chars: int, work: Callable[[list, list, list], None]) -> Iterator[_Chunk]:
    """A task's documents by language, cut at CHUNK_CHARS.

    ``work(parts, texts, folds)`` takes up the prepared texts of each run of about ``chars``
    characters, so that no chunk's texts are held together.
    Both passes over the documents cut alike, since a task reads its rows in file order.
    """
    first = TaskContext.get().partitionId() << 32
    held: dict[str, tuple[list, list, list, list, list]] = {}
    size: Counter[str] = Counter()  # of the texts not yet taken up
    whole: Counter[str] = Counter()  # of the chunk

    def flush(lang: str) -> None:
        _, folds, _, parts, texts = held[lang]
        if texts:
            work(parts, texts, folds[-len(texts):])
            texts.clear()
        size[lang] = 0

    for batch in batches:
        rows = zip(*(batch.column(c) for c in ("doc_id", "lang", "fold", "text")))
        for doc_id, lang, fold, text in rows:
            lang, text = lang.as_py(), prepared(text.as_py())
            ids, folds, sizes, parts, texts = held.setdefault(lang, ([], [], [], [], []))
            ids.append(doc_id.as_py())
            folds.append(fold.as_py())
            sizes.append(len(text))
            texts.append(text)
            size[lang] += len(text)
            whole[lang] += len(text)
            if size[lang] >= chars:
                flush(lang)
            if whole[lang] >= CHUNK_CHARS:
                flush(lang)
                yield _Chunk(first, lang, ids, folds, sizes, parts)
                del held[lang], whole[lang]
                first += 1
    for lang in sorted(held):
        flush(lang)
        yield _Chunk(first, lang, *held[lang][:4])
        first += 1


class _Grams(NamedTuple):
    """Distinct n-grams of a fold's texts so far: (keys, points) known, and those found since."""

    known: list
    new: list

    def add(self, found: tuple[np.ndarray, np.ndarray]) -> None:
        self.new.append(found)
        if sum(len(k) for k, _ in self.new) > sum(len(k) for k, _ in self.known):
            self.union()

    def union(self) -> tuple[np.ndarray, np.ndarray]:
        self.known[:] = [merged([*self.known, *self.new])]
        self.new.clear()
        return self.known[0]


def _take_grams(parts: list, texts: list, folds: list) -> None:
    by_fold = parts[0] if parts else parts.append({}) or parts[0]
    for fold in set(folds):
        by_fold.setdefault(fold, _Grams([], [])).add(distinct_points([t for t, f in zip(texts, folds) if f == fold]))


def _asked_grams(chunk: _Chunk) -> Iterator[tuple[str, np.ndarray]]:
    """(model key, n-grams it is asked for): a fold's model its texts', the model of all folds every text's."""
    found = []
    for fold, grams in sorted(chunk.parts[0].items(), key=lambda x: str(x[0])):
        found.append(grams.union())
        if fold is not None:
            yield f"{fold}:{chunk.lang}", found[-1][1]
    yield f":{chunk.lang}", merged(found)[1]


def _take_packed(parts: list, texts: list, folds: list) -> None:
    parts.append(zstandard.ZstdCompressor(3).compress("".join(texts).encode("utf-8", "surrogatepass")))


def _shard(last: F.Column | np.ndarray, before: F.Column | np.ndarray) -> F.Column | np.ndarray:
    """Shard of an n-gram, from the code points of its last two characters."""
    return (last * 31 + before) % SHARDS


def _packed(points: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(points, np.uint32).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint32).reshape(-1, ORDER)


def _keys_of(points: np.ndarray) -> np.ndarray:
    return gram_keys(points.ravel())[::ORDER] if len(points) else tk.EMPTY


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk, model and shard: the distinct n-grams, sorted and packed.  A text is taken apart once."""
    for chunk in _chunks(batches, SLICE_CHARS, _take_grams):
        for key, points in _asked_grams(chunk):
            if not len(points):
                continue
            shard = _shard(points[:, -1].astype(np.int64), points[:, -2].astype(np.int64))
            order = np.lexsort((*points.T[::-1], shard))
            points, shard = points[order], shard[order]
            cuts = np.flatnonzero(np.diff(shard, prepend=-1))
            parts = np.split(points, cuts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk.number] * len(parts), pa.int64()), pa.array([key] * len(parts), pa.string()),
                 pa.array(shard[cuts], pa.int32()), pa.array([_packed(p) for p in parts], pa.binary())],
                names=["chunk", "lang", "shard", "grams"])


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of each model and shard; rows come ordered by these."""
    group, known, waiting, size = None, np.zeros((0, ORDER), np.uint32), [], 0

    def union() -> np.ndarray:
        points = np.concatenate([known, *waiting])
        return points[np.unique(_keys_of(points), return_index=True)[1]]

    def rows() -> pa.RecordBatch:
        text = union().tobytes().decode("utf-32-le", "surrogatepass")
        grams = [text[i:i + ORDER] for i in range(0, len(text), ORDER)]
        return pa.RecordBatch.from_arrays([pa.array([group[0]] * len(grams), pa.string()), pa.array(grams, pa.string())],
                                          names=["lang", "gram"])

    for batch in batches:
        for lang, shard, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "shard", "grams"))):
            if (lang, shard) != group:
                if group:
                    yield rows()
                group, known, waiting, size = (lang, shard), known[:0], [], 0
            waiting.append(_unpacked(raw))
            size += len(waiting[-1])
            if size > max(1_000_000, len(known)):
                known, waiting, size = union(), [], 0
    if group:
        yield rows()


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each model and shard: sorted n-gram keys and their log-probabilities."""
    group, grams, logps = None, [], []

    def row() -> pa.RecordBatch:
        keys = _keys_of(code_points("".join(grams)).reshape(-1, ORDER))
        order = np.argsort(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array([group[0]], pa.string()), pa.array([group[1]], pa.int32()), pa.array([keys[order].tobytes()], pa.binary()),
             pa.array([np.asarray(logps, np.float32)[order].tobytes()], pa.binary())],
            names=["lang", "shard", "keys", "logps"])

    for batch in batches:
        for lang, shard, gram, logp in zip(*(batch.column(c).to_pylist() for c in ("lang", "shard", "gram", "logp"))):
            if (lang, shard) != group:
                if group:
                    yield row()
                group, grams, logps = (lang, shard), [], []
            grams.append(gram)
            logps.append(logp)
    if group:
        yield row()


def _found(known: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Values of the ``asked`` keys among the sorted ``known``; an error if one is not there."""
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    if not np.array_equal(known[at], asked):
        raise RuntimeError("an n-gram has no answer: chunks were cut otherwise when they were asked for")
    return values[at]


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Log-probabilities of each asked row's n-grams, in their order.

    Rows come ordered by model and shard, each shard's answers before those who
    ask: the answers are held once a shard, not joined to every chunk.  What has no
    answers (a language without a model) gets none.
    """
    group, known, values = None, tk.EMPTY, np.zeros(0, np.float32)
    for batch in batches:
        chunk, lang, grams, out = [], [], [], []
        for row in zip(*(batch.column(c) for c in ("lang", "shard", "chunk", "grams", "keys", "logps"))):
            own, of = (row[0].as_py(), row[1].as_py()), row[2].as_py()
            if of is None:
                group, known, values = own, *(np.frombuffer(c.as_py(), t) for c, t in zip(row[4:], (np.uint64, np.float32)))
            elif own == group:
                chunk.append(of)
                lang.append(own[0])
                grams.append(row[3].as_py())
                out.append(_found(known, values, _keys_of(_unpacked(grams[-1]))).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk, pa.int64()), pa.array(lang, pa.string()), pa.array(grams, pa.binary()), pa.array(out, pa.binary())],
            names=["a_chunk", "a_lang", "grams", "logps"])


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches, SCORE_CHARS, _take_packed):
        sizes, packed = np.asarray(chunk.sizes, np.int64), chunk.parts
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk.number], pa.int64()), pa.array([chunk.lang], pa.string()),
             pa.array([chunk.ids], pa.list_(pa.int64())), pa.array([chunk.folds], pa.list_(pa.string())),
             pa.array([sizes.tobytes()], pa.binary()), pa.array([packed], pa.list_(pa.binary()))],
            names=["chunk", "lang", "ids", "folds", "sizes", "packed"])


def _score(chunk: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
    """Perplexities of a chunk's documents, and held-out ones of the trusted."""
    tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for key, rows in answer.groupby("a_lang"):
        keys = np.concatenate([_keys_of(_unpacked(g)) for g in rows["grams"]])
        order = np.argsort(keys)
        tables[key] = keys[order], np.concatenate([np.frombuffer(v, np.float32) for v in rows["logps"]])[order]
    out = []
    for row in chunk.itertuples():
        sizes, folds = np.frombuffer(row.sizes, np.int64), np.asarray(list(row.folds), object)
        value = {"perplexity": np.full(len(sizes), np.nan), "held_out": np.full(len(sizes), np.nan)}
        # one slice is unpacked at a time
        for packed, (start, stop) in zip(row.packed, slices(sizes.tolist() if tables else [], SCORE_CHARS)):
            own, of = sizes[start:stop], folds[start:stop]
            points = code_points(zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass"))
            if len(points) < ORDER:
                continue
            ends = np.flatnonzero(points[ORDER - 1:] != ord(PAD))
            keys, doc = gram_keys(points)[ends], np.repeat(np.arange(len(own)), own)[ends + ORDER - 1]
            ask = [("perplexity", f":{row.lang}", np.ones(len(own), bool))]
            ask += [("held_out", f"{f}:{row.lang}", of == f) for f in sorted({f for f in of if f is not None})]
            for name, model_key, docs in ask:
                if model_key not in tables:
                    continue
                mine = docs[doc]
                sums = np.bincount(doc[mine], _found(*tables[model_key], keys[mine]), len(own))
                some = docs & (own > ORDER - 1)
                value[name][start:stop][some] = np.exp(-sums[some] / (own[some] - ORDER + 1))
        out.append(pd.DataFrame({"doc_id": pd.array(list(row.ids), "Int64"), "lang": row.lang, **value}))
    return pd.concat(out)


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Within it, files are cut alike by every job, though executors come and go in between.

    Spark derives splits from the cores it has at the moment unless their least number is set.
    """
    name = "spark.sql.files.minPartitionNum"
    known = spark.conf.get(name, None)
    if known is None:
        spark.conf.set(name, spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
                       or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if known is None:
            spark.conf.unset(name)


def perplexities(texts: DataFrame, tables: tuple) -> DataFrame:
    """(doc_id, lang, perplexity, held_out); null for texts without characters or without a model.

    ``texts`` is (doc_id, text, lang, fold): the fold of a trusted document,
    null for others; ``held_out`` is by the model that leaves it out.  ``texts`` is
    read twice in the same order, so this call and the first job on its result
    belong in one ``same_splits``; a chunk that lacks an answer raises an error.
    """
    asked = materialize(texts.mapInArrow(_ask, "chunk long, lang string, shard int, grams binary"), "asked")
    distinct = asked.drop("chunk").repartition(SHARDS, "lang", "shard").sortWithinPartitions("lang", "shard").mapInArrow(
        _union, "lang string, gram string")
    shard = _shard(F.ascii(F.substring("gram", ORDER, 1)), F.ascii(F.substring("gram", ORDER - 1, 1))).cast("int")
    told = materialize(gram_log_probs(distinct, tables).where("logp is not null").withColumn("shard", shard).repartition(
        "lang", "shard").sortWithinPartitions("lang", "shard").mapInArrow(
        _tell, "lang string, shard int, keys binary, logps binary"), "told")
    asking = asked.select("lang", "shard", "chunk", "grams", *[F.lit(None).cast("binary").alias(c) for c in ("keys", "logps")])
    telling = told.select("lang", "shard", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("grams"),
                          "keys", "logps")
    answers = asking.union(telling).repartition("lang", "shard").sortWithinPartitions("lang", "shard", "chunk").mapInArrow(
        _answer, "a_chunk long, a_lang string, grams binary, logps binary")
    sent = texts.mapInArrow(_send, "chunk long, lang string, ids array<long>, folds array<string>, sizes binary, packed array<binary>")
    scored = sent.groupBy("chunk").cogroup(answers.groupBy("a_chunk")).applyInPandas(
        _score, "doc_id long, lang string, perplexity double, held_out double")
    null = F.lit(None).cast("double")
    return scored.select("doc_id", "lang", *[F.nanvl(c, null).alias(c) for c in ("perplexity", "held_out")])


def judge(docs: DataFrame, labels: DataFrame, quantile: float = KEEP_QUANTILE) -> DataFrame:
    """One row per document: doc_id, lang, perplexity, threshold, kept.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic.
    Trusted are the documents labelled good and not toxic.  A null lang is a
    language of its own.  Documents of a language without trusted ones are not
    judged: no perplexity, no threshold, kept.  A language whose trusted
    documents are all in one fold has no threshold and is kept too.  Texts
    without characters have no perplexity and are kept.  Empty table: no rows.
    """
    ids = materialize(trusted_ids(labels), "trusted")
    few = ids.count() <= BROADCAST_IDS
    side = F.broadcast(ids) if few else ids
    texts = _language(docs)
    trusted = texts.join(side, F.col("doc_id") == F.col("trusted_id"), "left_semi")
    tables = model(materialize(count_grams(trusted), "counts"))
    asked = texts.join(side, F.col("doc_id") == F.col("trusted_id"), "left").select(
        "doc_id", "text", "lang", F.when(F.col("trusted_id").isNotNull(), _fold()).alias("fold"))
    asked = asked if few else materialize(asked, "asked-texts")  # a shuffle keeps no order
    # many small splits would make many small chunks, which share few n-grams: join them to CHUNK_CHARS
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    with same_splits(docs.sparkSession):
        asked = asked.coalesce(max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // CHUNK_CHARS)))
        scored = materialize(perplexities(asked, tables), "perplexities")
    by_lang = scored.where("held_out is not null").groupBy("lang").agg(
        F.percentile_approx("held_out", quantile, 10_000).alias("own_threshold")).withColumnRenamed("lang", "t_lang")
    return scored.join(by_lang, F.col("lang") == F.col("t_lang"), "left").select(
        "doc_id", F.nullif("lang", F.lit("")).alias("lang"), "perplexity", F.col("own_threshold").alias("threshold"),
        F.coalesce(F.col("perplexity") <= F.col("own_threshold"), F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = KEEP_QUANTILE) -> DataFrame:
    """``docs`` without the rejected; all columns and null ids stay."""
    bad = judge(docs, labels, quantile).where("not kept and doc_id is not null").select(
        F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti")
