"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is found in a document when at least ``containment`` of its
distinct five-word shingles occur there, wherever in the (possibly very long)
document they stand.  Test items are partitioned by size, a power of two.
An item of n shingles keeps a MinHash sketch of its ``n - need + 1`` smallest
shingle keys, ``need = ceil(containment * n)``: a document that lacks all of
these has at most ``need - 1`` of the item's shingles, so the sketch search
loses nothing.  A size partition's largest sketch key bounds what a document
must look up for it, which is a scaled MinHash of the document's shingles.
Candidates are verified by the exact number of shared shingles.

Items are processed in blocks of ``items_per_block``; a block's shingles are
the only data sent to the executors (``items_per_block`` * shingles per item
* 8 bytes), and each block is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.llm import textkeys as tk

WIDTH = 5
CONTAINMENT = 0.8
ITEMS_PER_BLOCK = 5_000
HIT_SCHEMA = "doc_id long, item_id long, n_item long, n_shared long"
#: Fixed value: ASCII characters that separate words.
_BREAKS = {c: " " for c in range(128) if not chr(c).isalnum()}


def words(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII marks and white space separate them."""
    return (text or "").lower().translate(_BREAKS).encode().split()


def _item_keys(text: str | None) -> tuple[int, np.ndarray]:
    """(shingle width, sorted shingle keys) of a test item; one of under five words is one shingle."""
    h = tk.word_hashes(words(text))
    width = min(WIDTH, len(h))
    return width, (np.unique(tk.windows(h, width)) if width else tk.EMPTY)


class Block:
    """Sketches and full shingle sets of a block of test items, by shingle width and size partition."""

    def __init__(self, items: list[tuple[int, str | None]], containment: float):
        self.parts = []
        groups: dict[tuple[int, int], list[tuple[int, np.ndarray, int]]] = {}
        for item_id, text in items:
            width, keys = _item_keys(text)
            if len(keys):
                need = int(np.ceil(round(containment * len(keys), 9)))
                groups.setdefault((width, len(keys).bit_length()), []).append((item_id, keys, max(1, need)))
        for (width, _), members in sorted(groups.items()):
            owner = np.concatenate([np.full(len(k) - need + 1, i) for i, (_, k, need) in enumerate(members)])
            sketch = np.concatenate([k[:len(k) - need + 1] for _, k, need in members])
            order = np.argsort(sketch, kind="stable")
            self.parts.append((width, sketch[order], owner[order], members))

    def search(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item_id, shingles of the item, shared shingles) of each item that the text contains."""
        by_width = {w: np.unique(tk.windows(hashes, w)) for w in {p[0] for p in self.parts}}
        for width, sketch, owner, members in self.parts:
            keys = by_width[width]
            small = keys[:np.searchsorted(keys, sketch[-1], side="right")]  # the document's scaled MinHash
            lo, hi = np.searchsorted(sketch, small, "left"), np.searchsorted(sketch, small, "right")
            hit = hi > lo
            for i in sorted({int(x) for a, b in zip(lo[hit], hi[hit]) for x in owner[a:b]}):
                item_id, full, need = members[i]
                shared = tk.overlap(full, keys)
                if shared >= need:
                    yield item_id, len(full), shared


def find_items(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT,
               items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """Rows (doc_id, item_id, n_item, n_shared) for each test item that a document contains.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns
    are ignored.  Null or empty texts and items hold no words and match
    nothing.  Repeated document rows give a row each; items of equal text are
    each reported.  Empty tables: no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    items = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id").toLocalIterator()
    found, block = [], []

    def scan(block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(Block(block, containment))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = [(doc_id, *hit)
                        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                        for hit in index.search(tk.word_hashes(words(text.as_py())))]
                cols = list(zip(*rows)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["doc_id", "item_id", "n_item", "n_shared"])

        return texts.mapInArrow(run, HIT_SCHEMA)

    for row in items:
        block.append((row["item_id"], row["text"]))
        if len(block) == items_per_block:
            found.append(scan(block))
            block = []
    if block:
        found.append(scan(block))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], HIT_SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``docs`` without those that contain a test item; all columns and null ids stay."""
    hits = find_items(docs, benchmark, containment).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hits, docs["doc_id"] == hits["_hit"], "left_anti")
