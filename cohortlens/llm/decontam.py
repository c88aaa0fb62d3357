"""Benchmark decontamination: n-gram seeds find places, Smith-Waterman alignment scores them.

The items' word n-grams are looked up in every text, and each one that occurs
is a seed, however common it is: edits can leave a copy none but common ones.
Around the seeds the passage is aligned to the item word by word, so copies
with changed, missing or added words still score. A passage is skipped only
where it holds too few of the item's words to reach the threshold.

Items travel to the tasks in slices of at most ``SLICE_BYTES``: a benchmark
that is larger is searched slice by slice, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.common import stored

SEED_WORDS = 3
#: Items of fewer words do not tell a leak from common speech and match nothing.
LEAST_WORDS = 5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an item's best possible alignment score that makes a leak.
THRESHOLD = 0.5
SLICE_BYTES = 8 << 20

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a lower-cased text column."""
    return T.utf8(pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), "")))


def _hashed(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = T.spans(data, off, _ALNUM)
    return T.word_hashes(data, starts, ends), first


@dataclass
class Items:
    """Word hashes of a slice of items; seeds sorted, each with its places (item, position)."""
    ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray
    at: np.ndarray
    item: np.ndarray
    pos: np.ndarray

    @staticmethod
    def of(ids: list[int], texts: list[str]) -> Items:
        words = []
        for t in texts:
            data, off = _words(pa.array([t]))
            words.append(_hashed(data[off[0]:off[1]], off - off[0])[0])
        keep = [i for i, w in enumerate(words) if len(w) >= LEAST_WORDS]
        ids, words = [ids[i] for i in keep], [words[i] for i in keep]
        grams = [T.gram_hashes(w, SEED_WORDS) for w in words]
        all_, item = np.concatenate([*grams, np.empty(0, np.uint64)]), np.repeat(np.arange(len(words)), [len(g) for g in grams])
        pos = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
        order = np.argsort(all_, kind="stable")
        seeds, at = np.unique(all_[order], return_index=True)
        return Items(ids, words, seeds, np.append(at, len(order)), item[order], pos[order].astype(np.int64))

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions of seeds that lie inside one row, and which seeds."""
        grams = T.gram_hashes(words, SEED_WORDS)
        if not len(grams) or not len(self.seeds):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k = np.minimum(np.searchsorted(self.seeds, grams), len(self.seeds) - 1)
        at = np.flatnonzero(self.seeds[k] == grams)
        end = first[np.searchsorted(first, at, side="right")]
        at = at[at + SEED_WORDS <= end]
        return at, k[at]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, start and end in the passage."""
    n = len(passage)
    row, start = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    step = np.arange(n + 1) * -GAP
    best = (0, 0, 0)
    for w in item:
        diag = row[:-1] + np.where(passage == w, MATCH, MISMATCH)
        up = row[1:] + GAP
        top = np.maximum(np.maximum(diag, up), 0)
        begin = np.where(top == 0, np.arange(1, n + 1), np.where(diag >= up, start[:-1], start[1:]))
        cell = np.concatenate([[0], top])
        begin = np.concatenate([[0], begin])
        reach = np.maximum.accumulate(cell + step)
        source = np.maximum.accumulate(np.where(cell + step == reach, np.arange(n + 1), 0))
        row, start = reach - step, begin[source]
        k = int(row.argmax())
        if row[k] > best[0]:
            best = (int(row[k]), int(start[k]), k)
    return best


def _leaks(items: Items, words: np.ndarray, at: np.ndarray, seed: np.ndarray, threshold: float):
    """(item, score, start, end) of one text, the best place of each item."""
    count = np.diff(items.at)[seed]
    place = np.concatenate([np.arange(items.at[s], items.at[s + 1]) for s in seed])
    item, origin = items.item[place], np.repeat(at, count) - items.pos[place]
    order = np.lexsort((origin, item))
    item, origin = item[order], origin[order]
    lo = 0
    while lo < len(item):
        own = items.words[item[lo]]
        # an alignment that reaches the threshold adds at most so many words to the item's
        slack = max(0, int(MATCH * len(own) * (1 - threshold)))
        hi, best = lo, None
        while hi < len(item) and item[hi] == item[lo]:
            begin = hi
            while hi + 1 < len(item) and item[hi + 1] == item[lo] and origin[hi + 1] - origin[hi] <= slack:
                hi += 1
            a, b = max(0, origin[begin] - slack), min(len(words), origin[hi] + len(own) + slack)
            passage = words[a:b]
            if np.isin(own, passage).sum() >= threshold * len(own):
                score, s, e = align(own, passage)
                if score >= threshold * MATCH * len(own) and (best is None or score > best[0]):
                    best = (score, int(a) + s, int(a) + e)
            hi += 1
        if best:
            yield int(item[lo]), best[0] / (MATCH * len(own)), best[1], best[2]
        lo = hi


def _slice(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    all_items = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches):
        items = all_items.value
        for batch in batches:
            data, off = _words(batch.column(1))
            out = [[], [], [], [], []]
            for lo, hi in T.chunks(off):
                words, first = _hashed(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                at, seed = items.hits(words, first)
                edges = np.searchsorted(at, first)
                for i in np.flatnonzero(np.diff(edges)).tolist():
                    a, b = edges[i], edges[i + 1]
                    for item, score, s, e in _leaks(items, words[first[i]:first[i + 1]], at[a:b] - first[i], seed[a:b], threshold):
                        for x, v in zip(out, (batch.column(0)[lo + i].as_py(), items.ids[item], score, s, e)):
                            x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                                             names=["doc_id", "item_id", "score", "start_word", "end_word"])

    return docs.mapInArrow(search, "doc_id long, item_id long, score double, start_word long, end_word long")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, item_id, score, start_word, end_word): the best place of each item in each text that leaks it.

    ``score`` is the alignment's share of the item's best possible score,
    positions are words of the lower-cased text split at what is no letter or
    digit. Null and empty texts and items match nothing; items with a null id
    are skipped; repeated rows are each reported; equal scores go to the
    earliest place.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    items = stored(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total * 2 // SLICE_BYTES))
    out = None
    for s in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == s)
        got = part.orderBy("item_id", "text").toArrow().to_pydict()
        found = _slice(docs, Items.of(got["item_id"], got["text"]), threshold)
        out = found if out is None else out.union(found)
    return out
