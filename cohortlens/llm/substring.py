"""Substring dedup: a count-min prefilter finds the windows that may repeat, a second pass groups those exactly.

A window is ``WINDOW`` consecutive words. The sketch does not count every
window: it counts the window's *anchor*, the smallest hash among its runs of
``GRAM`` words, at the places where that run is smallest for some window.
Equal windows have equal anchors, so an anchor's count is at least the count
of each of its windows: an estimate of 1 proves a window unique, and none that
repeats is lost. An eighth of the words carry an anchor.

The sketch has one row of ``2**CELL_BITS`` cells and is kept sparse: only
touched cells are stored. Each partition adds up its own, the partial
sketches are merged by a shuffle, and nothing is broadcast, so it grows with
the input without filling up.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.common import stored

WINDOW = 20
GRAM = 6
CELL_BITS = 60
#: Windows that a task sorts at a time.
BUFFER = 1 << 20
_NO_WORDS = hashlib.sha256(b"").hexdigest()


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``width`` values."""
    out, have = x, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[:len(x) - width + 1], out[width - have:]) if have < width else out


def _anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and the anchors at every place where one is smallest."""
    g = T.gram_hashes(words, min(GRAM, window)) >> np.uint64(64 - CELL_BITS)
    width = window - min(GRAM, window) + 1
    low = _sliding(g, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    high = _sliding(np.concatenate([pad, low, pad]), width, np.maximum)
    return low, g[high == g]


def _tag(sha: bytes) -> int:
    return (sha[0] << 7 | sha[1] >> 1) << 40


def _profile(docs: DataFrame, window: int) -> DataFrame:
    """Each row's word count, hash of its words, its anchors, and those that it has twice or more."""
    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column(1))
            for lo, hi in T.chunks(off):
                part, at = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                starts, ends, first = T.spans(part, at)
                hashes = T.word_hashes(part, starts, ends)
                n, sha, tag, one, two = [], [], [], [], []
                for i in range(hi - lo):
                    words = hashes[first[i]:first[i + 1]]
                    n.append(len(words))
                    digest = hashlib.sha256(b" ".join(part[at[i]:at[i + 1]].tobytes().split()))
                    sha.append(digest.hexdigest())
                    tag.append(_tag(digest.digest()))
                    if len(words) >= window:
                        v, c = np.unique(_anchors(words, window)[1], return_counts=True)
                        one.append(v.view(np.int64))
                        two.append(v[c > 1].view(np.int64))
                    else:
                        one.append([])
                        two.append([])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sha), pa.array(tag, pa.int64()),
                     pa.array(one, pa.list_(pa.int64())), pa.array(two, pa.list_(pa.int64()))],
                    names=["doc_id", "n_words", "sha", "tag", "anchors", "twice"])

    return docs.mapInArrow(run, "doc_id long, n_words long, sha string, tag long, anchors array<long>, twice array<long>")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle that brings them to their anchors."""
    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.binary())
            packed = [pa.compress(t.as_buffer(), "zstd", asbytes=True) for t in texts]
            size = pa.array([len(t.as_buffer()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(packed, pa.binary()), size], names=["doc_id", "z", "size"])

    return docs.mapInArrow(run, "doc_id long, z binary, size long")


def _unpacked(row_z, row_size) -> bytes:
    size = row_size.as_py()
    return pa.decompress(row_z.as_buffer(), size, "zstd", asbytes=True) if size else b""


def _first_of_group(w1, w2, doc, at, last=None):
    """Of sorted rows, which are not the first place of their window; ``last`` is the group that goes on."""
    new = np.ones(len(w1), dtype=bool)
    new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(w1)), 0))
    fd, fa = doc[lead], at[lead]
    if last is not None and (w1[0], w2[0]) == last[:2]:
        same = lead == 0
        fd[same], fa[same] = last[2:]
    return new, (doc != fd) | (at != fa), (w1[-1], w2[-1], fd[-1], fa[-1])


_PLACES = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("known", pa.bool_())])


def _candidates(flagged: DataFrame, window: int) -> DataFrame:
    """Windows whose anchor is estimated repeated.

    A task sorts what it has gathered: only the first place of a window goes to
    the shuffle, the others are known to repeat. So a window that a third of all
    documents share costs one row per task.
    """
    def flush(held):
        w1, w2, doc, at = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((at, doc, w2, w1))
        w1, w2, doc, at = w1[order], w2[order], doc[order], at[order]
        new, later, _ = _first_of_group(w1, w2, doc, at)
        lead = new & ~later
        yield pa.RecordBatch.from_arrays([*(pa.array(x[lead]) for x in (w1, w2, doc, at)), pa.array(np.zeros(lead.sum(), bool))], schema=_PLACES)
        doc, at = doc[later], at[later]
        order = np.lexsort((at, doc))          # in order, places that are known to repeat take little room
        none = pa.nulls(len(doc), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(doc[order]), pa.array(at[order]), pa.array(np.ones(len(doc), bool))], schema=_PLACES)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for doc, z, size, hits in zip(*batch.columns):
                data = np.frombuffer(_unpacked(z, size), dtype=np.uint8)
                starts, ends, _ = T.spans(data, np.array([0, len(data)]))
                words = T.word_hashes(data, starts, ends)
                if len(words) < window:
                    continue
                at = np.flatnonzero(np.isin(_anchors(words, window)[0].view(np.int64), hits.values.to_numpy()))
                tag = _tag(hashlib.sha256(b" ".join(data.tobytes().split())).digest())
                held.append((T.gram_hashes(words, window)[at].view(np.int64), T.gram_hashes(words, window, salt=91)[at].view(np.int64),
                             np.full(len(at), doc.as_py()), at + tag))
                n += len(at)
                if n >= BUFFER:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return flagged.mapInArrow(run, "w1 long, w2 long, doc_id long, at long, known boolean")


def _repeats(places: DataFrame) -> DataFrame:
    """The places (doc_id, at) of windows that start earlier elsewhere; streams over sorted rows."""
    def run(batches):
        last = None
        for batch in batches:
            if batch.num_rows:
                w1, w2, doc, at = (batch.column(k).to_numpy() for k in range(4))
                _, later, last = _first_of_group(w1, w2, doc, at, last)
                yield pa.RecordBatch.from_arrays([pa.array(doc[later]), pa.array(at[later])], names=["doc_id", "at"])

    return (places.where("not known").select("w1", "w2", "doc_id", "at").repartition("w1", "w2")
            .sortWithinPartitions("w1", "w2", "doc_id", "at").mapInArrow(run, "doc_id long, at long"))


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """Rows (doc_id, z, size, places) to (doc_id, tag, n_removed, kept_sha256, text) without the covered words."""
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, z, size, places in zip(*batch.columns):
                words = _unpacked(z, size).split()
                tag = _tag(hashlib.sha256(b" ".join(words)).digest())
                at = places.values.to_numpy()
                at = at[(at >> 40) == (tag >> 40)] - tag
                at = at[at <= len(words) - window]
                step = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
                gone = np.cumsum(step[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                for x, v in zip(out, (doc.as_py(), tag, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode())):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                             names=["doc_id", "tag", "n_removed", "kept_sha256", "kept_text"])

    return texts.mapInArrow(run, "doc_id long, tag long, n_removed long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 (and kept_text).

    Windows are judged on the input. A null or empty text has no words. A text
    whose words are all those of a smaller doc_id is removed whole without
    grouping its windows. Rows with a null doc_id are left as they are and
    remove nothing. Rows that share a doc_id are ordered by the hash of their
    words; an equal row never removes its twin.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    t = stored(_profile(docs, window))
    known = t.where("doc_id is not null")
    firsts = known.where(F.col("n_words") >= window).groupBy("sha").agg(F.min("doc_id").alias("first"))
    mine = stored(known.where(F.col("n_words") >= window).join(firsts, "sha").where("doc_id = first")
                  .select("doc_id", "tag", "anchors", "twice").dropDuplicates(["doc_id", "tag"]))
    sketch = mine.select(F.explode(F.concat("anchors", "twice")).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    hits = (mine.select("doc_id", F.explode("anchors").alias("cell")).join(sketch.where("n > 1"), "cell", "left_semi")
            .groupBy("doc_id").agg(F.collect_set("cell").alias("hits")))
    flagged = stored(_packed(docs.where("doc_id is not null")).join(hits, "doc_id"))
    places = stored(_candidates(flagged.select("doc_id", "z", "size", "hits"), window))
    later = (places.where("known").select("doc_id", "at").union(_repeats(places))
             .groupBy("doc_id").agg(F.collect_set("at").alias("places")))
    cut = _cut(flagged.select("doc_id", "z", "size").join(later, "doc_id"), window)
    if not with_text:
        cut = cut.drop("kept_text")
    cut = cut.dropDuplicates(["doc_id", "tag"])
    rows = t.select("doc_id", "tag", "n_words", "sha").join(firsts, "sha", "left").join(cut, ["doc_id", "tag"], "left")
    copy = F.col("first").isNotNull() & F.col("doc_id").isNotNull() & (F.col("first") < F.col("doc_id"))
    out = rows.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_NO_WORDS)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if with_text else []))
    return out
