"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings counts their common subsequences of four symbols that
span at most ``SPAN`` characters, each occurrence weighted by ``DECAY`` per
character left out (gap-weighted subsequence kernel, Lodhi et al. 2002, with a
bounded span): an insult with characters put between its letters keeps most of
its subsequences. Symbols are a to z, five classes of other letters and one for
everything else. A string is scaled by the root of its length, landmarks to norm one.

Landmarks are words of labelled texts: those found far more often in toxic
documents, and clean words as background. The Nyström map of a string is its
kernel row against the landmarks, whitened by their own kernel. MLlib fits a
linear support vector machine on it, first over labelled sentences (a sentence has
its document's label). A sentence of a toxic document need not be toxic, and a
toxic one is so in a few words; so ``ROUNDS`` times the machine picks its witnesses,
the highest passages of ``WINDOW`` characters of each sampled document, and is
fitted again on these and on hashed passages of clean documents. As the map is
linear in the subsequences, the machine folds into one weight per subsequence (a
table of 4 MB, whatever the corpus): scoring a text is one pass over its
characters. A document's margin is that of its highest passage; a logistic curve,
fitted on other labelled documents than the machine's, turns it into the score.

Bounds of the sample that is learnt from, all parameters: about ``SAMPLE_DOCS``
documents per class for the machine and as many for the curve, ``SAMPLE_SENTENCES``
sentences per class; documents that share their least 5-word shingle count once
as landmarks' evidence and in the first fit. Scoring reads every whole text.

Defined cases: null and empty texts and texts without a letter have no passage
and get the score of the machine's offset; a null ``doc_id`` is held out and never
learnt from; ids with several labels count as toxic if one label says so; null
labels are no labels; repeated rows are scored each on its own; without both
classes among the labelled rows every score is the share of toxic ones (0 if there is
none). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored

SYMBOL_BITS, LENGTH, SPAN, DECAY = 5, 4, 7, 0.35
LONGEST, WINDOW, ROUNDS = 160, 14, 2
SAMPLE_DOCS = 2000
SAMPLE_SENTENCES = 8000
#: Landmarks from toxic documents, how far they must stand out (standard errors), and clean ones.
LANDMARKS, LEAST_Z, BACKGROUND = 100, 4.0, 64
#: Passages taken of a toxic and of a clean document, and hashed ones of a clean one.
WITNESSES = (2, 6, 4)
#: Tasks of the fits, whose rows are bounded by the sample.
FIT_TASKS = 4
THRESHOLD = 0.7
_FEATURES = 1 << (SYMBOL_BITS * LENGTH)
_GAPS = [(i, j, k) for k in range(3, SPAN) for j in range(2, k) for i in range(1, j)]
#: Norm of the subsequences that start at one character, were they all different.
_UNIT = float(np.sqrt(sum(DECAY ** (2 * (k - 3)) for _, _, k in _GAPS)))
_CHUNK = 1 << 20


# ------------------------------------------------------------------ symbols and sentences
def _symbol_table(size: int = 0x250) -> np.ndarray:
    out = np.zeros(size, dtype=np.int32)
    for cp in range(size):
        c = chr(cp).lower()[0]
        if "a" <= c <= "z":
            out[cp] = ord(c) - 96
        elif c.isalpha():
            out[cp] = 27 + ord(c) % 5
    return out


_SYMBOL = _symbol_table()


def _symbols(points: np.ndarray) -> np.ndarray:
    """Symbol of each code point; punctuation blocks and everything that is no letter below them are 0."""
    out = _SYMBOL[np.minimum(points, len(_SYMBOL) - 1)]
    high = points >= len(_SYMBOL)
    mark = ((points >= 0x2000) & (points < 0x2070)) | ((points >= 0x3000) & (points < 0x3040)) | ((points >= 0xFE00) & (points < 0xFE70))
    return np.where(high, np.where(mark, 0, 27 + points % 5), out).astype(np.int32)


def _pieces(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of all sentences of the rows: after a line end, after . ! ? and a space, and every ``LONGEST`` characters."""
    n = len(points)
    start = np.zeros(n + 1, dtype=bool)
    stop = np.isin(points, (0x2E, 0x21, 0x3F))
    space = np.isin(points, (0x20, 0x09, 0x0A, 0x0D))
    start[2:] = (stop[:-1] & space[1:])
    start[1:] |= points == 0x0A
    start[off[:-1][np.diff(off) > 0]] = True
    at = np.flatnonzero(start[:n])
    size = np.diff(np.append(at, n))
    more = (size - 1) // LONGEST
    out = np.repeat(at, more + 1)
    first = np.cumsum(more + 1) - (more + 1)
    return out + LONGEST * (np.arange(len(out)) - np.repeat(first, more + 1))


_PAD = WINDOW + SPAN


def _rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by ``_PAD`` blanks, and where the rows begin."""
    values = pc.fill_null(texts.cast(pa.large_string()), "").to_pylist()
    points = np.frombuffer((" " * _PAD).join([*values, ""]).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int32)
    size = np.fromiter((len(v) + _PAD for v in values), dtype=np.int64, count=len(values))
    return points, np.concatenate([[0], np.cumsum(size)])


def _grams(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For every pattern of gaps the subsequence that starts at each character, and its weight."""
    n = len(symbols)
    s = np.concatenate([symbols, np.zeros(SPAN, dtype=np.int32)])
    first = s[:n] << 15
    for j in range(2, SPAN - 1):
        for i in range(1, j):
            two = first + (s[i:n + i] << 10) + (s[j:n + j] << 5)
            for k in range(max(j + 1, 3), SPAN):
                yield two + s[k:n + k], DECAY ** (k - 3)


def _scale(lengths: np.ndarray) -> np.ndarray:
    return _UNIT * np.sqrt(np.maximum(lengths, WINDOW))


# ------------------------------------------------------------------ landmarks
@dataclass
class Landmarks:
    """Feature columns of the landmarks' subsequences and the whitened map onto them."""
    column: np.ndarray            # subsequence -> column or -1
    phi: np.ndarray               # columns x landmarks, landmarks of norm one
    white: np.ndarray             # landmarks x dimensions

    @staticmethod
    def of(words: list[str], floor: float = 1e-3) -> "Landmarks":
        found = []
        for w in words:
            points = np.array([ord(c) for c in f" {w} "], dtype=np.int64)
            both = [(u, np.full(len(u), x)) for u, x in _grams(_symbols(points))]
            u, x = (np.concatenate(part) for part in zip(*both))
            uniq, at = np.unique(u, return_inverse=True)
            weight = np.bincount(at, weights=x)
            found.append((uniq, weight / np.sqrt((weight ** 2).sum())))
        used = np.unique(np.concatenate([u for u, _ in found]))
        column = np.full(_FEATURES, -1, dtype=np.int32)
        column[used] = np.arange(len(used))
        phi = np.zeros((len(used), len(words)), dtype=np.float32)
        for k, (u, x) in enumerate(found):
            phi[column[u], k] = x
        value, vector = np.linalg.eigh((phi.T @ phi).astype(np.float64))
        keep = value > floor * value.max()
        return Landmarks(column, phi, vector[:, keep] / np.sqrt(value[keep]))

    def rows(self, texts: list[str]) -> np.ndarray:
        """Whitened kernel rows of the strings."""
        out = np.zeros((len(texts), self.white.shape[1]))
        for k, text in enumerate(texts):
            points = np.array([ord(c) for c in text], dtype=np.int64)
            both = [(c[c >= 0], x) for c, x in ((self.column[u], x) for u, x in _grams(_symbols(points)))]
            columns = np.concatenate([c for c, _ in both])
            weights = np.repeat([x for _, x in both], [len(c) for c, _ in both])
            uniq, at = np.unique(columns, return_inverse=True)
            if len(uniq):
                out[k] = (np.bincount(at, weights=weights) @ self.phi[uniq]) @ self.white
            out[k] /= _scale(np.float64(len(points)))
        return out

    def table(self, weights: np.ndarray) -> np.ndarray:
        """One weight per subsequence: the linear machine on the whitened rows, folded back."""
        out = np.zeros(_FEATURES, dtype=np.float32)
        used = np.flatnonzero(self.column >= 0)
        out[used] = (self.phi @ (self.white @ weights))[self.column[used]]
        return out


@dataclass
class Model:
    """Weight per subsequence and offset of the machine; slope and offset of the curve. ``table`` None: a constant."""
    table: np.ndarray | None
    offset: float = 0.0
    slope: float = 1.0
    curve: float = 0.0
    share: float = 0.0

    def passages(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all words and the margin of the passage of ``WINDOW`` characters there."""
        run, letter = np.zeros(len(points) + 1), np.zeros(len(points) + 1, dtype=bool)
        for at in range(0, len(points), _CHUNK):             # one very long text passes in pieces that overlap
            s = _symbols(points[at:at + _CHUNK + SPAN])
            v = np.zeros(len(s), dtype=np.float32)
            for u, x in _grams(s):
                v += np.float32(x) * self.table[u]
            n = min(_CHUNK, len(points) - at)
            run[at + 1:at + n + 1] = run[at] + np.cumsum(v[:n], dtype=np.float64)
            letter[at + 1:at + n + 1] = s[:n] > 0
        starts = np.flatnonzero(letter[1:] & ~letter[:-1])
        value = run[np.minimum(starts + WINDOW, len(points))] - run[np.maximum(starts - 1, 0)]
        return starts, value / _scale(np.float64(WINDOW)) + self.offset

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Highest passage margin of each text; texts without a letter have the offset."""
        out = np.full(len(texts), -np.inf)
        lo, sizes = 0, pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        while lo < len(texts):
            hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(sizes[lo:]), _CHUNK, side="right")))
            points, off = _rows(texts.slice(lo, hi - lo))
            starts, value = self.passages(points)
            np.maximum.at(out, lo + np.searchsorted(off, starts, side="right") - 1, value)
            lo = hi
        return np.where(np.isneginf(out), self.offset, out)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.table is None:
            return np.full(len(texts), self.share)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margins(texts) + self.curve, -700, 700)))


# ------------------------------------------------------------------ training
def held_out(doc_id) -> "F.Column":
    """Rows whose labels must not be learnt; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def _sampled(labels: DataFrame, per_class: int) -> DataFrame:
    """About ``per_class`` ids of each class in each of the two parts, by hash (doc_id, toxic, part)."""
    one = (labels.where("doc_id is not null and toxic is not null")
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    one = one.where(~held_out("doc_id")).withColumn("part", (F.crc32(F.col("doc_id").cast("string")) % 3 == 2).cast("int"))
    share = one.groupBy("toxic", "part").agg((F.lit(float(per_class)) / F.count(F.lit(1))).alias("share"))
    return (one.join(F.broadcast(share), ["toxic", "part"])
            .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("doc_id", "toxic", "part"))


def _sentences(docs: DataFrame) -> DataFrame:
    """(toxic, sketch, n, sentence) of the sampled documents; the sketch is the least hash of five words in a row."""
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for toxic, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points, off = _rows(pa.array([whole], pa.string()))
                words = whole.split()
                sketch = min((hash_of(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0)
                starts = [int(x) for x in _pieces(points, off) if x < len(whole)]
                out += [(toxic, sketch, k, whole[a:b]) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(whole)]))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["toxic", "sketch", "n", "sentence"])

    return docs.select("toxic", "text").mapInArrow(run, "toxic long, sketch long, n long, sentence string")


def hash_of(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1


def landmark_words(sentences: DataFrame, count: int = LANDMARKS, background: int = BACKGROUND) -> list[str]:
    """Words most over-represented in toxic documents, then clean words by hash; documents count once per sketch."""
    words = sentences.select("toxic", "sketch", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("sentence"), F.lit(r"([\p{L}]{2,24})"), F.lit(1)))).alias("word"))
    seen = words.groupBy("word").agg(F.count_distinct(F.when(F.col("toxic") == 1, F.col("sketch"))).alias("t"),
                                     F.count_distinct(F.when(F.col("toxic") == 0, F.col("sketch"))).alias("c"))
    n = sentences.agg(F.count_distinct(F.when(F.col("toxic") == 1, F.col("sketch"))).alias("t"),
                      F.count_distinct(F.when(F.col("toxic") == 0, F.col("sketch"))).alias("c")).first()
    p = (F.col("t") + F.col("c") + 1) / float(n["t"] + n["c"] + 2)
    z = (F.col("t") / float(max(n["t"], 1)) - F.col("c") / float(max(n["c"], 1))) / F.sqrt(p * (1 - p) * (1 / max(n["t"], 1) + 1 / max(n["c"], 1)))
    ranked = stored(seen.select("word", "t", "c", z.alias("z")))
    toxic = [r["word"] for r in ranked.where(f"t > 1 and z > {LEAST_Z}").orderBy(F.desc("z"), "word").limit(count).collect()]
    clean = [r["word"] for r in ranked.where("c > 0 and z <= 0").orderBy(F.xxhash64("word"), "word").limit(background).collect()]
    return list(dict.fromkeys(toxic + clean))


def _fit_machine(rows: DataFrame, reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear support vector machine on (toxic, z), classes weighted alike."""
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = F.when(F.col("toxic") == 1, total / (2.0 * counts[1])).otherwise(total / (2.0 * counts[0]))
    data = rows.select(F.col("toxic").cast("double").alias("label"), array_to_vector("z").alias("features"), weight.alias("weight"))
    # some 20,000 rows of 160 numbers, whatever the corpus: few tasks, as each iteration is a job
    model = LinearSVC(maxIter=40, regParam=reg, standardization=False, weightCol="weight").fit(data.coalesce(FIT_TASKS))
    return model.coefficients.toArray(), float(model.intercept)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_sentences: int = SAMPLE_SENTENCES) -> Model:
    """Learn from documents (doc_id, text) whose labels (doc_id, toxic) may be used; see the module docstring for bounds."""
    ids = stored(_sampled(labels, sample_docs))               # four groups of about ``sample_docs`` ids
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    sample = stored(own.join(F.broadcast(ids), "doc_id"))
    found = {(r["part"], r["toxic"]): r["n"] for r in sample.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not found.get((0, 0)) or not found.get((0, 1)):
        known = labels.where("toxic is not null").where(~held_out("doc_id")).agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
        return Model(None, share=float(known or 0.0))
    sentences = stored(_sentences(sample.where("part = 0")))
    words = landmark_words(sentences)
    marks = Landmarks.of(words) if words else None
    if marks is None:
        return Model(None, share=found[0, 1] / (found[0, 0] + found[0, 1]))
    share = sentences.groupBy("toxic").agg((F.lit(float(sample_sentences)) / F.count(F.lit(1))).alias("share"))
    once = sentences.groupBy("toxic", "sketch", "n").agg(F.min("sentence").alias("string"))
    picked = (once.join(F.broadcast(share), "toxic")
              .where(F.pmod(F.xxhash64("sketch", "n"), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("toxic", "string"))
    weights, offset = _fit_machine(_mapped(picked, marks))
    for _ in range(ROUNDS):
        witnesses = _witnesses(sample.where("part = 0"), Model(marks.table(weights), offset))
        weights, offset = _fit_machine(_mapped(witnesses, marks))
    part = 1 if found.get((1, 0)) and found.get((1, 1)) else 0
    return _curve(sample.where(F.col("part") == part), labels, part, Model(marks.table(weights), offset))


def _mapped(strings: DataFrame, marks: Landmarks) -> DataFrame:
    """(toxic, z) of (toxic, string): the whitened kernel rows, spread over all tasks and written."""
    shared = strings.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        for batch in batches:
            z = shared.value.rows(batch.column(1).to_pylist())
            at = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(z.ravel()))], names=["toxic", "z"])

    n = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(strings.select(F.col("toxic").cast("long").alias("toxic"), "string").repartition(n, F.xxhash64("string"))
                  .mapInArrow(run, "toxic long, z array<double>"))


def _witnesses(sample: DataFrame, model: Model) -> DataFrame:
    """The highest passages of each document that do not overlap, and hashed ones of clean documents."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            toxic, strings = [], []
            for t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points, _ = _rows(pa.array([text], pa.string()))
                starts, value = shared.value.passages(points)
                best: list[int] = []
                for k in starts[np.argsort(-value, kind="stable")].tolist():
                    if all(abs(k - x) >= WINDOW for x in best):
                        best.append(k)
                    if len(best) == WITNESSES[0 if t else 1]:
                        break
                if not t and len(starts):
                    best += [int(starts[hash_of(f"{k}:{text[:80]}") % len(starts)]) for k in range(WITNESSES[2])]
                strings += [text[max(k - 1, 0):k + WINDOW] for k in best]
                toxic += [t] * len(best)
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int64()), pa.array(strings, pa.string())], names=["toxic", "string"])

    return sample.select(F.col("toxic").cast("long").alias("toxic"), "text").mapInArrow(run, "toxic long, string string")


def _curve(sample: DataFrame, labels: DataFrame, part: int, model: Model) -> Model:
    """Logistic curve over document margins, weighted back to the classes' shares among all labels of the part."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.margins(batch.column(1)))], names=["toxic", "margin"])

    seen = stored(sample.select(F.col("toxic").cast("long").alias("toxic"), "text").mapInArrow(run, "toxic long, margin double"))
    mine = ~held_out("doc_id") & ((F.crc32(F.col("doc_id").cast("string")) % 3 == 2) == F.lit(bool(part)))
    all_of = labels.where("doc_id is not null and toxic is not null").where(mine).groupBy((F.col("toxic") > 0).cast("long").alias("toxic")).agg(F.count(F.lit(1)).alias("all"))
    got = seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).join(all_of, "toxic").withColumn("weight", F.col("all") / F.col("n"))
    data = seen.join(F.broadcast(got), "toxic").select(F.col("toxic").cast("double").alias("label"), array_to_vector(F.array("margin")).alias("features"), "weight")
    curve = LogisticRegression(weightCol="weight", regParam=1e-6, maxIter=100).fit(data)
    return Model(model.table, model.offset, max(float(curve.coefficients[0]), 0.0), float(curve.intercept))


# ------------------------------------------------------------------ scoring
def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text); only ``text`` decides the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = shared.value.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)], names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels that may be used, score every document."""
    return score(docs, fit(docs, labels))
