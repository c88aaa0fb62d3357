"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. An unseen word
falls back to its longest character n-grams that any language knows, then to
shorter ones, down to single letters. The model is a bounded table, learned
by Spark from a bounded sample of labelled rows, and is broadcast.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortlens.llm import textops as T

#: Bounds of the model: labelled rows per language, known words, n-grams per length.
ROWS_PER_LANGUAGE = 3000
MAX_WORDS = 120_000
MAX_GRAMS = 40_000
LONGEST = 5
SMOOTH = 0.5
UNDETERMINED = "und"
_CACHE_WORDS = 400_000


def _letters(col: pa.Array) -> pa.Array:
    """Lower-case runs of letters, separated by single spaces."""
    text = pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), ""))
    return pc.replace_substring_regex(text, pattern=r"[^\p{L}]+", replacement=" ")


def _grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """Languages in order; for each n (0: whole words) the row of a gram, and log frequencies by row."""
    languages: list[str]
    rows: list[dict[str, int]]
    logs: np.ndarray

    def of_word(self, word: str) -> np.ndarray:
        row = self.rows[0].get(word)
        if row is not None:
            return self.logs[row]
        for n in range(LONGEST, 0, -1):
            have = self.rows[n]
            known = [have[g] for g in _grams(word, n) if g in have]
            if known:
                return self.logs[known].mean(axis=0)
        return np.zeros(len(self.languages), dtype=np.float32)


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from (doc_id, text, lang); rows without a label or a text teach nothing.

    Of each language the ``rows_per_language`` rows of smallest hashed doc_id
    are used (a documented bound of the sample; all their text is read).
    """
    spark = labelled.sparkSession
    labelled = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        "lang is not null and doc_id is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (labelled.select("doc_id", "lang").withColumn("k", F.row_number().over(order))
           .where(F.col("k") <= rows_per_language).select("doc_id").distinct())
    sample = labelled.join(ids, "doc_id", "left_semi").select("lang", "text")

    def count(batches):
        for batch in batches:
            counts: Counter = Counter()
            text = _letters(batch.column(1)).to_pylist()
            for lang, words in zip(batch.column(0).to_pylist(), text):
                counts.update((lang, w) for w in words.split())
            grams: Counter = Counter()
            for (lang, word), c in counts.items():
                grams[lang, 0, word] += c
                for n in range(1, LONGEST + 1):
                    for g in _grams(word, n):
                        grams[lang, n, g] += c
            if grams:
                lang, n, g = zip(*grams)
                yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(n, pa.int32()), pa.array(g), pa.array(list(grams.values()), pa.int64())],
                                                 names=["lang", "n", "gram", "c"])

    found = sample.mapInArrow(count, "lang string, n int, gram string, c long").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    by_gram = found.groupBy("n", "gram").agg(F.sum("c").alias("total"), F.collect_list(F.struct("lang", "c")).alias("langs"))
    best = Window.partitionBy("n").orderBy(F.desc("total"), "gram")
    kept = (by_gram.withColumn("k", F.row_number().over(best))
            .where(F.when(F.col("n") == 0, F.col("k") <= MAX_WORDS).otherwise(F.col("k") <= MAX_GRAMS)).select("n", "gram", "langs"))
    table = kept.toArrow().to_pydict()
    languages = sorted({x["lang"] for langs in table["langs"] for x in langs})
    at = {x: i for i, x in enumerate(languages)}
    rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    counts = np.zeros((len(table["n"]), len(languages)))
    for i, (n, gram, langs) in enumerate(zip(table["n"], table["gram"], table["langs"])):
        rows[n][gram] = i
        for x in langs:
            counts[i, at[x["lang"]]] = x["c"]
    logs = np.zeros_like(counts, dtype=np.float32)
    for have in rows:
        if have:
            own = np.fromiter(have.values(), dtype=np.int64)
            c = counts[own] + SMOOTH
            logs[own] = np.log(c / c.sum(axis=0))
    return Model(languages, rows, logs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score added; only ``text`` is read.

    ``score`` is the language's share of the likelihood. A null text and one
    without a letter is ``und`` with score 0; equal scores go to the first
    language in code-point order; a model without languages gives ``und``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def scored(col, model, cache, vectors):
        data, off = T.utf8(_letters(col))
        width = len(model.languages)
        total = np.zeros((len(off) - 1, width))
        words = np.zeros(len(off) - 1, dtype=np.int64)
        for lo, hi in T.chunks(off):
            part, at = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            starts, ends, first = T.spans(part, at)
            words[lo:hi] = np.diff(first)
            if not len(starts) or not width:
                continue
            if len(cache) > _CACHE_WORDS:
                cache.clear()
                vectors.clear()
            uniq, example, which = np.unique(T.word_hashes(part, starts, ends), return_index=True, return_inverse=True)
            ids = np.empty(len(uniq), dtype=np.int64)
            for i, h in enumerate(uniq.tolist()):
                k = cache.get(h)
                if k is None:
                    e = example[i]
                    k = cache[h] = len(vectors)
                    vectors.append(model.of_word(part[starts[e]:ends[e]].tobytes().decode()))
                ids[i] = k
            used = np.array([vectors[k] for k in ids.tolist()], dtype=np.float64)[which]
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            for x in range(width):
                total[lo:hi, x] = np.bincount(row, weights=used[:, x], minlength=hi - lo)
        return total, words

    def run(batches):
        model = shared.value
        cache, vectors = {}, []
        for batch in batches:
            total, words = scored(batch.column("text"), model, cache, vectors)
            if model.languages:
                top = total.argmax(axis=1)
                share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                pred = np.array(model.languages, dtype=object)[top]
            else:
                share, pred = np.zeros(len(words)), np.full(len(words), UNDETERMINED, dtype=object)
            none = words == 0
            pred[none], share[none] = UNDETERMINED, 0.0
            columns = [*batch.columns, pa.array(pred.tolist(), pa.string()), pa.array(share)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    rest = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    schema = StructType(rest.schema.fields + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rest.mapInArrow(run, schema)


def held_out(doc_id) -> "F.Column":
    """Rows that the model must not learn from; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    docs = docs.select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out("doc_id")))
    return predict(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")
