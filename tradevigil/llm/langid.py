"""Language identification: words first, then ever shorter character n-grams.

A word seen in training scores each language by the log of its frequency there. An unseen
word is covered from left to right: at each place the longest n-gram that training knows,
from `LONGEST` characters down to one, scores, and the word counts as their mean.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradevigil.llm.store import free_names, remainder, stored
from tradevigil.session import small_batches

#: The training sample: at most so many documents per language, those of smallest hash.
DOCS_PER_LANGUAGE = 2500
LONGEST = 4
#: The model's size: at most so many words, and n-grams of each length, per language.
WORDS_KEPT, GRAMS_KEPT, LEAST_COUNT = 40_000, 20_000, 2
SMOOTHING = 0.5
#: A text's evidence is that of so many average words at most, so that scores stay below 1.
EVIDENCE_WORDS = 20
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> Counter:
    """Words of a text, lower-cased, with their counts."""
    return Counter(_WORD.findall((text or "").lower()))


def grams(word: str, n: int) -> list[str]:
    """Runs of n characters; the word's ends are marked for runs longer than one."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    tables: list[dict[str, int]]  # rows of `scores` by n-gram, for n = 1.. ; words at index 0
    scores: np.ndarray

    def unseen(self, word: str) -> np.ndarray:
        total, found, at = np.zeros(len(self.languages)), 0, 0
        marked = f"<{word}>"
        while at < len(marked):
            for n in range(min(LONGEST, len(marked) - at), 0, -1):
                row = self.tables[n].get(marked[at : at + n])
                if row is not None:
                    total += self.scores[row]
                    found += 1
                    break
            at += 1
        return total / found if found else total

    def predict(self, text: str | None, seen: dict[str, np.ndarray]) -> tuple[str, float]:
        """Language and share of the evidence; `seen` remembers words over texts."""
        counted = terms(text)
        if not self.languages or not any(c.isalpha() for w in counted for c in w):
            return UNKNOWN, 0.0
        rows, weights, total = [], [], np.zeros(len(self.languages))
        known = self.tables[0]
        for word, n in counted.items():
            row = known.get(word)
            if row is not None:
                rows.append(row)
                weights.append(n)
                continue
            if (score := seen.get(word)) is None:
                score = seen[word] = self.unseen(word)
            total += n * score
        if rows:
            total += np.array(weights, dtype=float) @ self.scores[rows]
        words = sum(counted.values())
        mean = total / words * min(words, EVIDENCE_WORDS)
        share = np.exp(mean - mean.max())
        best = int(np.argmax(mean))
        return self.languages[best], float(share[best] / share.sum())


def _counts(sample: DataFrame) -> DataFrame:
    """`lang`, `n` (0: word), `term`, `count` over the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(terms(text))
        for lang, words in found.items():
            levels = [words] + [Counter() for _ in range(LONGEST)]
            for word, count in words.items():
                for n in range(1, LONGEST + 1):
                    for g in grams(word, n):
                        levels[n][g] += count
            for n, level in enumerate(levels):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(level)), pa.array([n] * len(level), pa.int32()), pa.array(list(level)), pa.array(list(level.values()), pa.int64())],
                    ["lang", "n", "term", "count"],
                )

    parts = sample.mapInArrow(run, "lang string, n int, term string, count bigint")
    return parts.groupBy("lang", "n", "term").agg(F.sum("count").alias("count"))


def _drawn(rows: DataFrame, most: int) -> DataFrame:
    """`doc_id`, `lang` of at most `most` documents per language, those of smallest hash of their id.

    Rows are counted by the first 12 bits of the hash and cut after the one in which `most` is
    reached, then by 24 bits, so that a task ranks little more than `most` rows of a language,
    however many it has. Repeated rows count once each in the first cut and are one afterwards; NULL ids
    are never drawn.
    """
    left = rows.select("doc_id", "lang").where("doc_id IS NOT NULL").withColumn("hash", F.xxhash64(F.lit("sample"), "doc_id"))
    for bits in (12, 24):
        prefix = F.shiftright("hash", 64 - bits)
        counts = left.groupBy("lang", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("lang").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1))
        reached = counts.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < most)
        # a written table has a known size: Spark broadcasts it unless there are very many languages
        cut = stored(reached.groupBy("lang").agg(F.max("prefix").alias("last")), "cut")
        left = left.join(cut, "lang").where(prefix <= F.col("last")).select("doc_id", "lang", "hash").distinct()
    at = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    return left.withColumn("at", at).where(F.col("at") <= most).select("doc_id", "lang")


def fit(docs: DataFrame) -> Model:
    """Frequencies from the documents with a language and a crc32(doc_id) mod 3 other than 1.

    The sample is bounded per language (`DOCS_PER_LANGUAGE`), the model by the number of
    words and n-grams kept of each language, the most frequent; only those reach the driver.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & (remainder("doc_id", 3) != 1))
    chosen = stored(_drawn(rows, DOCS_PER_LANGUAGE), "sample")
    counts = stored(_counts(rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")), "counts")
    totals = counts.groupBy("lang", "n").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("kinds")).toPandas()
    best = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("count"), "term"))
    kept = counts.where(F.col("count") >= LEAST_COUNT).withColumn("at", best)
    kept = kept.where(F.col("at") <= F.when(F.col("n") == 0, WORDS_KEPT).otherwise(GRAMS_KEPT)).drop("at").toPandas()
    return _model(totals, kept)


def _model(totals: pd.DataFrame, kept: pd.DataFrame) -> Model:
    languages = sorted(totals["lang"].unique())
    tables, blocks, base = [], [], 0
    for n in range(LONGEST + 1):
        own = kept[kept["n"] == n]
        names = sorted(own["term"].unique())
        table = {t: base + i for i, t in enumerate(names)}
        counts = np.zeros((len(names), len(languages)))
        counts[[table[t] - base for t in own["term"]], [languages.index(x) for x in own["lang"]]] = own["count"]
        of = totals[totals["n"] == n].set_index("lang")
        size = np.array([of["total"].get(x, 0) + SMOOTHING * of["kinds"].sum() for x in languages])
        blocks.append(np.log((counts + SMOOTHING) / np.maximum(size, 1)))
        tables.append(table)
        base += len(names)
    return Model(languages, tables, np.concatenate(blocks) if blocks else np.zeros((0, 0)))


def identified(spark: SparkSession, model: Model, text: Column) -> Column:
    """`lang_pred` and `score` of a text column, as a struct."""
    shared = small_batches(spark).sparkContext.broadcast((model.languages, model.tables, model.scores))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, seen = Model(*shared.value), {}
        for texts in batches:
            found = []
            for t in texts:
                found.append(own.predict(t, seen))
                if len(seen) > 200_000:
                    seen.clear()
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang_pred string, score double")(text)


def report(docs: DataFrame) -> DataFrame:
    """The columns of `op6_language_id`.

    A text that is NULL or has no letter is `und` with score 0, and so is every text if no
    row has a language to learn. Repeated rows each get a row; ties go to the first name.
    """
    rows = docs.select("doc_id", "text").withColumn("found", identified(docs.sparkSession, fit(docs), F.col("text")))
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    return rows.select("doc_id", held_out, "found.lang_pred", "found.score")


def recognised(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of `docs` in some language with a score of at least `least`; all columns are kept."""
    found = identified(docs.sparkSession, fit(docs), F.col("text"))
    (name,) = free_names(docs, "language")
    rows = docs.withColumn(name, found)
    return rows.where((F.col(name)["lang_pred"] != UNKNOWN) & (F.col(name)["score"] >= least)).select(*docs.columns)
