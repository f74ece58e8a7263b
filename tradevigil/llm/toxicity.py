"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is a logistic function of its words and their character n-grams, as
offensive words take many endings. A document is toxic if any of its sentences is: its score is their noisy-or, 1 - prod(1 - score). Weights are trained
on document labels alone, through the noisy-or; the sentences with the highest scores are
the offending ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevigil.llm.store import remainder, stored

#: The training sample: at most so many labelled documents of either label, of smallest hash.
DOCS_PER_LABEL = 3000
#: Lengths of n-grams, the number of features kept (those that tell the labels apart best, by
#: chi-square), and the fewest training documents that one must stand in.
GRAMS, FEATURES_KEPT, LEAST_DOCS = (4, 5, 6), 3000, 6
#: Entries that a task holds before it hands out its counts.
COUNTED_AT_ONCE = 300_000
#: Gradient steps, their size, the pull of weights towards 0, and where the bias starts.
STEPS, RATE, PULL, BIAS = 200, 0.2, 2e-4, -4.0
#: Sentences of this score or more are offending ones, as documents are predicted toxic at 0.5.
OFFENDING = 0.5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> list[tuple[int, list[str]]]:
    """First character and distinct lower-cased words of each sentence that has words."""
    found = ((m.start(), sorted(set(_WORD.findall(m[0].lower())))) for m in _SENTENCE.finditer(text or ""))
    return [(at, own) for at, own in found if own]


def features(word: str) -> set[str]:
    """The marked word, and its character n-grams with the word's ends marked."""
    marked = f"<{word}>"
    return {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    base: float  # score of a text without sentences: the share of label 1
    known: dict[str, float] = field(default_factory=dict)  # sums of words seen so far

    def _weight(self, word: str) -> float:
        if len(self.known) > 300_000:
            self.known.clear()
        total = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return total

    def sentence_scores(self, text: str | None) -> tuple[list[int], np.ndarray]:
        parts, known = sentences(text), self.known
        logits = [sum(known[w] if w in known else self._weight(w) for w in own) for _, own in parts]
        return [at for at, _ in parts], 1 / (1 + np.exp(-np.clip(np.array(logits, dtype=float) + self.bias, -30, 30)))

    def score(self, text: str | None) -> tuple[float, int | None, float | None]:
        """The document's score, and the place and score of its worst sentence."""
        return self.located(text)[:3]

    def located(self, text: str | None) -> tuple[float, int | None, float | None, list[tuple[int, float]]]:
        """`score`, and the place and score of every offending sentence, in order of the text."""
        at, scores = self.sentence_scores(text)
        if not at:
            return self.base, None, None, []
        worst = int(np.argmax(scores))
        total = -np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum())
        offending = [(at[i], float(scores[i])) for i in np.flatnonzero(scores >= OFFENDING)]
        return float(total), at[worst], float(scores[worst]), offending


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list[str]]]]:
    """Label and sentences of the documents of a sample with columns `toxic` and `text`."""
    for batch in batches:
        for label, text in zip(batch.column(0), batch.column(1), strict=True):
            yield label.as_py(), [own for _, own in sentences(text.as_py())]


def chosen_features(sample: DataFrame) -> dict[str, int]:
    """Numbers of the features that tell the labels of a sample (`toxic`, `text`) apart best.

    Counted in the tasks and summed by Spark; only the chosen ones reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *(pa.array([n[i] for n in found.values()], pa.int64()) for i in (0, 1))],
                ["feature", "n0", "n1"],
            )

        for label, doc in _texts(batches):
            own: set[str] = set()
            for word in {w for sentence in doc for w in sentence}:
                own |= features(word)
            for f in own:
                found.setdefault(f, [0, 0])[label] += 1
            if len(found) > COUNTED_AT_ONCE:
                yield counted()
                found = {}
        yield counted()

    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = float(n.get(0, 0)), float(n.get(1, 0))
    if not n0 or not n1:
        return {}
    counts = sample.select("toxic", "text").mapInArrow(run, "feature string, n0 bigint, n1 bigint").groupBy("feature")
    counts = counts.agg(F.sum("n0").cast("double").alias("none"), F.sum("n1").cast("double").alias("one"))
    total = F.col("none") + F.col("one")
    apart = F.pow(F.col("one") * n0 - F.col("none") * n1, 2)
    chi = (n0 + n1) * apart / F.greatest(total * (F.lit(n0 + n1) - total) * (n1 * n0), F.lit(1.0))
    best = counts.where(total >= LEAST_DOCS).orderBy(chi.desc(), "feature").limit(FEATURES_KEPT).select("feature").collect()
    return {r["feature"]: i for i, r in enumerate(best)}


def _encoded(sample: DataFrame, chosen: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """The sample as numbers: `toxic`, `lengths`, `words` per document with sentences, the words
    (64-bit hashes) that have chosen features sentence by sentence; and `word`, `ids` per word."""
    shared = sample.sparkSession.sparkContext.broadcast(chosen)

    def chosen_ids(of: dict[str, list[int]], word: str) -> list[int]:
        if word not in of:
            if len(of) > COUNTED_AT_ONCE:
                of.clear()
            of[word] = sorted(shared.value[f] for f in features(word) if f in shared.value)
        return of[word]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, list[int]] = {}
        for label, doc in _texts(batches):
            if not doc:
                continue
            kept = [[xxhash.xxh64_intdigest(w) for w in own if chosen_ids(of, w)] for own in doc]
            words = np.array([w for own in kept for w in own], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([label], pa.int32()), pa.array([[len(k) for k in kept]], pa.list_(pa.int32())), pa.array([words.tobytes()])],
                ["toxic", "lengths", "words"],
            )

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, list[int]] = {}
        for _, doc in _texts(batches):
            own = [w for w in {w for sentence in doc for w in sentence} if w not in of and chosen_ids(of, w)]
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in own], dtype=np.uint64).astype(np.int64)
            ids = [np.array(of[w] if w in of else chosen_ids(of, w), dtype="<i4").tobytes() for w in own]
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(ids, pa.binary())], ["word", "ids"])

    rows = sample.select("toxic", "text")
    found = rows.mapInArrow(table, "word bigint, ids binary").groupBy("word").agg(F.min("ids").alias("ids"))
    return rows.mapInArrow(documents, "toxic int, lengths array<int>, words binary"), found


def train(sample: DataFrame, base: float) -> Model:
    """Weights by gradient steps (Adam) on the likelihood of the labels under the noisy-or.

    `sample` (`toxic`, `text`) is turned into numbers by Spark; the driver gets, of its
    documents, 8 bytes a word with chosen features, and each distinct such word's features.
    `base`: score of texts without sentences, and of all texts if the labels do not differ.
    """
    chosen = chosen_features(sample)
    found, table = _encoded(sample, chosen)
    docs = found.orderBy("toxic", "words").collect()
    y = np.array([r["toxic"] for r in docs])
    if not chosen or not len(y) or y.min() == y.max():
        return Model({}, float(np.log((base + 1e-6) / (1 - base + 1e-6))), base)
    size = len(chosen) + 1
    per_doc = [len(r["lengths"]) for r in docs]
    doc = np.repeat(np.arange(len(docs)), per_doc)  # of each sentence
    lengths = np.concatenate([np.array(r["lengths"], dtype=np.int64) for r in docs])
    sentence = np.repeat(np.arange(len(doc)), lengths)  # of each word in a text
    entries = table.orderBy("word").collect()
    names = np.array([r["word"] for r in entries], dtype=np.int64)
    word = np.searchsorted(names, np.concatenate([np.frombuffer(r["words"], dtype="<u8") for r in docs]).astype(np.int64))
    row = np.repeat(np.arange(len(entries)), [len(r["ids"]) // 4 for r in entries])  # word of each (word, feature)
    column = np.frombuffer(b"".join(bytes(r["ids"]) for r in entries), dtype="<i4").astype(np.intp)
    theta = np.zeros(size)
    theta[-1] = BIAS
    first, second = np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        of_word = np.bincount(row, theta[column], minlength=len(names))
        z = np.bincount(sentence, of_word[word], minlength=len(doc)) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        any_ = np.maximum(-np.expm1(none), 1e-9)
        slope = np.where(y == 1, -np.exp(none) / any_, 1.0)[doc] * p / len(y)
        by_word = np.bincount(word, slope[sentence], minlength=len(names))
        gradient = np.bincount(column, by_word[row], minlength=size)
        gradient[-1] += slope.sum()
        gradient[:-1] += PULL * theta[:-1] / len(chosen)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model({f: float(theta[i]) for f, i in chosen.items()}, float(theta[-1]), base)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Trained on labelled documents whose crc32(doc_id) mod 5 is not 0.

    At most `DOCS_PER_LABEL` documents of either label are learned from. If a document has
    several labels the largest counts; rows of a label with NULL id or label are left out,
    and of documents that share an id one is taken, by its text's hash.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder("doc_id", 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = [
        known.where(F.col("toxic") == value).orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(DOCS_PER_LABEL)
        for value in (0, 1)
    ]
    # at most 2 * DOCS_PER_LABEL pairs of numbers
    chosen = stored(drawn[0].unionByName(drawn[1]), "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one_each = rows.groupBy("doc_id", F.col("toxic").cast("int").alias("toxic")).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    base = known.agg(F.avg("toxic")).first()[0] or 0.0
    return train(stored(one_each, "labelled"), float(base))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: `doc_id`, `score`, the first character and score of the worst sentence, and, as
    `offending`, those of every sentence that scores `OFFENDING` or more (none: an empty array)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            found = [own.located(text.as_py()) for text in batch.column(1)]
            arrays = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.float64(), pa.int64(), pa.float64()))]
            places = [[{"start": at, "score": score} for at, score in f[3]] for f in found]
            arrays.append(pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "score", "worst_at", "worst_score", "offending"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    offending = "offending array<struct<start:bigint,score:double>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, worst_at bigint, worst_score double, {offending}")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of `op5_toxicity`, the place and score of each text's worst sentence, and, as
    `offending_at`, the places of all offending ones, comma-joined (none: empty).

    NULL, empty and wordless texts get the share of label 1 among the training documents.
    Without labels, or with labels of one kind, all texts get about that share.
    """
    return scored(docs, fit(docs, labels)).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "worst_at",
        "worst_score",
        F.array_join(F.transform("offending", lambda o: o["start"].cast("string")), ",").alias("offending_at"),
    )
