"""Benchmark decontamination by winnowing.

Any `window` consecutive words that a document shares with a benchmark item are found: of
the hashes of all `gram`-word runs inside a window the smallest is kept (the last of equal
ones), so equal windows keep the same run at the same offset. Kept runs of both sides are
joined, and each meeting is extended to the whole window and compared word by word. An
item of fewer words than a window is one window of its own, found by its whole hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradevigil.llm import words
from tradevigil.llm.store import stored
from tradevigil.session import small_batches

WINDOW, GRAM = 10, 5
#: Bits of the filter that document hashes pass before the join: 512 kB, whatever the
#: number of items. More items fill it and let more rows through to the (exact) join.
FILTER_BITS = 22
_FOUND = "array<struct<fp:bigint,at:int,first:int,size:int,near:array<string>>>"


def kept_runs(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Hash, position, first and last window start of each kept run of a text's words."""
    grams = words.gram_hashes(hashes, gram)
    wide = window - gram + 1
    count = len(grams) - wide + 1
    if count <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    best, at = grams[:count].copy(), np.arange(count)
    for j in range(1, wide):
        other = grams[j : j + count]
        lower = other <= best
        best[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + j
    first = np.flatnonzero(np.diff(at, prepend=-1) != 0)
    last = np.append(first[1:], count) - 1
    return best[first], at[first], first, last


def _runs(hashes: np.ndarray, sizes: list[int], window: int, gram: int):
    """Kept runs for whole windows, and every run of the short items' sizes."""
    yield (window, *kept_runs(hashes, window, gram))
    for size in sizes:
        own = words.gram_hashes(hashes, size)
        at = np.arange(len(own))
        yield (size, words.mix(own + np.uint64(size)), at, at, at)


def _text(parts: list[bytes]) -> list[str]:
    return [p.decode("utf-8", "surrogatepass") for p in parts]


def windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """`fp`, `size`, `offset` of the kept run, `words` and `item_id` of each item's windows."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = words.split(text, words.ALNUM)
                data = b" ".join(parts)
                hashes = words.word_hashes(data, *words.spans(data))
                n = len(parts)
                short = [n] if 0 < n < window else []
                for size, fp, at, first, last in _runs(hashes, short, window, gram):
                    for f, p, a, z in zip(fp.view(np.int64).tolist(), at.tolist(), first.tolist(), last.tolist(), strict=True):
                        for s in range(a, z + 1):
                            text = " ".join(_text(parts[s : s + size]))
                            out.append({"fp": f, "size": size, "offset": p - s, "words": text, "item_id": item})
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    shape = pa.schema(
        [("fp", pa.int64()), ("size", pa.int32()), ("offset", pa.int32()), ("words", pa.string()), ("item_id", _arrow(kind))]
    )
    rows = items.select("item_id", "text")
    return rows.mapInArrow(run, f"fp bigint, size int, offset int, words string, item_id {kind}")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _filter(known: DataFrame) -> np.ndarray:
    """Bits of the items' hashes; at most 2**FILTER_BITS numbers reach the driver."""
    bits = known.select(F.pmod("fp", F.lit(1 << FILTER_BITS)).cast("int").alias("bit")).distinct()
    seen = np.zeros(1 << FILTER_BITS, dtype=bool)
    seen[bits.toPandas()["bit"].to_numpy(dtype=np.int64)] = True
    return np.packbits(seen)


def _meetings(docs: DataFrame, seen: np.ndarray, sizes: list[int], window: int, gram: int) -> DataFrame:
    """`n_words` of each row, and its kept runs that pass the filter with the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(seen).astype(bool)
        for batch in batches:
            counts, found = [], []
            for text in batch.column(1):
                data = words.fold(text.as_py(), words.ALNUM)
                starts, ends = words.spans(data)
                counts.append(len(starts))
                hashes = words.word_hashes(data, starts, ends)
                near = []
                for size, fp, at, first, last in _runs(hashes, sizes, window, gram):
                    hit = np.flatnonzero(passes[(fp & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
                    for x in hit.tolist():
                        a, z = int(first[x]), int(last[x]) + size
                        around = data[starts[a] : ends[z - 1]].split()
                        near.append({"fp": int(fp[x].view(np.int64)), "at": int(at[x]), "first": a, "size": size, "near": _text(around)})
                found.append(near)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, shape)], ["doc_id", "n_words", "found"]
            )

    shape = pa.list_(
        pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("size", pa.int32()), ("near", pa.list_(pa.string()))])
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, found {_FOUND}")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of `docs`: `doc_id`, `n_words`, `n_hit`, `item_ids` (array of text), `n_items`.

    A word is hit if it lies in an occurrence of an item's window. NULL and empty texts
    have no words; items without words have no window; repeated rows each get a row;
    repeated items count once per id, items with a NULL id hit words but are not listed.
    Documents' texts are read once and never shuffled: only runs that pass the items' filter
    move, with the words around them. Equal windows of many items are joined as one.
    """
    small_batches(docs.sparkSession)
    known = stored(windows(items, window, gram), "windows")
    sizes = [r[0] for r in known.where(F.col("size") < window).select("size").distinct().collect()]
    rows = _meetings(docs, _filter(known), sorted(sizes), window, gram)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "runs")

    distinct = known.groupBy("fp", "size", "offset", "words").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids")
    )
    distinct = distinct.select("*", F.xxhash64("words").alias("word_key"))
    runs = rows.select("row", F.explode("found").alias("r")).select("row", "r.*").withColumnRenamed("size", "n")
    start = F.col("at") - F.col("offset")
    match = (
        (runs["fp"] == distinct["fp"])
        & (F.col("n") == F.col("size"))
        & (start >= F.col("first"))
        & (start - F.col("first") + F.col("n") <= F.size("near"))
        & (F.array_join(F.slice("near", F.greatest(F.lit(0), start - F.col("first")) + 1, F.col("n")), " ") == F.col("words"))
    )
    hits = runs.join(distinct, match).select("row", start.alias("start"), (start + F.col("n")).alias("stop"), "ids")
    hits = stored(hits, "hits")

    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    places = hits.select("row", "start", "stop").distinct()
    new = places.withColumn("reached", F.coalesce(F.max("stop").over(before), F.col("start")))
    new = new.select("row", F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached")).alias("n"))
    hit = new.groupBy("row").agg(F.sum("n").cast("bigint").alias("n_hit"))
    ids = hits.select("row", "ids").distinct().select("row", F.explode("ids").alias("item"))
    ids = ids.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    out = rows.select("row", "doc_id", "n_words").join(hit, "row", "left").join(ids, "row", "left")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), item_ids.alias("item_ids"), F.size(item_ids).cast("bigint").alias("n_items")
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of `docs` that share no window with an item; all columns are kept."""
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("doc_id"), "text")
    bad = contamination(keyed, items, window, gram).where("n_hit > 0").select(F.col("doc_id").alias("_hit_text")).distinct()
    return docs.join(bad, own == bad["_hit_text"], "left_anti")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of `op3_decontamination`."""
    return contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same rows from a plain comparison of all windows.
REPORT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) AS win
  FROM docs, sizes WHERE len(w) >= n),
hits AS (SELECT rid, i, g.n, item_id FROM grams g JOIN wins USING (n, win)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
ids AS (
  SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""
