"""How far apart the sources of a language are, from term counts made by Arrow kernels.

Tasks lower-case, split, dictionary-encode and group whole texts in Arrow and hand on
counts per language, source and term. Spark merges the counts. The kept terms of a
language are then cut into shards of bounded size; each shard is a dense block of counts,
terms by sources, from which the shares and their divergences follow in integers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradevigil.llm.store import stored

#: Whatever is not a letter: ASCII but A-Z and a-z. Everything past ASCII counts as a letter.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
TOP_TERMS = 200
WHOLE = 1_000_000_000
PRIOR = 1

#: Text taken through the kernels at once, counts a task holds, rows and pairs of a shard.
SLICE_BYTES = 8 << 20
COUNTS_HELD = 400_000
SHARD_ROWS = 50_000
SHARD_PAIRS = 1_000_000
DENSE_CELLS = 2_000_000

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_FOUND = "part string, lang string, source string, item string, value bigint"


# ---- counting ----------------------------------------------------------------------


def _terms(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Row number and code of every term of the texts, and the terms the codes stand for."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    coded = pc.list_flatten(parts).dictionary_encode()
    rows, codes = pc.list_parent_indices(parts), coded.indices
    blank = pc.index(coded.dictionary, "").as_py()  # before a first and after a last separator
    if blank >= 0:
        real = pc.not_equal(codes, blank)
        rows, codes = rows.filter(real), codes.filter(real)
    return rows, codes, coded.dictionary


def _pieces(text: str) -> list[str]:
    """A very long text, cut between terms; a single endless term stays whole."""
    step, found, start = SLICE_BYTES // 4, [], 0
    gap = re.compile(SEPARATORS)
    while len(text) - start > step:
        cut = gap.search(text, start + step)
        if not cut:
            break
        found.append(text[start : cut.start()])
        start = cut.end()
    return [*found, text[start:]]


def _per_text(texts: pa.Array) -> pa.Table:
    """`row`, `term`, `n`: how often a term stands in a text."""
    rows, codes, words = _terms(texts)
    found = pa.table({"row": rows, "code": codes}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table(
        {"row": found["row"], "term": words.take(found["code"].combine_chunks()), "n": found["count_all"]}
    )


def _long_text(text: str) -> pa.Table:
    tables = [_per_text(pa.array([piece])) for piece in _pieces(text)]
    whole = pa.concat_tables(tables).group_by(["term"], use_threads=False).aggregate([("n", "sum")])
    return pa.table({"row": pa.array(np.zeros(len(whole), np.int64)), "term": whole["term"], "n": whole["n_sum"]})


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows of at most SLICE_BYTES together, or one row."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes)


def _merged(tables: list[pa.Table]) -> pa.Table:
    coded = pa.concat_tables(tables).unify_dictionaries()
    whole = coded.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns(["lang", "source", "term", "n", "docs"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language, source and term, combined as far as a bounded table allows."""
    held: list[pa.Table] = []
    for batch in batches:
        column = {name: batch.column(name).fill_null("") for name in ("lang", "source", "text")}
        sizes = pc.binary_length(column["text"]).to_numpy(zero_copy_only=False)
        for start, end in _slices(sizes):
            texts = column["text"].slice(start, end - start)
            alone = len(texts) == 1 and sizes[start] > SLICE_BYTES
            found = _long_text(texts[0].as_py()) if alone else _per_text(texts)
            if not len(found):
                continue
            rows = found["row"].combine_chunks()
            coded = pa.table(
                {
                    "lang": column["lang"].slice(start, end - start).dictionary_encode().take(rows),
                    "source": column["source"].slice(start, end - start).dictionary_encode().take(rows),
                    "term": found["term"].dictionary_encode(),
                    "n": found["n"],
                }
            )
            grouped = coded.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
            held.append(grouped.rename_columns(["lang", "source", "term", "n", "docs"]))
            if sum(map(len, held)) > COUNTS_HELD:
                held = [_merged(held)]
                if len(held[0]) > COUNTS_HELD // 2:
                    yield from _plain(held.pop())
    if held:
        yield from _plain(_merged(held))


def _plain(counts: pa.Table) -> Iterator[pa.RecordBatch]:
    plain = [
        c.cast(pa.string()) if pa.types.is_dictionary(c.type) else c.cast(pa.int64()) for c in counts.itercolumns()
    ]
    yield from pa.table(plain, names=counts.column_names).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `source`, `term`, `n` (occurrences), `docs` (documents with it); NULLs read as ''."""
    texts = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    partial = texts.mapInArrow(_partial_counts, _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- divergences -------------------------------------------------------------------


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + PRIOR) / total), three decimal digits at a time: no step leaves 64 bits."""
    left = count + PRIOR
    whole = left // total
    left = left - whole * total
    for _ in range(3):
        left = left * 1000
        digit = left // total
        left = left - digit * total
        whole = whole * 1000 + digit
    return whole + 1


def _shard(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Divergences over one shard's terms: of each own source to each other one, and per term."""
    groups = groups.sort_by("source")
    sources = groups["source"].combine_chunks()
    own = np.flatnonzero(groups["own"].to_numpy())
    terms_kept, lang_total = groups["terms"][0].as_py(), groups["lang_total"][0].as_py()
    below = groups["total"].to_numpy() + PRIOR * terms_kept
    sums = np.zeros((len(own), len(sources)), np.int64)
    items: list[pa.Table] = []
    if len(counts):
        coded = counts["term"].combine_chunks().dictionary_encode()
        at = pc.index_in(counts["source"].combine_chunks(), sources).to_numpy()
        code, n = coded.indices.to_numpy(), counts["n"].to_numpy()
        everywhere = np.zeros(len(coded.dictionary), np.int64)
        everywhere[code] = counts["term_total"].to_numpy()
        wide = max(1, DENSE_CELLS // len(sources))
        order = np.argsort(code, kind="stable")
        code, at, n = code[order], at[order], n[order]
        for first in range(0, len(everywhere), wide):
            last = min(first + wide, len(everywhere))
            low, high = np.searchsorted(code, [first, last])
            dense = np.zeros((len(sources), last - first), np.int64)
            dense[at[low:high], code[low:high] - first] = n[low:high]
            p = _share(dense, below[:, None])
            q = _share(everywhere[first:last], np.int64(lang_total + PRIOR * terms_kept))
            for row, s in enumerate(own):
                for t in range(len(sources)):
                    gap = p[s] - p[t]
                    sums[row, t] += (gap * gap // p[t]).sum()
                more = np.flatnonzero((dense[s] > 0) & (p[s] > q))
                gap = p[s][more] - q[more]
                items.append(
                    pa.table(
                        {
                            "source": pa.repeat(sources[s], len(more)),
                            "item": coded.dictionary.take(pa.array(more + first)),
                            "value": gap * gap // q[more],
                        }
                    )
                )
    row, t = np.nonzero(own[:, None] != np.arange(len(sources)))
    pairs = pa.table({"source": sources.take(pa.array(own[row])), "item": sources.take(pa.array(t)), "value": sums[row, t]})
    found = [("pair", pairs)] + [("term", part) for part in items]
    lang = groups["lang"][0]
    return pa.concat_tables(
        [
            pa.table(
                {"part": pa.repeat(name, len(rows)), "lang": pa.repeat(lang, len(rows)), **{c: rows[c] for c in rows.column_names}}
            )
            for name, rows in found
        ]
    ).cast(pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` and part `term` of every (lang, source).

    `pair` compares a source's shares of all kept terms with each other source of its
    language; `term` lists the `top` terms that it has more of than its language. A
    language's terms are dealt by hash to shards of about SHARD_ROWS counts, and its sources
    to blocks where their pairs are many, so neither a language with most documents nor a term of all
    sources lands in one task. NULL lang, source and text count as ''; a source without terms
    is compared like any other; a language without kept terms gives pairs of value 0;
    repeated rows count each; no documents: no rows.
    """
    counts = stored(term_counts(docs), "term-counts")
    by_lang = counts.groupBy("lang", "term").agg(F.sum("docs").alias("in_docs"), F.sum("n").alias("term_total"))
    by_lang = by_lang.where(F.col("in_docs") >= least_docs).drop("in_docs")
    kept = stored(counts.drop("docs").join(by_lang, ["lang", "term"]), "kept-terms")

    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    occurring = docs.select(*names).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    groups = occurring.join(totals, ["lang", "source"], "left").fillna(0, ["total", "rows"])
    vocabulary = by_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    per_lang = groups.groupBy("lang").agg(
        F.count(F.lit(1)).cast("double").alias("sources"), F.sum("rows").alias("rows"), F.sum("total").alias("lang_total")
    )
    pairs = F.col("sources") * F.col("sources")
    per_lang = (
        per_lang.join(vocabulary, "lang", "left")
        .fillna(0, ["terms"])
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("rows") / F.greatest(F.lit(float(SHARD_ROWS)), pairs))).cast("int"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(pairs / SHARD_PAIRS)).cast("int"))
    )
    per_lang = stored(per_lang.select("lang", "terms", "lang_total", "shards", "blocks"), "languages")

    def cells(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (
        kept.join(per_lang, "lang")
        .withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
        .withColumn("block", cells("blocks"))
        .select("lang", "shard", "block", "source", "term", "n", "term_total")
    )
    right = (
        groups.join(per_lang, "lang")
        .withColumn("home", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
        .withColumn("shard", cells("shards"))
        .withColumn("block", cells("blocks"))
        .select("lang", "shard", "block", "source", "total", "terms", "lang_total", (F.col("home") == F.col("block")).alias("own"))
    )
    key = ["lang", "shard", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_shard, _FOUND)
    found = stored(found, "divergences")
    group = ["lang", "source", "part"]
    summed = found.where("part = 'pair'").groupBy(*group, "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item"))
    ranked = summed.withColumn("rank", place).unionByName(
        found.where("part = 'term'").withColumn("rank", place).where(F.col("rank") <= top)
    )
    return ranked.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def report(docs: DataFrame) -> DataFrame:
    """`op13`: `divergences` with the contract's three documents and 200 terms."""
    return divergences(docs)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REPORT_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
    FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, total FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, sum(n) AS n FROM dense GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, source, term, dense.n,
    CAST(1 + (1000000000 * (dense.n + 1)) // (s.n + v.v) AS BIGINT) AS p, CAST(1 + (1000000000 * (total + 1)) // (v.n + v.v) AS BIGINT) AS q
    FROM dense JOIN s USING (lang, source) JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200"""
