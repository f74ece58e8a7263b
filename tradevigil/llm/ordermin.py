"""Order MinHash document fingerprints, in DataFrame functions only.

Tokens are runs of non-space characters, cut after `PIECE` of them. Each run of `SHINGLE`
tokens is numbered by its occurrence in the text, and the pair is hashed. The hash values
are dealt to `BINS` bins (one permutation serves all); in each bin the `TUPLE` smallest are
selected and hashed in the order in which they stand in the text. Moving a passage changes
these tuples although the set of runs stays, so likeness follows edit distance.

A run is kept as one bigint, hash above position, so the sorts are of plain numbers. A text
is one row; nothing is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE, TUPLE, BINS, PIECE = 5, 2, 64, 16
#: Bits of a packed run that hold its position: texts of up to 16 million tokens. Later
#: positions count as the last, so their order among each other is not seen.
PLACE = 24
_PLACES = (1 << PLACE) - 1
_BIN_BITS = 6
#: Documents in one range of the neighbour search, and the most ranges.
RANGE_ROWS, MOST_RANGES = 500, 20_000


def _hashes(text: Column) -> Column:
    """Hash of each token."""
    tokens = F.regexp_extract_all(text, F.lit(r"\S{1,%d}" % PIECE), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _runs(hashes: Column) -> Column:
    """Packed runs, sorted by hash and then position; fewer tokens than a run are one run."""
    n = F.size(hashes)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), n - SHINGLE))).otherwise(F.array().cast("array<int>"))

    def packed(i: Column) -> Column:
        run = F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE)])
        return run.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(F.least(i, F.lit(_PLACES)).cast("bigint"))

    return F.sort_array(F.transform(starts, packed))


def _first(runs: Column, i: Column) -> Column:
    """Index of the first run with the hash of run `i`, by bisection."""
    of = F.shiftright(F.get(runs, i), PLACE)
    zero = F.struct(F.lit(0).alias("low"), i.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.shiftright(F.get(runs, middle), PLACE) < of
        return F.when(below, F.struct((middle + 1).alias("low"), s["high"].alias("high"))).otherwise(
            F.struct(s["low"].alias("low"), F.greatest(middle, s["low"]).alias("high"))
        )

    steps = F.ceil(F.log2(F.size(runs) + F.lit(1.0))).cast("int") + 1
    return F.aggregate(F.sequence(F.lit(1), steps), zero, halve, lambda s: s["low"])


def _numbered(runs: Column) -> Column:
    """Bin, hash of (run, occurrence) and position of each run, packed and sorted."""

    def packed(run: Column, i: Column) -> Column:
        of = F.shiftright(run, PLACE)
        again = (i > 0) & (F.shiftright(F.get(runs, F.greatest(i - 1, F.lit(0))), PLACE) == of)
        occurrence = F.when(again, i - _first(runs, i)).otherwise(F.lit(0))
        hashed = F.xxhash64(of, occurrence)
        return hashed.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(run.bitwiseAND(F.lit(_PLACES)))

    return F.sort_array(F.transform(runs, packed))


def _bin(numbered: Column) -> Column:
    return F.shiftrightunsigned(numbered, 64 - _BIN_BITS)


def _smallest(numbered: Column) -> Column:
    """The `TUPLE` smallest of each bin, still sorted."""
    return F.filter(
        numbered,
        lambda x, i: (i < TUPLE) | (_bin(F.get(numbered, F.greatest(i - TUPLE, F.lit(0)))) != _bin(x)),
    )


def _tuples(smallest: Column) -> Column:
    """Per filled bin: its number above 24 bits of the hash of its runs in text order."""

    def packed(x: Column, i: Column) -> Column:
        nearest = F.slice(smallest, i + 1, TUPLE)
        own = F.filter(nearest, lambda y: _bin(y) == _bin(x))
        placed = F.array_sort(F.transform(own, lambda y: F.struct(y.bitwiseAND(F.lit(_PLACES)).alias("at"), y.alias("run"))))
        hashed = F.aggregate(
            placed, F.lit(0).cast("bigint"), lambda h, p: F.xxhash64(h, F.shiftright(p["run"], PLACE))
        )
        head = (i == 0) | (_bin(F.get(smallest, F.greatest(i - 1, F.lit(0)))) != _bin(x))
        value = F.shiftleft(_bin(x), 24).bitwiseOR(hashed.bitwiseAND(F.lit(0xFFFFFF)))
        return F.when(head, value)

    return F.filter(F.transform(smallest, packed), lambda v: v.isNotNull())


def with_signature(df: DataFrame, text: str, to: str) -> DataFrame:
    """Adds the signature of a text column: one number per filled bin, in bin order."""
    # each array is a column of its own: functions over it look back at other elements
    out = df.withColumn("_hashes", _hashes(F.coalesce(text, F.lit(""))))
    out = out.withColumn("_runs", _runs(F.col("_hashes"))).drop("_hashes")
    out = out.withColumn("_numbered", _numbered(F.col("_runs"))).drop("_runs")
    out = out.withColumn("_smallest", _smallest(F.col("_numbered"))).drop("_numbered")
    return out.withColumn(to, _tuples(F.col("_smallest"))).drop("_smallest")


def likeness(a: Column, b: Column) -> Column:
    """Share of bins with equal tuples among those that either has filled; 1 if neither has."""
    bins = F.array_union(F.transform(a, lambda v: F.shiftright(v, 24)), F.transform(b, lambda v: F.shiftright(v, 24)))
    return F.when(F.size(bins) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(bins))


def as_text(signature: Column) -> Column:
    """Eight hex digits per filled bin."""
    return F.array_join(F.transform(signature, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def _ranges(docs: DataFrame) -> list[int]:
    """Bounds that cut the ids into ranges of about `RANGE_ROWS` rows; at most `MOST_RANGES`."""
    n = min(MOST_RANGES, docs.count() // RANGE_ROWS + 1)
    cuts = F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 4 * n)) if n > 1 else F.lit(None)
    return sorted(set(docs.agg(cuts.alias("cuts")).first()["cuts"] or []))


def _in_range(bounds: list[int]) -> Column:
    """Number of bounds below the id; NULL ids come first."""
    of = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<bigint>"), lambda b: b < F.col("doc_id")))
    return F.coalesce(F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(of), F.lit(0))


def _with_neighbours(docs: DataFrame) -> tuple[DataFrame, Column]:
    """`docs` dealt to ranges of ids, and the order inside one (descending doc_id).

    Each range's first row is sent along to the range before it in that order, as its
    `guest`: so the row after a range's last one is at hand, and texts move once.
    """
    order = [F.col("guest"), F.desc_nulls_last("doc_id"), "text"]
    ranged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _in_range(_ranges(docs)).alias("range"))
    firsts = F.max(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id")).alias("top")
    tops = ranged.groupBy("range").agg(firsts).select("range", F.col("top.doc_id").alias("doc_id"))
    # one row per range, of at most MOST_RANGES + 1: a single task can number them
    everywhere = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = F.lead("range").over(Window.orderBy("range"))
    hosts = tops.select("range", F.col("doc_id").alias("top"), F.coalesce(above, F.min("range").over(everywhere)).alias("host"))
    heads = ranged.join(F.broadcast(hosts), "range").where(F.col("doc_id").eqNullSafe(F.col("top")))
    heads = heads.groupBy("range", "host", "doc_id").agg(F.min("text").alias("text"))
    guests = heads.select("doc_id", "text", F.col("host").alias("range"), F.lit(True).alias("guest"))
    rows = ranged.withColumn("guest", F.lit(False)).unionByName(guests)
    return rows, Window.partitionBy("range").orderBy(*order)


def report(docs: DataFrame) -> DataFrame:
    """The columns of `op1_order_minhash`.

    The next document is that with the next smaller doc_id, after the smallest the largest;
    equal ids follow in the order of their texts, NULL ids come last. NULL text is empty.
    Texts of no token have an empty fingerprint, alike to each other (1) and to no other.
    A lone document is its own next one. No rows: no rows.
    """
    rows, order = _with_neighbours(docs)
    after = F.lead("text").over(order)
    rows = rows.withColumn("after", F.coalesce(after, F.lit("")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - int(floor(length(text) / 2)))"), F.expr("left(after, int(floor(length(text) / 2)))"))
    rows = rows.withColumn("edited", F.when(half > 0, edited).otherwise(F.col("text"))).drop("after")
    rows = with_signature(rows, "text", "own")
    rows = with_signature(rows, "edited", "changed")
    rows = rows.select(
        "doc_id", "range", "guest", "text", "own", "changed",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    rows = rows.withColumn("next", F.lead("own").over(order)).where("NOT guest")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
