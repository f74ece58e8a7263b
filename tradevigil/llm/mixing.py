"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its target share of the corpus's characters over
the characters it has. A document's number of copies is the inverse of the Poisson
distribution with that mean at a number drawn from a hash of the document, so a run that
is repeated draws the same. Copies are shuffled over the whole corpus by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradevigil.llm.store import stored

SEED = "mix-1"
#: Targets are proportional to a source's size to this power: below 1, small sources rise.
FLATTEN = 0.5
#: Means above this are drawn as a sum of so small ones, as exp(-mean) would vanish.
MOST_AT_ONCE = 64.0
SPREAD = 4  # leading hex digits by which shuffled copies are numbered


def sizes(docs: DataFrame) -> DataFrame:
    """`source` (NULL is a source of its own) and its `chars`."""
    chars = F.sum(F.length(F.coalesce("text", F.lit(""))).cast("bigint")).alias("chars")
    return docs.groupBy("source").agg(chars)


def flattened(found: DataFrame, power: float = FLATTEN) -> DataFrame:
    """Target weights by rule: size to the power."""
    return found.select("source", F.pow(F.col("chars").cast("double"), F.lit(power)).alias("weight"))


def rates(found: DataFrame, targets: DataFrame) -> DataFrame:
    """`source`, `rate`, `draws`, `levels` (distribution of one draw, up to a tail below 2**-53).

    Weights are taken relative to the sum over the sources that have text; sources without
    text, without a weight or with weight 0 get rate 0.
    """
    aim = targets.groupBy(F.col("source").alias("aim")).agg(F.max("weight").alias("weight"))
    both = found.join(aim, F.col("source").eqNullSafe(F.col("aim")), "left")
    usable = F.when((F.col("chars") > 0) & (F.col("weight") > 0), F.col("weight")).otherwise(F.lit(0.0))
    both = both.select("source", F.col("chars").cast("double").alias("chars"), usable.alias("weight"))
    total = both.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weights"))
    rate = F.when(F.col("weight") > 0, F.col("weight") / F.col("all_weights") * F.col("all_chars") / F.col("chars")).otherwise(F.lit(0.0))
    # the sums are one row, whatever the number of sources
    rows = both.join(F.broadcast(total)).select("source", rate.alias("rate"))
    rows = rows.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_AT_ONCE)).cast("int"))
    rows = rows.withColumn("mean", F.col("rate") / F.col("draws"))
    return rows.withColumn("levels", _levels(F.col("mean"))).drop("mean")


def _levels(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ..."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    none = F.exp(-mean)
    start = F.struct(F.array(none).alias("all"), none.alias("p"), none.alias("sum"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(F.concat(s["all"], F.array(s["sum"] + p)).alias("all"), p.alias("p"), (s["sum"] + p).alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["all"])


def _mix_key(docs: DataFrame) -> Column:
    doc_id = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    return F.concat_ws(":", F.lit(SEED), doc_id, F.md5(F.coalesce(docs["text"], F.lit(""))))


def _uniform(text: Column) -> Column:
    """A number in [0, 1) with 52 bits."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def replicated(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """`docs`, each row as often as drawn, with `_mix_copy` (from 1), `_mix_copies` and `_mix_order` (hex).

    `docs` has no column of a name that starts with `_mix_` (see `shuffled` for any names).
    A document drawn 0 times is left out: that is the method. Rates come from all rows.
    Repeated rows are drawn alike. NULL text is empty; no rows: no rows. The rates are
    stored and joined by their measured size, so a hot source needs no shuffle.
    """
    found = stored(sizes(docs), "sizes")
    per_source = stored(rates(found, targets if targets is not None else flattened(found)), "rates")
    per_source = per_source.select(*[F.col(c).alias(f"_mix_{c}") for c in per_source.columns])
    rows = docs.withColumn("_mix_key", _mix_key(docs))
    rows = rows.join(per_source, docs["source"].eqNullSafe(per_source["_mix_source"]))
    levels = F.col("_mix_levels")

    def drawn(part: Column) -> Column:
        u = _uniform(F.concat_ws(":", "_mix_key", F.lit("draw"), part.cast("string")))
        return F.size(F.filter(levels, lambda level: level <= u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("_mix_draws")), F.lit(0), lambda n, part: n + drawn(part))
    rows = rows.withColumn("_mix_copies", copies).where("_mix_copies > 0")
    rows = rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    order = F.md5(F.concat_ws(":", "_mix_key", F.lit("order"), F.col("_mix_copy").cast("string")))
    return rows.withColumn("_mix_order", order).select(*[docs[c] for c in docs.columns], "_mix_copy", "_mix_copies", "_mix_order")


def shuffled(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The drawn rows with the columns of `docs`, in their shuffled order over all partitions.

    Rows travel as one column, so `docs` may have columns of any name. NULLs, repeated rows and
    no rows as in `replicated`.
    """
    packed = docs.select("doc_id", "text", "source", F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = replicated(packed, targets).repartitionByRange("_mix_order", "doc_id")
    return rows.sortWithinPartitions("_mix_order", "doc_id").select("row.*")


def numbered(rows: DataFrame) -> DataFrame:
    """`position` of each drawn row in the shuffled order, from 0.

    Rows are ranked inside 16**SPREAD ranges of the hash, and the ranges' counts summed up,
    so no task sees more than its even share. Equal rows may change places.
    """
    ranged = rows.withColumn("_mix_range", F.substring("_mix_order", 1, SPREAD))
    counts = ranged.groupBy("_mix_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_mix_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_mix_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_offset"))
    inside = F.row_number().over(Window.partitionBy("_mix_range").orderBy("_mix_order", "doc_id"))
    placed = ranged.withColumn("_mix_inside", inside).join(F.broadcast(offsets), "_mix_range")
    return placed.withColumn("position", F.col("_mix_offset") + F.col("_mix_inside") - 1)


def report(docs: DataFrame) -> DataFrame:
    """The columns of `op10_source_mixing`: one row per copy."""
    narrow = docs.select("doc_id", "text", "source")
    rows = replicated(narrow).drop("text")
    return numbered(rows).select(
        "doc_id", "source", F.col("_mix_copies").cast("bigint").alias("n_copies"), F.col("_mix_copy").cast("bigint").alias("copy"), "position"
    )


REPORT_SQL = """
WITH RECURSIVE found AS (
  SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS chars FROM documents GROUP BY source),
weights AS (SELECT source, chars, CASE WHEN chars > 0 THEN pow(chars, 0.5) ELSE 0 END AS weight FROM found),
rates AS (
  SELECT source, CASE WHEN weight > 0 THEN weight / sum(weight) OVER () * sum(chars) OVER () / chars ELSE 0 END AS rate FROM weights),
means AS (SELECT source, CAST(greatest(1, ceil(rate / 64)) AS INT) AS draws, rate / greatest(1, ceil(rate / 64)) AS mean FROM rates),
levels AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS level FROM means
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), level + p * mean / (k + 1) FROM levels WHERE k < ceil(mean + 12 * sqrt(mean) + 40)),
keyed AS (
  SELECT row_number() OVER () AS rid, doc_id, source, draws,
    'mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS k
  FROM documents JOIN means USING (source)),
drawn AS (SELECT *, unnest(range(1, draws + 1)) AS part FROM keyed),
uniform AS (SELECT *, CAST('0x' || substr(md5(k || ':draw:' || part), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM drawn),
counted AS (
  SELECT rid, any_value(d.doc_id) AS doc_id, any_value(d.source) AS source, any_value(d.k) AS k, count(*) AS n
  FROM uniform d JOIN levels l ON d.source = l.source AND l.level <= d.u GROUP BY rid),
copies AS (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)
SELECT doc_id, source, n AS n_copies, copy,
  row_number() OVER (ORDER BY md5(k || ':order:' || copy), doc_id) - 1 AS position
FROM copies
"""
