"""SimHash near-duplicates by anchor-point covering.

A fingerprint's 64 bits are cut into segments. On each segment the words of a covering
code are the anchors: every value is within the code's covering radius R of its nearest
anchor, its home. If two values differ by at most d bits, the home of one is within R + d
of the other; so when each value is sent to every anchor within R + d, every such pair
meets at a home. A segment's allowance d is chosen so that no pair escapes: allowances
that sum to at least `threshold - (segments - 1)` cannot all be exceeded by `threshold`
differing bits. Anchors are perfect codes, so few are in reach: the Golay code on 23
bits (R = 3), the Hamming code on 15 bits (R = 1), and all words of 18 bits (R = 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevigil.llm import words
from tradevigil.llm.components import components
from tradevigil.llm.store import free_names, stored
from tradevigil.session import small_batches

#: A cell of an anchor's pairs has about so many homes and members at most.
CELL_HOMES, CELL_MEMBERS = 4096, 32768
_CHUNK = 1 << 16  # shingles hashed at a time


# ---- fingerprints ------------------------------------------------------------


def simhash(text: str | None, shingle: int) -> int:
    """64 bits: 1 where more than half of the shingles' XXH64 (seed 42) have a 1.

    Shingles are `shingle` words joined by a space, repeats included; a text of fewer
    words is one shingle, one without words has fingerprint 0.
    """
    data = b" ".join(words.split(text, words.SPACED))
    if not data:
        return 0
    starts, ends = words.spans(data)
    k = min(shingle, len(starts))
    bounds = zip(starts[: len(starts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    grams = (data[s:e] for s, e in bounds)
    ones, n, digest = np.zeros(64, dtype=np.int64), 0, xxhash.xxh64_intdigest
    while True:
        hashes = np.fromiter((digest(g, 42) for _, g in zip(range(_CHUNK), grams)), dtype="<u8")
        if not len(hashes):
            break
        n += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """`doc_id`, `text_key` (hash of the text, NULL as empty) and `fp` of each row."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t.as_py(), shingle) for t in batch.column(2)]
            values = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], ["doc_id", "text_key", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, fp bigint")


# ---- anchors -----------------------------------------------------------------


@dataclass(frozen=True)
class Segment:
    """A linear code on `bits` bits from `shift` on: syndromes, and the patterns that lead
    from a value of each syndrome to the anchors within reach, nearest first."""

    shift: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    offsets: np.ndarray
    counts: np.ndarray
    patterns: np.ndarray


_GOLAY = 0xAE3  # generator polynomial of the binary Golay code, a fixed value


def _checks(code: str) -> tuple[int, list[int], int]:
    """Bits, the syndrome of each bit, and the covering radius."""
    if code == "golay":
        columns, rest = [], 1
        for _ in range(23):
            columns.append(rest)
            rest <<= 1
            if rest >> 11:
                rest ^= _GOLAY
        return 23, columns, 3
    if code == "hamming":
        return 15, list(range(1, 16)), 1
    return 18, [0] * 18, 0


def _sums(columns: list[int]) -> np.ndarray:
    """XOR of the chosen columns for every choice."""
    out = np.zeros(1, dtype=np.int64)
    for c in columns:
        out = np.concatenate([out, out ^ c])
    return out


def segment(shift: int, code: str, allowance: int) -> Segment:
    bits, columns, radius = _checks(code)
    found = [
        (sum(1 << i for i in chosen), weight)
        for weight in range(radius + allowance + 1)
        for chosen in combinations(range(bits), weight)
    ]
    patterns = np.array([p for p, _ in found], dtype=np.int64)
    weights = np.array([w for _, w in found])
    low, high = _sums(columns[:12]), _sums(columns[12:])
    of = low[patterns & 0xFFF] ^ high[patterns >> 12]
    order = np.lexsort((weights, of))
    counts = np.bincount(of, minlength=1 << max(columns).bit_length())
    return Segment(shift, bits, low, high, np.cumsum(counts) - counts, counts, patterns[order])


def segments(threshold: int) -> list[Segment]:
    """Three segments whose allowances leave no pair of `threshold` differing bits out."""
    spare = max(0, threshold - 2)
    a, b, c = (spare + 2) // 3, (spare + 1) // 3, spare // 3
    return [segment(0, "golay", a), segment(23, "golay", b), segment(46, "hamming" if c else "all", c)]


def reach(values: np.ndarray, seg: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index into `values`, anchor, and whether it is the home, for each anchor in reach."""
    part = (values >> np.uint64(seg.shift)).astype(np.int64) & ((1 << seg.bits) - 1)
    of = seg.low[part & 0xFFF] ^ seg.high[part >> 12]
    counts = seg.counts[of]
    index = np.repeat(np.arange(len(values)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return index, part[index] ^ seg.patterns[seg.offsets[of][index] + within], within == 0


def anchored(fps: DataFrame, threshold: int) -> DataFrame:
    """`part`, `anchor`, `home`, `fp`: each fingerprint at each anchor in reach."""
    segs = segments(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for block in np.array_split(values, len(values) // 4096 + 1):
                for part, seg in enumerate(segs):
                    index, anchor, home = reach(block, seg)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(index), part, dtype=np.int8)),
                            pa.array(anchor.astype(np.int32)),
                            pa.array(home),
                            pa.array(block[index].view(np.int64)),
                        ],
                        ["part", "anchor", "home", "fp"],
                    )

    return fps.select("fp").mapInArrow(run, "part tinyint, anchor int, home boolean, fp bigint")


def _cells(rows: DataFrame) -> DataFrame:
    """Adds the cell (`i`, `j`): a large anchor's homes x members are cut into a grid.

    The sizes of all anchors are counted. There are at most 2**18 + 2 * 2**12 of them, so
    the list of the large ones has a bound and can be broadcast.
    """
    large = (
        rows.groupBy("part", "anchor")
        .agg(F.count(F.lit(1)).alias("members"), F.count_if("home").alias("homes"))
        .where((F.col("members") > CELL_MEMBERS) | (F.col("homes") > CELL_HOMES))
        .select(
            "part",
            "anchor",
            F.ceil(F.col("homes") / CELL_HOMES).cast("int").alias("n_i"),
            F.ceil(F.col("members") / CELL_MEMBERS).cast("int").alias("n_j"),
        )
    )
    sized = rows.join(F.broadcast(large), ["part", "anchor"], "left").withColumns(
        {"n_i": F.greatest(F.lit(1), F.coalesce("n_i", F.lit(1))), "n_j": F.greatest(F.lit(1), F.coalesce("n_j", F.lit(1)))}
    )
    mine = F.xxhash64(F.lit("cell"), "fp")
    i, j = F.pmod(mine, F.col("n_i")).cast("int"), F.pmod(mine, F.col("n_j")).cast("int")
    as_member = F.transform(
        F.sequence(F.lit(0), F.col("n_i") - 1),
        lambda x: F.struct(x.alias("i"), j.alias("j"), (F.col("home") & (F.col("n_i") * F.col("n_j") == 1)).alias("home"), F.lit(True).alias("member")),
    )
    as_home = F.transform(
        F.sequence(F.lit(0), F.col("n_j") - 1),
        lambda x: F.struct(i.alias("i"), x.alias("j"), F.lit(True).alias("home"), F.lit(False).alias("member")),
    )
    split = F.col("home") & (F.col("n_i") * F.col("n_j") > 1)
    places = F.when(split, F.concat(as_member, as_home)).otherwise(as_member)
    return sized.select("part", "anchor", "fp", F.explode(places).alias("at")).select("part", "anchor", "at.*", "fp")


def forest(homes: np.ndarray, members: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever links of `homes` to `members` connect; no others.

    There are fewer of them than different fingerprints, however many differ little.
    """
    a = [np.zeros(0, dtype=np.uint64)]
    b = [np.zeros(0, dtype=np.uint64)]
    label = np.unique(np.concatenate([homes, members]), return_inverse=True)[1]
    mine, label = label[: len(homes)], label[len(homes) :]
    width = max(1, (1 << 22) // max(1, len(members)))
    for at in range(0, len(homes), width):
        block = homes[at : at + width]
        near = np.bitwise_count(block[:, None] ^ members[None, :]) <= threshold
        own = np.isin(block, members)
        for row in np.flatnonzero(near.sum(axis=1) > own):
            home = at + row
            linked = np.flatnonzero(near[row])
            linked = linked[label[linked] != mine[home]]
            if not len(linked):
                continue
            labels, first = np.unique(label[linked], return_index=True)
            a.append(np.full(len(first), homes[home]))
            b.append(members[linked[first]])
            label[np.isin(label, labels)] = mine[home]
            mine[np.isin(mine, labels)] = mine[home]
    return np.concatenate(a), np.concatenate(b)


def _matched(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Forest of each cell; rows arrive in order of their cell."""
    names = ["part", "anchor", "i", "j"]
    rest: list[pa.RecordBatch] = []

    def edges(rows: pa.Table) -> pa.RecordBatch:
        fp = rows["fp"].to_numpy().view(np.uint64)
        home, member = rows["home"].to_numpy(), rows["member"].to_numpy()
        keys = np.stack([rows[n].to_numpy().astype(np.int64) for n in names])
        cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
        spans = zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True)
        found = [forest(fp[s:e][home[s:e]], fp[s:e][member[s:e]], threshold) for s, e in spans]
        sides = [np.concatenate(x) for x in zip(*found, strict=True)] or [np.zeros(0, dtype=np.uint64)] * 2
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in sides], ["a", "b"])

    def key(batch: pa.RecordBatch, row: int) -> list:
        return [batch.column(n)[row].as_py() for n in names]

    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and key(rest[-1], rest[-1].num_rows - 1) == key(batch, batch.num_rows - 1):
            rest.append(batch)  # one cell goes on; a cell has a bounded number of rows
            continue
        last = key(batch, batch.num_rows - 1)
        cut = batch.num_rows - 1
        step = np.ones(batch.num_rows, dtype=bool)
        for n, v in zip(names, last, strict=True):
            step &= batch.column(n).to_numpy(zero_copy_only=False) == v
        cut = int(np.argmax(step))
        whole = [*rest, batch.slice(0, cut)]
        if sum(x.num_rows for x in whole):
            yield edges(pa.Table.from_batches(whole))
        rest = [batch.slice(cut)]
    if rest:
        yield edges(pa.Table.from_batches(rest))


def links(fps: DataFrame, threshold: int) -> DataFrame:
    """`a`, `b`: links between different fingerprints that differ in `threshold` bits or fewer.

    Not all of them (a group of n would have n * n / 2): per cell those of a spanning
    forest, so that `components` of the result are those of all links.
    """
    unique = fps.select("fp").where("fp IS NOT NULL").distinct()
    order = ["part", "anchor", "i", "j"]
    laid = _cells(anchored(unique, threshold)).repartition(*order).sortWithinPartitions(*order)
    return laid.mapInArrow(lambda b: _matched(b, threshold), "a bigint, b bigint").distinct()


def _rooted(rows: DataFrame, threshold: int, first: Column) -> DataFrame:
    """`fp`, `root` (a fingerprint of its group) and the least `first` of the rows with that fingerprint."""
    found = components(links(rows, threshold)).withColumnRenamed("node", "fp")
    classes = rows.groupBy("fp").agg(F.min(first).alias("first"))
    return classes.join(found, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, threshold: int = 4) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` of every row.

    Rows link at `threshold` or fewer differing bits; `component_id` is the smallest doc_id
    reachable, the row's own included. NULL text is empty; a text without words has
    fingerprint zero and links like any other; repeated rows each get a row. NULL ids take
    part, but are no component's name unless all of its ids are NULL. No rows: no rows.
    """
    rows = stored(fingerprints(docs, shingle), "simhash")
    rooted = _rooted(rows, threshold, F.col("doc_id"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle: int = 4, threshold: int = 4) -> DataFrame:
    """`docs` with one row of each group of `near_duplicates`, that with the smallest doc_id.

    Rows without an id come after those with one; of rows with one id that with the smallest
    hash of its text stays, and of repeated rows one. All columns are carried along, whatever
    their names. No rows: no rows.
    """
    rows = stored(fingerprints(docs, shingle), "simhash")
    rooted = _rooted(rows, threshold, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    names = free_names(docs, "kept_id", "kept_text")
    kept = best.select(F.col("best.doc_id").alias(names[0]), F.col("best.text_key").alias(names[1]))
    kept = stored(kept, "kept")
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    stays = docs.join(kept, docs["doc_id"].eqNullSafe(kept[names[0]]) & (own == kept[names[1]]))
    return stays.dropDuplicates(names).select(*[docs[c] for c in docs.columns])
