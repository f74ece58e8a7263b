"""Token ids in binary blocks, entropy-coded by a static range asymmetric numeral system.

One frequency table, counted over the whole corpus, serves all blocks. A block holds the
ids of whole documents; they are dealt in turn to `LANES` interleaved states, which code
independently and write 32-bit words to one stream. A block can be decoded alone; inside
it, checkpoints (all states and the place in the stream) every `SEGMENT` ids let each
segment be decoded alone too, and each segment carries the CRC-32 of its ids. Blocks are
rows of Parquet files, beside the ids and lengths of their documents. A block's bytes:

    magic "TRB1", then little-endian uint32: ids, lanes, segments, words
    per segment: uint32 ids' CRC-32, uint32 place in words, uint64 x lanes states
    uint32 x words stream
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradevigil.session import scratch_path, small_batches

SCALE = 20  # frequencies sum to 2**SCALE
LOWER = np.uint64(1 << 31)  # states lie in [2**31, 2**63)
LANES, SEGMENT = 512, 1 << 17
BLOCK = 1 << 18  # ids after which a block ends, at the next end of a document
END_ID = 2
MAGIC = b"TRB1"


# ---- coder -------------------------------------------------------------------


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**SCALE; every id that occurs gets at least 1."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * float(1 << SCALE) / total).astype(np.int64), 0)
    over = int(freq.sum()) - (1 << SCALE)
    for i in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        cut = min(over, int(freq[i]) - 1)
        freq[i] -= cut
        over -= cut
    freq[int(np.argmax(freq))] -= min(over, 0)
    return freq


def encode(ids: np.ndarray, freq: np.ndarray) -> bytes:
    """One block of ids (uint32)."""
    n, below = len(ids), (np.cumsum(freq) - freq).astype(np.uint64)
    f = freq.astype(np.uint64)
    steps = -(-n // LANES)
    of = np.zeros(steps * LANES, dtype=np.intp)
    of[:n] = ids
    of = of.reshape(steps, LANES)
    per = SEGMENT // LANES
    x = np.full(LANES, LOWER, dtype=np.uint64)
    out: list[np.ndarray] = []  # from the last word to the first
    marks, written = [], 0
    scale, half = np.uint64(SCALE), np.uint64(32)
    for t in range(steps - 1, -1, -1):
        live = LANES if (t + 1) * LANES <= n else n - t * LANES
        now = of[t, :live]
        s, ft = x[:live], f[now]
        full = s >= (ft << np.uint64(63 - SCALE))
        if full.any():
            word = s[full].astype(np.uint32)
            out.append(word)
            written += len(word)
            s[full] >>= half
        whole = s // ft
        x[:live] = (whole << scale) + (s - whole * ft) + below[now]
        if t % per == 0:
            marks.append((t, written, x.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, dtype=np.uint32)
    head = MAGIC + struct.pack("<4I", n, LANES, len(marks), len(words))
    body = b"".join(
        struct.pack("<2I", zlib.crc32(ids[t * LANES : t * LANES + SEGMENT].astype("<u4").tobytes()), len(words) - at)
        + state.astype("<u8").tobytes()
        for t, at, state in reversed(marks)
    )
    return head + body + words.astype("<u4").tobytes()


def decode(block: bytes, freq: np.ndarray, only: int | None = None, slots: np.ndarray | None = None) -> np.ndarray:
    """All ids of a block, or those of one segment; ValueError if a checksum fails."""
    if block[:4] != MAGIC:
        raise ValueError("not a block")
    n, lanes, segments, n_words = struct.unpack_from("<4I", block, 4)
    size = 8 + 8 * lanes
    words = np.frombuffer(block, dtype="<u4", count=n_words, offset=20 + segments * size).astype(np.uint64)
    below = (np.cumsum(freq) - freq).astype(np.uint64)
    f = freq.astype(np.uint64)
    slots = symbols(freq) if slots is None else slots
    parts = []
    low_bits, scale, half = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for k in range(segments) if only is None else [only]:
        crc, at = struct.unpack_from("<2I", block, 20 + k * size)
        x = np.frombuffer(block, dtype="<u8", count=lanes, offset=28 + k * size).astype(np.uint64)
        count = min(SEGMENT, n - k * SEGMENT)
        ids = np.zeros(-(-count // lanes) * lanes, dtype=np.uint32)
        for t in range(0, count, lanes):
            live = min(lanes, count - t)
            slot = x[:live] & low_bits
            of = slots[slot]
            ids[t : t + live] = of
            s = f[of] * (x[:live] >> scale) + slot - below[of]
            empty = np.flatnonzero(s < LOWER)
            s[empty] = (s[empty] << half) | words[at : at + len(empty)]
            at += len(empty)
            x[:live] = s
        ids = ids[:count]
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"segment {k}: checksum differs")
        parts.append(ids)
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)


def symbols(freq: np.ndarray) -> np.ndarray:
    """The id of each of the 2**SCALE slots."""
    return np.repeat(np.arange(len(freq), dtype=np.intp), freq)


# ---- tokens ------------------------------------------------------------------


#: Words that a worker process remembers, at about 360 bytes each; with one more it starts afresh.
KNOWN_WORDS = 600_000
_KEPT = "tradevigil_kept_tokenizers"
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # of ASCII, without the apostrophe, which starts endings
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_ADDED = re.compile(r"([!-&(-/:-@\[-`{-~]+)\S*[A-Za-z]\S*")  # an added token that is never part of letters, or of marks after them
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: What a vocabulary file must say for texts to be encoded word by word: white space ends
#: words and is dropped, and letters are lower-cased. Fixed values of the file format.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLITTERS = [
    {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def by_words(model: str) -> bool:
    """Whether a vocabulary's texts may be encoded word by word."""
    parts = json.loads(model)
    steps = [(parts.get(kind) or {}).get(name) for kind, name in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    added = all(_ADDED.fullmatch(token["content"]) for token in parts.get("added_tokens") or [])
    return steps == [_NORMALIZERS, _SPLITTERS] and parts["model"]["type"] == "BPE" and added


def _latin(word: bytes) -> bool:
    return not word.isascii() and bool(_LATIN.fullmatch(word.decode("utf-8", "surrogatepass")))


class WordIds(dict[bytes, bytes]):
    """Packed ids of words between white space; a word not held yet is looked up when asked for.

    Words of Latin letters, and runs of ASCII punctuation, go straight to the library's merges
    (its normaliser and splitter only lower-case such words), all others through all of it.
    """

    def __init__(self, full, packed: list[bytes]):
        super().__init__()
        self.full, self.merges, self.packed = full, full.model.tokenize, packed
        latin = [chr(c) for c in [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]]
        self.bytes = str.maketrans({c: full.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in latin})

    def __missing__(self, word: bytes) -> bytes:
        letters = word.rstrip(_MARKS)
        if letters and letters != word and (letters.isalnum() or _latin(letters)):
            # a letter or digit and a mark are never in one piece
            ids = self[letters] + self[word[len(letters) :]]
        elif not letters or word.isalpha():
            ids = self._merged(word.lower().decode("ascii"))
        elif _latin(word):
            ids = self._merged(word.decode("utf-8").lower().translate(self.bytes))
        else:
            text = word.decode("utf-8", "surrogatepass")
            ids = b"".join([self.packed[i] for i in self.full.encode(text, add_special_tokens=False).ids])
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def _merged(self, piece: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.merges(piece)])


class WordTokenizer:
    """Ids of whole texts.

    Vocabularies that drop white space and never merge over it (`by_words`) are encoded word
    by word, each of which goes through the library once while it is remembered. With any other
    vocabulary, whole texts go through the library.
    """

    def __init__(self, model: str):
        import tokenizers

        self.full = tokenizers.Tokenizer.from_str(model)
        self.packed = [struct.pack("<I", i) for i in range(self.full.get_vocab_size())]
        self.known = WordIds(self.full, self.packed) if by_words(model) else None
        # case is kept before marks that the library composes with letters, U+0300 to U+036F, and in added tokens
        leads = {_ADDED.fullmatch(t.content)[1] for t in self.full.get_added_tokens_decoder().values()} if self.known is not None else ()
        self.cased = [b"\xcc", b"\xcd", *(lead.encode() for lead in sorted(leads))]

    def of_bytes(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of a text in UTF-8."""
        if self.known is None:
            ids = self.full.encode(text.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
            return b"".join([self.packed[i] for i in ids])
        if not any(lead in text for lead in self.cased):
            text = text.translate(_LOWER)  # the library does so anyway; fewer words differ
        # bytes split at the six white-space characters of ASCII; others are the library's
        return b"".join(map(self.known.__getitem__, text.split()))

    def ids(self, text: str | None) -> bytes:
        return self.of_bytes((text or "").encode("utf-8", "surrogatepass"))


def tokenizer_of(model: str, run: str) -> WordTokenizer:
    """The tokenizer of a worker process, kept with its words from task to task of one run."""
    # a task may unpickle this module anew, while a module of its own name lasts as long as the worker
    kept = sys.modules.get(_KEPT)
    if kept is None or kept.run != run:
        del kept  # workers outlive runs; words of several runs would add up
        forget()
        kept = sys.modules[_KEPT] = ModuleType(_KEPT)
        kept.run, kept.tokenizer = run, WordTokenizer(model)
    return kept.tokenizer


def forget() -> None:
    """Drop a worker process's tokenizer and words."""
    sys.modules.pop(_KEPT, None)


_END = struct.pack("<I", END_ID)


def _counts(blocks: DataFrame) -> np.ndarray:
    """Occurrences of each id in the corpus; the list is as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # all texts are encoded
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                own = np.bincount(np.frombuffer(ids.as_py(), dtype="<u4"), minlength=len(total))
                own[: len(total)] += total
                total = own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    rows = blocks.select("ids").mapInArrow(run, "id bigint, n bigint")
    found = rows.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, dtype=np.int64)
    counts[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    return counts


def blocks_of(docs: DataFrame, order: list[str], vocabulary: str) -> DataFrame:
    """Blocks of the sorted corpus, not yet coded: `part` (range of the sort), `first_id`
    (ids before it in its part), `n_ids`, `doc_ids`, `lengths`, `ids`."""
    spark, run_id = small_batches(docs.sparkSession), uuid.uuid4().hex
    with open(vocabulary, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())
    rows = docs.select(*dict.fromkeys([*order, "doc_id", "text"]), F.xxhash64("text").alias("_text"))
    # ranges are drawn by the hash, not the text, as a sample of their keys goes to the driver
    rows = rows.repartitionByRange(*order, "_text").sortWithinPartitions(*order, "_text", "text").select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = ["part", "first_id", "n_ids", "doc_ids", "lengths", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, first = tokenizer_of(model.value, run_id), TaskContext.get().partitionId(), 0
        owners: list = []
        held: list[bytes] = []
        size, ids_type = 0, pa.null()

        def block() -> pa.RecordBatch:
            values = [[part], [first], [size], None, [[len(x) // 4 for x in held]], [b"".join(held)]]
            types = [pa.int32(), pa.int64(), pa.int64(), None, pa.list_(pa.int64()), pa.binary()]
            arrays = [t and pa.array(v, t) for v, t in zip(values, types, strict=True)]
            arrays[3] = pa.ListArray.from_arrays([0, len(owners)], pa.array(owners, ids_type))
            return pa.RecordBatch.from_arrays(arrays, columns)

        for batch in batches:
            ids_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                owners.append(doc_id)
                held.append(tokenizer.of_bytes(text.as_py() or b"") + _END)
                size += len(held[-1]) // 4
                if size >= BLOCK:
                    yield block()
                    first, size, owners, held = first + size, 0, [], []
        if held:
            yield block()

    shape = f"part int, first_id bigint, n_ids bigint, doc_ids array<{kind}>, lengths array<bigint>, ids binary"
    return rows.mapInArrow(run, shape)


def write(docs: DataFrame, order: list[str], vocabulary: str, path: str | None = None) -> str:
    """Encode `docs` (`doc_id`, `text` and the columns of `order`, ascending); returns the folder.

    Texts are sorted in ranges and tokenized once; each range's documents fill blocks, kept
    as plain ids until all are counted for the table, then coded one by one. Rows equal in
    all of `order` are put in order of a hash of their text; NULL is the empty text and gets the end
    id only. The vocabulary file is read on the driver and shipped as text. `table` holds
    the frequencies, `blocks` the blocks. No rows: an empty table and no blocks.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    plain = scratch_path(spark, "ids")
    blocks_of(docs, order, vocabulary).write.option("compression", "zstd").parquet(plain)
    blocks = spark.read.parquet(plain)
    freq = frequencies(_counts(blocks))
    table = json.dumps([[int(i), int(freq[i])] for i in np.flatnonzero(freq)])
    spark.createDataFrame([(table, len(freq))], "frequencies string, ids int").coalesce(1).write.parquet(f"{path}/table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [encode(np.frombuffer(ids.as_py(), dtype="<u4"), freq) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(coded, pa.binary())], [*batch.schema.names[:-1], "block"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema[:-1])
    blocks.mapInArrow(run, f"{shape}, block binary").write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def table(spark: SparkSession, path: str) -> np.ndarray:
    """The frequency of each id; as long as the vocabulary."""
    row = spark.read.parquet(f"{path}/table").first()
    freq = np.zeros(row["ids"], dtype=np.int64)
    for i, f in json.loads(row["frequencies"]):
        freq[i] = f
    return freq


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids` (little-endian uint32) of each document of a file.

    Blocks are decoded where they lie; only the parts' totals are summed up in one task.
    """
    freq = table(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = symbols(freq)
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, _, owners, lengths, block = (batch.column(c)[row] for c in range(6))
                data = decode(block.as_py(), freq, slots=slots).astype("<u4").tobytes()
                n = np.array(lengths.as_py(), dtype=np.int64)
                ends = np.cumsum(n)
                ids = [data[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part.as_py(), dtype=np.int32)),
                        owners.values,
                        pa.array(first.as_py() + ends - n),
                        pa.array(n),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "doc_id", "first_id", "n_tokens", "ids_crc32", "ids"],
                )

    shape = f"part int, doc_id {kind}, first_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    found = blocks.select("part", "first_id", "n_ids", "doc_ids", "lengths", "block").mapInArrow(run, shape)
    return found.join(offsets, "part").select(
        "doc_id", (F.col("first_id") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def report(docs: DataFrame, vocabulary: str, order: list[str] | None = None) -> DataFrame:
    """The columns of `op8_token_files`: the corpus written in order, and read back."""
    path = write(docs, order or ["doc_id"], vocabulary)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", "ids_crc32")
