"""Personal data: exact rules for four kinds, and spans a trained character tagger adds.

Base spans follow fixed patterns. The tagger learns from them: windows around base spans
of a bounded sample, the same windows with the span written another way (labelled as the same
kind), and with look-alikes in its place (labelled as nothing). It reads overlapping windows,
and their spans are reconciled over the whole text. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradevigil.llm import tagger

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, place of the kind in KINDS, end

# ---- base spans ----------------------------------------------------------------------
# Patterns of the contract (fixed values), written so that no text takes quadratic time.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_BASE = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ in turn: the run of local characters before it, not before the last match's end."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        found = _HOST.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", free)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """A chain of numbers and dots is taken four numbers at a time."""
    for chain in _NUMBERS.finditer(text):
        numbers = list(re.finditer(r"[0-9]+", chain[0]))
        for i in range(0, len(numbers) - 3, 4):
            if all(len(n[0].lstrip("0")) <= 3 and int(n[0][-4:]) <= 255 for n in numbers[i : i + 4]):
                yield chain.start() + numbers[i].start(), chain.start() + numbers[i + 3].end()


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 38 and 14 <= len(d := "".join(_DIGIT.findall(m[0]))) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """Spans of the rules by start, then kind, in code points."""
    if not _BASE.search(text):
        return []
    rules = (_emails, _addresses, _cards, _phones)
    return sorted((a, k, b) for k, rule in enumerate(rules) for a, b in rule(text))


# ---- windows -------------------------------------------------------------------------

#: Characters in a window, and from one window to the next; a span's kinds all need a trigger.
WIDTH = 96
STRIDE = 48
_TRIGGER = re.compile(r"\d|[@＠﹫]|[(\[{<]\s?at\s?[)\]}>]", re.I)
_MAYBE = re.compile(r"[\d@＠﹫(\[{<]")
_PUNCTUATION = " !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SYMBOLS = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz" + _PUNCTUATION + "9")}
_LINE, _LETTER, _OTHER = len(_SYMBOLS) + 1, len(_SYMBOLS) + 2, len(_SYMBOLS) + 3
SYMBOLS = _OTHER + 1  # 0 is padding


def symbol(c: str) -> int:
    """Digits of any script are one symbol; ASCII letters without case, punctuation; the rest by class."""
    if c.isdecimal():
        return _SYMBOLS["9"]
    plain = unicodedata.normalize("NFKC", c).lower()
    if plain in _SYMBOLS:
        return _SYMBOLS[plain]
    return _LINE if c in "\n\r\t" else _LETTER if c.isalpha() else _OTHER


class _Coded:
    """Symbol codes of text, one lookup per different character."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str, width: int = WIDTH) -> np.ndarray:
        codes = np.zeros(width, np.int64)
        for i, c in enumerate(text):
            code = self.known.get(c)
            if code is None:
                code = self.known[c] = symbol(c)
            codes[i] = code
        return codes


def _open_triggers(text: str, known: list[Span], apart: int = 0) -> Iterator[re.Match]:
    """Triggers outside the known spans, at least `apart` characters from each; one sweep."""
    spans = sorted((a - apart, b + apart) for a, _, b in known)
    place, reach = 0, 0
    for m in _TRIGGER.finditer(text) if _MAYBE.search(text) else ():
        while place < len(spans) and spans[place][0] <= m.start():
            reach = max(reach, spans[place][1])
            place += 1
        if m.start() >= reach:
            yield m


def window_starts(text: str, known: list[Span] = ()) -> list[int]:
    """Starts of the windows, STRIDE apart from 0, that hold a trigger outside the known spans.

    No other window can hold a span that is to be added: such a span has a trigger and
    overlaps no known one.
    """
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    found: set[int] = set()
    for m in _open_triggers(text, known):
        for at in (m.start(), m.end() - 1):
            low = max(0, -(-(at - WIDTH + 1) // STRIDE))
            found.update(range(low, min(at // STRIDE, last) + 1))
    return [k * STRIDE for k in sorted(found)]


# ---- labelled windows ----------------------------------------------------------------

#: Documents whose windows are considered, and windows kept of each kind and of none.
SAMPLE_DOCS = 20_000
WINDOWS_A_KIND = 256
#: Windows the tagger is trained on, made from these.
TRAINED_WINDOWS = 2_400

_SAMPLE = "kind int, mark bigint, text string, spans array<struct<start:int,kind:int,end:int>>"


def _cut(text: str, centre: int, spans: list[Span], shift: int) -> tuple[str, list[Span]]:
    start = max(0, min(centre - shift, len(text) - WIDTH))
    inside = [(max(0, a - start), k, min(b, start + WIDTH) - start) for a, k, b in spans if a < start + WIDTH and b > start]
    return text[start : start + WIDTH], inside


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most one window of each kind and one without spans from a text, chosen by hash."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text or "")
            places: dict[int, list[int]] = {}
            for a, k, _ in spans:
                places.setdefault(k, []).append(a)
            clear = [m.start() for m in _open_triggers(text or "", spans, WIDTH)]
            if clear:
                places[len(KINDS)] = clear
            for k, at in places.items():
                mark = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, salt=bytes([k])).digest(), "little")
                window, own = _cut(text, at[mark % len(at)], spans, 16 + mark // 7 % 48)
                rows.append({"kind": k, "mark": mark >> 1, "text": window, "spans": [dict(zip(("start", "kind", "end"), s, strict=True)) for s in own]})
        yield pa.RecordBatch.from_pylist(rows, schema=_SAMPLE_ARROW)


_SAMPLE_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("mark", pa.int64()),
        ("text", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ]
)


def labelled_windows(docs: DataFrame) -> list[tuple[str, list[Span]]]:
    """Windows with their base spans: WINDOWS_A_KIND of each kind and of none, at most.

    They come from about SAMPLE_DOCS documents, chosen by the hash of their text, so equal
    tables give equal windows on any cluster; copies give one window.
    """
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    chosen = docs.select(F.col("text").cast("string").alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    )
    found = chosen.mapInArrow(_sample_windows, _SAMPLE).groupBy("kind", "mark").agg(F.min(F.struct("text", "spans")).alias("w"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("mark"))
    rows = found.withColumn("place", place).where(F.col("place") <= WINDOWS_A_KIND).orderBy("kind", "mark").collect()
    return [(r["w"]["text"], [tuple(s) for s in r["w"]["spans"]]) for r in rows]


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def rewritten(kind: int, span: str, rng: np.random.Generator) -> str:
    """The span in a form the rules do not know, of the same kind."""

    def one(options):
        return options[rng.integers(len(options))]

    if KINDS[kind] == "email":
        local, _, host = span.partition("@")
        at = one([" (at) ", " [at] ", "(at)", "[at]", " @ ", "＠", " <at> "])
        return local + at + host.replace(".", one([".", " (dot) ", " [dot] ", "[dot]", " . "]))
    if KINDS[kind] == "ip":
        return one(["[.]", " . ", "(.)", "[dot]", ",", "。"]).join(str(n) for n in rng.integers(1, 256, 4))
    if KINDS[kind] == "card":
        d, gap = _digits(rng, 16), one([".", "/", "  ", "_", " ", " - ", "–"])
        return gap.join(d[i : i + 4] for i in range(0, 16, 4))
    d, lead = _digits(rng, 10), one(["", "", "00" + _digits(rng, 2) + " ", "tel:", "+" + _digits(rng, 1) + "/"])
    body = one(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "{}/{}-{}"])
    return lead + body.format(d[:3], d[3:6], d[6:])


def look_alike(rng: np.random.Generator) -> str:
    """Digits and signs that are none of the kinds: versions, days, times, amounts, keys, long numbers."""
    d = _digits(rng, 40)
    forms = (
        f"{d[0]}.{d[1]}", f"{d[0]}.{d[1]}.{d[2]}", f"v{d[0]}.{d[1:3]}.{d[3]}", f"20{d[:2]}-0{d[2]}-1{d[3]}", f"1{d[0]}.0{d[1]}.20{d[2:4]}",
        f"1{d[0]}:{d[1:3]}", f"1{d[0]}:{d[1:3]}:{d[3:5]}", f"{d[0]},{d[1:4]}.{d[4:6]}", f"{d[:3]}.{d[3:5]}", d[:4], d[:6], d[:8], d,
        f"{d[:2]}%", f"#{d[:5]}", f"[{d[:2]}]", f"({d[0]})", f"{d[:3]}-{d[3]}-{d[4:6]}", "@" + "abcdefgh"[: 3 + int(d[0]) % 5],
        hashlib.md5(d.encode()).hexdigest(), hashlib.md5(d.encode()).hexdigest()[:20], "K" + hashlib.md5(d.encode()).hexdigest()[:16].upper(),
        f"{d[:2]} + {d[2:4]} = {d[4:6]}", f"{d[0]}/{d[1]}", f"{d[:2]}.{d[2:4]}.{d[4]}", f"{d[:3]} {d[3:6]}", f"10-{d[:2]}-{d[2:4]}",
    )
    return forms[rng.integers(len(forms))]


def training_set(windows: list[tuple[str, list[Span]]], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of TRAINED_WINDOWS windows: as found, spans rewritten, spans replaced by look-alikes."""
    rng, coded = np.random.default_rng(seed), _Coded()
    codes, tags = np.zeros((TRAINED_WINDOWS, WIDTH), np.int64), np.zeros((TRAINED_WINDOWS, WIDTH), np.int64)
    for i in range(TRAINED_WINDOWS):
        text, spans = windows[i % len(windows)]
        form = rng.choice(3, p=[0.3, 0.45, 0.25])
        parts, kept, end = [], [], 0
        length = 0
        for a, k, b in sorted(spans):
            if a < end:
                continue
            own = text[a:b]
            new = own if form == 0 else rewritten(k, own, rng) if form == 1 else look_alike(rng)
            parts += [text[end:a], new]
            length += a - end
            if form != 2:
                kept.append((length, k, length + len(new)))
            length += len(new)
            end = b
        parts.append(text[end:])
        full = "".join(parts)
        if not spans and form == 2:  # a look-alike in clear text too
            place = full.find(" ", int(rng.integers(0, max(1, len(full)))))
            full = f"{full[:place]} {look_alike(rng)}{full[place:]}" if place >= 0 else full
        codes[i] = coded(full[:WIDTH])
        for a, k, b in kept:
            if a < WIDTH:
                tags[i, a : min(b, WIDTH)] = 2 * k + 2
                tags[i, a] = 2 * k + 1
    return codes, tags


# ---- spans the tagger adds -----------------------------------------------------------

LEAST_SURE = 0.8
_WINDOWS_AT_ONCE = 1024
_SPOT = re.compile(r"@|＠|﹫|[(\[{<]\s?at\s?[)\]}>]", re.I)


def plausible(kind: int, span: str) -> bool:
    """An exact check of what the tagger found: how many digits, which numbers, a name and a host."""
    plain = unicodedata.normalize("NFKC", span)
    numbers = re.findall(r"\d+", plain)
    digits = "".join(str(unicodedata.decimal(c)) for n in numbers for c in n)
    if KINDS[kind] == "email":
        ends = _SPOT.split(span, maxsplit=1)
        return len(ends) == 2 and all(re.search(r"\w", e) for e in ends) and bool(re.search(r"\.|dot", ends[1], re.I))
    if KINDS[kind] == "ip":
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if KINDS[kind] == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def _decoded(codes: np.ndarray, weights: tagger.Weights) -> list[list[tuple[int, int, int, float]]]:
    """Per window its spans: start, kind, end, and the least probability of their tags."""
    found = []
    for low in range(0, len(codes), _WINDOWS_AT_ONCE):
        tags, sure = tagger.decode(codes[low : low + _WINDOWS_AT_ONCE], weights)
        for row, how in zip(tags, sure, strict=True):
            spans, start = [], 0
            for i in range(1, WIDTH + 1):
                if i == WIDTH or row[i] % 2 or row[i] != row[start] + row[start] % 2:
                    if row[start]:
                        spans.append((start, (int(row[start]) - 1) // 2, i, float(how[start:i].min())))
                    start = i
            found.append(spans)
    return found


def reconciled(found: list[tuple[int, int, int, float, bool]]) -> list[Span]:
    """One set of spans for the text from those of its windows, as (start, kind, end, sureness, cut).

    Spans of one kind that overlap and of which one is cut by its window's edge are one span.
    Among what then overlaps, the set with the largest sum of length times sureness is kept.
    """
    joined: list[list] = []
    for a, k, b, sure, cut in sorted(found, key=lambda s: (s[1], s[0], -s[2])):
        last = joined[-1] if joined else None
        if last and last[1] == k and a < last[2] and (cut or last[4]):
            last[2], last[3], last[4] = max(last[2], b), max(last[3], sure), last[4] and cut
        else:
            joined.append([a, k, b, sure, cut])
    joined.sort(key=lambda s: (s[2], s[0], s[1], -s[3]))
    ends = [s[2] for s in joined]
    best: list[tuple[float, int]] = [(0.0, -1)]  # value of the first n spans, and the last one taken
    for i, (a, _, b, sure, _) in enumerate(joined):
        with_it = best[bisect_right(ends, a, 0, i)][0] + (b - a) * sure
        best.append((with_it, i) if with_it > best[-1][0] else (best[-1][0], best[-1][1]))
    kept, n = [], len(joined)
    while best[n][1] >= 0:
        s = joined[best[n][1]]
        kept.append((s[0], s[1], s[2], s[3]))
        n = bisect_right(ends, s[0], 0, best[n][1])
    return sorted((a, k, b) for a, k, b, sure in kept if sure >= LEAST_SURE)


def added_spans(texts: list[str], bases: list[list[Span]], weights: tagger.Weights) -> list[list[Span]]:
    """Spans of the tagger that stand apart from all base spans and pass `plausible`."""
    coded, added = _Coded(), [[] for _ in texts]
    held: list[tuple[int, int]] = []  # text, window start
    seen: list[list[tuple[int, int, int, float, bool]]] = [[] for _ in texts]

    def decode_held() -> None:
        if held:
            codes = np.array([coded(texts[i][s : s + WIDTH]) for i, s in held])
            for (i, s), spans in zip(held, _decoded(codes, weights), strict=True):
                end = min(WIDTH, len(texts[i]) - s)
                for a, k, b, sure in spans:
                    if a < end:
                        cut = (a == 0 and s > 0) or (b >= end and s + end < len(texts[i]))
                        seen[i].append((s + a, k, s + min(b, end), sure, cut))
            held.clear()

    for i, text in enumerate(texts):
        for start in window_starts(text, bases[i]):
            held.append((i, start))
            if len(held) == _WINDOWS_AT_ONCE:
                decode_held()
    decode_held()
    for i, found in enumerate(seen):
        base = sorted((a, b) for a, _, b in bases[i])
        starts, reach = [a for a, _ in base], np.maximum.accumulate([b for _, b in base]) if base else []
        for a, k, b in reconciled(found):
            n = bisect_right(starts, b - 1)
            apart = not n or reach[n - 1] <= a
            span = texts[i][a:b]
            if apart and _TRIGGER.search(span) and plausible(k, span):
                added[i].append((a, k, b))
    return added


# ---- the operator --------------------------------------------------------------------


def trained(docs: DataFrame) -> tagger.Weights | None:
    """The tagger for these documents; None where their sample holds no base span."""
    windows = labelled_windows(docs)
    if not any(spans for _, spans in windows):
        return None
    codes, tags = training_set(windows)
    return tagger.train(codes, tags, SYMBOLS, len(KINDS))


def _told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


_FOUND = "doc_id {id}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def _scan(batches: Iterator[pa.RecordBatch], weights: tagger.Weights | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        bases = [base_spans(t) for t in texts]
        added = added_spans(texts, bases, weights) if weights else [[] for _ in texts]
        counts = [[sum(k == j for _, k, _ in spans) for spans in bases] for j in range(len(KINDS))]
        marks = [hashlib.sha256(_told(spans).encode()).hexdigest() for spans in bases]
        every = [_told(a + b) for a, b in zip(bases, added, strict=True)]
        columns = [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts]]
        columns += [pa.array(marks, pa.string()), pa.array(every, pa.string()), pa.array([len(a) for a in added], pa.int64())]
        names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def personal_data(docs: DataFrame, weights: tagger.Weights | None) -> DataFrame:
    """Per document counts of base spans, their digest, all spans, and how many the tagger added.

    NULL and empty texts have no spans; very long texts are read whole, window by window;
    repeated rows each get a row; other columns are ignored; no rows: no rows. Without
    weights only base spans are told.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = _FOUND.format(id=dict(rows.dtypes)["doc_id"])
    return rows.mapInArrow(lambda part: _scan(part, weights), schema)


def report(docs: DataFrame) -> DataFrame:
    """`op12`: the tagger trained on these documents' own base spans, applied to all of them."""
    return personal_data(docs, trained(docs))
