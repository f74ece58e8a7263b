"""Centroid clustering and source divergence on hand-made rows, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradevigil.llm import centroids, divergence

WIDE = "vec_id bigint, embedding array<float>, label int, v array<int>, dots string, cluster string, id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 1, [1], "x", "y", "z") for i, e in rows], WIDE)


def unit(*at, size=64, value=1.0):
    return [value if i in at else 0.0 for i in range(size)]


def plain_clusters(rows, k=8, rounds=10):
    """The contract, from scratch every round."""
    points = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows]
    mark = lambda p: (hashlib.sha256(f"3:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1])
    now = [p[1] for p in sorted(points, key=mark)[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((gap(v, c), j) for j, c in enumerate(now))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in points:
            own[nearest(v)[1]].append(v)
        now = [[sum(c) // len(own[j]) for c in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(now)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in points), key=repr)


def test_clusters_against_plain_rounds(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(i % 5, 0.7, 64).astype(np.float32)]) for i in range(120)]
    rows += [(200, rows[3][1]), (200, rows[3][1]), (None, unit(0)), (None, unit(1, value=-3.7)), (300, unit())]
    got = centroids.report(vectors(spark, rows)).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == plain_clusters(rows)
    assert {r["inertia"] for r in got} == {sum(r["distance"] for r in got)}
    for r in got:
        assert r["cluster_inertia"] == sum(x["distance"] for x in got if x["cluster"] == r["cluster"])


def test_unusable_vectors_have_no_row(spark):
    bad = [(1, None), (2, []), (3, unit(size=63)), (4, [*unit(size=63), None]), (5, [*unit(size=63), math.nan]), (6, [*unit(size=63), math.inf])]
    bad.append((7, [*unit(size=63), 2.0**18]))  # its squared distance can leave 64 bits
    assert centroids.report(vectors(spark, bad)).count() == 0
    assert centroids.report(vectors(spark, [])).count() == 0
    some = centroids.report(vectors(spark, [*bad, (8, unit(2)), (9, [*unit(size=63), 2.0**17 - 1])])).collect()
    assert sorted((r["vec_id"], r["distance"]) for r in some) == [(8, 0), (9, 0)]


def test_only_moved_components_are_used(spark):
    old, new = np.zeros((2, 64), np.int64), np.zeros((2, 64), np.int64)
    new[1, [3, 9]] = 5, -2
    moved = centroids._moved(old, new)
    assert [list(at) for at, _ in moved] == [[], [3, 9]] and list(moved[1][1]) == [5, -2]


DOCS = "doc_id bigint, text string, lang string, source string, term string, n bigint, total string, shard string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, g, s, "a", 1, "b", "c") for i, (t, g, s) in enumerate(rows)], DOCS)


def plain_divergences(rows, least=3, top=200):
    docs = [(t or "", g or "", s or "") for t, g, s in rows]
    term = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    own, seen = defaultdict(Counter), defaultdict(Counter)
    for t, g, s in docs:
        own[g, s].update(term(t))
        seen[g].update(set(term(t)))
    found = []
    for g in seen:
        kept = [w for w, n in seen[g].items() if n >= least]
        sources = [s for h, s in own if h == g]
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c[x] for x in kept) + len(kept)) for w in kept}  # noqa: B023, E731
        p = {s: share(own[g, s]) for s in sources}
        q = share(sum((own[g, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pair = [(t, sum(f(p[s][w], p[t][w]) for w in kept)) for t in sources if t != s]
            words = [(w, f(p[s][w], q[w])) for w in kept if own[g, s][w] and p[s][w] > q[w]]
            for part, items, most in (("pair", pair, len(pair)), ("term", words, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                found += [(g, s, part, w, v, i + 1) for i, (w, v) in enumerate(ranked)]
    return sorted(found)


ODD = [
    (None, "en", "a"), ("", "en", "b"), ("The cat\x00 the-cat ÉTÉ été", "en", "a"), ("the cat 1 2", "en", "a"), ("THE dog été", "en", "c"),
    ("the été zebra", None, None), ("the", "", ""), ("the été", None, "x"), ("the été", None, "x"), ("alone", "de", "only"), ("日本 the", "en", "c"),
    ("cat " * 50_000 + "dog", "en", "b"), ("x" * 300_000, "en", "b"),
]


@pytest.mark.parametrize("small", [False, True])
def test_divergences_against_plain_counting(spark, monkeypatch, small):
    if small:  # every text alone, every count handed on at once, many shards and blocks
        for name, value in {"SLICE_BYTES": 64, "COUNTS_HELD": 2, "SHARD_ROWS": 1, "SHARD_PAIRS": 2, "DENSE_CELLS": 3}.items():
            monkeypatch.setattr(divergence, name, value)
    got = divergence.report(documents(spark, ODD))
    assert sorted(tuple(r) for r in got.collect()) == plain_divergences(ODD)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "string", "string", "bigint", "int"]


def test_no_documents_no_divergences(spark):
    assert divergence.report(documents(spark, [])).count() == 0


def test_pieces_of_a_long_text_hold_its_terms(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 40)
    text = "alpha beta " * 30 + "y" * 200 + " alpha"
    found = divergence._long_text(text)
    assert dict(zip(found["term"].to_pylist(), found["n"].to_pylist(), strict=True)) == dict(Counter(text.split()))


def test_shares_are_exact_for_large_counts():
    count, total = np.array([0, 10**12, 3 * 10**14 - 1]), np.array([3 * 10**14] * 3)
    assert list(divergence._share(count, total)) == [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(count, total, strict=True)]
