"""Personal data: rules against plain patterns, the tagger against enumeration, spans over whole texts."""

import hashlib
import itertools
import re

import duckdb
import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from tradevigil.llm import personal, registry, tagger

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = (True, k != 1 or all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and personal.luhn(d), 10 <= len(d) <= 15)
            found += [(m.start(), k, m.end())] if good[k] else []
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.sampled_from(["ab@.1-é", "01.2 -+()", "0123456789 -", "1.25.0", "a@b.c@", "+1 (2).-3x5"]).flatmap(lambda a: st.text(a, max_size=60)))
def test_rules_find_what_the_patterns_find(text):
    assert personal.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "a@", "a@b", "+1", "+1(", "1 ", "(at)", "a.b@c.d "])
def test_long_texts_take_linear_time(unit):
    long = unit * (200_000 // len(unit))
    assert isinstance(personal.base_spans(long), list)
    assert len(personal.window_starts(long, personal.base_spans(long))) <= len(long) // personal.STRIDE + 1


def small_tagger():
    rng = np.random.default_rng(1)
    w = tagger.fresh(5, 2, 1, 3, 4, np.float64)
    for k in ("pair", "start", "out_b"):
        w[k] = rng.normal(size=w[k].shape)
    return rng, w


def test_gradients_are_those_of_the_loss():
    rng, w = small_tagger()
    codes, tags = rng.integers(0, 5, (3, 6)), np.array([[0, 1, 2, 2, 0, 3], [3, 4, 4, 1, 0, 0], [2, 2, 0, 0, 1, 1]])
    _, grads = tagger.loss_and_gradients(codes, tags, w)
    for k in w:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w[k].shape)
            own = w[k][at]
            w[k][at] = own + 1e-5
            high, _ = tagger.loss_and_gradients(codes, tags, w)
            w[k][at] = own - 1e-5
            low, _ = tagger.loss_and_gradients(codes, tags, w)
            w[k][at] = own
            assert abs((high - low) / 2e-5 - grads[k][at]) < 1e-6 * (1 + abs(grads[k][at])), k


def test_best_tagging_and_shares_against_all_taggings():
    rng, w = small_tagger()
    codes = rng.integers(0, 5, (2, 4))
    scores, _, _ = tagger._emissions(codes, w)
    pair = tagger._pairs(w)
    tags, sure = tagger.decode(codes, w)
    for b in range(2):
        value = {
            y: w["start"][y[0]] + sum(scores[t, b, y[t]] for t in range(4)) + sum(pair[y[t], y[t + 1]] for t in range(3))
            for y in itertools.product(range(5), repeat=4)
        }
        assert tuple(tags[b]) == max(value, key=value.get)
        whole = np.logaddexp.reduce(list(value.values()))
        for t in range(4):
            own = np.logaddexp.reduce([v for y, v in value.items() if y[t] == tags[b, t]])
            assert abs(np.exp(own - whole) - sure[b, t]) < 1e-9
    assert all(pair[p, q] > -1000 or q in (2, 4) for p in range(5) for q in range(5))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3), st.integers(1, 6), st.integers(80, 99)), max_size=7))
def test_reconciled_spans_are_the_best_set(drawn):
    found = list({(a, k, a + n): (a, k, a + n, s / 100, False) for a, k, n, s in drawn}.values())
    got = personal.reconciled(found)
    assert all(x[2] <= y[0] for x, y in itertools.pairwise(got))
    value = {s[:3]: (s[2] - s[0]) * s[3] for s in found}
    best = 0
    for r in range(len(found) + 1):
        for chosen in itertools.combinations(sorted(found), r):
            if all(x[2] <= y[0] for x, y in itertools.pairwise(chosen)):
                best = max(best, sum(value[s[:3]] for s in chosen))
    assert abs(sum(value[s] for s in got) - best) < 1e-9


def test_a_span_cut_by_a_window_is_joined():
    assert personal.reconciled([(10, 0, 48, 0.9, True), (30, 0, 70, 0.95, True), (80, 1, 90, 0.5, False)]) == [(10, 0, 70)]


def test_every_window_with_an_open_trigger_is_read():
    text = "x" * 500 + " 5 " + "y" * 300 + " a@b.cc "
    known = personal.base_spans(text)
    starts = personal.window_starts(text, known)
    at = text.index("5")
    assert starts == [s for s in range(0, len(text), personal.STRIDE) if s <= at < s + personal.WIDTH]
    assert personal.window_starts(text, [*known, (at, 1, at + 1)]) == []


DOCS = "doc_id bigint, text string, spans string, kind string, n_email string, mark string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], DOCS)


def test_odd_rows_each_get_a_row(spark, monkeypatch):
    monkeypatch.setattr(personal, "TRAINED_WINDOWS", 192)
    long = "the cat 1.2.3.4 sat " * 20_000
    rows = [(1, None), (2, ""), (3, "a@b.cc, 1.2.3.4 and +1 (234) 555-6789"), (3, "a@b.cc"), (3, "a@b.cc"), (None, "日 a@b.cc"), (4, long), (5, "1" * 5000)]
    got = {}
    for r in personal.report(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert {i: len(v) for i, v in got.items()} == {1: 1, 2: 1, 3: 3, None: 1, 4: 1, 5: 1}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[1][0]["base_sha256"] == got[2][0]["base_sha256"] == nothing and got[1][0]["spans"] == ""
    assert got[4][0]["n_ip"] == 20_000 and got[None][0]["spans"] == "email:2:8"
    assert sorted(r["n_phone"] for r in got[3]) == [0, 0, 1]
    assert personal.report(documents(spark, [])).count() == 0
    clear = personal.report(documents(spark, [(1, "no data here, 4.0")])).collect()
    assert [(r["n_added"], r["spans"]) for r in clear] == [(0, "")]


def test_query_over_the_sample_tables(spark):
    """Base columns against plain patterns; the tagger finds other spellings and leaves clear text alone."""
    big = f"{SF_DIR}/../sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{big}/documents.parquet'").fetchall())
    for r in registry.QUERIES["op12_personal_data"](spark, big).collect():
        spans = plain_spans(texts[r["doc_id"]])
        told = [f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal.KINDS] == [sum(j == i for _, j, _ in spans) for i in range(4)]
        every = [s for s in r["spans"].split(",") if s]
        assert set(told) <= set(every) and len(every) == len(told) + r["n_added"]
        assert every == sorted(every, key=lambda s: (int(s.split(":")[1]), personal.KINDS.index(s.split(":")[0])))
        assert r["n_added"] == 0  # these texts hold nothing but base spans

    docs = spark.read.parquet(f"{big}/documents.parquet")
    weights = personal.trained(docs)
    rng = np.random.default_rng(11)
    windows = [(t, s) for t, s in personal.labelled_windows(docs) if len(s) == 1]
    hits = total = wrong = 0
    for text, ((a, k, b),) in windows:
        new = personal.rewritten(k, text[a:b], rng)
        other = text[:a] + new + text[b:]
        if personal.base_spans(other) or not personal.plausible(k, new) or not personal._TRIGGER.search(new):
            continue
        spans = personal.added_spans([other], [[]], weights)[0]
        total += 1
        hits += any(s == (a, k, a + len(new)) for s in spans)
        wrong += any(s[2] <= a or s[0] >= a + len(new) for s in spans)
    assert total >= 20 and hits / total > 0.5 and wrong / total < 0.05
