"""Operators on hand-made rows: NULLs, empty and long texts, ties, repeats, no rows, extra columns."""

import itertools
import re
import time
import weakref

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tradevigil.llm import components, langid, licences, maintext, mixing, ordermin, simhash, tokenfile, toxicity, warc, winnow, words

LONG = "the cat sat on the mat and saw a dog run past it " * 4000
#: doc_id, text; ids repeat and may be NULL
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "One."), (4, "One."), (None, "One."), (5, LONG), (6, "日本語のテキスト"), (7, "... 123 !!!")]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, range string, row string, fp string, _order string"


def documents(spark, rows):
    full = [(i, t, "en", "s", len(t or ""), "x", "y", "z", "w") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


REPORTS = {
    "ordermin": lambda s, d: ordermin.report(d),
    "winnow": lambda s, d: winnow.report(d, items(s, [(1, "a dog run past it the cat sat on the mat"), (2, "One"), (None, None)])),
    "licences": lambda s, d: licences.report(d),
    "toxicity": lambda s, d: toxicity.report(d, labels(s, [(1, 0, 1), (2, 0, 0), (4, 1, 0), (6, 0, 1), (None, 0, 1)])),
    "langid": lambda s, d: langid.report(d),
    "tokenfile": lambda s, d: tokenfile.report(d, corpus_pipeline.vocabulary()),
    "simhash": lambda s, d: simhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_odd_rows_each_get_a_row(spark, name):
    got = REPORTS[name](spark, documents(spark, ODD))
    ids = sorted((r["doc_id"] for r in got.collect()), key=repr)
    assert ids == sorted((i for i, _ in ODD), key=repr)
    assert REPORTS[name](spark, documents(spark, [])).count() == 0


def test_odd_rows_in_filters(spark):
    docs = documents(spark, ODD)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    # texts without words are one group, as are all rows of "One."
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 4, 5, 6, 7]
    clean = winnow.clean(docs, items(spark, [(1, "One")]))
    assert clean.columns == docs.columns and clean.where("text = 'One.'").count() == 0 and clean.count() == 6
    told = langid.recognised(documents(spark, [*ODD, (9, "One one cat cat")]), least=0.0)
    assert told.columns == docs.columns and {r["doc_id"] for r in told.collect()} == {4, None, 5, 6, 9}
    assert mixing.shuffled(docs).columns == docs.columns
    for name, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, documents(spark, []), "").count() == 0, name


def test_mixing_reaches_its_weights(spark):
    docs = spark.createDataFrame([(i, "x" * 10, "big" if i % 4 else "small") for i in range(4000)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 1.0), ("small", 1.0), ("gone", 5.0)], "source string, weight double")
    n = {r["source"]: r["count"] for r in mixing.replicated(docs, targets).groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 2000) < 200
    high = spark.createDataFrame([("small", 1.0)], "source string, weight double")
    few = docs.where("source = 'big' OR doc_id < 40")
    drawn = {r["doc_id"]: r["_mix_copies"] for r in mixing.replicated(few, high).collect()}
    assert set(drawn) <= set(range(0, 40, 4)) and abs(np.mean(list(drawn.values())) - 301) < 25


def test_null_source_is_a_source(spark):
    docs = spark.createDataFrame([(i, "abc", None) for i in range(300)], "doc_id bigint, text string, source string")
    assert 200 < mixing.report(docs).count() < 400


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=3000), st.integers(1, 40))
def test_coder_round_trip(values, top):
    ids = np.minimum(np.array(values, dtype=np.uint32), top)
    freq = tokenfile.frequencies(np.bincount(ids, minlength=1)) if len(ids) else np.zeros(1, dtype=np.int64)
    assert (tokenfile.decode(tokenfile.encode(ids, freq), freq) == ids).all()


def test_coder_segments_and_checksums():
    ids = (np.random.default_rng(1).zipf(1.3, 2 * tokenfile.SEGMENT + 777) % 5000).astype(np.uint32)
    freq = tokenfile.frequencies(np.bincount(ids))
    block = tokenfile.encode(ids, freq)
    for k in range(3):
        assert (tokenfile.decode(block, freq, only=k) == ids[k * tokenfile.SEGMENT : (k + 1) * tokenfile.SEGMENT]).all()
    broken = bytearray(block)
    broken[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        tokenfile.decode(bytes(broken), freq)
    with pytest.raises(ValueError):
        tokenfile.decode(b"????" + block[4:], freq)


def test_word_tokenizer_is_the_library():
    from tokenizers import Tokenizer

    with open(corpus_pipeline.vocabulary(), encoding="utf-8") as file:
        model = file.read()
    library, own = Tokenizer.from_str(model), tokenfile.WordTokenizer(model)
    for text in ["Aİb, K Å ẞß 'sdon't it's", "x <|endoftext|>a b c d\x1ce\x85f", "ÀÉ... naïve.Été,été 1a2b ½ǅ", "日本 한국 |.,;", "", "<|ENDOFTEXT|> <|endoftext|>, H\u0331i, H\u0331 I\u0307 É\u0331. 12, 3a, été'. ´a", "×÷ a×b, é×. a\u2003b, µm ªº ÿŸ"]:
        assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_are_forgotten_and_found_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfile, "KNOWN_WORDS", 5)
    with open(corpus_pipeline.vocabulary(), encoding="utf-8") as file:
        model = file.read()
    library, own = Tokenizer.from_str(model), tokenfile.WordTokenizer(model)
    texts = ["The the, THE. $$$ a_b-c [x]", "antionon&&& haerou$$$ ***", None, "it's it' ''s 's x'", "Été!! ÉTÉ ß<|endoftext|>", "<|endoftext|> &amp; ~`@"] * 2
    found = [np.frombuffer(own.ids(t), dtype="<u4").tolist() for t in texts]
    again = [np.frombuffer(own.ids(t), dtype="<u4").tolist() for t in texts]
    assert found == again == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(own.known) <= 5 + 2  # letters and marks of the last word go before it


def test_worker_keeps_the_words_of_one_run_only():
    with open(corpus_pipeline.vocabulary(), encoding="utf-8") as file:
        model = file.read()
    first = tokenfile.tokenizer_of(model, "run 1")
    first.ids("words of the first run")
    assert tokenfile.tokenizer_of(model, "run 1") is first and len(first.known) == 5
    other = tokenfile.tokenizer_of(model, "run 2")
    assert other is not first and not other.known
    gone = weakref.ref(other)
    del other
    tokenfile.forget()
    assert gone() is None


def test_texts_go_to_python_in_batches_of_bounded_bytes(spark):
    text = "x" * 100_000
    rows = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    simhash.fingerprints(rows, 4)
    sizes = [r["n"] for r in rows.mapInArrow(run, "n bigint").collect()]
    assert sum(sizes) == 300 and max(sizes) * len(text) <= 5_000_000


def test_other_vocabularies_take_whole_texts():
    import json

    from tokenizers import Tokenizer

    with open(corpus_pipeline.vocabulary(), encoding="utf-8") as file:
        parts = json.load(file)
    parts["normalizer"]["normalizers"].pop()  # letters keep their case
    model = json.dumps(parts)
    own = tokenfile.WordTokenizer(model)
    assert own.known is None
    text = "Upper and lower, Été"
    assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == Tokenizer.from_str(model).encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_round_trip(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


def test_warc_segments_revisits_and_damage(spark, tmp_path):
    page = "é" * 30_000
    rows = [(1, "http://a", page), (2, "http://b", page), (3, None, None), (4, "u", "short"), (5, "u", "short"), (None, "n", page), (2, "http://b", page)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((tuple(r)[:2] + tuple(r)[3:] for r in warc.report(pages).collect()), key=repr)
    want = [(1, 60000, "response", None), (2, 60000, "revisit", 1), (2, 60000, "revisit", 1), (3, 0, "response", None)]
    want += [(4, 5, "response", None), (5, 5, "response", None), (None, 60000, "revisit", 1)]
    assert got == sorted(want, key=repr)
    assert warc.report(pages.limit(0)).count() == 0
    path = str(tmp_path / "w")
    warc.write(pages, path)
    found = warc.read_records(spark, path)
    assert found.where("kind = 'continuation'").count() > 5
    errors = {r["error"] for r in warc.reassembled(found.where("number <> 3")).collect()}
    assert errors == {None, "segments are missing or repeated"}
    last = found.agg({"number": "max"}).first()[0]
    assert "total length differs" in {r["error"] for r in warc.reassembled(found.where(f"number < {last}")).collect()}
    assert "no first segment" in {r["error"] for r in warc.reassembled(found.where("number <> 1")).collect()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=60))
def test_winnowing_guarantee(a, b):
    """Texts that share ten words keep a run in common."""
    runs = []
    for own in (a, b):
        data = b" ".join(b"w%d" % x for x in own)
        runs.append(set(winnow.kept_runs(words.word_hashes(data, *words.spans(data)), 10, 5)[0].tolist()))
    shared = {tuple(a[i : i + 10]) for i in range(len(a) - 9)} & {tuple(b[i : i + 10]) for i in range(len(b) - 9)}
    assert not shared or runs[0] & runs[1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 3), max_size=30))
def test_matching_statistics(templates, text):
    """Runs of the automaton are the longest that stand in a template and cannot go on."""
    automaton = licences.Automaton(templates)

    def occurs(run):
        return any(t[i : i + len(run)] == run for t in templates for i in range(len(t)))

    longest = [max(n for n in range(i + 2) if n == 0 or occurs(text[i + 1 - n : i + 1])) for i in range(len(text))]
    want = [(i + 1 - n, n) for i, n in enumerate(longest) if n >= 2 and (i + 1 == len(text) or longest[i + 1] != n + 1)]
    known = [(c, i) for i, c in enumerate(text) if c < 3]
    found = list(automaton.runs([c for c, _ in known], [i for _, i in known], 2))
    assert [(s, n) for s, n, _ in found] == want
    for s, n, state in found:
        places = {(t, i + n) for t, own in enumerate(templates) for i in range(len(own)) if own[i : i + n] == text[s : s + n]}
        assert set(automaton.ends[state]) == places


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=25))
def test_runs_are_placed_in_every_template(templates, text):
    """All common runs that go on neither to the left nor to the right; 4 is in no template."""
    want = set()
    for t, own in enumerate(templates):
        for i in range(len(text)):
            for j in range(len(own)):
                if i and j and text[i - 1] == own[j - 1]:
                    continue
                n = 0
                while i + n < len(text) and j + n < len(own) and text[i + n] == own[j + n]:
                    n += 1
                if n >= 2:
                    want.add((t, i, n, j))
    known = [(c, i) for i, c in enumerate(text) if c < 4]
    found = list(licences.Automaton(templates).placed([c for c, _ in known], [i for _, i in known], 2))
    assert len(found) == len(set(found)) and set(found) == want


def chained(hits, weights, gap):
    """Weight of the best chain, by trying all of them."""
    best = 0
    for k in range(1, len(hits) + 1):
        for chain in itertools.combinations(sorted(hits), k):
            pairs = itertools.pairwise(chain)
            if all(s + n <= t <= s + n + gap and a + n <= b for (s, n, a), (t, _, b) in pairs):
                best = max(best, sum(weights[a + n] - weights[a] for _, n, a in chain))
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70), st.integers(1, 3), st.integers(0, 5)), min_size=1, max_size=7, unique=True), st.lists(st.integers(1, 9), min_size=8, max_size=8))
def test_the_best_chain_is_the_best_of_all(hits, own):
    weights = [0, *itertools.accumulate(own)]
    found = licences._chains(hits, weights)
    assert max(c for *_, c in found) == chained(hits, weights, licences.MOST_GAP) / weights[-1]


@pytest.mark.parametrize("text", ["The film was released under the title Golden Days.", "Released under the GPL", "Released under the BSD License", "licensed under the terms of a lease"])
def test_common_words_are_no_licence(text):
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES)
    assert all(covered < licences.COVERED for *_, covered in scanner.scan(text)[3])


def test_a_fuller_match_explains_shared_words():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES)
    for label, notice in licences.TEMPLATES[-3:]:
        found = scanner.scan(f"Words before. {notice}. And words after, licensed under nothing.")[3]
        assert [s[0] for s in found if s[3] >= licences.COVERED] == [label]


def test_licence_with_gaps():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES)
    text = licences.TEMPLATES[1][1].replace("furnished", "given and delivered").replace("sublicense", "lend")
    _, places, found, spans = scanner.scan("Some words first. " + text)
    best = max(spans, key=lambda s: s[3])
    assert not places and not found and best[0] == "mit" and best[1] == 3 and best[3] > 0.9


def test_every_copy_of_a_notice_is_a_span():
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES)
    label, notice = licences.TEMPLATES[1]
    n = len(words.split(notice, words.ALNUM))
    spans = [s for s in scanner.scan("x y z ".join([notice + " "] * 3))[3] if s[0] == label]
    assert [s[1:] for s in spans] == [(i * (n + 3), i * (n + 3) + n, 1.0) for i in range(3)]
    assert len([s for s in scanner.scan(notice)[3] if s[0] == label]) == 1


@pytest.mark.parametrize("code, count", [("golay", 1 << 12), ("hamming", 1 << 11)])
def test_codes_cover(code, count):
    seg = simhash.segment(0, code, 0)
    values = np.random.default_rng(0).integers(0, 1 << seg.bits, 20_000, dtype=np.uint64)
    index, anchor, home = simhash.reach(values, seg)
    assert home.all() and len(index) == len(values) and len(np.unique(anchor)) <= count


@pytest.mark.parametrize("threshold", [4, 8])
def test_no_link_escapes(threshold):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, threshold, replace=False)) for _ in a], dtype=np.uint64)
    values = np.concatenate([a, a ^ flips])
    met = np.zeros(len(a), dtype=bool)
    for seg in simhash.segments(threshold):
        index, anchor, home = simhash.reach(values, seg)
        homes = {(int(i), int(x)) for i, x, h in zip(index, anchor, home, strict=True) if h}
        met |= [any((i, int(x)) in homes for x in anchor[index == i + len(a)]) for i in range(len(a))]
    assert met.all()


def test_large_anchors_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_HOMES", 3)
    monkeypatch.setattr(simhash, "CELL_MEMBERS", 5)
    fps = spark.createDataFrame([(1 << i,) for i in range(40)] + [(-1,), (-3,)], "fp bigint")
    found = {(r["node"], r["root"]) for r in components.components(simhash.links(fps, 4)).collect()}
    assert len({r for _, r in found}) == 2 and len(found) == 42


def test_components_of_a_path_and_none(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components.components(edges.limit(0)).count() == 0


def least_of_groups(rows, shingle, threshold):
    """Smallest id of each component of all pairs of fingerprints, in plain Python."""
    fp = [simhash.simhash(t, shingle) for _, t in rows]
    root = list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            if (fp[i] ^ fp[j]).bit_count() <= threshold:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root)}, fp


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 5000, 400)]
    edited = [*base[:-1], "other"]
    other = [f"w{x}" for x in rng.integers(0, 5000, 400)]
    rows = [(3, " ".join(base)), (1, " ".join(edited)), (2, " ".join(other)), (9, " ".join(base).upper())]
    assert least_of_groups(rows, 4, 4)[0] == {1, 2}
    assert sorted(r["doc_id"] for r in simhash.one_per_group(documents(spark, rows)).collect()) == [1, 2]


def test_groups_are_those_of_all_pairs(spark):
    """Drifting copies, many a little under and over the distance, against all pairs."""
    rng = np.random.default_rng(5)
    texts = [f"v{x}" for x in rng.integers(0, 800, 300)], [f"v{x}" for x in rng.integers(0, 800, 150)]
    rows = []
    for i in range(240):
        text = list(texts[i % 2])
        for at in rng.integers(0, len(text), int(rng.integers(0, 6))):
            text[at] = f"v{rng.integers(0, 800)}"
        rows.append((1000 - i, " ".join(text)))
    rows += [(2000, "a b"), (2001, "b a"), (2002, "a a b"), (2003, "A  B")]
    wanted, fp = least_of_groups(rows, 4, 4)
    links = sum((x ^ y).bit_count() <= 4 for k, x in enumerate(fp) for y in fp[:k])
    assert links > 300 and 10 < len(wanted) < len(rows) - 100
    kept = [r["doc_id"] for r in simhash.one_per_group(documents(spark, rows)).collect()]
    assert sorted(kept) == sorted(wanted)


def test_near_dedup_keeps_columns_named_like_its_own(spark):
    rows = [(1, "one two three four five", 7, 8, 9), (2, "one two three four five", 1, 2, 3), (3, "else", 4, 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept_id int, Kept_Text int, fp int")
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_stages_keep_columns_named_like_their_own(spark):
    names = ["language", "_language", "_mix_key", "_mix_copy", "_mix_copies", "_mix_order", "_mix_source", "row", "kept_text"]
    docs = documents(spark, [(1, "one cat sat"), (2, "two dogs ran"), (2, "two dogs ran"), (None, None)]).select("doc_id", "text", "lang", "source")
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    before = sorted(map(tuple, docs.collect()), key=repr)
    told = langid.recognised(docs, least=0.0)
    assert told.columns == docs.columns and sorted(map(tuple, told.collect()), key=repr) == [r for r in before if r[1]]
    mixed = mixing.shuffled(docs)
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= set(before)
    assert mixing.shuffled(docs.limit(0)).count() == 0


def test_a_forest_has_fewer_links_than_fingerprints():
    values = np.arange(16, dtype=np.uint64)  # all pairs differ in 4 bits at most
    a, b = simhash.forest(values, values, 4)
    assert len(a) == 15 and set(a) | set(b) == set(values)


def test_order_is_seen(spark):
    a = [f"a{i}" for i in range(300)]
    rows = spark.createDataFrame([(" ".join(a), " ".join(a[150:] + a[:150])), ("x " * 50, "x " * 40)], "a string, b string")
    rows = ordermin.with_signature(ordermin.with_signature(rows, "a", "s"), "b", "t")
    moved, repeats = (r[0] for r in rows.select(ordermin.likeness(rows["s"], rows["t"])).collect())
    assert 0.3 < moved < 0.9 and 0.3 < repeats < 1


PAGES = {
    "<html><body><nav><a href=/>Home page</a></nav><main><h1>T</h1><p>Some &lt;text&gt; &amp; more<p>End</main><footer>F": "T Some <text> & more End",
    "<div class='cookie-banner'>We use cookies on this site, and so on and on</div><div>"
    + "<p>" + "A long paragraph of the article itself. " * 3 + "</p>" * 1 + "<p>Short one.</p></div><ul><li><a href=1>One menu entry</a></ul>": ("A long paragraph of the article itself. " * 3).strip() + " Short one.",
    "<article><p>Yes<div class=comments><p>No</div><form>no</form><aside>no</aside><p>also</article>": "Yes also",
    "<article>a<!-- x <b>-->b<script>if (a<b) {}</script> c&nbsp;&eacute;</article>": "ab c é",
    "": "",
    "<": "<",
}


@pytest.mark.parametrize("page", sorted(PAGES))
def test_main_text(page):
    assert maintext.main_text(page) == PAGES[page]


@pytest.fixture(scope="module")
def sample_pages():
    return [html for (html,) in duckdb.sql(f"SELECT html FROM '{SF_DIR}/pages.parquet'").fetchall()]


def test_a_very_long_block_hides_no_paragraph():
    """Before it and after a dive; and where no line is long, the first ones stay, too."""
    some = [f"Paragraph {i}: " + "it goes on about things and more things. " * 7 for i in range(6)]
    links = "".join(f"<p><a href=/{i}>Another page of ours, number {i}</a></p>" for i in range(3))
    for between in ("", links):
        for parts in ([*some, between, "long " * 4000], ["long " * 4000, between, *some], [*some, between, "long " * 4000, between, *some]):
            page = "<h1>The title of it</h1>" + "".join(x if x == between else f"<p>{x}</p>" for x in parts)
            assert maintext.main_text(page) == " ".join(["The title of it", *(x.strip() for x in parts if x != between)])
    assert maintext.main_text("<p>a<p>b<p>c<p>dddd<p>e") == "a b c dddd e"


def test_an_article_tag_hides_no_text_outside():
    body = [f"Paragraph {i}: " + "it goes on about things and more things. " * 7 for i in range(6)]
    whole = " ".join(x.strip() for x in body)
    divs = "".join(f"<div>{x}</div>" for x in body)
    for teaser in ("<article><h3>Read this, too</h3></article>", "<article><img src=x><p>A caption</p></article>"):
        for page in (teaser + f"<div>{divs}</div>", f"<div>{divs}</div>" + teaser, f"<div>{divs[:900]}</div>{teaser}<div>{divs[900:]}</div>"):
            text = maintext.main_text(page)
            assert all(x.strip() in text for x in body[:2] + body[3:]) and len(text) >= len(whole)


def test_sample_pages_without_their_tags(sample_pages):
    """Nearly all articles are found by their lines alone; the rest lose a short first line."""
    bare = [maintext.main_text(re.sub("<(/?)(?:article|main)>", r"<\1div>", page)) for page in sample_pages]
    named = [maintext.main_text(page) for page in sample_pages]
    assert np.mean([a == b for a, b in zip(bare, named, strict=True)]) > 0.98
    assert all(b.endswith(a) and a for a, b in zip(bare, named, strict=True))


_BODY = "<p>" + "</p><p>".join(f"This is sentence {i} of the article, and it goes on for some time." for i in range(8)) + "</p>"


@pytest.mark.parametrize(
    "around",
    [
        '<div class="elementor-widget elementor-widget-text-editor">%s</div>',
        '<div class="content no-sidebar">%s</div>',
        '<div class="social-science">%s</div>',
        '<form id="aspnetForm"><nav>Menu of it</nav>%s<footer>Footer of it</footer></form>',
        '<div class="widget"><div class="social">%s<div class="comments"><p>A reader comments at some length on it.</div></div></div>',
        '<div>%s</div><section class="comments">' + _BODY * 3 + "</section>",
        '<article>%s</article><div class="promo">' + _BODY * 3 + "</div>",
    ],
)
def test_names_do_not_drop_most_of_a_page(around):
    """What holds most of the text stays; comments, and what stands outside of the article, do not."""
    assert maintext.main_text(around.replace("%s", _BODY)) == maintext.main_text(_BODY) != ""


@pytest.mark.parametrize("unit", ['<b " ', "x<a y ", "<b>", "<i \"'>", "<script ", "<div class=widget>x", "<! ", "</script "])
def test_open_tags_take_linear_time(unit):
    began = time.process_time()
    maintext.main_text(unit * 20_000 + "</i>" * 20_000)
    assert time.process_time() - began < 10


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>\"'ab =/", max_size=40))
def test_tags_end_where_the_plain_pattern_ends(page):
    """Also after a quote that stays open, from where on ends are looked up."""
    plain = re.compile(r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>")
    ends = maintext._Ends(page)
    for at in range(len(page)):
        assert ends.after(at) == (m.end() if (m := plain.match(page, at)) else -1)


def test_main_text_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "<p>" * 50_000), (2, "u", "<!--")], "page_id bigint, url string, html string")
    assert [r["text"] for r in maintext.report(pages).collect()] == [""] * 4
    assert maintext.report(pages.limit(0)).count() == 0


def test_offending_sentence_is_found(spark):
    rng = np.random.default_rng(5)

    def text(bad):
        parts = [" ".join(f"w{c}" for c in rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(8)]
        if bad:
            parts[3] += " grobian"
        return ". ".join(parts) + "."

    truth = [i % 2 for i in range(200)]
    sample = spark.createDataFrame([(t, text(t)) for t in truth] + [(0, None), (1, "")], "toxic int, text string")
    model = toxicity.train(sample, 0.5)
    own = text(1)
    score, at, worst = model.score(own)
    assert score > 0.5 > model.score(text(0))[0] and at <= own.index("grobian") < at + 60 and worst <= score
    assert model.score("")[0] == 0.5 and toxicity.train(sample.limit(0), 0.0).score("a b")[0] < 0.01


def test_every_offending_sentence_is_located(spark):
    model = toxicity.Model({"<grobian>": 8.0}, -4.0, 0.1)
    text = "All is well. You grobian. Fine days. A grobian again! Quiet"
    docs = spark.createDataFrame([(1, text), (2, "All is well. Fine days."), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert [o["start"] for o in got[1]["offending"]] == [text.index(" You"), text.index(" A grobian")]
    assert all(o["score"] > 0.9 for o in got[1]["offending"]) and got[1]["worst_at"] == text.index(" You")
    assert got[2]["offending"] == [] and got[3]["offending"] == []


def test_the_query_hands_out_offending_sentences(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: toxicity.Model({"<grobian>": 8.0}, -4.0, 0.1))
    text = "All is well. You grobian. Fine days. A grobian again! Quiet"
    rows = toxicity.report(documents(spark, [(1, text), (2, "Fine days."), (3, None)]), labels(spark, [])).collect()
    found = {r["doc_id"]: r["offending_at"] for r in rows}
    assert found == {1: f"{text.index(' You')},{text.index(' A grobian')}", 2: "", 3: ""}


@pytest.mark.parametrize("most", [1, 7, 40, 5000])
def test_the_sample_is_that_of_smallest_hashes(spark, most):
    """A language with nearly all rows, one with few, and none without rows."""
    rows = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 100 = 3, 'b', 'a') AS lang")
    rows = rows.unionByName(spark.createDataFrame([(None, "a")] * 5 + [(None, "c")], "doc_id bigint, lang string"))
    hashed = rows.where("doc_id IS NOT NULL").selectExpr("lang", "xxhash64('sample', doc_id) AS h", "doc_id").collect()
    want = {(r["doc_id"], x) for x in "ab" for r in sorted((r for r in hashed if r["lang"] == x), key=lambda r: r["h"])[:most]}
    found = [(r["doc_id"], r["lang"]) for r in langid._drawn(rows, most).collect()]
    assert len(found) == len(want) and set(found) == want


def test_unseen_words_fall_back():
    rows = [("de", "schule schulen haus"), ("en", "school schools house")]
    import pandas as pd

    found = []
    for lang, text in rows:
        for word, n in langid.terms(text).items():
            found.append((lang, 0, word, n))
            found += [(lang, k, g, n) for k in range(1, langid.LONGEST + 1) for g in langid.grams(word, k)]
    counts = pd.DataFrame(found, columns=["lang", "n", "term", "count"]).groupby(["lang", "n", "term"], as_index=False).sum()
    totals = counts.groupby(["lang", "n"], as_index=False).agg(total=("count", "sum"), kinds=("term", "count"))
    model = langid._model(totals, counts)
    assert model.predict("schulhaus", {})[0] == "de" and model.predict("schoolhouse", {})[0] == "en"
    assert model.predict("123", {}) == ("und", 0.0) and model.predict(None, {}) == ("und", 0.0)
