"""Registered queries against SQL twins, or against plain Python, over whole small tables."""

import html
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import SF_DIR

import __spark_entry__ as entry_points
from tradevigil.llm import licences, registry, words

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def run(spark, name):
    return registry.QUERIES[name](spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    got = run(spark, name)
    columns = sorted(got.columns)
    cursor = duck.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    expected = [tuple(dict(zip(names, row, strict=True))[c] for c in columns) for row in cursor.fetchall()]
    assert sorted(names) == columns
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(expected, key=repr)


def test_each_operator_is_registered_once():
    numbers = range(1, 14)
    assert [sum(n.startswith(f"op{i}_") for n in registry.QUERIES) for i in numbers] == [1] * len(numbers)
    assert {"pipeline", *registry.QUERIES} <= entry_points.queries().keys()


def test_order_minhash_edits(spark, texts):
    import hashlib

    ids = sorted(texts, reverse=True)
    rows = {r["doc_id"]: r for r in run(spark, "op1_order_minhash").collect()}
    assert sorted(rows, reverse=True) == ids
    for i, doc_id in enumerate(ids):
        own, after = texts[doc_id], ids[(i + 1) % len(ids)]
        edited = own[: len(own) - len(own) // 2] + texts[after][: len(own) // 2]
        r = rows[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_next"] == 1) == (r["fingerprint"] == rows[after]["fingerprint"])
    by_text = {}
    for doc_id, text in texts.items():
        assert by_text.setdefault(text, rows[doc_id]["fingerprint"]) == rows[doc_id]["fingerprint"]
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.1 > np.mean([r["near_next"] for r in rows.values()])


def test_license_scan_against_plain_search(spark, texts):
    for r in run(spark, "op4_license_scan").collect():
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]]))
        places, labels = [], set()
        for phrase, label in licences.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(own)) if own[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(own), len(places), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == (min(places, default=None), max(places, default=None))
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_toxicity_and_language_on_held_out_rows(duck, spark):
    big = f"{SF_DIR}/../sf0.01"
    scored = registry.QUERIES["op5_toxicity"](spark, big).toPandas()
    assert ((scored["score"] >= 0.5) == (scored["predicted"] == 1)).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()
    known = duckdb.sql(f"SELECT doc_id, toxic FROM '{big}/labels.parquet'").df().merge(scored, on="doc_id")
    known = known[known["held_out"]]
    assert (known["toxic"] == known["predicted"]).mean() > 0.9
    found = registry.QUERIES["op6_language_id"](spark, big).toPandas()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]).all()
    known = duckdb.sql(f"SELECT doc_id, lang FROM '{big}/documents.parquet'").df().merge(found, on="doc_id")
    assert (known["lang"] == known["lang_pred"])[known["held_out"]].mean() > 0.98


def test_main_text_is_the_article(duck, spark):
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    for r in run(spark, "op7_main_text").collect():
        article = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        plain = " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert (r["text"], r["n_chars"]) == (plain, len(plain))


def test_token_files_against_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(registry.vocabulary())
    rows = {r["doc_id"]: r for r in run(spark, "op8_token_files").collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = [*library.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert tuple(rows[doc_id]) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_near_dedup_against_all_pairs(spark, texts):
    rows = run(spark, "op9_simhash_near_dedup").collect()
    fps = {}
    for doc_id, text in texts.items():
        own = words.split(text, words.SPACED)
        counts, n = [0] * 64, max(1, len(own) - 3)
        for i in range(n if own else 0):
            h = xxhash.xxh64_intdigest(b" ".join(own[i : i + 4]), 42)
            counts = [c + (h >> b & 1) for b, c in enumerate(counts)]
        fps[doc_id] = sum(1 << b for b, c in enumerate(counts) if 2 * c > n)
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {d: f"{f:016x}" for d, f in fps.items()}
    parent = {d: d for d in fps}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert {r["doc_id"]: r["component_id"] for r in rows} == {d: root(d) for d in fps}
