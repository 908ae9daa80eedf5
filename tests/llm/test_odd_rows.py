"""Every operator on nulls, empty and very long texts, repeated rows, an empty table and clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import public_tokenizers
import pytest
import tiktoken

from martkit.llm import (
    byte_bpe,
    decontaminate,
    lang_id,
    licenses,
    lm_score,
    near_dedup,
    quality,
    sharding,
    suffix_dedup,
    url_lists,
)
from tests.helpers import frame

EMPTY = hashlib.sha256(b"").hexdigest()
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) for _ in range(n))


LONG = prose(1, 40_000)
ROWS = [(1, None), (2, ""), (3, LONG), (3, LONG), (None, prose(2, 300)), (None, None), (4, " \n\t"), (5, prose(3, 200)),
        (5, prose(4, 200)), (6, "ünï ßçø 東京 \U0001f600"), (7, "a" * 3000)]


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


DIGESTS = {
    "suffix": suffix_dedup.document_repeats,
    "near": near_dedup.document_duplicates,
    "language": lang_id.document_languages,
    "score": lm_score.document_scores,
    "bpe": lambda d: byte_bpe.encode(d, PATH, public_tokenizers.PATTERN),
    "quality": quality.document_quality,
    "sharding": sharding.shard_documents,
    "benchmark": lambda d: decontaminate.contaminated_documents(d, d.selectExpr("doc_id AS item_id", "text").where("doc_id = 5")),
    "licenses": licenses.document_licenses,
}


@pytest.mark.parametrize("name", DIGESTS)
def test_one_row_each_and_none_for_an_empty_table(docs, name):
    table = docs(*ROWS)
    got = DIGESTS[name](table)
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(i) for i, _ in ROWS)
    assert DIGESTS[name](table.where("false")).collect() == []


FILTERS = {
    "suffix": suffix_dedup.drop_repeats,
    "near": near_dedup.keep_one,
    "quality": quality.keep_good,
    "benchmark": lambda d: decontaminate.drop_contaminated(d, d.selectExpr("doc_id AS item_id", "text").where("doc_id = 6")),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(docs, name):
    table = docs(*ROWS)
    got = FILTERS[name](table)
    assert got.columns == table.columns
    assert got.select(*table.columns[5:]).distinct().count() == 1
    assert FILTERS[name](table.where("false")).collect() == []


def test_suffix_rows(docs):
    got = by_id(suffix_dedup.document_repeats(docs(*ROWS)))
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got[1] + got[2]] == [(0, 0, 0, EMPTY)] * 2
    # a repeated row is a copy, and a text that repeats itself loses all of it
    assert [(r["n_removed"], r["n_spans"]) for r in got[3]] == [(len(LONG), 1)] * 2
    assert [(r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got[7]] == [(3000, 1, EMPTY)]
    assert {r["n_removed"] for r in got[5]} == {0}


def test_near_rows(docs):
    got = by_id(near_dedup.document_duplicates(docs(*ROWS)))
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in got[1] + got[4]] == [(0, 1, True), (0, 4, True)]
    assert [(r["component_id"], r["kept"]) for r in got[3]] == [(3, True)] * 2
    assert got[6][0]["n_shingles"] == 1
    assert sorted((r["n_shingles"], r["component_id"], r["kept"]) for r in got[None])[0] == (0, None, True)
    kept = near_dedup.keep_one(docs(*ROWS)).select("doc_id", "text").collect()
    assert len(kept) == len(ROWS) - 1 and sum(r["text"] == LONG for r in kept) == 1


def test_language_and_score_rows(docs):
    got = by_id(lang_id.document_languages(docs(*ROWS)))
    assert {(r["lang_pred"], r["score"]) for i in (1, 2, 4) for r in got[i]} == {("und", 0.0)}
    assert {r["lang_pred"] for r in got[3]} == {"en"}
    alone = by_id(lang_id.document_languages(docs(*ROWS, lang=None)))
    assert {r["lang_pred"] for rows in alone.values() for r in rows} == {"und"}
    scored = by_id(lm_score.document_scores(docs(*ROWS)))
    assert {r["n_tokens"] for i in (1, 2, 4) for r in scored[i]} == {1}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) for i, rows in scored.items() if i for r in rows)


def test_sharding_rows(docs):
    rows = sharding.shard_documents(docs(*ROWS)).collect()
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r["doc_id"] == 1} == {1}
    assert len({r["shard"] for r in rows if r["doc_id"] == 3}) == 1


def test_bpe_round_trip(spark, docs):
    table = docs(*ROWS)
    encoded = byte_bpe.encode(table, PATH, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={}
    )
    want = sorted((str(i), plain.encode_ordinary(t or "")) for i, t in ROWS)
    assert sorted((str(r["doc_id"]), list(r["token_ids"])) for r in encoded.collect()) == want
    texts = byte_bpe.decode(encoded, PATH)
    assert sorted(r["text"] for r in texts.collect()) == sorted(t or "" for _, t in ROWS)
    digest = {str(i): hashlib.sha256((t or "").encode()).hexdigest() for i, t in ROWS if i in (1, 6, 7)}
    assert {str(r["doc_id"]): r["decoded_sha256"] for r in encoded.collect() if r["doc_id"] in (1, 6, 7)} == digest


def test_url_rows(spark):
    entries = frame(
        spark, "key string, list string, action string, day date",
        *[(k, n, a, __import__("datetime").date.fromisoformat(d)) for k, n, a, d in [
            ("example.com", "spam", "add", "2024-01-10"), ("example.com", "spam", "remove", "2024-02-10"),
            ("example.com", "spam", "add", "2024-01-20"), ("good.example.com", "allow", "add", "2024-01-01"),
            ("b.org/x", "adult", "add", "2024-01-05"), ("b.org/x", "adult", "remove", "2024-01-05"),
            ("b.org/y", "adult", "add", "2024-01-05"),
        ]], (None, "spam", "add", None),
    )
    day = __import__("datetime").date
    captures = frame(
        spark, "page_id long, url string, fetched date, host string, list string",
        (1, "http://a.example.com/p", day(2024, 1, 9), "h", "l"), (2, "http://u:p@A.example.com.:80/p?q", day(2024, 1, 10), "h", "l"),
        (3, "https://good.example.com/", day(2024, 1, 15), "h", "l"), (4, "http://a.example.com/p", day(2024, 2, 10), "h", "l"),
        (5, "http://b.org/x", day(2024, 1, 6), "h", "l"), (6, "http://b.org/y/z#f", day(2024, 1, 6), "h", "l"),
        (7, None, day(2024, 1, 6), "h", "l"), (8, "no url", day(2024, 1, 6), "h", "l"), (9, "http://b.org/y", None, "h", "l"),
        (2, "http://u:p@A.example.com.:80/p?q", day(2024, 1, 10), "h", "l"),
    )
    got = url_lists.filter_captures(captures, entries, "page_id")
    assert sorted((r["page_id"], r["entry"], r["blocked"]) for r in got.collect()) == [
        (1, None, False), (2, "example.com", True), (2, "example.com", True), (3, "good.example.com", False), (4, None, False),
        (5, None, False), (6, "b.org/y", True), (7, None, False), (8, None, False), (9, None, False),
    ]
    assert url_lists.filter_captures(captures, entries.where("false"), "page_id").where("blocked").count() == 0
    assert url_lists.filter_captures(captures.where("false"), entries, "page_id").count() == 0


def test_licence_inheritance(spark):
    files = frame(
        spark, "id long, path string, text string, license string",
        (1, "r/LICENSE", "MIT License\nReleased under the MIT License.", "x"), (2, "r/a/b/code.py", "def f(): pass", "x"),
        (3, "r/a/LICENSE.txt", "Licensed under the Apache License, Version 2.0.", "x"), (4, "r/other.py", "x = 1", "x"),
        (5, "r/a/own.py", "# Licensed under CC BY-NC 4.0.", "x"), (6, "q/f.py", None, "x"), (7, None, "", "x"),
    )
    found = licenses.inherited(licenses.notices(files, "id", "path", "text"))
    assert sorted((r["id"], r["license"], r["license_from"]) for r in found.collect()) == [
        (1, "MIT", "own"), (2, "Apache-2.0", "r/a"), (3, "Apache-2.0", "own"), (4, "MIT", "r"), (5, "CC-BY-NC-4.0", "own"),
        (6, None, None), (7, None, None),
    ]
