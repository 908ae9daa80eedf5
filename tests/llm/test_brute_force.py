"""Every operator against a plain version of its contract, over whole small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline
from martkit.llm import byte_bpe, decontaminate, lm_score, near_dedup, quality, suffix_dedup
from martkit.llm.suffix_array import suffix_array
from martkit.llm.tables import table
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, sf, "documents").collect()}


def result(spark, sf, name):
    return entry_points.queries()[name](spark, sf)


# --- suffix arrays -------------------------------------------------------------


def plain_suffixes(data: bytes, depth: int):
    order = sorted(range(len(data)), key=lambda i: data[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < depth and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        common.append(n)
    return order, common


@pytest.mark.parametrize("limit", [0, 64, 1 << 20])
def test_suffix_array(limit):
    draw = np.random.default_rng(limit)
    for _ in range(400):
        data = (draw.integers(0, draw.integers(1, 5), draw.integers(1, 70)) + draw.choice([0, 97, 251])).astype(np.uint8)
        position, common = suffix_array(data, 1000, limit)
        assert (position.tolist(), common.tolist()) == plain_suffixes(data.tobytes(), 1000)
    # to a limited depth: in order and grouped up to there
    words = [draw.integers(97, 100, n).astype(np.uint8) for n in (3, 5, 9)]
    data = np.concatenate([words[i] for i in draw.integers(0, 3, 60)])
    position, common = suffix_array(data, 8, limit)
    order, full = plain_suffixes(data.tobytes(), 8)
    starts = [data.tobytes()[i : i + 8] for i in position]
    assert starts == [data.tobytes()[i : i + 8] for i in order] and common.tolist() == full
    assert len(suffix_array(data[:0], 8)[0]) == 0


def plain_repeats(texts, length=400):
    places = defaultdict(list)
    for i, text in texts.items():
        for at in range(len(text) - length + 1):
            places[text[at : at + length]].append((i, at))
    covered = {i: np.zeros(len(t), bool) for i, t in texts.items()}
    for where in places.values():
        if len(where) > 1:
            for i, at in where:
                covered[i][at : at + length] = True
    out = {}
    for i, text in texts.items():
        c = covered[i]
        kept = np.frombuffer(text, np.uint8)[~c].tobytes()
        spans = int(np.sum(np.diff(c.astype(int), prepend=0) == 1))
        out[i] = len(text), int(c.sum()), spans, hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 0])
def test_repeats(spark, sf, texts, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    got = result(spark, sf, "op1_suffix_array_dedup").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == plain_repeats(texts)
    assert sum(r["n_removed"] for r in got) > 0


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 0])
def test_planted_repeats(spark, monkeypatch, hot):
    """Passages of about the length that counts, shared lines shorter than that, and texts that repeat themselves."""
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    draw = random.Random(hot)

    def noise(n):
        return "".join(draw.choice("abcdefghij \n") for _ in range(n))

    shared = [noise(n) for n in (399, 400, 401, 520, 250, 1200)]
    period = noise(37)
    texts = {}
    for i in range(60):
        parts = [noise(draw.randint(0, 300))]
        for _ in range(draw.randint(0, 4)):
            one = draw.choice([*shared, period * draw.randint(2, 30), period[: draw.randint(1, 37)] * 40])
            cut = draw.choice([0, 0, draw.randint(0, len(one) // 3)])
            parts += [one[cut:], noise(draw.randint(0, 60))]
        texts[i] = "".join(parts).encode()
    docs = spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.document_repeats(docs).collect()}
    assert got == plain_repeats(texts)


def test_cut_texts(spark, sf, texts):
    want = plain_repeats(texts)
    for r in suffix_dedup.drop_repeats(table(spark, sf, "documents")).collect():
        removed = want[r["doc_id"]][1]
        assert len(texts[r["doc_id"]]) - removed - 8 * want[r["doc_id"]][2] <= len(r["text"].encode())
        assert r["n_chars"] == len(r["text"]) and (removed or r["text"].encode() == texts[r["doc_id"]])


# --- near duplicates -----------------------------------------------------------


def plain_components(texts):
    sets = {}
    for i, text in texts.items():
        words = text.lower().split()
        n = max(len(words) - 4, min(len(words), 1))
        sets[i] = {tuple(words[k : k + 5]) for k in range(n)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(k for x in s for k in holders[x] if k < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("rows, depth", [(near_dedup.NODE_ROWS, near_dedup.DEPTH), (3, 6), (2, 1)])
def test_components(spark, sf, texts, monkeypatch, rows, depth):
    """Also with nodes so small that they branch, and that classes no token divides are dealt in blocks."""
    monkeypatch.setattr(near_dedup, "NODE_ROWS", rows)
    monkeypatch.setattr(near_dedup, "DEPTH", depth)
    got = {r["doc_id"]: tuple(r)[1:] for r in result(spark, sf, "op3_near_duplicates").collect()}
    assert got == plain_components(texts)


def test_one_stays(spark, sf, texts):
    kept = {r["doc_id"] for r in near_dedup.keep_one(table(spark, sf, "documents")).collect()}
    assert kept == {i for i, (_, _, stays) in plain_components(texts).items() if stays}


# --- language, scores ----------------------------------------------------------


def test_languages(spark, sf):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").collect()}
    got = result(spark, sf, "op4_language_id").collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("block", [lm_score.BLOCK_BYTES, 20_000])
def test_scores(spark, sf, texts, monkeypatch, block):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_score.score, "__defaults__", (block,))
    tokens = {i: [*t.lower().split(), b"\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count, pairs = Counter(), Counter()
    for i, t in tokens.items():
        if not held[i]:
            count.update(t)
            pairs.update(zip([b"\n", *t], t))
    total = sum(count.values())
    norm = total + len(count) + 1
    model = exact = base_all = 0.0
    for r in result(spark, sf, "op5_lm_scoring").collect():
        t = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 1) / norm) for w in t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]], len(t), sum(count[w] > 0 for w in t), total,
        )
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        model, base_all = model + r["score"], base_all + base
        exact += sum(
            math.log10(((2 ** int(math.log2(n)) if (n := pairs[(a, b)]) else 0) + lm_score.STRENGTH * (count[b] + 1) / norm)
                       / (count[a] + lm_score.STRENGTH)) for a, b in zip([b"\n", *t], t)
        )
    # strange pairs that the filter takes for known ones only raise the score, by little
    assert exact <= model <= exact * 0.95 and model > base_all


# --- byte pairs, benchmark, quality, shards, URLs --------------------------------


def test_byte_pairs(spark, sf, texts):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in result(spark, sf, "op6_byte_bpe").collect():
        text = texts[r["doc_id"]]
        ids = plain.encode_ordinary(text.decode())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text).hexdigest(),
        )


@pytest.mark.parametrize("most", [decontaminate.BLOCK_WINDOWS, 300])
def test_contamination(spark, sf, texts, monkeypatch, most):
    words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for r in table(spark, sf, "benchmark").collect():
        w = words.findall(r["text"].encode().lower())
        for k in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + 13])].add(str(r["item_id"]))
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    monkeypatch.setattr(decontaminate.contamination, "__defaults__", ("doc_id", "text", "item_id", "text", 13, most))
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contaminated_documents(docs, items).collect()}
    for i, text in texts.items():
        w = words.findall(text.lower())
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert got[i] == (len(w), len(hit), len(found), ids, 0 < len(hit) and 20 * len(hit) >= len(w))
    assert any(r[-1] for r in got.values())
    clean = decontaminate.drop_contaminated(docs, items)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if not r[-1]}
    rest = decontaminate.remove_spans(docs, items).collect()
    assert {len(words.findall(r["text"].encode().lower())) == got[r["doc_id"]][0] - got[r["doc_id"]][1] for r in rest} == {True}


def plain_quality(text: str):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    repeated = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(repeated), failed)


def test_quality(spark, sf, texts):
    good = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 1").collect()}
    kept = set()
    for r in result(spark, sf, "op7_quality_rules").collect():
        assert tuple(r)[1:7] == plain_quality(texts[r["doc_id"]].decode())
        assert not (r["kept"] and r["base_failed"])
        assert r["kept"] or r["base_failed"] or r["doc_id"] not in good
        kept |= {r["doc_id"]} if r["kept"] else set()
    stage = corpus_pipeline.quality_rules(spark, table(spark, sf, "documents"), sf)
    assert {r["doc_id"] for r in stage.collect()} == kept


def test_shards(spark, sf, texts):
    got = result(spark, sf, "op8_sharding").collect()
    for r in got:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]))
        draws = [int(hashlib.md5(f"{r['doc_id']}:{s}".encode()).hexdigest()[:13], 16) for s in range(9)]
        assert (r["shard"], r["grown_shard"]) == (max(range(8), key=draws.__getitem__), max(range(9), key=draws.__getitem__))
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_urls(spark, sf):
    con = connect(sf)
    for name, sql in entry_points.CORPUS_ORACLE.items():
        assert differences(result(spark, sf, name), con, sql) is None


def test_licences(spark, sf, texts):
    notice = {b"Released under the MIT License.": "MIT", b"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
              b"Licensed under the Apache License, Version 2.0.": "Apache-2.0", b"All rights reserved.": "Proprietary",
              b"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    for r in result(spark, sf, "op10_license_scan").collect():
        lines = texts[r["doc_id"]].split(b"\n")
        assert r["notice"] == next((notice[x] for x in lines if x in notice), None)


# --- pipeline ------------------------------------------------------------------


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, sf)
        assert done.columns == docs.columns, name
        docs = corpus_pipeline.written(done)
        assert 0 < docs.count()
    last = corpus_pipeline.run(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()
    }


def test_quality_sql_on_other_scripts(spark):
    """Scripts without spaces, vowel signs, and texts of long words that neither excuses."""
    draw = random.Random(11)

    def words(letters, n, low, high):
        return " ".join("".join(draw.choices(letters, k=draw.randint(low, high))) for _ in range(n))

    han, thai, hindi = "漢字東京語文書読中国人日本", "กขคงจชซญดตถทธนบปผพภมยรลวสหอ" + "ะาำิีึืุู", "कखगघचजतदनपबमयरलवसह" + "ािीुूेैोौं"
    texts = [
        words(han, 25, 18, 30), words(thai, 25, 18, 40), words(hindi, 30, 3, 9), words("abc", 25, 16, 30), words("a1111", 30, 3, 8),
        words(han + "abcdefgh", 25, 14, 20), words(han[0] + "abcdefghijklmnop", 30, 16, 18), "漢" * 400, words("áñ", 40, 2, 6), None, "",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = quality.document_quality(spark.createDataFrame(rows, "doc_id long, text string"))
    assert differences(got, con, quality.DOCUMENT_QUALITY_SQL) is None
    kept = {r["doc_id"] for r in got.collect() if r["kept"]}
    assert {0, 1, 2} <= kept and 3 not in kept and 4 not in kept
