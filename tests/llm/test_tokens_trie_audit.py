"""Token files, the prefix trie and the divergence audit against plain versions, and on odd rows."""

from __future__ import annotations

import glob
import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from martkit.llm import divergence, prefix_trie, token_files
from martkit.llm.tables import table
from martkit.workspace import new_folder
from tests.helpers import frame
from tests.oracle import connect, differences

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Tokenizer.from_file(PATH)


# --- token files ----------------------------------------------------------------


def plain_files(encoder, texts):
    """start, n_tokens and checksum of texts in file order."""
    out, at = [], 0
    for text in texts:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, sf, encoder):
    docs = table(spark, sf, "documents")
    got = token_files.document_tokens(docs, PATH, public_tokenizers.PATTERN).orderBy("start").collect()
    rows = docs.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    assert [tuple(r)[1:] for r in got] == plain_files(encoder, [r["text"] for r in rows])


def test_odd_rows_of_token_files(docs, encoder):
    rows = [(5, "b"), (5, "a"), (5, "a"), (None, "x"), (1, None), (2, ""), (-3, "ünï 東京 <|endoftext|>"), (9, "word " * 90_000)]
    got = token_files.document_tokens(docs(*rows).repartition(3), PATH).collect()
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, -3, 1, 2, 5, 5, 5, 9]
    texts = {str(i): t for i, t in rows if i != 5}
    five = [r["ids_crc32"] for r in got if r["doc_id"] == 5]
    order = ["a", "a", "b"] if five[0] == five[1] else ["b", "a", "a"]
    want = plain_files(encoder, [order.pop(0) if r["doc_id"] == 5 else texts[str(r["doc_id"])] for r in got])
    assert [tuple(r)[1:] for r in got] == want
    assert token_files.document_tokens(docs(*rows).where("false"), PATH).collect() == []


def test_parts_give_the_ids_of_the_whole(encoder):
    draw = random.Random(3)
    words = ["don't", "it's 12", "x_1", "東京", "été", "a  b", "\n\n", " \t", "...", "<|endoftext|>", "(a)", "ß", "१२", "a b", "x" * 40]
    for _ in range(200):
        text = "".join(draw.choice(words) + draw.choice([" ", "\n", "", "  "]) for _ in range(draw.randint(1, 80)))
        parts = token_files.parts_of(text, draw.randint(1, 30))
        assert "".join(parts) == text
        joined = [i for p in parts for i in encoder.encode(p, add_special_tokens=False).ids]
        assert joined == encoder.encode(text, add_special_tokens=False).ids


def test_matches_are_encoded_as_in_the_whole_text(encoder):
    """Every character, assigned or not, beside letters, digits, spaces and marks; and added tokens."""
    with open(PATH, encoding="utf-8") as file:
        pieces = token_files.Encoder(file.read(), public_tokenizers.PATTERN)
    characters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b 1{c}2 {c}.{c}{c} {c}x" for c in characters[i : i + 64]) for i in range(0, len(characters), 64)]
    texts += ["", "<|endoftext|>", "one <|endoftext|> two", "it's 'tis ''s !'s 's\n's", "  two   three \n\n x\t\ty "]
    for first in range(0, len(texts), 500):
        part = texts[first : first + 500]
        want = [e.ids for e in encoder.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(b, np.int32).tolist() for b in pieces.encode(part)] == want


def test_pieces_between_single_spaces(encoder, monkeypatch):
    """White space of all kinds, long pieces, clashing hashes and a memo that overflows; few pieces are split again."""
    with open(PATH, encoding="utf-8") as file:
        pieces = token_files.Encoder(file.read(), public_tokenizers.PATTERN)
    seen = []
    monkeypatch.setattr(pieces, "_matched", lambda text, f=pieces._matched: seen.append(len(text)) or f(text))
    text = " ".join(f"word{i % 50}, of the" for i in range(4000))
    want = encoder.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(pieces.encode([text])[0], np.int32).tolist() == want and sum(seen) < len(text) // 20
    draw = random.Random(9)
    words = [*map(chr, token_files.SPACES), "  ", "\r\n", " a", " b", " the", "don't", "12", "½", "東京", "\u0378", "!", "'s", "\0", "“"]
    words += ["x" * n + "é" for n in (7, 8, 31, 32, 40)] + ["<|endoftext|>"]
    for memo, key in ((40, 32), (500_000, 0)):
        monkeypatch.setattr(token_files, "MEMO", memo)
        monkeypatch.setattr(token_files, "KEY_BYTES", key)
        for i in range(60):
            texts = ["".join(draw.choices(words[: len(words) - i % 2], k=draw.randint(0, 60))) for _ in range(20)]
            want = [e.ids for e in encoder.encode_batch(texts, add_special_tokens=False)]
            assert [np.frombuffer(b, np.int32).tolist() for b in pieces.encode(texts)] == want


def test_long_matches_are_not_remembered(encoder, monkeypatch):
    """The memo's bytes are bounded too; others reach the model once, whatever they stand beside."""
    with open(PATH, encoding="utf-8") as file:
        pieces = token_files.Encoder(file.read(), public_tokenizers.PATTERN)
    seen = []
    monkeypatch.setattr(pieces, "_learnt", lambda matches, f=pieces._learnt: seen.extend(matches.to_pylist()) or f(matches))
    long = "x" * (token_files.KEY_BYTES + 1)
    for text in (f"so the {long} and {long}, the end", f"so and the, {long} the end", f"so {long} the and end"):
        want = encoder.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(pieces.encode([text])[0], np.int32).tolist() == want
        assert sorted(pieces.memo.to_pylist()) == [" and", " end", " the", ","]
    assert Counter(seen) == {" and": 1, " end": 1, " the": 1, ",": 1, f" {long}": 3}


def scanned_rows(df):
    """Rows that the scan of the largest table gave out."""
    df.collect()
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if "Scan orc" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return max(found)


def test_files_are_read_in_part(spark, encoder):
    """Stripes, row indexes, Bloom filters on ids, and spans of the whole sequence of ids."""
    docs = spark.range(0, 20_000, 2).selectExpr("id * 7 AS doc_id", "concat('word ', id, ' and ', id % 13) AS text")
    path = new_folder(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        token_files.write_tokens(docs, path, PATH, stripe_bytes=64 << 10)
        files = glob.glob(f"{path}/tokens/*.orc")
        assert len(files) > 1 and max(orc.ORCFile(f).nstripes for f in files) > 1
        whole = token_files.read_tokens(spark, path)
        assert scanned_rows(whole) == 10_000
        one = token_files.read_documents(spark, path, [14 * 777])
        assert scanned_rows(one) <= token_files.INDEX_ROWS
        assert [r["ids"] for r in one.collect()] == [[*encoder.encode("word 1554 and 7").ids, 2]]
        # between two ids: only the Bloom filter can tell
        assert sum(scanned_rows(token_files.read_documents(spark, path, [14 * i + 3])) for i in range(1, 6)) <= token_files.INDEX_ROWS
        ids = [i for r in whole.orderBy("start").collect() for i in r["ids"]]
        for first, end in ((0, 10), (12_345, 12_400), (len(ids) - 3, len(ids) + 50), (7, 7), (len(ids), len(ids) + 1), (0, len(ids))):
            span = token_files.read_span(spark, path, first, end).orderBy("start")
            rows = span.collect()
            assert [i for r in rows for i in r["ids"]] == ids[first:end]
            assert all(r["n_tokens"] == len(r["ids"]) for r in rows) and (not rows or rows[0]["start"] == first)
        assert scanned_rows(token_files.read_span(spark, path, 12_345, 12_400)) <= 2 * token_files.INDEX_ROWS
        assert token_files.files_of(spark, path).count() == len(files)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- prefix trie ----------------------------------------------------------------


def test_range_minimum():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 64, 100):
        values = draw.integers(0, 6, n)
        tree = prefix_trie.RangeMinimum(values)
        places = np.arange(n + 1)
        for least in range(8):
            right = tree.reach_right(places, np.full(n + 1, least))
            left = tree.reach_left(places, np.full(n + 1, least))
            for p in range(n + 1):
                assert right[p] == next((i for i in range(p, n) if values[i] < least), n)
                assert left[p] == next((i + 1 for i in range(p - 1, -1, -1) if values[i] < least), 0)
        if n:
            a = draw.integers(0, n, 50)
            b = a + 1 + draw.integers(0, n, 50) % (n - a)
            assert tree.minimum(a, b).tolist() == [values[x:y].min() for x, y in zip(a, b)]


def plain_trie(rows):
    """Nodes of the rebuilt conversations from (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[3] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = turns.get(c // 100 * 100, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].add(c)
        ends[tuple(whole)].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    return sorted(
        (min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, ids in members.items()
    )


DDL = "conv_id long, turn long, role string, text string, node string, depth int, path string"


def nodes_of(spark, rows, parts=3):
    df = frame(spark, DDL, *[(*r, "n", 1, "p") for r in rows]).repartition(parts)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df).collect()))


@pytest.mark.parametrize("turns", [prefix_trie.BLOCK_TURNS, 30])
def test_trie_matches_sql(spark, sf, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", turns)
    got = prefix_trie.conversation_trie(table(spark, sf, "conversations"))
    assert differences(got, connect(sf), prefix_trie.CONVERSATION_TRIE_SQL) is None


@pytest.mark.parametrize("turns", [prefix_trie.BLOCK_TURNS, 40, 5])
def test_trie_of_shared_prefixes(spark, monkeypatch, turns):
    """Many conversations of few different turns, a third of them the same, over blocks of several sizes and levels."""
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", turns)
    draw = random.Random(turns)
    rows = []
    for c in range(0, 300):
        n = 4 if c % 3 == 0 else draw.randint(0, 9)
        for t in range(n):
            rows.append((c + 1000, t, "user", "same" if c % 3 == 0 else draw.choice(["a", "bb", "ü" * 7])))
    assert nodes_of(spark, rows) == plain_trie(rows)


def test_odd_conversations(spark):
    long = "wörd " * 100_000
    rows = [
        (1, None, "user", "first"), (1, 0, "user", "second"), (1, 0, "user", "second"), (2, 3, None, None), (2, 4, "", ""),
        (None, 1, "user", "nobody's"), (3, 0, "user", long), (4, 0, "user", long), (100, 0, "a", "x"), (100, 0, "b", "x"),
        (142, 0, "a", "own"), (0, 0, "user", "base"), (7, 1, "use", "r1:first"), (8, 1, "user", "1:first"),
    ]
    assert nodes_of(spark, rows) == plain_trie(rows)
    assert nodes_of(spark, [(None, 1, "a", "b")]) == [] and nodes_of(spark, []) == []


# --- divergence -----------------------------------------------------------------


def plain_audit(rows):
    """Ranked rows from (text, lang, source)."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups[lang].add(source)
        count[lang, source].update(terms)
        count[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= 10)

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return [1 + 10**9 * (counts[t] + 2) // total for t in kept]

        share = {s: shares(count[lang, s]) for s in sources}
        whole = shares(count[lang])
        for s in sources:
            pairs = [(o, sum((p - q) ** 2 // (p + q) for p, q in zip(share[s], share[o]))) for o in sources - {s}]
            terms = [(t, (p - q) ** 2 // (p + q)) for t, p, q in zip(kept, share[s], whole) if count[lang, s][t] and p > q]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i) for i, (item, v) in enumerate(found, 1) if part == "pair" or i <= 10]
    return sorted(out)


def test_audit_matches_sql(spark, sf, monkeypatch):
    con = connect(sf)
    assert differences(divergence.source_audit(table(spark, sf, "documents")), con, divergence.SOURCE_AUDIT_SQL) is None
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 37)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "COUNTED_TERMS", 500)
    assert differences(divergence.source_audit(table(spark, sf, "documents")), con, divergence.SOURCE_AUDIT_SQL) is None


def test_odd_documents_of_the_audit(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 1000)
    words = ["Alpha", "BETA", "ÉTÉ", "été", "ß1ß", "東京", "a_b", " ", "\U0001f600x"]
    draw = random.Random(5)
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 12))), draw.choice(["en", None]), draw.choice(["s", "t", None, "é", "z" * 9]))
            for _ in range(120)]
    rows += [(None, "en", "empty"), ("", None, "s"), ("few words", "xx", "a"), (None, "xx", "b"), ("alone", "yy", "c")]
    rows += [("Alpha same row", "en", "s")] * 40 + [("tie one two", "en", f"t{i}") for i in range(12)]
    rows += [("gamma delta " * 20_000, "en", "long")]
    df = frame(spark, "text string, lang string, source string, term string, n long, block int, value long",
               *[(*r, "x", 1, 2, 3) for r in rows]).repartition(4)
    got = sorted(tuple(r) for r in divergence.source_audit(df).collect())
    assert got == plain_audit(rows)
    assert divergence.source_audit(df.where("false")).collect() == []


def test_shares_are_exact():
    draw = random.Random(1)
    for _ in range(300):
        total = draw.randint(1, 10 ** draw.randint(1, 15))
        count, terms = draw.randint(0, total), draw.randint(1, 10**9)
        assert divergence.share(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 2) // (total + 2 * terms)
