"""Places where an operator once did less than its whole job."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from martkit.llm import lang_id, licenses, lm_score, near_dedup, quality, suffix_dedup, tables
from tests.helpers import frame


# --- joined batches, language-model scores ------------------------------------


def test_joined_batches_over_two_gigabytes_keep_their_rows():
    one = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"x" * (100 << 20)])], ["key", "text"])
    (whole,) = tables.groups(iter([one] * 22), "key")
    assert whole.num_rows == 22 and whole.column("text").nbytes > 22 * (100 << 20)


def test_pairs_of_one_last_word_are_dealt_to_many_buckets(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "CELL_KEYS", 64)
    monkeypatch.setattr(lm_score, "MERGE_KEYS", 100)
    text = [" ".join(f"w{i}x{j} the" for j in range(300)) for i in range(10)]
    model = lm_score.train(docs(*enumerate(text)), "text")
    rows = model.collect()
    pairs = [r for r in rows if r["filter"] is not None]
    assert max(r["filter_bits"] for r in pairs) <= 64 * 9 * lm_score.BITS
    assert sum(r["n_words"] for r in rows) == 3001 + 1 and sum(r["n_tokens"] for r in rows) == 6010
    hot = lm_score.xxhash.xxh3_64_intdigest(b"the") >> (64 - lm_score.PREFIX)
    first = [((r["first"] + (1 << 63)) >> (64 - lm_score.PREFIX)) for r in pairs]
    assert first.count(hot) > 3000 // 64


def test_scores_do_not_change_with_blocks_and_words_that_no_training_text_has(docs):
    train = docs(*[(i, f"a{i} the b{i} the") for i in range(40)])
    model = lm_score.train(train, "text")
    table = docs(*[(i, f"a{i} the b{i} the new{i} x{i} y{i}") for i in range(200)])
    one, many = (
        {r["doc_id"]: (r["n_known"], r["base_score"], r["score"]) for r in
         lm_score.score(table, model, "doc_id", "text", [], block).collect()} for block in (1 << 27, 500)
    )
    assert len(list(lm_score._blocks(model, 500))) > 1
    assert one.keys() == many.keys() and all(np.allclose(one[i], many[i]) for i in one)
    assert [one[i][0] for i in (0, 39, 40)] == [5, 5, 3]


# --- licence scans --------------------------------------------------------------

GPL_HEADER = """/* frob.c
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }"""


def test_licences_by_full_text_wrapped_header_identifier_and_version(spark):
    texts = licenses.full_texts()
    prose = [(1000 + i, f"p/{i}.txt", f"the of and to in is a {i} free this with software you any use file") for i in range(300)]
    want = {
        "Copyright (c) 2020 A\n\n" + texts["MIT"]: "MIT", GPL_HEADER: "GPL-3.0-or-later",
        "# Copyright 2021 A. All rights reserved.\n#\n" + "\n".join("# " + x for x in texts["BSD-3-Clause"].split("\n")): "BSD-3-Clause",
        GPL_HEADER.replace("version 3", "version 2"): "GPL-2.0-or-later",
        "// SPDX-License-Identifier: MIT": "MIT", "/* SPDX-License-Identifier: MIT OR Apache-2.0 */": "MIT OR Apache-2.0",
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0-only",
        "GNU General Public License, version 2": "GPL-2.0-only", "Licensed under CC BY-NC 2.0": "CC-BY-NC-2.0",
        "x = 1": None,
    }
    rows = [(i, f"s/f{i}.c", text) for i, text in enumerate(want)]
    whole = [(100 + i, f"d{i}/LICENSE", text) for i, text in enumerate(texts.values())]
    files = frame(spark, "id long, path string, text string", *rows, *whole, *prose)
    got = {r["id"]: r["notice"] for r in licenses.notices(files, "id", "path", "text").collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())
    assert [got[100 + i] for i in range(len(texts))] == list(texts)
    assert not any(got[i] for i, _, _ in prose)
    assert licenses.exact("CC-BY-NC-4.0", "CC BY-NC 2.0") == "CC-BY-NC-2.0"


# --- languages --------------------------------------------------------------------


def labelled(spark, rows):
    return frame(spark, "doc_id long, text string, lang string", *[(i, t, g) for i, (t, g) in enumerate(rows)])


def test_every_label_is_learned_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "BLOCK_BYTES", 20_000)
    start = {f"l{k:03}": chr(0x4E00 + 20 * k) for k in range(210)}
    rows = [("".join(chr(ord(c) + (i * j) % 19) for j in range(1, 60)), g) for g, c in start.items() for i in (1, 2)]
    table = labelled(spark, rows)
    blocks = list(lang_id.fit(lang_id.sample(table, "text", "lang")))
    assert len(blocks) > 1 and sum(len(b["langs"]) for b in blocks) == 210
    got = {r["doc_id"]: r["lang_pred"] for r in lang_id.predict(table, blocks).collect()}
    assert [got[i] for i in range(len(rows))] == [g for _, g in rows]


def test_excerpts_are_of_different_texts(spark):
    table = labelled(spark, [("copy of one text", "a")] * 500 + [(f"text number {i}", "a") for i in range(200)])
    got = [r["text"] for r in lang_id.sample(table, "text", "lang").collect()]
    assert len(got) == len(set(got)) == lang_id.EXCERPTS


# --- quality rules -----------------------------------------------------------------

CLEAN = {
    "Han": "今天的天气非常好我们决定一起去公园散步看看花草树木还有小鸟", "Japanese": "わたしたちはきのうコーヒーをのみながらほんをよみましたとてもたのしかった",
    "Thai": "วันนี้อากาศดีมากพวกเราจึงตัดสินใจไปเดินเล่นที่สวนสาธารณะด้วยกัน", "Lao": "ມື້ນີ້ອາກາດດີຫຼາຍພວກເຮົາຈຶ່ງໄປຍ່າງຫຼິ້ນຢູ່ສວນສາທາລະນະ",
    "Khmer": "ថ្ងៃនេះអាកាសធាតុល្អណាស់យើងសម្រេចចិត្តទៅដើរលេងនៅសួនច្បារ", "Myanmar": "ယနေ့ရာသီဥတုကောင်းသဖြင့်ကျွန်ုပ်တို့ပန်းခြံသို့သွားကြသည်",
    "Tibetan": "དེ་རིང་གནམ་གཤིས་ཡག་པོ་འདུག་ང་ཚོ་གླིང་ག་ལ་འགྲོ་བར་ཐག་བཅད་པ་ཡིན",
}


def test_clean_texts_of_every_script_pass(docs):
    rows = [(i, " ".join(w[k % len(w) :] + w[: k % len(w)] for k in range(25))) for i, w in enumerate(CLEAN.values())]
    rows.append((len(CLEAN), " ".join(f"{chr(0x915 + k)}ीं{chr(0x939 - k)}ीं" for k in range(25))))  # Devanagari
    bad = [(100, " ".join(f"{k}" + "x" * 40 for k in range(25)) + " 天"), (101, " ".join(f"{k}12345天" for k in range(1000, 1025)))]
    got = {r["doc_id"]: r["rejected_by"] for r in quality.reject_reasons(docs(*rows, *bad)).collect()}
    assert {name: got[i] for i, name in enumerate(CLEAN)} == dict.fromkeys(CLEAN) and got[len(CLEAN)] is None
    assert (got[100], got[101]) == ("word_length", "letters")


# --- repeated passages in the pipeline ----------------------------------------------


def without_repeats(texts, length=50):
    """The words outside every passage of so many words that starts at two places."""
    places = defaultdict(list)
    for i, text in texts.items():
        words = text.split()
        for at in range(len(words) - length + 1):
            places[tuple(words[at : at + length])].append((i, at))
    covered = {(i, k) for where in places.values() if len(where) > 1 for i, at in where for k in range(at, at + length)}
    return {i: [w for k, w in enumerate(t.split()) if (i, k) not in covered] for i, t in texts.items()}


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 0])
def test_pipeline_cuts_passages_of_fifty_words(spark, docs, monkeypatch, hot):
    """Far shorter than 400 bytes, of just under and over 50 words, with other white space, and repeated in one text."""
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    draw = random.Random(hot)

    def noise(n):
        return ["".join(draw.choices("abcdeé", k=draw.randint(1, 4))) for _ in range(n)]

    shared = [noise(n) for n in (49, 50, 51, 60, 130, 30)]
    period = noise(7)
    texts = {}
    for i in range(60):
        words = noise(draw.randint(0, 60))
        for _ in range(draw.randint(0, 4)):
            words += draw.choice([*shared, period * draw.randint(2, 12)])[draw.choice([0, 0, 1, 20]) :] + noise(draw.randint(0, 20))
        texts[i] = "".join(w + draw.choice([" ", " ", " ", "\n", "  ", "\t"]) for w in words)
    texts[60] = texts[61] = "  " + " ".join(noise(50))  # copies
    texts[62] = texts[63] = " ".join(noise(49))  # neither 50 words nor 400 bytes
    texts[64] = ""
    long = "漢字" * 20 + "".join(noise(150))  # a passage of 400 bytes and one word
    texts[65], texts[66] = "my start" + long + "my end", "one" + long + "two"
    table = docs(*texts.items()).repartition(5)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_dedup_stage(spark, table, "").collect()}
    want = without_repeats(texts)
    assert len(long.encode()) >= 400 and (got.pop(65), got.pop(66)) == ("my startmy end", "onetwo")
    assert {i: t.split() for i, t in got.items()} == {i: w for i, w in want.items() if i < 65}
    assert got[60] == got[61] == "" and sum(t == texts[i] for i, t in got.items()) > 5
    assert sum(1 for i, t in texts.items() if len(t.split()) > len(want[i])) > 20


# --- near copies ------------------------------------------------------------------


def edited_copies(texts: int, copies: int) -> list[str]:
    """Copies of some texts, some words of each drawn anew: at the most a third."""
    draw = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    heads = [draw.choices(words, k=120) for _ in range(texts)]
    rates = [[0.0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.33][i % 8] for i in range(copies)]
    return [" ".join(draw.choice(words) if draw.random() < r else w for w in h) for h in heads for r in rates]


def plain_components(texts: list[str]) -> list[int]:
    sets = [near_dedup.shingle_set(t.encode()) for t in texts]
    own = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if own[i] != own[j] and near_dedup.similar(sets[i], sets[j]):
                a, b = sorted((own[i], own[j]))
                own = [a if x == b else x for x in own]
    return own


def test_near_copies_of_one_text_do_not_multiply(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE_ROWS", 12)
    monkeypatch.setattr(near_dedup, "HUBS", 3, raising=False)
    counts, likely = [], near_dedup._likely

    def counted(nodes, classes):
        counts.append(nodes.count())
        return likely(nodes, classes)

    monkeypatch.setattr(near_dedup, "_likely", counted)
    texts = edited_copies(2, 120)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.document_duplicates(docs(*enumerate(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == plain_components(texts)
    assert counts[0] < 3 * near_dedup.TREES * len(texts)


def test_meetings_compare_every_two_rows_of_different_components_once_on_two_sides(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE_ROWS", 6)
    roots = [0] * 14 + [1] * 5 + list(range(20, 27))
    rows = [(0, 7, i, 10, 26, 260, root) for i, root in enumerate(roots)]
    tight = frame(spark, "tree int, node long, cls long, n long, rows long, weight long, root long", *rows)
    met = defaultdict(list)
    for r in near_dedup._meetings(tight).collect():
        met[r["node"]].append((r["side"], r["cls"]))
    pairs = []
    for members in met.values():
        assert len(members) <= 24
        pairs += [tuple(sorted((x, y))) for s, x in members for t, y in members if (s == t == -1 and x < y) or (s, t) == (0, 1)]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) >= {(x, y) for x in range(26) for y in range(x + 1, 26) if roots[x] != roots[y]}
    assert not near_dedup._meetings(tight.where("root = 0")).collect()


def test_bits_of_a_node_bound_what_sets_share(monkeypatch):
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 300, n).astype(np.uint64)) for n in draw.integers(1, 200, 60)]
    sets += [np.append(s[: len(s) * 9 // 10], np.uint64(1000 + i)) for i, s in enumerate(sets)]
    for columns in (1 << 14, 64, 5):
        monkeypatch.setattr(near_dedup, "COLUMNS", columns)
        common = near_dedup._Common(sets)
        for i, one in enumerate(sets):
            others = np.delete(np.arange(len(sets)), i)
            may = common.may_link(i, others)
            want = np.array([near_dedup.similar(one, sets[j]) for j in others])
            assert not (want & ~may).any() and (columns < 300 or (want == may).all())


# --- repeated passages of words ---------------------------------------------------


def test_word_passages_are_sorted_by_short_codes(monkeypatch):
    draw = np.random.default_rng(5)
    sorted_bytes, plain = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, depth: sorted_bytes.append(len(text)) or plain(text, depth))
    measure = suffix_dedup.Measure(4, 2, 8)
    for kinds in (1, 2, 200, 256, 257, 3000):
        words = draw.integers(0, 2**63, kinds, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        numbers = [draw.integers(0, kinds, 40) for _ in range(30)]
        numbers += [np.concatenate([draw.integers(0, kinds, 5), x[10:20], draw.integers(0, kinds, 5)]) for x in numbers[:10]]
        starts = [len(x) - 3 for x in numbers]
        twice = draw.random(len(numbers)) < 0.1
        found = Counter()
        for x, more in zip(numbers, twice):
            found.update({tuple(x[i : i + 4]): 0 for i in range(len(x) - 3)})
            for i in range(len(x) - 3):
                found[tuple(x[i : i + 4])] += 2 if more else 1
        flags = [[found[tuple(x[i : i + 4])] > 1 for i in range(len(x) - 3)] for x in numbers]
        want = [np.flatnonzero(np.diff(f, prepend=False, append=False)).tolist() for f in flags]
        assert suffix_dedup.repeated_starts([words[x].tobytes() for x in numbers], starts, twice, measure) == want
        assert sorted_bytes.pop() <= (1 if kinds <= 256 else 2) * sum(map(len, numbers))
