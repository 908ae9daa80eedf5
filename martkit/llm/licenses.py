"""License scans (operator 10): TF-IDF cosine to templates, then inheritance along the directories.

Every line of a text, blocks of its words around words of licences, and the
whole of a licence file are compared with notices, standard headers and full
texts: cosine of sparse vectors whose weights count how many documents hold a
template's term. The version, and which of several like licences it is, is read
from the matched words. An SPDX identifier counts as written. A file without a
notice of its own takes the licence of the nearest directory above it that has a
licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import byte_list, record, utf8
from martkit.operators.spread import left_lookup
from martkit.workspace import written

LEAST = 0.6  # cosine from which a notice counts
LICENCE_FILE = "(?i)^(licen[cs]e|copying|unlicense|notice)(\\.(txt|md|rst))?$"

# Notices by which the licences ask to be named, under their SPDX ids.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0-only": "This library is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0-only": "This program is licensed under the GNU Affero General Public License, version 3",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license, redistribution and use in source and binary forms",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright, CC0 1.0 Universal public domain",
    "Proprietary": "All rights reserved",
}

# Standard headers beside the notices: paragraphs as the licences' own texts recommend them.
_GNU = ("This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General "
        "Public License as published by the Free Software Foundation, either version {v} of the License, or (at your "
        "option) any later version.")
HEADERS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0-or-later": _GNU.format(work="program", kind="", v=3),
    "LGPL-3.0-or-later": _GNU.format(work="library", kind="Lesser ", v=3),
    "AGPL-3.0-or-later": _GNU.format(work="program", kind="Affero ", v=3),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the Software), to deal in the Software without restriction",
    "CC0-1.0": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright "
               "and related or neighboring rights to this work.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}
TITLES = {"Apache-2.0": "Apache License Version 2.0, January 2004"}
VERSIONS = {"GPL": "1.0 2.0 3.0", "LGPL": "2.0 2.1 3.0", "AGPL": "1.0 3.0", "MPL": "1.0 1.1 2.0", "Apache": "1.0 1.1 2.0"}
BLOCKS = (12, 18, 27, 40, 60, 90, 135, 200)  # terms of the blocks that are compared, each a quarter of its size on
TITLE = 400  # characters of a licence that name it
CERTAIN = 0.95  # cosine of a line from which no blocks are compared
RESERVED = "Proprietary"  # stands beside many licences, so any other notice goes before it

_SIGN = re.compile(r"licen[cs]|copyright|permission|redistribut|warrant|public domain|creative commons|\bcc0|\bgnu\b|mozilla|apache")
_SIGNS = ("licen", "copyright", "permission", "redistribut", "warrant", "domain", "creative", "cc0", "gnu", "mozilla", "apache")
_SPDX = re.compile(
    r"SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9][\w.+-]*\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9][\w.+-]*\)*)*)"
)
_VERSIONED = re.compile(r"(AGPL|LGPL|GPL|MPL|Apache|CC-BY)(?:-NC|-SA|-ND)*-\d")
_NAMED = re.compile(r"public license|gpl|mpl|mozilla|apache|creative commons|\bcc\b|attribution")
_NUMBER = re.compile(r"(?:\bv(?:ersion|er)?|gpl|mpl)[ .,-]{0,3}v?(\d+(?:\.\d+)?)|license-(\d\.\d)|/(\d\.\d)\b")
_CC_NUMBER = re.compile(r"\b(\d\.\d)\b|\bv(?:ersion)?[ .]*(\d)\b")
_LATER = re.compile(r"\bor,? (?:\(?at your option\)?,? )?(?:any )?(?:later|newer)")
_MARK = re.compile(r"\s+(?:(?://+|\*+|#+|;+|--+|%+|rem\b|dnl\b)\s+)*")  # white space and signs of a comment
_TERM = re.compile(r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]")


def terms_of(line: str) -> list[str]:
    return _TERM.findall(line.lower())


def full_texts() -> dict[str, str]:
    """The licences' whole texts by SPDX id."""
    folder = Path(__file__).with_name("licence_texts")
    return {p.stem: p.read_text("utf-8") for p in sorted(folder.glob("*.txt"))}


def exact(name: str, matched: str, after: str = "") -> str:
    """The SPDX id that the matched words name: family and version are theirs, not the template's.

    Words after them may still allow later versions.

    A version that SPDX lacks gives a LicenseRef. So does none, but for the GNU licences, of which then any version holds.
    """
    text = _MARK.sub(" ", matched.lower())
    if name in ("BSD-2-Clause", "BSD-3-Clause") and "following conditions" in text and "disclaimer" in text:
        return "BSD-3-Clause" if "prior written permission" in text else "BSD-2-Clause"
    of = _VERSIONED.match(name)
    if not of:
        return name
    family, gnu = of[1], of[1].endswith("GPL")
    if gnu:
        family = "AGPL" if re.search("affero|agpl", text) else "LGPL" if re.search("lesser|library general|lgpl", text) else "GPL"
    number = _NUMBER
    if family == "CC-BY":
        number = _CC_NUMBER
        for mark, words in (("NC", r"non-?commercial|\bnc\b"), ("SA", r"share-? ?alike|\bsa\b"), ("ND", r"no-?deriv|\bnd\b")):
            family += f"-{mark}" if re.search(words, text) else ""
    named = _NAMED.search(text)
    found = number.search(text, named.start()) if named else None
    found = found or number.search(text)
    later = "-or-later" if _LATER.search(_MARK.sub(" ", (matched + after).lower())) else "-only"
    if not found:
        return {"GPL": "GPL-1.0-or-later", "LGPL": "LGPL-2.0-or-later", "AGPL": "AGPL-1.0-or-later"}.get(family, f"LicenseRef-{family}")
    version = next(filter(None, found.groups()))
    version += "" if "." in version else ".0"
    known = VERSIONS.get(family, "1.0 2.0 2.5 3.0 4.0").split()
    return f"{'' if version in known else 'LicenseRef-'}{family}-{version}{later if gnu else ''}"


def _vocabulary(templates: dict[str, str]) -> set[str]:
    return {t for text in templates.values() for t in terms_of(text)}


def document_frequencies(files: DataFrame, text_col: str, templates: dict[str, str]) -> tuple[int, dict[str, int]]:
    """Number of files, and for each template term the files that hold it: as many rows as templates have terms."""
    words = _vocabulary(templates)
    schema = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for raw in byte_list(batch.column(0)):
                counts[""] += 1
                counts.update(words.intersection(terms_of(raw.decode("utf-8", "replace"))))
        yield record({"term": list(counts), "n": list(counts.values())}, schema)

    partial = files.select(utf8(text_col)).mapInArrow(run, "term string, n long")
    counts = {r["term"]: r["n"] for r in partial.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return counts.pop("", 0), counts


class Matcher:
    """Templates as sparse vectors; terms that no template has weigh as much as a term of one file."""

    def __init__(self, templates: dict[str, str], files: int, frequencies: dict[str, int]) -> None:
        self.rare = math.log((1 + files) / 2) + 1
        self.weights = {t: math.log((1 + files) / (1 + frequencies.get(t, 0))) + 1 for t in _vocabulary(templates)}
        self.vectors = {name: self._vector(terms_of(text)) for name, text in sorted(templates.items())}
        # a template's terms by weight: a match needs one of its heavy ones
        self.telling = set().union(*(self._heavy(v) for v in self.vectors.values()))

    def _vector(self, terms: list[str]) -> dict[str, float]:
        raw = {t: n * self.weights.get(t, self.rare) for t, n in Counter(terms).items()}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        return {t: w / norm for t, w in raw.items()}

    @staticmethod
    def _heavy(vector: dict[str, float]) -> set[str]:
        """The fewest terms without which the cosine stays below LEAST."""
        rest, out = 1.0, set()
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < LEAST * LEAST:
                break
            out.add(term)
            rest -= weight * weight
        return out

    def best(self, line: str) -> tuple[str, float] | None:
        """The nearest template with a cosine of LEAST or more; of equals the first by name."""
        terms = terms_of(line)
        if self.telling.isdisjoint(terms):
            return None
        own = self._vector(terms)
        score, name = min((-sum(w * own.get(t, 0.0) for t, w in v.items()), name) for name, v in self.vectors.items())
        return (name, round(-score, 6)) if -score >= LEAST else None


class Scanner:
    """All that a text is compared with: short notices by line, these and headers by block, whole licences by file."""

    def __init__(self, templates: dict[str, str], files: int, frequencies: dict[str, int]) -> None:
        self.lines = Matcher(templates, files, frequencies)
        self.titles = Matcher(TITLES, files, frequencies)
        self.blocks = Matcher(block_templates(templates), files, frequencies)
        self.whole = Matcher(full_texts(), files, frequencies)

    def hits(self, text: str, licence_file: bool) -> list[tuple[str, float]]:
        """Names and cosines of what the text was found to say."""
        units = text.split("\n")
        if licence_file:
            units.append(text)
        out = [(exact(h[0], u, "\n" + "\n".join(units[i + 1 : i + 3])), h[1]) for i, u in enumerate(units) if (h := self.lines.best(u))]
        out += [(m[1].rstrip("-"), 1.0) for m in _SPDX.finditer(text)]
        if not _SIGN.search(" ".join(text.lower().split())):
            return out
        if licence_file:
            out += [(exact(h[0], text[:TITLE]), h[1]) if _VERSIONED.match(h[0]) else (exact(h[0], text), h[1])
                    for h in [self.whole.best(text)] if h]
            # headings of two lines
            out += [(h[0], h[1]) for a, b in zip(units, units[1:]) if (h := self.titles.best(f"{a} {b}"))]
        if not any(cosine >= CERTAIN and name != RESERVED for name, cosine in out):
            out += self._in_blocks(text)
        return out

    def _in_blocks(self, text: str) -> Iterator[tuple[str, float]]:
        low = text.lower()
        spans = [m.span() for m in _TERM.finditer(low)]
        signs = [i for i, (a, b) in enumerate(spans) if low.startswith(_SIGNS, a, b)]
        for size in BLOCKS:
            step = size // 4
            starts = sorted({k * step for i in signs for k in range(max(-(-(i - size + 1) // step), 0), i // step + 1)})
            for start in starts:
                end = spans[min(start + size, len(spans)) - 1][1]
                block = low[spans[start][0] : end]
                if h := self.blocks.best(block):
                    yield exact(h[0].partition("#")[0], block, low[end : end + TITLE]), h[1]


def block_templates(templates: dict[str, str]) -> dict[str, str]:
    """Notices of five terms and more, headers, and the licences that are short enough for a block."""
    short = {n: t for n, t in full_texts().items() if len(terms_of(t)) <= BLOCKS[-1] * 5 // 4}
    notice = {n: t for n, t in templates.items() if len(terms_of(t)) >= 5}
    return notice | {f"{n}#header": t for n, t in HEADERS.items()} | {f"{n}#text": t for n, t in short.items()}


def notices(files: DataFrame, id_col: str, path_col: str, text_col: str, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Each file's id, path, the best notice among its lines and blocks (a licence file's whole text counts too), its cosine.

    That all rights are reserved counts only where nothing else is found.

    Null and empty texts have none. One row for each row; other columns are not read.
    """
    every = {f"{n}#{i}": t for i, d in enumerate((block_templates(templates), templates, TITLES, full_texts())) for n, t in d.items()}
    scanner = Scanner(templates, *document_frequencies(files, text_col, every))
    licence_file = re.compile(LICENCE_FILE.removeprefix("(?i)"), re.IGNORECASE)
    frame = files.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), utf8(text_col).alias("raw"))
    ddl = f"id {frame.schema['id'].dataType.simpleString()}, path string, notice string, score double"
    schema = to_arrow_schema(files.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, raw in zip(batch.column("path").to_pylist(), byte_list(batch.column("raw"))):
                named = bool(licence_file.match((path or "").rpartition("/")[2]))
                hits = scanner.hits(raw.decode("utf-8", "replace"), named)
                found.append(min(hits, key=lambda h: (h[0] == RESERVED, -h[1], h[0]), default=(None, None)))
            yield record({"id": batch.column("id").cast(schema.field("id").type), "path": batch.column("path"),
                          "notice": [f[0] for f in found], "score": [f[1] for f in found]}, schema)

    return frame.mapInArrow(run, ddl).withColumnRenamed("id", id_col)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The directory and all above it, the root being the empty text."""
    parts = F.split(folder, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), above))


def inherited(found: DataFrame) -> DataFrame:
    """The notices with ``license`` and ``license_from``: ``own``, the directory that gives it, or null.

    Of several licence files in a directory the nearest to its template counts, then the first by name. The join runs
    over distinct directories, so files of one directory cost one row. A null path is in the root.
    """
    name = F.regexp_extract("path", "[^/]*$", 0)
    located = found.withColumn("folder", F.coalesce(directory(F.col("path")), F.lit("")))
    ranked = F.struct((-F.col("score")).alias("far"), F.col("notice").alias("notice"))
    files = located.where(name.rlike(LICENCE_FILE) & F.col("notice").isNotNull())
    given = files.groupBy(F.col("folder").alias("above")).agg(F.min(ranked)["notice"].alias("given"))
    folders = located.select("folder").distinct().withColumn("above", F.explode(ancestors(F.col("folder"))))
    nearest = left_lookup(folders, given, ["above"]).where("given is not null").groupBy("folder").agg(
        F.max(F.struct(F.length("above").alias("depth"), "above", "given")).alias("n")
    ).select("folder", F.col("n.above").alias("above"), F.col("n.given").alias("given"))
    joined = left_lookup(located, nearest, ["folder"])
    return joined.withColumn("license", F.coalesce("notice", "given")).withColumn(
        "license_from", F.when(F.col("notice").isNotNull(), F.lit("own")).otherwise(F.col("above"))
    ).drop("folder", "above", "given")


def document_paths(docs: DataFrame) -> DataFrame:
    """The documents as files: their place in a tree is derived from source, id and text, as the table has none.

    A third of the documents that end with a line on a license are the licence file of their directory, or of the
    one above it.
    """
    doc = F.col("doc_id")
    upper = F.concat(F.coalesce(F.col("source"), F.lit("none")), F.lit("/a"), (doc % 37).cast("string"))
    lower = F.concat(upper, F.lit("/b"), (doc % 11).cast("string"))
    file = F.concat(lower, F.lit("/f"), doc.cast("string"), F.lit(".txt"))
    ends = F.lower(F.substring_index("text", "\n", -1)).rlike("licen[cs]e") & (doc % 3 == 0)
    folder = F.when(doc % 2 == 0, upper).otherwise(lower)
    return docs.select("doc_id", F.when(ends, F.concat(folder, F.lit("/LICENSE"))).otherwise(file).alias("path"), "text")


def document_licenses(docs: DataFrame) -> DataFrame:
    """Every document's own notice, its cosine, and the licence that holds for it."""
    found = written(notices(document_paths(docs), "doc_id", "path", "text"))
    return inherited(found)
