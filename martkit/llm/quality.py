"""Quality rules as a short-circuit cascade (operator 7): native Spark expressions only.

Each rule is a condition that rejects a text. A sample gives every rule's cost
(seconds to evaluate it) and its rejections; rules then run in the order of
rejections per cost, and a text that one rule rejects is not looked at by the
next. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.tables import SPACES
from martkit.workspace import written

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
SAMPLE_FILES, SAMPLE_ROWS = 4, 2_000

# Scripts that write no spaces between words.
_UNSPACED_SCRIPTS = (
    "Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan", "Javanese", "Balinese",
    "Tai_Le", "New_Tai_Lue", "Tai_Tham",
)
UNSPACED = "[" + "".join(f"\\p{{Is{name}}}" for name in _UNSPACED_SCRIPTS) + "]+"

_WORD_SEPARATOR = "[\\x20\\x09-\\x0D]+"


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _WORD_SEPARATOR), "")


def n_words(text: Column) -> Column:
    """Words without making them: places where a word starts."""
    return F.size(words(text))


def word_chars(text: Column) -> Column:
    return F.length(_without(text, SPACES))


def n_symbols(text: Column) -> Column:
    return F.length(text) - F.length(_without(text, SYMBOLS))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, SPACES)) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def n_repeat_words(text: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words inside windows of so many words that occur twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. Only a text with an equal pair of hashes is looked at further.
    """
    def windows(w: Column) -> Column:
        whole = F.size(w) - window + 1
        return F.when(whole > 1, F.slice(_runs(F.transform(w, lambda x: F.xxhash64(x)), window), 1, whole)).otherwise(
            F.array().cast("array<bigint>")
        )

    return _covered(_let(words(text), windows), window)


def _runs(hashes: Column, n: int) -> Column:
    """Hashes of the runs of n elements, made of those of shorter runs; the last n - 1 lack elements."""
    if n == 1:
        return hashes
    half = n // 2

    def joined(h: Column) -> Column:
        later = F.slice(h, half + 1, F.greatest(F.size(h), F.lit(1)))
        return F.zip_with(h, later, lambda a, b: F.xxhash64(a, b))

    doubled = _let(_runs(hashes, half), joined)
    if n % 2 == 0:
        return doubled
    last = F.slice(hashes, n, F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(doubled, last, lambda a, b: F.xxhash64(a, b))


def _covered(hashes: Column, window: int) -> Column:
    def marked(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return _let(placed, lambda s: _let(_twins(s), lambda p: _span(p, window)))

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), marked(h)).otherwise(F.lit(0)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _twins(s: Column) -> Column:
    """Ordered places whose hash equals that of a neighbour in the array sorted by hash."""
    same = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    before = F.concat(F.array(F.lit(False)), same)
    flagged = F.arrays_zip(s.alias("s"), same.alias("a"), F.slice(before, 1, F.size(s)).alias("b"))
    return F.sort_array(F.transform(F.filter(flagged, lambda x: x["a"] | x["b"]), lambda x: x["s"]["at"]))


def _span(places: Column, window: int) -> Column:
    """Words covered by windows that start at ordered places."""
    steps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(b - a, F.lit(window)))
    return F.aggregate(steps, F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(window)))


@dataclass(frozen=True)
class Rule:
    """A named condition, true where a text is to be rejected."""

    name: str
    rejects: Column


def sample_of(df: DataFrame, columns: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """About so many rows from at most SAMPLE_FILES of the frame's files, or from the frame where it has none."""
    files = sorted(df.inputFiles())
    if len(files) > SAMPLE_FILES:
        files = files[:: -(-len(files) // SAMPLE_FILES)]
        part = df.sparkSession.read.parquet(*files)
        if set(columns) <= set(part.columns):
            df = part
    df = df.select(*columns)
    n = df.count()
    return df.sample(min(1.0, rows / n), seed=7) if n else df


def order_rules(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per second on a sample, the best first; ties and an empty sample keep the order."""
    names = [f"r{i}" for i in range(len(rules))]
    counts = sample.agg(F.count("*"), *[F.count(F.when(r.rejects, 1)).alias(n) for r, n in zip(rules, names)]).first()
    total = counts[0]
    if not total:
        return list(rules)
    worth = []
    for rule, rejected in zip(rules, counts[1:]):
        start = time.perf_counter()
        sample.agg(F.count(F.when(rule.rejects, 1))).first()
        worth.append(rejected / total / (time.perf_counter() - start))
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-worth[i], i))]


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; a null condition does not reject."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return verdict


def text_measures(text: Column) -> dict[str, Column]:
    """What the rules look at, as expressions on the text."""
    return {
        "n_words": n_words(text), "word_chars": word_chars(text), "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(text), "n_repeat_words": n_repeat_words(text),
    }


def _too_long(text: Column, chars: Column, most: Column) -> Column:
    """Whether there are more characters than that; each letter of a script without spaces excuses itself and one other."""
    unspaced = F.length(text) - F.length(F.regexp_replace(text, UNSPACED, ""))
    return (chars > most) & (chars - 2 * unspaced > most)


BASE_RULES = ("short", "repeats")


def document_rules(text: Column, measures: dict[str, Column] | None = None) -> list[Rule]:
    """Rules for running text; ``measures`` are columns that hold what is counted already.

    ``short`` and ``repeats`` are the base. The others reject texts of symbols, of repeated lines, of words too
    short or long to be words, and with few letters. All leave ordinary prose alone: vowel signs count as letters, and
    words of scripts without spaces may be long.
    """
    m = measures or text_measures(text)
    return [
        Rule("short", m["n_words"] < 20),
        Rule("symbols", m["n_symbols"] * 10 > m["n_words"] * 3),
        Rule("word_length", _too_long(text, m["word_chars"], 15 * m["n_words"]) | (m["word_chars"] < 2 * m["n_words"])),
        Rule("lines", (m["n_dup_lines"] >= 5) & (m["n_dup_lines"] * 10 > F.size(F.split(text, "\n")) * 3)),
        Rule("letters", F.length(F.regexp_replace(text, "[^\\p{L}\\p{M}]+", "")) * 2 < m["word_chars"]),
        Rule("repeats", m["n_repeat_words"] * 100 > m["n_words"] * 30),
    ]


def reject_reasons(df: DataFrame, text_col: str = "text", out: str = "rejected_by") -> DataFrame:
    """The rows with the name of the rule that rejected them, null where kept.

    Null and empty texts have no words and are rejected as short. Repeated rows
    are judged alike. A column of the output's name is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rules = order_rules(written(sample_of(df, [text_col])), document_rules(text))
    return df.withColumn(out, cascade(rules))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with their columns as they were."""
    packed = docs.select(F.struct("*").alias("whole"), F.col(text_col).alias("judged"))
    text = F.coalesce(F.col("judged"), F.lit(""))
    sample = written(sample_of(docs, [text_col]).select(F.col(text_col).alias("judged")))
    return packed.where(cascade(order_rules(sample, document_rules(text))).isNull()).select("whole.*")


def document_quality(docs: DataFrame) -> DataFrame:
    """Digest of every document: its counts, whether the base rules fail it, and the cascade's verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sample = written(sample_of(docs, ["text"]))
    order = [r.name for r in order_rules(sample, [r for r in document_rules(text) if r.name not in BASE_RULES])]
    measures = text_measures(text)
    counted = docs.select("doc_id", "text", *[c.cast("long").alias(n) for n, c in measures.items()])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rules = {r.name: r for r in document_rules(text, {n: F.col(n) for n in measures})}
    reason = F.when(failed, F.lit("base")).otherwise(cascade([rules[n] for n in order]))
    return counted.select("doc_id", *measures, failed.alias("base_failed"), reason.isNull().alias("kept"))


# The words' separators and the symbols as above; the SQL checks every column but needs no order of the rules.
_UNSPACED_SQL = "[" + "".join(f"\\p{{{name}}}" for name in _UNSPACED_SCRIPTS) + "]+"
DOCUMENT_QUALITY_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    [x for x in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x != ''] AS w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS h FROM place),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
step AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM twice),
rep AS (SELECT doc_id, sum(n)::BIGINT AS n_repeat_words FROM step GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^\\p{{L}}\\p{{M}}]+', '', 'g')) AS letters,
    length(t) - length(regexp_replace(t, '{_UNSPACED_SQL}', '', 'g')) AS unspaced, len(string_split(t, chr(10))) AS n_lines
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 10 > n_words * 3 OR (word_chars > 15 * n_words AND word_chars - 2 * unspaced > 15 * n_words)
    OR word_chars < 2 * n_words
    OR (n_dup_lines >= 5 AND n_dup_lines * 10 > n_lines * 3) OR letters * 2 < word_chars) AS kept
FROM f
"""
