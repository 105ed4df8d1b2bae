"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words (space, 09 to 0D), and the symbols that are counted.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = ("#", "*", "$", "%", "&", "|", "<", ">")
# Words in a window that may repeat.
REPEAT_WINDOW = 8

# Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "a", "is", "was", "for", "on",
    "der", "die", "das", "und", "ist", "von", "zu", "nicht", "ein", "eine", "den", "mit", "sich",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "qui", "est", "du", "en", "dans",
    "el", "los", "las", "y", "del", "se", "por", "para", "con", "es", "lo", "como", "su",
)


class Rule(NamedTuple):
    """A text is kept if low * denominator <= 100 * numerator <= high * denominator."""

    name: str
    numerator: str
    denominator: str
    low: int | None
    high: int | None


# Ratios in percent. Bounds are wide: they are to catch menus, markup and repeated lines.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "word_chars", None, 10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("stop_words", "n_stop_words", "n_words", 1, None),
)

# Verdicts that hold whatever the table says.
LEAST_WORDS = 20
MOST_REPEAT_PERCENT = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often and deep in lambdas it is used."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: Sequence[str]) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of words which the text has twice or more."""
    size = REPEAT_WINDOW

    def of_windows(windows: Column) -> Column:
        distinct = F.size(F.array_distinct(windows))
        return F.when(distinct == F.size(windows), F.lit(0)).otherwise(repeated(windows))

    def repeated(windows: Column) -> Column:
        # In order of content, a window that repeats has an equal neighbour.
        numbered = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        return let(F.sort_array(numbered), of_sorted)

    def of_sorted(ordered: Column) -> Column:
        def has_equal(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(ordered, i - 1)["w"] == x["w"])
            after = F.get(ordered, i + 1)["w"] == x["w"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        places = F.transform(F.filter(ordered, has_equal), lambda x: x["i"])
        return let(F.sort_array(places), covered)

    def covered(places: Column) -> Column:
        """Each window adds the words up to the next one's begin, or all of its own."""
        steps = F.transform(
            places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - p, F.lit(size)))
        )
        return F.aggregate(steps, F.lit(0), lambda n, s: n + s)

    def of_hashes(hashes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hashes) - size)
        windows = F.transform(at, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(size))))
        return let(windows, of_windows)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < size, F.lit(0)).otherwise(let(hashes, of_hashes))


def _measures(text: Column) -> Column:
    """All counts of a text, as a struct of longs."""
    trimmed = F.btrim(text, F.lit("".join(BLANKS)))
    split = F.split(trimmed, "[\\x20\\x09-\\x0D]+")

    def of_words(words: Column) -> Column:
        # Without a word, splitting gives one empty string.
        some = F.length(trimmed) > 0
        lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit("".join(BLANKS)))) > 0)
        stops = F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))
        counts = {
            "n_words": F.when(some, F.size(words)).otherwise(0),
            "word_chars": F.length(_without(text, BLANKS)),
            "n_symbols": F.length(text) - F.length(_without(text, SYMBOLS)),
            "n_lines": F.size(lines),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
            "n_repeat_words": _repeat_words(words),
            "n_stop_words": F.size(stops),
        }
        return F.struct(*(c.cast("long").alias(n) for n, c in counts.items()))

    return let(split, of_words)


def _passes(rule: Rule, measures: Column) -> Column:
    ratio, base = 100 * measures[rule.numerator], measures[rule.denominator]
    passed = F.lit(True)
    if rule.low is not None:
        passed = passed & (rule.low * base <= ratio)
    if rule.high is not None:
        passed = passed & (ratio <= rule.high * base)
    return passed


def apply_rules(
    docs: DataFrame, text_column: str = "text", rules: Sequence[Rule] = RULES, into: str = "quality"
) -> DataFrame:
    """Add a struct column of counts and verdicts to every row; a column of its name gives way.

    Fields: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words (long),
    base_failed, failed (names of the rules of the table that it breaks) and kept. No row
    depends on another, so ties and repeated rows need no care. Null, empty and blank texts have
    counts of 0 and fail for their few words. All of a text is looked at, however long.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))

    def verdict(m: Column) -> Column:
        base = (m["n_words"] < LEAST_WORDS) | (
            100 * m["n_repeat_words"] > MOST_REPEAT_PERCENT * m["n_words"]
        )
        broken = F.array_compact(
            F.array(*(F.when(~_passes(r, m), F.lit(r.name)) for r in rules)).cast("array<string>")
        )
        names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")
        return let(
            broken,
            lambda b: F.struct(
                *(m[n].alias(n) for n in names),
                base.alias("base_failed"),
                b.alias("failed"),
                (~base & (F.size(b) == 0)).alias("kept"),
            ),
        )

    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*kept, let(_measures(text), verdict).alias(into))


def oracle(table: str = "documents", id_column: str = "doc_id", text_column: str = "text") -> str:
    """The same counts and verdicts of `RULES` as DuckDB SQL, by windows as strings."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    size = REPEAT_WINDOW
    checks = []
    for r in RULES:
        if r.low is not None:
            checks.append(f"{r.low} * {r.denominator} <= 100 * {r.numerator}")
        if r.high is not None:
            checks.append(f"100 * {r.numerator} <= {r.high} * {r.denominator}")
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, {id_column}, coalesce({text_column}, '') AS t FROM {table}
), split AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT r, i, array_to_string(words[i:i + {size - 1}], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - {size - 2})) AS i FROM split)
), doubled AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM doubled, range({size}) AS o(j) GROUP BY r
), counts AS (
  SELECT {id_column}, len(words) AS n_words, length(regexp_replace(t, '{blank}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stop_words
  FROM split LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts
)
SELECT {id_column}, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(checks)} AS kept
FROM judged"""
