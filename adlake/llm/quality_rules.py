"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Counts of a text (words, symbols, lines, stop words, repeats) are columns; every rule is a ratio of two counts with a
lower and an upper bound. The table is compiled to SQL text that Spark and DuckDB read alike. Nothing shuffles.

Defined cases: NULL and empty texts have zero counts and fail the base rule; other columns are kept and may have any
name but those of the counts, which are replaced; repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import SPACE_CLASS, SPACES, WORD_CLASS, let

SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Very common words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was with as be on are "
    "der die und das von zu den mit sich auf ein nicht ist des im "
    "le la les de des et un une que dans pour est qui au par "
    "el los las del y en una por con para no se al su lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high``; a rule without a whole (0) passes."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None


BASE_RULES = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"

# Thresholds, checked against labelled documents: clean ones stay far inside each of them.
RULES = (
    Rule("mean word length", "word_chars", "n_words", 2, 14),
    Rule("symbols per word", "n_symbols", "n_words", None, 0.25),
    Rule("exclamation marks per word", "n_bangs", "n_words", None, 0.5),
    Rule("stop words", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("lines cut by an ellipsis", "n_cut_lines", "n_lines", None, 0.5),
)


def rule_sql(rules: Sequence[Rule] = RULES) -> str:
    """The rules as one condition, in SQL that Spark and DuckDB both read. Ratios become products."""
    terms = []
    for r in rules:
        if r.low is not None:
            terms.append(f"{r.part} >= {r.low} * {r.whole}")
        if r.high is not None:
            terms.append(f"{r.part} <= {r.high} * {r.whole}")
    return " AND ".join(terms) or "TRUE"


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the array.

    Windows are compared by 64-bit hash. A text without a repeated window stops at the distinct count; otherwise the
    (hash, place) pairs are sorted, and the lengths of the covered runs are added up: n log n steps in all.
    """

    def covered(pairs: Column) -> Column:
        here = F.filter(
            pairs,
            lambda p, i: (F.get(pairs, i - 1)["h"].eqNullSafe(p["h"]) & (i > 0))
            | F.get(pairs, i + 1)["h"].eqNullSafe(p["h"]),
        )
        places = F.sort_array(F.transform(here, lambda p: p["i"]))
        begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            places,
            begin,
            lambda acc, p: F.struct(
                (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end")
            ),
            lambda acc: acc["n"],
        )

    def of_hashes(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(pairs, covered)
        )

    def of_words(ws: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(ws) - WINDOW + 1)
        return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(
            let(F.transform(at, lambda i: F.xxhash64(F.slice(ws, i, WINDOW))), of_hashes)
        )

    return let(words, of_words)


def count_columns(text: Column) -> dict[str, Column]:
    """The counts as expressions over ``text``, which must not be NULL."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{SPACE_CLASS}+")
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def without(chars: str) -> Column:
        return F.length(F.regexp_replace(text, f"[{chars}]+", ""))

    def of_words(ws: Column) -> Column:
        is_stop = [F.lit(w) for w in dict.fromkeys(STOP_WORDS)]
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.size(F.filter(ws, lambda w: F.lower(F.btrim(w, F.lit(".,;:!?"))).isin(*is_stop)))
            .cast("long")
            .alias("n_stop_words"),
            repeated_words(ws).alias("n_repeat_words"),
        )

    def of_lines(ls: Column) -> Column:
        return F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(ls, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
            .cast("long")
            .alias("n_cut_lines"),
        )

    return {
        "_words": let(words, of_words),
        "_lines": let(lines, of_lines),
        "word_chars": without(r"\x20\x09-\x0D"),
        "n_symbols": F.length(text) - without(SYMBOLS),
        "n_bangs": F.length(text) - without("!"),
    }


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_cut_lines",
    "n_bangs",
)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``."""
    counts = count_columns(F.coalesce(F.col(text), F.lit("")))
    own = [c for c in docs.columns if c not in (*COUNTS, "base_failed", "kept", *counts)]
    measured = docs.select(*own, *[c.alias(name) for name, c in counts.items()])
    flat = measured.select(
        *own,
        F.col("_words.n_words"),
        *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols")],
        F.col("_lines.n_dup_lines"),
        F.col("_words.n_repeat_words"),
        F.col("_words.n_stop_words"),
        F.col("_lines.n_lines"),
        F.col("_lines.n_cut_lines"),
        F.col("n_bangs").cast("long").alias("n_bangs"),
    )
    failed = F.expr(BASE_RULES)
    return flat.select("*", failed.alias("base_failed"), (~failed & F.expr(rule_sql(rules))).alias("kept"))


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    counts = count_columns(F.coalesce(F.col(text), F.lit("")))
    struct = F.struct(*[c.alias(n) for n, c in counts.items()])
    names = {n: f"_q._words.{n}" for n in ("n_words", "n_stop_words", "n_repeat_words")}
    names |= {n: f"_q._lines.{n}" for n in ("n_lines", "n_dup_lines", "n_cut_lines")}
    names |= {n: f"_q.{n}" for n in ("word_chars", "n_symbols", "n_bangs")}
    passes = re.sub(r"\b[a-z_]+\b", lambda m: names.get(m[0], m[0]), f"NOT ({BASE_RULES}) AND {rule_sql(rules)}")
    return docs.withColumn("_q", struct).where(F.expr(passes)).select(*docs.columns)


def oracle(rules: Sequence[Rule] = RULES) -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD_CLASS}+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: trim(x, {space}) <> '') AS ls FROM d),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW}),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s FROM places),
rep AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
r AS (SELECT doc_id, CAST(sum(least({WINDOW}, coalesce(i - before, {WINDOW}))) AS BIGINT) AS n FROM rep GROUP BY doc_id),
c AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{SPACE_CLASS}+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[{SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    CAST(len(list_filter(ws, lambda x: lower(trim(x, '.,;:!?')) IN ({stop}))) AS BIGINT) AS n_stop_words,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(list_filter(ls, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS BIGINT) AS n_cut_lines,
    CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bangs
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id)
SELECT *, ({BASE_RULES}) AS base_failed, (NOT ({BASE_RULES}) AND {rule_sql(rules)}) AS kept FROM c
"""
