"""Quality rules as native expressions, tried in the order of rejections per cost."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import texts

#: Rows that costs and selectivities are estimated on. They set the order, never the verdict.
SAMPLE_ROWS = 2000

# White space between words, and the characters that count as symbols.
BETWEEN = r"[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
BLANKS = r"' \t\n\u000b\u000c\r'"


@dataclass(frozen=True)
class Rule:
    """A document is rejected where `rejects` (SQL over the text and its measures) holds."""

    name: str
    rejects: str


# The bounds follow what published web filters use; integers only, so any engine agrees.
RULES = (
    Rule("symbols", "n_symbols * 10 > n_words * 3"),
    Rule("duplicate_lines", "n_lines >= 4 AND n_dup_lines * 10 > n_lines * 3"),
    Rule("word_length", "word_chars < n_words * 2 OR word_chars > n_words * 15"),
    Rule("shouting", "length(regexp_replace(text, '[^A-Z]', '')) * 2 > word_chars"),
    Rule("exclamations", "(length(text) - length(replace(text, '!!', ''))) * 5 > n_words * 2"),
    Rule("ellipses", "(length(text) - length(replace(text, '...', ''))) > n_words"),
)


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    Everything is computed inside the row, so nothing is shuffled, however often a line or a
    word occurs. Windows are compared by 64-bit hash; the words in repeated windows are found
    by sorting (hash, position), and counted from the gaps between the positions."""
    cut = texts(docs).select(
        "doc_id",
        "text",
        F.expr(f"filter(split(text, '{BETWEEN}'), x -> x != '')").alias("words"),
        F.expr(rf"filter(split(text, '\n'), x -> translate(x, {BLANKS}, '') != '')").alias("lines"),
        F.expr(f"length(translate(text, {BLANKS}, ''))").cast("bigint").alias("word_chars"),
        F.expr(f"length(text) - length(translate(text, '{SYMBOLS}', ''))").cast("bigint").alias("n_symbols"),
    )
    hashed = cut.select(
        "doc_id",
        "text",
        "word_chars",
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        F.expr(
            """CASE WHEN size(words) < 4 THEN cast(array() as array<bigint>) ELSE
            transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) END"""
        ).alias("windows"),
    )
    # texts without a repeated window, the most, stop here
    sorted_windows = hashed.withColumn(
        "spots",
        F.expr(
            """CASE WHEN size(array_distinct(windows)) = size(windows) THEN NULL ELSE
            array_sort(transform(windows, (h, i) -> struct(h, i))) END"""
        ),
    ).drop("windows")
    placed = sorted_windows.withColumn(
        "places",
        F.expr(
            """array_sort(transform(filter(transform(spots, (s, k) -> struct(
                s.i AS i, (k > 0 AND s.h = get(spots, k - 1).h) OR coalesce(s.h = get(spots, k + 1).h, false) AS twice)),
                s -> s.twice), s -> s.i))"""
        ),
    ).drop("spots")
    repeated = F.expr(
        """coalesce(aggregate(transform(places, (p, k) -> least(3, coalesce(get(places, k + 1) - p, 3))),
        0L, (n, x) -> n + x), 0L)"""
    )
    return placed.withColumn("n_repeat_words", repeated).drop("places")


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def order_rules(sample: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules by rejections per second on a measured sample, best first.

    Each rule's cost is the time it adds to a pass over the sample, with a floor against noise.
    If rules reject independently, this order has the least expected cost."""
    held = sample.cache()
    try:
        if not held.count():
            return rules

        def timed(*columns: Column) -> tuple[float, int]:
            begin = time.perf_counter()
            out = held.agg(F.count("*"), *columns).first()
            return time.perf_counter() - begin, out[-1]

        empty = min(timed()[0] for _ in range(3))
        rank = {}
        for rule in rules:
            spent, rejected = timed(F.count_if(F.expr(rule.rejects)))
            rank[rule.name] = rejected / max(spent - empty, 1e-3)
    finally:
        held.unpersist()
    return tuple(sorted(rules, key=lambda r: (-rank[r.name], r.name)))


def cascade(rules: tuple[Rule, ...]) -> Column:
    """Name of the first rule that rejects, NULL if none; later ones are not evaluated."""
    out = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        out = out.when(F.expr(rule.rejects), F.lit(rule.name))
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`measures` and rejected_by, the rule that rejected the document (NULL: it is kept).

    The order of the rules is estimated on a random sample of about `sample_rows` rows. The
    verdict is the same in any order; which rule is named depends on it. NULL and empty texts
    have no words and fail the base; each row gives a row."""
    total = docs.count()
    sample = docs.sample(sample_rows / total, seed=5) if total > sample_rows else docs
    return measures(docs).withColumn("rejected_by", cascade(order_rules(measures(sample), rules)))
