"""License notices: an exact set-similarity join of text blocks with templates, as expressions.

A block is a window of `WINDOW` words, one every `STRIDE` words, so every stretch of up to
STRIDE + 1 words lies whole in one. A block matches a template if it holds at least `percent`
percent of the template's distinct words. All pairs that do are found, and few others are
looked at:

- Words outside all templates can't count, so a block is the set of its template words,
  ordered by how many documents hold them, rarest first (ties by the word).
- Prefix: of a template of n words of which a must be there, one of the n - a + 1 rarest
  is in the block; likewise for the block. Only these are joined, by word.
- Length: a block of fewer than a template words can't match.
- Position: at the first common word, what follows on both sides must still reach a.

Templates are a parameter and few; the table of their prefixes is what is broadcast. Rows are
exploded and joined where they were read; only digests of rows are shuffled. No Python code
runs on the executors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import texts

#: Words of a block and between the starts of two blocks; percent of a template's words.
WINDOW, STRIDE, PERCENT = 64, 32, 95

# What parts words once A-Z is lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose words stand consecutively, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: (label, notice). Notices of up to STRIDE + 1 words are found wherever they begin.
TEMPLATES = (
    ("agpl", "licensed under the GNU Affero General Public License version 3"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"),
    ("lgpl", "licensed under the GNU Lesser General Public License version 2.1"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "")


def template_words(text: str) -> list[str]:
    """The distinct words of a template, cut as those of texts are."""
    kept = "".join(c if c >= "\x80" or c.isalnum() else " " for c in text.translate(str.maketrans(UPPER, LOWER)))
    return list(dict.fromkeys(kept.split()))


@dataclass(frozen=True)
class Template:
    """`ranks`: the template's words by the global order; `least`: how many a block must hold."""

    label: str
    ranks: tuple[int, ...]
    least: int

    def prefix(self) -> tuple[int, ...]:
        return self.ranks[: len(self.ranks) - self.least + 1]


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def global_order(rows: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """The template words, those that fewest of all rows hold first.

    Counts combine before the shuffle, and there are no more of them than template words."""
    held = rows.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
    counts = dict(held.groupBy("word").count().collect())
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def ordered_templates(templates: Sequence[tuple[str, str]], order: Sequence[str], percent: int) -> list[Template]:
    rank = {w: k for k, w in enumerate(order)}
    found = {}
    for label, text in templates:
        ranks = tuple(sorted(rank[w] for w in template_words(text)))
        if ranks:
            found[label, ranks] = Template(label, ranks, -(-len(ranks) * percent // 100))
    return list(found.values())


def _worded(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", words(F.col("text")).alias("words"))


def _matched(rows: DataFrame, templates: Sequence[tuple[str, str]], percent: int, order: Sequence[str]) -> DataFrame:
    """`rows` (words and others), once for each match with (start, end, label, containment), and
    once or more without (label NULL). `words` goes."""
    spark = rows.sparkSession
    known = ordered_templates(templates, order, percent)
    least = min(t.least for t in known)
    first_words = sorted({order[r] for t in known for r in t.prefix()})
    rank_of = F.map_from_arrays(_strings(order), F.array(*map(F.lit, range(len(order)))))
    others = [c for c in rows.columns if c != "words"]

    def block(start: Column) -> Column:
        own = F.array_intersect(F.slice("words", start + 1, WINDOW), _strings(order))
        ranks = F.array_sort(F.transform(own, lambda w: F.element_at(rank_of, w)))
        return F.struct(start.alias("start"), F.least(start + WINDOW, F.size("words")).alias("end"), ranks.alias("ranks"))

    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(STRIDE))
    long_enough = F.filter(F.transform(starts, block), lambda b: F.size(b["ranks"]) >= least)
    # what a whole text lacks no block of it holds; most rows end here
    rows = rows.withColumn("own", F.array_intersect("words", _strings(order)))
    of = [(t.least, _strings([order[r] for r in t.ranks])) for t in known]
    enough = _any([F.size(F.array_intersect("own", held)) >= least_of for least_of, held in of])
    may = F.arrays_overlap("own", _strings(first_words)) & (F.size("own") >= least) & enough
    rows = rows.withColumn("blocks", F.when(may, long_enough))
    rows = rows.select(*others, F.explode_outer("blocks").alias("block"))
    rows = rows.select(*others, "block.*")
    prefix = F.slice("ranks", 1, F.size("ranks") - least + 1)
    rows = rows.select(*others, "start", "end", "ranks", F.posexplode_outer(prefix).alias("at", "rank"))
    table = spark.createDataFrame(
        [(r, k, t.label, list(t.ranks), t.least) for t in known for k, r in enumerate(t.prefix())],
        "t_rank int, t_at int, label string, t_ranks array<int>, least int",
    )
    follow = F.least(F.size("ranks") - F.col("at"), F.size("t_ranks") - F.col("t_at"))
    common = F.size(F.array_intersect("ranks", "t_ranks"))
    same = (F.col("rank") == F.col("t_rank")) & (F.size("ranks") >= F.col("least")) & (follow >= F.col("least"))
    rows = rows.join(F.broadcast(table), same & (common >= F.col("least")), "left")
    return rows.select(*others, "start", "end", "label", (common / F.size("t_ranks")).alias("containment"))


def license_blocks(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, start, end, label, containment): every block of words [start, end) that holds at
    least `percent` percent of a template's distinct words; a label once per block, with its
    highest share. Repeated rows repeat their blocks; NULL and empty texts have none."""
    rows = _worded(docs)
    order = global_order(rows, sorted({w for _, t in templates for w in template_words(t)}))
    rows = _matched(rows.withColumn("row", F.monotonically_increasing_id()), templates, percent, order)
    keys = ["row", "doc_id", "start", "end", "label"]
    found = rows.filter("label is not null").groupBy(*keys).agg(F.max("containment").alias("containment"))
    return found.drop("row")


def _stands(phrase: str, at: Column) -> Column:
    """Whether the words of a phrase begin at word `at`."""
    held = F.lit(True)
    for k, word in enumerate(phrase.split(" ")):
        held = held & F.coalesce(F.get("words", at + k) == word, F.lit(False))
    return held


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    percent: int = PERCENT,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    The base are the places of `phrases`; `labels` adds those of matching templates. Both lists
    are distinct, sorted and joined by commas, '' if empty. `score` is 1 with a place of the
    base, else the highest share of a template in a block that matches it, else 0. NULL texts
    are empty: no words, no labels. Repeated rows repeat, whatever their ids; other columns are
    not read."""
    rows = _worded(docs)
    order = global_order(rows, sorted({w for _, t in templates for w in template_words(t)}))
    anywhere = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: _any([_stands(p, i) for p, _ in phrases])
    )
    begins = F.arrays_overlap("words", _strings(sorted({p.split(" ")[0] for p, _ in phrases})))
    rows = rows.withColumn("places", F.when(begins, anywhere))
    stands = lambda phrase: F.exists("places", lambda at: _stands(phrase, at))
    named = [F.when(stands(p), F.lit(label)) for p, label in phrases]
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"),
        F.array_max("places").cast("bigint").alias("last_word"),
        F.array_distinct(F.array_sort(F.array_compact(F.array(*named)))).alias("base"),
    )
    rows = rows.withColumn("n_base", F.greatest("n_base", F.lit(0)))
    digest = [c for c in rows.columns if c != "words"]
    found = _matched(rows, templates, percent, order).groupBy(*digest)
    found = found.agg(F.collect_set("label").alias("more"), F.max("containment").alias("share"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
