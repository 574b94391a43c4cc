"""License scans by an exact set-similarity join, in DataFrame functions only.

Two things are found in every whole text:

* base labels, where the words of a phrase stand consecutively;
* labels of the templates below: a text block (a line, or a window of
  ``WINDOW`` words of a longer line, overlapping by half) has a template's
  label if it contains at least ``CONTAINMENT`` of the template's words;
  with ``across_lines`` such windows over the words of the whole text are
  blocks as well, so a notice may be wrapped.

The join of blocks and templates is exact.  Template words are put in
ascending order of the number of documents that hold them, counted over the
whole corpus.  A block that contains enough of a template shares one of the
rarest words of both (prefix filter), has enough template words (length
filter), and from the place of a shared word in both orders enough can still
follow (positional filter); what passes is verified.

The text is read once: a pass keeps, for each row, its figures, its distinct
template words and the blocks with enough template words to matter for any
template, and everything else works on that.  Only the templates are
broadcast, and only the frequencies of their words come to the driver, at
most one row for each word of the fixed list below.

Defined cases: a null text is an empty one: no words, no places, empty
labels, score 0; repeated rows each give a row; other columns are not
carried.  The score is the largest containment reached, 1 where a base
phrase stands, and 0 where no template is reached.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CONTAINMENT = 0.9
WINDOW = 64

# Phrases and their labels
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Words of license notices and their labels
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution noncommercial license": "cc-by-nc",
    "creative commons attribution sharealike license": "cc-by-sa",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "dedicated to the public domain under cc0 1 0 universal": "cc0",
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: all but ASCII letters, digits and characters outside ASCII, in lower-cased text
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _spaced(text: Column) -> Column:
    """The words of a lower-cased text between single spaces."""
    return F.trim(F.regexp_replace(text, NO_WORD, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _literal(words) -> Column:
    return F.array(*map(F.lit, words))


def _needed(template: str, containment: float) -> int:
    return ceil(containment * len({*template.split()}) - 1e-9)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
         templates: dict[str, str] | None = None, containment: float = CONTAINMENT, across_lines: bool = False) -> DataFrame:
    """Columns ``id_col``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels`` and ``score``."""
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    rows = materialize(_rows(docs, id_col, text_col, phrases, templates, containment, across_lines))
    found = _matches(rows, templates, containment)
    joined = rows.join(found, "row", "left")
    every = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.greatest(F.coalesce("score", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"))


def _rows(docs, id_col, text_col, phrases, templates, containment, across_lines) -> DataFrame:
    """One row per document with all that is needed of its text."""
    vocabulary = sorted({w for t in templates for w in t.split()})
    least = min(_needed(t, containment) for t in templates)
    text = docs.select(F.col(id_col).alias("id"), F.translate(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _UPPER.lower()).alias("low"))
    text = text.withColumn("spaced", _spaced(F.col("low")))
    text = text.withColumn("n_words", F.when(F.col("spaced") == "", 0).otherwise(_spaces(F.col("spaced")) + 1).cast("long"))
    text = text.withColumn("norm", F.concat(F.lit(" "), "spaced", F.lit(" ")))
    norm = F.col("norm")
    has = {p: F.contains(norm, F.lit(f" {p} ")) for p in phrases}
    count = [F.when(has[p], F.regexp_count(norm, F.lit(f"(?<= ){p}(?= )"))).otherwise(0) for p in phrases]
    first = [F.when(has[p], _spaces(F.substring(norm, F.lit(1), F.instr(norm, f" {p} "))) - 1) for p in phrases]
    last = [F.when(has[p], F.col("n_words") - _spaces(F.substring_index(norm, f" {p} ", -1)) - len(p.split()))
            for p in phrases]
    none = F.lit(None).cast("long")
    words = F.array_intersect(F.split("spaced", " "), _literal(vocabulary))
    return text.withColumn("words", words).select(
        F.monotonically_increasing_id().alias("row"), "id", "n_words",
        reduce(lambda a, b: a + b, count).cast("long").alias("n_base"),
        F.least(*first, none, none).cast("long").alias("first_word"),
        F.greatest(*last, none, none).cast("long").alias("last_word"),
        F.array_distinct(F.array_compact(F.array(*(F.when(has[p], F.lit(x)) for p, x in phrases.items())))).alias("base"),
        "words", _blocks(F.col("low"), F.col("spaced"), F.col("words"), vocabulary, templates, containment, least, across_lines)
        .alias("blocks"))


def _blocks(low, spaced, words, vocabulary, templates, containment, least, across_lines) -> Column:
    """The template words of each block of the text that has enough of them
    for some template; a text that has too few altogether has no such block."""
    enough = [F.size(F.array_intersect(_literal({*t.split()}), words)) >= _needed(t, containment) for t in templates]
    lines = F.transform(F.split(low, "\n"), lambda line: F.split(_spaced(line), " "))
    if across_lines:
        lines = F.concat(lines, F.array(F.split(spaced, " ")))
    windows = F.flatten(F.transform(lines, lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - WINDOW // 2 - 1, F.lit(0)), F.lit(WINDOW // 2)),
        lambda at: F.array_intersect(F.slice(w, at + 1, F.lit(WINDOW)), _literal(vocabulary)))))
    kept = F.filter(windows, lambda w: F.size(w) >= least)
    return F.when(reduce(lambda a, b: a | b, enough), kept).otherwise(F.array().cast("array<array<string>>"))


def _matches(rows: DataFrame, templates: dict[str, str], containment: float) -> DataFrame:
    """Columns ``row``, ``found`` (labels) and ``score`` of rows with a match."""
    counts = {r["word"]: r["n"] for r in rows.select(F.explode("words").alias("word"))
              .groupBy("word").agg(F.count("*").alias("n")).collect()}  # one for each template word at most
    vocabulary = sorted({w for t in templates for w in t.split()}, key=lambda w: (counts.get(w, 0), w))
    least = min(_needed(t, containment) for t in templates)
    entries = []
    for number, (template, label) in enumerate(templates.items()):
        own = [w for w in vocabulary if w in template.split()]
        needed = _needed(template, containment)
        for place, word in enumerate(own[:len(own) - needed + 1]):
            entries.append(F.struct(
                F.lit(word).alias("word"), F.lit(place).alias("place"), F.lit(number).alias("template"),
                F.lit(label).alias("label"), F.lit(needed).alias("needed"), _literal(own).alias("own")))
    index = rows.sparkSession.range(1).select(F.inline(F.array(*entries)))
    blocks = (rows.select("row", F.explode("blocks").alias("block"))
              .withColumn("block", F.array_intersect(_literal(vocabulary), "block")))
    prefixes = blocks.select("row", "block", F.posexplode(
        F.slice("block", F.lit(1), F.size("block") - least + 1)).alias("at", "word"))
    size, own = F.size("block"), F.size("own")
    pairs = (prefixes.join(F.broadcast(index), "word")
             .where((size >= F.col("needed")) & (F.col("at") <= size - F.col("needed")))
             .where(1 + F.least(size - F.col("at") - 1, own - F.col("place") - 1) >= F.col("needed")))
    verified = pairs.withColumn("share", F.size(F.array_intersect("block", "own")) / own).where(
        F.round(F.col("share") * own) >= F.col("needed"))
    return verified.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("score"))
