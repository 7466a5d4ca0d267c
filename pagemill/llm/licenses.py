"""Licence scan with a positional index of rare template words.

The words of all templates are counted over the corpus; each template is indexed by its rarest words and their
positions. The words of a file that are in the index are looked up, hits are grouped by their relative
position to the template, and a template counts as found where enough of its index words stand at
one relative position and its key phrase is in the file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pagemill.llm.columns import ascii_lower, let, whole_text, words_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEX_WORDS = 4
MIN_SHARE = 0.75

# Phrases with the label of the licence they name.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of public licences, with the phrase that has to be there.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free of charge to any person"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]


def license_words(text: Column) -> Column:
    return words_of(ascii_lower(text), SEPARATORS)


def _template_words(spark: SparkSession, templates: list[tuple[str, str, str]]) -> DataFrame:
    rows = [(name, word, at) for name, body, _ in templates for at, word in enumerate(body.split())]
    return spark.createDataFrame(rows, "template string, word string, at int")


def rare_word_index(words: DataFrame, templates: list[tuple[str, str, str]], size: int = INDEX_WORDS) -> DataFrame:
    """``word, template, at, size``: the rarest words of each template, by documents that hold them.

    ``words`` has the array ``words`` of every document. The index has at most ``size`` rows per template.
    """
    places = _template_words(words.sparkSession, templates)
    vocabulary = sorted({w for _, body, _ in templates for w in body.split()})
    held = words.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("word"))
    frequency = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # At most as many rows as the templates have words.
    counted = places.join(F.broadcast(frequency), "word", "left").fillna(0, ["n"])
    rank = Window.partitionBy("template").orderBy("n", "word", "at")
    ranked = counted.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= size)
    return ranked.select("word", "template", "at", F.count(F.lit(1)).over(Window.partitionBy("template")).alias("size"))


def _phrase_starts(words: Column, phrase: str) -> Column:
    parts = phrase.split()

    def here(word: Column, i: Column) -> Column:
        test = word == parts[0]
        for n, part in enumerate(parts[1:], start=1):
            test = test & F.coalesce(F.get(words, i + n) == part, F.lit(False))
        return F.when(test, i)

    return F.filter(F.transform(words, here), lambda i: i.isNotNull())


def _phrase_pattern(phrases: list[str]) -> str:
    return "|".join(re.escape(p).replace(r"\ ", SEPARATORS).replace(" ", SEPARATORS) for p in phrases)


def scan_licenses(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    templates: list[tuple[str, str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """Each row as the struct ``input`` with ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Base labels come from phrases that stand in the text as consecutive words; ``n_base`` counts their places and
    ``first_word`` and ``last_word`` are the smallest and largest. Labels of the method are the templates found;
    ``score`` is the largest share of a found template's index words at one relative position, else 0.

    NULL text counts as empty and has no label. Repeated rows get the same answer each, rows without an id too.
    An empty table gives no rows.
    """
    rows = df.select(
        F.struct("*").alias("input"), F.col(id_column).alias("doc"), whole_text(text).alias("text")
    ).withColumn("row", F.xxhash64("text"))
    words = rows.select("doc", "row", license_words(F.col("text")).alias("words"))
    index = rare_word_index(words, templates)
    # The index is bounded by the number of templates.
    hits = words.select("doc", "row", F.posexplode("words").alias("place", "word")).join(F.broadcast(index), "word")
    aligned = hits.groupBy("doc", "row", "template", (F.col("place") - F.col("at")).alias("shift")).agg(
        F.size(F.collect_set("at")).alias("n"), F.first("size").alias("size")
    )
    found = aligned.groupBy("doc", "row", "template").agg((F.max("n") / F.first("size")).alias("share"))
    found = found.where(F.col("share") >= MIN_SHARE)
    found = found.groupBy("doc", "row").agg(F.collect_list(F.struct("template", "share")).alias("found"))

    lowered = ascii_lower(F.col("text"))
    has_phrase = lowered.rlike(_phrase_pattern(list(phrases)))

    def keys(t: Column) -> Column:
        return F.array_compact(F.array(*[F.when(t.rlike(_bounded(key)), F.lit(name)) for name, _, key in templates]))

    def base(w: Column) -> Column:
        starts = [_phrase_starts(w, p) for p in phrases]
        labels = [F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(starts, phrases.values(), strict=True)]
        return F.struct(F.concat(*starts).alias("places"), F.array_compact(F.array(*labels)).alias("labels"))

    def measured(w: Column) -> Column:
        none = F.struct(F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("labels"))
        return F.struct(F.size(w).cast("long").alias("n_words"), F.when(has_phrase, base(w)).otherwise(none).alias("base"))

    counted = rows.select("input", "doc", "row", let(license_words(F.col("text")), measured).alias("m"))
    found = found.select(F.col("doc").alias("of"), F.col("row").alias("of_row"), "found")
    joined = counted.join(found, F.col("doc").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    # Only texts with aligned hits need the key phrases; the text is in the input and does not cross the join twice.
    whole = F.coalesce(F.col("input").getField(text).cast("string"), F.lit(""))
    verified = let(
        let(ascii_lower(whole), keys),
        lambda held: F.filter("found", lambda f: F.array_contains(held, f["template"])),
    )
    verified = F.when(F.col("found").isNotNull(), verified)
    result = joined.withColumn("verified", F.coalesce(verified, F.array().cast("array<struct<template:string,share:double>>")))
    places, base_labels = F.col("m.base.places"), F.col("m.base.labels")
    own = F.transform("verified", lambda f: f["template"])
    return result.select(
        "input",
        "m.n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("verified", lambda f: f["share"])), F.lit(0.0)).alias("score"),
    )


def _bounded(phrase: str) -> str:
    """A pattern for the phrase as whole words."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    return f"(?<!{word})(?:{_phrase_pattern([phrase])})(?!{word})"
