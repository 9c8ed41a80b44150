"""License scan: an exact set-similarity join of text blocks with license notices and bodies.

A template of up to STEP words is looked for in windows of 2 * STEP words, one starting at every STEP words, so
it lies whole in some window (a block); longer templates have blocks of their own length, a multiple of
STEP. A block meets a template if it holds at least THRESHOLD of the template's distinct words and all of its
naming words, which tell licenses of like wording apart. Words are ordered by their frequency in all texts: a
block that meets a template of m words with at least o in common must hold one of its m - o + 1 rarest words,
so only those (the prefix) start a candidate. Candidates whose length or word positions cannot reach o are
dropped before sets are compared. Blocks are cut out of a text once, so the work is linear in its length.

Exact phrases are looked up besides, as runs of consecutive words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_ascii, stage

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# (label, text, naming words): short notices, then bodies of public licenses, in the words of this module
TEMPLATES = [
    ("mit", "released under the mit license", "mit"),
    ("apache-2", "licensed under the apache license version 2 0", "apache"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution source binary"),
    ("mpl-2", "this file is subject to the terms of the mozilla public license version 2 0", "mozilla"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
            "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
            "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
     "permission granted sublicense merge"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain "
                 "a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed "
                 "on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language "
                 "governing permissions and limitations under the license", "apache compliance"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in "
            "binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
            "materials provided with the distribution", "redistributions retain reproduce"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
              "the free software foundation either version 3 of the license or at your option any later version", "gnu general public 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
            "copyright notice and this permission notice appear in all copies", "permission purpose fee"),
]
STEP, THRESHOLD = 24, 0.8


def words(text: Column | str) -> Column:
    """Words of a whole text: runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), SEPARATOR), "")


def _starts(phrase: str) -> Column:
    """Word positions at which a phrase begins, from the ``hits`` (p, w) in text order."""
    first, *rest = phrase.split()
    same = [f"x.w = '{first}'", *(f"get(hits, k + {j}).w = '{w}' AND get(hits, k + {j}).p = x.p + {j}" for j, w in enumerate(rest, 1))]
    return F.expr(f"filter(transform(hits, (x, k) -> IF({' AND '.join(same)}, x.p, NULL)), p -> p IS NOT NULL)")


def _needed(size: int, threshold: float) -> int:
    return math.ceil(threshold * size - 1e-9)


def block_step(text: str, step: int = STEP) -> int:
    """Distance of the blocks a template is looked for in: its length, as a multiple of ``step``."""
    return step * math.ceil(len(text.split()) / step)


def _in(words: set[str] | list[str]) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


def scanned(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str, str]] = TEMPLATES,
            step: int = STEP, threshold: float = THRESHOLD) -> DataFrame:
    """License labels of every row of ``docs`` (doc_id, text).

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and blocks. score is
    1 where a phrase stands, else the largest share of a template that a block holds if it meets the
    threshold, else 0. blocks lists what the join found: (label, first word of the block, share). Null text
    counts as empty: no words, no labels (''). Repeated rows are scanned each, an empty table gives no rows,
    texts of any length are scanned whole. Further columns drop. Templates are listed by their maker; words of
    templates and phrases are of the kind that :func:`words` gives.
    """
    sets = [sorted(set(text.split())) for _, text, _ in templates]
    steps = sorted({block_step(text, step) for _, text, _ in templates})
    parts = sorted({w for s in sets for w in s})
    known = sorted({w for p in phrases for w in p.split()} | set(parts))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words("text").alias("words"))
    hits = F.expr(f"filter(transform(words, (w, i) -> named_struct('p', i, 'w', w)), x -> x.w IN ({_in(known)}))")
    chunks = [F.expr(f"IF(size(words) = 0, array(), transform(sequence(0, (size(words) - 1) div {n}), "
                     f"b -> filter(slice(words, CAST(b * {n} + 1 AS INT), {n}), w -> w IN ({_in(parts)}))))").alias(f"chunks{n}") for n in steps]
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("bigint").alias("n_words"), hits.alias("hits"), *chunks), "hits")

    # frequencies of the templates' words over all texts: as many rows as the templates have words
    counted = rows.select(F.explode("hits.w").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    often = {r["w"]: r["n"] for r in counted}
    found = None
    for n in steps:
        index: dict[str, list[str]] = {}
        least = []
        for i, (label, text, names) in enumerate(templates):
            if block_step(text, step) != n:
                continue
            rare_first, needed = sorted(sets[i], key=lambda w: (often.get(w, 0), w)), _needed(len(sets[i]), threshold)
            least.append(needed)
            t = (f"named_struct('id', {i}, 'label', '{label}', 'needed', {needed}, 'size', {len(sets[i])}, "
                 f"'set', array({', '.join(repr(w) for w in rare_first)}), 'names', array({_in(names.split())}))")
            for w in rare_first[: len(rare_first) - needed + 1]:
                index.setdefault(w, []).append(t)
        heads = _in(list(index))
        # blocks of two chunks each that hold a word of some prefix, cut in one pass over the chunks
        blocks = (f"filter(transform(chunks{n}, (c, b) -> named_struct('block', b, 'held', array_distinct(concat(c, coalesce(get(chunks{n}, b + 1), array()))))), "
                  f"z -> size(z.held) >= {min(least)} AND exists(z.held, w -> w IN ({heads})))")
        # the inverted index of the prefixes: word -> templates
        case = "CASE w " + " ".join(f"WHEN '{w}' THEN array({', '.join(t)})" for w, t in index.items()) + " END"
        met = rows.select("row", F.explode_outer(F.expr(blocks)).alias("z")).where("z IS NOT NULL").select("row", "z.block", "z.held")
        met = met.select("row", "block", "held", F.explode(F.expr(f"array_distinct(flatten(transform(filter(held, w -> w IN ({heads})), w -> {case})))")).alias("t"))
        met = met.where("size(held) >= t.needed")  # length
        lowest = F.expr("array_min(transform(array_intersect(t.set, held), w -> array_position(t.set, w)))")  # 1 for the rarest
        met = met.where(lowest <= F.col("t.size") - F.col("t.needed") + 1)  # position: what can follow its rarest word must suffice
        met = met.withColumn("common", F.size(F.array_intersect(F.col("t.set"), F.col("held"))))
        met = met.where((F.col("common") >= F.col("t.needed")) & (F.size(F.array_except(F.col("t.names"), F.col("held"))) == 0))
        met = met.select("row", F.col("t.label").alias("label"), (F.col("block") * n).cast("bigint").alias("first_word"), (F.col("common") / F.col("t.size")).alias("share"))
        found = met if found is None else found.unionByName(met)
    found = found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("label", "first_word", "share"))).alias("blocks"))  # a few for each line of license text

    places = {f"s{i}": _starts(p) for i, p in enumerate(phrases)}
    all_places = F.concat(*places)
    base = F.concat(*[F.when(F.size(f"s{i}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")) for i, label in enumerate(phrases.values())])
    rows = rows.select("row", "doc_id", "n_words", "hits").withColumns(places).join(found, "row", "left")
    return rows.select(
        "doc_id", "n_words", F.size(all_places).cast("bigint").alias("n_base"), F.array_min(all_places).cast("bigint").alias("first_word"),
        F.array_max(all_places).cast("bigint").alias("last_word"), F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce(F.col("blocks.label"), F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size(all_places) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("blocks.share")), F.lit(0.0))).alias("score"), "blocks")
