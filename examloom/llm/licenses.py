"""License labels: phrases anywhere, and blocks of lines that contain a license template.

The second part is an exact set-similarity join of text blocks (runs of `LINES` lines) with templates.
Tokens are ordered by their frequency in the whole corpus, rarest first.  A block can hold
`need` of a template's tokens only if the two share a token among their first
`size - need + 1` in that order (prefix filter), if it has that many known tokens (length
filter), and if enough tokens follow that first common one on both sides (positional
filter).  What is left is verified by the full intersection, and by the words that tell the license
from others.  The templates are a parameter of
fixed size, so their index is a literal in the plan and no text is shuffled.

One pass over the corpus splits each text once: it gives the tokens for that order, and stages
the texts of those documents alone that hold enough of a template's tokens, or a phrase, as a whole.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm.common import LOWER, UPPER, ascii_lower, staged

# Between words.  Texts are split: to match its complement, Java tests each character against every range.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWERED_TO_ASCII = "\u0130\u212A"  # beyond A-Z

PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# (words that tell the license from others and have to be there, text)
TEMPLATES = {
    "mit": [
        ("mit", "released under the mit license"),
        ("", "permission is hereby granted free of charge to any person obtaining a copy of this "
         "software and associated documentation files the software to deal in the software "
         "without restriction"),
    ],
    "apache-2": [
        ("apache 2", "licensed under the apache license version 2 0"),
        ("apache 2", "you may not use this file except in compliance with the license you may obtain a copy "
         "of the license at http www apache org licenses license 2 0"),
    ],
    "gpl-3": [
        ("gnu 3", "this work is licensed under the gnu general public license version 3"),
        ("gnu", "this program is free software you can redistribute it and or modify it under the terms "
         "of the gnu general public license as published by the free software foundation"),
    ],
    "cc-by-nc": [("cc nc", "licensed under cc by nc 4 0")],
    "cc-by-sa": [("cc sa", "licensed under cc by sa 4 0")],
    "bsd": [("", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met")],
}
THRESHOLD = 0.8
LINES = 4  # lines of a block: notices are wrapped, and the longest template takes about as many


def _template_sets(templates) -> list[tuple[str, list[str], list[str]]]:
    """(label, distinct tokens, those that have to be there)"""
    return [(label, sorted(set(text.split())), sorted(set(needed.split())))
            for label, texts in templates.items() for needed, text in texts]


def _lowered(text: Column, known: str) -> Column:
    """A-Z lowered, as far as the words of `known` can tell: no character beyond ASCII becomes one of ASCII."""
    if not known.isascii():
        return ascii_lower(text)
    odd = [text.contains(c) for c in LOWERED_TO_ASCII]
    return F.when(odd[0] | odd[1], ascii_lower(text)).otherwise(F.lower(text))


def _may_hold(tokens: Column, templates, threshold: float) -> Column:
    """Whether a text with these template tokens can hold a block that contains a template."""
    index, rare = [], set()
    for _, words, required in _template_sets(templates):
        need = ceil(threshold * len(words) - 1e-9)
        # Who holds `need` holds one of any size - need + 1; long words are seldom.
        rare.update(sorted(words, key=lambda w: (-len(w), w))[:len(words) - need + 1])
        index.append(F.struct(
            F.array(*map(F.lit, words)).alias("words"),
            F.array(*map(F.lit, required)).cast("array<string>").alias("required"), F.lit(need).alias("need")))
    return F.arrays_overlap(tokens, F.array(*map(F.lit, sorted(rare)))) & F.exists(F.array(*index), lambda t: (
        F.size(F.array_intersect(tokens, t["words"])) >= t["need"]) & (F.size(F.array_except(t["required"], tokens)) == 0))


def _split_once(docs: DataFrame, id_col: str, text: str, templates, phrases, threshold: float) -> DataFrame:
    """doc_id, n_words, _tokens (template tokens in it), and where something can be found, _spaced (words in
    order, a space around each) and _text (with its lines); both lowered.  Staged; the only pass over all texts."""
    sets = _template_sets(templates)
    vocabulary = sorted({w for _, words, required in sets for w in words + required})
    lowered = _lowered(F.col("_body"), " ".join([*vocabulary, *phrases]))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_body"))
    # One value each, kept above the expressions that use it.
    rows = rows.withColumn("_words", F.explode(F.array(F.trim(F.regexp_replace(lowered, GAP, " ")))))
    rows = rows.withColumn("_tokens", F.explode(F.array(
        F.array_intersect(F.split("_words", " "), F.array(*map(F.lit, vocabulary))))))
    gaps = F.octet_length("_words") - F.octet_length(F.replace("_words", F.lit(" "), F.lit("")))
    may_base = F.lit(False)
    for phrase in phrases:
        may_base = may_base | F.col("_words").contains(phrase)
    return staged(rows.select(
        "doc_id", F.when(F.col("_words") == "", 0).otherwise(gaps + 1).cast("long").alias("n_words"), "_tokens",
        F.when(may_base, F.concat(F.lit(" "), "_words", F.lit(" "))).alias("_spaced"),
        F.when(_may_hold(F.col("_tokens"), templates, threshold), lowered).alias("_text")), "license-texts")


def token_order(tokens: DataFrame, templates=TEMPLATES) -> list[str]:
    """Template tokens by their number of documents in the corpus, rarest first.

    `_tokens` of each document; the result has one row per template token, whatever the corpus' size.
    """
    vocabulary = sorted({w for _, words, _ in _template_sets(templates) for w in words})
    counts = tokens.select(F.explode("_tokens").alias("token")).groupBy("token").count()
    found = {r["token"]: r["count"] for r in counts.collect()}  # of template tokens only
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def _containments(lines: Column, order: list[str], templates, threshold: float) -> Column:
    """Array of (label, containment) of all lines and templates at or above the threshold."""
    rank = {w: i for i, w in enumerate(order)}
    ranks = F.create_map(*[x for w, i in rank.items() for x in (F.lit(w), F.lit(i))])
    known = F.array(*map(F.lit, order))
    index = []
    for label, words, required in _template_sets(templates):
        tokens = sorted(rank[w] for w in words)
        need = ceil(threshold * len(tokens) - 1e-9)
        index.append(F.struct(
            F.lit(label).alias("label"), F.array(*map(F.lit, tokens)).alias("tokens"),
            F.array(*map(F.lit, tokens[:len(tokens) - need + 1])).alias("prefix"),
            F.array(*[F.lit(rank[w]) for w in required]).cast("array<int>").alias("required"),
            F.lit(need).alias("need")))
    least = min(ceil(threshold * len(w) - 1e-9) for _, w, _ in _template_sets(templates))

    def line_ranks(line: Column) -> Column:
        return F.transform(F.array_intersect(F.split(line, GAP), known), lambda w: F.element_at(ranks, w))

    def block(of_lines: Column, at: Column) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.slice(of_lines, at + 1, F.lit(LINES)))))

    def candidate(b: Column, t: Column) -> Column:
        first = F.array_min(F.array_intersect(
            F.slice(b, F.lit(1), F.greatest(F.size(b) - t["need"] + 1, F.lit(0))), t["prefix"]))
        after = lambda s: F.size(s) - F.array_position(s, first) + 1
        return (F.size(b) >= t["need"]) & first.isNotNull() \
            & (after(b) >= t["need"]) & (after(t["tokens"]) >= t["need"])

    def matches(b: Column) -> Column:
        near = F.filter(F.array(*index), lambda t: candidate(b, t))
        scored = F.transform(near, lambda t: F.struct(
            t["label"].alias("label"),
            (F.size(F.array_intersect(b, t["tokens"])) / F.size(t["tokens"])).alias("share"),
            ((F.size(F.array_intersect(b, t["tokens"])) >= t["need"])
             & (F.size(F.array_except(t["required"], b)) == 0)).alias("ok")))
        return F.filter(scored, lambda m: m["ok"])

    def found(of_lines: Column) -> Column:
        blocks = F.filter(F.transform(of_lines, lambda _, at: block(of_lines, at)), lambda b: F.size(b) >= least)
        return F.flatten(F.transform(blocks, matches))

    # Bound as a lambda's variable, the lines' tokens are found once.
    return F.flatten(F.transform(F.array(F.transform(lines, line_ranks)), found))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates=TEMPLATES,
         phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lowered.  `n_base` counts
    all places of the phrases, `first_word` and `last_word` are the smallest and largest start
    (null without any), labels are distinct, sorted and comma-joined (empty without any).
    `score`: 1 with a phrase, else the largest containment found, else 0.  Null texts are
    empty, ids are passed on, an empty table gives no rows.
    """
    rows = _split_once(docs, id_col, text, templates, phrases, threshold)
    order = token_order(rows, templates)
    rows = rows.withColumn("_lines", F.split("_text", "\n"))
    found = []
    for phrase, label in phrases.items():
        pattern = f" {phrase}(?= )"
        has = F.col("_spaced").contains(f" {phrase} ")
        number = lambda before: F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))
        first = number(F.substring_index("_spaced", f" {phrase} ", 1))
        tail = F.substring_index("_spaced", f" {phrase} ", -1)
        last = number("_spaced") - 1 - number(tail) - len(phrase.split())
        found.append(F.when(has, F.struct(
            F.lit(label).alias("label"),
            F.regexp_count("_spaced", F.lit(pattern)).cast("long").alias("n"),
            first.cast("long").alias("first"), last.cast("long").alias("last"))))
    rows = rows.withColumn("_base", F.explode(F.array(F.array_compact(F.array(*found)))))
    rows = rows.withColumn("_more", F.explode(F.array(F.coalesce(
        _containments(F.col("_lines"), order, templates, threshold), F.array()))))
    base = F.array_sort(F.array_distinct(F.transform("_base", lambda b: b["label"])))
    both = F.array_union(base, F.transform("_more", lambda m: m["label"]))
    return rows.select(
        "doc_id", "n_words",
        F.aggregate("_base", F.lit(0).cast("long"), lambda s, b: s + b["n"]).alias("n_base"),
        F.array_min(F.transform("_base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("_base", lambda b: b["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(F.round(F.coalesce(
            F.array_max(F.transform("_more", lambda m: m["share"])), F.lit(0.0)), 6)).alias("score"))


def _sql(templates=TEMPLATES, phrases=PHRASES, threshold=THRESHOLD) -> str:
    values = ", ".join(
        f"('{label}', {i}, [{', '.join(map(repr, words))}], [{', '.join(map(repr, required)) or 'NULL'}]::VARCHAR[], "
        f"{ceil(threshold * len(words) - 1e-9)})" for i, (label, words, required) in enumerate(_template_sets(templates)))
    places = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS i, '{label}' AS label FROM pos WHERE w[i:i + {len(p.split()) - 1}] = "
        f"[{', '.join(repr(x) for x in p.split())}]" for p, label in phrases.items())
    return f"""
WITH templates(label, t, words, required, need) AS (VALUES {values}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM d),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w),
places AS ({places}),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, list(DISTINCT label) AS l
         FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, list_distinct(regexp_extract_all(array_to_string(l[i:i + {LINES - 1}], chr(10)),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS b
          FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
                FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d))),
hits AS (SELECT doc_id, label, len(list_intersect(b, words)) / len(words) AS share
         FROM lines, templates WHERE len(list_intersect(b, words)) >= need
           AND (required[1] IS NULL OR list_has_all(b, required))),
more AS (SELECT doc_id, max(share) AS share, list(DISTINCT label) AS l FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word,
  b::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.l), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(base.l, []) || coalesce(more.l, []))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE round(coalesce(share, 0), 6) END::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)"""


SQL = _sql()
