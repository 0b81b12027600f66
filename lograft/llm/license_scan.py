"""License scan: phrases, and an exact set-similarity join with license templates.

A template is a set of words. A text block matches it if the block contains a
share of ``containment`` of the template's words or more. Blocks are all
windows of 2 * ``step`` words. Only those that start at a template word are looked at:
any other has no more template words than the next one of them.

The join is exact and prunes in this order:
- Words of templates are ordered by the number of documents they occur in, over
  the whole corpus, rarest first. A template that needs k of its n words has a
  prefix of n - k + 1 words; a block without any of them cannot match, and a
  document without any is not cut into blocks at all.
- Length: a block with fewer than k template words cannot match.
- Position: for a common word, the words after it on the shorter side bound what
  is still to come.
- What is left is counted in full.

Main path: DataFrame functions only. Everything about a document stays in its
row; the only table built is one count per template word.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Words of public license notices, and the labels they add.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit-notice": "released under the mit license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of anything but digits, a-z and characters beyond ASCII, in text with A-Z as a-z.
_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(folded, _GAPS), lambda w: w != "")


def _places(phrase: str) -> Column:
    """Where the phrase's words stand one after another (words from 0)."""
    parts = phrase.split()
    same = " and ".join(f"_w[i + {k}] = '{w}'" for k, w in enumerate(parts))
    return F.expr(f"filter(sequence(0, size(_w) - {len(parts)}), i -> {same})")


def template_order(docs: DataFrame, templates: Mapping[str, str], text_col: str = "text") -> dict[str, int]:
    """Rank of each template word by the number of documents with it, rarest first.
    Counts cover all documents; one row per template word reaches the driver."""
    vocabulary = sorted({w for t in templates.values() for w in t.split()})
    found = F.array_intersect(_words(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    counts = {r["w"]: r["count"] for r in docs.select(F.explode(found).alias("w")).groupBy("w").count().collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def _ints(values: Sequence[int]) -> str:
    return "array(" + ", ".join(map(str, values)) + ")"


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES,
                  containment: float = 0.9, step: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find license phrases and license text.

    Returns a row per row of ``docs``: doc_id, n_words, n_base (places of all
    phrases), first_word and last_word (smallest and largest start of a place,
    else null), base_labels and labels (distinct, sorted, comma-joined; labels
    has those of templates too), score (1 with a phrase, else the largest share of
    a matched template's words in one block, 0 without). Null and empty texts have
    no words and no labels. Null and repeated ids are returned as they are; no
    rows give no rows; other columns are not read. Texts are used whole.
    """
    if any(len(t.split()) > step for t in templates.values()):
        raise ValueError("a template is longer than step")
    rank = template_order(docs, templates, text_col)
    sets = {label: sorted({rank[w] for w in t.split()}) for label, t in templates.items()}
    need = {label: -(-int(round(containment * 1000)) * len(s) // 1000) for label, s in sets.items()}
    prefix = {label: s[: len(s) - need[label] + 1] for label, s in sets.items()}
    by_rank = {i: w for w, i in rank.items()}
    starters = sorted({i for p in prefix.values() for i in p})

    rows = docs.select(F.col(id_col).alias("doc_id"), _words(F.col(text_col)).alias("_w"))
    # Phrases: only where their rarest-looking word is there at all.
    lead = F.array(*(F.lit(max(p.split(), key=len)) for p in phrases))
    rows = rows.withColumn("_has", F.arrays_overlap("_w", lead)).withColumn("_can", F.arrays_overlap("_w", F.array(*(F.lit(by_rank[i]) for i in starters))))
    for k, p in enumerate(phrases):
        rows = rows.withColumn(f"_p{k}", F.when(F.col("_has") & (F.size("_w") >= len(p.split())), _places(p)).otherwise(F.array().cast("array<int>")))
    # Blocks: the ranks of a window's template words, in order; only windows with a word of a prefix.
    numbers = "map(" + ", ".join(f"'{w}', {i}" for w, i in sorted(rank.items())) + ")"
    rows = rows.withColumn("_r", F.when(F.col("_can"), F.expr(f"transform(_w, w -> {numbers}[w])")).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("_first", F.expr(f"""array_distinct(flatten(transform(
        filter(transform(_r, (r, i) -> if(array_contains({_ints(starters)}, r), i, null)), i -> i is not null),
        i -> filter(sequence(greatest(0, i - {2 * step - 1}), i), s -> _r[s] is not null))))"""))
    blocks = F.expr(f"transform(_first, s -> array_sort(array_distinct(filter(slice(_r, s + 1, {2 * step}), r -> r is not null))))")
    rows = rows.withColumn("_blocks", F.array_distinct(blocks))
    shares = []
    for label, s in sets.items():
        k, n = need[label], len(s)
        ahead = " or ".join(f"(array_contains(b, {r}) and 1 + least({n - i - 1}, size(b) - array_position(b, {r})) >= {k})" for i, r in enumerate(prefix[label]))
        same = f"size(array_intersect({_ints(s)}, b))"
        shares.append(F.struct(F.lit(label).alias("label"), F.expr(
            f"aggregate(filter(_blocks, b -> size(b) >= {k} and ({ahead})), 0, (m, b) -> greatest(m, {same})) / {n}").alias("share"), F.lit(k / n).alias("least")))
    rows = rows.withColumn("_matched", F.when(F.size("_blocks") > 0, F.filter(F.array(*shares), lambda x: x["share"] >= x["least"])))

    places = F.concat(*(F.col(f"_p{k}") for k in range(len(phrases))))
    base = F.array_sort(F.array_distinct(F.filter(F.array(*(F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values()))), lambda x: x.isNotNull())))
    rows = rows.select("doc_id", F.size("_w").cast("long").alias("n_words"), places.alias("_at"), base.alias("_base"),
                       F.coalesce("_matched", F.expr("array()").cast("array<struct<label:string,share:double,least:double>>")).alias("_matched"))
    return rows.select(
        "doc_id", "n_words", F.size("_at").cast("long").alias("n_base"),
        F.array_min("_at").cast("long").alias("first_word"), F.array_max("_at").cast("long").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.col("_matched.label"))), ",").alias("labels"),
        F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("_matched.share"), F.lit(0.0))).alias("score"))
