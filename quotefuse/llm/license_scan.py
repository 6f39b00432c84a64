"""License scan with a positional rare-token index, in DataFrame operations only.

Words are runs outside ASCII non-alphanumerics with A-Z lower-cased. Templates
are word sequences of licence notices, each with a label and mandatory key
phrases. The template index has postings (word, template, position) for the
words worth indexing; function words are left out by the index's definition.

Scan: the inverse document frequency of every indexed word is counted over
all documents. A file looks up a template if it holds every indexed word of the
template's key phrases. It looks up ``rare`` of the template's words that it
holds: the ``agree`` of highest IDF of its first key phrase, then the others by IDF.
Their positions are joined with the template's postings; the difference of
positions places the template in the file, and the postings are intersected by
counting, for each (file, template, place), the template positions that agree.
A placement with at least ``agree`` of them (all, if the template has fewer) is
verified: every key phrase of the template must stand at its position word for
word. With ``agree`` 2 the choice of words loses no template that all words would
find: a first key phrase with fewer than two indexed words occurs only in templates
of at most ``rare`` words, which are looked up whole; ``rare`` below ``agree`` is an error. The score
is 1 for a base phrase and else the best share, of the template's indexed
positions or of ``rare`` if that is less, that agrees in a verified placement.

Base and key phrases are placed word for word: a phrase is found from its
first indexed word and checked against the words beside it.

Defined results: null has no words; a file without licence words has score 0,
null positions and empty labels; equal rows are scanned alike; other columns
are ignored; an empty table gives an empty result. Ties in IDF go by the word.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import saved

# fixed values: base phrases and their labels
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices of common licences: label, template, key phrases that must stand in place.
TEMPLATES = (
    ("gpl-notice", "this work is licensed under the gnu general public license version", ("gnu general public license",)),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    ("lgpl-notice", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ("gnu lesser general public license",)),
    ("apache-2.0-notice", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license", ("apache license version 2 0", "in compliance with the license")),
    ("mit-notice", "released under the mit license", ("mit license",)),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction", ("permission is hereby granted free of charge",)),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted", ("distribute this software for any purpose",)),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("cc-by-notice", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa-notice", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("unlicense-text", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
)
# words too common in any prose to be indexed
FUNCTION_WORDS = frozenset((
    "a and any are as by can for form in into is it may met not of or that the this to under use with you file files "
    "following person work code copy free published deal source subject v 0 2 4").split())

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def indexed_words() -> list[str]:
    words = set(itertools.chain.from_iterable(t.split() for _, t, _ in TEMPLATES)) - FUNCTION_WORDS
    return sorted(words | {p.split()[0] for p, _ in PHRASES})


def phrases() -> list[str]:
    """Base phrases, then the key phrases that are no base phrases."""
    base = [p for p, _ in PHRASES]
    return base + sorted({k for _, _, keys in TEMPLATES for k in keys} - set(base))


def file_words(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_words, places (pos, word) of indexed words and starts
    (pos, number) of phrases, of every row."""
    known, text = indexed_words(), F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.xxhash64(text).alias("h"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    # explode of one value keeps it from being computed again by each use
    words = words.select("doc_id", "h", F.explode(F.array("w")).alias("w"))
    at = F.array_compact(F.transform("w", lambda w, i: F.when(F.lower(w).isin(known), i)))
    places = F.transform(at, lambda i: F.struct(i.cast("long").alias("pos"), ascii_lower(F.get(F.col("w"), i)).alias("word")))
    found = words.select("doc_id", "h", "w", F.explode(F.array(F.filter(places, lambda p: p["word"] != ""))).alias("places"))

    def starts(number: int, want: list[str]) -> Column:
        off = next(i for i, w in enumerate(want) if w in known)

        def stands(p):
            test = p["word"] == want[off]
            for k, w in enumerate(want):
                if k != off:
                    test = test & (ascii_lower(F.get(F.col("w"), (p["pos"] - off + k).cast("int"))) == w)
            return F.coalesce(test, F.lit(False))

        return F.transform(F.filter("places", stands), lambda p: F.struct((p["pos"] - off).alias("pos"), F.lit(number).alias("number")))

    every = F.concat(*[starts(n, p.split()) for n, p in enumerate(phrases())])
    return found.select("doc_id", "h", F.size("w").cast("long").alias("n_words"), "places",
                        F.when(F.size("places") > 0, F.array_sort(every)).otherwise(F.array().cast(
                            "array<struct<pos:bigint,number:int>>")).alias("starts"))


def ascii_lower(word: Column) -> Column:
    """The word with A-Z lower-cased; empty for a word beyond ASCII, which is in no template."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.lit(""))


def template_postings(spark) -> DataFrame:
    """word, template, tpos: bounded by the fixed templates."""
    known = set(indexed_words())
    rows = [(w, n, i) for n, (_, t, _) in enumerate(TEMPLATES) for i, w in enumerate(t.split()) if w in known]
    return spark.createDataFrame(rows, "word string, template int, tpos long")


def template_phrases(spark) -> DataFrame:
    """number, template, at: where the key phrases stand in the templates; bounded likewise."""
    numbers, rows = {p: n for n, p in enumerate(phrases())}, []
    for n, (_, template, keys) in enumerate(TEMPLATES):
        words = template.split()
        for key in keys:
            want = key.split()
            rows.append((numbers[key], n, next(i for i in range(len(words)) if words[i:i + len(want)] == want)))
    return spark.createDataFrame(rows, "number int, template int, at long")


def lookups(ranked: list[str], agree: int = 2) -> Column:
    """For each template its number, the indexed words of its key phrases, and its own in the order of lookup."""
    known, place, out = set(indexed_words()), {w: i for i, w in enumerate(ranked)}, []
    for n, (_, template, keys) in enumerate(TEMPLATES):
        def rank(words):
            return sorted({w for w in words if w in known}, key=lambda w: (place.get(w, len(place)), w))
        first = rank(keys[0].split())[:agree]
        own = first + [w for w in rank(template.split()) if w not in first]
        out.append(F.struct(F.lit(n).alias("template"), F.array(*map(F.lit, rank(" ".join(keys).split()))).alias("must"),
                            F.array(*map(F.lit, own)).alias("own")))
    return F.array(*out)


def scan(docs: DataFrame, rare: int = 8, agree: int = 2) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    if rare < agree:
        raise ValueError(f"rare ({rare}) must be at least agree ({agree})")
    files = saved(file_words(docs.select("doc_id", "text")), "license_words")
    some = files.where(F.size("places") > 0).dropDuplicates(["doc_id", "h"])
    spark, known = docs.sparkSession, set(indexed_words())
    held = F.array_distinct(F.transform("places", lambda p: p["word"]))
    # document frequencies over all documents; as many rows as the templates have words
    df = files.where(F.size("places") > 0).select(F.explode(held).alias("word")).groupBy("word").count().collect()
    ranked = [r["word"] for r in sorted(df, key=lambda r: (r["count"], r["word"]))]  # highest IDF first
    tried = some.withColumn("held", held).select("doc_id", "h", "places", "held", F.explode(
        F.filter(lookups(ranked, agree), lambda c: F.size(F.array_except(c["must"], F.col("held"))) == 0)).alias("c"))
    tried = tried.withColumn("best", F.slice(F.array_intersect("c.own", "held"), 1, rare))
    looked = (tried.select("doc_id", "h", F.col("c.template").alias("template"), F.explode(
        F.filter("places", lambda p: F.array_contains(F.col("best"), p["word"]))).alias("p"))
        .select("doc_id", "h", "template", F.col("p.word").alias("word"), F.col("p.pos").alias("pos"))
        .join(F.broadcast(template_postings(spark)), ["template", "word"])
        .select("doc_id", "h", "template", (F.col("pos") - F.col("tpos")).alias("place"), F.lit(1).alias("word"), F.lit(0).alias("phrase")))
    stands = (some.select("doc_id", "h", F.explode("starts").alias("s")).select("doc_id", "h", "s.pos", "s.number")
              .join(F.broadcast(template_phrases(spark)), "number")
              .select("doc_id", "h", "template", (F.col("pos") - F.col("at")).alias("place"), F.lit(0).alias("word"), F.lit(1).alias("phrase")))
    sizes = F.array(*[F.lit(sum(w in known for w in t.split())) for _, t, _ in TEMPLATES])
    keys = F.array(*[F.lit(len(k)) for _, _, k in TEMPLATES])
    agreed = (looked.unionByName(stands).groupBy("doc_id", "h", "template", "place")
              .agg(F.sum("word").alias("n"), F.sum("phrase").alias("phrases"))
              .withColumn("size", F.get(sizes, F.col("template")))
              .where(F.col("n") >= F.least(F.lit(agree), F.col("size")))
              .where(F.col("phrases") == F.get(keys, F.col("template"))))
    label = F.get(F.array(*[F.lit(name) for name, _, _ in TEMPLATES]), F.col("template"))
    found = agreed.groupBy("doc_id", "h").agg(
        F.collect_set(label).alias("found"), F.max(F.least(F.lit(1.0), F.col("n") / F.least(F.col("size"), F.lit(rare)))).alias("part"))
    found = found.select(F.col("doc_id").alias("found_id"), F.col("h").alias("found_h"), "found", "part")
    rows = files.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("h") == F.col("found_h")), "left")
    base = F.filter("starts", lambda s: s["number"] < len(PHRASES))
    rows = rows.select("doc_id", "n_words", F.transform(base, lambda s: s["pos"]).alias("at"), F.array_sort(F.array_distinct(
        F.transform(base, lambda s: F.get(F.array(*[F.lit(name) for _, name in PHRASES]), s["number"])))).alias("base"),
        F.coalesce("found", F.array().cast("array<string>")).alias("found"), F.coalesce("part", F.lit(0.0)).alias("part"))
    return rows.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").alias("first_word"),
        F.array_max("at").alias("last_word"), F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", "found"))).alias("labels"),
        F.when(F.size("at") > 0, 1.0).otherwise(F.col("part")).alias("score"))
