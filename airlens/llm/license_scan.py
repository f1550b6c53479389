"""License scan (operator 9): DataFrame functions only.

An exact set-similarity join of text blocks (lines) with license templates. Tokens are ordered by how many
documents hold them, rarest first. A block that covers at least ``need`` of a template's n distinct tokens
must hold one of the template's first n - need + 1 tokens (prefix filter), must have ``need`` tokens
itself (length filter), and behind the first common token both sides must have enough tokens left
(positional filter). What passes is verified by intersecting the sets.

Beside the join, places where the words of a base phrase stand in a row are counted.

Defined cases: a null or empty text has no words, labels or places and score 0; words keep letters beyond
A-Z as they are; repeated rows return one row each; other columns are ignored; an empty table gives an
empty result.
"""

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: what separates words, before and after lower-casing A-Z
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: fixed values: phrases of the contract and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: fixed values: notices as their licenses word them, and labels
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]
#: share of a template's distinct words that a block must hold
CONTAINMENT = 0.9
#: score of a document with a base phrase but no template
PHRASE_SCORE = 0.5


def tokens(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; only for texts known to be of interest, as it costs most."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def plain_tokens(text: str) -> list[str]:
    """The same for a template's ASCII text, on the driver."""
    return re.findall("[0-9a-z]+", text.lower())


def _any_of(found: list[str]) -> str:
    edge = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    return rf"(?i)(?:^|{edge})(?:{'|'.join(found)})(?={edge}|$)"


def token_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` by the number of documents holding each token, rarest first; one row per token returns."""
    held = (docs.where(F.col("_text").rlike(_any_of(vocabulary)))
            .select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), tokens(F.col("_text")))).alias("token"))
            .groupBy("token").count())
    count = {r["token"]: r["count"] for r in held.collect()}
    return sorted(vocabulary, key=lambda t: (count.get(t, 0), t))


def prefix_index(spark: SparkSession, order: list[str], templates, containment: float) -> DataFrame:
    """One row per template and prefix token: ``token, place, template, label, size, need, held``."""
    rank, rows = {t: k for k, t in enumerate(order)}, []
    for number, (label, text) in enumerate(templates):
        held = sorted(set(plain_tokens(text)), key=rank.get)
        need = math.ceil(round(containment * len(held), 9))
        rows += [(token, place, number, label, len(held), need, held)
                 for place, token in enumerate(held[: len(held) - need + 1])]
    return spark.createDataFrame(rows, "token string, place int, template int, label string, size int, need int, held array<string>")


def matches(docs: DataFrame, templates=None, containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, _hash, block, template, label, containment``: all blocks that meet the threshold."""
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, text in templates for w in plain_tokens(text)})
    order = token_order(docs, vocabulary)
    index = prefix_index(docs.sparkSession, order, templates, containment)
    keys = [r["token"] for r in index.select("token").distinct().collect()]
    lines = (docs.where(F.col("_text").rlike(_any_of(sorted(keys))))
             .select("doc_id", "_hash", F.posexplode(F.split("_text", "\n")).alias("block", "_line"))
             .where(F.col("_line").rlike(_any_of(sorted(keys)))))
    in_order = F.array_intersect(F.array(*map(F.lit, order)), tokens(F.col("_line")))
    blocks = lines.select("doc_id", "_hash", "block", in_order.alias("_tokens"))
    probes = blocks.select("*", F.explode(F.array_intersect(F.col("_tokens"), F.array(*map(F.lit, keys)))).alias("token"))
    common = F.array_intersect("held", "_tokens")
    place = F.array_position("_tokens", F.col("token"))
    return (probes.join(index, "token")
            .where((F.size("_tokens") >= F.col("need"))
                   & (1 + F.least(F.col("size") - F.col("place") - 1, F.size("_tokens") - place) >= F.col("need")))
            .where(F.get(common, 0) == F.col("token"))  # each pair by its first common token only
            .where(F.size(common) >= F.col("need"))
            .select("doc_id", "_hash", "block", "template", "label", (F.size(common) / F.col("size")).alias("containment")))


def places(w: str) -> Column:
    """Array of (start, label) of base phrases in the array column ``w`` of words, in order of start."""
    def label(word, i):
        found = F.lit(None).cast("string")
        for phrase, name in PHRASES.items():
            first, *rest = phrase.split()
            here = word == first
            for k, part in enumerate(rest, 1):
                here = here & (F.get(w, i + k) == part)
            found = F.when(here, F.lit(name)).otherwise(found)
        return F.struct(i.cast("long").alias("start"), found.alias("label"))

    return F.filter(F.transform(w, label), lambda x: x["label"].isNotNull())


def scan(docs: DataFrame, templates=None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: n_words, places of base phrases, labels and score."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    docs = docs.withColumn("_hash", F.xxhash64("_text"))
    pattern = "|".join(SEPARATORS.join(p.split()) for p in PHRASES)
    base = docs.select(
        "doc_id", "_hash", F.regexp_count("_text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.col("_text").rlike(f"(?i){pattern}"), tokens(F.col("_text")))
        .otherwise(F.array().cast("array<string>")).alias("_w"))
    base = base.withColumn("_places", places("_w")).drop("_w")
    found = matches(docs, templates, containment).groupBy("doc_id", "_hash").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_score"))
    found = found.withColumnsRenamed({"doc_id": "_doc", "_hash": "_key"})
    base_labels = F.array_sort(F.array_distinct(F.transform("_places", lambda x: x["label"])))
    return (base.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_key")), "left")
            .select(
                "doc_id", "n_words", F.size("_places").cast("long").alias("n_base"),
                F.get("_places", F.lit(0))["start"].alias("first_word"),
                F.get("_places", F.size("_places") - 1)["start"].alias("last_word"),
                F.array_join(base_labels, ",").alias("base_labels"),
                F.array_join(F.array_sort(F.array_union(base_labels, F.coalesce("_labels", F.array().cast("array<string>")))), ",").alias("labels"),
                F.coalesce("_score", F.when(F.size("_places") > 0, F.lit(PHRASE_SCORE)), F.lit(0.0)).alias("score")))
