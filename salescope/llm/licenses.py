"""License scans: diagonal voting.

Every pair of consecutive words of every document is hashed and joined with the
positions of the same pair in the templates.  A match at document position i
and template position j votes for the diagonal i - j, where the template would
start.  Votes are kept as a bit per template position, so a diagonal with all
bits is an exact occurrence.  Diagonals that lie next to each other (words put
in or left out) are merged, and the merged span is verified: it must cover
enough of the template without being much longer.  Everything is built of
DataFrame functions; the templates, fixed and few, are the broadcast side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescope.llm.common import lower_ascii, whole_text

#: The base phrases and their labels.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
#: Longer notices, found also with a few words changed; at most 63 words each.
NOTICES = (
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("apache-2.0", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution share alike 4 0 international license"),
    ("reserved", "no part of this publication may be reproduced stored in a retrieval system or transmitted in any form or by any means"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("bsl-1.0", "distributed under the boost software license version 1 0"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)
#: Votes that a diagonal of a notice needs, how far apart merged ones may lie, and the verified span's least cover and greatest stretch.
VOTES, GAP, COVER, STRETCH = 2, 3, 0.75, 1.5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def templates(spark: SparkSession) -> DataFrame:
    """A row for each pair of neighbouring words of each template, and one of
    template -1 that only the pair put before a document's words meets."""
    rows = [(-1, False, None, 2, 0, "", "")]
    for t, (base, label, text) in enumerate([(True, *x) for x in BASE] + [(False, *x) for x in NOTICES]):
        words = text.split()
        rows += [(t, base, label, len(words), j, a, b) for j, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    df = spark.createDataFrame(rows, "template int, base boolean, label string, n int, j int, a string, b string")
    return df.withColumn("hash", F.xxhash64("a", "b"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, base, label, start, cover): verified places of templates,
    and for each doc_id and text one row without a label that has n_words and,
    as copies, the number of its rows.  One pass over the texts gives all votes."""
    words = docs.select("doc_id", "digest", F.filter(F.split(lower_ascii(F.col("text")), NOT_WORD), lambda w: w != "").alias("words"))
    less = F.greatest(F.size("words") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("words", 1, less).alias("a"), F.slice("words", 2, less).alias("b"))
    own = F.array(F.struct(F.lit("").alias("a"), F.lit("").alias("b")))  # no word is empty
    pairs = words.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), F.posexplode(F.concat(own, pairs)).alias("i", "pair"))
    t = templates(docs.sparkSession).alias("t")
    votes = pairs.alias("p").join(F.broadcast(t), (F.xxhash64("p.pair.a", "p.pair.b") == F.col("t.hash")) & (F.col("p.pair.a") == F.col("t.a")) & (F.col("p.pair.b") == F.col("t.b")))
    i = F.col("i") - 1
    diagonals = votes.groupBy("doc_id", "digest", "template", "base", "label", "n", (i - F.col("j")).alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, t.j))").alias("bits"), F.min(i).alias("low"), (F.max(i) + 2).alias("high"), F.max("n_words").alias("n_words"), F.count("*").alias("copies")
    )
    count = F.expr("bit_count(bits)")
    strong = diagonals.where((F.col("template") < 0) | F.col("base") & (count == F.col("n") - 1) | ~F.col("base") & (count >= VOTES))
    # neighbouring diagonals of a notice are one place; those of a base phrase are places each
    order = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal")
    run = F.sum(F.when(~F.col("base") & (F.col("diagonal") - F.lag("diagonal").over(order) <= GAP), 0).otherwise(1)).over(order)
    merged = strong.withColumn("run", run).groupBy("doc_id", "digest", "template", "base", "label", "n", "run").agg(
        F.expr("bit_count(bit_or(bits))").alias("votes"), F.min("low").alias("start"), F.max("high").alias("high"), F.max(count).alias("best"), F.max("n_words").alias("n_words"), F.max("copies").alias("copies")
    )
    # a chain of chance diagonals is too long for its template: then its best single diagonal counts
    cover = F.when(F.col("high") - F.col("start") <= STRETCH * F.col("n"), F.col("votes")).otherwise(F.col("best")) / (F.col("n") - 1)
    return merged.withColumn("cover", cover).where((F.col("template") < 0) | (F.col("cover") >= COVER)).select("doc_id", "digest", "base", "label", "start", "cover", "n_words", "copies")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places with the smallest and largest
    start, base labels, all labels, and as score the best cover of any template.

    A null text counts as empty: no words, no labels (empty strings), score 0.
    A null doc_id stays null; repeated rows give repeated results; an empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text")).withColumn("digest", F.xxhash64("text"))
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    base = lambda c: F.when(F.col("base"), c)
    own = F.col("label").isNull()
    found = occurrences(rows).groupBy("doc_id", "digest").agg(
        F.max(F.when(own, F.col("n_words"))).alias("n_words"),
        F.max(F.when(own, F.col("copies"))).alias("copies"),
        F.count(base(F.lit(1))).alias("n_base"),
        F.min(base(F.col("start"))).cast("long").alias("first_word"),
        F.max(base(F.col("start"))).cast("long").alias("last_word"),
        names(base(F.col("label"))).alias("base_labels"),
        names(F.col("label")).alias("labels"),
        F.coalesce(F.max(F.when(~own, F.col("cover"))), F.lit(0.0)).alias("score"),
    )
    every = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return every.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
