"""License scans: a trained paragraph classifier, confirmed against templates (JVM operators only).

A paragraph is a run of lines without a blank one; its words are taken across line ends, so that wrapped notices are whole. A paragraph
of more than ``WINDOW`` words is read in windows that overlap by half, and once more in windows of ``NARROW`` words, in which a bare
name of a licence is not outweighed by the words around it; its lines are read by themselves, too, so that a licence in one
line is not lost beside another in the next. Word 1- to 3-grams of a window are hashed into a sparse
vector; a multinomial logistic regression gives the probability of every licence family and of ``unknown``. It is trained here
on the notices below, in several wordings and set between words of the corpus, against plain windows of the corpus and sentences that
only sound like licences. The plain windows are a bounded sample: those of the ``PLAIN_ROWS`` documents that come first by hash, at
most ``PLAIN_WINDOWS``. The unknown class is calibrated on windows held out of the fit: a family counts if its probability is above
all but ``FALSE_RATE`` of what held-out unknown windows get, and at least ``FLOOR``. Every family that counts is compared with its
templates, so that a window may name several: it is confirmed if at least ``CONFIRM`` of a notice's word pairs stand in
the window. Windows that cannot be confirmed are not classified: of a notice's ``n`` marks a confirmed window holds all but
``n - ceil(CONFIRM * n)``, so a few words that touch one mark more than that are enough, and a window without any of them is
confirmed for no notice (``needed_words``). Those words are taken from the notices, so no place of a text is passed over.

Cases: null and empty texts hold no licence; a text of any length is read in windows; several licences of a document are all named;
equal probabilities are of no matter, as every family is judged by itself; rows that repeat a doc_id get what any of them holds; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.llm.common import doc_texts, public_id, written

PLAIN_ROWS, PLAIN_WINDOWS = 1000, 4000  # documents and windows that train the unknown class
BUCKETS = 1 << 13
WINDOW, NARROW = 48, 12  # words; no notice is longer than half of WINDOW, names of licences fit NARROW
FALSE_RATE, FLOOR, CONFIRM = 0.001, 0.1, 0.6
UNKNOWN = "unknown"
CUES = ("licen", "copyright", "warrant", "permission", "redistribut", "public domain", "cc by", "cc-by", "cc0", "gpl", "terms of")

#: Usual notices of licence families.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "under the Apache License, Version 2.0",
        "Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "MIT License",
        "licensed under MIT",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GPL v2 or later.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "the GNU General Public License",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "AGPL": ("Licensed under the GNU Affero General Public License, version 3.", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": ("Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright under CC0."),
    "ISC": ("ISC License", "Licensed under the ISC license.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "EPL": ("Eclipse Public License", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0"),
    "EUPL": ("Licensed under the EUPL", "European Union Public Licence"),
    "Proprietary": ("All rights reserved. No part of this publication may be reproduced without written permission.", "Copyright. All rights reserved."),
}
SOUNDS_LIKE = (
    "He lost his driving license on the road.", "A license plate was found near the bridge.", "The fishing licence costs ten a year.", "She asked for permission to leave early.",
    "The warranty covers parts and labour for two years.", "Copyright law was discussed in the seminar.", "They were licensed to sell food at the market.", "Public domain maps show the old coast.",
    "The judge signed a warrant in the morning.", "With permission of the owner they crossed the field.", "The doctor is licensed in three states.", "Redistribution of land was debated for years.",
)
WORDINGS = ("{}", "This file: {}", "{} See the file for details.", "Copyright (c) 2021 the authors. {}", "# {}", "Note: {} Thanks to all contributors.", "The text below is shared as follows. {}")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9+.-]+"), lambda w: F.rtrim(w, F.lit(".")) != "")


def clean(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.rtrim(w, F.lit(".")))


def grams(ws: Column, n: int) -> Column:
    at = F.sequence(F.lit(1), F.size(ws) - (n - 1))
    found = F.transform(at, lambda i: F.array_join(F.slice(ws, i, n), " "))
    return F.when(F.size(ws) >= n, found).otherwise(F.array().cast("array<string>"))


def has_any(low: Column, parts: Sequence[str]) -> Column:
    """Whether a text holds one of the parts. A lambda binds ``low``, as a filter would compute it again for every part."""
    return F.exists(F.array(low), lambda t: reduce(lambda found, part: found | F.contains(t, F.lit(part)), parts, F.lit(False)))


def windows(d: DataFrame, text: str, *keep: str) -> DataFrame:
    """(keep, paragraph, ws): the word windows of every paragraph of a text column, and of every line of it."""
    p = d.select(*keep, F.posexplode(F.split(F.col(text), r"\n[ \t\r\x0B\x0C]*\n")).alias("paragraph", "_p"))
    lines = F.split("_p", "\n")
    parts = F.when(F.size(lines) > 1, F.concat(F.array("_p"), lines)).otherwise(F.array("_p"))
    p = p.select(*keep, "paragraph", F.explode(F.transform(parts, lambda t: clean(tokens(t)))).alias("_w")).where(F.size("_w") > 0)

    def of_width(width: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_w") - (width // 2 + 1)), F.lit(width // 2))
        return F.transform(starts, lambda k: F.slice(F.col("_w"), k + 1, F.lit(width)))

    both = F.when(F.size("_w") > NARROW, F.concat(of_width(WINDOW), of_width(NARROW))).otherwise(F.array("_w"))
    return p.select(*keep, "paragraph", F.explode(both).alias("ws"))


def features(d: DataFrame) -> DataFrame:
    """Adds ``marks`` (words and pairs) and the sparse vector ``features`` of a column ``ws``."""
    p = d.withColumn("marks", F.array_distinct(F.concat("ws", grams(F.col("ws"), 2))))
    p = p.withColumn("terms", F.concat("ws", grams(F.col("ws"), 2), grams(F.col("ws"), 3)))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="terms", outputCol="features").transform(p)


def families() -> list[str]:
    return [UNKNOWN, *NOTICES]


def fit(docs: DataFrame):
    """(model, least probability of a family), fitted on notices and a sample of the corpus."""
    spark = docs.sparkSession
    # few rows more than wanted pass a threshold of the hash, so that the order is one of some thousand rows at any size
    most = min(1 << 30, (4 * PLAIN_ROWS << 30) // max(doc_texts(docs).count(), 1) + 1)
    drawn = doc_texts(docs).withColumn("o", F.xxhash64("id", "text")).where(F.shiftrightunsigned("o", 34) < most)
    plain = drawn.where(~has_any(F.lower("text"), CUES)).orderBy("o").limit(PLAIN_ROWS)
    by = ["o", "paragraph", F.xxhash64("ws")]
    plain = windows(plain, "text", "o").orderBy(*by).limit(PLAIN_WINDOWS)
    at = F.row_number().over(Window.orderBy(*by))  # a bounded sample
    plain = written(plain.select("ws", at.alias("at"), (F.pmod(F.xxhash64("o"), F.lit(4)) == 3).alias("held")), "license-plain")
    rows = [(w.format(t), float(i + 1), False) for i, texts in enumerate(NOTICES.values()) for t in texts for w in WORDINGS]
    rows += [(w.format(t), 0.0, i % 4 == 3) for i, t in enumerate(SOUNDS_LIKE) for w in WORDINGS]
    named = spark.createDataFrame([(k + 1, *r) for k, r in enumerate(rows)], "at int, line string, label double, held boolean")
    named = named.withColumn("ws", clean(tokens(F.col("line")))).select("at", "ws", "label", "held")
    # each row once more between words of the corpus, so that a window of other text around a notice is known
    around = plain.where("not held").select(F.pmod(F.xxhash64("at"), F.lit(len(rows))).cast("int").alias("at"), F.col("ws").alias("other")).groupBy("at").agg(F.first("other").alias("other"))
    half = F.greatest(F.lit(0), F.floor((WINDOW - F.size("ws")) / 2)).cast("int")
    set_in = named.join(F.broadcast(around), "at").withColumn("ws", F.concat(F.slice("other", 1, half), "ws", F.slice("other", half + 1, half))).select("ws", "label", "held")
    train = named.select("ws", "label", "held").unionByName(set_in).unionByName(plain.select("ws", F.lit(0.0).alias("label"), "held"))
    train = written(features(train).select("label", "held", "features").coalesce(1), "license-train")  # a few thousand rows
    lr = LogisticRegression(maxIter=60, regParam=0.0005, elasticNetParam=0.0, family="multinomial", standardization=False)
    model = lr.fit(train.where("not held").coalesce(1))
    odds = model.transform(train.where("held and label = 0")).select(F.array_max(F.slice(vector_to_array("probability"), 2, len(NOTICES))).alias("p"))
    worst = odds.agg(F.percentile_approx("p", 1 - FALSE_RATE)).first()[0]
    return model, max(FLOOR, worst or 0.0)


def notice_marks() -> list[tuple[int, list[str]]]:
    """(family's class, word pairs) of every notice; of a notice of one word, the word."""
    out = []
    for i, texts in enumerate(NOTICES.values()):
        for t in texts:
            ws = [w.rstrip(".") for w in "".join(c if c.isalnum() or c in "+.-" else " " for c in t.lower()).split() if w.rstrip(".")]
            out.append((i + 1, sorted({f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False)}) or ws))
    return out


def needed_words() -> list[str]:
    """Words of which every window that ``CONFIRM`` of a notice's marks stand in holds at least one.

    Of ``n`` marks at most ``n - ceil(CONFIRM * n)`` may be missing, so one mark more than that is touched by the words taken:
    words that are taken already, then those with a cue, then long ones, as they are rare in other text."""
    taken: list[str] = []
    for _, marks in notice_marks():
        parts = [set(m.split(" ")) for m in marks]
        missing = len(marks) - math.ceil(CONFIRM * len(marks) - 1e-9)
        rank = lambda w: (not any(c in w for c in CUES), -len(w), w)
        for w in sorted(set().union(*parts), key=rank):
            touched = sum(1 for p in parts if any(t in x for t in taken for x in p))
            if touched > missing:
                break
            if not any(t in w for t in taken):
                taken.append(w)
    return sorted(t for t in taken if not any(o != t and o in t for o in taken))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_licenses, families, findings): findings are structs of paragraph, family, probability and confirmed share,
    one for each paragraph and family."""
    model, least = fit(docs)
    d = doc_texts(docs)
    needed = needed_words()
    near = windows(d.where(has_any(F.lower("text"), needed)), "text", "id").where(has_any(F.array_join("ws", " "), needed))
    # written tables keep the optimizer from repeating the features and the prediction in every later expression
    near = written(features(near).select("id", "paragraph", "marks", "features"), "license-windows")
    odds = F.posexplode(vector_to_array("probability")).alias("class", "p")
    scored = written(model.transform(near).select("id", "paragraph", "marks", odds).where((F.col("class") > 0) & (F.col("p") >= least)), "license-scores")
    notices = docs.sparkSession.createDataFrame(notice_marks(), "class int, notice array<string>")  # fixed size
    share = F.size(F.array_intersect("marks", "notice")) / F.size("notice")
    scored = scored.join(F.broadcast(notices), "class").withColumn("share", share).where(F.col("share") >= CONFIRM)
    best = F.max(F.struct("share", "p")).alias("best")
    scored = scored.groupBy("id", "paragraph", "class").agg(best)
    family = F.get(F.array(*map(F.lit, families())), F.col("class"))
    finding = F.struct("paragraph", family.alias("family"), F.round("best.p", 4).alias("probability"), F.round("best.share", 4).alias("confirmed"))
    found = scored.groupBy("id").agg(F.sort_array(F.collect_set(finding)).alias("findings"))
    out = d.select("id").join(found, "id", "left").withColumn("findings", F.coalesce("findings", F.array().cast(found.schema["findings"].dataType)))
    return out.select(
        public_id().alias("doc_id"),
        F.size("findings").cast("long").alias("n_licenses"),
        F.array_sort(F.array_distinct(F.transform("findings", lambda x: x["family"]))).alias("families"),
        "findings",
    )
