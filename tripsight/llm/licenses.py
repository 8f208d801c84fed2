"""Licence scan: a paragraph classifier with a calibrated unknown class and template comparison.

Every paragraph (line) of every document becomes the set of its words and word pairs that a notice
or a lookalike holds (``GRAMS``; other words have no part in any notice and weigh nothing). A
multinomial logistic regression over these sparse features tells licence families from ordinary
text. A paragraph counts as licence-like if its best family is more likely than a threshold that at
most ``ALPHA`` of held-back ordinary paragraphs exceed; it is confirmed if it holds at least
``OVERLAP`` of the word triples of one of the family's templates, otherwise its licence is unknown.

Everything runs in the JVM: DataFrame functions and the DataFrame-based learner. Training uses the
templates (whole, and set between other words) and every paragraph of every document without a cue:
paragraphs with the same set of grams are one weighted row, three quarters of them (by a hash) are
learnt from, the threshold comes from the counts of the last quarter. Only licence-like paragraphs
leave the scan.

Defined results: null and empty texts have no paragraphs and licence 'none'; ties between
paragraphs go to the likelier, then to the earlier one; repeated rows and null ids give one row
each with the same result as a single row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import handover

#: Training rows to a task: every optimiser step is a small job.
ROWS_PER_TASK = 50_000
#: Steps of log-odds in which held-back paragraphs are counted, and the largest that is told apart.
ODDS_STEP, MOST_ODDS = 0.01, 36.0
#: Share of held-back ordinary paragraphs that may pass the threshold, and the threshold's floor.
ALPHA, FLOOR = 0.001, 0.5
#: Least part of a template's word triples that a confirmed paragraph holds.
OVERLAP = 0.5
#: Least words of a paragraph that is scored (shorter ones have no triple).
MIN_WORDS = 3

#: Notices by which the licence families are known.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License.",
                   "Released under the Apache License 2.0."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is MIT licensed.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction."],
    "bsd": ["Licensed under the BSD License.", "Use of this source code is governed by a BSD-style license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "Licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation."],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 3.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License."],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3.",
             "You can redistribute it under the terms of the GNU Affero General Public License."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License 2.0."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License."],
    "public-domain": ["This work is dedicated to the public domain under CC0 1.0.",
                      "This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved.", "Copyright 2020. All rights reserved.",
                    "No part of this publication may be reproduced without prior written permission of the publisher."],
}
#: Openings that licences may follow, and sentences that only sound like them.
OPENINGS = ["", "Note that this text is published online.", "Copyright (c) 2019 the authors."]
LOOKALIKES = ["He lost his driver's license on the way to work.", "The museum released the paintings to the public.",
              "You may not use the back door after ten.", "All visitors reserved their seats in general.",
              "The version 2.0 of the plan was reviewed in 2004.", "The public library is free and open to any person.",
              "The terms of the general agreement were modified.", "A license fee is charged for each copy sold.",
              "She has the permission of the owner to restrict access.", "Rights and duties of all members are equal."]
#: Words that keep a paragraph out of the ordinary ones.
CUES = r"(?i)licen[sc]|copyright|permission|public domain|all rights|warrant|creative commons"

FAMILIES = ["none", *TEMPLATES]


def words_col(text: Column) -> Column:
    """Lower-cased words: runs of letters, digits and dots inside numbers."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\d)"), lambda w: F.length(w) > 0)


def _ngrams(words: Column, n: int) -> Column:
    """Distinct word n-grams of an array column."""
    top = F.size(words) - n + 1
    return F.when(top < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(top, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))))


def _known_rows() -> list[tuple[str, float]]:
    """The labelled paragraphs: templates, whole and behind openings, and lookalikes."""
    rows = [(f"{o} {t}".strip(), float(FAMILIES.index(f))) for f, ts in TEMPLATES.items() for t in ts for o in OPENINGS]
    return rows + [(t, 0.0) for t in LOOKALIKES]


def _known_grams() -> list[str]:
    """Words and word pairs of the labelled paragraphs (ASCII texts, split as ``words_col`` does)."""
    out = set()
    for text, _ in _known_rows():
        words = [w for w in re.split(r"[^a-z0-9.]+|\.(?!\d)", text.lower()) if w]
        out.update(words, map(" ".join, zip(words, words[1:])))
    return sorted(out)


#: The features, in order.
GRAMS = _known_grams()


def grams_col(words: Column) -> Column:
    """Distinct words and word pairs among ``GRAMS``, in order."""
    def of(w: Column) -> Column:
        # beyond the last word there is none, which gives that word alone once more
        pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_sort(F.array_distinct(F.filter(F.concat(w, pairs), lambda g: g.isin(GRAMS))))

    # bound to a variable, else the plan splits the text once for each mention of the words
    return F.get(F.transform(F.array(words), of), F.lit(0))


def _featured(df: DataFrame) -> DataFrame:
    """Adds ``features`` for the grams in column ``grams``."""
    model = CountVectorizerModel.from_vocabulary(GRAMS, inputCol="grams", outputCol="features")
    return model.setBinary(True).transform(df)


@dataclass
class Classifier:
    model: LogisticRegressionModel
    threshold: float


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, place, paragraph) of every line with a non-space character."""
    src = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\n")).alias("place", "paragraph"))
    return src.where(F.length(F.trim("paragraph")) > 0)


def ordinary_counts(docs: DataFrame) -> DataFrame:
    """(held, grams, n): how many ordinary paragraphs of all documents have which set of grams."""
    plain = paragraphs(docs).where(~F.col("paragraph").rlike(CUES))
    held = F.pmod(F.xxhash64(F.lit(1), "paragraph"), F.lit(4)) == 0
    return (plain.select(held.alias("held"), words_col(F.col("paragraph")).alias("words"))
            .select("held", grams_col(F.col("words")).alias("grams"))
            .groupBy("held", "grams").agg(F.count(F.lit(1)).alias("n")))


def train_licenses(docs: DataFrame) -> Classifier:
    """Fit the classifier on the templates and all ordinary paragraphs, its unknown class on those held back."""
    spark = docs.sparkSession
    rows = _known_rows()
    known = spark.createDataFrame(rows, "paragraph string, label double").withColumn("words", words_col(F.col("paragraph")))
    plain = handover(ordinary_counts(docs), "license-paragraphs")
    n, groups = plain.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # templates weigh as much as the ordinary paragraphs
    weight = max(1.0, n / len(rows))
    fit = (known.select(grams_col(F.col("words")).alias("grams"), "label", F.lit(weight).alias("w")).coalesce(1)
           .unionByName(plain.where(~F.col("held")).select("grams", F.lit(0.0).alias("label"), F.col("n").cast("double").alias("w"))))
    fit = _featured(fit).select("features", "label", "w").coalesce(1 + groups // ROWS_PER_TASK)
    model = LogisticRegression(maxIter=40, regParam=1e-4, weightCol="w", family="multinomial").fit(fit)
    return Classifier(model, max(FLOOR, _threshold(_likelihood(_featured(plain.where("held")), model))))


def _threshold(held: DataFrame) -> float:
    """The least likelihood (to ``ODDS_STEP``) that at most ``ALPHA`` of the paragraphs counted by ``n`` exceed."""
    odds = F.ln(F.col("p") / F.greatest(1 - F.col("p"), F.lit(math.exp(-MOST_ODDS))))
    step = F.ceil(F.least(F.greatest(odds, F.lit(-MOST_ODDS)), F.lit(MOST_ODDS)) / ODDS_STEP)
    # at most 2 * MOST_ODDS / ODDS_STEP + 1 rows
    counts = held.groupBy(step.alias("step")).agg(F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    may, above, edge = ALPHA * sum(r["n"] for r in counts), 0, None
    for r in counts:
        edge = r["step"]
        above += r["n"]
        if above > may:
            break
    return 0.0 if edge is None else 1 / (1 + math.exp(-edge * ODDS_STEP))


def _likelihood(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """Adds ``p``, the chance of the likeliest family, and ``family``."""
    probs = model.transform(df).withColumn("probs", vector_to_array("probability"))
    families = F.slice("probs", 2, len(FAMILIES) - 1)
    names = F.array(*[F.lit(f) for f in FAMILIES[1:]])
    return (probs.withColumn("p", F.array_max(families))
            .withColumn("family", F.element_at(names, F.array_position(families, F.col("p")).cast("int")))
            .drop("probs", "probability", "rawPrediction", "prediction"))


def license_paragraphs(docs: DataFrame, clf: Classifier) -> DataFrame:
    """Licence-like paragraphs: doc_id, place, paragraph, family, p, overlap, confirmed."""
    spark = docs.sparkSession
    para = paragraphs(docs).withColumn("words", words_col(F.col("paragraph")))
    like = _likelihood(_featured(para.withColumn("grams", grams_col(F.col("words")))), clf.model) \
        .where(F.col("p") > clf.threshold).where(F.size("words") >= MIN_WORDS)
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    triples = (spark.createDataFrame(rows, "family string, template string")
               .select("family", _ngrams(words_col(F.col("template")), 3).alias("triples"))
               .groupBy("family").agg(F.collect_list("triples").alias("templates")))  # one short row per family
    own = _ngrams(F.col("words"), 3)
    share = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("own"))) / F.size(t)))
    return (like.withColumn("own", own).join(F.broadcast(triples), "family")
            .select("doc_id", "place", "paragraph", "family", "p", share.alias("overlap"))
            .withColumn("confirmed", F.col("overlap") >= OVERLAP))


def scan_licenses(docs: DataFrame, clf: Classifier) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, license, probability, n_like, n_confirmed."""
    like = license_paragraphs(docs, clf)
    found = (like.where(F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(
                 F.count_distinct("place").alias("n_like"),
                 F.count_distinct(F.when(F.col("confirmed"), F.col("place"))).alias("n_confirmed"),
                 F.max(F.struct(F.col("confirmed"), F.col("p"), (-F.col("place")).alias("q"),
                                F.col("family"))).alias("best")))
    text = F.coalesce("text", F.lit(""))
    n = F.size(F.filter(F.split(text, r"\n"), lambda x: F.length(F.trim(x)) > 0))
    docs_ = docs.select("doc_id", n.cast("long").alias("n_paragraphs"))
    return (docs_.join(found, "doc_id", "left").select(
        "doc_id", "n_paragraphs",
        F.when(F.col("best").isNull(), "none").when(F.col("best.confirmed"), F.col("best.family")).otherwise("unknown")
        .alias("license"),
        F.round("best.p", 9).alias("probability"), F.coalesce("n_like", F.lit(0)).alias("n_like"),
        F.coalesce("n_confirmed", F.lit(0)).alias("n_confirmed")))
