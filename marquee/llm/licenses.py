"""Licences in text: a trained classifier of paragraphs, confirmed against templates.

A paragraph's words and word pairs go into a sparse logistic regression over licence
families and one class of everything else. The threshold from which a family is believed is
set on held-out paragraphs of other text, so that hardly any of those passes. Both are
worked out from all other paragraphs of the corpus: those with the same terms are one row
that counts as many times. A believed
paragraph is then held against the family's templates, and is confirmed if enough of its
word triples stand there.

All of it is DataFrame expressions and Spark ML. The regression is sparse, so a paragraph
without any of the terms it kept gets the score of an empty one; those are told apart by an
overlap of word lists and never reach the classifier.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import shared_dir

# Wording of licence notices, by family.
TEMPLATES = {
    "apache": (
        "licensed under the apache license version 2.0 you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www.apache.org licenses license-2.0",
        "released under the apache license version 2.0", "apache license version 2.0 january 2004",
        "spdx-license-identifier apache-2.0"),
    "mit": (
        "released under the mit license", "this project is licensed under the terms of the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "licensed under the mit license", "the mit license mit", "spdx-license-identifier mit"),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later "
        "version", "released under the gnu general public license version 2", "licensed under the gpl version 3",
        "spdx-license-identifier gpl-3.0-or-later"),
    "lgpl": (
        "licensed under the gnu lesser general public license version 2.1",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        "spdx-license-identifier lgpl-2.1"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met", "licensed under the bsd 3-clause license", "released under the bsd license",
        "spdx-license-identifier bsd-3-clause"),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0", "spdx-license-identifier mpl-2.0"),
    "cc-by": (
        "licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license",
        "licensed under the creative commons attribution license", "spdx-license-identifier cc-by-4.0"),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0", "this work is licensed under a creative commons attribution-sharealike 4.0 "
        "international license", "spdx-license-identifier cc-by-sa-4.0"),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0", "this work is licensed under a creative commons attribution-noncommercial 4.0 "
        "international license", "spdx-license-identifier cc-by-nc-4.0"),
    "cc0": (
        "dedicated to the public domain under cc0 1.0", "to the extent possible under law the author has waived all "
        "copyright and related rights to this work", "spdx-license-identifier cc0-1.0"),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = "unknown"

#: What all other paragraphs weigh together in the fit, at most, so that the templates' rows, each of weight 1, still
#: count beside a large corpus. It is the same part for every paragraph; none is left out.
OTHER_WEIGHT = 15_000.0
#: One paragraph in so many is held out of the fit and sets the threshold.
HELD_OUT = 4
#: Steps of probability in which held-out paragraphs are counted.
STEPS = 10_000
#: Share of held-out other paragraphs that may pass the threshold.
FALSE_ALARMS = 0.001
#: Share of a paragraph's word triples that must stand in a template of its family.
CONFIRM = 0.6
#: Words by which corpus paragraphs are kept from standing for everything else.
_TELLING = r"(?i)licen[cs]|copyright|creative commons|public domain|spdx|warrant|redistribut"

#: What stands between words, with the points and hyphens at a word's edges. It takes time in proportion to the text.
_WORD_BREAK = r"(?<![.-])(?:[.-]*+[^\p{L}\p{N}.-]++)++[.-]*+|^[.-]++|(?<![.-])[.-]++$"


def words(text: Column) -> Column:
    """Lower-case words; points and hyphens within a word stay, as in version numbers."""
    return F.filter(F.split(F.lower(text), _WORD_BREAK), lambda w: w != "")


def grams(found: Column, n: int) -> Column:
    """Rows of n words, joined by spaces."""
    count = F.size(found) - n + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda at: F.array_join(
        F.slice(found, at, n), " "))).otherwise(F.array().cast("array<string>"))


def terms(found: Column) -> Column:
    return F.concat(found, grams(found, 2))


def once(value: Column, name: str) -> Column:
    """A column that is worked out once for each row, however often it is named further on.

    Plain columns may be put in wherever they are named, in a loop over words as well.
    """
    return F.explode(F.array(value)).alias(name)


def paragraphs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``paragraph`` with its place: lines, and sentences within them."""
    cut = F.split(F.col(text_col), r"\n|(?<=[.!?])[ \t]+(?=\p{Lu})")
    return df.select(F.col(id_col).alias("id"), F.posexplode(cut).alias("place", "paragraph")).where("paragraph != ''")


def templates(spark: SparkSession) -> DataFrame:
    """``family`` and ``words`` of every template."""
    listed = F.array(*[F.struct(F.lit(family).alias("family"), F.lit(text).alias("text"))
                       for family, texts in TEMPLATES.items() for text in texts])
    return spark.range(1).select(F.inline(listed)).select("family", words(F.col("text")).alias("words"))


def template_rows(spark: SparkSession) -> DataFrame:
    """Labelled rows from the templates: each whole, and stretches of words from every place in it."""
    whole = templates(spark)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - 5, F.lit(1)))
    parts = whole.select("family", "words", F.explode(starts).alias("start")).select(
        "family", F.explode(F.array(*[F.slice("words", F.col("start"), n) for n in (6, 9, 14)])).alias("words"))
    return whole.union(parts.distinct())


@dataclass
class Model:
    """What has been fitted: terms, weights, and the probability from which a family is believed."""

    vocabulary: CountVectorizerModel
    regression: LogisticRegressionModel
    threshold: float
    classes: tuple[str, ...]
    common: dict[str, int]

    def telling_words(self) -> list[str]:
        """Words such that a paragraph without any of them can't be believed.

        A believed family is likelier than everything else. Words are given up from the most
        common on, as long as all terms made of given up words together don't make any family
        that likely. What is left is rare in other text.
        """
        weights = self.regression.coefficientMatrix.toArray()
        bias = self.regression.interceptVector.toArray()
        last = self.classes.index(UNKNOWN)
        gain = (weights - weights[last]).clip(min=0)[:last]
        start = (bias - bias[last])[:last]
        needs: dict[str, list[int]] = {}
        missing = []
        for n, term in enumerate(self.vocabulary.vocabulary):
            own = set(term.split(" "))
            missing.append(len(own))
            for word in own:
                needs.setdefault(word, []).append(n)
        told = []
        for word in sorted(needs, key=lambda w: (-self.common.get(w, 0), w)):
            full = [n for n in needs[word] if missing[n] == 1]
            more = gain[:, full].sum(axis=1)
            if (start + more < 0).all():
                start = start + more
                for n in needs[word]:
                    missing[n] -= 1
            elif gain[:, needs[word]].any():
                told.append(word)
        return sorted(told)

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have ``words``, with ``family`` and ``probability`` of the likeliest family."""
        return self.scored_terms(rows.withColumn("terms", terms(F.col("words")))).drop("terms")

    def scored_terms(self, rows: DataFrame) -> DataFrame:
        """``scored`` for rows that have their ``terms``."""
        scored = self.regression.transform(self.vocabulary.transform(rows))
        made = scored.select(*rows.columns, once(vector_to_array("probability"), "chances"))
        named = F.array(*[F.struct(F.col("chances")[n].alias("probability"), F.lit(c).alias("family"))
                          for n, c in enumerate(self.classes) if c != UNKNOWN])
        best = F.array_max(named)
        return made.select(*rows.columns, once(best, "best")).select(
            *rows.columns, F.col("best.family").alias("family"), F.col("best.probability").alias("probability"))


def known_terms(found: Column, vocabulary: list[str]) -> Column:
    """Those of ``terms`` that are in a list, each once and in order; other ones are not put together."""
    pairs = [t for t in vocabulary if " " in t]
    first, second = ({t.split(" ")[n] for t in pairs} for n in (0, 1))
    listed = F.filter(found, lambda w: w.isin(*{w for t in vocabulary for w in t.split(" ")}))
    joined = F.zip_with(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))), F.slice(found, 2, F.size(found)),
                        lambda a, b: F.when(a.isin(*first) & b.isin(*second), F.concat(a, F.lit(" "), b)))
    double = F.when(F.size(listed) > 1, F.filter(joined, lambda t: t.isin(*pairs))).otherwise(
        F.array().cast("array<string>"))
    single = F.filter(listed, lambda w: w.isin(*[t for t in vocabulary if " " not in t]))
    return F.array_sort(F.array_distinct(F.concat(single, double)))


def _others(df: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """All other paragraphs by their ``terms``: ``held``, whether they are held out, and ``n``, how many have those."""
    return (
        paragraphs(df, id_col, text_col).where(~F.col("paragraph").rlike(_TELLING))
        .select((F.xxhash64("id", "place") % HELD_OUT == 0).alias("held"), once(words(F.col("paragraph")), "words"))
        .where(F.size("words") > 0).groupBy("held", known_terms(F.col("words"), vocabulary).alias("terms"))
        .agg(F.count("*").alias("n"))
    )


def quiet_from(scored: DataFrame) -> float:
    """The probability that at most ``FALSE_ALARMS`` of all held-out paragraphs reach, 0.5 at least.

    They are counted by steps of probability, so what comes to the driver is a number for a step.
    """
    step = F.floor(F.col("probability") * STEPS).alias("step")
    total, = scored.agg(F.sum("n")).first()
    left = FALSE_ALARMS * (total or 0)
    for r in sorted(scored.where(F.col("probability") >= 0.5).groupBy(step).agg(F.sum("n").alias("n")).collect(),
                    reverse=True):
        left -= r["n"]
        if left < 0:
            return min(1.0, (r["step"] + 1) / STEPS)
    return 0.5


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit the classifier on the templates and on all of the corpus's other paragraphs.

    A paragraph counts by the templates' terms in it, and those with the same ones are a
    single row with their number as weight. The empty text always stands for everything
    else, so a corpus without other paragraphs, or without any, gives a classifier too.
    """
    spark = df.sparkSession
    shared_dir(spark)
    classes = (*FAMILIES, UNKNOWN)
    number = F.element_at(F.create_map(*[F.lit(x) for n, c in enumerate(classes) for x in (c, float(n))]), F.col("family"))
    known = template_rows(spark).select(number.alias("label"), terms(F.col("words")).alias("terms")).union(
        spark.range(1).select(F.lit(float(len(FAMILIES))), F.array().cast("array<string>"))).withColumn(
            "weight", F.lit(1.0)).checkpoint()
    vocabulary = CountVectorizer(inputCol="terms", outputCol="features", binary=True, vocabSize=1 << 14).fit(
        known.where(F.col("label") < len(FAMILIES)))
    others = _others(df, id_col, text_col, vocabulary.vocabulary).checkpoint()
    fitted = others.where("not held")
    count, = fitted.agg(F.sum("n")).first()
    weight = F.col("n") * F.lit(min(1.0, OTHER_WEIGHT / (count or 1)))
    rows = known.union(fitted.select(F.lit(float(len(FAMILIES))), "terms", weight))
    regression = LogisticRegression(family="multinomial", regParam=5e-4, elasticNetParam=0.8, maxIter=80,
                                    probabilityCol="probability", weightCol="weight").fit(vocabulary.transform(rows))
    common = others.select("n", F.explode("terms").alias("term")).where(~F.col("term").contains(" ")).groupBy("term").agg(
        F.sum("n"))
    model = Model(vocabulary, regression, 0.5, classes, dict(common.collect()))
    model.threshold = quiet_from(model.scored_terms(others.where("held")))
    return model


def may_hold(text: Column, telling: list[str]) -> Column:
    """Whether a text may hold any of some words: it has the longest plain part of one, between anything but a-z and 0-9."""
    parts = sorted({max(re.split(r"[^a-z0-9]+", w), key=len) for w in telling})
    return F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), F.array(*map(F.lit, parts)))


def classify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Believed paragraphs: ``id``, ``place``, ``paragraph``, ``family``, ``probability``, ``likeness`` and ``confirmed``.

    ``likeness`` is the share of the paragraph's word triples that a template of the family
    has; for a paragraph of fewer words, of its words.
    """
    telling = model.telling_words()
    texts = df.where(may_hold(F.col(text_col), telling))
    rows = paragraphs(texts, id_col, text_col).where(may_hold(F.col("paragraph"), telling)).select(
        "id", "place", "paragraph", once(words(F.col("paragraph")), "words"))
    believed = model.scored(rows).where(F.col("probability") >= model.threshold)
    shapes = templates(df.sparkSession).groupBy("family").agg(
        F.array_distinct(F.flatten(F.collect_list(F.concat(F.col("words"), grams(F.col("words"), 3))))).alias("wording"))
    own = F.when(F.size("words") >= 3, grams(F.col("words"), 3)).otherwise(F.col("words"))
    likeness = F.size(F.array_intersect(own, "wording")) / F.size(F.array_distinct(own))
    return believed.join(F.broadcast(shapes), "family").withColumn("likeness", likeness).withColumn(
        "confirmed", F.col("likeness") >= CONFIRM).drop("words", "wording")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per row: ``id_col``, ``families``, ``n_confirmed``, ``n_unconfirmed`` and ``probability``.

    ``families`` are those of confirmed paragraphs, sorted and comma-joined; ``unknown`` where
    a paragraph was believed and none confirmed; empty without any. ``probability`` is the
    highest of any believed paragraph, or null. Null and empty texts have none; an empty table
    gives no rows. Rows that
    share an id have the findings of all of them; a row without an id has none.
    """
    found = classify(df, model or fit(df, id_col, text_col), id_col, text_col).groupBy("id").agg(
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("names"),
        F.count_if("confirmed").alias("n_confirmed"), F.count_if(~F.col("confirmed")).alias("n_unconfirmed"),
        F.max("probability").alias("probability"))
    rows = df.select(F.col(id_col).alias("id"))
    names = F.when(F.col("n_confirmed") > 0, F.array_join("names", ",")).when(
        F.col("n_unconfirmed") > 0, F.lit(UNKNOWN)).otherwise(F.lit(""))
    zero = F.lit(0).cast("bigint")
    return rows.join(found, "id", "left").select(
        F.col("id").alias(id_col), names.alias("families"), F.coalesce("n_confirmed", zero).alias("n_confirmed"),
        F.coalesce("n_unconfirmed", zero).alias("n_unconfirmed"), "probability")
