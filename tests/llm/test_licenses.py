import re

import pytest

from marquee.llm import licenses

SAID = {"cc-by-nc": "Licensed under CC BY-NC 4.0.", "apache": "Licensed under the Apache License, Version 2.0.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.", "mit": "Released under the MIT License."}


@pytest.fixture(scope="module")
def model(documents):
    return licenses.fit(documents)


def test_families_of_documents(documents, model):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    found = licenses.scan(documents, model=model).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.families == ",".join(sorted(k for k, v in SAID.items() if v in texts[r.doc_id]))


def test_wordings_and_other_text(spark, model):
    rows = [("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
            ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
            ("", "The driver showed a license to the officer and drove on under the bridge."),
            ("", "You may not use the public terms of any version."), ("", "")]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan(docs, model=model).collect()}
    for n, (family, _) in enumerate(rows):
        assert found[n].families == family or not family and found[n].n_confirmed == 0


def test_leaving_out_texts_without_telling_words_changes_nothing(documents, model):
    rows = licenses.paragraphs(documents, "doc_id", "text").withColumn("words", licenses.words(
        licenses.F.col("paragraph")))
    whole = model.scored(rows).where(licenses.F.col("probability") >= model.threshold).select("id", "place", "family")
    some = licenses.classify(documents, model).select("id", "place", "family")
    assert sorted(whole.collect()) == sorted(some.collect())


def test_awkward_rows(awkward, nothing, model):
    assert licenses.scan(awkward, model=model).count() == awkward.count()
    assert licenses.scan(nothing, model=model).count() == 0
    assert licenses.fit(nothing).threshold == 0.5


@pytest.mark.parametrize("texts", [[], [""], ["Released under the MIT License."], ["one", "two three", None],
                                   ["Released under the MIT License."] * 3 + ["Copyright of nobody."]])
def test_small_tables_and_tables_of_licences_alone(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.families for r in licenses.scan(docs).collect()}
    assert set(found) == set(range(len(texts)))
    assert all(found[n] == ("mit" if t and "MIT" in t else "") for n, t in enumerate(texts))


def test_awkward_rows_without_a_ready_model(awkward):
    assert licenses.scan(awkward).count() == awkward.count()


def test_no_python_in_the_plan(documents, model, capsys):
    licenses.scan(documents, model=model).explain("formatted")
    assert not re.search("Python|Pandas|Arrow|Cartesian", capsys.readouterr().out)


def test_every_other_paragraph_counts(spark):
    texts = ["The software of an author.\nWords of nobody. Said under the bridge, software and software."] * 160 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = licenses.fit(docs)
    assert model.common["software"] == 320 and model.common["author"] == 160
    counted = licenses._others(docs, "doc_id", "text", model.vocabulary.vocabulary).groupBy("held").sum("n").collect()
    assert sum(r[1] for r in counted) == 480 and {r[0] for r in counted} == {True, False}


def test_known_terms_are_those_of_all_terms(spark):
    texts = ["the mit license the mit", "License: the, mit-license version 2.0", "one", "the", "mit license"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(licenses.words(licenses.F.col("text")).alias("words"))
    known = ["mit", "the", "license", "the mit", "mit license", "version 2.0"]
    for r in rows.select(licenses.terms(licenses.F.col("words")), licenses.known_terms(licenses.F.col("words"), known)).collect():
        assert r[1] == sorted({t for t in r[0] if t in known})


def test_the_threshold_counts_all_held_out_paragraphs(spark):
    rows = [(0.1, 10_000), (0.7, 4), (0.75, 6), (0.9, 3)]
    scored = spark.createDataFrame(rows, "probability double, n bigint")
    assert licenses.quiet_from(scored) == 0.7001  # 10 of 10,013 may pass: 3 and 6 do, 4 more would be too many
    assert licenses.quiet_from(scored.where("probability < 0.5")) == 0.5
    assert licenses.quiet_from(scored.where("probability > 1")) == 0.5
