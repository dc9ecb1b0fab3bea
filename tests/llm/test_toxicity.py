import math
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import toxicity

LEARNED = {"zorgling": 5.0, "blurf*": 4.0}


def kinds(text):
    values = toxicity.features(text, toxicity.Lexicon(LEARNED))
    return {k for k, v in zip(toxicity.KINDS, values) if v}


@pytest.mark.parametrize("text, found", [
    ("A zorgling walks", {"insult"}), ("you are a Zorgling!", {"insult_at"}), ("the blurfen, he said", {"insult"}),
    ("he is not a zorgling", {"insult_negated"}), ("she said that was a zorgling", {"insult_reported"}),
    ("I will kill you. Fine", {"threat_at"}), ("the house is fine", set()), ("not at all. A zorgling", {"insult"}),
    ("never kill", {"threat_negated"}), ("", set()), ("a blur", set())])
def test_clauses(text, found):
    assert kinds(text) == found


def plain_reading(text, lexicon):
    """The kinds of all clauses, by looking at every word pair of a clause."""
    out = []
    for line in text.split("\n"):
        clause = []
        for word in [*line.split(), None]:
            if word is not None:
                clause.append(lexicon[word][0] if lexicon[word] else toxicity.NONE)
            if word is None or word[-1] in ".,;:!?|)":
                at = {kind: [n for n, c in enumerate(clause) if c == kind] for kind in range(6)}
                hits = at[toxicity.THREAT] or at[toxicity.INSULT]
                every = at[toxicity.THREAT] + at[toxicity.INSULT]
                near = lambda kind: any(abs(h - n) <= 6 for h in every for n in at[kind])
                if hits:
                    name = "threat" if at[toxicity.THREAT] else "insult"
                    negated = all(any(0 < h - n <= 3 for n in at[toxicity.NEGATION]) for h in hits)
                    out.append(f"{name}_negated" if negated else f"{name}_reported" if near(toxicity.REPORT) else
                               f"{name}_at" if near(toxicity.TARGET) else name)
                clause = []
    return out


def test_the_composed_automaton_against_a_plain_reading():
    chance = random.Random(4)
    words = ["zorgling", "blurfing", "kill", "you", "they", "not", "never", "said", "told", *["walk", "house", "tree"] * 4]
    lexicon = toxicity.Lexicon(LEARNED)
    seen = set()
    for _ in range(3_000):
        text = "".join(chance.choice(words) + chance.choice([" ", " ", " ", " ", ", ", ". ", "\n"]) for _ in range(25))
        kinds = plain_reading(text, lexicon)
        want = [math.log1p(kinds.count(k)) for k in toxicity.KINDS]
        assert toxicity.features(text, lexicon)[: len(toxicity.KINDS)] == want
        seen.update(kinds)
    assert seen == set(toxicity.KINDS)


def test_line_breaks_end_clauses_and_far_words_do_not_count():
    assert kinds("Zorgling\nThe weather was said to be fine\nThank you") == {"insult"}
    assert kinds("you are\nzorgling said him\nnot\nfine") == {"insult_reported"}
    far = " ".join(["tree"] * 7)
    assert kinds(f"you {far} zorgling") == kinds(f"zorgling {far} said") == {"insult"}
    at = toxicity.FEATURES.index("strongest")
    lexicon = toxicity.Lexicon(LEARNED)
    assert toxicity.features("not a zorgling. the blurfen", lexicon)[at] == 4.0
    assert toxicity.features("he said zorgling", lexicon)[at] == 0.0


def test_a_stem_that_one_word_accounts_for_is_not_learned():
    kept = toxicity._telling({"worthless": 50, "wort*": 52, "worthle*": 50, "lowe*": 90, "loweia": 30, "lowein": 30})
    assert set(kept) == {"worthless", "lowe*", "loweia", "lowein"}


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, toxicity.toxicity(docs, labels).cache()


def test_held_out_accuracy(learned):
    docs, labels, found = learned
    held = found.where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.score for r in held if r.toxic == n] for n in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) >= 0.85
    assert sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)
    assert found.count() == docs.count()


def test_held_out_labels_are_not_read(learned):
    docs, labels, found = learned
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(
        F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in found.collect())


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (None, 1, 1), (7, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    found = toxicity.toxicity(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    none = toxicity.toxicity(awkward, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(nothing, labels).count() == 0
