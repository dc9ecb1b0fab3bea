import re
import tracemalloc
from collections import Counter

from marquee.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, n=8):
    words = WORD.findall(text)
    found = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    inside = {i + k for i in range(len(words) - n + 1) if found[tuple(words[i:i + n])] > 1 for k in range(n)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


def covered(text, n):
    words = WORD.findall(text)
    found = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    inside = {i + k for i in range(len(words) - n + 1) if found[tuple(words[i:i + n])] > 1 for k in range(n)}
    return sum(len(words[i]) for i in inside)


def test_counts_equal_brute_force(documents):
    texts = [r.text for r in documents.select("text").collect()]
    texts += ["", " \n ", "a b c", "ä ö\n\nä ö\nä ö", "w " * 50, "x y z " * 30 + "\u0085 q"]
    made = quality.measure(texts)
    assert [list(row) for row in zip(*made[:5])] == [brute(t) for t in texts]
    lengths = tuple(quality.NGRAM_LIMITS)
    assert made[7] == [[covered(t, n) for n in lengths] for t in texts]


def test_texts_in_one_batch_do_not_mix():
    text = "one two three four five six seven eight nine ten"
    assert quality.measure([text, text])[4] == [0, 0]


def test_kept_rows_are_those_of_the_verdict(awkward, rows):
    verdicts = quality.quality(awkward)
    kept = quality.kept_documents(awkward)
    assert kept.columns == awkward.columns
    assert rows(kept, "doc_id") == rows(verdicts.where("kept"), "doc_id")
    assert {r.doc_id for r in verdicts.where("base_failed").collect()} == {3, 4, 5, 6, 7, 8, 9, None}
    assert rows(kept, "doc_id") == sorted([(1,), (2,), (2,), (None,)], key=repr)


def test_no_rows(nothing):
    assert quality.quality(nothing).count() == quality.kept_documents(nothing).count() == 0


def test_clean_documents_stay(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.quality(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count()
    count = {(r.quality, r.kept): r["count"] for r in judged.collect()}
    assert count.get((1, False), 0) <= 0.02 * count[1, True]
    assert count.get((0, True), 0) <= 0.1 * count.get((0, False), 1) + 2


def test_a_slice_of_one_letter_words_takes_little_memory():
    text = "".join(chr(97 + n * n % 23) + " " for n in range(quality.SLICE // 2))
    tracemalloc.start()
    quality.measure([text])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200 << 20


def test_a_text_goes_to_python_once(spark, capsys):
    docs = spark.createDataFrame([(1, "a b " * 20, 2), (2, None, 3)], "doc_id bigint, text string, n_words int")
    quality.kept_documents(docs).explain("formatted")
    given = re.search(r"MapInArrow\s*\nInput \[\d+\]: (.*)", capsys.readouterr().out).group(1)
    assert "text" not in given and "row" in given
