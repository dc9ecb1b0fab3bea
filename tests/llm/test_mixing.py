import re

from marquee.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Targets by pouring: shares by weight, the full ones closed, what is over poured again."""
    weights = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(sizes)}
    goal, left = dict.fromkeys(sizes, 0.0), mixing.SHARE * sum(sizes.values())
    while left > 1e-9 * (1 + sum(sizes.values())):
        open_ = [s for s in sizes if goal[s] < 2 * sizes[s] - 1e-9]
        if not open_:
            break
        per, left = left / sum(weights[s] for s in open_), 0.0
        for s in open_:
            goal[s] += per * weights[s]
            left += max(0.0, goal[s] - 2 * sizes[s])
            goal[s] = min(goal[s], 2.0 * sizes[s])
    return goal


def test_targets_and_words_taken(documents):
    found = mixing.mix(documents).collect()
    sizes = {}
    for r in documents.select("source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text))
    sizes = dict(sorted(sizes.items(), key=lambda x: x[0].encode()))
    goal, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    source = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]]
        assert abs(r.target - goal[source[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in goal)
    assert sorted(found) == sorted(mixing.mix(documents.repartition(3)).collect())


def test_the_schedule_is_even_at_every_length(spark, documents):
    placed, dealt = mixing.plan(documents, "doc_id", "text", "source")
    slots = sorted(mixing.schedule(dealt).collect())
    goals = {r.source_rank: r.aim for r in dealt.collect()}
    assert [r.slot for r in slots] == list(range(dealt.first().slot_count))
    seen, total = dict.fromkeys(goals, 0), sum(goals.values())
    for n, r in enumerate(slots, 1):
        assert r.block == seen[r.source_rank]
        seen[r.source_rank] += 1
        if n % 997 == 0:
            assert all(abs(seen[s] - n * goals[s] / total) < 20 for s in goals)


def test_awkward_rows(awkward, nothing):
    found = mixing.mix(awkward).collect()
    assert len(found) == awkward.count()
    assert {r.taken for r in found if r.size == 0} == {0}
    assert mixing.mix(nothing).count() == mixing.mixed_documents(nothing).count() == 0
    empty = awkward.where("doc_id IN (3, 4)")
    assert {(r.size, r.target, r.taken) for r in mixing.mix(empty).collect()} == {(0, 0.0, 0)}


def test_copies_follow_the_words_taken(awkward, documents):
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(documents).collect()}
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = dict.fromkeys(taken, 0)
    for r in mixing.mixed_documents(documents).collect():
        got[r.doc_id] += len(WORD.findall(r.text))
        assert r.text == texts[r.doc_id] or texts[r.doc_id].startswith(r.text) and WORD.findall(r.text)
    assert got == {d: t for d, (_, t) in taken.items()}


def test_no_python_in_the_plan(documents, capsys):
    for df in (mixing.mix(documents), mixing.mixed_documents(documents)):
        df.explain("formatted")
        plan = capsys.readouterr().out
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_sources_that_aim_at_less_than_a_slot_get_their_aim(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 4)
    rows = [(n, "word " * 40, "large") for n in range(50)]
    rows += [(1_000 + 10 * s + n, "a b c", f"small{s:02}") for s in range(12) for n in range(2)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    source = {r[0]: r[2] for r in rows}
    goal, taken, words = {}, {}, {}
    for r in mixing.mix(table).collect():
        goal[source[r.doc_id]] = r.target
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    for r in mixing.mixed_documents(table).collect():
        words[r.source] = words.get(r.source, 0) + len(WORD.findall(r.text))
    assert words == taken
    for s in goal:
        assert s == "large" or 0 < goal[s] < sum(goal.values()) / 16 and abs(taken[s] - goal[s]) <= 0.5


def test_every_source_comes_within_a_word_of_its_target(spark, monkeypatch):
    """Aims from a third of a slot to five slots, at eight slots."""
    monkeypatch.setattr(mixing, "SLOTS", 3)
    rows, source = [], {}
    for s, n_words in enumerate([2, 5, 9, 14, 22, 31, 31, 31]):
        for n in range(7):
            source[100 * s + n] = f"s{s}"
            rows.append((100 * s + n, "w\n" * n_words, f"s{s}"))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    goal, taken, mixed = {}, dict.fromkeys(source.values(), 0), dict.fromkeys(source.values(), 0)
    for r in mixing.mix(table).collect():
        goal[source[r.doc_id]] = r.target
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in goal)
    for r in mixing.mixed_documents(table).collect():
        mixed[r.source] += len(WORD.findall(r.text))
    assert mixed == taken


def test_the_mix_is_in_the_order_of_its_slots(documents):
    """Any long stretch of the mixed documents has every source in its share."""
    rows = mixing.mixed_documents(documents).select("source", "text").collect()
    words = [(r.source, len(WORD.findall(r.text))) for r in rows]
    whole = {s: sum(n for t, n in words if t == s) / sum(n for _, n in words) for s in {t for t, _ in words}}
    half = words[: len(words) // 2]
    for s, share in whole.items():
        assert abs(sum(n for t, n in half if t == s) / sum(n for _, n in half) - share) < 0.15


def test_equal_rows_and_rows_of_one_id(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (1, "d e f", "x"), (2, "g h i", "y"), (2, "g h i", "y"), (None, "j", "y")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = sum(r.taken for r in mixing.mix(table).collect())
    for n in (1, 4):
        found = sorted(map(str, mixing.mixed_documents(table.repartition(n)).collect()))
        assert sum(len(WORD.findall(eval(f.replace("Row", "dict"))["text"])) for f in found) == taken
        assert n == 1 or found == before
        before = found
