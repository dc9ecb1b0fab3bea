import itertools
import random

import numpy as np
import xxhash

from marquee.llm import simhash


def brute_fingerprint(text, n=4):
    data = text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    words = data.split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def brute_roots(points, linked):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {p: find(p) for p in points}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_every_four_bits_are_left_out_by_some_mask():
    chosen = random.Random(1)
    for turn in (0, 1):
        masks = np.array(simhash.masks(4, turn), dtype=np.uint64)
        for _ in range(5_000):
            bits = np.uint64(sum(1 << b for b in chosen.sample(range(64), 4)))
            assert (masks & bits == 0).any()


def test_few_bits_are_free_after_both_masks():
    pairs = itertools.product(simhash.masks(4), simhash.masks(4, 1))
    assert max(64 - (a | b).bit_count() for a, b in pairs) <= 22


def test_groups_equal_those_of_all_pairs(spark, documents):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    prints = {d: brute_fingerprint(t) for d, t in texts.items()}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = brute_roots(prints, near)
    found = simhash.groups(documents).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        d: (signed(prints[d]), roots[d]) for d in prints}


def test_links_connect_what_is_near_in_large_buckets_too(spark):
    chosen = random.Random(7)
    centres = [chosen.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << b for b in chosen.sample(range(64), chosen.randint(0, 7))) for c in centres for _ in range(40)}
    points = sorted(signed(v) for v in values)
    near = [(a, b) for a, b in itertools.combinations(points, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    table = spark.createDataFrame([(p,) for p in points], "point bigint")
    for large in (3, 1_000):
        links = [tuple(r) for r in simhash.links(table, large=large).collect()]
        assert set(links) <= set(near)
        assert brute_roots(points, links) == brute_roots(points, near)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(1, n) for n in range(2, 40)] + [(70, 71), (71, 70)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{n: 100 for n in range(101, 161)}, **{n: 1 for n in range(2, 40)}, 71: 70}


def test_awkward_rows(awkward):
    found = {r.doc_id: r for r in simhash.groups(awkward).where("doc_id IS NOT NULL").collect()}
    assert [found[d].component_id for d in (1, 2, 3, 4, 5, 6)] == [1, 1, 3, 3, 3, 6]
    assert found[3].fingerprint == 0
    kept = simhash.one_of_each_group(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 8, 9]  # 7 is 1 over and over


def test_rows_of_one_id_with_unlike_texts_stay(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "quite another text that has no word of it", "x"), (1, "a b c d e f g", "y"),
            (1, "a b c d e f g", "y"), (2, "a b c d e f g", "x"), (None, "a b c d e f g", "x"), (None, "alone here", None),
            (None, "alone here", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = [sorted((r.doc_id or 0, r.text) for r in simhash.one_of_each_group(df.repartition(n)).collect()) for n in (1, 3)]
    assert kept[0] == kept[1] == sorted([(1, rows[0][1]), (1, rows[1][1]), (0, "alone here")])
    found = simhash.groups(df).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (None, 1), (None, None)}


def test_no_rows(nothing):
    assert simhash.groups(nothing).count() == 0
    assert simhash.one_of_each_group(nothing).count() == 0


def test_copies_with_few_edits_go_and_others_stay(spark):
    chosen = random.Random(3)
    vocabulary = ["".join(chosen.choices("abcdefghij", k=chosen.randint(3, 9))) for _ in range(3_000)]
    rows = []
    for n in range(60):
        words = chosen.choices(vocabulary, k=4_000)
        rows.append((n, " ".join(words)))
        words = list(words)
        for at in chosen.sample(range(4_000), 2):
            words[at] = chosen.choice(vocabulary)
        rows.append((1_000 + n, " ".join(words)))
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id bigint, text string"))
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(60)) <= ids
    assert len(ids) <= 63
