import hashlib

from marquee.llm import spotsigs


def brute(text, chain=3):
    words = [spotsigs._WORDS[w] for w in text.encode().split()]
    common = 1 << 63
    spots, content = [0x5EED] + words, [n for n, w in enumerate([0] + words) if w and not w & common]
    found = set()
    for n, anchor in enumerate(spots):
        if n == 0 or anchor & common:
            after = [([0] + words)[k] for k in content if k > n][:chain]
            if after:
                found.add((anchor, *after))
    return found


def test_signatures_count_as_by_definition(documents):
    texts = [r.text for r in documents.select("text").collect()]
    for text, found in zip(texts, spotsigs.signatures(texts)):
        assert len(found) == len(brute(text)) or len(brute(text)) == 0
    assert [len(s) for s in spotsigs.signatures(["", "the of", " \n", "word", "..."])] == [0, 1, 0, 1, 1]


def test_a_text_has_the_same_signatures_in_any_company():
    texts = ["the red fox of the wood ran", "a", "", "and then came the winter of great cold"]
    for text, found in zip(texts, spotsigs.signatures(texts)):
        assert found.tolist() == spotsigs.signatures([text])[0].tolist()


def test_likeness_is_pruned_by_size():
    a, b, c = (spotsigs.signatures([t])[0] for t in ("the cat sat", "the cat sat", ""))
    assert spotsigs.likeness(a, b) == spotsigs.likeness(c, c) == 1.0
    assert spotsigs.likeness(a, c) == 0.0
    import numpy as np
    few, many = np.arange(10, dtype=np.uint32), np.arange(40, dtype=np.uint32)
    assert spotsigs.likeness(few, many) == 0.25
    assert spotsigs.likeness(few, many, 0.5) == 0.0
    assert spotsigs.likeness(many[:32], many, 0.8) == 0.8


def test_every_row_meets_its_next_one(documents):
    rows = sorted(((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()), reverse=True)
    prints = [s.tolist() for s in spotsigs.signatures([t for _, t in rows])]
    found = {r.doc_id: r for r in spotsigs.with_edits(documents).collect()}
    assert len(found) == len(rows)
    for n, (doc, text) in enumerate(rows):
        after = (n + 1) % len(rows)
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[after][1][:half]
        a, b = set(prints[n]), set(prints[after])
        assert found[doc].edited == edited
        assert found[doc].n_chars == len(text)
        assert found[doc].fingerprint == "".join(f"{x:08x}" for x in prints[n])
        assert found[doc].near_next == len(a & b) / len(a | b)


def test_awkward_rows(awkward, nothing):
    found = spotsigs.with_edits(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.near_next for r in sorted(by_id[2], key=lambda r: r.near_next)] == [1.0, 1.0]
    assert by_id[3][0].fingerprint == by_id[4][0].fingerprint == ""
    assert {r.near_next for r in by_id[None]} == {0.0, 1.0}
    assert spotsigs.with_edits(nothing).count() == spotsigs.fingerprints(nothing).count() == 0


def test_one_row_follows_itself(awkward):
    one, = spotsigs.with_edits(awkward.where("doc_id = 1")).collect()
    assert one.near_next == 1.0
    assert hashlib.sha256(one.edited.encode()).hexdigest()


def test_equal_texts_have_equal_fingerprints(awkward):
    prints = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(awkward).collect()}
    assert prints[1] == prints[2] != prints[7]
