import hashlib
import zlib

import pytest

from marquee.llm import prefixes

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def in_order(rows, conv):
    return [(r or "", x or "") for _, _, _, r, x in sorted(
        (t is not None, t or 0, hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest(), r, x)
        for c, t, r, x in rows if c == conv)]


def rebuilt(rows):
    own = {c: in_order(rows, c) for c in {r[0] for r in rows} - {None}}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(int(c - (abs(c) % 20) * (1 if c >= 0 else -1)), [])[:h] + own[c][h:]
    return out


def brute(convs):
    """Every node with its subtree, by looking at all conversations."""
    nodes = {tuple(t[:d]) for t in convs.values() for d in range(len(t) + 1)}
    out = set()
    for node in nodes:
        d = len(node)
        members = sorted(c for c, t in convs.items() if tuple(t[:d]) == node)
        below = [v for v in nodes if v[:d] == node]
        size = {v: sum(tuple(t[: len(v)]) == v for t in convs.values()) for v in below}
        saved = sum((size[v] - 1) * len(v[-1][1].encode().split()) for v in below if v)
        leaves = sum(not any(len(w) == len(v) + 1 and w[: len(v)] == v for w in below) for v in below)
        ended = ",".join(str(c) for c in members if len(convs[c]) == d)
        parent = min(c for c, t in convs.items() if tuple(t[: d - 1]) == node[:-1]) if d else None
        out.add((members[0], d, parent, len(members), sum(len(w) == d + 1 for w in below), leaves, saved,
                 hashlib.sha256(ended.encode()).hexdigest()))
    return out


def found(df):
    rows = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
            for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, n):
    """Conversations that share starts, end inside others, repeat and run deep."""
    import random

    chance, rows = random.Random(seed), []
    for c in range(n):
        told = [("user", chance.choice(["hi", "a b c", ""])) for _ in range(chance.randint(0, 6))]
        if c % 7 == 0:
            told = [("system", "you are x"), *told, *[("user", f"more {k}") for k in range(25)]]
        rows += [(c * 3 - 20, t, role, text) for t, (role, text) in enumerate(told)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_all_conversations(spark, seed):
    rows = made(seed, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    plain = {c: in_order(rows, c) for c in {r[0] for r in rows}}
    assert found(prefixes.trie(prefixes.as_they_are(prefixes.turns(df)))) == brute(plain)
    assert found(prefixes.trie(prefixes.with_common_starts(prefixes.turns(df)))) == brute(rebuilt(rows))


def test_nested_conversations_and_one_very_long_pair(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(6) for t in range(c)]
    rows += [(c, t, "user", f"deep {t}") for c in (50, 51) for t in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(prefixes.trie(prefixes.as_they_are(prefixes.turns(df))))
    plain = {c: in_order(rows, c) for c in {r[0] for r in rows}}
    assert len(got) == 1 + 5 + 400
    assert {r for r in got if r[1] < 8} == {r for r in brute(plain) if r[1] < 8}
    assert (50, 400, 50, 2, 0, 1, 2, hashlib.sha256(b"50,51").hexdigest()) in got


def test_awkward_rows(spark):
    rows = [(1, 1, "user", "b"), (1, None, "user", "a"), (1, 1, "user", "b"), (1, 1, None, "b"), (2, 0, None, None),
            (None, 0, "user", "lost"), (20, 0, "user", "x " * 40_000), (21, 0, "user", "  \t\n"), (0, 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    df = df.withColumns({c: F.lit("x") for c in ("conv", "pos", "digest", "words", "key", "depth", "level", "run", "part")})
    assert found(prefixes.trie(prefixes.with_common_starts(prefixes.turns(df)))) == brute(rebuilt(rows))


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(prefixes.trie(prefixes.with_common_starts(prefixes.turns(df)))) == set()


def test_digest_of_very_many_ends_is_put_together_from_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "CHUNK_IDS", 7)
    ended = spark.range(1000).selectExpr("CAST('k' AS binary) AS key", "id * 3 AS conv").repartition(3)
    row, = prefixes.end_digests(ended).collect()
    assert row.ends_sha256 == hashlib.sha256(",".join(str(3 * n) for n in range(1000)).encode()).hexdigest()
