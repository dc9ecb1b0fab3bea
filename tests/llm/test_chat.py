import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import chat
from tests.oracle_check import database, differences

CONTROL = st.lists(st.sampled_from(["\\", "#", "##", "###", "</turn>", "</turn", ">", "<", "|", "<|", "image_0", "|>", ":",
                                    ": ", " ", "\n", "a", "🙂", "</turn>\n", "### Assistant: "]), max_size=9).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(deadline=None, max_examples=400)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=5))
def test_whatever_a_turn_says_is_read_back(turns):
    writer = chat._Writer(("assistant",), chat.Rates(), 1 << 20)
    rows = [row for role, text in turns for row in writer.turn(1, role, text)] + list(writer.end())
    formatted = "".join(r[3] for r in rows)
    got = [(role, chat.unescape(formatted[a:b])) for role, a, b in chat.written_turns(formatted)]
    assert got == turns


@settings(deadline=None, max_examples=300)
@given(st.lists(st.one_of(CONTROL.map(lambda t: {"type": "text", "text": t}),
                          st.sampled_from(chat.KINDS).map(lambda k: {"type": k, "ref": f"{k}.bin"})), max_size=6))
def test_parts_are_read_back_and_texts_forge_no_placeholder(parts):
    flat = chat.Flattener(chat.Rates())
    for part in parts:
        flat.visit(part)
    written = flat.close()
    notes = [dict(zip(("ordinal", "kind", "ref", "at", "tokens"), a)) for a in flat.attachments]
    merged = []
    for part in parts:
        if part["type"] == "text" and merged and merged[-1]["type"] == "text":
            merged[-1] = {"type": "text", "text": merged[-1]["text"] + part["text"]}
        else:
            merged.append(part)
    assert chat.read_parts(written, notes) == [p for p in merged if p != {"type": "text", "text": ""}]
    for note in notes:
        assert written[note["at"]:].startswith(chat.placeholder(note["kind"], note["ordinal"]))


def test_attachments_are_numbered_and_their_tokens_counted(spark):
    rows = [(1, 0, "user", [("text", "see", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None),
                            None, ("audio", None, "b.wav", None, None, 2.1, None)]),
            (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3), ("odd", None, "d", None, None, None, None),
                                 ("odd", "plain", None, None, None, None, None)]),
            (1, 2, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn int, role string, text {chat.PARTS}")
    found = chat.format_conversations(df)
    one, = found.collect()
    assert one.formatted == ("### user: see<|image_0|><|audio_1|></turn>\n### assistant: <|document_2|><|document_3|>plain</turn>\n"
                             "### user: </turn>\n")
    assert [(a.ordinal, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        (0, "image", "a.png", 3), (1, "audio", "b.wav", 53), (2, "document", "c.pdf", 1536), (3, "document", "d", 1)]
    assert all(one.formatted[a.at:].startswith(f"<|{a.kind}_{a.ordinal}|>") for a in one.attachments)
    assert [one.formatted[s.start:s.end] for s in one.loss] == ["<|document_2|><|document_3|>plain"]
    read, = chat.read_back(found).collect()
    assert (read.n_turns, read.n_attachments, read.expanded_tokens) == (3, 4, 1593)


AWKWARD = [(1, 1, "assistant", "b"), (1, None, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (2, 0, None, None),
           (None, 0, "user", "lost"), (None, 1, "assistant", "found"), (3, 5, "a: b", "### a: </turn>\n<|image_0|> \\"),
           (4, 0, "assistant", "🙂" * 70_000)]


def test_awkward_rows_against_plain_python(spark):
    df = spark.createDataFrame(AWKWARD, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("conv", "content", "segment", "loss", "tokens", "formatted")})
    want = {}
    for conv in {r[0] for r in AWKWARD}:
        rows = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in AWKWARD if c == conv))
        loss = "".join(x for *_, r, x in rows if r == "assistant")
        want[conv] = (len(rows), sha("".join(f"{r}\n{x}\n" for *_, r, x in rows)), len(loss), sha(loss))
    for most in (1 << 20, 10):  # in one row, and cut between all turns
        segments = chat.format_conversations(df, segment_chars=most)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(segments).collect()}
        assert got == want
    parts = sorted((r.segment, r.first_char, r.formatted) for r in segments.where("conv_id = 1").collect())
    assert [p[0] for p in parts] == list(range(4))
    assert [p[1] for p in parts] == [sum(len(q[2]) for q in parts[:n]) for n in range(4)]


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).collect() == []


def test_sql_agrees_on_odd_turns(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD[:4] + AWKWARD[7:], "conv_id bigint, turn bigint, role string, text string")
    df.toPandas().astype({"turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    assert differences(spark, database(str(tmp_path)), str(tmp_path), "op11_chat") is None
