import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from millrace.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string, n_turns int"
MARKS = st.lists(st.sampled_from(["\\", "#", "###", "### assistant: ", "</turn>", "\n", "<", ":", "é", "😀", "a", " "]), max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(MARKS.map("".join), MARKS.map("".join)), min_size=1, max_size=5))
def test_any_text_comes_back(turns):
    buffer, places, *_ = chat.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    assert chat.parse(buffer.tobytes().decode()) == turns
    assert len(places) == len(turns) + 1 and places[-1] == len(buffer)


def rows():
    out = [(1, 0, "user", "hi", "x", 1), (1, 1, "assistant", "\\### user: </turn>\n", None, 2), (1, 1, "assistant", "", None, 2),
           (2, None, None, None, None, None), (2, 5, "assistant", "é" * 50, None, None), (None, 0, "assistant", "nobody", None, 0),
           (3, 0, "system", "only", "y", 1), (3, 0, "system", "only", "y", 1)]
    return out + [(9, i, "assistant" if i % 2 else "user", f"turn <{i}> " + "#" * (i % 5), None, i) for i in range(400)]


def plain(turns):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in turns:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, said in convs.items():
        said.sort()
        all_, loss = hashlib.sha256(), "".join(t for _, _, r, t in said if r == "assistant")
        chars = 0
        for _, _, role, text in said:
            all_.update(f"{role}\n{text}\n".encode())
            chars += 14 + len(role) + len(text) + sum(map((role + text).count, "\\#<")) + role.count(":") + role.count("\n")
        out.append((conv, len(said), all_.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


@pytest.mark.parametrize("batch_bytes", [1 << 21, 40])
def test_digests_agree_with_plain_version(spark, batch_bytes):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    formatted = chat.format_conversations(df, batch_bytes=batch_bytes)
    got = [tuple(r) for r in chat.digests(formatted).collect()]
    assert sorted(got, key=str) == plain(rows())
    pieces = formatted.where("conv_id = 9").count()
    assert pieces == 1 if batch_bytes > 1000 else pieces > 10


def test_loss_mask_covers_each_learned_text_once(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    for r in chat.format_conversations(df).collect():
        masked = [r.formatted[a:b] for a, b in zip(r.loss_starts, r.loss_stops)]
        assert [t for role, t in chat.parse(r.formatted) if role == "assistant"] == [
            chat._ESCAPED.sub(rb"\1", m.encode()).decode() for m in masked]


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
