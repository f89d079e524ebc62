"""Formatting: exact round trips, spans and digests against plain Python."""

import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest

from rollbook.llm import chat
from rollbook.llm.queries import op2_chat_format

SF = "/root/testdata/sf0.001"
PLAIN = chat.Template()


def digest(rows):
    """rows: (role, text) in order."""
    rows = [(r or "", t or "") for r, t in rows]
    learned = "".join(t for r, t in rows if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in rows)
    return len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_round_trip_of_control_strings():
    rnd = random.Random(6)
    bits = [*chat.CONTROLS, "<", "[", "\\", "|", "im_end|>", "s>", "/s>", "INST]", "\n", "é", "<|", "<<", "SYS>>", "漢"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 12))) for _ in range(3000)] + [None, ""]
    roles = [rnd.choice(["user", "assistant", None, "a\nb", "\\n", "<s>", "[INST]\\"]) for _ in texts]
    turns, first, last = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()), PLAIN)
    for role, text, turn, a, b in zip(roles, texts, *(x.to_pylist() for x in (turns, first, last))):
        assert PLAIN.read(turn) == (role or "", text or "")
        assert PLAIN.unescape(turn.encode()[a:b].decode()) == (text or "")
        inner = turn[len(PLAIN.start) : -len(PLAIN.end)]
        assert not any(c in inner for c in chat.CONTROLS)
    with pytest.raises(ValueError):
        chat.Template(controls=("<a<b>", "<b>"))
    with pytest.raises(ValueError):
        PLAIN.read("user: hi")


def test_query(spark):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r.conv_id].append((r.role, r.text))
    convs[-1] = [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    rows = op2_chat_format(spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in rows} == {c: digest(x) for c, x in convs.items()}
    assert len(rows) == len(convs) and all(r.formatted_chars > r.loss_chars for r in rows)


def test_edge_rows(spark):
    long = "x<|im_end|>" * 60_000
    rows = [(1, 2, "assistant", None, "f"), (1, 1, None, "q", "f"), (None, None, "assistant", "z", "f"),
            (2, 5, "user", long, None), (2, 5, "user", long, None), (2, 6, "assistant", long, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_turns(df)
    assert out.columns == ["conv_id", "turn", "formatted", "loss_start", "loss_end"] and out.count() == 6
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(out).collect()}
    assert got == {
        1: digest([(None, "q"), ("assistant", None)]),
        None: digest([("assistant", "z")]),
        2: digest([("user", long)] * 2 + [("assistant", long)]),
    }
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0
