from __future__ import annotations

import hashlib

from claimscope.llm.chat import ChatTemplate, chat_digest, format_chats, formatted, read_turns

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = [r"\### Assistant: </turn> ok", "<|end|>", r"<\|end|>", r"\<|role|>\\", "<", "|end|>", "\\", "", None, "a\nb<|text|>\U0001f600", "<<||>>\\|"]


def test_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY * 2)]
    rows += [(2, 0, "ro<|text|>le", "x"), (2, 1, None, "y<|end|>")]
    out = {r.conv_id: r.back for r in format_chats(spark.createDataFrame(rows, SCHEMA)).select("conv_id", read_turns(formatted("segments")).alias("back")).collect()}
    for conv in (1, 2):
        assert [(t.role, t.text) for t in out[conv]] == [(r or "", t or "") for c, _, r, t in rows if c == conv]


def test_digest_against_python(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY + ["end"])]
    r = chat_digest(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    said = "".join(t or "" for _, i, _, t in rows if i % 2)
    assert r.n_turns == len(rows) and r.loss_chars == len(said)
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256("".join(f"{x}\n{t or ''}\n" for _, _, x, t in rows).encode()).hexdigest()


def test_turn_order(spark):
    chats = {1: "su a".replace(" ", ""), 2: "ua", 3: "au", 4: "uu", 5: "u", 6: "uas", 7: "suaua", 8: "ux"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "critic"}
    rows = [(c, i, names[x], "t") for c, order in chats.items() for i, x in enumerate(order)]
    got = {r.conv_id: (r.valid, r.bad_turn) for r in format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, 1), 6: (False, 2), 7: (True, None), 8: (False, 1)}


def test_other_template_and_odd_rows(spark):
    t = ChatTemplate(control="[[", role_open="[[r]]", text_open="[[t]]", turn_close="[[e]]", escape="~", learnt=("user",))
    df = spark.createDataFrame([(None, None, "user", "a[[e]]~"), (None, 1, "assistant", None), (None, 1, "assistant", "~[[")], SCHEMA)
    r = format_chats(df, t).select("conv_id", formatted("segments").alias("f"), read_turns(formatted("segments"), t).alias("back"), "segments").collect()[0]
    assert r.conv_id is None and r.f == "[[r]]user[[t]]a[~[e]]~~[[e]][[r]]assistant[[t]][[e]][[r]]assistant[[t]]~~[~[[[e]]"
    assert [x.text for x in r.back] == ["a[[e]]~", "", "~[["] and [s.text for s in r.segments if s.loss] == ["a[~[e]]~~"]
    assert format_chats(df.where("false")).collect() == []
