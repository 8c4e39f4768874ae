"""Chat formatting: exact round trip and masks against brute force."""

import hashlib

import numpy as np

from finlake.llm import chat, tokens

CONTROL = [r"\### Assistant: </turn> ok", "</turn>\n### assistant:\n", "\\", "\\\\###", "a\\</turn>", "####", ":", "",
           " 漢字😀 <|endoftext|>", "x\n### user:\ny", "\\:", "tail\\"]


def test_render_parses_back():
    turns = [(role, text) for role in ("user", "assistant", "a:b\n", "", "### x</turn>") for text in CONTROL]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert "".join(chat.unescape(formatted[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_align_equals_a_mask_by_character():
    t = tokens.load(tokens.byte_tokenizer_path())
    formatted, spans = chat.render([("user", "hi there. "), ("assistant", " 漢字😀 ok"), ("assistant", ""), ("assistant", "x")])
    offsets = np.array(t.encode(formatted, add_special_tokens=False).offsets)
    mask, covered = chat.align(offsets, spans)
    inside = {i for a, b in spans for i in range(a, b)}
    assert mask.tolist() == [any(i in inside for i in range(a, b)) for a, b in offsets]
    assert covered == [s for s in spans if s[0] < s[1]]


def test_conversations_round_trip(spark):
    rows = [(-7, 0, "user", CONTROL[0], 1), (-7, 1, "assistant", CONTROL[0], 2), (1, 2, "assistant", None, 0),
            (1, 1, None, "b", 0), (1, 2, "assistant", "z", 0), (1, 2, "assistant", "z", 0), (None, 0, "assistant", "lost", 0),
            (2, None, "user", "first", 0), (2, 0, "system", "", 0)]
    rows += [(3, i, "assistant" if i % 2 else "user", CONTROL[i % len(CONTROL)] * 3, 0) for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    formatted = chat.format_conversations(df).collect()
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert set(got) == {r[0] for r in rows} and len(formatted) == len(got)
    for conv_id, r in got.items():
        turns = sorted((x for x in rows if x[0] == conv_id),
                       key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        said = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        heard = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        assert (r.n_turns, r.loss_chars) == (len(turns), len(said))
        assert r.turns_sha256 == hashlib.sha256(heard.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert all(len(r.ids) == len(r.loss_mask) for r in formatted)
    assert chat.format_conversations(df.limit(0)).count() == 0
