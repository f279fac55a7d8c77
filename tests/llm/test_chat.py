from collections import defaultdict

from forumshift.llm import chat

ROWS = [(1, 0, "system", "be & <|im_end|>"), (1, 1, "user", None), (1, 2, "assistant", "&lt;| ok\n<|im_start|>user\nx"),
        (1, 3, "assistant", ""), (1, 4, "user", "bye"), (2, 0, "user", "alone"), (3, 5, None, "&amp;"), (3, 5, "a\nb&nl;", "x"),
        (3, 5, "a\nb&nl;", "x"), (3, None, "assistant", "first"), (None, 1, "assistant", "null id"), (4, 0, "assistant", "é😀" * 9)]


def test_examples_hold_each_conversation_and_reply(spark):
    turns = spark.createDataFrame([(*r, "clash") for r in ROWS], "conv_id long, turn long, role string, text string, example string")
    made = chat.examples(turns)
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(ROWS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == want
    for c, said in want.items():
        assert list(got[c].losses) == [t for role, t in said if role == "assistant" and t]
    sizes = defaultdict(int)
    for r in made.collect():
        sizes[r.conv_id] += len(r.text)
        if r.loss_end > r.loss_start:
            assert r.text[r.loss_end:] == chat.END and "<|" not in r.text[r.loss_start:r.loss_end]
    assert {c: r.formatted_chars for c, r in got.items()} == sizes


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.examples(empty).count() == 0 and chat.read_back(chat.examples(empty)).count() == 0
