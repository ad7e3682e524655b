import hashlib
import random

import pytest

from stockloom.llm import chat_format
from stockloom.llm.chat_format import TEMPLATE, Malformed

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SCRAPS = [
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]",
    "\\", "<", "[", "]", ">", "s>", "INST]", "/", "plain words", "é😀", "\n", "<\\s>", "[\\\\INST]", "",
]
ROLES = ["user", "assistant", "system", "tool", "", "[TEXT]", "a\\b</s>", "[\\TEXT]"]


def test_random_turns_read_back_one_by_one_and_together():
    choice = random.Random(3)
    whole, turns = "", []
    for _ in range(4000):
        role = choice.choice(ROLES)
        text = "".join(choice.choice(SCRAPS) for _ in range(choice.randrange(7)))
        formatted = TEMPLATE.settled(role, text)
        assert [(t.role, t.text) for t in TEMPLATE.parse(formatted)] == [(role, text)]
        whole += formatted
        turns.append((role, text))
    found = list(TEMPLATE.parse(whole))
    assert [(t.role, t.text) for t in found] == turns
    assert [TEMPLATE.unescape(whole[t.start : t.end]) for t in found] == [t for _, t in turns]
    # No control string is left inside a text.
    assert not any(TEMPLATE.plain.search(whole[t.start : t.end]) for t in found)


def test_only_conflicting_texts_are_escaped():
    assert TEMPLATE.settled("user", "a \\ b < [") == "[INST]a \\ b < [[/INST]"
    assert TEMPLATE.settled("user", "</s>") == "[INST]<\\/s>[/INST]"
    assert TEMPLATE.settled("user", "[\\INST]") == "[INST][\\\\INST][/INST]"
    assert TEMPLATE.settled("user", "[\\INST][INST]") == "[INST][\\\\INST][\\INST][/INST]"


@pytest.mark.parametrize(
    "text", ["x", "[INST]x", "[INST]a[INST]b[/INST]", "[INST]a</s>", "[/INST]", "[INST]a[/INST] ",
             "[ROLE]user[TEXT]a[/ROLE]", "[ROLE]a[/ROLE]"]
)
def test_malformed_text_is_refused(text):
    with pytest.raises(Malformed):
        list(TEMPLATE.parse(text))


def test_marks_that_could_run_into_each_other_are_refused():
    for marks in ({"a": ("<a", "a>")}, {"a": ("<<", "<<x")}, {"a": ("<", ">")}, {"a": ("<x>", "<x>")}):
        with pytest.raises(ValueError):
            chat_format.Template(marks, chat_format.OTHER)


def expected(rows):
    found = {}
    for conv_id, turn, role, text in rows:
        order = (turn is not None, turn or 0, role or "", text or "")
        found.setdefault(conv_id, []).append((order, role or "", text or ""))
    out = {}
    for conv_id, turns in found.items():
        turns = [(r, t) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv_id] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def test_digests_equal_the_source(spark, monkeypatch):
    choice = random.Random(8)
    rows = [
        (c, t, choice.choice(ROLES), "".join(choice.choice(SCRAPS) for _ in range(5)))
        for c in range(60) for t in range(choice.randrange(1, 9))
    ]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    rows += [(101, None, None, None), (101, 1, "user", None), (101, 1, "user", None), (101, 0, "assistant", "")]
    rows += [(None, 2, "user", "second"), (None, 1, "user", "first"), (102, 0, "assistant", "y" * 300_000)]
    choice.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    frame = frame.withColumn("piece", frame.role).withColumn("formatted", frame.role)
    for size in (1_000_000, 2_000):
        monkeypatch.setattr(chat_format, "PIECE", size)
        pieces = chat_format.formatted(frame)
        found = chat_format.digests(pieces).collect()
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}
        assert got == expected(rows) and len(found) == len(got)
        held = pieces.collect()
        assert sum(len(r.formatted) for r in held) == sum(r.formatted_chars for r in found)
        assert max(r.piece for r in held) == (0 if size > 10**5 else max(r.piece for r in held))
        for row in held:
            for start, end in row.loss:
                assert row.formatted[start - 3 : start] == "<s>" and row.formatted[end:].startswith("</s>")


def test_no_conversations(spark):
    empty = chat_format.formatted(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and chat_format.digests(empty).collect() == []
