"""Chat formatting: spans, round trip, long conversations, templates that rewrite history."""
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlake.llm import chat

TURNS = "conv_id bigint, turn bigint, role string, text string, block int, at string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)


def _want(rows):
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _got(frame):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.conversation_digests(chat.format_conversations(frame)).collect()}


def test_conversations(spark):
    hard = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (2, 0, "system", "s"), (2, 2, "assistant", None), (2, 1, "user", "é\n### User: "), (2, 1, "user", "é\n### User: "),
            (3, 0, None, ""), (3, None, "tool: ### x\\", "</turn>"), (None, 0, "assistant", "null conversation"), (None, 1, "USER", "a" * 50_000)]
    rows += [(7, i, ("user", "assistant")[i % 2], f"turn {i} {hard}") for i in range(300)]  # several blocks
    rows += [(8, i * 5000, "assistant", f"t{i}") for i in range(70)]
    assert _got(_frame(spark, rows)) == _want(rows)
    assert _got(_frame(spark, [])) == {}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab:=#\\<>/ turn\n", max_size=12), st.text(alphabet="#\\</turn> :\nab", max_size=30)), max_size=5))
def test_a_rendered_turn_reads_back(turns):
    turns = [{"role": r, "text": t} for r, t in turns]
    text, starts, ends, rewrites = chat.spans(turns, chat.turn_template)
    assert not rewrites and [chat.parse_turn(text[a:b]) for a, b in zip(starts, ends, strict=True)] == [(t["role"], t["text"]) for t in turns]
    assert text == chat.turn_template(turns)


def test_a_template_that_rewrites_history():
    def last_first(turns):
        return "".join(t["text"] for t in reversed(turns))
    turns = [{"role": "user", "text": x} for x in "abc"]
    assert chat.spans(turns, last_first)[3]
    assert not chat.spans(turns, chat.turn_template)[3]


def _formatted(spark, template, n=200):
    rows = [(1, i, "system" if i == 0 else ("assistant", "user")[i % 2], f"t{i}") for i in range(n)] + [(2, 0, "user", "short")]
    got = chat.format_conversations(_frame(spark, rows), template).orderBy("conv_id", "block").collect()
    one = [r for r in got if r["conv_id"] == 1]
    return "".join(r["formatted"] for r in one), any(r["rewrites_history"] for r in one), len(one), any(r["rewrites_history"] for r in got if r["conv_id"] == 2)


def test_templates_that_look_far_back(spark):
    """Undeclared templates get every prefix whole; a declaration that is wrong is seen at the borders of blocks."""
    def numbered(turns):
        return "".join(f"{i + 1}. {t['text']}\n" for i, t in enumerate(turns))

    def system_again(turns):
        return "".join(f"[{turns[0]['text']}] {t['text']}\n" for t in turns)

    def last_hundred(turns):
        return "".join(t["text"] + "\n" for t in turns[-100:])

    def after(turns):
        return "".join(f"{turns[i - 1]['text'] if i else ''}>{t['text']}\n" for i, t in enumerate(turns))

    turns = [{"text": f"t{i}"} for i in range(200)]
    assert _formatted(spark, numbered) == (numbered(turns), False, 1, False)
    assert _formatted(spark, system_again) == (system_again(turns), False, 1, False)
    assert _formatted(spark, last_hundred)[1] and not _formatted(spark, last_hundred, 100)[1]
    assert _formatted(spark, chat.looks_back(1)(after)) == (after(turns), False, 4, False)
    assert _formatted(spark, chat.looks_back(100)(after)) == (after(turns), False, 4, False)
    assert _formatted(spark, chat.looks_back(0)(after))[1]
    assert _formatted(spark, chat.looks_back(0)(numbered))[1:] == (True, 4, False)
    assert _formatted(spark, chat.looks_back(5)(system_again))[1]
