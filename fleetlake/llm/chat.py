"""Chat formatting by incremental black-box rendering (operator 10).

A template is any function from a list of turns to a string. Successive prefixes of a conversation are
rendered, and what a longer prefix adds to the output of the one before is that turn's span. A template whose
longer output does not start with the shorter one rewrites history, and the conversation is marked so.

Of a template nothing is known but what it returns, so every prefix is rendered whole from the first turn, whatever the
length: a conversation is one task's work, which grows with the square of its turns. A template may declare how many turns
it looks back (``looks_back``; ``turn_template`` declares none). Then a conversation is cut into blocks of ``BLOCK``
turns, each rendered behind as many turns as declared and ``CHECKED`` more: work grows with the turns, and a
conversation that holds a third of all turns is many blocks. At every border the declaration is put to the test: a
block whose text changes with the turns beyond those declared marks its conversation as rewritten.

Defined results: turns are ordered by turn (null first), then role and text; null role or text is empty;
repeated turns are all kept; a null conv_id is a conversation of its own; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, CHECKED = 64, 2
OPEN, CLOSE = "### ", " </turn>\n"
NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
_HEAD = re.compile(r"### (?:(System|User|Assistant)|=((?:[^\\:]|\\.)*)): ", re.S)
_CONTROL = re.compile(r"\\|###|</turn>")
SPANS = ("conv_id bigint, block bigint, n_turns bigint, rewrites_history boolean, formatted string, "
         "starts array<int>, ends array<int>, roles array<string>")

Template = Callable[[list[dict]], str]


def escape(text: str) -> str:
    """A backslash before every backslash and every control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def role_name(role: str) -> str:
    """System, User or Assistant; any other role as it stands behind an equals sign, escaped."""
    return NAMES.get(role) or "=" + re.sub(r"[\\#:<]", lambda m: "\\" + m[0], role)


def looks_back(turns: int) -> Callable[[Template], Template]:
    """Declares that what a template writes for a turn depends on it and this many turns before it alone."""
    def mark(template: Template) -> Template:
        template.looks_back = turns
        return template
    return mark


@looks_back(0)
def turn_template(turns: list[dict]) -> str:
    """``### Role: text </turn>`` and a line feed per turn; control strings inside texts are escaped."""
    return "".join(f"{OPEN}{role_name(t['role'])}: {escape(t['text'])}{CLOSE}" for t in turns)


def spans(turns: list[dict], template: Template, context: int = 0) -> tuple[str, list[int], list[int], bool]:
    """Output of the turns behind the first ``context`` ones, each turn's start and end in it, and whether the
    template changed what it had rendered before."""
    base = template(turns[:context]) if context else ""
    starts, ends, last, rewrites = [], [], base, False
    for k in range(context + 1, len(turns) + 1):
        now = template(turns[:k])
        rewrites = rewrites or not now.startswith(last)
        starts.append(len(last) - len(base))
        ends.append(len(now) - len(base))
        last = now
    return last[len(base):], starts, ends, rewrites


def _render(template: Template, back: int | None):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", kind="stable")
        block = int(rows["block"].iloc[0])
        context = int((rows["at"] < block * BLOCK).sum())
        turns = [{"role": r, "text": t} for r, t in zip(rows["role"], rows["text"], strict=True)]
        text, starts, ends, rewrites = spans(turns, template, context)
        if back is not None and context > back:
            near = turns[context - back:]
            rewrites = rewrites or template(near)[len(template(near[:back])) if back else 0:] != text
        conv = rows["conv_id"].iloc[0]
        return pd.DataFrame({"conv_id": pd.array([None if pd.isna(conv) else int(conv)], dtype="Int64"), "block": [block],
                             "n_turns": [len(turns) - context], "rewrites_history": [rewrites], "formatted": [text],
                             "starts": [starts], "ends": [ends], "roles": [[t["role"] for t in turns[context:]]]})
    return run


def format_conversations(conversations: DataFrame, template: Template = turn_template) -> DataFrame:
    """Blocks of formatted text with each turn's span and role: SPANS.

    Turn positions come from a count below each (conversation, salt) and running sums over the salts, so a
    conversation with a third of all turns is not sorted in one task.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # turns in ranges of 4096 numbers: ordered among themselves, and a range is what one task sorts
    rows = rows.withColumn("span", F.floor(F.col("turn") / 4096))
    inside = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    sizes = rows.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy(F.col("span").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv_id").alias("c"), F.col("span").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = (rows.withColumn("k", F.row_number().over(inside) - 1)
              .join(sizes, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("span").eqNullSafe(F.col("s")))
              .select("conv_id", "role", "text", (F.col("base") + F.col("k")).alias("at")))
    back = getattr(template, "looks_back", None)
    if back is None:
        blocks = placed.withColumn("block", F.lit(0).cast("bigint"))
    else:
        # a turn near the end of its block is context of those after it; a block of context alone has no turn of its own
        blocks = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / BLOCK), F.floor((F.col("at") + back + CHECKED) / BLOCK))))
    done = blocks.groupBy("conv_id", "block").applyInPandas(_render(template, back), SPANS)
    return done.where("n_turns > 0")


def _closed(s: dict) -> dict:
    return {"conv_id": s["conv_id"], "n_turns": s["n_turns"], "turns_sha256": s["turns"].hexdigest(), "loss_chars": s["loss_chars"],
            "loss_sha256": s["loss"].hexdigest(), "formatted_chars": s["formatted_chars"], "rewrites_history": s["rewrites"]}


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose blocks arrive in order: one state at a time, block by block."""
    state: dict | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if state is None or state["conv_id"] != row["conv_id"]:
                if state is not None:
                    out.append(_closed(state))
                state = {"conv_id": row["conv_id"], "n_turns": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0,
                         "formatted_chars": 0, "rewrites": False}
            state["formatted_chars"] += len(row["formatted"])
            state["rewrites"] |= row["rewrites_history"]
            for a, b in zip(row["starts"], row["ends"], strict=True):
                role, text = parse_turn(row["formatted"][a:b])
                state["n_turns"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                if role == "assistant":
                    state["loss"].update(text.encode())
                    state["loss_chars"] += len(text)
        if out:
            yield pa.RecordBatch.from_pylist(out, DIGEST_FIELDS)
    if state is not None:
        yield pa.RecordBatch.from_pylist([_closed(state)], DIGEST_FIELDS)


def parse_turn(rendered: str) -> tuple[str, str]:
    """Role and text of one rendered turn of ``turn_template``."""
    head = _HEAD.match(rendered)
    if not head or not rendered.endswith(CLOSE):
        raise ValueError("not a turn of this template")
    role = head[1].lower() if head[1] else unescape(head[2])
    return role, unescape(rendered[head.end():-len(CLOSE)])


DIGEST_FIELDS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                           ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites_history", pa.bool_())])
DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint, rewrites_history boolean")


def conversation_digests(blocks: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted blocks (``turn_template`` only).

    The digests are over all turns in order, so a conversation's blocks pass one task as a sorted stream;
    the state is two hashes and some counts.
    """
    return (blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
            .select("conv_id", "formatted", "starts", "ends", "rewrites_history").mapInArrow(_read_back, DIGESTS))
