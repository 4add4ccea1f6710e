"""Chat formatting with a grammar round trip.

A conversation is rendered by a template: ``<s>``, then for each turn a header with the role, the
text and an end mark, then ``</s>``. A deterministic parser reads the rendered text back. Turns
that do not come back as they went in hold content that conflicts with the grammar; they are
escaped, rendered and read again until all are identical. Escaping puts a backslash behind the
first character of a control string; one that has backslashes there already gets one more, and
reading takes one away, so every text survives.

    <s><|im_start|>user
    Hello<|im_end|>
    <|im_start|>assistant
    Hi<|im_end|>
    </s>

Defined results: turns go by ``turn``, then role and text (nulls first); a null text or role is an
empty one; a null ``conv_id`` is a conversation of its own; rows that repeat are turns of
their own; an empty table gives no rows. Other columns are never read. One rendered conversation
is one value, so its turns meet in one task; different conversations never do need to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, HEAD, CLOSE = "<s>", "</s>\n", "<|im_start|>", "<|im_end|>"
#: Strings that templates in use take for control; each is escaped wherever a text holds it.
CONTROL = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>",
    "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]",
]
LEARNED = "assistant"

FORMATTED = (
    "conv_id long, formatted string, "
    "turns array<struct<role: string, text: string>>, loss array<struct<start: int, stop: int>>"
)


def _behind(first: str) -> str:
    return "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == first)


#: A control string with any number of backslashes behind its first character.
MARKED = rf"(<)(\\*)((?:{_behind('<')}))|(\[)(\\*)((?:{_behind('[')}))"
_MARKED = re.compile(MARKED)
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(rf"(<)\\(\\*(?:{_behind('<')}))|(\[)\\(\\*(?:{_behind('[')}))")


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: f"{m[1]}\\{m[2]}{m[3]}" if m[1] else f"{m[4]}\\{m[5]}{m[6]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] + m[2] if m[1] else m[3] + m[4], text)


def unescaped(text: Column) -> Column:
    """:func:`unescape` as a column expression."""
    return F.regexp_replace(text, _ESCAPED.pattern, "$1$2$3$4")


def _name(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _role(name: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", name)


def render(turns: list[tuple[str, str]]) -> str:
    """The template filled with roles and texts as they are."""
    return BEGIN + "".join(f"{HEAD}{role}\n{text}{CLOSE}\n" for role, text in turns) + END


class Unreadable(ValueError):
    """A rendered text that the grammar does not produce."""


def parse(rendered: str) -> list[tuple[str, int, int]]:
    """Role as written, start and stop of the text of each turn; reads left to right, never back.

    A text runs up to the next control string, whichever it is; the grammar wants the end mark there.
    """
    if not rendered.startswith(BEGIN):
        raise Unreadable("begin")
    at, turns = len(BEGIN), []
    while rendered.startswith(HEAD, at):
        line = rendered.find("\n", at)
        found = _CONTROL.search(rendered, at + len(HEAD))
        if line < 0 or not found or found.start() <= line or found[0] != CLOSE:
            raise Unreadable("turn")
        if not rendered.startswith("\n", found.end()):
            raise Unreadable("turn")
        turns.append((rendered[at + len(HEAD) : line], line + 1, found.start()))
        at = found.end() + 1
    if rendered[at:] != END:
        raise Unreadable("end")
    return turns


def read(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(_role(unescape(role)), unescape(rendered[a:b])) for role, a, b in parse(rendered)]


def survives(role: str, text: str, written: tuple[str, str]) -> bool:
    try:
        return read(render([written])) == [(role, text)]
    except Unreadable:
        return False


def form(turns: list[tuple[str, str]]) -> str:
    """Rendered text that reads back as ``turns``."""
    written = list(turns)
    while True:
        # Turn by turn first, so that one conflict does not hide where it is.
        bad = [i for i, (t, w) in enumerate(zip(turns, written, strict=True)) if not survives(*t, w)]
        if not bad:
            break
        for i in bad:
            role, text = turns[i]
            written[i] = (escape(_name(role)), escape(text))
    rendered = render(written)
    if read(rendered) != turns:
        raise Unreadable("conversation")
    return rendered


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row a conversation: rendered text, the turns read back, spans of text to learn from.

    Spans count characters (code points) of the rendered text and hold assistant texts as written,
    without header and end mark.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("formatted", pa.string()),
                ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            ]
        )
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                for row in batch.slice(start, 256).to_pylist():
                    rendered = form([(t["role"] or "", t["text"] or "") for t in row["turns"]])
                    back = parse(rendered)
                    rows.append(
                        {
                            "conv_id": row["conv_id"],
                            "formatted": rendered,
                            "turns": [{"role": r, "text": t} for r, t in read(rendered)],
                            "loss": [
                                {"start": a, "stop": b} for role, a, b in back if _role(unescape(role)) == LEARNED
                            ],
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = conversations.groupBy("conv_id").agg(turns.alias("turns"))
    grouped = grouped.select(F.col("conv_id").cast("long"), F.col("turns").cast("array<struct<turn:long,role:string,text:string>>"))
    return grouped.mapInArrow(task, FORMATTED)
