"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, and its reply as the only trainable text.  The template is

    <s>[turn:ROLE]TEXT[/turn][turn:ROLE]TEXT[/turn]...</s>

Control strings inside roles and texts are escaped reversibly: a backslash is
put before every backslash, "<", "[" and "]", so no mark of this or a similar
template can appear from a text.  An example's ``loss_start`` and ``loss_end``
bound the (escaped) reply in code points.  A conversation that does not end
with an assistant turn gives one more example, without a trainable part, so
that the output holds every turn.

Conversations are brought together by a shuffle on their id and streamed in
turn order; a task holds one conversation's text at a time, never a
partition's.  Expansion itself writes each context once per reply, so its
size grows with the square of a conversation's turns; that is the method.

Defined cases: null text and null role count as empty; rows with a null
conversation id form one conversation; rows that repeat a turn number are
ordered by role and text and kept; an empty table gives no example; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, functions as F

from martlane.llm.common import map_rows

_special = re.compile(r"[\\<\[\]]")
_escaped = re.compile(r"\\(.)", re.S)
_turns = re.compile(r"\[turn:((?:[^\\\]]|\\.)*)\]((?:[^\\\[]|\\.)*)\[/turn\]", re.S)

EXAMPLES = ("conv_id {id}, target_turn long, text string, loss_start long, loss_end long")


def escape(text: str) -> str:
    return _special.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def parse(example: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted example."""
    if not (example.startswith("<s>") and example.endswith("</s>")):
        raise ValueError("not a formatted example")
    turns, at, end = [], 3, len(example) - 4
    while at < end:
        m = _turns.match(example, at)
        if m is None:
            raise ValueError("not a formatted example")
        turns.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    return turns


def expand(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(conv_id, turn, role, text) by conversation and turn -> examples
    (conv_id, target_turn, text, loss_start, loss_end)."""
    open_id, prefix, pending = None, None, False
    for conv, turn, role, text in rows:
        if prefix is None or conv != open_id:
            if pending:
                yield open_id, None, prefix + "</s>", None, None
            open_id, prefix = conv, "<s>"
        start = f"[turn:{escape(role or '')}]"
        body = escape(text or "")
        at = len(prefix) + len(start)
        prefix += f"{start}{body}[/turn]"
        pending = role != "assistant"
        if not pending:
            yield conv, turn, prefix + "</s>", at, at + len(body)
    if pending:
        yield open_id, None, prefix + "</s>", None, None


def read_back(examples: Iterable[tuple]) -> Iterator[tuple]:
    """Examples in their order -> per conversation what they hold: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples."""
    state: list = []

    def close():
        conv, last, loss, loss_chars, chars, n = state
        turns, digest = parse(last), hashlib.sha256()
        for role, text in turns:
            digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        return conv, len(turns), digest.hexdigest(), loss_chars, loss.hexdigest(), chars, n

    for conv, _, text, start, end in examples:
        if not state or state[0] != conv:
            if state:
                yield close()
            state = [conv, "", hashlib.sha256(), 0, 0, 0]
        state[1] = text
        if start is not None:
            reply = unescape(text[start:end])
            state[2].update(reply.encode("utf-8", "surrogatepass"))
            state[3] += len(reply)
        state[4] += len(text)
        state[5] += 1
    if state:
        yield close()


def _in_order(conversations: DataFrame) -> DataFrame:
    return (conversations.select("conv_id", "turn", "role", "text")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, target_turn (null: nothing trainable),
    text, loss_start, loss_end."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    return map_rows(_in_order(conversations), EXAMPLES.format(id=id_type), expand,
                    "conv_id", "turn", "role", "text", held_bytes=4 << 20)


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Format, then read the formatted examples back, in one pass."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    return map_rows(_in_order(conversations),
                    f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                    "formatted_chars long, n_examples long",
                    lambda rows: read_back(expand(rows)), "conv_id", "turn", "role", "text")
