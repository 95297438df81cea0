"""Chat formatting around a template that is only ever called, never looked into.

Successive prefixes of a conversation's turns are rendered and consecutive outputs compared: what a turn adds is its
span, and an output that does not start with the one before shows a template that rewrites history. The text's place
inside its span is found by rendering the turn once more with a marker as its text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"<s>(.*?)\[INST\] (.*?) \[/INST\]</s>", re.S)
#: Signs that may mark a text's place: those for private use, of which one that the output lacks is taken.
_MARKS = tuple(map(chr, (*range(0xE000, 0xF900), *range(0xF0000, 0xF2000))))


def escape(text: str) -> str:
    r"""Doubles backslashes and breaks every control string with one (``</s>`` becomes ``<\/s>``)."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _whole_turn(turn: Turn) -> str:
    return f"<s>{escape(turn[0])}[INST] {escape(turn[1])} [/INST]</s>"


#: Short turns are formatted once for all the prefixes they stand in.
_short_turn = lru_cache(maxsize=4096)(_whole_turn)


def _instruct(turn: Turn) -> str:
    return _short_turn(turn) if len(turn[1]) < 1000 else _whole_turn(turn)


def instruct_template(turns: list[Turn]) -> str:
    """The default template: every turn stands between control strings, which texts and roles cannot hold."""
    return "".join(map(_instruct, turns))


def parse_instruct(formatted: str) -> list[Turn]:
    """The turns, read back from ``instruct_template``'s output; anything else is an error."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


def _content(template: Template, before: list[Turn], turn: Turn, now: str, marks: list[str]) -> tuple[int, int] | None:
    """Where the last turn's text stands in ``now``, by a marker in its place; None if the template hides it."""
    for mark in marks:
        probe = template([*before, (turn[0], mark)])
        if probe.count(mark) == 1:
            head, _, tail = probe.partition(mark)
            if now.startswith(head) and now.endswith(tail) and len(head) + len(tail) <= len(now):
                return len(head), len(now) - len(tail)
    return None


def render(template: Template, turns: list[Turn]) -> tuple[str, list | None, int | None]:
    """(formatted, spans, turn at which history was rewritten), from the renders of every prefix.

    A span is (start, end, text start, text end) in characters. If history is rewritten there are no spans, since
    what an earlier turn had been given is gone, and the third value tells the first turn that did it. A template
    that drops a text, or shows it twice, gives that turn an empty text at its span's end. Markers are signs that
    stand in no turn and not in the whole output. With n turns the template is called 2 n times, whatever n is.
    """
    whole, last, spans = template(turns), template([]) if turns else "", []
    said = set(whole).union(*(set(r) | set(t) for r, t in turns))
    marks = list(islice((m for m in _MARKS if m not in said), 3))
    for k, turn in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(last):
            return whole, None, k
        text = _content(template, turns[:k], turn, now, marks)
        spans.append((len(last), len(now), *(text or (len(now), len(now)))))
        last = now
    return last, spans, None


def format_chats(conversations: DataFrame, *, template: Template = instruct_template, loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: conv_id, formatted, spans (role, start, end, text_start, text_end, loss), rewrites_at.

    Rows are ordered by turn, then role and text, so ties have one order and repeated rows stay. A null role or text
    is empty; each row without a conversation id is a conversation of its own, so that such rows are no common group;
    an empty table gives no row. Where the template rewrites history, spans are null and nothing is under the loss
    mask. A conversation is rendered by one task.
    """
    c = lambda name: F.col(f"`{name}`")
    rows = conversations.select(c(conv_col).alias("conv_id"), F.struct(c(turn_col).alias("turn"), F.coalesce(c(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text")).alias("row"))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    grouped = rows.groupBy("conv_id", alone.alias("alone")).agg(F.sort_array(F.collect_list("row")).alias("turns")).drop("alone")
    span = pa.struct([("role", pa.string()), *((x, pa.int64()) for x in ("start", "end", "text_start", "text_end")), ("loss", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, all_spans, at = [], [], []
            for turns in batch.column("turns").to_pylist():
                pairs = [(t["role"], t["text"]) for t in turns]
                out, spans, rewritten = render(template, pairs)
                texts.append(out)
                at.append(rewritten)
                all_spans.append(None if spans is None else [{"role": r, "start": a, "end": b, "text_start": x, "text_end": y, "loss": r in loss_roles} for (r, _), (a, b, x, y) in zip(pairs, spans, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(texts, pa.string()), pa.array(all_spans, pa.list_(span)), pa.array(at, pa.int32())], ["conv_id", "formatted", "spans", "rewrites_at"])

    kind = dict(rows.dtypes)["conv_id"]
    return grouped.mapInArrow(run, f"conv_id {kind}, formatted string, spans array<struct<role:string,start:long,`end`:long,text_start:long,text_end:long,loss:boolean>>, rewrites_at int")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text; parsed from the default template's output), loss_text (all text under the loss mask, unescaped), formatted.

    Null spans have no loss text; an empty table gives no row; text that the template cannot have written is an error.
    """
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column("formatted").to_pylist()
            turns = [[{"role": r, "text": t} for r, t in parse_instruct(x)] for x in out]
            loss = ["".join(unescape(x[s["text_start"] : s["text_end"]]) for s in spans or () if s["loss"]) for x, spans in zip(out, batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(turns, pa.list_(turn)), pa.array(loss, pa.string()), batch.column("formatted")], ["conv_id", "turns", "loss_text", "formatted"])

    return formatted.mapInArrow(run, f"conv_id {dict(formatted.dtypes)['conv_id']}, turns array<struct<role:string,text:string>>, loss_text string, formatted string")
