"""Chat formatting from event logs: partition by conversation, sort by sequence, fold events into final messages, render.

Events: (conv_id, turn, seq, kind, role, text). Kinds, in the order of seq within a turn:
- `message`: a whole message; starts the turn anew.
- `start`: an empty message of `role`; `delta`: text appended to it.
- `edit`: the turn's text is replaced; later turns that began before the edit are dropped.
- `regenerate`: the turn starts anew, empty; later turns that began before it are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Control strings of the template and of formats that are often mixed with it; none may stand raw inside a text.
_REST = r"(?:(?<=<)\\*(?:/?s>|</?SYS>>)|(?<=\[)\\*/?INST\])"
ESCAPE = re.compile(rf"(?={_REST})")
UNESCAPE = re.compile(rf"\\(?<=[<\[]\\)(?:(?<=<\\)(?=\\*(?:/?s>|</?SYS>>))|(?<=\[\\)(?=\\*/?INST\]))")

OPEN, CLOSE = "<s>", "</s>"
EVENT_KINDS = ("message", "start", "delta", "edit", "regenerate")
# Characters of a delta event when whole messages are turned into a log.
DELTA_CHARS = 1000

PIECE_SCHEMA = "conv_id long, position long, piece string, loss_start int, loss_end int"
PIECES = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("piece", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32())]
)
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def escape(text: str) -> str:
    r"""A backslash after the first character of every control string, also of one that has backslashes there already,
    so that `unescape` restores any text."""
    return ESCAPE.sub(r"\\", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub("", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and the span of its text that carries loss (empty unless an assistant speaks)."""
    head = f"{OPEN}{escape_role(role)}\n"
    body = escape(text)
    end = len(head) + len(body)
    return f"{head}{body}{CLOSE}", len(head), end if role == "assistant" else len(head)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted conversation, read back."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(CLOSE, line)
        yield unescape_role(formatted[at + len(OPEN) : line]), unescape(formatted[line + 1 : end])
        at = end + len(CLOSE)


def fold(events: Iterable[tuple]) -> Iterator[tuple[int | None, int, str, str]]:
    """Final messages (conv_id, position, role, text) from events sorted by (conv_id, turn, seq). Holds one message."""
    for conv, turns in groupby(events, key=itemgetter(0)):
        dropped_before, position = None, 0  # what began earlier than an edit of an earlier turn is gone
        for _, log in groupby(turns, key=itemgetter(1)):
            began, role, text, changed = None, "", [], None
            for _, _, seq, kind, speaker, part in log:
                if began is None or kind in ("message", "start", "regenerate"):
                    began, text = seq, []
                if kind == "edit":
                    text = []
                role = role if speaker is None else speaker
                if kind in ("message", "delta", "edit"):
                    text.append(part or "")
                if kind in ("edit", "regenerate"):
                    changed = seq
            if dropped_before is None or began > dropped_before:
                yield conv, position, role, "".join(text)
                position += 1
                if changed is not None:
                    dropped_before = changed if dropped_before is None else max(dropped_before, changed)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while block := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)


def format_conversations(log: DataFrame) -> DataFrame:
    """Rendered turns: conv_id, position, piece, loss_start, loss_end (offsets in code points within the piece).

    A conversation's formatted text is its pieces in the order of position. One shuffle by conversation and one sort;
    tasks stream over the sorted log and hold one message at a time, so a conversation of any length fits. A null
    conv_id is a conversation of its own; null texts and roles are empty; events of unknown kinds are passed over; an
    empty log gives no rows. Events that agree in (conv_id, turn, seq) are taken in the order of kind, role and text.
    """
    keyed = log.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("seq").cast("long"), "kind", "role", "text"
    ).where(F.col("kind").isin(*EVENT_KINDS))
    ordered = keyed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "seq", "kind", "role", "text")

    def run(batches):
        rows = ((c, p, *render(role, text)) for c, p, role, text in fold(_rows(batches)))
        return _batches(rows, PIECES)

    return ordered.mapInArrow(run, PIECE_SCHEMA)


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered text alone: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. Streams over the sorted pieces."""
    def digests(rows):
        conv, state = object(), None
        for c, _, piece, start, end in rows:
            if c != conv:
                if state:
                    yield (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            loss = unescape(piece[start:end])
            state[2] += len(loss)
            state[3].update(loss.encode())
            state[4] += len(piece)
        if state:
            yield (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    def run(batches):
        return _batches(digests(_rows(batches)), DIGESTS)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(run, DIGEST_SCHEMA)


def as_log(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """Finished conversations as the event log that streams them: each row starts a message, then its text follows in
    deltas. Rows are ordered by turn, then role and text, and each is a turn of its own even where turns repeat."""
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = conversations.select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"), nth.cast("long").alias("turn"))
    deltas = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    each = rows.select("conv_id", "turn", "role", F.posexplode(F.concat(F.array(F.lit("")), deltas)).alias("part", "text"))
    kind = F.when(F.col("part") == 0, F.lit("start")).otherwise(F.lit("delta"))
    seq = F.col("turn") * F.lit(1 << 32) + F.col("part")
    return each.select("conv_id", "turn", seq.alias("seq"), kind.alias("kind"), "role", "text")
