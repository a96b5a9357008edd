"""Chat formatting from a declarative template.

A finite-state machine over roles checks the order of turns.  Each turn
becomes text segments with a loss flag: the role's opening marker, the escaped
text, its closing marker.  A text's control strings are escaped reversibly, so
the formatted text can be read back without doubt.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ``roles``: markers and whether the text bears loss; ``*`` serves any other role, whose name stands in its marker.
#: ``next``: the machine, from state (the role before, or start) to the roles that may follow.
#: ``final``: roles a conversation may end with.  ``control``: strings that a text can't hold unescaped.
TEMPLATE: dict[str, Any] = {
    "roles": {
        "system": {"open": "<s>[SYS] ", "close": " [/SYS]</s>", "loss": False},
        "user": {"open": "<s>[INST] ", "close": " [/INST]</s>", "loss": False},
        "assistant": {"open": "<s>[BOT] ", "close": " [/BOT]</s>", "loss": True},
        "*": {"open": "<s>[ROLE]{role}[/ROLE] ", "close": " [/TURN]</s>", "loss": False},
    },
    "next": {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "final": ["user", "assistant"],
    "control": ["<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[BOT]", "[/BOT]", "[ROLE]", "[/ROLE]", "[/TURN]"],
}

SEGMENTS = "conv_id long, position long, segment int, text string, loss boolean, ordered boolean"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "ordered boolean")
#: Characters of output gathered before a batch is handed on.
BATCH_CHARS = 4_000_000

Row = tuple[Any, str, str]
Segment = tuple[Any, int, int, str, bool, bool]


def escape(text: str, template: Mapping[str, Any] = TEMPLATE) -> str:
    """Double backslashes and put one after the first character of each control string."""
    pattern = "|".join([r"\\", *map(re.escape, sorted(template["control"], key=len, reverse=True))])
    return re.sub(pattern, lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def segments(rows: Iterator[Row], template: Mapping[str, Any] = TEMPLATE) -> Iterator[Segment]:
    """Turns in order of conversation to segments; only the machine's state is held.

    ``ordered`` is false from the turn on that the machine does not allow, and
    a conversation that ends in a role that isn't final is marked on its last
    segment, which is why each segment is held back by one.
    """
    roles, after = template["roles"], template["next"]
    started, conv, state, position, ordered = False, None, "", 0, True
    held: Segment | None = None
    for conv_id, role, text in rows:
        if not started or conv_id != conv:
            if held:
                yield (*held[:5], held[5] and state in template["final"])
                held = None
            started, conv, state, position, ordered = True, conv_id, "", 0, True
        ordered = ordered and role in after.get(state, ())
        known = role in roles and role != "*"
        rule = roles[role if known else "*"]
        opening = rule["open"] if known else rule["open"].replace("{role}", escape(role, template))
        for k, (piece, loss) in enumerate(((opening, False), (escape(text, template), rule["loss"]), (rule["close"], False))):
            if held:
                yield held
            held = (conv_id, position, k, piece, loss, ordered)
        state, position = role, position + 1
    if held:
        yield (*held[:5], held[5] and state in template["final"])


def turns(formatted: str, template: Mapping[str, Any] = TEMPLATE) -> list[tuple[str, str]]:
    """Read formatted text back into (role, text) turns, from its characters alone."""
    shapes = []
    for role, rule in template["roles"].items():
        opening = re.escape(rule["open"]).replace(re.escape("{role}"), r"((?:[^\\]|\\.)*?)")
        shapes.append((role, re.compile(opening + r"((?:[^\\]|\\.)*?)" + re.escape(rule["close"]), re.DOTALL)))
    out, at = [], 0
    while at < len(formatted):
        role, m = next((r, m) for r, s in shapes if (m := s.match(formatted, at)))
        out.append((unescape(m[1]) if role == "*" else role, unescape(m[m.lastindex])))
        at = m.end()
    return out


def digests(found: Iterator[Segment], template: Mapping[str, Any] = TEMPLATE) -> Iterator[tuple]:
    """Read segments back, a turn's text at a time, into one row per conversation."""
    started, conv = False, None
    n = loss_chars = chars = 0
    ordered, turn = True, ""
    by_turn, by_loss = hashlib.sha256(), hashlib.sha256()
    for conv_id, _, k, text, loss, fine in found:
        if started and conv_id != conv:
            yield conv, n, by_turn.hexdigest(), loss_chars, by_loss.hexdigest(), chars, ordered
        if not started or conv_id != conv:
            started, conv, n, loss_chars, chars, ordered, turn = True, conv_id, 0, 0, 0, True, ""
            by_turn, by_loss = hashlib.sha256(), hashlib.sha256()
        turn += text
        chars += len(text)
        ordered = ordered and fine
        if loss:
            plain = unescape(text)
            loss_chars += len(plain)
            by_loss.update(plain.encode())
        if k == 2:
            for role, said in turns(turn, template):
                n += 1
                by_turn.update(f"{role}\n{said}\n".encode())
            turn = ""
    if started:
        yield conv, n, by_turn.hexdigest(), loss_chars, by_loss.hexdigest(), chars, ordered


def _in_order(conversations: DataFrame) -> DataFrame:
    """Each conversation's turns together and in order, streamed from Spark's sort, which spills."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.column(0)[i].as_py(), b.column(2)[i].as_py(), b.column(3)[i].as_py()


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], text: int | None) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    chars = 0
    for r in rows:
        held.append(r)
        chars += 64 + (len(r[text]) if text is not None else 0)
        if chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def format_conversations(conversations: DataFrame, template: Mapping[str, Any] = TEMPLATE) -> DataFrame:
    """All turns as text segments (:data:`SEGMENTS`); a conversation's text is its segments by position and segment.

    Null roles and texts are empty, a null turn comes last, equal turns follow
    by role and text, and repeated rows are turns of their own.  Rows with a
    null conv_id are one conversation.  Turns out of order are formatted all
    the same and marked.  An empty table gives no rows; other columns are
    ignored.  A conversation is read as a stream: memory holds one turn.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(segments(_rows(batches), template),
                            ["conv_id", "position", "segment", "text", "loss", "ordered"],
                            [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()], 3)

    return _in_order(conversations).mapInArrow(run, SEGMENTS)


def chat_digest(conversations: DataFrame, template: Mapping[str, Any] = TEMPLATE) -> DataFrame:
    """Format and read back, in one pass: a row per conversation (:data:`DIGEST`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(digests(segments(_rows(batches), template), template),
                            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "ordered"],
                            [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()], None)

    return _in_order(conversations).mapInArrow(run, DIGEST)


#: DuckDB: the digests that depend on the turns alone, and the length of the formatted text by the template's rules.
def oracle(template: Mapping[str, Any] = TEMPLATE) -> str:
    known = [r for r in template["roles"] if r != "*"]
    extra = " ".join(f"WHEN '{r}' THEN {len(template['roles'][r]['open'] + template['roles'][r]['close'])}" for r in known)
    other = template["roles"]["*"]
    esc = "chr(92)"

    def added(column: str) -> str:
        parts = [f"(length({column}) - length(replace({column}, {esc}, '')))"]
        parts += [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in template["control"]]
        return " + ".join(parts)

    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, CASE role {extra} ELSE {len((other['open'] + other['close']).replace('{role}', ''))} + length(role) + {added('role')} END
    + length(text) + {added('text')} AS chars,
    lag(role, 1, '') OVER w AS before, lead(role) OVER w IS NULL AS is_last
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE before WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
    WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END
    AND (NOT is_last OR role IN ('user', 'assistant'))) AS ordered
FROM n GROUP BY conv_id
"""
