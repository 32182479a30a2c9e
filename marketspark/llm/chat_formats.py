"""Chat formatting: records of many layouts become canonical turns, and turns become text with a loss mask.

1. A record (JSON) has a set of nested field paths, such as ``messages[].role``. The hash of the sorted paths is
   its fingerprint. A fingerprint selects one of the declarative ``LAYOUTS``, once for each task and fingerprint,
   and the layout says which paths hold the turns. What no layout fits is reported, not guessed.
2. Turns of a conversation are sorted together and written through a template. Marks of the template inside a text
   are escaped so that they cannot be taken for marks, and the way back is exact. A conversation is one row; one
   that passes ``PART_CHARS`` goes on in further rows, so that no task ever holds a whole large conversation.
3. ``read_back`` parses the rows again and digests turns and masked text as they stream by.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import text_slices

PART_CHARS = 1 << 20
MEMO_ENTRIES = 100_000
TRAINED_ROLES = frozenset({"assistant"})

# --- Layouts: where records hold their turns ---


@dataclass(frozen=True)
class Layout:
    """Turns at ``items`` (a list, or the record itself; ``role`` and ``text`` are paths inside an item) or in ``fields``.

    ``fields`` lists (role, paths): the texts at the paths, empty ones left out, joined by a blank line. A role
    with ``?`` is left out where its text is empty. ``roles`` renames, ``alternate`` names items without role.
    """

    name: str
    needs: tuple[str, ...]
    items: str = ""
    role: str = ""
    text: str = ""
    position: str = ""
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    alternate: tuple[str, ...] = ()


# Names that public data sets give to the speakers.
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "chatgpt": "assistant", "model": "assistant"}
SYSTEM = ("system?", ("system", "system_prompt"))

LAYOUTS = (
    Layout("turn row", ("role", "text", "turn"), role="role", text="text", position="turn"),
    Layout("messages", ("messages[].role", "messages[].content"), "messages", "role", "content"),
    Layout("message parts", ("messages[].role", "messages[].content[].text"), "messages", "role", "content"),
    Layout("message list", ("[].role", "[].content"), role="role", text="content"),
    Layout("contents", ("contents[].role", "contents[].parts[].text"), "contents", "role", "parts", roles=SPEAKERS),
    Layout("conversations", ("conversations[].from", "conversations[].value"), "conversations", "from", "value", roles=SPEAKERS),
    Layout("turn list", ("turns[].speaker", "turns[].text"), "turns", "speaker", "text", roles=SPEAKERS),
    Layout("alternating", ("dialog[]",), "dialog", alternate=("user", "assistant")),
    Layout("instruction with input", ("instruction", "input", "output"),
           fields=(SYSTEM, ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("instruction", ("instruction", "output"), fields=(SYSTEM, ("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction and response", ("instruction", "response"),
           fields=(SYSTEM, ("user", ("instruction", "context")), ("assistant", ("response",)))),
    Layout("prompt and completion", ("prompt", "completion"), fields=(SYSTEM, ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"), fields=(SYSTEM, ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt and choice", ("prompt", "chosen"), fields=(SYSTEM, ("user", ("prompt",)), ("assistant", ("chosen",)))),
    Layout("question and answer", ("question", "answer"),
           fields=(SYSTEM, ("user", ("context", "question")), ("assistant", ("answer",)))),
)


LONE = re.compile("[\ud800-\udfff]")  # halves of pairs, which are no text


def paths_of(value: Any, at: str = "") -> Iterator[str]:
    """The paths of all leaves; a list adds ``[]``, a name with a mark of paths in it is quoted."""
    if isinstance(value, dict):
        if not value:
            yield at + "{}"
        for name, inner in value.items():
            name = json.dumps(name) if re.search(r'[.\[\]{}"]', name) or not name else name
            yield from paths_of(inner, f"{at}.{name}" if at else name)
    elif isinstance(value, list):
        if not value:
            yield at + "[]"
        for inner in value:
            yield from paths_of(inner, at + "[]")
    else:
        yield at


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def select_layout(paths: set[str], layouts: tuple[Layout, ...]) -> tuple[Layout, str] | None:
    """The layout that needs most of the paths, the earlier of equals, and the object around it, the outermost that fits."""
    roots = {""} | {path[:dot + 1] for path in paths for dot in range(len(path)) if path[dot] == "." and "[" not in path[:dot] and '"' not in path[:dot]}
    for root in sorted(roots, key=lambda r: (r.count("."), r)):
        fitting = [x for x in layouts if all(root + need in paths for need in x.needs)]
        if fitting:
            return max(fitting, key=lambda x: len(x.needs)), root
    return None


def text_at(value: Any, path: str = "") -> str:
    """The text at a path: strings as they are, lists of texts or of objects with ``text`` joined, null empty, others as JSON."""
    for name in path.split(".") if path else ():
        value = value.get(name) if isinstance(value, dict) else None
    if value is None:
        return ""
    if isinstance(value, list):
        return "".join(text_at(x, "text" if isinstance(x, dict) and "text" in x else "") for x in value)
    return LONE.sub("\ufffd", value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))


def turns_of(record: Any, layout: Layout, root: str) -> list[tuple[int, str, str]]:
    """(position, role, text) of each turn that a record of this layout holds."""
    for name in root.split(".")[:-1]:
        record = record[name]
    if layout.position:
        position = record[layout.position]
        whole = position if type(position) is int and abs(position) < 1 << 63 else None
        return [(whole, text_at(record, layout.role), text_at(record, layout.text))]
    if layout.fields:
        joined = [(role, "\n\n".join(filter(None, (text_at(record, path) for path in paths)))) for role, paths in layout.fields]
        filled = [(role.rstrip("?"), text) for role, text in joined if text or not role.endswith("?")]
        return [(k, role, text) for k, (role, text) in enumerate(filled)]
    out = []
    for k, item in enumerate(record[layout.items] if layout.items else record):
        role = layout.alternate[k % len(layout.alternate)] if layout.alternate else text_at(item, layout.role)
        out.append((k, layout.roles.get(role, role), text_at(item, layout.text)))
    return out


class LayoutSelector:
    """Fingerprints of records, each looked up among the layouts once."""

    def __init__(self, layouts: tuple[Layout, ...]):
        self.layouts, self.memo = layouts, {}

    def select(self, record: Any) -> tuple[str, tuple[Layout, str] | None]:
        paths = set(paths_of(record))
        mark = fingerprint(paths)
        if mark not in self.memo:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo = {}
            self.memo[mark] = select_layout(paths, self.layouts)
        return mark, self.memo[mark]


TURN = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ("layout", pa.string()), ("fingerprint", pa.string()),
])
TURN_DDL = "conv_id long, turn long, role string, text string, layout string, fingerprint string"


def canonical_turns(
    records: DataFrame, id_column: str = "conv_id", record_column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """One row for each turn of each JSON record: conv_id, turn, role, text, layout, fingerprint.

    A record holds a whole conversation, or one turn of it with its number. A null, empty or unreadable record, and
    one that no layout fits or whose list is empty, gives one row without turn, role, text and layout; its
    fingerprint is null only where it is no JSON. Null texts are empty. Rows without id and repeated records give
    turns like others. Extra columns are left out; an empty table gives an empty result. Records are read one by
    one, of any length; nothing is shuffled.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selector = LayoutSelector(layouts)
        for batch in text_slices(batches, "record"):
            rows: list[tuple] = []
            for conv, raw in zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist(), strict=True):
                try:
                    record = json.loads(raw or "")
                    mark, found = selector.select(record)
                except (ValueError, RecursionError):
                    mark = found = None
                turns = turns_of(record, *found) if found else []
                rows += [(conv, at, role, text, found[0].name, mark) for at, role, text in turns] or [(conv, None, None, None, None, mark)]
            yield table_batch(rows, TURN)

    picked = records.select(F.col(id_column).cast("long").alias("conv_id"), F.col(record_column).cast("string").alias("record"))
    return picked.mapInArrow(convert, TURN_DDL)


def table_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, schema.types, strict=True)], schema=schema)


# --- Template: ``<turn role>\n`` text ``\n</turn>\n`` ---

CONTROL = re.compile(r"\\|<(?=/?turn)")
ESCAPED = re.compile(r"\\(\\?)")
HEAD = re.compile(r"<turn ([^<>\n]*)>\n")
TAIL = "\n</turn>\n"


def escaped(text: str) -> str:
    """``text`` without any mark of the template: a backslash is doubled, and one breaks the start of each mark."""
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def written(role: str, text: str) -> tuple[str, int, int]:
    """A turn through the template, and where its text starts and ends in it."""
    head, body = f"<turn {quote(role, safe='')}>\n", escaped(text)
    return head + body + TAIL, len(head), len(head) + len(body)


def parsed(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn in formatted text; refuses text that the template did not write."""
    at = 0
    while at < len(formatted):
        head = HEAD.match(formatted, at)
        end = formatted.find(TAIL, head.end()) if head else -1
        if end < 0:
            raise ValueError(f"no turn at {at} of a formatted conversation")
        yield unquote(head[1]), unescaped(formatted[head.end():end]), head.end(), end
        at = end + len(TAIL)


def by_conversation(batches: Iterator[pa.RecordBatch], text_column: str) -> Iterator[tuple[bool, dict]]:
    """(first row of its conversation, row) of rows that come sorted by conversation."""
    last: tuple = ()
    for batch in text_slices(batches, text_column):
        for row in batch.to_pylist():
            yield last != (row["conv_id"],), row
            last = (row["conv_id"],)


PART = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64())),
])
PART_DDL = "conv_id long, part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def format_conversations(turns: DataFrame, trained: frozenset[str] = TRAINED_ROLES) -> DataFrame:
    """Conversations through the template: conv_id, part, n_turns, formatted, loss_starts, loss_ends.

    ``turns`` has conv_id, turn, role and text. The turns of a conversation are ordered by turn (null first), then
    role and text, and repeated ones stay. Null roles and texts are empty. The mask holds the text of each turn
    of a trained role, in code points of ``formatted``, end exclusive. A row goes up to ``PART_CHARS`` code
    points or one turn; the next rows of the conversation have the next parts. Rows without layout, where there
    is such a column, hold no turn. Turns without conv_id are one conversation. Extra columns are left out; an
    empty table gives an empty result. Rows of one conversation stay sorted in one partition.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = part = n_turns = length = 0
        pieces: list[str] = []
        starts: list[int] = []
        ends: list[int] = []

        def flushed() -> pa.RecordBatch:
            return table_batch([(conv, part, n_turns, "".join(pieces), starts, ends)], PART)

        for first, row in by_conversation(batches, "text"):
            if pieces and (first or length >= PART_CHARS):
                yield flushed()
                pieces, starts, ends, n_turns, length, part = [], [], [], 0, 0, part + 1
            if first:
                conv, part = row["conv_id"], 0
            text, start, end = written(row["role"], row["text"])
            if row["role"] in trained:
                starts.append(length + start)
                ends.append(length + end)
            pieces.append(text)
            n_turns, length = n_turns + 1, length + len(text)
        if pieces:
            yield flushed()

    if "layout" in turns.columns:
        turns = turns.filter(F.col("layout").isNotNull())
    empty = F.lit("")
    picked = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"))
    return together(picked, "turn", "role", "text").mapInArrow(write, PART_DDL)


def together(df: DataFrame, *order: str) -> DataFrame:
    """Rows of a conversation in one partition, in this order, sorted on disk where they do not fit."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame, in_order: bool = False) -> DataFrame:
    """What formatted conversations say: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The turns are parsed from the formatted text alone, the masked text from the mask. Digests are over role, line
    break, text, line break of each turn, and over the masked text. ``in_order`` is for rows that stand as
    ``format_conversations`` returns them; others, such as a stored table, are brought together again first.
    A null formatted text has no turn; one that the template did not write is refused. An empty table gives an
    empty result.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        conv, n_turns, loss_chars, chars = None, 0, 0, 0
        turns, loss, begun = hashlib.sha256(), hashlib.sha256(), False
        for first, row in by_conversation(batches, "formatted"):
            if first:
                if begun:
                    rows.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                if len(rows) >= 10_000:
                    yield table_batch(rows, DIGEST)
                    rows = []
                conv, n_turns, loss_chars, chars, begun = row["conv_id"], 0, 0, 0, True
                turns, loss = hashlib.sha256(), hashlib.sha256()
            formatted = row["formatted"] or ""
            for role, text, _, _ in parsed(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n_turns += 1
            for start, end in zip(row["loss_starts"] or (), row["loss_ends"] or (), strict=True):
                trained = unescaped(formatted[start:end])
                loss.update(trained.encode())
                loss_chars += len(trained)
            chars += len(formatted)
        if begun:
            rows.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        yield table_batch(rows, DIGEST)

    return (parts if in_order else together(parts, "part")).mapInArrow(read, DIGEST_DDL)
