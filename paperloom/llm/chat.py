"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its own
text is trainable. ``format_turns`` places the formatted turns in their conversation; ``write_chat`` writes the examples,
each with its whole context. Their texts grow with the square of the turns of a conversation. They begin
alike, so compressed pages hold little more than one of them, and a task has one context and one small batch in memory.

A turn reads ``[INST]role[/INST]text</s>``. Control strings inside roles and texts are escaped by a
backslash behind their first character, and backslashes are doubled, so ``unescape(escape(x)) == x``.

Defined cases: null text or role is empty; turns are ordered by number, then role and text, null numbers
first; repeated rows are repeated turns; a null conversation id is a conversation; a conversation without an
assistant has turns but no example; an empty table gives an empty result. Only the assistant role is a target.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.llm.common import shipped
from paperloom.session import fresh_path

#: The control strings of the template family that are escaped inside texts.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
TARGET_ROLE = "assistant"
# A batch ends behind so many characters; a row group of the output holds so many examples.
CHARS_A_BATCH = 4_000_000
ROWS_A_GROUP = 256
_INSIDE = r"(<(?=/?s>|<SYS>>|</SYS>>))|(\[(?=/?INST\]))"
_turn = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
_escaped = re.compile(r"\\(\\?)")


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _INSIDE, r"$1$2\\")


def unescape(text: str) -> str:
    """A doubled backslash is one, a single one was put in."""
    return _escaped.sub(lambda m: m[1], text) if "\\" in text else text


def format_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: ``conv_id``, ``position``, ``piece``, ``start``, ``is_target``, ``example``, ``loss_start``, ``loss_end``.

    ``start`` and the loss span count code points of the conversation's formatted text; ``example`` numbers the
    assistant turns from 1.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("_role")), F.lit(MIDDLE))
    body = escape(F.col("_text"))
    base = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    made = base.select(
        "*", F.concat(head, body, F.lit(CLOSE)).alias("piece"), F.length(head).alias("_head"), F.length(body).alias("_body"),
        (F.col("_role") == TARGET_ROLE).alias("is_target"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = made.select(
        "conv_id", F.row_number().over(order).alias("position"), "piece",
        F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long")).alias("start"), "is_target",
        F.sum(F.col("is_target").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_n"), "_head", "_body",
    )
    target = F.col("is_target")
    return placed.select(
        "conv_id", "position", "piece", "start", "is_target", F.when(target, F.col("_n")).alias("example"),
        F.when(target, F.col("start") + F.col("_head")).alias("loss_start"),
        F.when(target, F.col("start") + F.col("_head") + F.col("_body")).alias("loss_end"),
    )


def write_chat(rows: DataFrame) -> str:
    """Write the examples of formatted turns as Parquet, each with its context, and what no example holds; the path.

    Texts of a conversation begin alike, so a page keeps little more than the longest of them; row groups are short, as a
    reader unpacks up to a whole one.
    """
    path = fresh_path(rows.sparkSession, "chat")
    limits = {"compression": "zstd", "parquet.block.row.count.limit": ROWS_A_GROUP}
    _written_out(rows).write.options(**limits).parquet(path)
    return path


def _by_conversation(rows: DataFrame, names: list[str], place: str) -> DataFrame:
    """Rows in order, each conversation within one task, which passes over it row by row."""
    return shipped(rows).select(*names).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), place)


def _written_out(turns: DataFrame) -> DataFrame:
    """Each example with all turns before it: ``conv_id``, ``example``, ``text``, ``loss_start``, ``loss_end``, ``is_last``.

    A conversation that does not end with an assistant has one more row, without example and loss: its whole text.
    ``is_last`` tells the row that holds all turns of the conversation.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
    names = ["conv_id", "example", "text", "loss_start", "loss_end", "is_last"]

    def run(batches):
        now, prefix, waiting, conv_type = object(), "", None, pa.int64()
        out, size = [], 0

        def packed():
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (conv_type, *types), strict=True)], names=names)

        def last():
            """The last row of the conversation at hand."""
            if waiting is not None and len(waiting[2]) == len(prefix):
                return [(*waiting, True)]
            before = [] if waiting is None else [(*waiting, False)]
            return [*before, (now, None, prefix, None, None, True)]

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                ready = []
                if row["conv_id"] != now:
                    ready = last() if prefix else []
                    now, prefix, waiting = row["conv_id"], "", None
                prefix += row["piece"]
                if row["is_target"]:
                    if waiting is not None:
                        ready.append((*waiting, False))
                    waiting = (now, row["example"], prefix, row["loss_start"], row["loss_end"])
                out += ready
                size += sum(len(r[2]) for r in ready)
                if size > CHARS_A_BATCH:
                    yield packed()
                    out, size = [], 0
        if prefix:
            out += last()
        if out:
            yield packed()

    columns = ["conv_id", "position", "piece", "is_target", "example", "loss_start", "loss_end"]
    shape = f"conv_id {kind}, example int, text string, loss_start bigint, loss_end bigint, is_last boolean"
    return _by_conversation(turns, columns, "position").mapInArrow(run, shape)


def expand(turns: DataFrame) -> DataFrame:
    """Each example written out: ``conv_id``, ``example``, ``text``, ``loss_start``, ``loss_end``."""
    return _written_out(turns).filter("example IS NOT NULL").drop("is_last")


DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_examples bigint"


def _parsed(written: DataFrame) -> DataFrame:
    """Per written row the unescaped text under its loss mask; from the last row of a conversation also its turns."""
    kind = written.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "example", "loss", "n_turns", "turns_sha256", "formatted_chars"]
    types = (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def turns_of(text):
        digest, n, at = hashlib.sha256(), 0, 0
        while at < len(text):
            turn = _turn.match(text, at)
            role, said = map(unescape, turn.groups())
            digest.update(f"{role}\n{said}\n".encode())
            n, at = n + 1, turn.end()
        return n, digest.hexdigest(), len(text)

    def run(batches):
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                conv, example, text, start, end, is_last = row
                loss = None if example is None else unescape(text[start:end])
                out.append((conv, example, loss, *(turns_of(text) if is_last else (None, None, None))))
            if out:
                kinds = (batch.schema.field("conv_id").type, *types)
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    shape = f"conv_id {kind}, example int, loss string, n_turns bigint, turns_sha256 string, formatted_chars bigint"
    return shipped(written).select("conv_id", "example", "text", "loss_start", "loss_end", "is_last").mapInArrow(run, shape)


def read_back(written: DataFrame) -> DataFrame:
    """Per conversation, parsed from the written examples: digests of the turns and of the text under the loss masks.

    Formatted turns are written out first.
    """
    kind = written.schema["conv_id"].dataType.simpleString()
    parsed = _parsed(_written_out(written) if "piece" in written.columns else written)

    def fresh(conv):
        return {"conv_id": conv, "n_turns": None, "turns": None, "loss_chars": 0, "loss": hashlib.sha256(), "chars": None, "examples": 0}

    def closed(done, conv_type):
        arrays = [pa.array([d["conv_id"] for d in done], conv_type)]
        arrays.append(pa.array([d["n_turns"] for d in done], pa.int64()))
        arrays.append(pa.array([d["turns"] for d in done], pa.string()))
        arrays.append(pa.array([d["loss_chars"] for d in done], pa.int64()))
        arrays.append(pa.array([d["loss"].hexdigest() for d in done], pa.string()))
        arrays.append(pa.array([d["chars"] for d in done], pa.int64()))
        arrays.append(pa.array([d["examples"] for d in done], pa.int64()))
        names = ["conv_id", *[part.split()[0] for part in DIGEST.split(", ")]]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches):
        state, conv_type = None, pa.int64()
        for batch in batches:
            conv_type, done = batch.schema.field("conv_id").type, []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != state["conv_id"]:
                    if state is not None:
                        done.append(state)
                    state = fresh(row["conv_id"])
                if row["example"] is not None:
                    state["loss_chars"] += len(row["loss"])
                    state["loss"].update(row["loss"].encode())
                    state["examples"] += 1
                if row["n_turns"] is not None:
                    state |= {"n_turns": row["n_turns"], "turns": row["turns_sha256"], "chars": row["formatted_chars"]}
            if done:
                yield closed(done, conv_type)
        if state is not None:
            yield closed([state], conv_type)

    return _by_conversation(parsed, parsed.columns, "example").mapInArrow(run, f"conv_id {kind}, {DIGEST}")
