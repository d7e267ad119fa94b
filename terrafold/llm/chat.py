"""Chat formatting with a grammar round trip.

A conversation is a row of turns, each its opening mark, its text, its closing
mark. The marks are control strings; the parser is deterministic: it reads an
opening mark, then text up to the closing mark that belongs to it, and undoes
escapes inside. A turn is rendered as it is, parsed again and compared; what
does not come back identical is escaped, first its control strings, then every
character a control string may begin with, until it does. Turns parse alone
exactly as in a row, since a turn's rendering must be used up to its last
character; so conversations are rendered and checked turn by turn and never have
to fit a row: they come as chunks of whole turns in order.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import column_of, table
from terrafold.workspace import new_path

# The marks of the template. Other roles are named in the general mark.
OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"<<SYS>>": "<</SYS>>", "[INST]": "[/INST]", "<s>": "</s>", "<|role|>": "<|/role|>"}
OTHER, NAMED = "<|role|>", "<|text|>"
MARKS = [*CLOSE, *CLOSE.values(), NAMED]
# Stuffed after the first character of a control string inside a text.
ESCAPE = "\\"

LEARNED = "assistant"
CHUNK_CHARS = 1 << 18

_FIRST = "".join(sorted({m[0] for m in MARKS}))
_REST = {f: "|".join(re.escape(m[1:]) for m in MARKS if m[0] == f) for f in _FIRST}
# A mark with any number of escapes after its first character.
_STUFFED = re.compile("|".join(
    f"{re.escape(f)}{re.escape(ESCAPE)}*(?=(?:{_REST[f]}))" for f in _FIRST))
_ANY_FIRST = re.compile(f"[{re.escape(_FIRST)}]{re.escape(ESCAPE)}*")
_MARK = re.compile("|".join(sorted(map(re.escape, MARKS), key=len, reverse=True)))
_TEXT_LEVELS = 3


def escaped(text: str, level: int) -> str:
    """Level 0: as it is; 1: one escape more in every mark; 2: after every first character."""
    if level == 0:
        return text
    pattern = _STUFFED if level == 1 else _ANY_FIRST
    return pattern.sub(lambda m: m[0] + ESCAPE, text)


def unescaped(text: str, level: int) -> str:
    if level == 0:
        return text
    pattern = _STUFFED if level == 1 else _ANY_FIRST
    return pattern.sub(lambda m: m[0][:-1] if len(m[0]) > 1 else m[0], text)


class Conflict(ValueError):
    """Rendered text that the grammar does not accept."""


def render_turn(role: str, text: str, level: int) -> str:
    """One turn; the character after its opening mark states the level of its escapes."""
    body = f"{level}{escaped(text, level)}"
    if role in OPEN:
        return f"{OPEN[role]}{body}{CLOSE[OPEN[role]]}"
    return f"{OTHER}{level}{escaped(role, level)}{NAMED}{body}{CLOSE[OTHER]}"


def _read(rendered: str, at: int, mark: str) -> tuple[str, int, int, int]:
    """Text up to the first control string, which must be ``mark``: (text, its start, level, next)."""
    if at >= len(rendered) or rendered[at] not in "012":
        raise Conflict("a turn does not state its escapes")
    level = int(rendered[at])
    found = _MARK.search(rendered, at + 1)
    if found is None or found[0] != mark:
        raise Conflict(f"{mark} expected")
    return unescaped(rendered[at + 1:found.start()], level), at + 1, level, found.end()


def parse_turns(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, stop) of every turn; start and stop bound the text as rendered."""
    out, at, roles = [], 0, {m: r for r, m in OPEN.items()}
    while at < len(rendered):
        found = _MARK.match(rendered, at)
        if found is None or found[0] not in CLOSE:
            raise Conflict("a turn does not begin with an opening mark")
        mark, at = found[0], found.end()
        if mark == OTHER:
            role, _, _, at = _read(rendered, at, NAMED)
            if role in OPEN:
                raise Conflict("a role with a mark of its own is named")
        else:
            role = roles[mark]
        text, start, _, after = _read(rendered, at, CLOSE[mark])
        out.append((role, text, start, after - len(CLOSE[mark])))
        at = after
    return out


def format_turn(role: str, text: str) -> str:
    """The first rendering that parses back into exactly this turn."""
    for level in range(_TEXT_LEVELS):
        rendered = render_turn(role, text, level)
        try:
            if [t[:2] for t in parse_turns(rendered)] == [(role, text)]:
                return rendered
        except Conflict:
            pass
    raise Conflict(f"no rendering of a turn of role {role!r} parses back")


def formatted(turns: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """conv_id, chunk, n_turns, text, loss: conversations as chunks of whole turns in order.

    Turns are ordered by ``turn`` (null first), then role, then text; a null role
    or text is empty. ``loss`` lists (start, stop) of the assistant texts in the
    chunk, in code points, escapes included. Repeated rows are turns of their
    own. A conversation's chunks, joined in order, are its formatted text.
    """
    order = ["conv_id", "turn", "role", "__tie", "text"]
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    # Ranges may cut a long conversation; its chunks are numbered by range and place.
    ordered = (rows.withColumn("__tie", F.xxhash64("text"))
               .repartitionByRange("conv_id", "turn", "role", "__tie")
               .sortWithinPartitions(*order).select("conv_id", "role", "text"))

    def run(batches):
        range_no, made = TaskContext.get().partitionId(), 0
        now, texts, loss, size, ready = None, [], [], 0, []

        def close():
            nonlocal texts, loss, size, made
            if texts:
                ready.append((now[0], (range_no << 32) + made, len(texts), "".join(texts), loss))
                made += 1
            texts, loss, size = [], [], 0

        for batch in batches:
            for conv, role, text in zip(*[column_of(batch, c).to_pylist()
                                          for c in ("conv_id", "role", "text")]):
                if now != (conv,) or size >= chunk_chars:
                    close()
                    now = (conv,)
                    if sum(len(r[3]) for r in ready) >= 16 * chunk_chars:
                        yield _chunks(ready, kind_arrow)
                        ready = []
                rendered = format_turn(role, text)
                if role == LEARNED:
                    (_, _, start, stop), = parse_turns(rendered)
                    loss.append({"start": size + start, "stop": size + stop})
                texts.append(rendered)
                size += len(rendered)
        close()
        if ready:
            yield _chunks(ready, kind_arrow)

    kind_arrow = _arrow_kind(rows)
    return ordered.mapInArrow(run, f"conv_id {kind}, chunk bigint, n_turns int, text string, "
                                   "loss array<struct<start: bigint, stop: bigint>>")


def _arrow_kind(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


def _chunks(ready: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, chunk, n, text, loss = zip(*ready)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, kind), pa.array(chunk, pa.int64()), pa.array(n, pa.int32()),
         pa.array(text, pa.string()), pa.array(loss, spans)],
        ["conv_id", "chunk", "n_turns", "text", "loss"])


def digests(chunks: DataFrame) -> DataFrame:
    """Per conversation, from its chunks alone: what the parser recovers and what is learned.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of each turn),
    loss_chars and loss_sha256 (the unescaped text under the loss spans),
    formatted_chars. Chunks stream by in order; a task holds one at a time.
    """
    kind = chunks.schema["conv_id"].dataType.simpleString()
    arrow = _arrow_kind(chunks)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def row(now):
        conv, n, turns, chars, learned, size = now
        return conv, n, turns.hexdigest(), chars, learned.hexdigest(), size

    def run(batches):
        now = None
        for batch in batches:
            out = []
            for conv, text, loss in zip(*[column_of(batch, c).to_pylist()
                                          for c in ("conv_id", "text", "loss")]):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(row(now))
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, turn, _, _ in parse_turns(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{turn}\n".encode())
                for span in loss:
                    start = span["start"]
                    learned = unescaped(text[start:span["stop"]], int(text[start - 1]))
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(text)
            if out:
                yield _as_batch(out)
        if now is not None:
            yield _as_batch([row(now)])

    def _as_batch(out):
        kinds = [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)

    ordered = chunks.select("conv_id", "chunk", "text", "loss").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "chunk").drop("chunk")
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, "
                                   "loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op2_chat(spark, sf_dir: str) -> DataFrame:
    """The digests of all conversations, and of one made of control strings, read back."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Conversation -1.
    hard = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"),
                                  (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                 "conv_id bigint, turn bigint, role string, text string")
    path = new_path(spark, "chat")
    formatted(said.unionByName(hard)).write.parquet(path)
    return digests(spark.read.parquet(path))
