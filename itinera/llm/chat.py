"""Chat formatting with loss masks aligned by token offsets.

A conversation is rendered whole with one template, every turn as ``<turn:ROLE>``, a line break, the text and
``</turn>``, with a line break between turns. The tokenizer encodes the rendered text once with offsets, and the sorted
spans of the trained turns are met with the sorted token spans by binary search: the tokens and characters under the loss.

A backslash stands before every backslash and every ``<`` of a text (and before ``>`` and, as ``n``, line breaks of a
role), so no text can look like a mark and reading back is exact.

Rows are sorted by (conversation, turn, role, text) within partitions of the conversation and streamed, so no
conversation is ever held whole. A long one comes out in parts of about ``part`` characters, cut between turns: there
the tokenizer never joins, so the ids are those of the whole text.

Edge cases: null texts and roles are empty ones; a null conversation id is a conversation of its own; equal turn numbers
follow each other by role and text; repeated rows are turns like any other; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import map_rows
from itinera.llm.vocab import public_path, tokenizer

VOCABULARY = "byte_bpe_50k.json"
PART = 400_000
TRAINED = ("assistant",)

_TURN = re.compile(r"<turn:((?:\\.|[^\\>])*)>\n((?:\\.|[^\\<]+)*)</turn>\n?", re.S)
_MARK = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return _MARK.sub(r"\1", text)


def _escape_role(role: str) -> str:
    return escape(role).replace(">", "\\>").replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return _MARK.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def read_turns(formatted: str):
    """(role, text, start, end) of every turn of a formatted text; the span is that of the escaped text."""
    for m in _TURN.finditer(formatted):
        yield _unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)


def _loss_tokens(starts: list[int], ends: list[int], spans: list[tuple[int, int]]) -> list[dict]:
    """For each trained span the range of tokens that meet it, and the characters of the span under those tokens."""
    out = []
    for a, b in spans:
        first, after = bisect_right(ends, a), bisect_left(starts, b)
        if first < after and a < b:
            out.append({"token_from": first, "token_to": after, "from": max(a, starts[first]), "to": min(b, ends[after - 1])})
    return out


def format_conversations(rows: DataFrame, path: str | None = None, part: int = PART, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """(conv_id, part, formatted, ids, loss): parts of a conversation lie in one partition, one after another in order.

    ``loss`` has one entry for each trained turn with text: its token range and its characters in ``formatted``.
    """
    path = path or public_path(VOCABULARY)
    roles = frozenset(trained)

    def run(batches):
        coder = tokenizer(path, plain_specials=True)
        conv, serial, pieces, spans, chars = None, 0, [], [], 0

        def close():
            formatted = "".join(pieces)
            code = coder.encode(formatted, add_special_tokens=False)
            starts, ends = [o[0] for o in code.offsets], [o[1] for o in code.offsets]
            return [conv], [serial], [formatted], [code.ids], [_loss_tokens(starts, ends, spans)]

        for batch in batches:
            for conv_id, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
                if pieces and conv_id != conv:
                    yield close()
                    pieces, spans, chars, serial = [], [], 0, 0
                elif pieces and chars >= part:
                    yield close()
                    pieces, spans, chars, serial = [], [], 0, serial + 1
                conv = conv_id
                head = ("\n" if pieces or serial else "") + f"<turn:{_escape_role(role or '')}>\n"
                body = escape(text or "")
                if role in roles:
                    spans.append((chars + len(head), chars + len(head) + len(body)))
                pieces += [head, body, "</turn>"]
                chars += len(head) + len(body) + 7
        if pieces:
            yield close()

    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    ordered = turns.repartition(_parts(rows), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    loss = "array<struct<token_from:int,token_to:int,`from`:int,`to`:int>>"
    return map_rows(ordered.select("conv_id", "role", "text"), run, f"conv_id long, part int, formatted string, ids array<int>, loss {loss}")


def _parts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row a conversation, read back from the parts in their order within the partition."""

    def run(batches):
        conv, seen = None, False
        turns = loss = None
        n_turns = loss_chars = chars = 0

        def row():
            return [conv], [n_turns], [turns.hexdigest()], [loss_chars], [loss.hexdigest()], [chars]

        for batch in batches:
            for conv_id, part, text, spans in zip(batch["conv_id"], batch["part"], batch["formatted"], batch["loss"], strict=True):
                if part == 0:
                    if seen:
                        yield row()
                    conv, seen, turns, loss = conv_id, True, hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
                chars += len(text)
                for role, said, _, _ in read_turns(text):
                    n_turns += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unescape(text[s["from"] : s["to"]])
                    loss_chars += len(said)
                    loss.update(said.encode())
        if seen:
            yield row()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_rows(formatted.select("conv_id", "part", "formatted", "loss"), run, schema)


def op8(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return conversation_digests(format_conversations(rows.unionByName(more)))
