"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names the strings around each role's texts, whether a text bears loss,
and which role may follow which.  Control strings inside texts are escaped: a
backslash goes behind their first character, one more where there are some already,
so every text comes back and none holds a control string.

Rows are sorted by ranges of (conversation, turn), so a conversation of any length
is spread over tasks; a task puts out chunks of segments, each with its loss flag.
What precedes a chunk may lie in another task, so a chunk carries the machine's step
as a map from each state to the state after it; ``turn_order`` applies a
conversation's maps in order.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annolink.llm.common import by_value, shared_dir

by_value(__name__)

#: role -> (before a text, after it, does the text bear loss); the strings around the
#: name and text of any other role; the machine's start, steps and final states.
TEMPLATE = {
    "turns": {"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST]", "[/INST]", False), "assistant": ("<s>", "</s>", True)},
    "other": ("[ROLE]", "[TEXT]", "[/ROLE]"),
    "start": "start",
    "steps": {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"},
              "assistant": {"user": "user"}},
    "final": ["assistant"],
}
#: Characters after which a chunk is closed.
CHUNK_CHARS = 1 << 16

_CHUNK = ("conv_id long, chunk long, whole boolean, n_turns long, segments array<struct<text:string,loss:boolean>>, "
          "after array<int>, fault array<long>")
_CHUNK_ARROW = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()),
                          ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
                          ("after", pa.list_(pa.int32())), ("fault", pa.list_(pa.int64()))])
_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_BACK_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


class Format:
    """A checked template: formatting, parsing and the machine's numbered states."""

    def __init__(self, template: dict = TEMPLATE):
        self.turns, self.other = template["turns"], template["other"]
        controls = [s for before, after, _ in self.turns.values() for s in (before, after)] + list(self.other)
        for x in controls:
            if len(x) < 2 or "\\" in x:
                raise ValueError(f"control string {x!r} is too short or holds a backslash")
            for y in controls:
                if (x != y and x in y) or any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)))):
                    raise ValueError(f"control strings {x!r} and {y!r} overlap")
        if len(set(controls)) < len(controls):
            raise ValueError("control strings repeat")
        forms = lambda n: "|".join(re.escape(x[0]) + rf"\\{n}" + re.escape(x[1:]) for x in controls)
        self.bare = re.compile("|".join(map(re.escape, controls)))
        self._inside, self._escaped = re.compile(forms("*")), re.compile(forms("+"))
        steps = template["steps"]
        self.states = list(dict.fromkeys([template["start"], *steps, *(t for s in steps.values() for t in s.values())]))
        number = {s: i for i, s in enumerate(self.states)}
        self.fault = len(self.states)                       # no way back
        self.step = {(number[s], role): number[t] for s, ways in steps.items() for role, t in ways.items()}
        self.final = [number[s] for s in template["final"]]

    def escape(self, text: str) -> str:
        return self._inside.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][2:], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        if role in self.turns:
            before, after, loss = self.turns[role]
            return [(before, False), (self.escape(text), loss), (after, False)]
        before, between, after = self.other
        return [(before + self.escape(role) + between + self.escape(text) + after, False)]

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn."""
        role_of = {before: role for role, (before, _, _) in self.turns.items()}
        marks = [(m[0], m.start(), m.end()) for m in self.bare.finditer(formatted)]
        at = 0
        while at < len(marks):
            n = 2 if marks[at][0] in role_of else 3
            parts = [self.unescape(formatted[a[2]:b[1]]) for a, b in zip(marks[at:at + n - 1], marks[at + 1:at + n])]
            yield (role_of[marks[at][0]], parts[0]) if n == 2 else (parts[0], parts[1])
            at += n


def _formatter(template: dict, chunk_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        form = Format(template)
        number = TaskContext.get().partitionId() << 33
        every = range(form.fault + 1)
        conv, first, out = (), True, []

        def fresh():
            return {"n_turns": 0, "segments": [], "after": list(every), "fault": [-1] * len(every)}

        box, chars, inner = fresh(), 0, False

        def close(ended: bool):
            nonlocal number, box, chars
            # a conversation is whole where it neither begins nor ends the task's rows, in one chunk
            out.append({"conv_id": conv[0], "chunk": number, "whole": ended and not inner and not first, **box})
            number, box, chars = number + 1, fresh(), 0

        for batch in batches:
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if (c,) != conv:
                    if conv:
                        close(True)
                        first = False
                    conv, inner = (c,), False
                elif chars >= chunk_chars:
                    close(False)
                    inner = True
                for s in every:
                    q = form.step.get((box["after"][s], role), form.fault)
                    if q == form.fault and box["after"][s] != form.fault:
                        box["fault"][s] = box["n_turns"]
                    box["after"][s] = q
                box["n_turns"] += 1
                for part, loss in form.segments(role, text):
                    if box["segments"] and not loss and not box["segments"][-1]["loss"]:
                        box["segments"][-1]["text"] += part
                    else:
                        box["segments"].append({"text": part, "loss": loss})
                    chars += len(part)
            if out:
                yield pa.RecordBatch.from_pylist(out, _CHUNK_ARROW)
                out.clear()
        if conv:
            close(False)
            yield pa.RecordBatch.from_pylist(out, _CHUNK_ARROW)
    return run


def _reader(template: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, conv, n, out = Format(template), (), None, []

        def close():
            out.append({"conv_id": conv[0], "n_turns": n["turns"], "turns_sha256": n["sha"].hexdigest(), "loss_chars": n["loss"],
                        "loss_sha256": n["loss_sha"].hexdigest(), "formatted_chars": n["chars"]})

        for batch in batches:
            for c, segments in zip(batch.column("conv_id").to_pylist(), batch.column("segments").to_pylist()):
                if (c,) != conv:
                    if conv:
                        close()
                    conv = (c,)
                    n = {"turns": 0, "loss": 0, "chars": 0, "sha": hashlib.sha256(), "loss_sha": hashlib.sha256()}
                for s in segments:
                    if s["loss"]:
                        text = form.unescape(s["text"])
                        n["loss"] += len(text)
                        n["loss_sha"].update(text.encode())
                formatted = "".join(s["text"] for s in segments)
                n["chars"] += len(formatted)
                for role, text in form.parse(formatted):
                    n["turns"] += 1
                    n["sha"].update(f"{role}\n{text}\n".encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, _BACK_ARROW)
                out.clear()
        if conv:
            close()
            yield pa.RecordBatch.from_pylist(out, _BACK_ARROW)
    return run


def format_chat(rows: DataFrame, template: dict = TEMPLATE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` -> chunks ``conv_id, chunk, whole, n_turns,
    segments(text, loss), after, fault``.

    A conversation's chunks ascend by ``chunk``; its formatted text is the
    concatenation of their segments.  Rows go by turn (nulls first), ties by role and
    text; every row is a turn, repeated ones too.  A null role or text is empty, a null
    conv_id is one conversation.  Other columns are ignored; no rows, no chunks.  A
    chunk holds about ``chunk_chars`` characters, or one longer turn."""
    Format(template)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_formatter(template, chunk_chars), _CHUNK)


def written(chunks: DataFrame) -> DataFrame:
    """The chunks as Parquet in the shared folder, read back."""
    path = shared_dir(chunks.sparkSession, "chat")
    chunks.write.option("compression", "zstd").parquet(path)
    return chunks.sparkSession.read.schema(chunks.schema).parquet(path)


def read_back(chunks: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Turns and loss text of each conversation, parsed from its chunks, as digests:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.  Only
    conversations in several chunks (or at a task's border) are brought together; a
    hash goes through them in order, a batch at a time."""
    parts = chunks.where(~F.col("whole")).select("conv_id", "chunk", "segments")
    rest = parts.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").select("conv_id", "segments")
    whole = chunks.where("whole").select("conv_id", "segments")
    return whole.mapInArrow(_reader(template), _BACK).unionByName(rest.mapInArrow(_reader(template), _BACK))


def turn_order(chunks: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """``conv_id, valid, first_fault``: does the machine accept the roles, and if a
    turn stops it, the number of the first one from 0 (null where only the end is missing)."""
    form = Format(template)
    steps = chunks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "n_turns", "after", "fault"))).alias("steps"))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("turns"), F.lit(-1).cast("long").alias("fault"))

    def step(done, c):
        here = F.get(c["fault"], done["state"])
        return F.struct(F.get(c["after"], done["state"]).alias("state"), (done["turns"] + c["n_turns"]).alias("turns"),
                        F.when((done["fault"] < 0) & (here >= 0), done["turns"] + here).otherwise(done["fault"]).alias("fault"))

    end = F.aggregate("steps", start, step)
    return steps.select("conv_id", end.alias("end")).select(
        "conv_id", F.col("end.state").isin(form.final).alias("valid"), F.when(F.col("end.fault") >= 0, F.col("end.fault")).alias("first_fault"))
