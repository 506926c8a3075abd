"""Conversation structure repair by scalar big-integer weights.

A conversation's rows, by turn, are edited at the least cost so that their role
initials read ``(s?(ua)+)?``: keep (0), rerole to user or assistant (3), delete (4,
required for blank and repeated rows), insert an empty turn (3); a truncated row
that stays costs 3 more.  A weight is one integer: the cost above, below it the
audit letters as octal digits in their order (D, I, K, R are 1 to 4, as in ASCII),
padded with zeros at the end to a fixed width.  The smaller integer is the cheaper
edit or, at equal cost, the ASCII-least audit, so a plain minimum over the edges of
a DAG (row, state of the pattern) decides everything.

Rows are sorted by ranges and cut into blocks of at most ``BLOCK`` rows, so a
conversation of any length is spread over tasks.  A block gives the least weight
from each state to each other one; a conversation's blocks are chained from the
last to the first by the same minimum.  What is collected for one conversation is a
few bytes a row, the order of its audit letters.  Texts stay out of all this (two
64-bit hashes tell them apart) and are shuffled once, when the repaired turns are
put out in order.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from annolink.llm.common import by_value, stored

by_value(__name__)

#: Rows of a conversation decided together, as a power of two.
BLOCK_BITS = 10
#: White space: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 3, 4, 3, 3
#: States of the pattern: nothing yet, after s, after u, after a; the first and the last accept.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled turn leads to.
NEXT = (USER, USER, ASSISTANT, USER)
#: The states from which a kept row of that initial may follow (others: from none).
KEEPS = {0: ((START, SYSTEM),), 1: ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), 2: ((USER, ASSISTANT),), 3: ()}
#: Weights as (cost, letters, digits) of ending in each state: unclosed turns are closed by inserts.
CLOSE = ((0, 0, 0), (2 * COST_INSERT, 2, 0o22), (COST_INSERT, 1, 0o2), (0, 0, 0))
LEGAL = {(0, 1), (1, 2), (2, 1)}

_KEY = "conv_id long, turn long, role string, h1 long, h2 long"
_SUMMARY = ("conv_id long, block long, first_cls int, last_cls int, first_turn long, last_turn long, least long, turns long, "
            "blank long, duplicate long, truncated long, illegal long, steps array<int>, paths array<struct<cost:long,letters:long,digits:binary>>")
_PLAN = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         "pieces array<struct<block:long,edits:string>>")


# ------------------------------------------------------------------ weights

def scalar(path, width: int) -> int:
    """The weight as one integer, its letters padded with zeros to ``width`` digits."""
    cost, letters, digits = path
    return (cost << 3 * width) | (digits << 3 * (width - letters))


def chained(first, then):
    return first[0] + then[0], first[1] + then[1], (first[2] << 3 * then[1]) | then[2]


def unpacked(weight: int, width: int):
    """(cost, letters, digits) of a scalar weight; no letter is zero."""
    digits = weight & ((1 << 3 * width) - 1)
    padding = ((digits & -digits).bit_length() - 1) // 3 if digits else width
    return weight >> 3 * width, width - padding, digits >> 3 * padding


def letters(path) -> str:
    return oct(path[2])[2:].translate(str.maketrans("1234", LETTERS)) if path[1] else ""


def _least(steps: list[tuple[int, int, int]], after: list, bits: int) -> list:
    """Least weight from each state, through ``steps``, to the weights ``after``."""
    low = (1 << bits) - 1

    def ahead(weight, digits, n, cost):
        """``weight`` behind an edit run of ``n`` letters."""
        rest = weight & low
        return weight - rest + (cost << bits) + (digits << bits - 3 * n) + (rest >> 3 * n)

    for initial, extra, gone in reversed(steps):
        if gone:
            run = ((1 << 3 * gone) - 1) // 7      # D, gone times over
            after = [None if w is None else ahead(w, run, gone, COST_DELETE * gone) for w in after]
        if initial >= 0:
            here = [None if w is None else ahead(w, DELETE, 1, COST_DELETE) for w in after]
            edges = [(q, t, KEEP, extra) for q, t in KEEPS[initial]] + [(q, NEXT[q], REROLE, COST_REROLE + extra) for q in range(4)]
            for q, t, letter, cost in edges:
                if after[t] is not None:
                    w = ahead(after[t], letter, 1, cost)
                    here[q] = w if here[q] is None else min(here[q], w)
            after = here
        # at most two inserts in a row lead to a state that fewer don't
        one = [None if after[NEXT[q]] is None else ahead(after[NEXT[q]], INSERT, 1, COST_INSERT) for q in range(4)]
        two = [None if one[NEXT[q]] is None else ahead(one[NEXT[q]], INSERT, 1, COST_INSERT) for q in range(4)]
        after = [min((w for w in (after[q], one[q], two[q]) if w is not None), default=None) for q in range(4)]
    return after


def _width(steps: list[tuple[int, int, int]]) -> int:
    """Letters that the least path may have: the rows', and two inserts before each."""
    return sum((k >= 0) + gone + 2 for k, _, gone in steps)


def block_paths(steps: list[tuple[int, int, int]]) -> list[list]:
    """``steps`` are (initial, extra cost of staying, copies that must go after it), with
    the initial -1 for none but those copies.  Returns the least path from each state
    to each state, None where there is none."""
    width = _width(steps)
    ends = [_least(steps, [0 if q == end else None for q in range(4)], 3 * width) for end in range(4)]
    return [[None if w[q] is None else unpacked(w[q], width) for w in ends] for q in range(4)]


def whole_path(steps: list[tuple[int, int, int]]) -> tuple:
    """The least path of a conversation of one block."""
    width = _width(steps) + 2
    return unpacked(_least(steps, [scalar(p, width) for p in CLOSE], 3 * width)[START], width)


def chain(blocks: list[list[list]]) -> tuple[tuple, list[str]]:
    """The least path through the blocks in order, and its letters block by block."""
    best, choice = list(CLOSE), []
    for table in reversed(blocks):
        width = max((p[1] for row in table for p in row if p), default=0) + max((p[1] for p in best if p), default=0)
        now, to = [None] * 4, [0] * 4
        for q in range(4):
            least = None
            for t in range(4):
                if table[q][t] is not None and best[t] is not None:
                    path = chained(table[q][t], best[t])
                    weight = scalar(path, width)
                    if least is None or weight < least:
                        least, now[q], to[q] = weight, path, t
        best = now
        choice.append(to)
    q, pieces = START, []
    for table, to in zip(blocks, reversed(choice)):
        pieces.append(letters(table[q][to[q]]))
        q = to[q]
    pieces[-1] += letters(CLOSE[q])
    return best[START], pieces


# ------------------------------------------------------------- tasks' loops

def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last_of = (1 << BLOCK_BITS) - 1
    for batch in batches:
        out = []
        for conv, block, rows in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "block", "rows"))):
            n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            steps, last, turns, known = [], None, 0, None
            for r in rows:
                cls, copies = r["cls"], r["copies"]
                if r["turn"] is not None and r["turn"] != known:
                    turns, known = turns + 1, r["turn"]
                n["illegal"] += (last is not None and (last, cls) not in LEGAL) + (copies - 1) * ((cls, cls) not in LEGAL)
                last = cls
                if r["blank"]:
                    n["blank"] += copies
                    steps.append((-1, 0, copies))
                elif r["again"]:
                    n["duplicate"] += copies
                    steps.append((-1, 0, copies))
                else:
                    n["duplicate"] += copies - 1
                    n["truncated"] += r["cut"]
                    steps.append((cls, COST_TRUNCATED * r["cut"], copies - 1))
            # rows before or behind would stand in this block; only a range's last block may be wrong about that
            alone = rows[0]["at"] & last_of > 0 and rows[-1]["at"] & last_of < last_of
            paths = None if alone else [p and {"cost": p[0], "letters": p[1], "digits": p[2].to_bytes((p[2].bit_length() + 7) // 8, "big")}
                                        for row in block_paths(steps) for p in row]
            out.append({"conv_id": conv, "block": block, "first_cls": rows[0]["cls"], "last_cls": last, "first_turn": rows[0]["turn"],
                        "last_turn": rows[-1]["turn"], "least": next((r["turn"] for r in rows if r["turn"] is not None), None),
                        "turns": turns, **n, "steps": [x for step in steps for x in step] if alone else None, "paths": paths})
        yield _batch(out, _SUMMARY_ARROW)


def _steps(block: dict) -> list[tuple[int, int, int]]:
    flat = block["steps"]
    return list(zip(flat[::3], flat[1::3], flat[2::3]))


def _table(block: dict) -> list[list]:
    if block["paths"] is None:
        return block_paths(_steps(block))
    return [[p and (p["cost"], p["letters"], int.from_bytes(p["digits"], "big")) for p in block["paths"][4 * q:4 * q + 4]] for q in range(4)]


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, blocks in zip(batch.column("conv_id").to_pylist(), batch.column("blocks").to_pylist()):
            if len(blocks) == 1 and blocks[0]["steps"] is not None:
                total = whole_path(_steps(blocks[0]))
                pieces = [letters(total)]
            else:
                total, pieces = chain([_table(b) for b in blocks])
            n = {k: sum(b[k] for b in blocks) for k in ("blank", "duplicate", "truncated", "illegal")}
            turns, last = 0, None
            for a, b in zip([None, *blocks], blocks):
                n["illegal"] += a is not None and (a["last_cls"], b["first_cls"]) not in LEGAL
                turns += b["turns"] - (a is not None and b["first_turn"] is not None and a["last_turn"] == b["first_turn"])
                last = b["last_turn"] if b["last_turn"] is not None else last
            least = next((b["least"] for b in blocks if b["least"] is not None), None)
            out.append({"conv_id": conv, "gaps": 0 if least is None else last - least + 1 - turns, **n, "cost": total[0],
                        "audit": "".join(pieces), "pieces": [{"block": b["block"], "edits": e} for b, e in zip(blocks, pieces)]})
        yield _batch(out, _PLAN_ARROW)


#: The edits of one row: inserts, then its own letter.
_EDIT = re.compile("I*[DKR]")


def _row_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's edits, row by row; what follows the last row's letter stays with it."""
    for batch in batches:
        out = []
        for conv, rows, edits in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "rows", "edits"))):
            at, ends = 0, [m.end() for m in _EDIT.finditer(edits)]
            done = 0
            for k, r in enumerate(rows):
                done += r["copies"]
                to = len(edits) if k == len(rows) - 1 else ends[done - 1]
                out.append({"conv_id": conv, "turn": r["turn"], "role": r["role"], "h1": r["h1"], "h2": r["h2"], "edits": edits[at:to]})
                at = to
        yield _batch(out, _EDITS_ARROW)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, turn, role and text hashes, each text's edits before it:
    the repaired turns, in order."""
    conv, state, position, edits = (), START, 0, None
    for batch in batches:
        out: dict[str, list] = {"conv_id": [], "position": [], "role": [], "text": []}
        for c, role, given, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "edits", "text"))):
            if given is not None:
                edits = given
                continue
            if edits is None:       # a copy of the row before
                continue
            if (c,) != conv:
                conv, state, position = (c,), START, 0
            for letter in edits:
                if letter == "D":
                    continue
                if letter == "K":
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                else:
                    state = NEXT[state]
                out["conv_id"].append(c)
                out["position"].append(position)
                out["role"].append(role if letter == "K" else "user" if state == USER else "assistant")
                out["text"].append("" if letter == "I" else text)
                position += 1
            edits = None
        yield pa.RecordBatch.from_pydict(out, _TURNS_ARROW)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha = (), None
    for batch in batches:
        out: dict[str, list] = {"conv_id": [], "repaired_sha256": []}
        for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if (c,) != conv:
                if sha is not None:
                    out["conv_id"].append(conv[0])
                    out["repaired_sha256"].append(sha.hexdigest())
                conv, sha = (c,), hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_pydict(out, _DIGEST_ARROW)
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"conv_id": [conv[0]], "repaired_sha256": [sha.hexdigest()]}, _DIGEST_ARROW)


_LONG, _TEXT = pa.int64(), pa.string()
_PATH = pa.struct([("cost", _LONG), ("letters", _LONG), ("digits", pa.binary())])
_COUNTS = [(n, _LONG) for n in ("blank", "duplicate", "truncated", "illegal")]
_SUMMARY_ARROW = pa.schema([("conv_id", _LONG), ("block", _LONG), ("first_cls", pa.int32()), ("last_cls", pa.int32()), ("first_turn", _LONG),
                            ("last_turn", _LONG), ("least", _LONG), ("turns", _LONG), *_COUNTS, ("steps", pa.list_(pa.int32())), ("paths", pa.list_(_PATH))])
_PLAN_ARROW = pa.schema([("conv_id", _LONG), ("gaps", _LONG), *_COUNTS, ("cost", _LONG), ("audit", _TEXT),
                         ("pieces", pa.list_(pa.struct([("block", _LONG), ("edits", _TEXT)])))])
_EDITS_ARROW = pa.schema([("conv_id", _LONG), ("turn", _LONG), ("role", _TEXT), ("h1", _LONG), ("h2", _LONG), ("edits", _TEXT)])
_TURNS_ARROW = pa.schema([("conv_id", _LONG), ("position", _LONG), ("role", _TEXT), ("text", _TEXT)])
_DIGEST_ARROW = pa.schema([("conv_id", _LONG), ("repaired_sha256", _TEXT)])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


# --------------------------------------------------------------- operator

def _plain(rows: DataFrame) -> DataFrame:
    """The four columns; a null role or text is one space."""
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))


def _hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]


def _blocks(rows: DataFrame) -> DataFrame:
    """``conv_id, block, rows``: the rows of each conversation in order, equal ones
    counted, with their faults, at most ``2^BLOCK_BITS`` to a block."""
    key = ["conv_id", "turn", "role", "h1", "h2"]
    ink = F.rtrim("text", F.lit(BLANKS))
    light = rows.select("conv_id", "turn", "role", *_hashes(), (ink == "").alias("blank"),
                        (~F.substring(ink, -1, 1).isin(".", "!", "?")).alias("cut"))
    light = light.groupBy(*key).agg(F.count("*").alias("copies"), F.any_value("blank").alias("blank"), F.any_value("cut").alias("cut"))
    # numbers that ascend with the sort, over all ranges
    light = stored(light.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id()), "repair-rows")
    first = (light.groupBy("conv_id", "role", "h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h1").alias("x"), F.col("h2").alias("y"), "first"))
    seen = light.join(first, F.expr("conv_id <=> c and role = r and h1 = x and h2 = y"), "left")
    initial = F.substring("role", 1, 1)
    cls = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    row = F.struct("at", "turn", "role", "h1", "h2", "copies", cls.alias("cls"), "blank",
                   F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("again"), "cut")
    return seen.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows(conv_id, turn, role, text)`` -> ``(plans, turns)``.

    ``plans``: one row per conv_id that has rows (null is one conversation):
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.  ``turns``:
    the repaired conversations as ``conv_id, position, role, text``; a conversation's
    turns are in one partition and in order.

    Rows are ordered by turn (nulls first); ties by role, then by the text's hash.  A
    null role or text is one space (a blank row).  Roles count by their initial;
    a role without s, u or a in front can't be kept.  Other columns are ignored; no
    rows give no plans and no turns."""
    rows = _plain(rows)
    blocks = stored(_blocks(rows), "repair-blocks")
    summaries = blocks.mapInArrow(_summaries, _SUMMARY)
    names = [c for c in summaries.columns if c not in ("conv_id", "block")]
    per_conv = summaries.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", *names))).alias("blocks"))
    plans = stored(per_conv.mapInArrow(_plans, _PLAN), "repair-plans")
    pieces = plans.select(F.col("conv_id").alias("c"), F.explode("pieces").alias("p")).select("c", F.col("p.block").alias("b"), "p.edits")
    edits = (blocks.join(pieces, F.expr("conv_id <=> c and block = b")).select("conv_id", "rows", "edits")
             .mapInArrow(_row_edits, _KEY + ", edits string"))
    texts = rows.select("conv_id", "turn", "role", *_hashes(), F.lit(None).cast("string").alias("edits"), "text")
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(texts)
    order = ["conv_id", "turn", "role", "h1", "h2"]
    turns = (both.repartition("conv_id").sortWithinPartitions(*order, F.col("edits").desc_nulls_last())
             .select("conv_id", "role", "edits", "text").mapInArrow(_apply, "conv_id long, position long, role string, text string"))
    return plans.drop("pieces"), turns


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` lines; ``turns`` as ``repair`` returns
    them.  A hash goes through a conversation in order, a batch at a time."""
    return turns.select("conv_id", "role", "text").mapInArrow(_digest, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a row,
    1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it the user's.
    Nulls count as one space (conv_id and turn in the crc32 only)."""
    space = F.lit(" ")
    seed = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = _plain(rows).withColumn("fault", F.crc32(seed) % 20)
    fault = F.col("fault")
    return rows.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
