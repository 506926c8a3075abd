import hashlib
import itertools
import random
import zlib

import pytest

from annolink.llm import queries, repair

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if f == 4 else role
        text = "" if f == 1 else "".join(c for c in text if c not in ".!?") if f == 2 else text
        out += [(conv, turn, role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Forward over the rows, all (cost, audit, turns) of each state: no integers, no blocks."""
    best = {"": (0, "", ())}

    def insert(states):
        found = dict(states)
        for _ in range(3):
            for q, (c, a, o) in list(found.items()):
                n = NEXT[q]
                way = (c + 3, a + "I", o + ((NAMES[n], ""),))
                found[n] = min(found.get(n, way), way)
        return found

    for (role, text), fault in zip(rows, faults(rows)):
        now = {}
        for q, (c, a, o) in insert(best).items():
            ways = [(q, (c + 4, a + "D", o))]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                r = role[:1]
                if (q, r) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    ways.append((r, (c + extra, a + "K", o + ((role, text),))))
                ways.append((NEXT[q], (c + 3 + extra, a + "R", o + ((NAMES[NEXT[q]], text),))))
            for t, way in ways:
                now[t] = min(now.get(t, way), way)
        best = now
    return min(v for q, v in insert(best).items() if q in ("", "a"))


def expected(rows):
    """As the contract has it; rows as (conv_id, turn, role, text)."""
    out = []
    damaged = hurt(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = {r[1] for r in own} - {None}
        plain = [r[2:] for r in own]
        found = faults(plain)
        cost, audit, left = cheapest(plain)
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(plain, plain[1:])]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[found.count(k) for k in ("blank", "duplicate", "truncated")],
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            if rng.random() < 0.1:
                continue
            rows.append((conv, turn * rng.choice([1, 1, 2]) * 10 + turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "sage"]),
                         rng.choice(["Yes.", "No!", "And then", "  ", "", "Ünd? \n", "a.b", "Why?\x0b", "x" * 300])))
    rows += [(None, 3, "user", "Hm."), (None, 4, "assistant", "Oh."), (700, None, "user", "No turn."), (700, 0, "assistant", "Turn."),
             (701, None, None, None), (702, 2**40, "user", None), (702, 0, None, "."), (703, -5, "assistant", "Ah?")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, at int, block string, edits string"


def run(spark, tmp_path, rows):
    path = str(tmp_path / f"sf{random.random()}")
    spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).write.parquet(f"{path}/conversations.parquet")
    return path


def test_repair_equals_forward_search(spark, tmp_path, monkeypatch):
    rows = random_rows(120, 3)
    got = sorted(map(tuple, queries.op11_conversation_repair(spark, run(spark, tmp_path, rows)).collect()), key=repr)
    assert got == expected(rows)
    assert {c for g in got for c in g[7]} == set("DIKR")
    monkeypatch.setattr(repair, "BLOCK_BITS", 1)        # two rows a block: conversations are chained
    assert sorted(map(tuple, queries.op11_conversation_repair(spark, run(spark, tmp_path, rows)).collect()), key=repr) == got


def test_repair_of_one_long_conversation(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 5)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Text {t}.", f"cut {t}", ""])) for t in range(400)]
    got = [tuple(r) for r in queries.op11_conversation_repair(spark, run(spark, tmp_path, rows)).collect()]
    assert got == expected(rows)


def test_repair_of_nothing(spark, tmp_path):
    assert queries.op11_conversation_repair(spark, run(spark, tmp_path, [])).count() == 0
    gone = next(t for t in range(99) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = queries.op11_conversation_repair(spark, run(spark, tmp_path, [(5, gone, "user", "A.")])).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repeated_rows_are_copies_of_one(spark):
    """A row that stands there a thousand times: one is kept, the others go."""
    rows = spark.createDataFrame([(1, 0, "user", "A.")] * 1000 + [(1, 1, "assistant", "B.")], "conv_id long, turn long, role string, text string")
    plans, turns = repair.repair(rows)
    p = plans.first()
    assert (p.cost, p.audit, p.duplicate, p.illegal) == (4 * 999, "K" + "D" * 999 + "K", 999, 999)
    assert sorted((t.position, t.role, t.text) for t in turns.collect()) == [(0, "user", "A."), (1, "assistant", "B.")]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_cheapest_edit_among_all(n):
    """All edits of up to three rows, tried one by one, against the integers."""
    for initials in itertools.product([-1, 0, 1, 2, 3], repeat=n):
        steps = [(k, 3 * (i % 2) if k >= 0 else 0, 0 if k >= 0 else 1) for i, k in enumerate(initials)]
        options = []
        for inserts in itertools.product(range(3), repeat=n + 1):
            for ops in itertools.product("DKR", repeat=n):
                cost, audit, q, ok = 0, "", "", True
                for i, op in enumerate([*ops, ""]):
                    for _ in range(inserts[i]):
                        q, cost, audit = NEXT[q], cost + 3, audit + "I"
                    if not op:
                        break
                    k, extra = initials[i], 3 * (i % 2)
                    audit += op
                    if op == "D":
                        cost += 4
                    elif k < 0:
                        ok = False
                    elif op == "R":
                        q, cost = NEXT[q], cost + 3 + extra
                    else:
                        r = "sua"[k] if k < 3 else "x"
                        ok &= (q, r) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
                        q, cost = r if r != "x" else q, cost + extra
                if ok and q in ("", "a"):
                    options.append((cost, audit))
        best, pieces = repair.chain([repair.block_paths(steps)])
        assert (best[0], "".join(pieces)) == min(options)


def test_a_block_alone_and_blocks_in_a_chain_agree():
    rng = random.Random(11)
    for _ in range(300):
        steps = [(k := rng.choice([-1, 0, 1, 2, 2, 1, 3]), 3 * rng.randint(0, 1) if k >= 0 else 0, rng.randint(0, 2) + (k < 0)) for _ in range(rng.randint(1, 12))]
        path = repair.whole_path(steps)
        cut = rng.randint(0, len(steps) - 1)
        for parts in ([steps], [steps[:cut], steps[cut:]] if cut else [steps]):
            total, pieces = repair.chain([repair.block_paths(p) for p in parts])
            assert (total[0], "".join(pieces)) == (path[0], repair.letters(path))
