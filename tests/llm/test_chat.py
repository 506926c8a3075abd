import hashlib
import random

import pytest

from annolink.llm import chat, queries

CONTROLS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]"]


def texts(rng, n):
    parts = [*CONTROLS, "<\\s>", "[\\\\INST]", "<", "[", "\\", "SYS>>", "s>", "/INST]", "\n", "ü東😀", "word ", ""]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(n)]


def test_escape_is_reversible_and_leaves_no_control_string():
    form = chat.Format()
    for t in texts(random.Random(1), 5000):
        e = form.escape(t)
        assert form.unescape(e) == t
        assert not any(c in e for c in CONTROLS)


def test_parse_gives_back_the_turns():
    form, rng = chat.Format(), random.Random(2)
    for _ in range(500):
        turns = list(zip([rng.choice(["system", "user", "assistant", "tool", "", "[TEXT]", "a\nb"]) for _ in range(6)], texts(rng, 6)))
        whole = "".join(part for role, text in turns for part, _ in form.segments(role, text))
        assert list(form.parse(whole)) == turns


def test_templates_that_cannot_be_read_back_are_refused():
    for turns in ({"user": ("<a>", "<a>", False)}, {"user": ("<ab>", ">x", True)}, {"user": ("[a]", "x[a]y", False)}, {"user": ("a\\b", "cd", False)},
                  {"user": ("a", "bc", False)}):
        with pytest.raises(ValueError):
            chat.Format(chat.TEMPLATE | {"turns": turns})


def expected(rows):
    steps = {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
    out = []
    extra = {("system",): 15, ("user",): 13, ("assistant",): 7}
    form = chat.Format()
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        loss = "".join(x for _, r, x in own if r == "assistant")
        chars = sum(len(form.escape(x)) + (extra[r,] if (r,) in extra else 19 + len(form.escape(r))) for _, r, x in own)
        faults = [k for k, (a, b) in enumerate(zip([""] + [r for _, r, _ in own], [r for _, r, _ in own])) if (a, b) not in steps or (k and a == "")]
        out.append((conv, len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), chars, not faults and own[-1][1] == "assistant", faults[0] if faults else None))
    return sorted(out, key=repr)


def random_rows(seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]), x)
            for c in range(60) for t, x in enumerate(texts(rng, rng.randint(1, 9)))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} [INST]") for t in range(300)]         # a long one, valid
    rows += [(101, t, "assistant" if t % 2 else "user", "x") for t in range(200)] + [(101, 200, "user", "y")]
    rows += [(None, None, None, None), (None, 1, "user", "a"), (102, 0, "user", "same"), (102, 0, "user", "same"), (103, 0, "user", "z" * 200_000),
             (104, None, "user", "first"), (104, -1, "assistant", "second")]
    return rows


@pytest.mark.parametrize("chunk_chars", [chat.CHUNK_CHARS, 64])
def test_chat_equals_plain_python(spark, tmp_path, monkeypatch, chunk_chars):
    rows = random_rows(4)
    path = str(tmp_path / "sf")
    spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, chunk int, loss string").write.parquet(
        f"{path}/conversations.parquet")
    shape = chat.format_chat
    monkeypatch.setattr(chat, "format_chat", lambda rows: shape(rows, chunk_chars=chunk_chars))
    df = queries.op12_chat_format(spark, path)
    got = sorted(map(tuple, df.collect()), key=repr)
    assert df.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "first_fault"]
    assert got == expected(rows + queries.PLANTED_CHAT)
    by_conv = {g[0]: g for g in got}
    assert by_conv[100][6] and by_conv[101][6:] == (False, None) and by_conv[-7][6]


def test_loss_flags_mark_the_assistants_texts_only(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b<s>"), (1, 2, "user", "c")], "conv_id long, turn long, role string, text string")
    got = [[(s.text, s.loss) for s in r.segments] for r in chat.format_chat(rows).collect()]
    assert got == [[("[INST]a[/INST]<s>", False), ("b<\\s>", True), ("</s>[INST]c[/INST]", False)]]


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    chunks = chat.format_chat(none)
    assert chat.read_back(chunks).count() == 0 and chat.turn_order(chunks).count() == 0
