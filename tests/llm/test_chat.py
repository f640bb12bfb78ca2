"""Prefix-target expansion: exact round trips."""

import hashlib

from pyspark.sql import functions as F

from quarry.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>x<|text|>y<|end|>", "\\", "\\\\<\\[", "<", "[", "<\\", "a\\<b", "", None,
         "é中👍\n\t", "x" * 30000, "$1 \\1 (", "<<SYS>>"]


def sample():
    rows = []
    for c in range(6):
        for t in range(c + 1):
            rows.append((c, t, ("system", "user", "assistant")[(t + c) % 3], NASTY[(c * 5 + t) % len(NASTY)]))
    rows += [(10 + i, 0, "assistant", x) for i, x in enumerate(NASTY)]
    rows += [(50, None, "user", "first"), (50, 1, None, "no role"), (50, 1, "assistant", "tie"), (50, 1, "assistant", "tie"),
             (None, 0, "user", "no conversation"), (60, 3, "user", "only asked"), (70, 0, "as<s>i|stant\\", "odd role")]
    return rows


def plain(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(loss), sha(loss))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(4)


def test_digests_read_back(spark):
    got = chat.digest(chat.expand(frame(spark, sample()))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == plain(sample())


def test_each_reply_is_one_example_with_its_prefix(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "<a1>"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    examples = sorted(chat.expand(frame(spark, rows)).collect(), key=lambda r: r.example)
    assert [r.loss_start is not None for r in examples] == [True, True, False]
    assert [r.last for r in examples] == [False, False, True]
    for r, reply, turns in zip(examples, ["<\\a1>", "a2", None], (2, 4, 5)):
        assert r.formatted.count(chat.TURN) == turns
        if reply:
            assert r.formatted[r.loss_start - 1: r.loss_start - 1 + r.loss_length] == reply
            assert r.formatted.endswith(reply + chat.END)
    assert examples[1].formatted.startswith(examples[0].formatted)


def test_control_strings_never_stand_in_texts(spark):
    df = spark.createDataFrame([(x,) for x in NASTY if x is not None], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_empty(spark):
    assert chat.digest(chat.expand(frame(spark, []))).collect() == []
