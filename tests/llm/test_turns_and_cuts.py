"""Chat formatting, the prefix trie and fill-in-the-middle: edge cases, brute force and round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulselake.llm import chat_format, fill_middle, prefix_trie

TURNS = "conv_id long, turn int, role string, text string"
#: Names the operators use themselves.
CLASHING = ("turns", "said", "key", "words", "block", "place", "lcp", "family", "segments", "formatted", "walk", "form", "n")


def clashing(frame):
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def told(rows):
    """Turns of each conversation, as (role, text)."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


HARD = [
    "", "<", "<|", "|>", "<\\|", "<\\\\|", "<<|im_end|>", "<|im_end|>\n<|im_start|>user\nhi", "a\nb\r\n", "\\", "|", "é\U0001f600",
    "<|im_start|>" * 3, "<|im_start", "$1 \\1 ", "x" * 200_000,
]
CHATS = (
    [(i, 0, "user", t) for i, t in enumerate(HARD)]
    + [(i, 1, "assistant", t) for i, t in enumerate(HARD)]
    + [(100, None, "system", None), (100, 0, "user", "u"), (100, 0, "user", "u"), (101, 0, None, "only")]
    + [(102, 0, "user\n<|im_start|>\\n", "a"), (None, 3, "assistant", "no id"), (103, 0, "assistant", "first")]
    + [(104, 0, "system", "s"), (104, 1, "user", "q"), (104, 2, "assistant", "a"), (104, 3, "user", "q")]
)


def test_chats_against_brute_force(spark):
    got = {r["conv_id"]: r for r in chat_format.chat_digests(clashing(spark.createDataFrame(CHATS, TURNS))).collect()}
    want = told(CHATS) | {-1: [("user", chat_format.PROBE_TEXT), ("assistant", chat_format.PROBE_TEXT)]}
    assert set(got) == set(want)
    for conv, turns in want.items():
        trained = "".join(t for r, t in turns if r == "assistant")
        row = got[conv]
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(trained))
        assert row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert row["loss_sha256"] == sha(trained)


def test_machine_tells_turns_out_of_order(spark):
    rows = {r["conv_id"]: r for r in chat_format.format_chats(spark.createDataFrame(CHATS, TURNS)).collect()}
    assert rows[0]["valid"] and rows[0]["complete"]
    assert rows[104]["valid"] and not rows[104]["complete"]
    assert (rows[103]["valid"], rows[103]["bad_turn"]) == (False, 0)
    assert (rows[100]["valid"], rows[100]["bad_turn"]) == (False, 2)


def test_segments_join_to_the_formatted_text(spark):
    rows = chat_format.format_chats(spark.createDataFrame(CHATS, TURNS)).collect()
    for row in rows:
        assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
        assert row["formatted"].count("<|im_start|>") == len(row["segments"]) // 3 == row["formatted"].count("<|im_end|>")


def test_another_template(spark):
    short = chat_format.Template("<|", ":", "|>", ("bot",), "s", {("s", "me"): "t", ("t", "bot"): "s"}, ("s",))
    rows = spark.createDataFrame([(1, 0, "me", "a"), (1, 1, "bot", "b <| c")], TURNS)
    row = chat_format.format_chats(rows, short).select(
        "*", chat_format.read_turns(F.col("formatted"), short).alias("turns")
    ).first()
    assert row["formatted"] == "<|me:a|><|bot:b <\\| c|>" and row["complete"]
    assert [tuple(t) for t in row["turns"]] == [("me", "a"), ("bot", "b <| c")]


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert chat_format.format_chats(none).count() == 0
    assert [r["conv_id"] for r in chat_format.chat_digests(none).collect()] == [-1]
    assert prefix_trie.prefix_trie(none).count() == 0


def test_chat_formatting_runs_no_python(spark):
    made = chat_format.chat_digests(spark.createDataFrame(CHATS, TURNS))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_trie(rows):
    own = told(r for r in rows if r[0] is not None)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(node[-1][1].split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += worth
    return sorted(
        (
            min(convs), len(node), -1 if not node else min(members[node[:-1]]), len(convs), len(kids.get(node, ())),
            leaves[node], saved[node], sha(",".join(str(c) for c in sorted(convs) if built[c] == node)),
        )
        for node, convs in members.items()
    )


def trie_rows(frame, block_rows=None):
    return sorted(
        (r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
         r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        for r in prefix_trie.prefix_trie(frame, block_rows).collect()
    )


def random_chats(seed, convs, absent=()):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        if c in absent:
            continue
        for turn in range(draw.choice([1, 2, 2, 3, 5, 9])):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["a", "b b", "c  c\tc", ""])))
    return rows


@pytest.mark.parametrize("block_rows", [1, 17, None])
def test_trie_against_brute_force(spark, block_rows):
    rows = random_chats(5, 90, absent=(20, 60))
    rows += [(300, None, "user", "n"), (300, 0, None, None), (None, 0, "user", "x"), (41, 0, "user", "twice"), (41, 0, "user", "twice")]
    assert trie_rows(clashing(spark.createDataFrame(rows, TURNS)), block_rows) == brute_trie(rows)


@pytest.mark.parametrize("block_rows", [2, None])
def test_trie_of_equal_and_nested_conversations(spark, block_rows):
    same = [(c, t, "user", "one two") for c in range(1000, 1060) for t in range(4)]
    nested = [(c, t, "user", "one two") for c in range(2001, 2020) for t in range(c - 2000)]
    # Without the family's first conversation and with few turns, nothing may be left.
    for rows in (same + nested, [(c, 0, "user", "x") for c in range(3001, 3010)]):
        assert trie_rows(spark.createDataFrame(rows, TURNS), block_rows) == brute_trie(rows)


def test_trie_of_a_long_conversation(spark):
    rows = [(c, t, "user", f"w {t}") for c in (0, 1, 2) for t in range(1500)] + [(2, 1500, "user", "more")]
    assert trie_rows(spark.createDataFrame(rows, TURNS), 1) == brute_trie(rows)


def test_range_minimum_searches():
    draw = np.random.default_rng(3)
    values = draw.integers(0, 6, 97)
    table = prefix_trie.RangeMinimum(values)
    for at in range(98):
        for depth in range(7):
            right = next((i for i in range(at, 97) if values[i] < depth), 97) - at
            left = at - next((i + 1 for i in range(at - 1, -1, -1) if values[i] < depth), 0)
            assert table.right(np.array([at]), np.array([depth]))[0] == right
            assert table.left(np.array([at]), np.array([depth]))[0] == left


TEXTS = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb\nc", "a\r\nb c\x85d\n", "x <P> y\nz", "<S>", "a<M>", "<P\n<S\n>M>",
    "é\U0001f600\n\U0001f600", "line\n" * 70_000, "\n" * 200_000, "long " * 50_000 + "\n" + "y" * 70_000,
    "".join("ab\n" if i % 3 else "\n\n" for i in range(60_000)), "<\n<\n<\n",
]


def brute_cut(doc_id, text):
    import re

    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, rest = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<P>{pre}<S>{rest}<M>{mid}" if form == "psm" else f"<S>{rest}<P>{pre}<M>{mid}"
    return n, form, len(pre), len(mid), sha(out), sha(text)


def test_fill_middle_against_brute_force(spark):
    rows = [(100 * k + i, t) for k in range(3) for i, t in enumerate(TEXTS)] + [(None, "no\nid"), (1, "again\n"), (1, "again\n")]
    frame = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, fill_middle.fill_middle_digests(frame).collect()), key=repr)
    assert got == sorted(((i, *brute_cut(i, t)) for i, t in rows), key=repr)
    assert fill_middle.fill_middle_digests(frame.limit(0)).count() == 0


def test_every_container_selects_like_a_list():
    draw = np.random.default_rng(1)
    made = set()
    for lows in (
        np.array([5]), np.arange(65536), np.flatnonzero(draw.random(65536) < 0.5), np.flatnonzero(draw.random(65536) < 0.01),
        np.concatenate((np.arange(9), np.arange(400, 9000), [65535])),
    ):
        box = fill_middle.container(lows.astype(np.int64))
        made.add(type(box).__name__)
        assert [box.select(k) for k in range(len(lows))] == lows.tolist()
    assert made == {"ArrayContainer", "BitmapContainer", "RunContainer"}


def test_no_share_of_documents_is_transformed(spark):
    rows = fill_middle.fill_middle(spark.createDataFrame([(i, "a\nb") for i in range(9)], "doc_id long, text string"), fim_percent=0)
    assert {(r["form"], r["output"]) for r in rows.collect()} == {("plain", "a\nb")}
