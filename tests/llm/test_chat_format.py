import random
import re

import pytest

from cardwatch.llm import chat_format, sql
from tests.compare import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, block_turns=64):
    """Whole dialogues by speaker, their blocks one after another: (text, target strings)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = {(t, r, x or "") for c, t, r, x in rows if c == conv}
        ordered = sorted(own, key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or "", m[2]))
        for speaker in {r for _, r, _ in own if r and r != "system"}:
            text, said = "", []
            for _, role, words in ordered:
                body = words.replace("<|", "<\\|") + "<|end|>"
                name = re.sub(r"[|<>\r\n]", "_", "unknown" if role is None else role)
                head = {"system": "<|system|>", speaker: "<|assistant|>"}.get(role, f"<|user name={name}|>")
                text += head + "\n" + body + "\n"
                if role == speaker:
                    said.append(body)
            out[(conv, speaker)] = (text, said)
    return out


def gathered(df):
    out = {}
    order = lambda r: (r.block is not None, r.block or 0, r.sub_block)
    for r in sorted(df.collect(), key=order):
        text, said = out.get((r.conv_id, r.speaker), ("", []))
        spans = [r.text[s.start : s.end] for s in r.targets]
        out[(r.conv_id, r.speaker)] = (text + r.text, said + spans)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "Ann", "Bö<b>", None]
    rows = [(rng.choice([1, 2, 3, None]), rng.randrange(-70, 200), rng.choice(roles), rng.choice(["hi", "é🙂", "a <|end|> b", "", None]))
            for _ in range(300)]
    rows += rows[:20] + [(7, None, "user", "no turn"), (7, 0, "user", "x"), (8, 1, "system", "alone"), (9, 1, None, "alone"),
                         (10, 2, "user", "y " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", block int, speaker string").repartition(4)
    assert gathered(chat_format.rotate(df)) == brute(rows)


def test_crowded_blocks_are_cut(spark):
    rows = [(1, 5, "user" if i % 3 else "bot", f"m{i}") for i in range(500)] + [(1, 6, "user", "last"), (2, 5, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    cut = chat_format.rotate(df, max_messages=40)
    most = max(r.n_messages for r in cut.collect())
    assert most <= 80
    mine, plain = gathered(cut), brute(rows)
    assert set(mine) == set(plain)
    for key, (text, said) in plain.items():
        assert sorted(mine[key][1]) == sorted(said) and len(mine[key][0]) == len(text)
        if key[0] == 1:
            assert mine[key][0].rstrip().endswith("last<|end|>")


def test_pieces_in_order_give_the_dialogue(spark):
    rows = [(c, 5 + i % 2, ["user", "bot", None][i % 3], f"m{i * 7919 % 500}") for c in (1, None) for i in range(300)]
    rows += [(2, 5, "user", "again")] * 100 + [(2, None, "user", f"n{i}") for i in range(90)]
    pieces = chat_format.rotate(spark.createDataFrame(rows, SCHEMA).repartition(5), max_messages=40)
    assert gathered(pieces) == brute(rows)
    sizes = {}
    for r in pieces.collect():
        sizes.setdefault((r.conv_id, r.speaker, r.block), []).append((r.sub_block, r.n_messages))
    for found in sizes.values():
        found.sort()
        assert [k for k, _ in found] == list(range(len(found)))
        assert all(n == 40 for _, n in found[:-1]) and found[-1][1] <= 40
    assert sizes[(2, "user", 0)] == [(0, 1)]


def test_empty_table(spark):
    assert chat_format.rotate(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf_dir, name):
    folder = sf_dir.replace("sf0.001", name)
    got = chat_format.digests(chat_format.rotate(spark.read.parquet(f"{folder}/conversations.parquet")))
    with connect(folder) as con:
        assert differences(got, con, sql.OP10) == []
