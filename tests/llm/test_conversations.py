"""Conversation repair against a plain search, on the given table and on odd rows."""

import hashlib
import os
import random
import sys
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from cardmill.llm import common  # noqa: E402
from cardmill.llm import conversations as conv  # noqa: E402
from cardmill.llm.queries import QUERIES  # noqa: E402

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string, key string, times long, part int, row string"


def expected(rows):
    """Reports by conversation of damaged rows."""
    by_id = defaultdict(list)
    for conv_id, *row in rows:
        by_id[conv_id].append(tuple(row))
    return {conv_id: brute.conversation(conv_id, rows) for conv_id, rows in by_id.items()}


def found(spark, rows):
    common.prepare(spark)
    df = spark.createDataFrame([(*r, "k", 1, 2, "r") for r in rows], SCHEMA)
    repaired, report = conv.repair(df.repartition(3))
    digest = {r.conv_id: r.repaired_sha256 for r in conv.digests(repaired).collect()}
    out = {}
    for r in report.collect():
        r = r.asDict()
        conv_id = r.pop("conv_id")
        del r["n_rows"]
        assert conv_id not in out
        out[conv_id] = r | {"repaired_sha256": digest.get(conv_id, hashlib.sha256().hexdigest())}
    return out


def test_query(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    want = expected(brute.damage(rows))
    got = {r["conv_id"]: r.asDict() for r in QUERIES["op11_conversation_repair"](spark, SF).collect()}
    assert set(got) == {r[0] for r in rows}
    empty = dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], 0)
    empty |= {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    for conv_id, row in got.items():
        assert {k: v for k, v in row.items() if k != "conv_id"} == want.get(conv_id, empty)
    assert any(set(r["audit"]) & set("RD") for r in got.values())


def random_rows(seed, conversations, longest):
    chance = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "cut off \n", "", " ", "Why?\t", None, "é.", "x" * 50 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "umpire"]
    rows = []
    for c in range(conversations):
        turn = 0
        for _ in range(chance.randrange(1, longest)):
            turn += chance.choice([0, 1, 1, 1, 1, 3])
            role = chance.choice(roles[: chance.choice([2, 3, 8])])
            rows.append((None if c == 3 else c, None if chance.random() < 0.05 else turn, role, chance.choice(texts)))
    return rows


def filled(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.mark.parametrize("seed,conversations,longest", [(1, 200, 9), (2, 30, 40)])
def test_odd_rows(spark, seed, conversations, longest):
    rows = random_rows(seed, conversations, longest)
    assert found(spark, rows) == expected(filled(rows))


@pytest.mark.parametrize("part_rows", [1, 3])
def test_cut_in_parts(spark, monkeypatch, part_rows):
    """The result does not depend on how a conversation is cut; parts are searched in this process."""
    rows = random_rows(5, 40, 30)
    by_id = defaultdict(list)
    for c, *row in filled(rows):
        by_id[c].append(tuple(row))
    for own in by_id.values():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0))
        judged, seen = [], set()
        for _, role, text in own:
            last = text.strip()[-1:]
            judged.append((role, text, "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"))
            seen.add((role, text))
        parts = [
            conv.ways_of([(r[:1], f in ("blank", "duplicate"), f == "truncated") for r, _, f in judged[i : i + part_rows]])
            for i in range(0, len(judged), part_rows)
        ]
        assert conv.cheapest(conv.joined_all(parts)) == brute.repaired(judged)[:2]


@pytest.mark.parametrize("insert", [1, 2, 5])
def test_inserts_decided_by_weight(monkeypatch, insert):
    """With cheap inserts the same search puts rows in, and ties go by letters, not by length."""
    import re

    monkeypatch.setattr(conv, "INSERT_COST", insert)
    source = re.sub(r"c \+ 5, \"I\"", f'c + {insert}, "I"', open(brute.__file__).read())
    plain = {}
    exec(compile(source, "brute", "exec"), plain)
    chance = random.Random(insert)
    with_insert = 0
    for _ in range(300):
        judged = [(chance.choice(["user", "assistant", "system", "tool"]), "t", chance.choice(["", "", "blank", "truncated"])) for _ in range(chance.randrange(7))]
        rows = [(r[:1], f == "blank", f == "truncated") for r, _, f in judged]
        want = plain["repaired"](judged)[:2]
        assert conv.cheapest(conv.ways_of(rows, (0,))) == want
        split = chance.randrange(len(rows) + 1)
        assert conv.cheapest(conv.joined(conv.ways_of(rows[:split]), conv.ways_of(rows[split:]))) == want
        with_insert += "I" in want[1]
    assert (with_insert > 0) == (insert < 5)


def test_one_long_conversation(spark):
    """A third of all rows in one conversation, and thousands of copies of one row."""
    chance = random.Random(7)
    rows = [(1, t, chance.choice(["user", "assistant"]), f"Text {t if chance.random() < 0.9 else 1}.") for t in range(1500)]
    rows += [(2, 4, "user", "Again and again.")] * 1200
    rows += [(2, 5, "assistant", "Yes."), (2, 1, "system", "Go.")]
    rows += [(c, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant"), "Good.") for c in range(10, 200) for t in range(2)]
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        got = found(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert got == expected(rows)
    assert got[2]["audit"] == "KK" + "D" * 1199 + "K"


def test_no_rows(spark):
    assert found(spark, []) == {}
