"""The registered queries over a whole small table against plain versions."""

import os
import sys
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from cardmill.llm.queries import QUERIES, vocabulary  # noqa: E402

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return {r["doc_id"]: r for r in table}


def result(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    pieces, used = defaultdict(list), defaultdict(list)
    for r in result(spark, "op1_packing"):
        pieces[r["doc_id"]].append(r)
        used[r["sequence_id"]].append(r)
    assert set(pieces) == set(docs)
    for doc_id, parts in pieces.items():
        ids = own.encode(docs[doc_id]["text"] or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            at += p["length"]
            assert p["ids_crc32"] == brute.crc(ids[p["start"] : at])
        assert at == len(ids)
    for parts in used.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    total = sum(r["length"] for parts in used.values() for r in parts)
    assert 1 - total / (2048 * len(used)) < 0.05


def test_simhash(spark, docs):
    rows = sorted(result(spark, "op2_simhash"), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == sorted(docs)
    prints = [brute.fingerprint(docs[r["doc_id"]]["text"] or "") for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == [rows[i]["doc_id"] for i in brute.linked(prints)]


def test_personal_data(spark, docs):
    for r in result(spark, "op3_pii"):
        spans = brute.pii_spans(docs[r["doc_id"]]["text"] or "")
        assert r["base_sha256"] == brute.sha(brute.joined(spans))
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(brute.joined(spans).split(",")) - {""} <= set(r["spans"].split(","))


def test_line_dedup(spark, docs):
    removed = brute.removed_lines([(i, d["text"]) for i, d in docs.items()])
    rows = result(spark, "op4_line_dedup")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        text = docs[r["doc_id"]]["text"] or ""
        gone = removed.get((r["doc_id"], text), set())
        clean = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        assert (r["n_removed"], r["clean_sha256"]) == (len(gone), brute.sha(clean))


def test_quality(spark, docs):
    rows = result(spark, "op5_quality")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        counts = brute.quality_counts(docs[r["doc_id"]]["text"] or "")
        assert {k: r[k] for k in counts} == counts
        failed = counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_token_file(spark, docs):
    from tokenizers import Tokenizer

    own, start = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), 0
    rows = sorted(result(spark, "op6_token_file"), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == sorted(docs)
    for r in rows:
        ids = own.encode(docs[r["doc_id"]]["text"] or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), brute.crc(ids))
        start += len(ids)


def test_sharding(spark, docs):
    rows = result(spark, "op7_sharding")
    groups, shards, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for r in rows:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        groups[text].add(r["shard"])
        shards[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    import hashlib

    sums = defaultdict(int)
    for d in docs.values():
        text = (d["text"] or "").encode()
        sums[hashlib.md5(text).hexdigest()] += len(text) + 1
    total, heavy = sum(sums.values()), [k for k, v in sums.items() if v * 16 > sum(sums.values())]
    if not heavy:
        assert total and max(shards.values()) == brute.least_capacity([sums[k] for k in sorted(sums)], 16)


def test_exact(spark, docs):
    first, size = {}, defaultdict(int)
    for i in sorted(docs):
        text = brute.SPACE.sub(" ", docs[i]["text"] or "")
        first.setdefault(text, i)
        size[text] += 1
    for r in result(spark, "op8_exact_dedup"):
        text = brute.SPACE.sub(" ", docs[r["doc_id"]]["text"] or "")
        assert (r["keep_id"], r["group_size"], r["kept"]) == (first[text], size[text], first[text] == r["doc_id"])
        assert r["text_sha256"] == brute.sha(text)


def test_mixing(spark, docs):
    sizes = {i: len(brute.WORD.findall(d["text"] or "")) for i, d in docs.items()}
    sources = sorted({d["source"] for d in docs.values() if d["source"] is not None})
    by_source = [sum(sizes[i] for i, d in docs.items() if d["source"] == s) for s in sources]
    goals = dict(zip(sources, brute.targets(by_source, [1 + i % 3 for i in range(len(sources))])))
    taken = defaultdict(int)
    rows = result(spark, "op9_mixing")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == by_source[sources.index(source)]
        assert r["target"] == pytest.approx(goals[source])
        assert r["taken"] <= 3 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0)
        taken[source] += r["taken"]
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= max(25, 0.02 * goal)


def test_secrets(spark, docs):
    for r in result(spark, "op10_secret_scan"):
        spans = brute.secret_spans(docs[r["doc_id"]]["text"] or "")
        assert r["base_sha256"] == brute.sha(brute.joined(spans))
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert set(brute.joined(spans).split(",")) - {""} <= set(r["spans"].split(","))
