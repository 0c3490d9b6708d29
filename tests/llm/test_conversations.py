"""Conversation repair against a cheapest-path search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from passagework.llm import conversations, queries

ROLES = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}


def cheapest(rows):
    """Least (cost, letters): Dijkstra with letters as tie-break."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, last = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, letters
        follows = "a" if last == "u" else "u"
        steps = [(3, "I", i, follows)]
        if i < len(rows):
            initial, fault = rows[i]
            steps.append((4, "D", i + 1, last))
            if fault in (0, 3):
                extra = fault
                steps.append((3 + extra, "R", i + 1, follows))
                if initial == follows or (initial, last) == ("s", ""):
                    steps.append((extra, "K", i + 1, initial))
        for more, letter, j, initial in steps:
            heapq.heappush(heap, (cost + more, letters + letter, j, initial))


def digest(rows, letters):
    last, lines, rest = "", [], iter(rows)
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rest)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(table):
    """The whole result by plain loops; rows are (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if harm == 1:
                text = ""
            if harm == 2:
                text = re.sub("[.!?]", "", text)
            if harm == 4:
                role = "user"
            rows += [(turn is not None, turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
        rows.sort(key=lambda r: (r[0], r[1] or 0, r[2].encode(), r[3].encode()))
        seen, codes = set(), []
        for _, _, role, text in rows:
            marks = re.findall("[^\x20\x09-\x0d]", text)
            codes.append((role[:1], 1 if not marks else 2 if (role, text) in seen else 3 if marks[-1] not in ".!?" else 0))
            seen.add((role, text))
        turns = [t for _, t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        cost, letters = cheapest(codes)
        faults = [sum(f == k for _, f in codes) for k in (1, 2, 3)]
        out.append((conv, gaps, *faults, illegal, cost, letters, digest([r[2:] for r in rows], letters)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_search():
    rnd = random.Random(1)
    for _ in range(3000):
        rows = [(rnd.choice("suuaaat"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.choice([0, 1, 2, 3, 5, 8, 12]))]
        assert conversations.search(rows) == cheapest(rows)


@pytest.mark.parametrize("part", [1, 4, 64])
def test_parts_of_long_conversations(monkeypatch, part):
    monkeypatch.setattr(conversations, "PART", part)
    rnd = random.Random(part)
    for _ in range(50):
        rows = [(rnd.choice("suuaaat"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randrange(150 if part > 4 else 25))]
        conversation = conversations.Conversation()
        for i, (initial, fault) in enumerate(rows):
            conversation.add(i, ROLES[initial], f"t{i}", fault)
        result, want = conversation.result(), cheapest(rows)
        assert result[5:7] == want
        assert result[7] == digest([(ROLES[r], f"t{i}") for i, (r, _) in enumerate(rows)], want[1])


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert got(queries.QUERIES["op13_conversation_repair"](spark, sf_dir)) == expected(rows)


def test_odd_conversations(spark):
    rnd = random.Random(3)
    texts = ["ok.", "ok.", "cut", "", " \n", None, "was it?\n", "😀", "a ", " ", "end!\t "]
    roles = ["user", "assistant", "assistant", "user", "system", "support", "", None, "User", "tool"]
    rows = [
        (rnd.choice([None, 1, 2, 3, 4, -7, 8, 9]), rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(texts))
        for _ in range(150)
    ]
    rows += [(50, t, "user" if t % 2 else "assistant", f"text {t}." + "x" * 20_000 + ".") for t in range(150)]
    rows += [(60, 5, "user", "one row twice.")] * 2
    lonely = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lonely, 0, "user", "all gone."))
    names = "conv_id long, turn long, role string, text string, conv long, copy long, gone long, fault long, harm long"
    table = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], names).repartition(6)
    turns = conversations.damaged(table)
    result = conversations.repair(turns)
    assert got(result) == expected(rows)
    lines = {}
    for r in conversations.repaired_turns(turns, result).orderBy("place").collect():
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    for r in result.collect():
        assert hashlib.sha256("\n".join(lines.get(r["conv"], [])).encode()).hexdigest() == r["repaired_sha256"]
    assert (lonely, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got(result)
    assert conversations.repair(conversations.damaged(table.where("false"))).collect() == []
