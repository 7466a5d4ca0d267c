"""Conversation repair against a brute-force version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from pagemill.llm import conversations
from pagemill.llm.conversations import damage, repair_conversations
from pagemill.llm.queries import QUERIES
from pagemill.session import table

COLUMNS = ["conv_id", *conversations.FAULTS, "audit", "repaired_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def filled(value):
    return " " if value is None else str(value)


def digest_order(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def damaged_by_hand(rows):
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = filled(role), filled(text)
        code = zlib.crc32(f"{filled(conv)}:{filled(turn)}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return found


def cheapest(rows, faults):
    """``cost, audit, turns`` by trying every edit; paths are compared as whole strings."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    memo = {}

    def best(i, state, inserted):
        key = (i, state, inserted)
        if key in memo:
            return memo[key]
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            for initial, role in (("u", "user"), ("a", "assistant")):
                if (state, initial) in moves:
                    cost, audit, turns = best(i, initial, inserted + 1) or (None,) * 3
                    if cost is not None:
                        options.append((cost + 2, "I" + audit, ((role, ""), *turns)))
        if i < len(rows):
            _, role, text = rows[i]
            tries = [(3, "D", state, ())]
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for cost, letter, new in ((0, "K", role), (2, "R", "user"), (2, "R", "assistant")):
                    if (state, new[:1]) in moves:
                        tries.append((cost + more, letter, new[:1], ((new, text),)))
            for cost, letter, after, written in tries:
                rest = best(i + 1, after, 0)
                if rest:
                    options.append((cost + rest[0], letter + rest[1], (*written, *rest[2])))
        memo[key] = min(options, key=lambda o: o[:2]) if options else None
        return memo[key]

    return best(0, "", 0)


def repaired_by_hand(found):
    answer = []
    for conv, rows in found.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest_order(*r[1:])))
        seen, faults = set(), []
        for _, role, text in rows:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else ""
            faults.append(fault or ("" if letters[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, kept = cheapest(rows, faults)
        text = "\n".join(f"{role}:{text}" for role, text in kept)
        count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        answer.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(answer, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def nasty_rows(seed=5, conversations=150):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "well", " \t", "", None, "same.", "ünï …?", "x" * 70_000 + "."]
    rows = []
    for conv in range(conversations):
        for n in range(rng.randint(1, 9)):
            turn = rng.choice([n, n, n, n + 3, None])
            text = rng.choice([f"{rng.random()}.", f"{rng.random()}.", *texts])
            rows.append((conv if conv % 40 else None, turn, rng.choice([*roles[:3] * 3, *roles]), text))
    return [*rows, *rows[:5], (10**15 + 1, -(10**15), "user", "a."), (10**15 + 1, 10**15, "user", "b.")]


@pytest.mark.parametrize("chunk", [1 << 16, 2])
def test_repair_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    rows = nasty_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, present int, cost string").repartition(3)
    assert collected(repair_conversations(damage(df))) == repaired_by_hand(damaged_by_hand(rows))


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op13_conversation_repair"](spark, folder)) == repaired_by_hand(damaged_by_hand(rows))


def test_a_long_conversation_is_repaired_across_batches_and_chunks(spark):
    n = 150_000
    df = spark.range(n).selectExpr(
        "7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('text ', id, '.') text", "true present"
    )
    found = repair_conversations(df).first()
    text = "\n".join(f"{'user' if t % 2 == 0 else 'assistant'}:text {t}." for t in range(n))
    assert tuple(found) == (7, 0, 0, 0, 0, 0, 0, "K" * n, hashlib.sha256(text.encode()).hexdigest())


def test_repaired_turns_alternate_and_hash_to_the_digest(spark):
    rows = nasty_rows(seed=6, conversations=30)
    damaged = damage(spark.createDataFrame(rows, SCHEMA))
    turns = {}
    for r in repair_conversations(damaged, rows=True).collect():
        turns.setdefault(r["conv_id"], []).append((r["position"], r["role"], r["text"]))
    for r in repair_conversations(damaged).collect():
        own = sorted(turns.get(r["conv_id"], []))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in own))
        text = "\n".join(f"{role}:{text}" for _, role, text in own)
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_conversations_that_lose_all_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", False)], f"{SCHEMA}, present boolean")
    assert collected(repair_conversations(df)) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert collected(repair_conversations(df.limit(0))) == []
