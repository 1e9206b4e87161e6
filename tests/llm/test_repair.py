"""Conversation repair: against an exhaustive search, chunked runs against whole ones, and edge cases."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from conftest import SF01
from tessera.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by a search over whole edit strings, cheapest and least first. rows: (role, text, fault)."""
    accept = re.compile("(s?(ua)+)?")
    heap, seen = [(0, 0, "")], set()
    best = {}
    heap = [(0, "", 0, "", ())]  # cost, audit, rows read, initials, lines
    done = None
    while heap:
        cost, audit, i, initials, lines = heapq.heappop(heap)
        if done and cost > done[0]:
            break
        if i == len(rows) and accept.fullmatch(initials):
            if done is None or (cost, audit) < done[:2]:
                done = (cost, audit, lines)
            continue
        mark = (i, initials[-1:], cost, audit)
        if mark in seen:
            continue
        seen.add(mark)
        state = (i, initials[-1:])
        if cost > best.get(state, cost):
            continue
        best[state] = cost
        fits = lambda c: re.fullmatch("s?(ua)*u?", initials + c)
        for c, role in (("u", "user"), ("a", "assistant")):
            if fits(c):
                heapq.heappush(heap, (cost + 3, audit + "I", i, initials + c, (*lines, f"{role}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, initials, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] and fits(role[:1]) and role[:1] in "sua":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, initials + role[:1], (*lines, f"{role}:{text}")))
                for c, other in (("u", "user"), ("a", "assistant")):
                    if fits(c):
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, initials + c, (*lines, f"{other}:{text}")))
    return done


def brute(rows):
    out = {}
    left = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)])
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(n, seed, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool", "u"])
            rows.append((c, rng.choice([t, t, t, None, t + 3]), role, rng.choice(["Yes.", "No", "ok!\n", "", " \t", None, "a?b", f"t{t}."])))
    return rows


@pytest.mark.parametrize("chunk", [R.CHUNK, 2])
def test_repair_equals_exhaustive_search(spark, chunk):
    rows = conversations(120, chunk)
    df = spark.createDataFrame(rows + [(None, 1, "user", "x."), (None, 2, "assistant", "y.")], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in R.summary(df, chunk, 64).collect()}
    assert got == brute(rows + [(None, 1, "user", "x."), (None, 2, "assistant", "y.")])


def test_query_equals_exhaustive_search(spark):
    from tessera.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_turn_repair"](spark, SF01).collect()}
    assert got == brute(rows)


def codes_of(rng, n, kind):
    if kind == "mixed":
        return [rng.randrange(0, 9) for _ in range(n)]
    return [{"users": 1 + 2 * R.U, "dialogue": 1 + 2 * (R.U if i % 2 else R.A), "other": 1, "none": 0}[kind] for i in range(n)]


@pytest.mark.parametrize("kind", ["mixed", "users", "none"])
def test_chunks_converge_to_the_whole_run(spark, kind):
    rng = random.Random(4)
    whole = {c: codes_of(rng, 400 + c, kind) for c in range(3)}
    rows = [(c, k, (len(x) - 1) // 10, k * 10, x[k * 10:k * 10 + 10]) for c, x in whole.items() for k in range(-(-len(x) // 10))]
    chunks = spark.createDataFrame(rows, "conv_id long, chunk long, last long, place long, code array<int>")
    behind, passes = R.converged(chunks)
    assert passes <= 50 and (kind != "mixed" or passes <= 3)
    for r in behind.collect():
        assert tuple(r["behind"]) == R.run_back(whole[r["conv_id"]][(r["chunk"] + 1) * 10:], R.FINAL)
    got = {}
    for r in R.traced(chunks, behind).orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append((r["inserted"], r["edit"]))
    for c, x in whole.items():
        inserted, edits, state = R.trace(x, R.FINAL, R.NONE)
        assert got[c] == [*zip(inserted, edits), ({R.S: "ua", R.U: "a"}.get(state, ""), "")]


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.summary(empty).collect() == []
    names = SCHEMA + ", first boolean, copies long, place long, conv string, chunk long"
    more = (False, 7, 3, "c", 1)
    rows = [(7, t, "user", "same text.") for t in range(300)] + [(8, 1, "assistant", "x" * 2_000_000 + "."), (9, None, None, None)]
    rows += [(10, 4, "user", "twice.")] * 500 + [(d, 1, "user", "a") for d in range(200, 260)]
    got = {r[0]: tuple(r)[1:] for r in R.summary(spark.createDataFrame([r + more for r in rows], names)).collect()}
    small = [r for r in rows if r[0] not in (7, 10)]
    assert {k: v for k, v in got.items() if k not in (7, 10)} == brute(small)
    assert got[10][2] == 500 - 1 + 500 * (zlib.crc32(b"10:4") % 20 == 3) and len(got[10][6]) == got[10][2] + 2
    kept = sum({0: 0, 3: 2}.get(zlib.crc32(f"7:{t}".encode()) % 20, 1) for t in range(300))
    assert got[7][1] + got[7][2] + got[7][3] >= kept - 1 and got[7][6].count("D") >= kept - 3
