"""Conversation repair against an enumeration of whole scripts."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import duckdb
import pytest

from termloom.llm import conversations as C
from termloom.llm.queries import op11_conversation_repair

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        at = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if at == 0:
            continue
        text = "" if at == 1 else "".join(c for c in text if c not in ".!?") if at == 2 else text
        out += [(conv, turn, "user" if at == 4 else role, text)] * (2 if at == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACES)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, repaired rows) by the cheapest, then least, of all ways to go on from each place."""
    faults = plain_faults(rows)

    @lru_cache(None)
    def rest(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        after, name = ("a", "assistant") if last == "u" else ("u", "user")
        if inserts < 3:
            cost, audit, kept = rest(i, after, inserts + 1)
            ways.append((cost + 5, "I" + audit, ((name, ""), *kept)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, kept = rest(i + 1, last, 0)
            ways.append((cost + 2, "D" + audit, kept))
            more = 5 if faults[i] == "truncated" else 0
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] == after or (role[:1] == "s" and last == ""):
                    cost, audit, kept = rest(i + 1, role[0], 0)
                    ways.append((cost + more, "K" + audit, ((role, text), *kept)))
                cost, audit, kept = rest(i + 1, after, 0)
                ways.append((cost + more + 1, "R" + audit, ((name, text), *kept)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, kept = rest(0, "", 0)
    return cost, audit, list(kept)


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], [])
    for row in plain_damage(rows):
        groups[row[0]].append(row)
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults, turns = plain_faults(own), [r[1] for r in own if r[1] is not None]
        cost, audit, kept = plain_repair(own)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df):
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def table_of(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_query_against_the_plain_repair(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert got(op11_conversation_repair(spark, SF)) == expected(rows)


def some_rows(seed, n=400):
    rng = random.Random(seed)
    texts = ["yes.", "no", " \t", "", None, "what?", "a b c!", "end. \n"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "U", "u"]
    out, used = [], set()
    for _ in range(n):
        key = (rng.choice([1, 2, 3, 4, None, *range(100, 130)]), rng.choice([None, *range(30)]))
        if key not in used:  # rows of one turn differ in nothing, see test_ties
            used.add(key)
            out += [(*key, rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 2])
    return out


@pytest.mark.parametrize(("seed", "segment"), [(1, 4096), (2, 3), (3, 2), (4, 1)])
def test_hard_rows_whole_and_in_segments(spark, tmp_path, monkeypatch, seed, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rows = some_rows(seed)
    own, size = C._segments, segment

    def smaller(batches):  # the workers have the module as it is
        C.SEGMENT = size
        yield from own(batches)

    monkeypatch.setattr(C, "_segments", smaller)
    assert got(op11_conversation_repair(spark, table_of(spark, tmp_path, rows))) == expected(rows)


def test_empty_ties_clashing_and_lost(spark, tmp_path):
    assert op11_conversation_repair(spark, table_of(spark, tmp_path / "none", [])).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert got(op11_conversation_repair(spark, table_of(spark, tmp_path / "lost", [(lost, 0, "user", "a.")]))) == {
        lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    rows = [("x", 1, "user", "b.", 1, 2), ("x", 1, "assistant", "a.", 1, 2), ("x", 1, "user", "b.", 1, 2), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, place long, audit long")
    out = {r["conv_id"]: r for r in C.audits(df).collect()}
    assert (out["x"]["audit"], out["x"]["cost"], out["x"]["duplicate"], out["x"]["gaps"]) == ("RRD", 4, 1, 0)  # assistant, user, user again
    assert (out[None]["audit"], out[None]["blank"], out[None]["gaps"]) == ("D", 1, 0)
    again = C.audits(df.orderBy(df["text"].desc()))
    assert sorted(map(str, again.collect())) == sorted(map(str, C.audits(df).collect()))


def test_repaired_rows_and_their_digest(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("assistant", "a."), ("user", "b."), ("user", "c."), ("system", "s."), ("assistant", "d.")])]
    df = spark.createDataFrame(rows * 1 + [(2, 0, "user", "")], SCHEMA)
    audited = C.audits(df)
    kept = [(r["conv_id"], r["nth"], r["role"], r["text"]) for r in C.repaired(df, audited).orderBy("conv_id", "nth").collect()]
    _, audit, plain = plain_repair(rows)
    assert kept == [(1, i, r, t) for i, (r, t) in enumerate(plain)]
    digest = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in C.digests(df, audited).collect()}
    assert digest == {1: (audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in plain).encode()).hexdigest()), 2: ("D", hashlib.sha256(b"").hexdigest())}


def test_a_long_conversation(spark):
    rng = random.Random(5)
    rows = [(9, i, rng.choice(["user", "assistant", "system", "x"]), f"t {i}" + rng.choice([".", "", "!"])) for i in range(9000)]
    df = spark.createDataFrame(rows + [(i, 0, "user", "q?") for i in range(20, 60)], SCHEMA)
    out = {r["conv_id"]: r for r in C.audits(df).collect()}

    def least(rows):  # costs alone, from the front
        best = {"": 0}
        for (_, _, role, _), fault in zip(rows, plain_faults(rows)):
            step = {}
            for last in ("", "s", "u", "a"):
                if last in best:
                    best["a" if last == "u" else "u"] = min(best.get("a" if last == "u" else "u", 10**9), best[last] + 5)
            for last, cost in best.items():
                after, more = "a" if last == "u" else "u", 5 * (fault == "truncated")
                ways = [(last, 2), (after, 1 + more)] + ([(role[0], more)] if role[0] == after or (role[0] == "s" and last == "") else [])
                for state, extra in ways:
                    step[state] = min(step.get(state, 10**9), cost + extra)
            best = step
        return min(best.get("", 10**9), best.get("a", 10**9), best.get("u", 10**9) + 5)

    assert out[9]["cost"] == least(rows) and len(out[9]["audit"]) >= 9000 and out[9]["gaps"] == 0
    one = C.best_scripts([int(c) for c in codes(rows)], 0)
    assert (out[9]["cost"], out[9]["audit"]) == min(one[s] for s in (C.EMPTY, C.ASSISTANT) if s in one)


def codes(rows):
    flags = {"": 0, "blank": C.BLANK, "truncated": C.TRUNCATED, "duplicate": C.DUPLICATE}
    return ["sua".find(r[2][:1]) % 4 + flags[f] for r, f in zip(rows, plain_faults(rows))]


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7, 2, 1])
def test_scripts_with_colliding_hashes(modulus):
    rng = random.Random(modulus)
    for _ in range(60):
        rows = [(1, i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c?", f"{i}.", f"{i}"])) for i in range(rng.randint(0, 14))]
        own = C.best_scripts(codes(rows), C.EMPTY, modulus)
        assert min(own[s] for s in (C.EMPTY, C.ASSISTANT) if s in own) == plain_repair(rows)[:2]


def test_prefix_order():
    tree = C.Prefixes(modulus=3)
    rng = random.Random(1)
    nodes = {"": 0}
    for _ in range(300):
        parent = rng.choice(list(nodes))
        for edit in "DIKR":
            if parent + edit not in nodes:
                nodes[parent + edit] = tree.grow(nodes[parent], edit)
    names = rng.sample(list(nodes), 200)
    for a, b in zip(names, names[1:]):
        assert tree.before(nodes[a], nodes[b]) == (a < b) and tree.spelled(nodes[a]) == a
