"""Repaired conversations against a search over whole audit strings."""

import hashlib
import zlib

import duckdb
import pyarrow.parquet as pq
import pytest

from tessera.llm import conversations as C
from tessera.llm import queries

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\v\f\r"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(turns):
    out, seen = [], set()
    for role, text in turns:
        body = text.rstrip(SPACE)
        out.append("blank" if not body.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(turns):
    """Cost, audit and lines of the best of all edit sequences: whole strings, no ranks."""
    best = {"": (0, "", ())}

    def put(to, state, value):
        if state is not None and (state not in to or value[:2] < to[state][:2]):
            to[state] = value

    def inserts(states):
        for _ in range(2):
            for s, (c, a, x) in list(states.items()):
                for r in "ua":
                    put(states, STEPS.get((s, r)), (c + 5, a + "I", (*x, ({"u": "user", "a": "assistant"}[r], ""))))
        return states

    for (role, text), fault in zip(turns, faults(turns)):
        best, after = inserts(best), {}
        for s, (c, a, x) in best.items():
            put(after, s, (c + 2, a + "D", x))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            put(after, STEPS.get((s, role[:1])), (c + more, a + "K", (*x, (role, text))))
            for r in "ua":
                put(after, STEPS.get((s, r)), (c + more + 1, a + "R", (*x, ({"u": "user", "a": "assistant"}[r], text))))
        best = after
    best = inserts(best)
    return min(v for s, v in best.items() if s in ("", "a"))


def audit(turns, numbers):
    f = faults(turns)
    cost, edits, kept = cheapest(turns)
    known = [n for n in numbers if n is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return gaps, *(f.count(x) for x in C.FAULTS), sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, sha


def grouped(rows):
    """Turns (conversation, turn, role, text), nulls as spaces, by conversation and in order."""
    out = {}
    said = [(c, n, *(" " if x is None else x for x in rest)) for c, n, *rest in rows]
    for c, *turn in sorted(said, key=lambda r: (r[1] is not None, r[1] or 0, *r[2:])):
        out.setdefault(c, []).append(turn)
    return out


def damaged(rows):
    for c, n, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if n is None else n}".encode()) % 20
        text = " " if text is None else text
        text = "" if code == 1 else "".join(x for x in text if x not in ".!?") if code == 2 else text
        yield from [(c, n, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)


def want(rows):
    return {c: audit([(r, t) for _, r, t in x], [n for n, _, _ in x]) for c, x in grouped(rows).items()}


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_op11_is_the_cheapest_repair(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet").select(["conv_id", "turn", "role", "text"]).to_pylist()]
    expected = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in rows} | want(damaged(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    sql = con.execute(f"SELECT conv_id, {', '.join(NAMES)} FROM ({queries.ORACLE_SQL['op11_conversations']})").fetchall()
    assert found(C.op11_conversations(spark, SF)) == expected == {r[0]: r[1:] for r in sql}


SCHEMA = "conv_id long, turn long, role string, text string, kind string, at string, edit string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def many(n, seed=3, conversations=4):
    import random

    draw = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No", "", None, " \t", "Why?", "so\n", "x.", "y!", "z"]
    for _ in range(n):
        yield draw.choice([*range(conversations), None]), draw.choice([None, *range(3 * n)]), draw.choice(roles[:2] * 4 + roles), draw.choice(texts) if draw.random() < 0.3 else f"{draw.random()}."


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_blocks_of_any_size_compose(spark, monkeypatch, bits):
    """With blocks of two turns a conversation is summed up over several levels."""
    monkeypatch.setattr(C, "BITS", bits)
    rows = list(many(150)) + [(7, None, "user", "same.")] * 40 + [(8, 1, "user", "Hi."), (9, 5, "assistant", "cut")]
    assert found(C.audited(frame(spark, rows))) == want(rows)


def test_costs_are_parameters(spark):
    rows = frame(spark, [(1, 0, "user", "a."), (1, 1, "user", "b.")])
    assert [r.audit for r in C.audited(rows).collect()] == ["KR"]
    assert [r.audit for r in C.audited(rows, C.Costs(rerole=9, delete=9, insert=1)).collect()] == ["KIKI"]


def test_repaired_turns_make_the_digest(spark):
    rows = list(many(60, seed=5))
    lines = {}
    for r in sorted(C.repaired(frame(spark, rows)).collect(), key=lambda r: (r.at, r.piece)):
        assert (r.edit == "I") <= (r.turn is None and r.text == "")
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    sha = {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()}
    assert all(sha.get(c, hashlib.sha256(b"").hexdigest()) == v[-1] for c, v in want(rows).items())


def test_empty_table_and_blank_conversations(spark):
    assert C.audited(frame(spark, [])).collect() == [] and C.repaired(frame(spark, [])).collect() == []
    long = "word " * 200_000 + "end."
    assert found(C.audited(frame(spark, [(1, 0, None, None), (2, 0, "user", long), (2, 1, "assistant", "Ok.")]))) == want([(1, 0, None, None), (2, 0, "user", long), (2, 1, "assistant", "Ok.")])
