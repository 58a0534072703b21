"""Repair of conversations by the cheapest edits, with rank-compressed dynamic programming.

Turns are kept, given another role or deleted, and empty turns inserted, so that the
roles read ``(s?(ua)+)?``. A run of inserts and the turn after it are one macro edit, whose
code is its letters. Codes are prefix-free (only the last letter isn't I) and ordered, so of
two audits of equally many turns the lesser one is known from the rank of its parent and
its last code: states carry a cost, a rank in their layer and a pointer to the parent; the
strings are put together afterwards, along the pointers.

Conversations of any length: turns are numbered by a range partitioning and cut into blocks
of 2^``BITS`` numbers. A block is summed up by the cost and rank of each way from an entry
to an exit state. Such sums compose, up to one for the conversation and down again to each
block's own entry and exit, so no task holds a conversation. Faults are found with column
expressions.

Defined cases: a null role or text is one space. Turns go by number, nulls first; those of
one number by the first 32 characters of role and text and a hash of both, so that equal
rows are neighbours. A null conversation id is a conversation of its own. Empty tables
give empty tables; other columns are left out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import lean, table, written

#: Bits of a turn's place within its block, and of a block's within the group that is composed at once.
BITS = 12
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
KINDS = ["s", "u", "a"]
FAULTS = ["blank", "duplicate", "truncated"]
#: Where an inserted turn, or one of a new role, leads, and the role it has; inserts that end a conversation.
NEXT, ROLE, FINISH = [USER, USER, ASSISTANT, USER], "uuau", [0, 2, 1, 0]
#: Macro edits in the order of their codes.
MACROS = ["D", "ID", "IK", "IR", "K", "R"]
NONE = 1 << 40


@dataclass(frozen=True)
class Costs:
    """What edits cost; inserting must cost something. ``truncated`` is added for each truncated turn that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """By kind of turn, fault, state and macro: the cost, and the state that follows."""
        cost, to = np.full((4, 4, 4, len(MACROS)), NONE, np.int64), np.zeros((4, 4, 4, len(MACROS)), np.int64)
        for kind, fault, state, m in np.ndindex(cost.shape):
            at, c = state, 0
            for letter in MACROS[m]:
                if letter == "D":
                    c += self.delete
                elif letter == "K":
                    allowed = {0: (START,), 1: (START, SYSTEM, ASSISTANT), 2: (USER,), 3: ()}[kind]
                    c, at = c if at in allowed else NONE, (SYSTEM, USER, ASSISTANT, at)[kind]
                else:
                    c, at = c + (self.insert if letter == "I" else self.rerole), NEXT[at]
            if not MACROS[m].endswith("D"):
                c = NONE if fault in (1, 2) else c + self.truncated * (fault == 3)
            cost[kind, fault, state, m], to[kind, fault, state, m] = min(c, NONE), at
        return cost, to


def _layers(kinds, faults, starts, sizes, first, costs: Costs, back: list | None = None):
    """Costs and ranks (block, entry, state) after all turns of each block.

    Blocks are runs of ``sizes`` turns from ``starts``, longest first; ``first`` has their
    costs before the first turn. ``back`` gets an array of parents and macros a layer.
    """
    step, to = costs.tables()
    cost, rank = first.copy(), np.broadcast_to(np.arange(4), first.shape).copy()
    for layer in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -layer, "left"))
        k, f = kinds[starts[:n] + layer], faults[starts[:n] + layer]
        key = np.minimum(cost[:n, :, :, None] + step[k, f][:, None], NONE) << 6 | rank[:n, :, :, None] << 3 | np.arange(len(MACROS))
        target = np.broadcast_to(to[k, f][:, None], key.shape)
        best = np.stack([np.where(target == t, key, NONE << 6).reshape(n, key.shape[1], -1).min(2) for t in range(4)], 2)
        if back is not None:
            parent = np.take_along_axis(np.argsort(rank[:n], 2, kind="stable"), best >> 3 & 7, 2)
            back.append((parent << 3 | best & 7).astype(np.uint8))
        cost[:n] = best >> 6
        rank[:n] = np.argsort(np.argsort(np.where(best >> 6 < NONE, best & 63, 64), 2, kind="stable"), 2, kind="stable")
    return cost, rank


def _compose(a, b):
    """(cost, rank) of one block after another, each by entry and exit state, and the state between."""
    total = np.minimum(a[0][:, :, None] + b[0][None], NONE) << 2 | a[1][:, :, None]
    total = np.where(total >> 2 < NONE, total, NONE << 2)
    mid = total.argmin(1)
    cost = np.take_along_axis(total, mid[:, None], 1)[:, 0] >> 2
    order = np.take_along_axis(a[1], mid, 1) << 2 | b[1][mid, np.arange(4)]
    return (cost, np.argsort(np.argsort(np.where(cost < NONE, order, 16), 1, kind="stable"), 1, kind="stable")), mid


def _ending(cost, rank, costs: Costs) -> np.ndarray:
    """The state in which conversations end best, from the costs and ranks (conversation, state)."""
    return np.where(cost < NONE, (cost + costs.insert * np.array(FINISH)) << 2 | rank, NONE << 3).argmin(1)


def turns(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with each turn's place (``at``), kind, faults of its own and digest, as a table in the shared folder."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    body = F.rtrim("text", F.lit(" \t\n\v\f\r"))
    initial = F.substring("role", 1, 1)
    kind = F.coalesce(*(F.when(initial == x, k) for k, x in enumerate(KINDS)), F.lit(3))
    fault = F.when(body == "", 1).when(~F.substring(body, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    out = rows.select("conv_id", "turn", said("role"), said("text")).select("*", kind.cast("byte").alias("kind"), fault.cast("byte").alias("fault"), digest.alias("digest"))
    # the last key only parts equal rows, of which there may be any number
    order = ["conv_id", "turn", F.left("role", F.lit(32)), F.left("text", F.lit(32)), F.xxhash64("role", "text"), "salt"]
    out = out.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    return written(out.withColumn("at", F.monotonically_increasing_id()), "turns")


def faulty(placed: DataFrame) -> DataFrame:
    """``conv_id``, ``at``, ``kind`` and the first ``fault`` of each turn, duplicates among them, as a table."""
    own = placed.select("conv_id", "at", "kind", "fault", "digest")
    seen = own.filter("fault <> 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "at")
    first = seen.groupBy("c", "d").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("c").alias("c1"), F.col("d").alias("d1"), "first")
    again = seen.join(first, F.col("c").eqNullSafe(F.col("c1")) & (F.col("d") == F.col("d1"))).filter("at > first").select("at", F.lit(True).alias("again"))
    fault = F.when(F.col("again") & (F.col("fault") != 1), 2).otherwise(F.col("fault"))
    return written(own.drop("digest").join(again, "at", "left").select("conv_id", "at", "kind", fault.cast("byte").alias("fault")), "faults")


def _block(level: int) -> Column:
    return F.shiftright("at", BITS).alias("block") if not level else F.shiftright("block", BITS)


SUMS = "conv_id long, block long, cost array<long>, rank array<long>"


def _array(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy(zero_copy_only=False)


def _matrices(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().flatten().to_numpy().reshape(-1, 4, 4)


def _ends(sums: DataFrame, costs: Costs) -> DataFrame:
    """``conv_id``, ``block``, ``entry`` and ``exit`` state of each block, from sums of blocks (a few a conversation at the top)."""
    conv = sums.schema["conv_id"].dataType.simpleString()
    many = sums.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if not many:

        def close(batches):
            for b in batches:
                t = pa.Table.from_batches([b])
                end = _ending(_matrices(t, "cost")[:, START], _matrices(t, "rank")[:, START], costs)
                yield pa.RecordBatch.from_pydict({"conv_id": b.column("conv_id"), "block": b.column("block"), "entry": pa.array(np.zeros(len(end), np.int64)), "exit": pa.array(end)})

        return sums.mapInArrow(close, f"conv_id {conv}, block long, entry long, exit long")

    def up(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        cost, rank = _matrices(t, "cost"), _matrices(t, "rank")
        whole = cost[0], rank[0]
        for k in range(1, len(cost)):
            whole, _ = _compose(whole, (cost[k], rank[k]))
        return pa.table({"conv_id": t.column("conv_id")[:1], "block": pa.array([t.column("block")[0].as_py() >> BITS], pa.int64()), "cost": pa.array([whole[0].ravel()]), "rank": pa.array([whole[1].ravel()])})

    def down(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        cost, rank, between = _matrices(t, "cost"), _matrices(t, "rank"), []
        whole = cost[0], rank[0]
        for k in range(1, len(cost)):
            whole, mid = _compose(whole, (cost[k], rank[k]))
            between.append(mid)
        entry, state = int(_array(t, "entry")[0]), int(_array(t, "exit")[0])
        exits = [state]
        for mid in reversed(between):
            exits.append(int(mid[entry, exits[-1]]))
        exits.reverse()
        return pa.table({"conv_id": t.column("conv_id"), "block": t.column("block"), "entry": pa.array([entry, *exits[:-1]]), "exit": pa.array(exits)})

    keys = ["conv_id", _block(1).alias("above")]
    above = written(sums.groupBy(*keys).applyInArrow(lambda t: up(t), SUMS.replace("long", conv, 1)), "sums")
    top = _ends(above, costs).select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "entry", "exit")
    met = sums.join(top, F.col("conv_id").eqNullSafe(F.col("c")) & (_block(1) == F.col("b"))).drop("c", "b")
    return met.groupBy(*keys).applyInArrow(lambda t: down(t), f"conv_id {conv}, block long, entry long, exit long")


def edits(faults: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``conv_id``, ``at``, ``kind``, ``fault``, and of each turn the macro edit: ``edit`` (its letters; after the last turn also inserts) and ``roles``.

    ``roles`` has a letter for each of ``edit``: ``u`` or ``a`` for new roles, ``k`` for what stays, ``x`` for what goes.
    """
    conv = faults.schema["conv_id"].dataType.simpleString()
    span = faults.groupBy("conv_id").agg(F.min(F.shiftright("at", BITS)).alias("low"), F.max(F.shiftright("at", BITS)).alias("last")).filter("low < last").select(F.col("conv_id").alias("c"), "last")

    def summed(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        first = np.where(np.eye(4, dtype=bool), 0, NONE)[None].astype(np.int64)
        cost, rank = _layers(_array(t, "kind"), _array(t, "fault"), np.zeros(1, np.int64), np.array([t.num_rows]), first, costs)
        return pa.table({"conv_id": t.column("conv_id")[:1], "block": pa.array([t.column("at")[0].as_py() >> BITS], pa.int64()), "cost": pa.array([cost.ravel()]), "rank": pa.array([rank.ravel()])})

    long = faults.join(span, F.col("conv_id").eqNullSafe(F.col("c")))
    sums = written(long.groupBy("conv_id", _block(0)).applyInArrow(summed, SUMS.replace("long", conv, 1)), "sums")
    ends = _ends(sums, costs).select(F.col("conv_id").alias("c"), "block", "entry", "exit")
    ends = ends.join(span.withColumnRenamed("c", "d"), F.col("c").eqNullSafe(F.col("d"))).select("c", "block", "entry", "exit", (F.col("block") < F.col("last")).alias("goes_on"))
    rows = faults.withColumn("part", _block(0)).join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("block")), "left").drop("c", "block")

    words = np.array(MACROS, object)
    roles = np.array([[_roles(m, s) for m in MACROS] for s in range(4)], object)
    tails = np.array([[("I" * FINISH[s], _roles("I" * FINISH[s], s))[k] for s in range(4)] for k in range(2)], object)

    def traced(t: pa.Table) -> pa.RecordBatch:
        part, ids, n = _array(t, "part"), t.column("conv_id").combine_chunks().dictionary_encode(null_encoding="encode"), t.num_rows
        code = ids.indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (code[1:] != code[:-1])])
        sizes = np.diff(np.r_[starts, n])
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        given = t.column("entry").combine_chunks().fill_null(0).to_numpy()[starts]
        first = np.where(np.arange(4) == given[:, None], 0, NONE)[:, None].astype(np.int64)
        back: list[np.ndarray] = []
        cost, rank = _layers(_array(t, "kind"), _array(t, "fault"), starts, sizes, first, costs, back)
        end = t.column("exit").combine_chunks().fill_null(-1).to_numpy()[starts]
        goes_on = t.column("goes_on").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)[starts]
        end = np.where(end < 0, _ending(cost[:, 0], rank[:, 0], costs), end)
        state, macro, before = end.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for layer in range(len(back) - 1, -1, -1):
            k = len(back[layer])
            taken = back[layer][np.arange(k), 0, state[:k]]
            macro[starts[:k] + layer], before[starts[:k] + layer], state[:k] = taken & 7, taken >> 3, taken >> 3
        edit, role = words[macro], roles[before, macro]
        last = (starts + sizes - 1)[~goes_on]
        edit[last] += tails[0][end[~goes_on]]
        role[last] += tails[1][end[~goes_on]]
        names = ("conv_id", "at", "kind", "fault")
        return pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in names), pa.array(edit, pa.string()), pa.array(role, pa.string())], [*names, "edit", "roles"])

    def work(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            part = b.column("part").to_numpy()
            if len(part) and part[0] != part[-1] or len(held) > 1 and len(part) and part[0] != held[0].column("part")[0].as_py():
                t = pa.Table.from_batches(held)
                all_parts = _array(t, "part")
                whole = int(np.searchsorted(all_parts, all_parts[-1]))
                if whole:
                    yield traced(t.slice(0, whole))
                held = t.slice(whole).to_batches()
        if held and (t := pa.Table.from_batches(held)).num_rows:
            yield traced(t)

    return rows.repartition("part").sortWithinPartitions("part", "at").mapInArrow(lean(work), f"conv_id {conv}, at long, kind byte, fault byte, edit string, roles string")


def _roles(letters: str, state: int) -> str:
    """The letter of the new role of each edit from ``state`` on."""
    out = ""
    for letter in letters:
        out += {"K": "k", "D": "x"}.get(letter, ROLE[state])
        state = NEXT[state] if letter in "IR" else state
    return out


def repaired(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The repaired turns: ``conv_id``, ``at`` and ``piece`` (their order), ``turn`` (null for inserts), ``edit``, ``role``, ``text``."""
    placed = turns(rows)
    done = edits(faulty(placed), costs).select("at", "edit", "roles")
    each = placed.join(done, "at").withColumn("piece", F.explode(F.sequence(F.lit(1), F.length("edit"))))
    letter, new = (F.substr(c, F.col("piece"), F.lit(1)) for c in ("edit", "roles"))
    role = F.when(new == "u", "user").when(new == "a", "assistant").otherwise(F.col("role"))
    own = letter != "I"
    return each.select("conv_id", "at", "piece", F.when(own, F.col("turn")).alias("turn"), letter.alias("edit"), role.alias("role"), F.when(own, F.col("text")).otherwise("").alias("text")).filter("edit <> 'D'")


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Audit:
    """What is said of a conversation, from its turns in order."""

    def __init__(self, conv):
        self.conv, self.low, self.last, self.distinct, self.before = conv, None, None, 0, None
        self.faults, self.illegal, self.cost, self.audit, self.sha, self.lines = [0] * 4, 0, 0, [], hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def add(self, turn, role: str, text: str, fault: int, edit: str, roles: str, costs: Costs) -> None:
        if turn is not None and turn != self.last:
            self.low, self.last, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1
        self.faults[fault] += 1
        self.illegal += self.before is not None and (self.before + role[:1]) not in ("su", "ua", "au")
        self.before = role[:1]
        self.audit.append(edit)
        for letter, new in zip(edit, roles):
            self.cost += {"I": costs.insert, "R": costs.rerole, "D": costs.delete}.get(letter, 0) + (costs.truncated if letter in "KR" and fault == 3 else 0)
            if letter != "D":
                self.line({"u": "user", "a": "assistant"}.get(new, role), "" if letter == "I" else text)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.last - self.low + 1 - self.distinct
        return self.conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def audited(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """A row for each conversation: faults, cost, audit and the digest of its repaired turns.

    Texts and edits of a conversation meet as one sorted stream, so a task holds one turn
    of it and its audit; the digest is one chain over all turns, and so is made in one task.
    """
    placed = turns(rows)
    conv = rows.schema["conv_id"].dataType.simpleString()
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    told = edits(faulty(placed), costs).select("conv_id", "at", F.lit(None).cast("long").alias("turn"), *none("role", "text"), "fault", "edit", "roles")
    own = placed.select("conv_id", "at", F.col("turn").cast("long").alias("turn"), "role", "text", "fault", *none("edit", "roles"))
    stream = told.union(own).repartition("conv_id").sortWithinPartitions("conv_id", "at", "edit")

    def work(batches):
        held, turn = None, None
        for b in batches:
            out = []
            for c, t, role, text, fault, edit, roles in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "edit", "roles"))):
                if edit is None:
                    turn = t, role, text
                    continue
                if held is None or held.conv != c:
                    if held:
                        out.append(held.row())
                    held = _Audit(c)
                held.add(*turn, fault, edit, roles, costs)
            yield _audits(out, b.schema.field("conv_id").type)
            kind = b.schema.field("conv_id").type
        if held:
            yield _audits([held.row()], kind)

    return stream.mapInArrow(lean(work), f"conv_id {conv}, {AUDIT}")


def _audits(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *(x.split()[0] for x in AUDIT.split(", "))]
    types = [kind, *(pa.string() if x.endswith("string") else pa.int64() for x in AUDIT.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with planted faults, chosen by the CRC of ``conv_id:turn`` (nulls: one space)."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(code == 4, "user").otherwise(said("role"))
    times = F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.filter(code != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations``, damaged by a rule and repaired: a row for each ``conv_id`` that the table has."""
    rows = table(spark, sf_dir, "conversations")
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    out = ids.join(audited(damaged(rows)), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
