"""Cheapest repair of conversations to the form `(system? (user assistant)+)?`.

A conversation's rows are read in order of turn. Each is kept, given another role or
deleted, and rows with empty text may be inserted; the script of these edits is its
audit. The cheapest audit is found by dynamic programming over four states (nothing
yet, after a system, user or assistant row). Prefixes of audits are shared as linked
nodes; two of equal cost are compared at their first difference, which is searched by
binary lifting over rolling hashes and then verified.

No conversation is held as a whole. Its rows get places by a range sort without their
texts, and are taken in segments of bounded length; a segment gives the best audit from
each state to each, and these are put together. Texts are shuffled once, and flow past
the audit one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from termloom.llm.shared import few, settled

SPACES = " \t\n\x0b\f\r"
#: Rows of a conversation that are taken at once; places of one partition are below 2**33.
SEGMENT = 4096
DELETE, RELABEL, INSERT, KEEP_TRUNCATED = 2, 1, 5, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a row of the initial `sua`[i] leads to from each state, by i; the last of each is what another role becomes.
NEXT_KEPT = [{EMPTY: SYSTEM}, {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {}]
NEXT_MADE = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
BLANK, TRUNCATED, DUPLICATE = 4, 8, 16


class Prefixes:
    """Edit scripts as a tree: a node is its parent's script and one edit more.

    Every node keeps its ancestors at distances of powers of two and a rolling hash.
    Scripts that are equal are the same node as long as no edit is added twice to one.
    """

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 1_000_003):
        self.modulus, self.base = modulus, base
        self.edit, self.depth, self.print, self.up = [""], [0], [0], [[]]

    def grow(self, parent: int, edit: str) -> int:
        ups, k = [parent], 0
        while k < len(self.up[ups[k]]):
            ups.append(self.up[ups[k]][k])
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.print.append((self.print[parent] * self.base + ord(edit)) % self.modulus)
        self.up.append(ups)
        return len(self.edit) - 1

    def lifted(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def before(self, one: int, other: int) -> bool:
        """Whether the script of `one` comes before that of `other`; a prefix comes first."""
        depth = min(self.depth[one], self.depth[other])
        a, b = self.lifted(one, self.depth[one] - depth), self.lifted(other, self.depth[other] - depth)
        if a == b:
            return self.depth[one] < self.depth[other]
        if self.print[a] != self.print[b]:
            for k in range(len(self.up[a]) - 1, -1, -1):
                if k < len(self.up[a]) and self.print[self.up[a][k]] != self.print[self.up[b][k]]:
                    a, b = self.up[a][k], self.up[b][k]
        # equal hashes prove nothing: below the first difference both have the same parent
        while self.up[a][0] != self.up[b][0]:
            a, b = self.up[a][0], self.up[b][0]
        return self.edit[a] < self.edit[b]

    def spelled(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def best_scripts(codes: list[int], start: int, modulus: int = (1 << 61) - 1) -> dict[int, tuple[int, str]]:
    """For each state that can be reached from `start` over these rows: least cost, and the least script of that cost."""
    tree = Prefixes(modulus)
    best: dict[int, tuple[int, int]] = {start: (0, 0)}

    def offer(found: dict, state: int, cost: int, parent: int, edit: str) -> None:
        # a candidate becomes a node when it is compared, and at the end of the row
        known = found.get(state)
        if known is None or cost < known[0]:
            found[state] = (cost, parent, edit, None)
        elif cost == known[0]:
            old = tree.grow(known[1], known[2]) if known[3] is None else known[3]
            new = tree.grow(parent, edit)
            found[state] = (cost, parent, edit, new) if tree.before(new, old) else (*known[:3], old)

    def nodes(found: dict) -> dict[int, tuple[int, int]]:
        return {s: (c, tree.grow(p, e) if n is None else n) for s, (c, p, e, n) in found.items()}

    def with_inserts(best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        for target, sources in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            found: dict = {}
            for s in sources:
                if s in best:
                    offer(found, target, best[s][0] + INSERT, best[s][1], "I")
            for cost, node in nodes(found).values():
                if target not in best or cost < best[target][0] or (cost == best[target][0] and tree.before(node, best[target][1])):
                    best = best | {target: (cost, node)}
        return best

    best = with_inserts(best)
    for code in codes:
        found: dict = {}
        more = KEEP_TRUNCATED if code & TRUNCATED else 0
        for state, (cost, node) in best.items():
            offer(found, state, cost + DELETE, node, "D")
            if not code & (BLANK | DUPLICATE):
                if state in NEXT_KEPT[code & 3]:
                    offer(found, NEXT_KEPT[code & 3][state], cost + more, node, "K")
                offer(found, NEXT_MADE[state], cost + more + RELABEL, node, "R")
        best = with_inserts(nodes(found))
    return {state: (cost, tree.spelled(node)) for state, (cost, node) in best.items()}


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, role, text, print; the print is that of the conversation, role and text together."""
    known = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    own = F.col("conv_id").cast("string")
    sizes = F.concat_ws(",", F.coalesce(F.length(own), F.lit(-1)).cast("string"), F.length("role").cast("string"))
    of = F.concat(sizes, F.lit(":"), F.coalesce(own, F.lit("")), F.col("role"), F.col("text"))
    return known.withColumn("print", F.unhex(F.sha2(of, 256)))


def _code() -> Column:
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(body == "", BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    return (kind + fault).cast("int")


def _segment_fields(conv: StructField) -> StructType:
    out = StructType([conv])
    for name in ("segment", "blank", "duplicate", "truncated", "illegal", "first_kind", "last_kind", "turns", "least", "most"):
        out = out.add(name, "long")
    return StructType([*out.fields, *StructType.fromDDL("scripts array<struct<start: int, end: int, cost: bigint, script: string>>").fields])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for of, rows in zip(batch.column("segment").to_pylist(), batch.column("rows").to_pylist(), strict=True):
            codes, turns = [r["code"] for r in rows], [r["turn"] for r in rows if r["turn"] is not None]
            kinds = [c & 3 for c in codes]
            faults = [sum(bool(c & BLANK) for c in codes), sum((c & (BLANK | DUPLICATE)) == DUPLICATE for c in codes), sum((c & (TRUNCATED | DUPLICATE)) == TRUNCATED for c in codes)]
            # a conversation that began before has its first row here at the segment's own beginning
            starts = range(4) if rows[0]["place"] % SEGMENT == 0 else (EMPTY,)
            scripts = [{"start": s, "end": e, "cost": c, "script": x} for s in starts for e, (c, x) in best_scripts(codes, s).items()]
            out.append((of, *faults, sum(map(_illegal, kinds, kinds[1:])), kinds[0], kinds[-1], len(set(turns)), min(turns, default=None), max(turns, default=None), scripts))
        kept = list(zip(*out, strict=True)) if out else [[]] * 11
        fields = [pa.int64()] * 10 + [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("script", pa.string())]))]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, t) for c, t in zip(kept, fields, strict=True))],
                                         ["conv_id", "segment", "blank", "duplicate", "truncated", "illegal", "first_kind", "last_kind", "turns", "least", "most", "scripts"])


def _illegal(one: int, other: int) -> bool:
    return (one, other) not in ((0, 1), (1, 2), (2, 1))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            best, turns, last = {EMPTY: (0, "")}, 0, None
            for part in parts:
                found: dict[int, tuple[int, str]] = {}
                for s in part["scripts"]:
                    if s["start"] in best:
                        cost, script = best[s["start"]]
                        here = (cost + s["cost"], script + s["script"])
                        found[s["end"]] = min(found.get(s["end"], here), here)
                best = found
                turns += part["turns"] - (last is not None and last == part["least"])
                last = part["most"] if part["most"] is not None else last
            low = [p["least"] for p in parts if p["least"] is not None]
            illegal = sum(p["illegal"] for p in parts) + sum(_illegal(p["last_kind"], q["first_kind"]) for p, q in zip(parts, parts[1:], strict=False))
            cost, audit = min(best[s] for s in (EMPTY, ASSISTANT) if s in best)
            out.append((last - low[0] + 1 - turns if low else 0, *(sum(p[n] for p in parts) for n in names[1:4]), illegal, cost, audit))
        kept = list(zip(*out, strict=True)) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, pa.int64()) for c in kept[:6]), pa.array(kept[6], pa.string())], ["conv_id", *names, "audit"])


def audits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: one row per conversation.

    A null role or text counts as one space, and so as blank; a null conversation id is
    a conversation of its own. Rows are taken by turn, nulls first, and those of one turn by
    role and a hash of the text, so that repeated rows and ties have one order. Empty tables
    give no rows; extra columns are not read. A row's first fault counts: blank, duplicate
    (its role and text seen earlier), truncated (it does not end in `.`, `!` or `?`).
    gaps are the turns missing between the smallest and the greatest. The audit has one
    letter per edit: K keep, R give another role, D delete, I insert.
    """
    known = _prepared(rows, conv, turn, role, text).select("conv_id", "turn", "role", "print", _code().alias("code"))
    order = ["conv_id", "turn", "role", "print"]
    placed = settled(
        known.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("place"), "conv_id", "turn", "print", "code"), "turns")
    repeated = placed.groupBy("print").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("print", "first")
    again = F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    coded = placed.join(repeated, "print", "left").select("conv_id", "place", "turn", (F.col("code") + F.when(again, DUPLICATE).otherwise(0)).alias("code"))
    segments = coded.groupBy("conv_id", F.expr(f"place div {SEGMENT}").alias("segment")).agg(F.sort_array(F.collect_list(F.struct("place", "turn", "code"))).alias("rows"))
    fields = _segment_fields(placed.schema["conv_id"])
    parts = segments.mapInArrow(_segments, fields)
    rest = [n for n in fields.names if n not in ("conv_id", "segment")]
    together = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", F.struct(*rest).alias("part")))).alias("parts"))
    out = StructType([placed.schema["conv_id"]])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        out = out.add(name, LongType())
    return together.select("conv_id", F.col("parts.part").alias("parts")).mapInArrow(_whole, out.add("audit", "string"))


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, str | None, str | None]]:
    """(audit row, role, text) of every row of the repaired conversations, in order; after each the audit row alone."""
    at: dict | None = None
    place, state = 0, EMPTY

    def made() -> str:
        nonlocal state
        state = NEXT_MADE[state]
        return "user" if state == USER else "assistant"

    def inserted() -> Iterator[tuple[dict, str, str]]:
        nonlocal place
        while place < len(at["audit"]) and at["audit"][place] == "I":
            place += 1
            yield at, made(), ""

    for batch in few(batches):
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if at is not None:
                    yield from inserted()
                    yield at, None, None
                at, place, state = row, 0, EMPTY
                continue
            yield from inserted()
            edit = at["audit"][place]
            place += 1
            if edit == "K":
                state = NEXT_KEPT["sua".index(row["role"][0])][state]
                yield at, row["role"], row["text"]
            elif edit == "R":
                yield at, made(), row["text"]
    if at is not None:
        yield from inserted()
        yield at, None, None


def _beside(rows: DataFrame, audited: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every conversation's audit row, and its own rows in order after it, in one partition."""
    order = ["turn", "role", "print"]
    lines = _prepared(rows, conv, turn, role, text)
    both = audited.unionByName(lines, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *order).drop("print")


def repaired(rows: DataFrame, audited: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, nth, role, text: the rows of the repaired conversations, nth from 0.

    `audited` is what `audits` gave for the same rows. A conversation of which nothing
    stays has no rows.
    """
    schema = StructType([audited.schema["conv_id"]]).add("nth", "long").add("role", "string").add("text", "string")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, nth, kinds = [], 0, {}
        for at, own_role, own_text in _followed(_typed(batches, kinds)):
            if own_role is None:
                nth = 0
                continue
            out.append((at["conv_id"], nth, own_role, own_text))
            nth += 1
            if len(out) == 1024:
                yield _batch(out, kinds["conv_id"], [pa.int64(), pa.string(), pa.string()], schema.names)
                out = []
        if out:
            yield _batch(out, kinds["conv_id"], [pa.int64(), pa.string(), pa.string()], schema.names)

    return _beside(rows, audited, conv, turn, role, text).mapInArrow(follow, schema)


def digests(rows: DataFrame, audited: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The columns of `audited` and repaired_sha256, that of the `role:text` of the repaired rows, joined by line feeds.

    The rows are those of `repaired`; none of them is kept.
    """
    schema = StructType([*audited.schema.fields]).add("repaired_sha256", "string")
    names = audited.columns

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own, first, kinds = [], hashlib.sha256(), True, {}
        for at, own_role, own_text in _followed(_typed(batches, kinds)):
            if own_role is not None:
                own.update(("" if first else "\n").encode() + f"{own_role}:{own_text}".encode())
                first = False
                continue
            out.append((*(at[n] for n in names), own.hexdigest()))
            own, first = hashlib.sha256(), True
            if len(out) == 1024:
                yield _batch(out, kinds["conv_id"], [kinds[n] for n in names[1:]] + [pa.string()], schema.names)
                out = []
        if out:
            yield _batch(out, kinds["conv_id"], [kinds[n] for n in names[1:]] + [pa.string()], schema.names)

    return _beside(rows, audited, conv, turn, role, text).mapInArrow(follow, schema)


def _typed(batches: Iterator[pa.RecordBatch], kinds: dict) -> Iterator[pa.RecordBatch]:
    """The batches, and the types of their columns in `kinds` as soon as one is read."""
    for batch in batches:
        kinds.update({f.name: f.type for f in batch.schema})
        yield batch


def _batch(rows: list[tuple], conv: pa.DataType, rest: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [conv, *rest], strict=True)], names)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults set by crc32 of `conv_id:turn`, modulo 20; nulls are one space there, and as role or text.

    0 drops the row, 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3 repeats it,
    4 makes it a user's.
    """
    space = F.lit(" ")
    at = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    return (
        rows.select("conv_id", "turn", "role", "text", at.alias("_at")).where("_at <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("_at") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
            F.when(F.col("_at") == 1, "").when(F.col("_at") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_at") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
        .drop("_copy")
    )
