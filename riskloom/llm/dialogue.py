"""Repair of conversation structure by a survivor-coalescence Viterbi (operator 13).

Turns are edited at least cost until their roles read ``(s?(ua)+)?`` by
initial.  The search walks over the rows with four states (nothing yet, after
the system turn, after a user turn, after an assistant turn) and keeps for each
state the survivor: its cheapest edits, of those the ASCII-least.

Survivors are leaves of a tree of back pointers.  A node holds the edits since
its parent and counts its references (children, and a survivor that ends
there); a node without references is dropped, and a chain becomes one node, so
the tree has at most seven.  Once all survivors share an ancestor, the edits up
to it are certain: they are emitted and the ancestor becomes the root.  Only
edits behind the root, the unresolved suffixes, are held.

Ties compare complete unresolved suffixes.  An edit of a row is any number of
insertions and one of D, K, R, so of two different suffixes over the same rows
neither begins the other, and their order is that of the first difference.
So the order of all survivors is kept as a rank: that of the parent's suffix
first, the row's edits second.  No suffix is read again to be compared.

A survivor that costs more than another one plus what it takes to do from there
whatever it can do is on no cheapest path and is dropped: this lets the rest
coalesce (a survivor that deleted everything would never share an ancestor).

Two passes read the turns in order: the first, over flags without texts, finds
the edits; the second applies them to the texts as they stream by.  So a task
holds a conversation's edits, a byte each, but never its texts, however long it
is.  The digest of the repaired texts is sequential: a conversation's rows meet
in one task, sorted (with spilling), and are never gathered.

Defined results: nulls in role and text are one space, in conversation and turn
as well where the rows are damaged; rows without a conversation number form a
conversation; rows of one turn come by role and then by SHA-256 of the text;
repeated rows are duplicates; a role with another initial than s, u, a can only
be given a new role or be deleted; a conversation whose rows were all dropped
has zeros, an empty audit and the digest of the empty string; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import parts, save

RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
# state after a role's initial; a missing pair is not allowed
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
# what comes next, for a new role and for an insertion
WANTED = {START: "u", SYSTEM: "u", ASSISTANT: "u", USER: "a"}
ROLES = {"u": "user", "a": "assistant"}
# COVER[y][x]: from state y, all that can follow state x costs at most that much more
COVER = {START: {SYSTEM: 0, USER: 3, ASSISTANT: 0}, SYSTEM: {START: 10, USER: 3, ASSISTANT: 6},
         USER: {START: 7, SYSTEM: 3, ASSISTANT: 3}, ASSISTANT: {START: 4, SYSTEM: 0, USER: 3}}


def _insertions(state: int) -> list[tuple[int, int]]:
    """States after none, one and two insertions, with their number; three only repeat one."""
    out = [(state, 0)]
    for k in (1, 2):
        state = NEXT[state, WANTED[state]]
        out.append((state, k))
    return out


INSERTIONS = {s: _insertions(s) for s in range(4)}


class _Node:
    __slots__ = ("edits", "parent", "refs")

    def __init__(self, edits: bytes, parent: _Node | None, refs: int):
        self.edits, self.parent, self.refs = bytearray(edits), parent, refs


class Survivors:
    """The cheapest edits of one conversation, row by row; ``done`` holds the certain ones."""

    def __init__(self):
        self.done = bytearray()
        self.root = _Node(b"", None, 1)
        self.live = {START: (0, 0, self.root)}  # state: cost, rank, leaf

    def _moves(self, initial: str, forced: bool, truncated: bool) -> Iterator[tuple]:
        extra = TRUNCATED if truncated else 0
        for state, (cost, rank, _) in self.live.items():
            for at, k in INSERTIONS[state]:
                c = cost + k * INSERT
                yield c + DELETE, rank, b"I" * k + b"D", state, at
                if not forced:
                    if (at, initial) in NEXT:
                        yield c + extra, rank, b"I" * k + b"K", state, NEXT[at, initial]
                    yield c + RETAG + extra, rank, b"I" * k + b"R", state, NEXT[at, WANTED[at]]

    def row(self, initial: str, forced: bool, truncated: bool) -> None:
        best: dict[int, tuple] = {}
        for cost, rank, edits, origin, to in self._moves(initial, forced, truncated):
            if to not in best or (cost, rank, edits) < best[to][:3]:
                best[to] = (cost, rank, edits, origin)
        kept = {x: b for x, b in best.items() if not any(b[0] > best[y][0] + COVER[y][x] for y in best if y != x)}
        order = {x: i for i, x in enumerate(sorted(kept, key=lambda x: kept[x][1:3]))}
        fresh = {}
        for x, (cost, _, edits, origin) in kept.items():
            parent = self.live[origin][2]
            parent.refs += 1
            fresh[x] = (cost, order[x], _Node(edits, parent, 1))
        for _, _, leaf in self.live.values():
            while leaf is not None:  # the old survivor no longer ends here
                leaf.refs -= 1
                leaf = leaf.parent if leaf.refs == 0 else None
        self.live = fresh
        self._squeeze()

    def _squeeze(self) -> None:
        """Join chains, then move what all survivors share from the tree to ``done``."""
        while True:
            nodes = {}
            for _, _, n in self.live.values():
                while n is not None and id(n) not in nodes:
                    nodes[id(n)] = n
                    n = n.parent
            chain = next((n for n in nodes.values() if n.parent not in (None, self.root) and n.parent.refs == 1), None)
            if chain is not None:  # the only child joins its parent
                into = chain.parent
                into.edits += chain.edits
                into.refs = chain.refs
                for n in nodes.values():
                    if n.parent is chain:
                        n.parent = into
                self.live = {x: (c, r, into if n is chain else n) for x, (c, r, n) in self.live.items()}
                continue
            if self.root.refs != 1:
                return
            tops = [n for n in nodes.values() if n.parent is self.root]
            if not tops:  # the root is the only survivor
                return
            self.root = tops[0]
            self.done += self.root.edits
            self.root.edits, self.root.parent = bytearray(), None

    def held(self) -> int:
        """Edits that are not certain yet."""
        seen: dict[int, int] = {}
        for _, _, n in self.live.values():
            while n is not None:
                seen[id(n)] = len(n.edits)
                n = n.parent
        return sum(seen.values())

    def end(self) -> tuple[int, bytes]:
        """Cost and edits of the whole conversation."""
        last = [(cost + k * INSERT, rank, b"I" * k, leaf) for state, (cost, rank, leaf) in self.live.items()
                for at, k in INSERTIONS[state] if at in (START, ASSISTANT)]
        cost, _, edits, leaf = min(last, key=lambda x: x[:3])
        tail = []
        while leaf is not None:
            tail.append(bytes(leaf.edits))
            leaf = leaf.parent
        return cost, bytes(self.done) + b"".join(reversed(tail)) + edits


def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the damage is set by the CRC-32 of conversation and turn."""
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition(parts(df), "conv_id")


def find_edits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation.

    ``turns`` has conv_id, turn, role, text, and gone (rows that only name their conversation).
    """
    kind = turns.schema["conv_id"].dataType
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    light = turns.select("conv_id", "turn", "role", "gone", F.sha2("text", 256).alias("digest"), last.alias("last"))
    first = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "seen"]
    rows = (_by_conversation(light).withColumn("seen", F.row_number().over(first))
            .sortWithinPartitions(*order)
            .select("conv_id", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), "gone",
                    (F.col("last") == "").alias("blank"), (F.col("seen") > 1).alias("again"),
                    (~F.col("last").isin(".", "!", "?")).alias("cut")))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def close() -> None:
            conv, viterbi, count, before, turn = now
            cost, audit = viterbi.end()
            low, high, distinct = turn
            gaps = 0 if low is None else high - low + 1 - distinct
            out.append((conv, gaps, *count, cost, audit.decode()))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 8
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], to_arrow_type(kind)), *[pa.array(c, pa.int64()) for c in cols[1:7]],
                 pa.array(cols[7], pa.string())], names=["conv_id", *names, "audit"])

        for b in batches:
            for conv, turn, initial, gone, blank, again, cut in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or conv != now[0]:
                    if now is not None:
                        close()
                    now = [conv, Survivors(), [0, 0, 0, 0], None, [None, None, 0]]
                if gone:
                    continue
                _, viterbi, count, before, turns_ = now
                again, cut = again and not blank, cut and not blank and not again
                count[0] += blank
                count[1] += again
                count[2] += cut
                if before is not None:
                    count[3] += before + initial not in ("su", "ua", "au")
                now[3] = initial
                if turn is not None:
                    if turns_[0] is None:
                        turns_[0] = turn
                    turns_[2] += turn != turns_[1]
                    turns_[1] = turn
                viterbi.row(initial, blank or again, cut)
            if len(out) > 5000:
                yield flush()
        if now is not None:
            close()
        yield flush()

    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", audit string")


def apply_edits(turns: DataFrame, edits: DataFrame, lines: bool = False) -> DataFrame:
    """The repaired turns (``lines``: conv_id, place, role, text), or else the rows of
    ``edits`` with repaired_sha256, the digest of their ``role:text`` lines.

    ``edits`` (conv_id, audit and more) comes first in each conversation of the sorted rows.
    """
    more = [f for f in edits.schema.fields if f.name != "conv_id"]
    kind = turns.schema["conv_id"].dataType
    head = edits.select("conv_id", F.lit(0).alias("part"), *[F.lit(None).cast(t).alias(c) for c, t in (
        ("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"))], *[f.name for f in more])
    body = turns.filter(~F.col("gone")).select(
        "conv_id", F.lit(1).alias("part"), F.col("turn").cast("long").alias("turn"), "role", F.sha2("text", 256).alias("digest"),
        "text", *[F.lit(None).cast(f.dataType).alias(f.name) for f in more])
    rows = (_by_conversation(head.unionByName(body))
            .sortWithinPartitions("conv_id", "part", F.col("turn").asc_nulls_first(), "role", "digest")
            .select("conv_id", "part", "role", "text", *[f.name for f in more]))
    at = [f.name for f in more].index("audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        now, out = None, []

        def write(initial: str, role: str, text: str) -> None:
            now["state"] = NEXT[now["state"], initial]
            if lines:
                out.append((now["conv"], now["place"], role, text))
            else:
                now["sha"].update((("\n" if now["place"] else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            now["place"] += 1

        def insert() -> None:
            while now["edit"] < len(now["audit"]) and now["audit"][now["edit"]] == "I":
                now["edit"] += 1
                wanted = WANTED[now["state"]]
                write(wanted, ROLES[wanted], "")

        def close() -> None:
            insert()
            if not lines:
                out.append((now["conv"], *now["more"], now["sha"].hexdigest()))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * len(target)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, target)], names=names)

        for b in batches:
            for conv, part, role, text, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if part == 0:
                    if now is not None:
                        close()
                    now = {"conv": conv, "more": rest, "audit": rest[at], "edit": 0, "state": START, "place": 0, "sha": sha256()}
                    continue
                insert()
                edit = now["audit"][now["edit"]]
                now["edit"] += 1
                if edit == "K":
                    write(role[:1], role, text)
                elif edit == "R":
                    wanted = WANTED[now["state"]]
                    write(wanted, ROLES[wanted], text)
                if len(out) > 5000:
                    yield flush()
        if now is not None:
            close()
        yield flush()

    conv = (kind.simpleString(), to_arrow_type(kind))
    if lines:
        fields = [("conv_id", *conv), ("place", "long", pa.int64()), ("role", "string", pa.string()), ("text", "string", pa.string())]
    else:
        fields = [("conv_id", *conv), *[(f.name, f.dataType.simpleString(), to_arrow_type(f.dataType)) for f in more],
                  ("repaired_sha256", "string", pa.string())]
    names, target = [f[0] for f in fields], [f[2] for f in fields]
    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t, _ in fields))


def repair(turns: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest of every conversation of ``turns`` (as of ``damaged``)."""
    return apply_edits(turns, save(find_edits(turns), "dialogue-edits"))


__all__ = ["Survivors", "apply_edits", "damaged", "find_edits", "repair"]
