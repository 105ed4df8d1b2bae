"""Repair of conversations: the generalised parser of `role_grammar`, run over blocks of turns.

Turns are put in order once, by ranges, so that a conversation of any length is spread over tasks.
A block is some turns of one conversation. The parser follows each block from every stack that it may be
entered with, all blocks at once; then each conversation's blocks are put together in order, which
takes a few numbers and the edits of each, not the texts. The edits go back to the blocks that have the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.role_grammar import Repairer, Stack, roles_by_audit, turn_kind
from tradelake.llm.scratch import Scratch
from tradelake.operators.paging import range_count

# Turns and bytes of text that a block has at most; one longer turn is a block of its own.
BLOCK_TURNS = 1024
BLOCK_BYTES = 4 << 20

# Fixed value: white space for blank texts and after the last mark.
WHITE = " \t\n\x0b\x0c\r"

_TURN_BITS = 33
_LISTS = {
    "turns": pa.int64(),
    "roles": pa.string(),
    "texts": pa.string(),
    "digests": pa.binary(),
    "blank": pa.bool_(),
    "truncated": pa.bool_(),
}
_COLUMNS = dict(zip(_LISTS, ("turn", "role", "text", "digest", "blank", "truncated")))
_LISTS_SQL = (
    "turns array<long>, roles array<string>, texts array<string>, digests array<binary>, "
    "blank array<boolean>, truncated array<boolean>"
)
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_LEGAL = ("su", "ua", "au")


class Repaired(NamedTuple):
    """`summary`: a row per conversation. `blocks`: what is left of each block, in `seg` order."""

    summary: DataFrame
    blocks: DataFrame


# -- blocks


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered turns as blocks of one conversation each; `opens` is null where a task can't tell."""
    number = TaskContext.get().partitionId() << _TURN_BITS
    before: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column("conv").to_pylist()
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        begins, opens, size = [], [], 0
        for i, conv in enumerate(convs):
            fresh = before is None or before[0] != conv
            full = bool(begins) and (i - begins[-1] >= BLOCK_TURNS or sizes[i] - size > BLOCK_BYTES)
            if fresh or full or not begins:
                begins.append(i)
                opens.append(None if before is None else fresh)
                size = int(sizes[i - 1]) if i else 0
            before = (conv,)
        present = batch.column("present").to_numpy(zero_copy_only=False)
        inside = np.concatenate([[0], np.cumsum(present)])[[*begins, len(convs)]].astype(np.int32)
        rows = batch.filter(pa.array(present))
        lists = [
            pa.ListArray.from_arrays(pa.array(inside), rows.column(c).cast(_LISTS[n])) for n, c in _COLUMNS.items()
        ]
        segs = pa.array(np.arange(number, number + len(begins)))
        number += len(begins)
        conv = batch.column("conv").take(pa.array(begins))
        yield pa.RecordBatch.from_arrays(
            [conv, segs, pa.array(opens, pa.bool_()), *lists], ["conv", "seg", "opens", *_LISTS]
        )


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each block, and the parser's ways through it from each stack it may begin with."""
    repairer = Repairer()
    entries = repairer.entries()
    place = {stack: i for i, stack in enumerate(entries)}
    for batch in batches:
        out = []
        for row in batch.select(["opens", "turns", "initials", "blank", "truncated", "firsts"]).to_pylist():
            first = set(row["firsts"] or ())
            initials = row["initials"]
            faults = [
                "blank" if blank else "duplicate" if i not in first else "truncated" if cut else ""
                for i, (blank, cut) in enumerate(zip(row["blank"], row["truncated"]))
            ]
            kinds = "".join(
                turn_kind(r, f in ("blank", "duplicate"), f == "truncated") for r, f in zip(initials, faults)
            )
            ways = []
            if row["opens"] is not False:
                ways += [(-1, way) for way in repairer.follow(entries[0], kinds, True)]
            if not row["opens"]:
                ways += [(i, way) for i, s in enumerate(entries) for way in repairer.follow(s, kinds, False)]
            turns = [t for t in row["turns"] if t is not None]
            out.append(
                {
                    **{f: faults.count(f) for f in _COUNTS[:3]},
                    "illegal": sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:])),
                    "first": initials[0] if initials else None,
                    "last": initials[-1] if initials else None,
                    "low": turns[0] if turns else None,
                    "high": turns[-1] if turns else None,
                    "distinct": len(set(turns)),
                    "ways": [
                        {"entry": i, "cost": cost, "audit": audit, "exit": place[stack]}
                        for i, (cost, audit, stack) in ways
                    ],
                }
            )
        names = ["conv", "seg"]
        table = pa.Table.from_pylist(out, schema=_PARSED)
        if len(out):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *(c.combine_chunks() for c in table.columns)],
                [*names, *_PARSED.names],
            )


_WAYS = pa.struct([("entry", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("exit", pa.int32())])
_PARSED = pa.schema(
    [(c, pa.int64()) for c in _COUNTS]
    + [("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in ("low", "high", "distinct")]
    + [("ways", pa.list_(_WAYS))]
)
_PARSED_SQL = (
    "blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, "
    "distinct long, ways array<struct<entry:int,cost:long,audit:string,exit:int>>"
)


# -- conversations


class _Node:
    """The edits of one block on some way, and what came before; ways share their beginnings."""

    __slots__ = ("before", "audit", "stack")

    def __init__(self, before: _Node | None, audit: str, stack: Stack):
        self.before, self.audit, self.stack = before, audit, stack


def _audit_below(x: _Node, y: _Node) -> bool:
    """Whether x's whole audit comes before y's; they have the same number of blocks."""
    mine, other = [], []
    while x is not y:
        mine.append(x.audit)
        other.append(y.audit)
        x, y = x.before, y.before
    return "".join(reversed(mine)) < "".join(reversed(other))


class _Conversation:
    def __init__(self, conv, repairer: Repairer, entries: list[Stack]):
        self.conv, self.repairer, self.entries = conv, repairer, entries
        self.place = {stack: i for i, stack in enumerate(entries)}
        self.segs: list[int] = []
        self.ways: list[tuple[int, _Node]] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.last = self.low = self.high = None
        self.distinct = 0

    def add(self, row: dict) -> None:
        after: dict[int, list[dict]] = {}
        for way in row["ways"]:
            after.setdefault(way["entry"], []).append(way)
        if self.segs:
            steps = [(cost, node, way) for cost, node in self.ways for way in after[self.place[node.stack]]]
        else:
            steps = [(0, None, way) for way in after[-1]]
        best: dict[int, tuple[int, _Node]] = {}
        for cost, before, way in steps:
            stack = self.entries[way["exit"]]
            found = (cost + way["cost"], _Node(before, way["audit"], stack))
            held = best.get(stack[-1])
            if held is None or found[0] < held[0] or found[0] == held[0] and _audit_below(found[1], held[1]):
                best[stack[-1]] = found
        self.ways = list(best.values())
        self.segs.append(row["seg"])
        for c in _COUNTS:
            self.counts[c] += row[c]
        if row["first"] is not None:
            if self.last is not None and self.last + row["first"] not in _LEGAL:
                self.counts["illegal"] += 1
            self.last = row["last"]
        if row["low"] is not None:
            self.distinct += row["distinct"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def rows(self) -> Iterator[dict]:
        """The edits of each block, and with the last one the conversation's row."""
        best: tuple[int, _Node] | None = None
        for cost, node in self.ways:
            if not self.repairer.tables.accepts(node.stack):
                continue
            if best is None or cost < best[0] or cost == best[0] and _audit_below(node, best[1]):
                best = (cost, node)
        cost, node = best
        pieces: list[_Node] = []
        while node:
            pieces.append(node)
            node = node.before
        pieces.reverse()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        summary = {"gaps": gaps, **self.counts, "cost": cost, "audit": "".join(p.audit for p in pieces)}
        shared = {"conv": self.conv, "conversation": self.segs[0], "blocks": len(self.segs)}
        for i, (seg, piece) in enumerate(zip(self.segs, pieces)):
            after = self.repairer.tables.last_turn(piece.before.stack) if piece.before else ""
            end = i + 1 == len(pieces)
            yield {**shared, "seg": seg, "edits": piece.audit, "after": after, "summary": summary if end else None}


_SUMMARY = [("gaps", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("cost", pa.int64()), ("audit", pa.string())]
_SUMMARY_SQL = "gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string"


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in the order of their conversations to the edits that cost least."""
    repairer = Repairer()
    entries = repairer.entries()
    current: _Conversation | None = None
    schema, waiting = None, []

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in batches:
        schema = schema or pa.schema(
            [batch.schema.field("conv"), ("conversation", pa.int64()), ("blocks", pa.int64()), ("seg", pa.int64())]
            + [("edits", pa.string()), ("after", pa.string()), ("summary", pa.struct(_SUMMARY))]
        )
        for row in batch.to_pylist():
            if current is None or current.conv != row["conv"]:
                if current:
                    waiting += current.rows()
                current = _Conversation(row["conv"], repairer, entries)
            current.add(row)
            if len(waiting) >= 1 << 12:
                yield batch_of(waiting)
                waiting = []
    if current:
        waiting += current.rows()
        yield batch_of(waiting)


# -- texts


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that edits leave of each block."""
    made = {"u": "user", "a": "assistant"}
    turn = pa.struct([("edit", pa.string()), ("source", pa.int32()), ("role", pa.string()), ("text", pa.string())])
    names = ["conv", "conversation", "blocks", "seg"]
    for batch in batches:
        out = []
        for row in batch.select(["roles", "texts", "edits", "after"]).to_pylist():
            roles, texts = row["roles"], row["texts"]
            left = roles_by_audit(row["edits"], [r[:1] for r in roles], row["after"])
            out.append(
                [
                    {
                        "edit": edit,
                        "source": i,
                        "role": roles[i] if edit == "K" else made[initial],
                        "text": texts[i] if i >= 0 else "",
                    }
                    for edit, i, initial in left
                ]
            )
        turns = pa.array(out, pa.list_(turn))
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), turns], [*names, "left"])


_LEFT_SQL = "left array<struct<edit:string,source:int,role:string,text:string>>"


def repair_conversations(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    present: Column | None = None,
) -> Repaired:
    """The cheapest edits by which a conversation's roles read: system at most once and first, then pairs of user and assistant.

    Turns are in order of `turn`, nulls first; ties go by role, the text's first 64 characters and a
    digest. A turn is known by its role's initial. Its first fault counts: blank (white space only), duplicate (role and
    text stood earlier) or truncated (no `.`, `!` or `?` at its end). Keeping a turn costs nothing, giving
    it the role of user or assistant 1, deleting it 2, inserting an empty turn 5, leaving a
    truncated one 5 more; blank and duplicate ones must go. Of equally cheap edits the least audit
    (initials in order) is taken.

    `summary`: conv, `conversation` (a number of its own), gaps, blank, duplicate, truncated, illegal (neighbours whose
    initials are not su, ua or au), cost and audit. `blocks`: conv, conversation, `blocks` (how many it has), `seg` (their
    order) and `left`, the remaining turns as (edit, source, role, text).

    Rows where `present` is not true only tell that a conversation exists; one without turns is all zeros. A null role
    or text counts as one space, a null conversation is one of its own, null turns are no gaps. Roles of other or no
    initial can't be kept. Repeated rows are duplicates. A long text is a block alone. Other columns don't matter; an
    empty table gives no rows.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "repair")
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    space = lambda c: F.when(here, F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))).otherwise("")
    bare = rows.select(
        F.col(f"`{conv_column}`").alias("conv"),
        F.col(f"`{turn_column}`").cast("long").alias("turn"),
        space(role_column).alias("role"),
        space(text_column).alias("text"),
        here.alias("present"),
    )
    end = F.rtrim("text", F.lit(WHITE))
    known = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    order = ["conv", "turn", "role", "lead", "digest", "tie"]
    turns = bare.withColumns(
        {
            "digest": F.unhex(F.sha2(known, 256)),
            "blank": end == "",
            "truncated": ~(end.endswith(".") | end.endswith("!") | end.endswith("?")),
            "lead": F.left("text", F.lit(64)),
            "tie": F.monotonically_increasing_id(),
        }
    )
    kind = rows.schema[conv_column].dataType.simpleString()
    blocks = scratch.keep(
        turns.repartitionByRange(range_count(turns), *order)
        .sortWithinPartitions(*order)
        .drop("lead", "tie")
        .mapInArrow(_blocks, f"conv {kind}, seg long, opens boolean, {_LISTS_SQL}"),
        "blocks",
    )
    # The first of equal turns, found by partial minima, whatever a conversation's length.
    firsts = (
        blocks.select("conv", "seg", F.posexplode("digests").alias("at", "digest"))
        .groupBy("conv", "digest")
        .agg(F.min(F.struct("seg", "at")).alias("first"))
        .groupBy("first.seg")
        .agg(F.collect_list("first.at").alias("firsts"))
    )
    parsed = (
        blocks.withColumn("initials", F.transform("roles", lambda r: F.left(r, F.lit(1))))
        .drop("roles", "texts", "digests")
        .join(firsts, "seg", "left")
        .mapInArrow(_parse, f"conv {kind}, seg long, {_PARSED_SQL}")
    )
    edits = scratch.keep(
        parsed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv")
        .sortWithinPartitions("conv", "seg")
        .mapInArrow(
            _put_together,
            f"conv {kind}, conversation long, blocks long, seg long, edits string, after string, "
            f"summary struct<{_SUMMARY_SQL}>",
        ),
        "edits",
    )
    summary = edits.filter("summary is not null").select("conv", "conversation", "summary.*")
    texts = blocks.select("seg", "roles", "texts")
    left = texts.join(edits.drop("summary"), "seg").mapInArrow(
        _apply, f"conv {kind}, conversation long, blocks long, seg long, {_LEFT_SQL}"
    )
    return Repaired(summary, left)


def text_digests(repaired: Repaired) -> DataFrame:
    """(`conversation`, `sha256`) of the remaining turns as `role:text` lines.

    A conversation of one block is hashed where it lies; the blocks of longer ones go through one
    task's running hash in order, as this digest can't be put together from parts.
    """
    lines = F.transform("left", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    bodies = repaired.blocks.select(
        "conversation", "blocks", "seg", F.size("left").alias("n"), F.array_join(lines, "\n").alias("body")
    )
    short = bodies.filter("blocks = 1").select("conversation", F.sha2("body", 256).alias("sha256"))
    spark = bodies.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    running = (
        bodies.filter("blocks > 1")
        .repartition(tasks, "conversation")
        .sortWithinPartitions("conversation", "seg")
        .mapInArrow(_running_digests, "conversation long, sha256 string")
    )
    return short.union(running)


def _running_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import sha256

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int64()), pa.array([running.hexdigest()])], ["conversation", "sha256"]
        )

    current, running, begun = None, sha256(), False
    for batch in batches:
        for row in batch.to_pylist():
            if row["conversation"] != current:
                if current is not None:
                    yield done()
                current, running, begun = row["conversation"], sha256(), False
            if row["n"]:
                running.update((b"\n" if begun else b"") + row["body"].encode())
                begun = True
    if current is not None:
        yield done()
