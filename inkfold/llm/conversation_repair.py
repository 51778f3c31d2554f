"""Conversation structure repair over a suffix-shared automaton (DAWG).

Every row of a conversation is one symbol: the initial of its role (``s u a``, ``o``
for others; upper-case if its text is truncated), or ``x`` where it must go (blank
or said before). The symbols of a conversation are its signature. Signatures of
all conversations are minimised from the end: sorted by their reversal, those with
a common ending lie side by side, and every distinct ending is one node. A node
holds, for each of four grammar states, the cost to go and the best rest of the
audit, computed once from the node behind it, however many conversations end so.

The grammar reads role initials ``(s?(ua)+)?``. What a move costs depends on the
node behind only through its four costs, of which thirty combinations occur (after
the least is taken off). So a long conversation is cut into blocks, and a block's
nodes hang below the combination that the rest of its conversation comes to: a
conversation that holds a third of all rows is many small rows, and blocks share
nodes as whole conversations do.

The least audit needs no comparison of texts. Each letter (D, I, K, R) leads to one
node and state, so the best rest begins with the first letter in ASCII order that
costs no more than the least.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import WHITE, stored, tasks

# Rows of one block; its texts are held together once.
BLOCK_BITS = 8
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# Grammar states: nothing read, after s, after u, after a. The role that must follow, and where it leads.
START = 0
WANTED, THEN = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
LEGAL = ("su", "ua", "au")
# Faults found in order, with the sentence ends that a whole text has.
SENTENCE_ENDS = (".", "!", "?")


class Node(NamedTuple):
    """An ending: per grammar state the cost to go, the audit up to the block's end and the state there."""

    cost: tuple[int, ...]
    audit: tuple[str, ...]
    end: tuple[int, ...]


# No row left: inserts complete what has begun.
FINAL = Node((0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""), (0, 3, 3, 3))


def step(symbol: str, behind: Node) -> Node:
    """The node of a symbol before an ending."""
    kept = KEEP.get(symbol.lower())
    extra = TRUNCATED if symbol.isupper() else 0
    moves: list[list[tuple[str, int, int]]] = []
    for state in range(4):
        own = [("D", DELETE + behind.cost[state], state)]
        if kept:
            if kept[state] is not None:
                own.append(("K", extra + behind.cost[kept[state]], kept[state]))
            own.append(("R", REROLE + extra + behind.cost[THEN[state]], THEN[state]))
        moves.append(own)
    cost = [min(c for _, c, _ in own) for own in moves]
    for _ in range(2):
        cost = [min(cost[s], INSERT + cost[THEN[s]]) for s in range(4)]

    def best(state: int) -> tuple[str, int]:
        for letter, c, to in sorted([*moves[state], ("I", INSERT + cost[THEN[state]], THEN[state])]):
            if c == cost[state]:
                if letter == "I":
                    rest, end = best(to)
                    return "I" + rest, end
                return letter + behind.audit[to], behind.end[to]
        raise AssertionError("one move has the least cost")
    found = [best(s) for s in range(4)]
    return Node(tuple(cost), tuple(a for a, _ in found), tuple(e for _, e in found))


class Ways:
    """Numbers of the cost combinations a rest can come to; 0 is the end of a conversation."""

    def __init__(self) -> None:
        self.costs, self.after, number = [FINAL.cost], [], {}
        while len(self.after) < len(self.costs):
            behind, row = Node(self.costs[len(self.after)], ("",) * 4, (0,) * 4), {}
            for symbol in "suaoSUAOx":
                cost = step(symbol, behind).cost
                least = tuple(c - min(cost) for c in cost)
                if least not in number:
                    number[least] = len(self.costs)
                    self.costs.append(least)
                row[symbol] = number[least]
            self.after.append(row)

    def before(self, signature: str, way: int) -> int:
        """The combination at the start of a signature, given the one behind it."""
        for symbol in reversed(signature):
            way = self.after[way][symbol]
        return way

    def root(self, way: int) -> Node:
        """What lies behind a block: the end of the conversation, or a combination, each state ending in itself."""
        return FINAL if way == 0 else Node(self.costs[way], ("",) * 4, (0, 1, 2, 3))


def _class(role: Column) -> Column:
    initial = F.left(role, F.lit(1))
    return F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows in order, numbered (``pos``) and dealt to blocks of neighbouring numbers.

    The order is conversation, turn (null first), role, the first characters of the
    text and its hash; a conversation, a turn or a row that repeats very often goes
    to several ranges.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.select("*", F.left("text", F.lit(32)).alias("head"), F.xxhash64(F.lit("a"), "role", "text").alias("ha"),
                       F.xxhash64(F.lit("b"), "role", "text").alias("hb"), F.monotonically_increasing_id().alias("tie"),
                       _class(F.col("role")).alias("mark"), (F.btrim("text", F.lit(WHITE)) == "").alias("blank"),
                       F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS).alias("whole"))
    order = ["conv_id", "turn", "role", "head", "ha", "hb", "tie"]
    dealt = rows.repartitionByRange(tasks(turns), *order).sortWithinPartitions(*order)
    numbered = dealt.withColumn("pos", F.monotonically_increasing_id()).drop("head", "tie")
    return stored(numbered.withColumn("block", F.shiftright("pos", BLOCK_BITS)), "repair-rows")


def _blocks(rows: DataFrame) -> DataFrame:
    """``conv_id, block, signature, marks`` and the number of faults; one row per conversation and block."""
    first = rows.where("NOT blank").groupBy("conv_id", "ha", "hb").agg(F.min("pos").alias("pos"))
    # Places are unique, so a text that a third of all rows repeat is no hot key here.
    seen = rows.select("conv_id", "block", "pos", "mark", "blank", "whole").join(first.select("pos", F.lit(True).alias("first")), "pos", "left")
    fault = F.when(F.col("blank"), F.lit("b")).when(F.col("first").isNull(), F.lit("d")).when(~F.col("whole"), F.lit("t")).otherwise(F.lit(""))
    symbol = F.when(F.col("fault").isin("b", "d"), F.lit("x")).when(F.col("fault") == "t", F.upper("mark")).otherwise(F.col("mark"))
    named = seen.withColumn("fault", fault).select("conv_id", "block", F.struct("pos", symbol.alias("symbol"), "mark").alias("row"), "fault")
    grouped = named.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list("row")).alias("rows"),
        *[F.count_if(F.col("fault") == c).alias(n) for n, c in (("blank", "b"), ("duplicate", "d"), ("truncated", "t"))])

    def joined(field: str) -> Column:
        return F.array_join(F.transform("rows", lambda r: r[field]), "")
    return stored(grouped.select("conv_id", "block", joined("symbol").alias("signature"), joined("mark").alias("marks"),
                                 "blank", "duplicate", "truncated"), "repair-blocks")


def _ways(blocks: DataFrame) -> DataFrame:
    """``blocks`` and ``way``: what the rest of the conversation behind a block comes to.

    Blocks of a conversation pass from the last to the first; a task keeps one number.
    """
    names = blocks.columns
    dealt = blocks.repartition(tasks(blocks), "conv_id").sortWithinPartitions("conv_id", F.desc("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways, here, way, known = Ways(), object(), 0, {}
        for batch in batches:
            out = []
            for conv, signature in zip(batch.column("conv_id").to_pylist(), batch.column("signature").to_pylist()):
                if conv != here:
                    here, way = conv, 0
                out.append(way)
                if len(known) > 1 << 16:
                    known.clear()
                if (signature, way) not in known:
                    known[signature, way] = ways.before(signature, way)
                way = known[signature, way]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*names, "way"])
    return stored(dealt.mapInArrow(run, _ddl(blocks, "way int")), "repair-ways")


def _ddl(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def automaton(signatures: DataFrame) -> DataFrame:
    """``signature, way, cost, audit, end`` (arrays by grammar state) for ``signature, way``.

    Sorted by their reversal, signatures meet the path of nodes of the one before
    and add those it lacks, so every ending is worked out once (again only where a
    range begins). A task holds the nodes of one path.
    """
    distinct = signatures.select("way", "signature").distinct().withColumn("ending", F.reverse("signature"))
    dealt = distinct.repartitionByRange(tasks(signatures), "way", "ending").sortWithinPartitions("way", "ending")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways, before, root = Ways(), "", -1
        path: list[Node] = []
        for batch in batches:
            out: list[Node] = []
            for way, ending in zip(batch.column("way").to_pylist(), batch.column("ending").to_pylist()):
                if way != root:
                    before, root, path = "", way, [ways.root(way)]
                shared, upto = 0, min(len(before), len(ending))
                while shared < upto and before[shared] == ending[shared]:
                    shared += 1
                del path[shared + 1:]
                for symbol in ending[shared:]:
                    path.append(step(symbol, path[-1]))
                before = ending
                base = path[0].cost
                node = path[-1]
                # What the block itself costs; the rest is counted where it stands.
                own = node.cost if way == 0 else tuple(c - base[e] for c, e in zip(node.cost, node.end))
                out.append(Node(own, node.audit, node.end))
            yield pa.RecordBatch.from_arrays(
                [batch.column("signature"), batch.column("way"), pa.array([n.cost for n in out], pa.list_(pa.int64())),
                 pa.array([n.audit for n in out], pa.list_(pa.string())), pa.array([n.end for n in out], pa.list_(pa.int32()))],
                names=["signature", "way", "cost", "audit", "end"])
    return dealt.mapInArrow(run, "signature string, way int, cost array<bigint>, audit array<string>, end array<int>")


def edits(signature: str, audit: str, state: int) -> tuple[list[list[str]], list[str | None], list[str]]:
    """Per row the roles inserted before it and its role ("" as it is, None deleted), and roles inserted at the end."""
    before: list[list[str]] = []
    roles: list[str | None] = []
    inserted: list[str] = []
    for letter in audit:
        if letter == "I":
            inserted.append(WANTED[state])
            state = THEN[state]
            continue
        symbol = signature[len(roles)]
        roles.append(None if letter == "D" else WANTED[state] if letter == "R" else "")
        before.append(inserted)
        inserted = []
        if letter != "D":
            state = THEN[state] if letter == "R" else KEEP[symbol.lower()][state]
    return before, roles, inserted


def _chosen(found: DataFrame) -> DataFrame:
    """The edits of every block: the blocks of a conversation pass from the first to the last."""
    schema = ("conv_id {}, block bigint, audit string, cost bigint, illegal bigint, inserted array<array<string>>, "
              "roles array<string>, tail array<string>").format(found.schema["conv_id"].dataType.simpleString())
    dealt = found.repartition(tasks(found), "conv_id").sortWithinPartitions("conv_id", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, mark = object(), START, ""
        for batch in batches:
            rows = []
            for r in batch.select(["conv_id", "block", "signature", "marks", "cost", "audit", "end"]).to_pylist():
                if r["conv_id"] != here:
                    here, state, mark = r["conv_id"], START, ""
                marks = mark + r["marks"]
                illegal = sum(marks[i:i + 2] not in LEGAL for i in range(len(marks) - 1))
                inserted, roles, tail = edits(r["signature"], r["audit"][state], state)
                rows.append((r["conv_id"], r["block"], r["audit"][state], r["cost"][state], illegal, inserted, roles, tail))
                state, mark = r["end"][state], marks[-1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], batch.schema.field("conv_id").type),
                 *(pa.array([r[i] for r in rows], t) for i, t in enumerate(
                     [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.string())), pa.list_(pa.string()), pa.list_(pa.string())], 1))],
                names=["conv_id", "block", "audit", "cost", "illegal", "inserted", "roles", "tail"])
    return stored(dealt.mapInArrow(run, schema), "repair-edits")


def _lines() -> Column:
    """``role:text`` of every turn a block comes to, inserted ones with an empty text."""
    def bare(roles: Column) -> Column:
        return F.transform(roles, lambda r: F.concat(r, F.lit(":")))

    def line(row: Column, i: Column) -> Column:
        role = F.get("roles", i)
        own = F.concat(F.when(role == "", row["role"]).otherwise(role), F.lit(":"), row["text"])
        return F.concat(bare(F.get("inserted", i)), F.when(role.isNull(), F.array().cast("array<string>")).otherwise(F.array(own)))
    return F.concat(F.flatten(F.transform("rows", line)), bare(F.col("tail")))


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not looked at, and
    may have any names. A null role or text is one space, so a null text is blank.
    Rows with a null id are one conversation. Rows of one turn (null turns come
    first) go by role, the first 32 characters of the text and its hash; repeated rows
    are duplicates of the first. A row's first fault counts: blank (nothing but
    white space), duplicate (role and text seen earlier), truncated (does not end a
    sentence). ``illegal`` counts neighbours, before repair, whose role initials are
    not su, ua or au. ``gaps`` are numbers missing between the first and the last turn
    (null beyond 64 bits). ``cost`` and ``audit`` are those of the cheapest edits
    (K keep, R other role, D delete, I insert), the ASCII-least on ties, and
    ``repaired`` is what they give: ``role:text`` of every turn, joined by line ends.
    Texts are taken whole at any length. An empty table gives an empty result.
    """
    rows = _ordered(turns)
    faults = _blocks(rows)
    ways = _ways(faults.select("conv_id", "block", "signature", "marks"))
    chosen = _chosen(ways.join(automaton(ways), ["signature", "way"]))
    texts = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("rows"))
    # Numbers of blocks are not null; a block holds the end of one conversation and the start of the next.
    theirs = chosen.withColumnsRenamed({"conv_id": "c", "block": "k"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("k"))
    bodies = texts.join(theirs, same).select("conv_id", "block", "audit", "cost", "illegal", _lines().alias("lines")).select(
        "conv_id", F.struct("block", "audit", F.when(F.size("lines") > 0, F.array_join("lines", "\n")).alias("body")).alias("part"), "cost", "illegal")
    gaps = (F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count_distinct("turn"))
    spans = rows.groupBy("conv_id").agg(F.coalesce(F.when(F.max("turn").isNull(), F.lit(0)), gaps).cast("decimal(38,0)").alias("gaps"))
    # Parts of a conversation are added up side by side, so that a null id needs no join.
    counts = ["blank", "duplicate", "truncated"]
    every = (bodies.unionByName(faults.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts]), allowMissingColumns=True)
             .unionByName(spans, allowMissingColumns=True))
    whole = every.groupBy("conv_id").agg(
        F.max("gaps").alias("gaps"), *[F.sum(c).alias(c) for c in [*counts, "illegal", "cost"]],
        F.array_sort(F.collect_list("part")).alias("parts"))

    def joined(field: str, by: str) -> Column:
        return F.array_join(F.transform("parts", lambda p: p[field]), by)
    return whole.select("conv_id", F.col("gaps").try_cast("bigint").alias("gaps"), *counts, "illegal", "cost",
                        joined("audit", "").alias("audit"), joined("body", "\n").alias("repaired"))


# Damage: what is done to a row by the remainder of its checksum.
DROP, EMPTY, UNSTOP, REPEAT, CONFUSE, DAMAGES = 0, 1, 2, 3, 4, 20


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by crc32 of ``conv_id:turn``; any null part is one space.

    Of twenty rows one is dropped, one loses its text, one its ``.!?``, one is there
    twice and one is said by the user. Repeated rows fare alike; an empty table stays empty.
    """
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                        (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % DAMAGES).alias("what"))
    what = F.col("what")
    text = F.when(what == EMPTY, "").when(what == UNSTOP, F.translate("text", "".join(SENTENCE_ENDS), "")).otherwise(F.col("text"))
    role = F.when(what == CONFUSE, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(what == DROP, 0).when(what == REPEAT, 2).otherwise(1).cast("int"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
