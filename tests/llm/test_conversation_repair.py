"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import conversation_repair as repair
from inkfold.llm import queries

WHITE = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(what, 1)
    return out


def cheapest(rows, faults):
    """Dijkstra over (row, initials' last letter and count), by cost and then by audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(lines)
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        name = {"u": "user", "a": "assistant"}[follow]
        heapq.heappush(heap, (cost + 3, audit + "I", at, follow, (*lines, f"{name}:")))
        if at == len(rows):
            continue
        role, text = rows[at]
        heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last, lines))
        if faults[at] in ("blank", "duplicate"):
            continue
        extra = 3 if faults[at] else 0
        heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, follow, (*lines, f"{name}:{text}")))
        if role[:1] == follow or (role[:1] == "s" and last == ""):
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))


def plain_repair(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or (" " if role is None else ""), " " if text is None else text))
    out = {}
    for conv, talk in talks.items():
        talk.sort()
        seen, faults = set(), []
        for _, _, role, text in talk:
            last = text.rstrip(WHITE)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for known, t, *_ in talk if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines = [(r, t) for *_, r, t in talk]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(lines))
        cost, audit, repaired = cheapest(lines, faults)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, repaired)
    return out


def made_talks(n, longest, seed):
    rng = random.Random(seed)
    return [(c, rng.choice([t, t + t // 3]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "u"]),
             rng.choice([f"t{t}.", f"t{t}!", f"t{t}", "same.", "", " \n", "é?  "])) for c in range(n) for t in range(rng.randint(1, longest))]


ODD = [(None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (900, None, "user", "b."), (900, None, "assistant", "a."),
       (901, -(1 << 63), "user", "x."), (901, (1 << 63) - 2, "assistant", "y."), (902, 1, "system", "s."), (903, 5, "user", "z." * 50_000),
       (904, 1, "\U0001f600", "\U0001f600"), (905, 3, None, "w.")]


@pytest.mark.parametrize("bits", [1, 8])
def test_repair_is_the_cheapest(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = made_talks(150, 9, bits) + ODD
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    clash = {n: F.lit(1) for n in ("pos", "block", "mark", "blank", "cost", "audit", "tie", "rows")}
    found = {r.conv_id: tuple(r)[1:] for r in repair.repair(turns.withColumns(clash)).collect()}
    want = plain_repair(rows)
    # The span of one conversation does not fit into 64 bits.
    want[901] = (None, *want[901][1:])
    assert found == want
    assert repair.repair(turns.limit(0)).count() == 0


def test_long_conversation_goes_to_many_blocks(spark):
    rows = [(1, t, ["user", "assistant"][t % 2] if t % 11 else "tool", f"{t}." if t % 7 else "again.") for t in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    row, = repair.repair(turns).collect()
    assert tuple(row)[1:] == plain_repair(rows)[1]
    again, = repair.repair(turns.select("conv_id", F.lit(None).cast("bigint").alias("turn"), F.lit("user").alias("role"), F.lit("a.").alias("text"))).collect()
    assert (again.duplicate, again.cost, again.audit) == (2999, 3 + 4 * 2999, "K" + "D" * 2999 + "I")


def test_nodes_are_shared_between_signatures(monkeypatch):
    made, whole = [], repair.step
    monkeypatch.setattr(repair, "step", lambda symbol, behind: made.append(symbol) or whole(symbol, behind))
    ways = repair.Ways()
    assert len(ways.costs) == 31
    assert ways.before("ua" * 500, 0) == ways.before("ua" * 2, 0)


def test_query_on_whole_table(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = {r.conv_id: (0, 0, 0, 0, 0, 0, "", "") for r in turns} | plain_repair(plain_damage(map(tuple, turns)))
    found = queries.REGISTRY["op13_conversation_repair"](spark, SF_DIR).collect()
    assert {tuple(r) for r in found} == {(c, *w[:7], hashlib.sha256(w[7].encode()).hexdigest()) for c, w in want.items()}
    assert len(found) == len(want)
