"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A conversation's rows, by turn (nulls first; rows of one turn by role and text), are edited until their roles' initials
read `(s?(ua)+)?`. Edits and costs: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty turn of user or assistant 5. Blank
and duplicate rows (role and text seen earlier in the conversation) must go; a row that stays and doesn't end a sentence costs 5
more. The audit lists the edits' initials; of the cheapest audits the least in ASCII order is taken.

Lattice: node (i, state) is reached after i rows; the state is what the initials so far allow next (`STEP`). `cheapest` searches
from both ends with a heap each, by cost and then by row, so that free edges are settled in order. Once the heaps' costs sum to more than the
best crossing, every crossing of that cost has been settled: an edge from a node settled from the front to one settled
from the back. The least concatenation over these is the answer. Two different cheapest audits to one node never begin with each
other (the longer one had the same rows and more inserts), so the least beginning and the least end make the least whole.

Long conversations: rows are range partitioned by conversation, turn, role and text, so one conversation may lie in many tasks. A
run of a conversation is cut into segments of `SEGMENT` rows or `SEGMENT_BYTES`. A conversation that ends within its task in one segment is
answered there. Any other segment gives its cheapest audits for each pair of states, and these (no texts) are chained for each
conversation in one task, which holds its audit, one string by definition. Equal rows are counted, not repeated, before any shuffle, and duplicates
are found by the least turn of each (conversation, role, text), counted with map-side combining.

Null role and text are one space. Null turns come first; a null conversation id is a conversation. Empty texts are blank. Very long texts
are read whole. Empty tables give empty results. Only the four columns are read, so names of other columns can't clash.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: state -> {initial: next state}: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
STATES, ENDS = 4, (0, 3)
ROLE = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Rows and bytes of text in a segment.
SEGMENT, SEGMENT_BYTES = 256, 4 << 20
#: The beginning of a text that range borders see; a beginning sorts as its text does.
BORDER = 1_000

_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
Row = tuple[str, int, bool, bool]         # role, copies, must go, truncated


def _edges(rows: list[Row]) -> list[list[list[tuple[int, int, str, int]]]]:
    """(rows taken, cost, audit, next state) of the edges that leave each (row, state)."""
    out = []
    for at in range(len(rows) + 1):
        row = rows[at] if at < len(rows) else None
        each = []
        for state in range(STATES):
            edges = [(0, INSERT, "I", STEP[state].get("u") or STEP[state]["a"])]
            if row:
                role, copies, gone, cut = row
                more, tail = DELETE * (copies - 1), "D" * (copies - 1)
                edges.append((1, DELETE + more, "D" + tail, state))
                if not gone:
                    stay = more + (TRUNCATED if cut else 0)
                    if role[:1] in STEP[state]:
                        edges.append((1, KEEP + stay, "K" + tail, STEP[state][role[:1]]))
                    edges.append((1, REROLE + stay, "R" + tail, STEP[state].get("u") or STEP[state]["a"]))
            each.append(edges)
        out.append(each)
    return out


def cheapest(edges: list, start: int, ends: tuple[int, ...]) -> tuple[int, str, int] | None:
    """(cost, audit, end state) of the cheapest path over the lattice, least in ASCII order; None if there is none."""
    last = len(edges) - 1
    back: dict = {}
    for at, states in enumerate(edges):
        for state, leaving in enumerate(states):
            for taken, cost, audit, then in leaving:
                back.setdefault((at + taken, then), []).append(((at, state), cost, audit))
    front = {(0, start): (0, "")}
    rear = {(last, e): (0, "") for e in ends}
    ahead, behind = [(0, 0, start)], [(0, 0, e) for e in ends]
    settled_front, settled_rear = set(), set()
    best = 0 if start in ends and not last else None
    while ahead or behind:
        f, r = (ahead[0][0] if ahead else None), (behind[0][0] if behind else None)
        if best is not None and (f is None or r is None or f + r > best):
            break                                  # a side that ran dry has settled all that it reaches
        if f is None or r is None:
            return None
        if f <= r:
            cost, at, state = heapq.heappop(ahead)
            node = (at, state)
            if node in settled_front:
                continue
            settled_front.add(node)
            for taken, more, audit, then in edges[at][state]:
                new, to = (cost + more, front[node][1] + audit), (at + taken, then)
                if to not in front or new < front[to]:
                    front[to] = new
                    heapq.heappush(ahead, (new[0], *to))
                if to in rear and (best is None or new[0] + rear[to][0] < best):
                    best = new[0] + rear[to][0]
        else:
            cost, down, state = heapq.heappop(behind)
            node = (last - down, state)
            if node in settled_rear:
                continue
            settled_rear.add(node)
            for to, more, audit in back.get(node, ()):
                new = (cost + more, audit + rear[node][1])
                if to not in rear or new < rear[to]:
                    rear[to] = new
                    heapq.heappush(behind, (new[0], last - to[0], to[1]))
                if to in front and (best is None or new[0] + front[to][0] < best):
                    best = new[0] + front[to][0]
    if best is None:
        return None
    found = [front[last, e][1] for e in ends if (last, e) in settled_front and front[last, e][0] == best]
    if (0, start) in settled_rear and rear[0, start][0] == best:
        found.append(rear[0, start][1])
    for at, state in settled_front:
        cost, audit = front[at, state]
        for taken, more, letters, then in edges[at][state]:
            to = (at + taken, then)
            if to in settled_rear and cost + more + rear[to][0] == best:
                found.append(audit + letters + rear[to][1])
    audit = min(found)
    return best, audit, _end(edges, start, audit)


def _end(edges: list, start: int, audit: str) -> int:
    at, state, left = 0, start, audit
    while left:
        for taken, _, letters, then in edges[at][state]:
            if left.startswith(letters):           # a node's edges differ in their first letter
                at, state, left = at + taken, then, left[len(letters):]
                break
    return state


def edited(rows: list[tuple[str, str, int]], audit: str, start: int) -> list[tuple[str, str, str]]:
    """(edit, role, text) of each turn that stays, from rows (role, text, copies)."""
    out, state, at, copy = [], start, 0, 0
    for edit in audit:
        role = text = ""
        if edit != "I":
            role, text, copies = rows[at]
            copy += 1
            if copy == copies:
                at, copy = at + 1, 0
        if edit == "D":
            continue
        letter = role[:1] if edit == "K" else ("u" if "u" in STEP[state] else "a")
        out.append((edit, role if edit == "K" else ROLE[letter], text))
        state = STEP[state][letter]
    return out


_STATS = "n long, first_turn long, last_turn long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string"
_AUDITS = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"


def _described(rows: list[tuple]) -> tuple[list[Row], list]:
    """The lattice's rows and the counts (`_STATS`) of rows (turn, role, text, copies, later)."""
    lattice, blank, duplicate, truncated, illegal, before, turns, seen = [], 0, 0, 0, 0, None, 0, None
    for turn, role, text, copies, later in rows:
        last = _LAST.search(text)
        gone = last is None or later
        cut = not gone and last.group(1) not in ".!?"
        blank += copies if last is None else 0
        duplicate += 0 if last is None else copies if later else copies - 1
        truncated += cut
        initial = role[:1]
        illegal += copies - 1 + (before is not None and before + initial not in LEGAL)
        before = initial
        turns += turn is not None and turn != seen
        seen = turn
        lattice.append((role, copies, gone, cut))
    known = [r[0] for r in rows if r[0] is not None]
    stats = [sum(r[3] for r in rows), rows[0][0], rows[-1][0], min(known, default=None), max(known, default=None), turns, blank, duplicate, truncated, illegal,
             rows[0][1][:1], rows[-1][1][:1]]
    return lattice, stats


def _chained(parts: list[list]) -> list:
    """The counts of a conversation from its segments' in order."""
    out = list(parts[0])
    for p in parts[1:]:
        out[5] += p[5] - (p[1] is not None and p[1] == out[2])
        out[9] += p[9] + (out[11] + p[10] not in LEGAL)
        for k in (0, 6, 7, 8):
            out[k] += p[k]
        out[3] = min((x for x in (out[3], p[3]) if x is not None), default=None)
        out[4] = max((x for x in (out[4], p[4]) if x is not None), default=None)
        out[2], out[11] = p[2], p[11]
    return out


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch once, with their number."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["conv_id", "turn", "role", "text"], use_threads=False).aggregate([([], "count_all")])
        t = t.select(["conv_id", "turn", "role", "text", "count_all"]).rename_columns(["conv_id", "turn", "role", "text", "copies"])
        yield from t.combine_chunks().to_batches()


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Staged segments (at most ``segment`` rows) of rows (conv_id, turn, role, text): their counts, rows and cheapest audits.

    (conv_id, shard, segment) orders a conversation's segments; a ``whole`` one is its conversation, with one audit.
    """
    space = F.lit(" ")
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.select("conv_id", F.col("turn").cast("long"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = rows.mapInArrow(_combined, f"conv_id {kind}, turn long, role string, text string, copies long")
    said = F.md5(F.to_json(F.struct(F.col("conv_id").isNull().alias("no"), F.col("conv_id").cast("string").alias("id"), "role", "text")).cast("binary"))
    rows = rows.withColumn("said", said)
    first = rows.groupBy("said").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first"), F.sum("copies").alias("times"))
    first = first.filter("times > 1").select("said", "first.some", F.col("first.turn").alias("first_turn"))
    later = F.coalesce(F.col("some") & ~F.col("turn").eqNullSafe(F.col("first_turn")) | ~F.col("some") & F.col("turn").isNotNull(), F.lit(False))
    flagged = rows.join(first, "said", "left").select("conv_id", "turn", "role", "text", "copies", later.alias("later"))
    order = ["conv_id", "turn", "role", "text"]
    spread = flagged.repartitionByRange(*order[:3], F.substring("text", 1, BORDER)).sortWithinPartitions(*order)
    schema = (f"conv_id {kind}, shard int, segment long, whole boolean, {_STATS}, rows array<struct<role:string,text:string,copies:bigint>>, audits {_AUDITS}")
    from pyspark.sql.pandas.types import to_arrow_schema
    out_schema = to_arrow_schema(spread.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, done, number = TaskContext.get().partitionId(), [], 0
        now, held, size, alone = None, [], 0, False       # alone: the run began in this task and is in one segment so far

        def close(whole: bool) -> None:
            nonlocal number, held, size
            lattice, stats = _described(held)
            edges = _edges(lattice)
            audits = []
            for entry in ([0] if whole else range(STATES)):
                for ends in ([ENDS] if whole else [(e,) for e in range(STATES)]):
                    got = cheapest(edges, entry, ends)
                    if got:
                        audits.append({"entry": entry, "exit": got[2], "cost": got[0], "audit": got[1]})
            done.append([now, shard, number, whole, *stats, [{"role": r[1], "text": r[2], "copies": r[3]} for r in held], audits])
            number, held, size = number + 1, [], 0

        def flush() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], f.type) for k, f in enumerate(out_schema)], schema=out_schema)
            done.clear()
            return b

        started, out_bytes = False, 0
        for b in batches:
            for conv, turn, role, text, copies, later in zip(*(c.to_pylist() for c in b.columns), strict=True):
                row = (turn, role, text, copies, later)
                if started and conv != now:
                    if held:
                        close(alone)
                    alone = True
                elif held and held[-1][:3] == row[:3]:          # equal rows of several batches
                    held[-1] = (*row[:3], held[-1][3] + copies, later)
                    continue
                elif len(held) >= segment or size >= SEGMENT_BYTES:
                    close(False)
                    alone = False
                now, started = conv, True
                held.append(row)
                size += len(text)
                out_bytes += len(text)
                if len(done) >= 1000 or out_bytes >= SEGMENT_BYTES and done:
                    yield flush()
                    out_bytes = 0
        if held:
            close(False)
        if done:
            yield flush()

    return stage(spread.mapInArrow(run, schema), "repair-segments")


def decisions(parts: DataFrame) -> DataFrame:
    """Staged choices for the segments that aren't whole: entry and exit state of each, and on a conversation's last one its counts, cost and audit."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    names = [s.split()[0] for s in _STATS.split(", ")]
    narrow = parts.filter("not whole").select("conv_id", "shard", "segment", "audits", *names)
    ordered = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "shard", "segment")
    schema = f"conv_id {kind}, shard int, segment long, entry int, exit int, last boolean, {_STATS}, cost long, audit string"
    from pyspark.sql.pandas.types import to_arrow_schema
    out_schema = to_arrow_schema(parts.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started, where, stats, ways = None, False, [], None, {}

        def answer() -> pa.RecordBatch:
            cost, audit, states = min(w for s, w in ways.items() if s in ENDS)
            rows = [[now, *at, states[k], states[k + 1], False, *[None] * len(names), None, None] for k, at in enumerate(where)]
            rows[-1][5:] = [True, *stats, cost, audit]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out_schema)], schema=out_schema)

        for b in batches:
            for conv, shard, segment, audits, *own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not started or conv != now:
                    if started:
                        yield answer()
                    now, started, where, stats, ways = conv, True, [], None, {0: (0, "", bytes([0]))}
                where.append((shard, segment))
                stats = own if stats is None else _chained([stats, own])
                then: dict = {}
                for a in audits:
                    if a["entry"] in ways:
                        cost, audit, states = ways[a["entry"]]
                        way = (cost + a["cost"], audit + a["audit"], states + bytes([a["exit"]]))
                        if a["exit"] not in then or way < then[a["exit"]]:
                            then[a["exit"]] = way
                ways = then
        if started:
            yield answer()

    return stage(ordered.mapInArrow(run, schema), "repair-decisions")


def _counts(df: DataFrame, cost: Column, audit: Column) -> DataFrame:
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return df.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", cost.alias("cost"), audit.alias("audit"))


def summaries(parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): one row for each conversation."""
    whole = _counts(parts.filter("whole"), F.col("audits")[0]["cost"], F.col("audits")[0]["audit"])
    return whole.unionByName(_counts(chosen.filter("last"), F.col("cost"), F.col("audit")))


def repaired(parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, shard, segment, whole, turns array of (edit, role, text)): the conversations' turns after the edits, in segments."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    keys = ["conv_id", "shard", "segment", "whole"]
    whole = parts.filter("whole").select(*keys, "rows", F.lit(0).alias("entry"), F.col("audits")[0]["audit"].alias("audit"))
    found = parts.filter("not whole").join(chosen.select("shard", "segment", "entry", "exit"), ["shard", "segment"])
    fits = F.filter("audits", lambda a: (a["entry"] == F.col("entry")) & (a["exit"] == F.col("exit")))
    cut = found.select(*keys, "rows", "entry", fits[0]["audit"].alias("audit"))
    schema = f"conv_id {kind}, shard int, segment long, whole boolean, turns array<struct<edit:string,role:string,text:string>>"
    turn = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for rows, entry, audit in zip(*(b.column(k).to_pylist() for k in (4, 5, 6)), strict=True):
                out = edited([(r["role"], r["text"], r["copies"]) for r in rows], audit, entry)
                made.append([{"edit": e, "role": r, "text": t} for e, r, t in out])
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(made, turn)], [*keys, "turns"])

    return whole.unionByName(cut).mapInArrow(run, schema)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): hex SHA-256 of each conversation's `role:text`, joined by line feeds.

    A conversation of several segments streams through one task, as a running digest asks for.
    """
    import hashlib

    kind = turns.schema["conv_id"].dataType.simpleString()
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = turns.filter("whole").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))
    ordered = (turns.filter("not whole").select("conv_id", "shard", "segment", F.size("turns").alias("k"), lines.alias("lines"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "shard", "segment"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = digest = None
        some = False
        for b in batches:
            convs, found = [], []
            for i, (k, text) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                conv = b.column(0)[i].as_py()
                if digest is None or conv != now:
                    if digest is not None:
                        convs.append(now)
                        found.append(digest.hexdigest())
                    now, digest, some = conv, hashlib.sha256(), False
                if k:
                    digest.update((("\n" if some else "") + text).encode())
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array(convs, b.column(0).type), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], b.column(0).type), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return whole.unionByName(ordered.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string"))
