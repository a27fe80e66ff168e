"""Repair of the turn structure of conversations by an auction algorithm for shortest paths.

A conversation's rows, in order of turn, are to be edited at least cost until the initials of their roles read
``(s?(ua)+)?``.  The edits form a lattice: a node is (rows done, state of that pattern), an arc keeps, re-roles or
deletes the next row or inserts an empty one.  Bertsekas' auction finds the shortest paths: it holds a price for each
node and one path; the path's end moves along an arc that its price allows (extension) or, where there is none, its
price rises to the least arc plus price ahead and the path steps back (contraction).  Costs are whole numbers and no
cycle is free, so prices converge to dual prices; every cheapest edit runs along tight arcs (price = arc + price
ahead), and the least audit string follows the least tight label that still reaches the end.

Long conversations are solved in blocks of ``BLOCK`` rows from the last to the first, each with the prices of the
next one's entry as costs of its exits: work grows with the rows.  Rows are dealt by ranges of (conversation, turn,
role, text), so a conversation of any size is split over tasks.  What lies whole in one task and has at most
``SEGMENT`` rows is solved there; of others each segment first gives its 4 x 4 matrix of cheapest costs between
states, one small pass chains the matrices (one row per segment; an audit string, hence a result row, cannot exceed 2^31
characters, so at most 2^31 / SEGMENT rows besides one per task), and the segments are traced at once for each entry
state.  Texts take no part in this.  They are then read once in order, a batch at a time, by the task that
writes the conversation's result: a digest over a whole conversation can only be taken in order.

Defined cases: null roles and texts count as one space; a null conversation id is a conversation; null turns come
first; rows of the same turn are ordered by role, then by the SHA-256 of the text; equal rows are copies and stand
together (they are counted before any sort, so that a third of all rows being copies fills no task); other roles, also
empty ones, can be re-roled or deleted only; empty tables give no rows.  Only the named columns are read, internal
columns start with ``_c_``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import has_rows, saved, shuffle_partitions

BLOCK = 8
SEGMENT = 4096

#: Costs of the edits Delete, Insert, Keep, Rerole; a row cut off in the middle costs more if it stays.
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED = 3
NO_ROW = float("inf")

#: States of the pattern: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEEPS = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: The state after a re-roled or inserted row (a user's or an assistant's, whichever the pattern takes).
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Rows inserted after the last one, by state, and what they cost.
TAIL = ("", "II", "I", "")
END = tuple(COST["I"] * len(t) for t in TAIL)

SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}


# --- lattice -----------------------------------------------------------------------------------------------------

def lattice(codes: str, exits: Iterable[float]) -> list[list[tuple[str, float, int]]]:
    """Arcs (label, cost, head) of each node 4 * rows done + state, labels ascending; the last node is the end.
    ``codes`` has a letter a row: d must go, else its initial (o for other roles), upper case if cut off."""
    arcs: list[list[tuple[str, float, int]]] = []
    end = 4 * len(codes) + 4
    for i, code in enumerate(codes):
        more = TRUNCATED if code.isupper() else 0
        keeps = KEEPS.get(code.lower(), {})
        for q in range(4):
            out = [("D", COST["D"], 4 * i + 4 + q), ("I", COST["I"], 4 * i + NEXT[q])]
            if code != "d":
                if q in keeps:
                    out.append(("K", COST["K"] + more, 4 * i + 4 + keeps[q]))
                out.append(("R", COST["R"] + more, 4 * i + 4 + NEXT[q]))
            arcs.append(out)
    arcs += [[("", x, end)] if x < NO_ROW else [] for x in exits]
    arcs.append([])
    return arcs


def reaching(arcs: list[list[tuple[str, float, int]]]) -> list[bool]:
    """Whether each node leads to the last one.  Heads are of a later row, but for inserts, which stay in theirs."""
    end = len(arcs) - 1
    leads = [False] * end + [True]
    for first in range(end - 4, -1, -4):
        for _ in range(3):
            for i in range(first, first + 4):
                leads[i] = leads[i] or any(leads[j] for _, _, j in arcs[i])
    return leads


def auction(arcs: list[list[tuple[str, float, int]]], origins: Iterable[int]) -> list[float]:
    """Prices under which price[i] <= cost + price[j] on every arc, with price[origin] the least cost from each
    origin to the last node (infinite if there is no way).  Prices stay from one origin to the next.

    Nodes without a way have an infinite price from the outset: along the circles of inserts theirs would rise for ever."""
    end = len(arcs) - 1
    price = [0.0 if there else NO_ROW for there in reaching(arcs)]
    for origin in origins:
        path = [origin]
        while path[-1] != end and price[origin] < NO_ROW:
            i = path[-1]
            best, ahead = NO_ROW, -1
            for _, cost, j in arcs[i]:
                if cost + price[j] < best:
                    best, ahead = cost + price[j], j
            if price[i] < best:
                price[i] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(ahead)
    return price


def prices(codes: str, exits: Iterable[float], block: int = BLOCK) -> tuple[list[float], list]:
    """The least cost from each of the four states before ``codes`` to its exits (at their costs), and the blocks
    (arcs, prices) from first to last."""
    blocks, entry = [], list(exits)
    for at in range((max(len(codes) - 1, 0) // block) * block, -1, -block):
        base = min(entry)  # prices begin at 0 and rise step by step, so what all exits cost is left out of the block
        arcs = lattice(codes[at : at + block], [x - base for x in entry])
        price = auction(arcs, range(4))
        blocks.append((arcs, price))
        entry = [x + base for x in price[:4]]
    return entry, blocks[::-1]


def trace(blocks: list, state: int) -> tuple[str, int]:
    """The least string of labels among the cheapest ways from ``state``, and the state in which it ends."""
    said = []
    for arcs, price in blocks:
        end = len(arcs) - 1
        tight = [[a for a in out if a[1] + price[a[2]] == price[i]] for i, out in enumerate(arcs)]
        leads = reaching(tight)
        node = state
        while node < end - 4:
            label, _, node = next(a for a in tight[node] if leads[a[2]])
            said.append(label)
        state = node - (end - 4)
    return "".join(said), state


# --- segments ----------------------------------------------------------------------------------------------------

def _segments(most: int):
    """Sorted rows (conv, code) -> segments of at most ``most`` rows of a conversation.  ``open``: the conversation may go
    on in another segment, so its matrix is given; else its edits are."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: list = []  # finished segments not yet yielded
        conv = codes = None  # the current segment
        whole = False  # whether it begins its conversation
        types = None

        def close(ended: bool):
            nonlocal number
            text = "".join(codes)
            if whole and ended:
                _, blocks = prices(text, END)
                said, state = trace(blocks, START)
                held.append((conv, part, number, False, text, said + TAIL[state], None))
            else:
                unit = [prices(text, [0.0 if x == q else NO_ROW for x in range(4)])[0] for q in range(4)]
                held.append((conv, part, number, True, text, None, [unit[q][p] for p in range(4) for q in range(4)]))
            number += 1

        def batch():
            c, p, n, o, t, e, m = zip(*held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, types), pa.array(p, pa.int32()), pa.array(n, pa.int32()), pa.array(o, pa.bool_()),
                 pa.array(t, pa.string()), pa.array(e, pa.string()), pa.array(m, pa.list_(pa.float64()))],
                names=["conv", "part", "seg", "open", "codes", "edits", "costs"])

        seen = False
        for b in batches:
            types = b.schema.field(0).type
            for c, code in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if codes is None or c != conv:
                    if codes is not None:
                        close(True)
                    whole, seen, conv, codes = seen, True, c, []
                elif len(codes) == most:
                    close(False)
                    whole, codes = False, []
                codes.append(code)
                if len(held) >= 1000:
                    yield batch()
        if codes is not None:
            close(False)
            yield batch()

    return run


def _chain_back(group: pa.Table) -> pa.Table:
    """Costs at the exits of each segment of one conversation, from the last to the first."""
    group = group.sort_by([("part", "ascending"), ("seg", "ascending")])
    exits, out = list(END), []
    for m in reversed(group.column("costs").to_pylist()):
        out.append(exits)
        exits = [min(m[4 * p + q] + exits[q] for q in range(4)) for p in range(4)]
    return pa.table({"part": group.column("part"), "seg": group.column("seg"), "exits": pa.array(out[::-1], pa.list_(pa.float64()))})


def _trace_open(batches):
    """Edits and last state of each open segment for each of the four states before it."""
    for b in batches:
        ends, said = [], []
        for codes, exits in zip(b.column("codes").to_pylist(), b.column("exits").to_pylist()):
            _, blocks = prices(codes, exits)
            ways = [trace(blocks, q) for q in range(4)]
            said.append([w[0] for w in ways])
            ends.append([w[1] for w in ways])
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), b.column("part"), b.column("seg"), b.column("codes"), pa.array(said, pa.list_(pa.string())),
             pa.array(ends, pa.list_(pa.int32()))], names=["conv", "part", "seg", "codes", "ways", "ends"])


def _chain_on(group: pa.Table) -> pa.Table:
    """The state before each segment of one conversation, from the first to the last, and what follows the last."""
    group = group.sort_by([("part", "ascending"), ("seg", "ascending")])
    state, entries = START, []
    for ends in group.column("ends").to_pylist():
        entries.append(state)
        state = ends[state]
    tails = [""] * (len(entries) - 1) + [TAIL[state]]
    return pa.table({"part": group.column("part"), "seg": group.column("seg"), "entry": pa.array(entries, pa.int32()),
                     "tail": pa.array(tails, pa.string())})


def edits(slim: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, part, seg, codes, edits): the cheapest edits of all rows of ``slim`` (conv, turn, role, digest, code), in
    pieces whose order within a conversation is (part, seg).  ``edits`` has one letter a row and the inserts before it."""
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest"]
    ranged = slim.repartitionByRange(shuffle_partitions(slim.sparkSession), *order).sortWithinPartitions(*order)
    kind = slim.schema["conv"].dataType.simpleString()
    found = saved(ranged.select("conv", "code").mapInArrow(
        _segments(segment), f"conv {kind}, part int, seg int, open boolean, codes string, edits string, costs array<double>"),
        "conversation-segments")
    pieces = found.filter(~F.col("open")).select("conv", "part", "seg", "codes", "edits")
    open_ = found.filter("open")
    if not has_rows(open_):
        return pieces
    exits = open_.select("conv", "part", "seg", "costs").groupBy("conv").applyInArrow(
        _chain_back, "part int, seg int, exits array<double>")
    traced = saved(open_.select("conv", "part", "seg", "codes").join(exits, ["part", "seg"]).mapInArrow(
        _trace_open, f"conv {kind}, part int, seg int, codes string, ways array<string>, ends array<int>"), "conversation-ways")
    entries = traced.select("conv", "part", "seg", "ends").groupBy("conv").applyInArrow(
        _chain_on, "part int, seg int, entry int, tail string")
    return pieces.unionByName(traced.join(entries, ["part", "seg"]).select(
        "conv", "part", "seg", "codes", F.concat(F.get("ways", "entry"), "tail").alias("edits")))


# --- rows --------------------------------------------------------------------------------------------------------

def trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE))


def counted(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows (conv, turn, role, text, digest, n copies), nulls of role and text as one space."""
    one = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    return one.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", F.sha2("text", 256))


def coded(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, code) of ``counted`` rows; a role and text seen in an earlier turn must go."""
    last = F.right(trimmed(F.col("text")), F.lit(1))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    slim = rows.select("conv", "turn", "role", "digest", F.when(last == "", "d").when(
        last.isin(".", "!", "?"), letter).otherwise(F.upper(letter)).alias("code"))
    first = slim.groupBy(F.col("conv").alias("_c_conv"), F.col("role").alias("_c_role"), F.col("digest").alias("_c_digest")).agg(
        F.min(F.struct("turn"))["turn"].alias("_c_turn"))
    # keys of both sides are distinct, so no key is hot
    joined = slim.join(first, (F.col("digest") == F.col("_c_digest")) & (F.col("role") == F.col("_c_role")) & F.col("turn").eqNullSafe(
        F.col("_c_turn")) & F.col("conv").eqNullSafe(F.col("_c_conv")), "left")
    return joined.select("conv", "turn", "role", "digest", F.when(F.col("_c_role").isNull(), "d").otherwise(F.col("code")).alias("code"))


def _ordered(ids: DataFrame, rows: DataFrame, segment: int) -> DataFrame:
    """Conversations in tasks, each as its id (kind 0), its pieces of edits (1) and its rows in order (2)."""
    rows = saved(rows, "conversation-rows")
    pieces = edits(saved(coded(rows), "conversation-codes"), segment)
    none = F.lit(None)
    empty = [none.cast("long").alias("a"), none.cast("long").alias("b"), F.lit("").alias("role"), F.lit("").alias("digest")]
    stream = ids.select(F.col(ids.columns[0]).alias("conv")).distinct().select(
        "conv", F.lit(0).alias("kind"), *empty, F.lit("").alias("text"), none.cast("string").alias("codes"), F.lit(0).cast("long").alias("n"))
    stream = stream.unionByName(pieces.select(
        "conv", F.lit(1).alias("kind"), F.col("part").cast("long").alias("a"), F.col("seg").cast("long").alias("b"),
        *empty[2:], F.col("edits").alias("text"), "codes", F.lit(0).cast("long").alias("n")))
    stream = stream.unionByName(rows.select(
        "conv", F.lit(2).alias("kind"), F.col("turn").alias("a"), empty[1], "role", "digest", "text", none.cast("string").alias("codes"), "n"))
    return stream.repartition(shuffle_partitions(rows.sparkSession), "conv").sortWithinPartitions(
        "conv", "kind", F.col("a").asc_nulls_first(), "b", "role", "digest").select("conv", "kind", "a", "role", "text", "codes", "n")


class _Conversation:
    """Walks through one conversation's edits and rows in order; ``row`` returns its repaired lines (edit, turn, role, text)."""

    def __init__(self, conv):
        self.conv, self.codes, self.said, self.at, self.i, self.state = conv, [], [], 0, 0, START
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.turns = self.low = self.high = self.last = self.initial = None
        self.audit: list[str] = []

    def piece(self, codes: str, said: str) -> None:
        self.codes.append(codes)
        self.said.append(said)

    def _joined(self) -> None:
        if isinstance(self.said, list):
            self.codes, self.said = "".join(self.codes), "".join(self.said)

    def _inserts(self) -> list:
        out = []
        while self.said[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            self.cost += COST["I"]
            self.audit.append("I")
            out.append(("I", None, "user" if self.state == AFTER_U else "assistant", ""))
        return out

    def row(self, turn: int | None, role: str, text: str, n: int) -> list:
        self._joined()
        out = self._inserts()
        code, label = self.codes[self.i], self.said[self.at]
        self.i, self.at = self.i + 1, self.at + 1
        self.audit.append(label + "D" * (n - 1))
        self.cost += COST[label] + COST["D"] * (n - 1)
        if code == "d":
            if text.strip(SPACE):
                self.duplicate += n
            else:
                self.blank += n
        else:
            self.duplicate += n - 1
            self.truncated += code.isupper()
            self.cost += TRUNCATED * (code.isupper() and label != "D")
        self.illegal += (self.initial is not None and self.initial + role[:1] not in LEGAL) + n - 1
        self.initial = role[:1]
        if turn is not None:
            self.turns = (self.turns or 0) + (turn != self.last)
            self.low, self.high, self.last = turn if self.low is None else self.low, turn, turn
        if label == "K":
            self.state = KEEPS[code.lower()][self.state]
            out.append((label, turn, role, text))
        elif label == "R":
            self.state = NEXT[self.state]
            out.append((label, turn, "user" if self.state == AFTER_U else "assistant", text))
        return out

    def end(self) -> list:
        self._joined()
        return self._inserts()

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _walk(batches) -> Iterator[tuple]:
    """(conversation, new lines, whether it is over) along a sorted stream of ``_ordered``."""
    now = None
    for b in batches:
        for conv, kind, a, role, text, codes, n in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or kind == 0:
                if now is not None:
                    yield now, now.end(), True
                now = _Conversation(conv)
            if kind == 1:
                now.piece(codes, text)
            elif kind == 2:
                yield now, now.row(a, role, text, n), False
    if now is not None:
        yield now, now.end(), True


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             segment: int = SEGMENT) -> DataFrame:
    """The repaired rows: the conversation's id, place (from 0), edit (K, R or I), turn (null if inserted), role, text."""
    kind = rows.schema[conv].dataType.simpleString()
    names = [conv, "place", "edit", "turn", "role", "text"]

    def run(batches):
        held, size, place, of, types = [], 0, 0, None, None

        def noted():
            nonlocal types
            for b in batches:
                types = b.schema.field(0).type
                yield b

        def batch():
            columns = list(zip(*held))
            held.clear()
            kinds = [types, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for now, lines, _ in _walk(noted()):
            if now is not of:
                of, place = now, 0
            for label, t, who, said in lines:
                held.append((now.conv, place, label, t, who, said))
                place, size = place + 1, size + len(said)
            if len(held) >= 10_000 or size > 16_000_000:
                size = 0
                yield batch()
        if held:
            yield batch()

    ids = rows.select(conv)
    return _ordered(ids, counted(rows, conv, turn, role, text), segment).mapInArrow(
        run, f"`{conv}` {kind}, place bigint, edit string, turn bigint, role string, text string")


def digests(rows: DataFrame, ids: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``ids`` (its first column): gaps, blank, duplicate, truncated, illegal, cost, audit and the
    SHA-256 of the repaired lines ``role:text``, joined by newlines."""
    kind = rows.schema[conv].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches):
        held, types, of, sha, lines_so_far = [], None, None, None, 0

        def noted():
            nonlocal types
            for b in batches:
                types = b.schema.field(0).type
                yield b

        def batch():
            columns = list(zip(*held))
            held.clear()
            kinds = [types, *[pa.int64()] * len(counts), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=[conv, *counts, "audit", "repaired_sha256"])

        for now, lines, over in _walk(noted()):
            if now is not of:
                of, sha, lines_so_far = now, hashlib.sha256(), 0
            for _, _, who, said in lines:
                sha.update(b"\n" * (lines_so_far > 0) + f"{who}:{said}".encode())
                lines_so_far += 1
            if over:
                held.append((now.conv, now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal, now.cost,
                             "".join(now.audit), sha.hexdigest()))
            if len(held) >= 2000:
                yield batch()
        if held:
            yield batch()

    return _ordered(ids, counted(rows, conv, turn, role, text), segment).mapInArrow(
        run, f"`{conv}` {kind}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            one_in: int = 20) -> DataFrame:
    """``rows`` (the named columns) with planted faults, by crc32 of ``conv:turn`` modulo ``one_in``: 0 drops the row, 1 empties
    its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's.  Nulls count as one space."""
    def known(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    lot = F.crc32(F.encode(F.concat(known(conv), F.lit(":"), known(turn)), "UTF-8")) % one_in
    said = F.when(F.col("_c_lot") == 1, "").when(F.col("_c_lot") == 2, F.translate(known(text), ".!?", "")).otherwise(known(text))
    who = F.when(F.col("_c_lot") == 4, "user").otherwise(known(role))
    times = F.when(F.col("_c_lot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(conv, turn, role, text).withColumn("_c_lot", lot).filter("_c_lot <> 0").select(
        conv, turn, who.alias(role), said.alias(text), F.explode(times).alias("_c_time")).drop("_c_time")
