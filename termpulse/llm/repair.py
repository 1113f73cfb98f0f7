"""Repair of the structure of conversations by the cheapest edits.

A sound conversation has an optional system turn and then pairs of user and assistant. Edits are Keep, Rerole (to user or
assistant), Delete and Insert (an empty user or assistant turn); the cheapest sequence of edits wins, and of equally cheap
ones that whose letters come first. A Viterbi search runs over the rows with one survivor for each state of that grammar (start, after
system, after user, after assistant).

Survivors are leaves of one tree of backpointers whose nodes count who refers to them. A node that no survivor leads back to
is freed; as soon as all survivors share an ancestor, the edits up to it are certain and are emitted. So memory holds
only what is unresolved. Tied candidates are compared on their complete unresolved suffixes: from where they part, the
first differing edits decide, because the edits of one row never begin those of another choice (inserts stand
before the row that they precede, and the row's own letter ends them). A survivor that is dearer than another one plus the edits that
make up for its state is dropped, since no continuation can make it the cheapest or a tie.

A conversation of any length is cut into segments of ``SEGMENT`` rows. Each is searched for every state at its start, and gives
cost and edits for each pair of states; a second search of the same kind over the segments picks the pairs. So a
conversation that holds a third of all rows is searched by many tasks, and only a few numbers a segment meet in one.
Places in a conversation come from ranges (``placed``), not from sorting it in one task.

Null conv_id: a conversation of its own. Null role or text: one space. Rows are taken by turn (null first); rows of equal
turn by role and digest, so repeated rows stand side by side. Role initials other than s, u and a are never legal and
must be reroled or deleted. Empty table: no rows. Extra columns do not take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse.llm import common
from termpulse.operators.places import placed

#: Rows of a segment.
SEGMENT = 4096
#: States of the grammar, and where a turn of each initial leads (s, u, a); others lead nowhere.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state that an inserted or reroled turn leads to; both always have the only legal role.
STEP = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits, and of a truncated row that is not deleted.
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: A row as one letter: its initial (x: any other) if it is sound, if it is truncated, if it must be deleted.
SOUND, CUT, GONE = "suax", "SUAX", "1234"
INITIAL = {letter: initial for letters in (SOUND, CUT, GONE) for letter, initial in zip(letters, SOUND)}
#: (state, other, more): a survivor in ``state`` is dropped if it is dearer than one in ``other`` by over ``more``. After an
#: assistant all goes on as at the start but for keeping a system row, which can be deleted; inserts reach the other states.
DROPPED = (
    (START, ASSISTANT, 2), (START, USER, 7), (SYSTEM, ASSISTANT, 0), (SYSTEM, USER, 5), (USER, ASSISTANT, 5), (ASSISTANT, USER, 5),
    (USER, START, 5), (USER, SYSTEM, 5), (ASSISTANT, START, 10), (ASSISTANT, SYSTEM, 10),
)


# ---- search


class Node:
    """A choice behind its parent's; ``refs`` counts children and survivors."""

    __slots__ = ("parent", "choice", "rank", "depth", "refs", "children")

    def __init__(self, parent: Node | None, choice, rank):
        self.parent, self.choice, self.rank, self.refs = parent, choice, rank, 0
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        if parent:
            parent.refs += 1
            parent.children.append(self)


def before(a: Node, b: Node) -> bool:
    """Whether the choices up to ``a`` come before those up to ``b``, a different node of the same depth."""
    while a.parent is not b.parent:
        a, b = a.parent, b.parent
    return a.rank < b.rank


class Survivors:
    """One cheapest path for each state. ``out`` gets the choices that all paths share, in order."""

    def __init__(self, state: int = START, cost: int = 0):
        self.root = Node(None, None, None)
        self.root.refs = 1
        self.paths: dict[int, tuple[int, Node]] = {state: (cost, self.root)}
        self.out: list = []

    def advance(self, moves) -> None:
        """``moves(state)`` gives (next state, cost, choice, rank): of equal costs the least ranks from the parting on win."""
        best: dict[int, tuple[int, Node, object, object]] = {}
        for state, (cost, node) in self.paths.items():
            for to, more, choice, rank in moves(state):
                held = best.get(to)
                if held is None or cost + more < held[0] or cost + more == held[0] and self._first((node, rank), held[1::2]):
                    best[to] = (cost + more, node, choice, rank)
        for state, other, more in DROPPED:
            if state in best and other in best and best[state][0] > best[other][0] + more:
                del best[state]
        old = [node for _, node in self.paths.values()]
        self.paths = {}
        for state, (cost, parent, choice, rank) in best.items():
            node = Node(parent, choice, rank)
            node.refs = 1
            self.paths[state] = (cost, node)
        for node in old:
            self._release(node)
        while self.root.refs == 1 and self.root.children:
            # all survivors share this child
            self.root = self.root.children[0]
            self.root.parent = None
            self.out.append(self.root.choice)

    @staticmethod
    def _first(a: tuple[Node, object], b: tuple[Node, object]) -> bool:
        return a[1] < b[1] if a[0] is b[0] else before(a[0], b[0])

    @staticmethod
    def _release(node: Node) -> None:
        node.refs -= 1
        while not node.refs and node.parent:
            parent = node.parent
            parent.children.remove(node)
            parent.refs -= 1
            node = parent

    def rest(self, state: int) -> list:
        """The unresolved choices of a survivor."""
        found, node = [], self.paths[state][1]
        while node is not self.root:
            found.append(node.choice)
            node = node.parent
        return found[::-1]

    def taken(self) -> list:
        """The resolved choices since the last call."""
        found, self.out = self.out, []
        return found

    def end(self) -> tuple[int, int, str]:
        """(state, cost, last inserts) of the cheapest path that ends soundly."""
        best = None
        for state, (cost, node) in self.paths.items():
            inserts = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[state]
            cost += inserts * COST[INSERT]
            if best is None or cost < best[1] or cost == best[1] and before(node, best[3]):
                best = (state, cost, INSERT * inserts, node)
        return best[:3]


def row_moves(letter: str):
    """What a row allows in each state: inserts before it, then its own edit."""
    initial, cut = INITIAL[letter], TRUNCATED if letter in CUT else 0
    table = []
    for state in range(4):
        found, at = [], state
        for inserts in range(3):
            lead, cost = INSERT * inserts, inserts * COST[INSERT]
            found.append((at, cost + COST[DELETE], lead + DELETE))
            if letter not in GONE:
                if initial in NEXT[at]:
                    found.append((NEXT[at][initial], cost + COST[KEEP] + cut, lead + KEEP))
                found.append((STEP[at], cost + COST[REROLE] + cut, lead + REROLE))
            at = STEP[at]
        table.append([(to, cost, edits, edits) for to, cost, edits in found])
    return table


MOVES = {letter: row_moves(letter) for letter in INITIAL}


def searched(letters: str, state: int) -> dict[int, tuple[int, str]]:
    """Of each state at the end: cost and edits of the rows ``letters`` from ``state`` on."""
    found = Survivors(state)
    for letter in letters:
        found.advance(MOVES[letter].__getitem__)
    sure = "".join(found.taken())
    return {end: (cost, sure + "".join(found.rest(end))) for end, (cost, _) in found.paths.items()}


def illegal(initials: str) -> int:
    """Neighbours that do not follow each other."""
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


# ---- Spark


SPACES = " \t\n\x0b\x0c\r"


def conversation(conv_id: str = "conv_id") -> Column:
    """The key ``conv`` of a conversation."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def marked(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, conv_id, place, turn, role, text, fault`` (blank, duplicate, truncated or null) and ``letter`` of every row."""
    own = rows.select(
        conversation(conv_id).alias("conv"),
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    own = common.stage(own.withColumns({"digest": digest, "number": F.monotonically_increasing_id()}), "turns")
    found = common.stage(placed(own, ["conv"], ["turn", "role", "digest", "number"]), "placed-turns")
    # only those that are there more than once
    firsts = found.groupBy("conv", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    found = found.join(common.stage(firsts, "repeated-turns"), ["conv", "digest"], "left")
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = (
        F.when(last == "", F.lit("blank"))
        .when(F.col("place") > F.col("first"), F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
    )
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    letters = F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE)).when(F.col("fault") == "truncated", F.lit(CUT)).otherwise(F.lit(SOUND))
    found = found.withColumn("fault", fault).withColumn("letter", letters.substr(kind, F.lit(1)))
    return found.select("conv", "conv_id", "place", "turn", "role", "text", "fault", "letter")


EXIT = "struct<entry:int,exit:int,cost:long,rank:int,edits:string>"


def _segments(rows: DataFrame, size: int) -> DataFrame:
    """``conv, segment, letters, exits``: what each segment costs from each state to each, and its edits."""
    cut = rows.groupBy("conv", F.floor(F.col("place") / size).cast("long").alias("segment"))
    # at most ``size`` rows
    found = cut.agg(F.sort_array(F.collect_list(F.struct("place", "letter"))).alias("rows")).select("conv", "segment", F.array_join("rows.letter", "").alias("letters"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.string())]))
        for batch in batches:
            out = []
            for segment, letters in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                exits = []
                for entry in range(4) if segment else (START,):
                    ends = searched(letters, entry)
                    order = sorted(ends, key=lambda end: ends[end][1])
                    exits += [{"entry": entry, "exit": end, "cost": ends[end][0], "rank": rank, "edits": ends[end][1]} for rank, end in enumerate(order)]
                out.append(exits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, "exits"])

    return found.mapInArrow(search, f"conv string, segment long, letters string, exits array<{EXIT}>")


def _chosen(segments: DataFrame) -> DataFrame:
    """``conv, segment, entry, exit, ending, cost, between``: the pair of states of each segment; its last one has the last
    inserts and the conversation's cost. ``between``: whether the turns where it meets the next segment are legal neighbours."""
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bare = F.transform("exits", lambda x: F.struct(x["entry"].alias("entry"), x["exit"].alias("exit"), x["cost"].alias("cost"), x["rank"].alias("rank")))
    narrow = segments.select("conv", "segment", F.substring("letters", 1, 1).alias("head"), F.substring("letters", -1, 1).alias("tail"), bare.alias("exits"))
    dealt = narrow.repartition(n, "conv").sortWithinPartitions("conv", "segment")
    names = ["conv", "segment", "entry", "exit", "ending", "cost", "between"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = found = tail = None
        out: list[tuple] = []

        def close() -> None:
            state, cost, ending = found.end()
            pairs = found.taken() + found.rest(state)
            out.extend((conv, *p[:3], "", 0, p[3]) for p in pairs[:-1])
            out.append((conv, *pairs[-1][:3], ending, cost, pairs[-1][3]))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)

        for batch in batches:
            for key, segment, head, end, exits in zip(*(c.to_pylist() for c in batch.columns)):
                if key != conv or found is None:
                    if found is not None:
                        close()
                    conv, found, tail = key, Survivors(), None
                between = illegal(INITIAL[tail] + INITIAL[head]) if tail else 0
                tail = end
                # choices of earlier segments; that of the last one carries the end
                out.extend((conv, *p[:3], "", 0, p[3]) for p in found.taken())
                by: dict[int, list] = {}
                for x in exits:
                    by.setdefault(x["entry"], []).append((x["exit"], x["cost"], (segment, x["entry"], x["exit"], between), x["rank"]))
                found.advance(lambda state, by=by: by.get(state, ()))
            if len(out) > 50_000:
                yield batch_of(out)
                out = []
        if found is not None:
            close()
        yield batch_of(out)

    return dealt.mapInArrow(choose, "conv string, segment long, entry int, exit int, ending string, cost long, between long")


@dataclass(frozen=True)
class Repair:
    """``rows``: every row with its fault (staged). ``segments``: ``conv, segment, letters, entry, edits, cost, illegal`` (staged)."""

    rows: DataFrame
    segments: DataFrame
    size: int

    def edits(self) -> DataFrame:
        """One row for each edit: ``conv, place`` (of the row, or of that behind an insert), ``ord, edit, new_role`` (null: as it was)."""
        size = self.size

        def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for conv, segment, letters, state, edits in zip(*(c.to_pylist() for c in batch.columns)):
                    place, order, out = segment * size, 0, []
                    for edit in edits:
                        role, at = None, place
                        if edit in (INSERT, REROLE):
                            state = STEP[state]
                            role = ROLE[state]
                        elif edit == KEEP:
                            state = NEXT[state][INITIAL[letters[place - segment * size]]]
                        out.append((conv, at, order, edit, role))
                        order += 1
                        if edit != INSERT:
                            place, order = place + 1, 0
                    columns = zip(*out) if out else [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()))], ["conv", "place", "ord", "edit", "new_role"])

        bare = self.segments.select("conv", "segment", "letters", "entry", "edits")
        return bare.mapInArrow(opened, "conv string, place long, ord int, edit string, new_role string")

    def repaired(self) -> DataFrame:
        """The turns that result: ``conv, place, ord, role, text``, in the order of (place, ord)."""
        kept = self.edits().filter(F.col("edit") != DELETE).join(self.rows.select("conv", "place", "role", "text"), ["conv", "place"], "left")
        text = F.when(F.col("edit") == INSERT, F.lit("")).otherwise(F.col("text"))
        return kept.select("conv", "place", "ord", F.coalesce("new_role", "role").alias("role"), text.alias("text"))

    def summary(self) -> DataFrame:
        """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation that has rows."""
        faults = [F.count(F.when(F.col("fault") == kind, 1)).alias(kind) for kind in ("blank", "duplicate", "truncated")]
        turns = self.rows.groupBy("conv", "turn").agg(*faults)
        span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        counts = turns.groupBy("conv").agg(F.coalesce(span, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
        parts = self.segments.groupBy("conv").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("segment", "edits"))).alias("parts")
        )
        return counts.join(parts, "conv").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.array_join("parts.edits", "").alias("audit"))


def repair(rows: DataFrame, size: int = SEGMENT, **names: str) -> Repair:
    """The cheapest repair of every conversation of ``rows``; ``names`` are those of its columns (see ``marked``)."""
    found = common.stage(marked(rows, **names), "marked-turns")
    segments = common.stage(_segments(found, size), "segments")
    pairs = _chosen(segments)
    own = F.filter("exits", lambda x: (x["entry"] == F.col("entry")) & (x["exit"] == F.col("exit")))[0]
    # initials alone, so that neighbours can be counted
    initials = F.translate("letters", SOUND + CUT + GONE, SOUND * 3)
    neighbours = F.size(F.regexp_extract_all(initials, F.lit("(?=(su|ua|au))"), F.lit(1)))
    chosen = segments.join(pairs, ["conv", "segment"]).select(
        "conv", "segment", "letters", "entry", F.concat(own["edits"], "ending").alias("edits"), "cost", (F.length("letters") - 1 - neighbours + F.col("between")).cast("long").alias("illegal")
    )
    return Repair(found, common.stage(chosen, "repairs"), size)


def digests(turns: DataFrame) -> DataFrame:
    """``conv, sha256`` of the conversations of ``Repair.repaired``: their ``role:text`` lines, hashed as they stream by."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartition(n, "conv").sortWithinPartitions("conv", "place", "ord").select("conv", F.concat("role", F.lit(":"), "text").alias("line"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = line.as_py().encode("utf-8")
                if conv != at or state is None:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = conv, hashlib.sha256(raw)
                else:
                    state.update(b"\n" + raw)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], pa.string()) for k in (0, 1)], ["conv", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], ["conv", "sha256"])

    return dealt.mapInArrow(hashed, "conv string, sha256 string")
