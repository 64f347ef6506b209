"""Repair of the turn structure of conversations by lightest derivations.

A conversation is sound if its roles are nothing, or an optional system turn and then user and
assistant in turn, the assistant last. Its rows may be kept, given another role or deleted, and empty
turns may be inserted. What can be derived are items: a prefix of the rows read up to a state of that
grammar. A deduction joins the prefix with the edit of the next row, or with an inserted turn; one
level up it joins a prefix of stretches with the way through the next stretch. Its weight is the sum
of costs and, behind it, the edits' initials laid end to end. Both parts only grow, and a lighter
antecedent never gives a heavier consequent, so items popped from an agenda in order of weight are
final (Knuth's generalisation of Dijkstra's search), and the search ends with the goal item.

Initials that are compared at equal cost are never the beginning of one another: such a rest would
consist of inserted turns, which cost something. So the order holds under what is laid behind.

Conversations of up to ``LONG`` rows are gathered whole in one task. Longer ones are laid out in
order over all tasks; each stretch of ``STRETCH`` rows is reduced to its lightest ways between states,
the ways of neighbouring stretches are joined level by level, and in the end rows and edits of a
conversation run past one another as a stream, since a digest is taken in order.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import saved

# Rows of a conversation that one task gathers, and rows whose edits are derived at once.
LONG = 4096
STRETCH = 256
# Runs of stretches that are joined from one level to the next.
FAN = 16
# Stretches of up to so many rows are remembered by a task, and how many of them.
REMEMBERED, KNOWN = 32, 20_000
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
BLANKS = " \t\n\v\f\r"
STOPS = ".!?"
# States: nothing yet, after system, after user, after assistant; and where each role leads from them.
START, SYSTEM, USER, ASSISTANT = range(4)
LEADS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENDS = (START, ASSISTANT)
GOAL = -1
NAMES = {"u": "user", "a": "assistant"}

Weight = tuple[int, str]
Ways = dict[tuple[int, int], Weight]


def lightest(axioms: Iterable[tuple[Weight, int]], deduce: Callable[[int, Weight], Iterable[tuple[Weight, int]]], goals: set[int]) -> dict[int, Weight]:
    """Final weights of items, up to the last of ``goals`` or until nothing can be derived.

    ``deduce`` gives the consequents that a newly final item makes with items final before it. An
    item is final when it leaves the agenda for the first time.
    """
    agenda, final, open_goals = list(axioms), {}, set(goals)
    heapq.heapify(agenda)
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        open_goals.discard(item)
        if not open_goals:
            break
        for found in deduce(item, weight):
            if found[1] not in final:
                heapq.heappush(agenda, found)
    return final


def row_edits(code: str) -> list[tuple[int, str, str]]:
    """``cost, initial, role`` of what may be done with a row; the role is empty if none is left.

    ``code`` is the initial of its role, ``x`` for others, in upper case if the text is truncated;
    ``b`` and ``d`` are blank and duplicate rows, which must go.
    """
    if code in "bd":
        return [(DELETE, "D", "")]
    extra, role = (TRUNCATED if code.isupper() else 0), code.lower()
    edits = [(DELETE, "D", ""), (REROLE + extra, "R", "u"), (REROLE + extra, "R", "a")]
    return edits + [(KEEP + extra, "K", role)] if role in "sua" else edits


EDITS = {code: row_edits(code) for code in "suaxSUAXbd"}


def _derived(codes: str, entry: int, goals: set[int]) -> dict[int, Weight]:
    """Final weights from ``entry`` on. Item ``4 * at + state`` is ``at`` rows read, ``GOAL`` all of them soundly."""
    n = len(codes)

    def deduce(item: int, weight: Weight) -> Iterator[tuple[Weight, int]]:
        at, state = divmod(item, 4)
        cost, initials = weight
        if at == n and state in ENDS:
            yield weight, GOAL
        for role, state_after in LEADS[state].items():
            if role != "s":
                yield (cost + INSERT, initials + "I"), 4 * at + state_after
        if at < n:
            for extra, initial, role in EDITS[codes[at]]:
                if not role:
                    yield (cost + extra, initials + initial), item + 4
                elif role in LEADS[state]:
                    yield (cost + extra, initials + initial), 4 * (at + 1) + LEADS[state][role]

    return lightest([((0, ""), entry)], deduce, goals)


def _from_state(codes: str, entry: int) -> dict[int, Weight]:
    """Lightest edits of a stretch from ``entry`` to every state that can be reached."""
    goals = {4 * len(codes) + state for state in range(4)}
    final = _derived(codes, entry, goals)
    return {goal % 4: final[goal] for goal in goals if goal in final}


def _to_goal(codes: str) -> Weight:
    return _derived(codes, START, {GOAL})[GOAL]


def _known(made: dict, key, make: Callable) -> object:
    """``make()``, remembered by ``key`` until ``KNOWN`` others are."""
    if key not in made:
        if len(made) >= KNOWN:
            made.clear()
        made[key] = make()
    return made[key]


_WAYS_OF: dict[tuple[str, int], dict[int, Weight]] = {}
_GOAL_OF: dict[str, Weight] = {}


def stretch_ways(codes: str, entries: Iterable[int] = range(4)) -> Ways:
    """Lightest edits of a stretch between states; equal short stretches are derived once a task."""
    found = {}
    for entry in entries:
        ways = _known(_WAYS_OF, (codes, entry), lambda: _from_state(codes, entry)) if len(codes) <= REMEMBERED else _from_state(codes, entry)
        found.update({(entry, state): weight for state, weight in ways.items()})
    return found


def joined_ways(stretches: list[Ways], entries: Iterable[int] = range(4)) -> Ways:
    """Lightest edits of stretches that follow one another: a prefix and the next one's way."""
    n = len(stretches)
    found = {}
    for entry in entries:

        def deduce(item: int, weight: Weight) -> Iterator[tuple[Weight, int]]:
            at, state = divmod(item, 4)
            if at < n:
                for state_after in range(4):
                    way = stretches[at].get((state, state_after))
                    if way is not None:
                        yield (weight[0] + way[0], weight[1] + way[1]), 4 * (at + 1) + state_after

        goals = {4 * n + state for state in range(4)}
        final = lightest([((0, ""), entry)], deduce, goals)
        found.update({(entry, goal % 4): final[goal] for goal in goals if goal in final})
    return found


def goal_weight(ways: Ways) -> Weight:
    """The goal item: lightest of the ways from the start to a state in which a conversation may end."""
    return lightest([(ways[START, state], GOAL) for state in ENDS if (START, state) in ways], lambda item, weight: (), {GOAL})[GOAL]


def cheapest_edits(codes: str) -> Weight:
    """``cost, initials`` of the cheapest edits that make a conversation sound, ties ASCII-least."""
    if len(codes) <= STRETCH:
        return _known(_GOAL_OF, codes, lambda: _to_goal(codes)) if len(codes) <= REMEMBERED else _to_goal(codes)
    parts = [codes[i : i + STRETCH] for i in range(0, len(codes), STRETCH)]
    return goal_weight(joined_ways([stretch_ways(parts[0], [START]), *map(stretch_ways, parts[1:])], [START]))


def row_code(role: str, text: str, seen: bool) -> str:
    """The first fault of a row, or its role's initial: see ``row_edits``."""
    ink = text.rstrip(BLANKS)
    if not ink:
        return "b"
    if seen:
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial if ink[-1] in STOPS else initial.upper()


class _Tally:
    """Faults and gaps of one conversation, row by row in order."""

    def __init__(self):
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.last = None
        self.distinct, self.before = 0, None

    def add(self, turn: int | None, role: str, code: str) -> None:
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.distinct += 1
        fault = "blank" if code == "b" else "duplicate" if code == "d" else "truncated" if code.isupper() else None
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.before = role[:1]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def repaired(rows: Iterable[tuple[str, str]], initials: str) -> Iterator[tuple[str, str, str]]:
    """``edit, role, text`` of the turns of a conversation after the edits."""
    left = len(initials) - initials.count("D")
    place = -1 if left % 2 else 0  # an odd number of turns starts with the system's
    rows = iter(rows)
    for initial in initials:
        if initial == "I":
            yield initial, NAMES["ua"[place % 2]], ""
        else:
            role, text = next(rows)
            if initial == "D":
                continue
            yield initial, NAMES["ua"[place % 2]] if initial == "R" else role, text
        place += 1


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"
BATCH = 4096


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


def _batched(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _told(conv_id: int | None, tally: _Tally, weight: Weight, turns: Iterator[tuple[str, str, str]], schema: str) -> Iterator[tuple]:
    """Rows of one conversation: its turns, or its report with a digest of them."""
    if schema == TURNS:
        for place, (edit, role, text) in enumerate(turns):
            yield conv_id, place, edit, role, text
        return
    digest, between = hashlib.sha256(), b""
    for _, role, text in turns:
        digest.update(between + f"{role}:{text}".encode())
        between = b"\n"
    counts = tally.counts
    yield conv_id, tally.gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], *weight, digest.hexdigest()


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Rows of sorted batches by their first column; each group is a stream to be read to its end."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    ahead = [next(rows, None)]

    def group(conv_id: int | None) -> Iterator[tuple]:
        while ahead[0] is not None and ahead[0][0] == conv_id:
            yield ahead[0]
            ahead[0] = next(rows, None)

    while ahead[0] is not None:
        conv_id = ahead[0][0]
        members = group(conv_id)
        yield conv_id, members
        for _ in members:
            pass


def _whole(rows: DataFrame, schema: str) -> DataFrame:
    """Conversations that are gathered whole."""

    def one(conv_id: int | None, members: Iterator[tuple]) -> Iterator[tuple]:
        seen: set[tuple[str, str]] = set()
        tally, codes, kept = _Tally(), [], []
        for _, turn, role, text, present in members:
            if present:
                codes.append(row_code(role, text, (role, text) in seen))
                seen.add((role, text))
                kept.append((role, text))
                tally.add(turn, role, codes[-1])
        weight = cheapest_edits("".join(codes))
        yield from _told(conv_id, tally, weight, repaired(kept, weight[1]), schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((row for conv_id, members in _by_conversation(batches) for row in one(conv_id, members)), schema)

    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return sorted_.mapInArrow(run, schema)


WAYS = "conv_id long, run long, seq long, ways array<struct<way:int,cost:long,initials:string>>"
_WAYS = pa.schema([
    ("conv_id", pa.int64()), ("run", pa.int64()), ("seq", pa.int64()),
    ("ways", pa.list_(pa.struct([("way", pa.int32()), ("cost", pa.int64()), ("initials", pa.string())]))),
])


def _ways_row(ways: Ways) -> list[dict]:
    return [{"way": 4 * a + b, "cost": cost, "initials": initials} for (a, b), (cost, initials) in ways.items()]


def _ways_of(row: list[dict]) -> Ways:
    return {divmod(x["way"], 4): (x["cost"], x["initials"]) for x in row}


def _long_stretches(rows: DataFrame) -> DataFrame:
    """``WAYS`` of the stretches of long conversations, laid out in order over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for conv_id, members in _by_conversation(batches):
            codes = ""
            for _, _, role, text, n, first in members:
                left = n
                while left:
                    # copies behind the first of a conversation are duplicates of it
                    some = min(left, STRETCH)
                    new = row_code(role, text, not (first and left == n))
                    codes += new + row_code(role, text, True) * (some - 1)
                    left -= some
                    while len(codes) >= STRETCH:
                        yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "run": part, "seq": seq, "ways": _ways_row(stretch_ways(codes[:STRETCH]))}], _WAYS)
                        codes, seq = codes[STRETCH:], seq + 1
            if codes:
                yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "run": part, "seq": seq, "ways": _ways_row(stretch_ways(codes))}], _WAYS)
                seq += 1

    return rows.mapInArrow(run, WAYS)


def _run_joined(t: pa.Table) -> pa.Table:
    """The ways of one run of stretches as one."""
    t = t.sort_by("seq")
    first = t.slice(0, 1).to_pylist()[0]
    ways = joined_ways([_ways_of(row) for row in t.column("ways").to_pylist()])
    row = {"conv_id": first["conv_id"], "run": first["run"] // FAN, "seq": first["run"], "ways": _ways_row(ways)}
    return pa.Table.from_pylist([row], _WAYS)


def _in_stretches(rows: DataFrame, schema: str) -> DataFrame:
    """Conversations with too many rows for one task to gather."""
    same = ["conv_id", "turn", "role", "text"]
    # equal rows are one with a count; the first turn of each text tells which rows repeat one
    counted = saved(rows.where("present").groupBy(*same).agg(F.count("*").alias("n")), "turns")
    mark = F.sha2(F.concat_ws("\x00", "role", "text"), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = counted.groupBy("conv_id", mark.alias("_mark")).agg(F.min(turn).alias("_first"))
    first = first.select(F.col("conv_id").alias("_conv"), "_mark", "_first")
    met = counted.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (mark == F.col("_mark")))
    flagged = saved(met.select(*same, "n", turn.eqNullSafe(F.col("_first")).alias("first")), "marked-turns")

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ordered = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    ways = saved(_long_stretches(ordered), "stretch-ways")
    runs = ways.agg(F.max("run")).head()[0] or 0
    while True:
        ways = saved(ways.groupBy("conv_id", "run").applyInArrow(_run_joined, WAYS), "run-ways")
        if not runs:
            break
        runs //= FAN

    def goals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [goal_weight(_ways_of(row)) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([i for _, i in found], pa.string())], names=["conv_id", "cost", "audit"])

    goal = ways.select("conv_id", "ways").mapInArrow(goals, "conv_id long, cost long, audit string")
    none = rows.groupBy("conv_id").agg(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
    # the edits of a conversation come ahead of its rows
    head = goal.unionByName(none).select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.col("cost").alias("n"), F.lit(False).alias("first"))
    body = flagged.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "n", "first")

    def one(conv_id: int | None, members: Iterator[tuple]) -> Iterator[tuple]:
        weight, tally = (0, ""), _Tally()
        ahead = next(members, None)
        while ahead is not None and ahead[1] == 0:
            weight = max(weight, (ahead[5], ahead[4]))
            ahead = next(members, None)

        def each() -> Iterator[tuple[str, str]]:
            row = ahead
            while row is not None:
                _, _, turn_, role, text, n, first_ = row
                for k in range(n):
                    tally.add(turn_, role, row_code(role, text, not first_ or k > 0))
                    yield role, text
                row = next(members, None)

        yield from _told(conv_id, tally, weight, repaired(each(), weight[1]), schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((row for conv_id, members in _by_conversation(batches) for row in one(conv_id, members)), schema)

    stream = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "text")
    return stream.mapInArrow(run, schema)


def _repair(rows: DataFrame, schema: str) -> DataFrame:
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.col("present") if "present" in rows.columns else F.lit(True)).alias("present"),
    )
    sizes = saved(plain.groupBy("conv_id").count().where(F.col("count") > LONG).select(F.col("conv_id").alias("_conv"), F.lit(True).alias("_long")), "long-conversations")
    if sizes.isEmpty():
        return _whole(plain, schema)
    known = plain.join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    short = known.where("_long is null").drop("_conv", "_long")
    return _whole(short, schema).unionByName(_in_stretches(known.where("_long").drop("_conv", "_long"), schema))


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (``conv_id, turn, role, text``): ``REPORT``.

    Rows are taken by turn, nulls first, equal turns by role and text. Each row's first fault counts:
    ``blank`` (nothing but blanks), ``duplicate`` (role and text seen earlier), ``truncated`` (does not
    end in ``.!?``). ``gaps`` are turn numbers that are missing, ``illegal`` neighbours whose roles may
    not follow each other, ``audit`` the initials of the cheapest edits (Keep, Rerole, Delete,
    Insert), ``sha256`` the digest of the repaired turns as ``role:text`` lines. A null id is a
    conversation like any other; a null role or text is one blank. Rows whose column ``present``
    (true, if there is none) is false only name their conversation; one of no other rows has zeros,
    no edits and the digest of nothing. Other columns are not read; an empty table gives no rows.
    """
    return _repair(rows, REPORT)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns after repair: ``TURNS``. ``place`` counts from 0, ``edit`` is K, R or I."""
    return _repair(rows, TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by a checksum of ``conv_id:turn``, for trials of the repair.

    Of twenty rows one is dropped (it stays with ``present`` false), one emptied, one loses its
    stops, one comes twice and one is the user's. Nulls are one blank, in the checksum's text too;
    null turns stay null.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", kind.alias("_kind"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
    )
    copies = F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))
    return rows.withColumn("_copy", F.explode(copies)).select("conv_id", "turn", "role", "text", (F.col("_kind") != 0).alias("present"))
