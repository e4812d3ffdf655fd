"""Conversation repair: the cheapest edits that make turns alternate, by iterative-deepening A*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE_CLASS, give_back, small_batches

#: Costs of edits. Delete is required for blank and duplicate rows; a truncated row that stays adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of the roles so far: none, system only, user last, assistant last. A whole conversation ends in EMPTY or ANSWERED.
EMPTY, SYSTEM, ASKED, ANSWERED = range(4)
STATES, WHOLE = (EMPTY, SYSTEM, ASKED, ANSWERED), (EMPTY, ANSWERED)
#: The state after a row that is kept, by its role's initial, and after an inserted or re-roled one.
KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
WANTED = {EMPTY: ASKED, SYSTEM: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
ROLE_OF = {ASKED: "user", ANSWERED: "assistant"}
#: The states that a state can be reached from.
FROM = {EMPTY: (EMPTY,), SYSTEM: (EMPTY, SYSTEM), ASKED: STATES, ANSWERED: STATES}
#: Rows that are searched at once; a longer conversation is searched in stretches of so many.
STRETCH = 64


class Turn(NamedTuple):
    """A row as the search sees it: its role's initial and its first fault ("" if it has none)."""

    initial: str
    fault: str


def cheapest_edits(turns: list[Turn], state: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from `state` to one of `goals`, ties by the ASCII order of the audit.

    Iterative-deepening A*: depth-first searches that try Delete, Insert, Keep and Rerole in this order, under a
    bound on the cost so far plus the least that the rows ahead cost. A state that failed with some budget is not
    entered again with as much or less, in later searches too, and the next bound is the least that a search
    went over. So the first path that arrives is the cheapest and the least of its cost. None: there is no way.
    """
    n = len(turns)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (DELETE if turns[i].fault in ("blank", "duplicate") else TRUNCATED if turns[i].fault else 0)

    def least(at: int, now: int) -> int:
        if not any(now in FROM[goal] for goal in goals):
            return dearest + 1
        return ahead[at] + (INSERT if at == n and now not in goals else 0)

    def steps(at: int, now: int) -> list[tuple[str, int, int, int]]:
        """(edit, cost, place, state) in ASCII order of the edits."""
        found = [("D", DELETE, at + 1, now)] if at < n else []
        found.append(("I", INSERT, at, WANTED[now]))
        if at < n and turns[at].fault not in ("blank", "duplicate"):
            extra = TRUNCATED if turns[at].fault else 0
            if (now, turns[at].initial) in KEPT:
                found.append(("K", extra, at + 1, KEPT[now, turns[at].initial]))
            found.append(("R", REROLE + extra, at + 1, WANTED[now]))
        return found

    dearest = DELETE * n + INSERT * len(STATES)  # everything deleted, then inserts alone
    moves = {(at, now): steps(at, now) for at in range(n + 1) for now in STATES}
    failed: dict[tuple[int, int], int] = {}
    bound = least(0, state)
    while bound <= dearest:
        over = dearest + 1
        path: list[str] = []
        trail = [(0, state, bound, iter(moves[0, state]))]
        while trail:
            at, now, budget, options = trail[-1]
            if at == n and now in goals:
                return bound - budget, "".join(path)
            for edit, cost, to, then in options:
                left = budget - cost
                if left < (need := least(to, then)):
                    over = min(over, bound - left + need)
                elif left <= (spent := failed.get((to, then), -1)):
                    over = min(over, bound + spent + 1 - left)
                else:
                    path.append(edit)
                    trail.append((to, then, left, iter(moves[to, then])))
                    break
            else:
                failed[at, now] = max(budget, failed.get((at, now), -1))
                trail.pop()
                if path:
                    path.pop()
        bound = over
    return None


class Way(NamedTuple):
    """The best edits so far that end in one state, and the digest of what they make."""

    cost: int
    audit: str
    digest: object
    empty: bool


def _edited(way: Way, cost: int, audit: str, state: int, turns: list[Turn], rows: list[tuple[str, str]]) -> Way:
    digest, empty, at = way.digest.copy(), way.empty, 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            state, (role, text) = KEPT[state, turns[at].initial], rows[at]
        else:
            state = WANTED[state]
            role, text = ROLE_OF[state], "" if edit == "I" else rows[at][1]
        at += edit != "I"
        digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
        empty = False
    return Way(way.cost + cost, way.audit + audit, digest, empty)


class Repair:
    """A conversation as its rows arrive: a stretch of them is held, and the best edits up to each state."""

    def __init__(self):
        self.ways = {EMPTY: Way(0, "", hashlib.sha256(), True)}
        self.turns, self.rows = [], []
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.last = 0, None
        self.least_turn = self.most_turn = None
        self.distinct_turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if fault:
            self.faults[fault] += 1
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            if self.least_turn is None:
                self.least_turn = turn
            self.distinct_turns += turn != self.most_turn
            self.most_turn = turn
        self.turns.append(Turn(initial, fault))
        self.rows.append((role, text))
        if len(self.turns) > STRETCH:  # so that the end always has a row
            kept = self.turns.pop(), self.rows.pop()
            self._advance(STATES)
            self.turns, self.rows = [kept[0]], [kept[1]]

    def _advance(self, goals: tuple[int, ...]) -> None:
        ways: dict[int, Way] = {}
        for goal in goals:
            found = []
            for state, way in self.ways.items():
                edits = cheapest_edits(self.turns, state, (goal,))
                if edits:
                    found.append((way.cost + edits[0], way.audit + edits[1], state, edits))
            if found:
                _, _, state, edits = min(found, key=lambda f: f[:2])
                ways[goal] = _edited(self.ways[state], *edits, state, self.turns, self.rows)
        self.ways = ways

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
        if len(self.ways) == 1 and EMPTY in self.ways:  # the whole conversation in one search
            cost, audit = cheapest_edits(self.turns, EMPTY, WHOLE)
            best = _edited(self.ways[EMPTY], cost, audit, EMPTY, self.turns, self.rows)
        else:
            self._advance(WHOLE)
            best = min(self.ways.values(), key=lambda way: way[:2])
        gaps = 0 if self.least_turn is None else self.most_turn - self.least_turn + 1 - self.distinct_turns
        return gaps if gaps < 1 << 63 else None, *self.faults.values(), self.illegal, best.cost, best.audit, best.digest.hexdigest()


def _repaired(batches: Iterator) -> Iterator:
    import pyarrow as pa

    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

    def made(done: list, id_type):
        kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*done), kinds)], names=["__id", *fields])

    present, repair, started, id_type = None, None, False, None
    for batch in batches:
        done, id_type = [], batch.column(0).type
        for key, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if not started or key != present:
                if started:
                    done.append((present, *repair.result()))
                present, repair, started = key, Repair(), True
            if fault is not None:
                repair.add(turn, role, text, fault)
        if done:
            yield made(done, id_type)
    if started:
        yield made([(present, *repair.result())], id_type)
    give_back()


def _fault(seen: Column) -> Column:
    """The first fault of a row of (role, text); seen: how many of its conversation's rows up to it have both."""
    blank = ~F.col("text").rlike(f"[^{SPACE_CLASS[1:]}")
    truncated = ~F.col("text").rlike(rf"[.!?]{SPACE_CLASS}*\z")
    return F.when(blank, "blank").when(seen > 1, "duplicate").when(truncated, "truncated").otherwise("")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row a conversation of `turns` (conv_id, turn, role, text and, where a row only names its conversation, absent true).

    Rows are taken by turn, role and text, null turns first. A row's first fault counts: blank (no character but those
    of [\\x20\\x09-\\x0D]), duplicate (role and text seen earlier), truncated (the last other character isn't [.!?]).
    The cheapest edits that give role initials `(s?(ua)+)?` are searched by cheapest_edits(), see there: Keep costs 0,
    Rerole to user or assistant 2, Delete 3 (required for blank and duplicate rows), Insert of an empty user or assistant
    text 2, and a truncated row that stays 1. Returns conv_id, gaps (of the turn numbers; null turns don't count), blank,
    duplicate, truncated, illegal (neighbouring role initials other than su, ua, au), cost, audit (initials of the edits)
    and repaired_sha256 (of the repaired `role:text`, joined by newlines).

    Rows are shuffled once by conversation, sorted there with spilling and read as a stream: of a conversation a task holds
    STRETCH rows and the best edits up to each state, so a very long one takes time, no memory but its audit's. One with
    no more than STRETCH rows is one search; a longer one a search for each stretch and pair of states, whose results
    add up to the same answer. Null roles and texts become one space, a null conv_id is a conversation like any other, gaps
    of 2^63 or more are null. Repeated rows are duplicates. Other columns are ignored. An empty table gives no rows.
    """
    small_batches(turns.sparkSession)
    absent = F.col("absent") if "absent" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), absent.alias("absent"))
    dealt = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "absent", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    faulty = dealt.withColumn("seen", F.row_number().over(same)).withColumn("fault", F.when(~F.col("absent"), _fault(F.col("seen"))))
    streamed = faulty.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen").select("conv_id", "turn", "role", "text", "fault")
    kind = turns.schema["conv_id"].dataType.simpleString()
    found = streamed.mapInArrow(_repaired, f"__id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    return found.withColumnRenamed("__id", "conv_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, absent): rows damaged by crc32(`conv_id:turn`) % 20, nulls being one space.

    0 drops a row (absent), 1 empties its text, 2 takes out its [.!?], 3 repeats it, 4 makes its role user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                                (F.crc32(key.cast("binary")) % 20).alias("kind"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.withColumn("copy", F.explode(times)).select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("absent"))
