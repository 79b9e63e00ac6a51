"""Repair of conversations: the cheapest edits that make their turns alternate.

A conversation is a sequence of role initials, and must read ``(s?(ua)+)?``.  Its rows are
kept (0), get the other role (1) or are deleted (2, a must for blank and repeated rows);
empty user and assistant rows can be inserted (5); a truncated row that stays costs 5.

The edits are found by iterative-deepening A*: depth-first searches that try the edits in
ASCII order under a growing cost bound.  A node is (rows read, last role kept).  The
transposition table holds for each node the cost at which it is known to fail at least; it
starts with a lower bound, every failed search raises it, and a node that it puts beyond the
bound is not searched again.  As costs below the optimum fail, the first path accepted is a
cheapest one, and of those the least in ASCII order.

On Spark, each row is dealt out twice: without its text (what the search needs), then with
it.  Sorted by conversation, part and turn, a task reads a conversation's facts, searches,
and then streams the texts through the edits; it holds some bytes per row, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import Rows, in_turn_order
from lakeshore.sources.tables import read_table

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
#: Rows whose cheapest edits, from any state to any, give the lower bound of a long conversation.
BLOCK = 256

#: States by the last role kept: none, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: The state that a user or assistant row leads to, whichever fits.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: States that a kept row leads to, by its initial; no entry where it does not fit.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
INITIALS = "sua"

BLANK, DUPLICATE, TRUNCATED, SOUND = range(4)
WHITE = " \t\n\x0b\x0c\r"


def _moves(code: int, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(edit, cost, rows read, next state) in ASCII order; see :func:`row_code`."""
    initial, fault = divmod(code, 4)
    fitting = KEPT.get((state, (INITIALS + "-")[initial]))
    moves = [(DELETE, COST[DELETE], 1, state), (INSERT, COST[INSERT], 0, NEXT[state])]
    if fault in (TRUNCATED, SOUND):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        if fitting is not None:
            moves.append((KEEP, COST[KEEP] + more, 1, fitting))
        if fitting != NEXT[state]:
            moves.append((REROLE, COST[REROLE] + more, 1, NEXT[state]))
    return tuple(moves)


MOVES = [[_moves(code, state) for state in range(4)] for code in range(16)]
AT_END = [((INSERT, COST[INSERT], 0, NEXT[state]),) for state in range(4)]


def row_code(role: str, fault: int) -> int:
    """A row as the search sees it: its role's initial (any other is 3) and its fault."""
    return (INITIALS.index(role[0]) if role and role[0] in INITIALS else 3) * 4 + fault


def _least_of_block(codes: Sequence[int]) -> int:
    """The least cost of a block's rows over all states before and after it."""
    costs = [0, 0, 0, 0]
    for code in codes:
        for _ in range(2):  # insertions, which read no row
            for state in range(4):
                costs[NEXT[state]] = min(costs[NEXT[state]], costs[state] + COST[INSERT])
        after = [costs[state] + COST[DELETE] for state in range(4)]
        for state in range(4):
            for _, cost, step, to in MOVES[code][state]:
                if step:
                    after[to] = min(after[to], costs[state] + cost)
        costs = after
    return min(costs)


def lower_bounds(codes: Sequence[int]) -> list[int]:
    """Per row, a cost that the rows from it on need at least: 2 for each blank, repeated or
    truncated row of its own block, and what the later blocks need whatever surrounds them."""
    bounds = [0] * (len(codes) + 1)
    later = 0
    for start in reversed(range(0, len(codes), BLOCK)):
        end = min(start + BLOCK, len(codes))
        forced = 0
        for i in range(end - 1, start - 1, -1):
            forced += 0 if codes[i] % 4 == SOUND else COST[DELETE]
            bounds[i] = later + forced
        if len(codes) > BLOCK:
            later += _least_of_block(codes[start:end])
    return bounds


def cheapest_edits(codes: Sequence[int]) -> tuple[int, str]:
    """The cost and the edits of the first path that iterative deepening accepts."""
    n = len(codes)
    least = [bound for bound in lower_bounds(codes) for _ in range(4)]  # the transposition table
    while True:
        bound = least[START]
        nodes, left, tried = [START], [bound], [0]
        while nodes:
            node, budget, k = nodes[-1], left[-1], tried[-1]
            i, state = divmod(node, 4)
            if i == n and state in ACCEPTING:
                path = zip(nodes[:-1], tried[:-1], strict=True)
                return bound, "".join((MOVES[codes[at // 4]] if at // 4 < n else AT_END)[at % 4][move][0] for at, move in path)
            moves = MOVES[codes[i]][state] if i < n else AT_END[state]
            while k < len(moves):
                _, cost, step, to = moves[k]
                child = (i + step) * 4 + to
                if cost + least[child] <= budget:
                    break
                k += 1
            if k < len(moves):
                tried[-1] = k
                nodes.append(child)
                left.append(budget - cost)
                tried.append(0)
            else:  # failed: the node needs more than the budget
                least[node] = max(least[node], min(cost + least[(i + step) * 4 + to] for _, cost, step, to in moves))
                nodes.pop()
                left.pop()
                tried.pop()


def illegal_pairs(roles: str) -> int:
    """Neighbours in a string of initials other than su, ua and au."""
    return sum(roles[i: i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))


HEAD = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPAIRED = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
                      *[(name, pa.int64()) for name in HEAD], ("audit", pa.string())])
REPAIRED_DDL = "conv_id long, position long, edit string, role string, text string, " + ", ".join(f"{c} long" for c in HEAD) + ", audit string"


class _Facts:
    """What the search needs of one conversation's rows, taken in their order."""

    def __init__(self) -> None:
        self.codes, self.initials = bytearray(), []
        self.seen: set[bytes] = set()
        self.faults = [0, 0, 0, 0]
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, ended: bool) -> None:
        fault = BLANK if blank else DUPLICATE if digest in self.seen else SOUND if ended else TRUNCATED
        self.seen.add(digest)
        self.faults[fault] += 1
        self.codes.append(row_code(role, fault))
        self.initials.append(role[:1] or "-")
        if turn is not None and turn != self.last:  # turns come sorted
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn

    def verdict(self) -> tuple:
        cost, audit = cheapest_edits(self.codes)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        illegal = illegal_pairs("".join(self.initials))
        return gaps, *self.faults[:TRUNCATED + 1], illegal, cost, audit


def repair(turns: DataFrame) -> DataFrame:
    """Repaired conversations of ``turns`` (conv_id, turn, role, text), each in one partition
    and in order: a first row with its verdict (``audit`` and the counts; other columns null),
    then a row per edit with its letter, position, role and text after it; deleted rows have
    their letter and their text.

    Rows go by turn (null first), then role and a digest of the text; a column ``copy``, if
    there is one, comes last.  Null roles and texts are empty.  Null conv_id are one
    conversation.  Where ``dropped`` is a column, its true rows only tell that the
    conversation exists; one without any other has an empty audit.  A role whose initial is
    not s, u or a (or which is empty) never fits.
    """
    spare = {"copy": F.lit(0), "dropped": F.lit(False)}
    extra = [(F.col(c) if c in turns.columns else spare[c]).alias(c) for c in spare]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)
    trimmed = F.rtrim("text", F.lit(WHITE))
    facts = rows.select(
        "*", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        (trimmed == "").alias("blank"), F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended"))
    dealt = facts.withColumn("part", F.explode(F.when(F.col("dropped"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    dealt = dealt.withColumn("text", F.when(F.col("part") == 1, F.col("text")))
    ordered = in_turn_order(dealt, "conv_id", "part", "turn", "role", "digest", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, none = Rows(REPAIRED), (None,) * (len(HEAD) + 1)
        here, facts, audit, at, state = object(), None, "", 0, START

        def insertions() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == INSERT:
                state = NEXT[state]
                out.add(here, at, INSERT, ROLE[state], "", *none)
                at += 1

        def searched() -> None:
            nonlocal facts, audit, at, state
            verdict = facts.verdict()
            out.add(here, None, None, None, None, *verdict)
            facts, audit, at, state = None, verdict[-1], 0, START

        def closed() -> None:
            if facts is not None:
                searched()
            insertions()

        begun = False
        for batch in batches:
            names = ("conv_id", "part", "turn", "role", "text", "digest", "blank", "ended", "dropped")
            for conv, part, turn, role, text, digest, blank, ended, dropped in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if not begun or conv != here:
                    if begun:
                        closed()
                    begun, here, facts = True, conv, _Facts()
                if part == 0:
                    if not dropped:
                        facts.add(turn, role, digest, blank, ended)
                    continue
                if facts is not None:
                    searched()
                insertions()
                edit = audit[at]
                if edit == REROLE:
                    state = NEXT[state]
                    role = ROLE[state]
                elif edit == KEEP:
                    state = KEPT[state, role[0]]
                out.add(here, at, edit, role, text, *none, size=len(text))
                at += 1
                yield from out.batches()
            yield from out.batches()
        if begun:
            closed()
        yield from out.batches(last=True)

    return ordered.mapInArrow(run, REPAIRED_DDL)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """A row per conversation of what :func:`repair` gives, in its order: the verdict and
    ``repaired_sha256`` (SHA-256 of the ``role:text`` that remain, joined by newlines)."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in HEAD], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, state, first = Rows(schema), None, None, True
        for batch in batches:
            for conv, _, edit, role, text, *verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if edit is None:
                    if head is not None:
                        out.add(*head, state.hexdigest())
                    head, state, first = (conv, *verdict), hashlib.sha256(), True
                elif edit != DELETE:
                    state.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            yield from out.batches()
        if head is not None:
            out.add(*head, state.hexdigest())
        yield from out.batches(last=True)

    return repaired.mapInArrow(run, "conv_id long, " + ", ".join(f"{c} long" for c in HEAD) + ", audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that crc32(``conv_id:turn``) % 20 deals out: 0 marks the row as
    ``dropped``, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it (``copy`` 1),
    4 sets the role user.  Null roles and texts, and nulls in the hashed text, are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and digest of the repaired turns of every conversation, damaged before."""
    damaged = damage(read_table(spark, sf_dir, "conversations"))
    return repaired_digests(repair(damaged))
