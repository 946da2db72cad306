"""Conversation structure repair: generalised LR parsing with weighted edits over the role grammar.

A conversation's roles must read ``(s?(ua)+)?`` by their initials: an optional
system turn, then pairs of user and assistant. The parser has the LR(0) states of
that grammar and a graph-structured stack: a node is a state and the node below it,
interned, so that equal stacks are one node and tails are shared; reductions branch
instead of looking ahead. Every row may be kept, get another role or be
deleted, and empty turns may be inserted anywhere, each at its cost. All stacks
that some edits of the rows so far lead to are carried on together; where two
meet in the same stack, the smaller (cost, audit) survives, the audit being the
initials of the edits: Delete, Insert, Keep, Rerole.

A row's own edit and the inserts before it are one token of the audit (``IIK``). No
token begins another, so audits of equally many rows compare token by token, and
a stack needs only its rank among the others, not its history. What a row does to
the carried stacks then depends on little, and is remembered.

One conversation may hold a third of all rows. Rows (hashes in place of texts)
are sorted by range over all tasks, a conversation in as many tasks as it takes. A task
starts its first conversation from every stack that there is (the grammar has
ten), and reports the best edits from each to each; these blocks are then put
together per conversation, one row a task and pair of stacks. Texts meet their
edits at the end, streamed in order: a conversation's digest is one sha256 and so is
computed by one task, which holds a batch of rows and the conversation's edits (a
byte a row) at a time.

Defined cases: a NULL role or text counts as one blank; rows with a NULL turn come
first; rows of the same turn follow by role, then by sha256 of the text; a NULL
conv_id is a conversation; a role whose first letter is none of s, u, a (or that is
empty) cannot be kept as it is; rows alike in role and text are duplicates from the
second on, blank ones are blank first; texts of any length are read whole, compared by
sha256; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, stage, table
from .resampling import crc32_sql

# The role grammar, as productions over role initials, and the costs of the edits.
GRAMMAR = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua"))
NAMES = {"u": "user", "a": "assistant"}   # roles that rerole and insert may give
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
LEGAL = ("su", "ua", "au")
MODULUS = 20                              # of the query's damage
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_STACKS_MOST = 1000                       # a grammar with more stacks than this nests without bound
_MEMO_KEPT = 100_000


class Node(NamedTuple):
    """A stack: its top state and the node below (None under the first state)."""

    state: int
    below: Node | None


class Parser:
    """LR(0) states of a grammar and its stacks, numbered; lower-case letters are the terminals."""

    def __init__(self, grammar: tuple[tuple[str, str], ...]):
        self.rules = (("", grammar[0][0]), *grammar)
        first = self._closure({(0, 0)})
        self.states, self.goto, todo = {first: 0}, {}, [first]
        while todo:
            items = todo.pop()
            for symbol in {self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}:
                after = self._closure({(r, d + 1) for r, d in items if self.rules[r][1][d:d + 1] == symbol})
                if after not in self.states:
                    self.states[after] = len(self.states)
                    todo.append(after)
                self.goto[self.states[items], symbol] = self.states[after]
        self.complete = {n: [r for r, d in items if d == len(self.rules[r][1])] for items, n in self.states.items()}
        self.nodes: dict[Node, Node] = {}
        start, self.moves, self.stacks = self._node(0, None), [], {}
        self.stacks[start] = 0
        for stack in (order := [start]):
            moves = {}
            for t in sorted({s for _, s in self.goto if s.islower()}):
                moves[t] = sorted({self.stacks.setdefault(n, len(self.stacks)) for n in self.shift(stack, t)})
                order += [n for n in self.stacks if self.stacks[n] >= len(order)]
            self.moves.append(moves)
            if len(self.stacks) > _STACKS_MOST:
                raise ValueError("the grammar's stacks grow without bound")
        self.accepts = [any(0 in self.complete[n.state] for n in self._reduced(s)) for s in order]

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo = list(items)
        while todo:
            r, d = todo.pop()
            expected = self.rules[r][1][d:d + 1]
            new = {(i, 0) for i, (left, _) in enumerate(self.rules) if expected and left == expected} - items
            items |= new
            todo += new
        return frozenset(items)

    def _node(self, state: int, below: Node | None) -> Node:
        return self.nodes.setdefault(Node(state, below), Node(state, below))

    def _reduced(self, stack: Node) -> list[Node]:
        """The stack and all that reductions make of it."""
        out = [stack]
        for node in out:
            for r in self.complete[node.state]:
                left, right = self.rules[r]
                base = node
                for _ in right:
                    base = base.below
                if (to := self.goto.get((base.state, left))) is not None and (n := self._node(to, base)) not in out:
                    out.append(n)
        return out

    def shift(self, stack: Node, terminal: str) -> list[Node]:
        return [self._node(to, n) for n in self._reduced(stack) if (to := self.goto.get((n.state, terminal))) is not None]


class Entry(NamedTuple):
    """One stack carried on: the best edits that lead to it cost ``cost`` and are the ``rank``-th least audit."""

    stack: int
    cost: int
    rank: int


class Move(NamedTuple):
    """Where an entry comes from: the entry before, the audit's token, the roles given by its inserts and reroles."""

    place: int
    token: str
    roles: str


class Repairer:
    """Least edits of one sequence of rows, from any stack to any stack."""

    def __init__(self, grammar=GRAMMAR):
        self.parser = Parser(grammar)
        self.inserts = [self._inserts(s) for s in range(len(self.parser.moves))]
        self.memo: dict = {}

    def _inserts(self, stack: int) -> list[tuple[str, int]]:
        """(roles inserted, stack after) for every stack that inserts reach, by the fewest."""
        out, seen = [("", stack)], {stack}
        for roles, at in out:
            for role in sorted(NAMES):
                for to in self.parser.moves[at].get(role, ()):
                    if to not in seen:
                        seen.add(to)
                        out.append((roles + role, to))
        return out

    def _step(self, entries: tuple[Entry, ...], initial: str, fault: str) -> tuple[int, tuple[Entry, ...], tuple[Move, ...]]:
        """Carry all stacks over one row: (cost common to all, entries, where each comes from)."""
        best: dict[int, tuple] = {}

        def offer(stack: int, cost: int, rank: int, token: str, place: int, roles: str) -> None:
            found = (cost, rank, token, place, roles)
            if stack not in best or found < best[stack]:
                best[stack] = found

        extra = TRUNCATED if fault == "truncated" else 0
        for place, e in enumerate(entries):
            for roles, at in self.inserts[e.stack]:
                cost, before = e.cost + INSERT * len(roles), "I" * len(roles)
                offer(at, cost + DELETE, e.rank, before + "D", place, roles)
                if fault in ("blank", "duplicate"):
                    continue
                for to in self.parser.moves[at].get(initial, ()):
                    offer(to, cost + extra, e.rank, before + "K", place, roles)
                for role in NAMES:
                    for to in self.parser.moves[at].get(role, ()):
                        offer(to, cost + REROLE + extra, e.rank, before + "R", place, roles + role)
        least = min(b[0] for b in best.values())
        ranks = {x: i for i, x in enumerate(sorted({(b[1], b[2]) for b in best.values()}))}
        entries = tuple(Entry(s, b[0] - least, ranks[b[1], b[2]]) for s, b in sorted(best.items()))
        moves = tuple(Move(b[3], b[2], b[4]) for _, b in sorted(best.items()))
        return least, entries, moves

    def run(self, rows: Iterable[tuple[str, str]], start: int = 0) -> list[tuple[int, int, str, str]]:
        """(stack, cost, audit, roles given) of every stack that the rows (initial, fault) lead to from ``start``."""
        entries, cost, history = (Entry(start, 0, 0),), 0, []
        for initial, fault in rows:
            key = entries, initial, fault
            if key not in self.memo:
                if len(self.memo) > _MEMO_KEPT:
                    self.memo.clear()
                self.memo[key] = self._step(*key)
            more, entries, moves = self.memo[key]
            cost += more
            history.append(moves)
        out = []
        for place, e in enumerate(entries):
            tokens, given = [], []
            for moves in reversed(history):
                move = moves[place]
                tokens.append(move.token)
                given.append(move.roles)
                place = move.place
            out.append((e.stack, cost + e.cost, "".join(reversed(tokens)), "".join(reversed(given))))
        return out

    def finish(self, ends: Iterable[tuple[int, int, tuple[str, ...], str]]) -> tuple[int, str, str]:
        """(cost, audit, roles given) of the best whole conversation among ends (stack, cost, audit's parts, roles)."""
        return min((cost + INSERT * len(more), "".join(audit) + "I" * len(more), roles + more)
                   for stack, cost, audit, roles in ends for more, at in self.inserts[stack] if self.parser.accepts[at])

    def join(self, blocks: Iterable[Iterable[tuple[int, int, int, str, str]]]) -> tuple[int, str, str]:
        """Put blocks together: each the (start, stack, cost, audit, roles) of one part of the rows, in order."""
        at: dict[int, tuple] = {0: (0, (), "")}
        for block in blocks:
            after: dict[int, tuple] = {}
            for start, stack, cost, audit, roles in block:
                if start in at:
                    found = (at[start][0] + cost, (*at[start][1], audit), at[start][2] + roles)
                    if stack not in after or found < after[stack]:
                        after[stack] = found
            at = after
        return self.finish((stack, *found) for stack, found in at.items())


def _normal(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and key: sha256 of the text, by which texts are compared."""
    blank = F.lit(" ")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                                F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    return rows.withColumn("key", F.unhex(F.sha2("text", 256)))


def find_faults(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, key, n, blank, whole, again), a row for all rows alike in the first four.

    ``n`` counts them, ``whole`` says that the text ends a sentence, ``again`` that role
    and text stood in an earlier turn of the conversation.
    """
    last = F.rtrim("text", F.lit(WHITE))
    rows = (_normal(conversations)
            .withColumns({"blank": last == "", "whole": F.right(last, F.lit(1)).isin(".", "!", "?")})
            .groupBy("conv_id", "turn", "role", "key", "blank", "whole").agg(F.count(F.lit(1)).alias("n")))
    rows = stage(rows, "repair-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (rows.groupBy("conv_id", "role", "key").agg(F.min(when).alias("first"), F.max(when).alias("last"))
              .filter(~F.col("first").eqNullSafe(F.col("last")))
              .select(F.col("conv_id").alias("__c"), F.col("role").alias("__r"), F.col("key").alias("__k"), "first"))
    same = (F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r")) & (F.col("key") == F.col("__k")))
    earlier = F.col("first.known").isNotNull() & ~when.eqNullSafe(F.col("first"))
    return (rows.join(firsts, same, "left").withColumn("again", F.coalesce(earlier, F.lit(False)))
            .drop("__c", "__r", "__k", "first"))


# One best edit sequence of a block: from which stack to which. ``whole``: of a conversation that lies in one task.
BLOCK = pa.schema([("part", pa.int32()), ("whole", pa.bool_()), ("start", pa.int32()), ("stack", pa.int32()),
                   ("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.string()), ("illegal", pa.int64()),
                   ("first", pa.string()), ("last", pa.string())])
BLOCK_DDL = ("part int, whole boolean, start int, stack int, cost bigint, audit string, roles string, illegal bigint, "
             "first string, last string")
PLAN = pa.schema([("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.string()), ("illegal", pa.int64())])
PLAN_DDL = "cost bigint, audit string, roles string, illegal bigint"


def _records(rows: list[tuple], conv_type: pa.DataType, rest: pa.Schema) -> pa.RecordBatch:
    """Rows of conv_id and the columns of ``rest``."""
    schema = pa.schema([("conv_id", conv_type), *rest])
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _legal(a: str, b: str) -> bool:
    return a + b in LEGAL


def edit_blocks(faults: DataFrame) -> DataFrame:
    """Best edits of every conversation's part in every task of the sorted rows, from each stack to each."""
    conv_type = faults.schema["conv_id"].dataType.simpleString()
    columns = ("conv_id", "role", "n", "blank", "whole", "again")

    def described(conv_id, rows: Iterable[tuple]) -> tuple[list[tuple[str, str]], int, str, str]:
        plain, illegal, first, last = [], 0, None, None
        for _, role, n, blank, whole, again in rows:
            initial, copies = role[:1], "blank" if blank else "duplicate"
            plain.append((initial, copies if blank or again else "" if whole else "truncated"))
            plain += [(initial, copies)] * (n - 1)
            illegal += (n - 1) * (not _legal(initial, initial)) + (last is not None and not _legal(last, initial))
            first, last = initial if first is None else first, initial
        return plain, illegal, first, last

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, part, kind, out, held = Repairer(), TaskContext.get().partitionId(), [], [], None

        def rows() -> Iterator[tuple]:
            for b in batches:
                kind[:] = [b.schema.field("conv_id").type]
                yield from zip(*(b.column(c).to_pylist() for c in columns))

        def rows_of(conv_id, runs, illegal, first, last, whole: bool) -> list[tuple]:
            if whole:
                runs = [(0, -1, *repairer.finish((s, c, (a,), r) for _, s, c, a, r in runs))]
            return [(conv_id, part, whole, *run, illegal, first, last) for run in runs]

        for place, (conv_id, run) in enumerate(groupby(rows(), key=lambda r: r[0])):
            if held:  # another conversation follows it, and the first may have begun in the task before
                out += rows_of(*held, whole=place > 1)
            plain, *ends = described(conv_id, run)
            starts = (0,) if place else range(len(repairer.parser.moves))
            held = (conv_id, [(s, *found) for s in starts for found in repairer.run(plain, s)], *ends)
            if len(out) >= 1000:
                yield _records(out, kind[0], BLOCK)
                out = []
        if held:  # it may go on in the next task
            yield _records(out + rows_of(*held, whole=False), kind[0], BLOCK)

    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("key")]
    return (faults.select(*columns, "turn", "key").repartitionByRange(*by).sortWithinPartitions(*by)
            .mapInArrow(edits, f"conv_id {conv_type}, {BLOCK_DDL}"))


def plan_edits(faults: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, roles, illegal): the least edits of every conversation that has rows.

    ``audit`` holds the edits' initials in order, ``roles`` the initial of the role that
    each insert and rerole gives.
    """
    blocks = stage(edit_blocks(faults), "repair-blocks")

    def join(key: tuple[pa.Scalar, ...], blocks: pa.Table) -> pa.Table:
        # One conversation: a row a task that holds some of it and pair of stacks.
        rows = sorted(blocks.select(BLOCK.names).to_pylist(), key=lambda r: r["part"])
        parts = [list(g) for _, g in groupby(rows, key=lambda r: r["part"])]
        found = Repairer().join([[(r["start"], r["stack"], r["cost"], r["audit"], r["roles"]) for r in g] for g in parts])
        illegal = sum(g[0]["illegal"] for g in parts)
        illegal += sum(not _legal(a[0]["last"], b[0]["first"]) for a, b in zip(parts, parts[1:]))
        return pa.Table.from_batches([_records([(key[0].as_py(), *found, illegal)], blocks.schema.field("conv_id").type, PLAN)])

    conv_type = faults.schema["conv_id"].dataType.simpleString()
    whole = blocks.filter("whole").select("conv_id", *PLAN.names)
    split = blocks.filter("NOT whole").groupBy("conv_id").applyInArrow(join, f"conv_id {conv_type}, {PLAN_DDL}")
    return whole.unionByName(split)


def apply_edits(conversations: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the rows after the edits, in order within a task.

    A conversation's rows follow its plan in one sorted stream; ``place`` counts from 1.
    """
    rows = _normal(conversations)
    none = F.lit(None).cast("string")
    plan = plan.select("conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"),
                       F.lit(None).cast("binary").alias("key"), "audit", "roles", F.lit(0).alias("kind"))
    both = rows.select("*", none.alias("audit"), none.alias("roles"), F.lit(1).alias("kind")).unionByName(plan)
    by = [F.asc_nulls_first("conv_id"), F.col("kind"), F.asc_nulls_first("turn"), F.col("role"), F.col("key")]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, audit, roles, at, given, place = None, "", "", 0, 0, 0
        for b in batches:
            out = []

            def inserted() -> None:
                nonlocal at, given, place
                while audit[at:at + 1] == "I":
                    place += 1
                    out.append((conv_id, place, "I", None, NAMES[roles[given]], ""))
                    at, given = at + 1, given + 1

            for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "audit", "roles"))):
                if row[1] == 0:
                    conv_id, audit, roles, at, given, place = row[0], row[5], row[6], 0, 0, 0
                    inserted()
                    continue
                letter, role, at = audit[at], row[3], at + 1
                if letter == "R":
                    role, given = NAMES[roles[given]], given + 1
                if letter != "D":
                    place += 1
                    out.append((conv_id, place, letter, row[2], role, row[4]))
                inserted()
            yield _records(out, b.schema.field("conv_id").type, pa.schema(
                [("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))

    conv_type = conversations.schema["conv_id"].dataType.simpleString()
    return (both.repartition("conv_id").sortWithinPartitions(*by)
            .select("conv_id", "kind", "turn", "role", "text", "audit", "roles")
            .mapInArrow(edit, f"conv_id {conv_type}, place bigint, edit string, turn bigint, role string, text string"))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text) of every row that the least edits leave or insert."""
    return apply_edits(conversations, stage(plan_edits(find_faults(conversations)), "repair-plan"))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations whose rows ``apply_edits`` has just put out, in its order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, kind = None, None, None
        for b in batches:
            out, kind = [], b.schema.field("conv_id").type
            for conv_id, place, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 1:
                    out += [(current, sha.hexdigest())] if sha else []
                    current, sha = conv_id, hashlib.sha256()
                sha.update(f"{chr(10) * (place > 1)}{role}:{text}".encode())
            yield _records(out, kind, pa.schema([("repaired_sha256", pa.string())]))
        if sha:
            yield _records([(current, sha.hexdigest())], kind, pa.schema([("repaired_sha256", pa.string())]))

    conv_type = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.mapInArrow(digest, f"conv_id {conv_type}, repaired_sha256 string")


def repair_report(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for every conv_id in ``ids``: faults, cost, audit and digest of its repair.

    gaps counts the turn numbers missing between the least and the greatest; blank,
    duplicate and truncated count rows by their first fault; illegal counts neighbours
    whose roles may not follow each other.
    """
    faults = stage(find_faults(conversations), "repair-faults")
    plan = stage(plan_edits(faults), "repair-plan")
    more = F.when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    stats = faults.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), more).otherwise(0)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & ~F.col("again") & ~F.col("whole"), 1).otherwise(0)).alias("truncated"))
    each = (ids.select("conv_id").distinct().unionByName(stats, allowMissingColumns=True)
            .unionByName(plan.drop("roles"), allowMissingColumns=True)
            .unionByName(digests(apply_edits(conversations, plan)), allowMissingColumns=True))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = each.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                                      F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                      F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """The query's damage, by crc32 of ``conv_id:turn``: dropped, emptied, unpunctuated, repeated, rerolled rows."""
    blank = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    key = F.concat(text("conv_id"), F.lit(":"), text("turn"))
    hit = F.pmod(F.crc32(key.cast("binary")), F.lit(MODULUS))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                                text("text").alias("text"), hit.alias("hit")).filter("hit != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damage(conversations), conversations)


def _sql() -> str:
    """The repair as a recursive query: four states (start, after s, after u, after a), the best (cost, audit, text) of each."""

    def moved(state: str, cost: str, letter: str, line: str) -> str:
        return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', "
                f"'t': {state}.t || {line}}} END")

    def best(*options: str) -> str:
        return f"least({', '.join(options)})"

    def inserted(q0: str, q1: str, q2: str, q3: str) -> tuple[str, str]:
        user = best(q2, *[moved(q, str(INSERT), "I", "chr(10) || 'user:'") for q in (q0, q1, q3)])
        return user, best(q3, moved("i2", str(INSERT), "I", "chr(10) || 'assistant:'"))

    nothing = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    gone = {q: moved(q, str(DELETE), "D", "''") for q in ("q0", "q1", "i2", "i3")}

    def shifted(initial: str, name: str, sources: tuple[str, ...]) -> list[str]:
        keep = [f"CASE WHEN NOT must AND initial = '{initial}' THEN {moved(q, 'extra', 'K', 'line')} END" for q in sources]
        new = [f"CASE WHEN NOT must THEN {moved(q, f'{REROLE} + extra', 'R', name)} END" for q in sources] if name else []
        return keep + new

    user, assistant = "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text"
    i2, i3 = inserted("q0", "q1", "q2", "q3")
    return f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % {MODULUS} AS h
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hit WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS role_before,
         regexp_replace(text, '[\x09-\x0D ]+$', '') AS bare
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed)),
steps AS (
  SELECT conv_id AS c, i, text, chr(10) || role || ':' || text AS line, left(role, 1) AS initial,
         fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra
  FROM judged),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS q0, {nothing} AS q1, {nothing} AS q2,
         {nothing} AS q3
  FROM damaged
  UNION ALL
  SELECT conv_id, i, {gone["q0"]}, {best(gone["q1"], *shifted("s", "", ("q0",)))},
         {best(gone["i2"], *shifted("u", user, ("q0", "q1", "i3")))},
         {best(gone["i3"], *shifted("a", assistant, ("i2",)))}
  FROM (SELECT *, {i3} AS i3
        FROM (SELECT walk.conv_id, steps.i, q0, q1, q2, q3, text, line, initial, must, extra, {i2} AS i2
              FROM walk JOIN steps ON walk.conv_id IS NOT DISTINCT FROM steps.c AND steps.i = walk.i + 1))),
ended AS (
  SELECT conv_id, {best("q0", i3)} AS q
  FROM (SELECT *, {i2} AS i2 FROM walk
        WHERE i = (SELECT count(*) FROM damaged d WHERE d.conv_id IS NOT DISTINCT FROM walk.conv_id))),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(q.c, 0)::BIGINT AS cost, coalesce(q.a, '') AS audit,
       sha256(coalesce(substr(q.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id"""


OP12_SQL = _sql()
