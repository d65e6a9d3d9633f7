"""Damage to the structure of conversations, and its cheapest repair.

A repair is a path through a directed acyclic graph whose nodes are (rows read, state of the grammar
``(s?(ua)+)?``), whose edges are edits: Keep 0, Rerole 3, Delete 4, Insert 3, and 3 more for a truncated row that
stays.  The weight of a path is one whole number: its high digits are the cost, its low digits, in base 8, the letters of the
edits from left to right (D 1, I 2, K 3, R 4) with zeros behind the last one.  The least weight at a node is the cheapest path to it and, of
equally cheap ones, that whose letters are least in ASCII; the path itself can be read off its digits.  The number of zeros tells
where the next letter goes, so the ordinary integer minimum is the whole recursion.  Inserts stand before the row
that follows them, or at the end; so no path to a node is a beginning of another one as cheap, and a minimum stays one
whatever comes behind.

Rows are ordered by ranges of conversation and turn, so a huge conversation spreads over tasks, and are held as blocks of
at most ``ROWS`` rows.  A conversation that lies in one block inside one task is repaired where it lies.  The others
(at the edges of tasks, or longer than a block) go on block by block: texts seen in an earlier block are found by a
grouping of digests, costs to the end by a pass over the blocks from the last to the first that keeps four numbers, and the edits by a
pass from the first to the last that keeps the state and a running hash.  No pass holds more than a block; the
last one reads a conversation in one task, since its digest is defined over the whole text in order.

Defined cases: null roles and texts are one space, a null id or turn is one space in the checksum; rows without
``conv_id`` are one conversation; turns sort nulls first, then by role and text (their first ``TIE`` characters, then a
hash), so copies stand together; repeated rows are rows of their own, and all but the first are duplicates;
roles other than system, user and assistant count by their initial, an empty role has none; a conversation that loses all
rows has zeros, an empty audit and the digest of the empty string; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stored
from tradewind.session import scratch

ROWS, CHARS = 256, 1 << 20   # a block's rows, and its characters unless one row has more
TIE = 64
BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = "-DIKR"
BEGUN, SYSTEM, USER, ASSISTANT = range(4)
# From which states a role may follow, and the state it leads to.
FOLLOWS = {"s": ((BEGUN,), SYSTEM), "u": ((BEGUN, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
# What is still to be inserted at the end, by state.
ENDING = {BEGUN: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
TO_END = [3 * ENDING[s] for s in range(4)]
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FAR = 1 << 60
BLOCKS = ("conv_id long, at long, edge boolean, turns array<long>, roles array<string>, texts array<string>, gone array<boolean>")
REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``; a dropped row stays as a mark, so that its conversation is known."""
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    ids = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    fault = F.pmod(F.crc32(F.concat(whole("conv_id"), F.lit(":"), whole("turn")).cast("binary")), F.lit(20))
    rows = turns.select(*ids, whole("role").alias("role"), whole("text").alias("text"), fault.alias("fault"))
    text = (F.when(F.col("fault") <= 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))
    return made.drop("copy")


def in_blocks(rows: DataFrame) -> DataFrame:
    """The rows in order, in blocks of one conversation; ``edge`` marks those that may not be their conversation's only one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, made, block, first, chars = TaskContext.get().partitionId() << 40, [], [], True, 0
        conv, more = None, False

        def closed(edge: bool) -> None:
            nonlocal at, block, chars
            made.append((conv, at, edge, *map(list, zip(*block))))
            at, block, chars = at + 1, [], 0

        for batch in batches:
            for own, *row in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                if block and own != conv:
                    closed(first or more)
                    first, more = False, False
                elif len(block) >= ROWS or chars >= CHARS:
                    closed(True)
                    more = True
                conv, chars = own, chars + len(row[2])
                block.append(row)
            yield _batch(made, BLOCKS)
            made = []
        if block:
            closed(True)
        yield _batch(made, BLOCKS)

    tie: list[Column] = [F.substring("role", 1, TIE), F.substring("text", 1, TIE), F.xxhash64("role", "text")]
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), *tie]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, BLOCKS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    names, columns = [], list(zip(*rows)) or None
    arrays = []
    for at, field in enumerate(schema.split(", ")):
        name, kind = field.split(" ")
        inner = kinds[kind.removeprefix("array<").removesuffix(">")]
        names.append(name)
        arrays.append(pa.array(columns[at] if columns else [], pa.list_(inner) if kind.startswith("array") else inner))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def faults(roles: list[str], texts: list[str], known: set[int]) -> list[str]:
    """The first fault of every row of a block: ``blank``, ``duplicate``, ``truncated`` or none; ``known`` are places seen in earlier blocks."""
    seen, out = set(), []
    for at, (role, text) in enumerate(zip(roles, texts)):
        core = text.rstrip(BLANKS)
        own = (role, text)
        out.append("blank" if not core else "duplicate" if own in seen or at in known else "truncated" if core[-1] not in ".!?" else "")
        seen.add(own)
    return out


def least(paths: list[int | None]) -> int | None:
    return min((p for p in paths if p is not None), default=None)


class Weights:
    """Path weights of up to ``rows`` rows: cost above ``width`` letters of three bits."""

    def __init__(self, rows: int):
        self.width = 3 * rows + 2

    def step(self, path: int, cost: int, letter: int) -> int:
        low = path & ((1 << 3 * self.width) - 1)
        # The lowest set bit lies in the last letter; what is right of that letter is free.
        free = ((low & -low).bit_length() - 1) // 3 if low else self.width
        return path + (cost << 3 * self.width) + (letter << 3 * (free - 1))

    def cost(self, path: int) -> int:
        return path >> 3 * self.width

    def letters(self, path: int) -> list[int]:
        digits = [path >> 3 * at & 7 for at in range(self.width - 1, -1, -1)]
        return [d for d in digits if d]

    def inserted(self, paths: list[int | None]) -> list[int | None]:
        """With one more row inserted."""
        more = [[] for _ in range(4)]
        for sources, target in (FOLLOWS["u"], FOLLOWS["a"]):
            more[target] += [self.step(paths[s], 3, INSERT) for s in sources if paths[s] is not None]
        return [least(p) for p in more]

    def read(self, paths: list[int | None], role: str, fault: str) -> list[int | None]:
        """The least weights after one more row, by state; two inserts before it reach every state there is."""
        once = self.inserted(paths)
        twice = self.inserted(once)
        ready = [least([*p]) for p in zip(paths, once, twice)]
        after = [[self.step(p, 4, DELETE)] if p is not None else [] for p in ready]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            for initial, (sources, target) in FOLLOWS.items():
                ways = [(more, KEEP)] * (role[:1] == initial) + [(more + 3, REROLE)] * (initial != "s")
                after[target] += [self.step(ready[s], c, letter) for s in sources if ready[s] is not None for c, letter in ways]
        return [least(p) for p in after]


def paths_through(roles: list[str], found: list[str], state: int) -> tuple[Weights, list[int | None]]:
    """The least path through a block from one state to each state."""
    weights = Weights(len(roles))
    paths: list[int | None] = [0 if s == state else None for s in range(4)]
    for role, fault in zip(roles, found):
        paths = weights.read(paths, role, fault)
    return weights, paths


def costs_through(roles: list[str], found: list[str]) -> list[int]:
    """Costs from each state to each state, row by row."""
    costs = []
    for state in range(4):
        weights, paths = paths_through(roles, found, state)
        costs += [FAR if p is None else weights.cost(p) for p in paths]
    return costs


class Report:
    """One conversation, read block by block."""

    def __init__(self, conv: int | None):
        self.conv, self.state, self.cost, self.audit, self.digest, self.written = conv, BEGUN, 0, [], hashlib.sha256(), False
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before, self.turns, self.low, self.high = 0, None, 0, None, None

    def write(self, role: str, text: str) -> None:
        self.digest.update(("\n" * self.written + f"{role}:{text}").encode())
        self.written = True

    def insert(self) -> None:
        self.state = USER if self.state != USER else ASSISTANT
        self.write("user" if self.state == USER else "assistant", "")

    def block(self, turns: list, roles: list[str], texts: list[str], known: set[int], togo: list[int], last: bool) -> None:
        found = faults(roles, texts, known)
        for turn, role, fault in zip(turns, roles, found):
            if fault:
                self.counts[fault] += 1
            if self.before is not None and (self.before, role[:1]) not in LEGAL:
                self.illegal += 1
            self.before = role[:1]
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        weights, paths = paths_through(roles, found, self.state)
        choices = [(weights.cost(p) + togo[s], self.ended(weights, p, s, last)) for s, p in enumerate(paths) if p is not None and togo[s] < FAR]
        _, letters = min(choices)
        row = 0
        for letter in letters:
            if letter == INSERT:
                self.insert()
                self.cost += 3
                continue
            role, text, fault = roles[row], texts[row], found[row]
            row += 1
            self.cost += {DELETE: 4, KEEP: 0, REROLE: 3}[letter] + (3 if fault == "truncated" and letter != DELETE else 0)
            if letter == KEEP:
                self.state = FOLLOWS[role[:1]][1]
                self.write(role, text)
            elif letter == REROLE:
                self.state = USER if self.state != USER else ASSISTANT
                self.write("user" if self.state == USER else "assistant", text)
        self.audit.append("".join(LETTERS[x] for x in letters))

    @staticmethod
    def ended(weights: Weights, path: int, state: int, last: bool) -> list[int]:
        return weights.letters(path) + [INSERT] * (ENDING[state] if last else 0)

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def present(gone: list[bool], *columns: list) -> list[list]:
    """What is left of the columns without the rows that were dropped."""
    return [[x for x, lost in zip(column, gone) if not lost] for column in columns]


def repaired_alone(blocks: DataFrame) -> DataFrame:
    """Reports of conversations that are one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for conv, turns, roles, texts, gone in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                report = Report(conv)
                report.block(*present(gone, turns, roles, texts), set(), TO_END, True)
                done.append(report.row())
            yield _batch(done, REPORT)

    return blocks.select("conv_id", "turns", "roles", "texts", "gone").mapInArrow(run, REPORT)


def seen_before(blocks: DataFrame) -> DataFrame:
    """``seen_conv, seen_at, places``: rows that are the first of their kind in their block but not in their conversation."""
    schema = "conv_id long, at long, place int, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, at, roles, texts, gone in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                own = set()
                for place, (role, text) in enumerate(zip(*present(gone, roles, texts))):
                    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
                    if digest not in own:
                        own.add(digest)
                        out.append((conv, at, place, digest))
            yield _batch(out, schema)

    firsts = stored(blocks.select("conv_id", "at", "roles", "texts", "gone").mapInArrow(run, schema), "repair-firsts")
    origin = firsts.groupBy(F.col("conv_id").alias("of_conv"), F.col("digest").alias("of_digest")).agg(
        F.min("at").alias("origin"), F.count("*").alias("blocks")).where("blocks > 1")
    later = firsts.join(origin, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("digest") == F.col("of_digest"))).where("at > origin")
    return later.groupBy(F.col("conv_id").alias("seen_conv"), F.col("at").alias("seen_at")).agg(F.collect_list("place").alias("places"))


def costs_to_end(blocks: DataFrame) -> DataFrame:
    """``end_at, togo, is_last``: the least cost from each state behind a block to the end of its conversation."""
    schema, out_schema = "conv_id long, at long, costs array<long>", "end_at long, togo array<long>, is_last boolean"

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([(conv, at, costs_through(*_codes(roles, texts, gone, places)))
                          for conv, at, roles, texts, gone, places in zip(*[batch.column(c).to_pylist() for c in range(6)])], schema)

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, togo, begun = None, TO_END, False
        for batch in batches:
            out = []
            for own, at, costs in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                last = not begun or own != conv
                conv, begun, togo = own, True, TO_END if last else togo
                out.append((at, togo, last))
                togo = [min(min(costs[4 * s + t] + togo[t] for t in range(4)), FAR) for s in range(4)]
            yield _batch(out, out_schema)

    costs = blocks.select("conv_id", "at", "roles", "texts", "gone", "places").mapInArrow(through, schema)
    return costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at")).mapInArrow(backward, out_schema)


def _codes(roles: list, texts: list, gone: list, places: list | None) -> tuple[list, list]:
    roles, texts = present(gone, roles, texts)
    return roles, faults(roles, texts, set(places or ()))


def repaired_across(blocks: DataFrame) -> DataFrame:
    """Reports of conversations of several blocks, in the order of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report = None
        for batch in batches:
            done = []
            for conv, _, turns, roles, texts, gone, places, togo, last in zip(*[batch.column(c).to_pylist() for c in range(9)]):
                report = report or Report(conv)
                report.block(*present(gone, turns, roles, texts), set(places or ()), togo, last)
                if last:
                    done.append(report.row())
                    report = None
            yield _batch(done, REPORT)

    seen = seen_before(blocks)
    marked = stored(blocks.join(seen, F.col("conv_id").eqNullSafe(F.col("seen_conv")) & (F.col("at") == F.col("seen_at")), "left").select(
        "conv_id", "at", "turns", "roles", "texts", "gone", "places"), "repair-marked")
    ready = marked.join(costs_to_end(marked), F.col("at") == F.col("end_at")).drop("end_at")
    ordered = ready.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return ordered.select("conv_id", "at", "turns", "roles", "texts", "gone", "places", "togo", "is_last").mapInArrow(run, REPORT)


def repair(rows: DataFrame) -> DataFrame:
    """The report of every conversation of ``conv_id, turn, role, text, gone``."""
    path = scratch(rows.sparkSession, "repair-blocks")
    in_blocks(rows).write.partitionBy("edge").parquet(path)
    blocks = rows.sparkSession.read.schema(BLOCKS).parquet(path)
    return repaired_alone(blocks.where("not edge")).unionByName(repaired_across(blocks.where("edge")))


def repair_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of the damaged conversations."""
    return repair(damage(turns))
