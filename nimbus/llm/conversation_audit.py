"""Conversation structure repair by a dynamic program over persistent edit strings.

A conversation is well formed when its role initials read ``(s?(ua)+)?``: an optional
system turn, then user and assistant in turn, or nothing at all. Rows are kept (cost 0),
reroled to user or assistant (2) or deleted (3, the only way for blank and repeated
rows); empty turns are inserted anywhere (2); a truncated row that is not deleted adds 1.
The cheapest edits are written as their initials in order, ties ASCII-least.

Edit strings share prefixes: a string is a node with one letter, its parent, its
ancestors at distances 1, 2, 4, ... and a rolling hash. Two strings of equal cost are
compared at their longest common prefix, found by descending the ancestors; where equal
hashes come from different nodes the letters themselves are checked.

Nothing needs a whole conversation in one task but the final stream of its repaired
turns. Rows are sorted by range of (conversation, turn), so a long conversation spreads
over partitions; there it is cut into chunks of at most ``CHUNK`` rows. A chunk gives the
cheapest edits from every state of the pattern it may start in to every state it may end
in, and the chunks of a conversation are then joined in order. Repeated rows are found by
aggregation, not by a conversation's own memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import written

CHUNK = 8_192
#: Conversations whose chunks are joined in one task.
JOINED = 20_000
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
_BLANKS = " \t\n\x0b\x0c\r"
_BASE, _PRIME = 1_000_003, (1 << 61) - 1
#: States of the pattern: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
_BEFORE_USER = (START, SYSTEM, ASSISTANT)


class Edits:
    """Edit strings that share their prefixes; node 0 is the empty string."""

    def __init__(self) -> None:
        self.letter, self.depth, self.code, self.up = [""], [0], [0], [()]

    def add(self, parent: int, letter: str) -> int:
        up, node = [parent], len(self.letter)
        above = self.up[parent]
        while len(above) >= len(up):
            up.append(above[len(up) - 1])
            above = self.up[up[-1]]
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.code.append((self.code[parent] * _BASE + ord(letter)) % _PRIME)
        self.up.append(tuple(up))
        return node

    def _at(self, node: int, depth: int) -> int:
        """The prefix of this length."""
        left = self.depth[node] - depth
        while left:
            step = left.bit_length() - 1
            node = self.up[node][step]
            left -= 1 << step
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth and hash are one string: letters back to a shared node."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def less(self, x: int, y: int) -> bool:
        """Whether string x sorts before string y."""
        short = min(self.depth[x], self.depth[y])
        a, b = self._at(x, short), self._at(y, short)
        if self.code[a] == self.code[b]:
            if self._same(a, b):
                return self.depth[x] < self.depth[y]
            return self.text(x) < self.text(y)
        # the deepest pair of equal prefixes lies just above
        step = len(self.up[a]) - 1
        while step >= 0:
            if step < len(self.up[a]) and self.code[self.up[a][step]] != self.code[self.up[b][step]]:
                a, b = self.up[a][step], self.up[b][step]
            step -= 1
        if not self._same(self.up[a][0], self.up[b][0]):
            return self.text(x) < self.text(y)
        return self.letter[a] < self.letter[b]


class Frontier:
    """The cheapest edits that lead to each state, from one state before the rows."""

    def __init__(self, start: int) -> None:
        self.edits = Edits()
        self.best: list[tuple[int, int] | None] = [None] * 4
        self.best[start] = (0, 0)
        self._insert()

    def _offer(self, into: list, state: int, cost: int, parent: int, letter: str) -> None:
        now = into[state]
        if now is None or cost < now[0]:
            into[state] = (cost, self.edits.add(parent, letter))
        elif cost == now[0]:
            node = self.edits.add(parent, letter)
            if self.edits.less(node, now[1]):
                into[state] = (cost, node)

    def _insert(self) -> None:
        best = self.best
        for state in _BEFORE_USER:
            if best[state] is not None:
                self._offer(best, USER, best[state][0] + INSERT, best[state][1], "I")
        if best[USER] is not None:
            self._offer(best, ASSISTANT, best[USER][0] + INSERT, best[USER][1], "I")

    def row(self, initial: str, fault: int) -> None:
        """One more row; ``fault`` is 0, or the number of its fault in ``FAULTS``."""
        new: list[tuple[int, int] | None] = [None] * 4
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            self._offer(new, state, cost + DELETE, node, "D")
            if fault in (1, 2):
                continue
            cost += CUT if fault == 3 else 0
            if state == START and initial == "s":
                self._offer(new, SYSTEM, cost + KEEP, node, "K")
            after, letter = (ASSISTANT, "a") if state == USER else (USER, "u")
            if initial == letter:
                self._offer(new, after, cost + KEEP, node, "K")
            else:
                self._offer(new, after, cost + REROLE, node, "R")
        self.best = new
        self._insert()

    def results(self) -> list[tuple[int, int, str]]:
        """(state, cost, edits) of every state that can be reached."""
        return [(state, held[0], self.edits.text(held[1])) for state, held in enumerate(self.best) if held is not None]


FAULTS = ("blank", "duplicate", "truncated")
_LEGAL = ("su", "ua", "au")
_CHUNK = ("pid int, part long, n long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
          "turns long, low long, high long, first long, last long, starts array<int>, ends array<int>, costs array<long>, audits array<string>")


class _Chunk:
    """A run of rows of one conversation."""

    def __init__(self, conv, starts: tuple[int, ...]) -> None:
        self.conv, self.frontiers, self.starts = conv, [Frontier(s) for s in starts], starts
        self.n, self.faults, self.illegal, self.turns = 0, [0, 0, 0, 0], 0, 0
        self.head = self.tail = self.low = self.high = self.first = self.last = None

    def row(self, turn, initial: str, fault: int) -> None:
        if not self.n:
            self.head, self.first = initial, turn
        elif self.tail + initial not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.last or self.low is None
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.tail, self.last = initial, turn
        self.faults[fault] += 1
        self.n += 1
        for frontier in self.frontiers:
            frontier.row(initial, fault)

    def record(self, pid: int, part: int) -> tuple:
        moves = [(s, *m) for s, f in zip(self.starts, self.frontiers) for m in f.results()]
        starts, ends, costs, audits = map(list, zip(*moves))
        return (self.conv, pid, part, self.n, *self.faults[1:], self.illegal, self.head, self.tail,
                self.turns, self.low, self.high, self.first, self.last, starts, ends, costs, audits)


def _rows(conv: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, d1, d2): nulls of role and text as one space, a 128-bit hash of both."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    rows = conv.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.select("*", *[F.xxhash64("role", "text", F.lit(k)).alias(f"d{k}") for k in (1, 2)])


def flagged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, d1, d2, copy, fault) of the frame of ``_rows``, without texts.

    Rows equal in turn, role and text are counted before they are shuffled; all but the first
    are repetitions, and so is the first where an earlier turn has the same role and text.
    """
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    marks = rows.select("conv", "turn", "role", "d1", "d2", (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    each = written(marks.groupBy(*marks.columns).agg(F.count("*").alias("n")), "audit-rows")
    lowest = F.lit(-(2**63))  # null turns come first
    turn = F.coalesce("turn", lowest)
    first = each.groupBy("conv", "d1", "d2").agg(F.min(turn).alias("t0"), F.count("*").alias("places")).where("places > 1")
    first = first.select(*[F.col(c).alias(f"{c}_") for c in ("conv", "d1", "d2")], "t0")
    joined = each.join(first, F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("d1") == F.col("d1_")) & (F.col("d2") == F.col("d2_")), "left")
    earlier = F.coalesce(F.col("t0") < turn, F.lit(False))
    copies = joined.select("conv", "turn", "role", "d1", "d2", "blank", "cut", earlier.alias("earlier"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    fault = F.when(F.col("blank"), 1).when(F.col("earlier") | (F.col("copy") > 0), 2).when(F.col("cut"), 3).otherwise(0)
    return copies.select("conv", "turn", "role", "d1", "d2", "copy", fault.alias("fault"))


def chunks(marked: DataFrame) -> DataFrame:
    """One row per chunk: its counts, its ends, and the cheapest edits between all states."""
    order = ["conv", "turn", "role", "d1", "d2", "copy"]
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = ranged.select("conv", F.spark_partition_id().alias("pid"), "turn", F.left("role", F.lit(1)).alias("initial"), "fault")
    kind = marked.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {_CHUNK}"
    every = (START, SYSTEM, USER, ASSISTANT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, part, pid, out = None, 0, 0, []
        for batch in batches:
            convs = batch.column(0).to_pylist()
            turns, initials, faults = (batch.column(k).to_pylist() for k in (2, 3, 4))
            pid = batch.column(1)[0].as_py() if batch.num_rows else pid
            for conv, turn, initial, fault in zip(convs, turns, initials, faults):
                if chunk is None or conv != chunk.conv or chunk.n >= CHUNK:
                    # a conversation that begins within the partition has no rows before it
                    starts = every if chunk is None or conv == chunk.conv else (START,)
                    if chunk is not None:
                        out.append(chunk.record(pid, part))
                        part += 1
                    chunk = _Chunk(conv, starts)
                chunk.row(turn, initial, fault)
            if len(out) >= 1000:
                yield _batch(out, arrow)
                out = []
        if chunk is not None:
            out.append(chunk.record(pid, part))
        if out:
            yield _batch(out, arrow)

    arrow = _arrow(marked.schema["conv"].dataType)
    return written(sorted_.mapInArrow(run, schema), "audit-chunks")


def _arrow(conv_type) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    longs, strings = pa.int64(), pa.string()
    fields = [("conv", to_arrow_type(conv_type)), ("pid", pa.int32()), ("part", longs), ("n", longs), *[(f, longs) for f in FAULTS], ("illegal", longs),
              ("head", strings), ("tail", strings), *[(c, longs) for c in ("turns", "low", "high", "first", "last")],
              ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("costs", pa.list_(longs)), ("audits", pa.list_(strings))]
    return pa.schema(fields)


def _batch(records: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*records), schema)], schema=schema)


def _join(parts: list[dict]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit) of a conversation's chunks in order."""
    held: dict[int, tuple[int, str]] = {START: (0, "")}
    sums, turns, low, high = [0, 0, 0, 0], 0, None, None
    before = None
    for part in parts:
        for k, name in enumerate((*FAULTS, "illegal")):
            sums[k] += part[name]
        turns += part["turns"]
        if before is not None:
            sums[3] += before["tail"] + part["head"] not in _LEGAL
            turns -= part["first"] is not None and part["first"] == before["last"]
        low = part["low"] if low is None else low
        high = part["high"] if part["high"] is not None else high
        new: dict[int, tuple[int, str]] = {}
        for start, end, cost, audit in zip(part["starts"], part["ends"], part["costs"], part["audits"]):
            if start in held:
                found = (held[start][0] + cost, held[start][1] + audit)
                if end not in new or found < new[end]:
                    new[end] = found
        held, before = new, part
    cost, audit = min(held[s] for s in (START, ASSISTANT) if s in held)
    return (0 if low is None else high - low + 1 - turns, *sums, cost, audit)


_AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def joined(parts: DataFrame) -> DataFrame:
    """One row per conversation of the frame ``chunks``."""
    conv = parts.schema["conv"].dataType
    bins = max(1, parts.count() // JOINED + 1)
    kinds = [pa.int64()] * 6 + [pa.string()]
    names = ["gaps", *FAULTS, "illegal", "cost", "audit"]

    def fold(table: pa.Table) -> pa.Table:
        order = sorted(table.to_pylist(), key=lambda r: (r["pid"], r["part"]))
        found: dict = {}
        for record in order:
            found.setdefault(record["conv"], []).append(record)
        rows = [_join(v) for v in found.values()]
        columns = list(zip(*rows)) if rows else [()] * 7
        return pa.table([pa.array(list(found), table.schema.field("conv").type), *[pa.array(c, t) for c, t in zip(columns, kinds)]], ["conv", *names])

    return parts.withColumn("bin", F.pmod(F.xxhash64("conv"), F.lit(bins))).groupBy("bin").applyInArrow(fold, f"conv {conv.simpleString()}, {_AUDIT}")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, role, text): the turns after repair, each conversation in order within one partition.

    A conversation streams through: its audit comes first, then its rows one by one.
    """
    order = ["conv", "kind", "turn", "role", "d1", "d2"]
    head = audits.select("conv", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("d1", "long"), ("d2", "long"))], F.col("audit").alias("text"))
    body = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "d1", "d2", "text")
    stream = head.unionByName(body).repartition("conv").sortWithinPartitions(*order).select("conv", "kind", "role", "text")
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, state = None, "", 0, 0, START
        names = ["conv", "place", "role", "text"]
        for batch in batches:
            out: list[tuple] = []

            def put(role: str, text: str) -> None:
                nonlocal place, state
                out.append((conv, place, role, text))
                place += 1
                state = SYSTEM if state == START and role[:1] == "s" else ASSISTANT if state == USER else USER

            def inserted() -> None:
                nonlocal at
                while at < len(audit) and audit[at] == "I":
                    put("assistant" if state == USER else "user", "")
                    at += 1

            for new, mark, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if mark == 0:
                    conv, audit, at, place, state = new, text, 0, 0, START
                    inserted()
                    continue
                step = audit[at]
                at += 1
                if step == "K":
                    put(role, text)
                elif step == "R":
                    put("assistant" if state == USER else "user", text)
                inserted()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (batch.schema.field(0).type, pa.int64(), pa.string(), pa.string()))], names)

    return stream.mapInArrow(run, f"conv {kind}, place long, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of ``role:text`` lines, newline-joined, of a frame in the order ``repaired`` gives."""
    kind = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            done = []
            for new, place, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if place == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = new, hashlib.sha256()
                state.update((f"{role}:{text}" if place == 0 else f"\n{role}:{text}").encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (batch.schema.field(0).type, pa.string()))], ["conv", "sha256"])
            last = batch.schema.field(0).type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], last), pa.array([state.hexdigest()])], ["conv", "sha256"])

    return turns.mapInArrow(run, f"conv {kind}, sha256 string")


def damaged(conv: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The four columns with faults put in by key: row dropped, text emptied, sentence ends removed, row repeated, role set to user."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.pmod(F.crc32(F.concat_ws(":", one(conv_col), one(turn_col))), F.lit(20))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("body", ".!?", "")).otherwise(F.col("body"))
    rows = conv.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("at"), one(role_col).alias("who"), one(text_col).alias("body"), draw.alias("draw"))
    kept = rows.where("draw <> 0").withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return kept.select(F.col("conv").alias(conv_col), F.col("at").alias(turn_col), F.when(F.col("draw") == 4, "user").otherwise(F.col("who")).alias(role_col), text.alias(text_col))


def audit(conv: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``every`` may name more conversations (its id column); those without rows get zeros, an empty
    audit and the hash of nothing. Rows are taken by turn, null turns first; rows of one turn by
    role, then by a hash of role and text. Null roles and texts are one space. A null id is a
    conversation of its own. Roles count by their first character; one that is neither system,
    user nor assistant can only be reroled or deleted. ``gaps`` counts turn numbers missing between
    the smallest and the largest. Extra columns are ignored. An empty table gives no rows.
    """
    rows = _rows(conv, conv_col, turn_col, role_col, text_col)
    found = written(joined(chunks(flagged(rows))), "audits")
    hashes = digests(repaired(rows, found))
    ids = (conv if every is None else every.select(conv_col).unionByName(conv.select(conv_col))).select(F.col(conv_col).alias("id")).distinct()
    found, hashes = found.withColumnRenamed("conv", "found"), hashes.withColumnRenamed("conv", "hashed")
    all_ = ids.join(found, F.col("id").eqNullSafe(F.col("found")), "left").join(hashes, F.col("id").eqNullSafe(F.col("hashed")), "left")
    zero: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return all_.select(F.col("id").alias(conv_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))
