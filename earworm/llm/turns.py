"""Repair of conversations by alignment with an alternating target (operator 12).

A repaired conversation's roles read ``(s?(ua)+)?``.  The turns that must go
(blank ones, repeats) are deleted on the spot; the others are aligned, in
blocks of 16, with every feasible length of the grammar's string between two
phases of it (nothing yet, behind the system turn, behind a user turn, behind an
answer): a Wagner-Fischer table per target, in a band that Ukkonen's bound draws
from the cheapest alignment so far, and a backtrace that takes the ASCII-least
of the cheapest edits.  Among targets of equal cost the backtraced audits are
compared.  A block's audit ends with an edit of a row (insertions behind a
block's last row belong to the next block), so of two audits of the same block
neither is a prefix of the other, and the least audit of a whole conversation is
that of its blocks put together.

So a conversation of any length is cut over tasks: rows lie in order over range
partitions; the (at most two) conversations that a partition shares with others
are summed up as 4 x 4 costs and ranks of audits, from which entry and exit of
each share follow; the shares are then aligned on their own.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earworm.llm.store import neutral, written
from earworm.session import cut_lineage

BLOCK = 16
ROWS_PER_PART = 200_000
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ANSWER = range(4)
#: What ends a conversation: cost and inserted turns behind its last row.
TAIL = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ANSWER: (0, "")}
#: The phase behind a turn whose role begins so.
PHASE = {"": START, "s": SYSTEM, "u": USER, "a": ANSWER}
FAR = 1 << 30
SPACES = " \t\n\u000b\f\r"
ROLE = {"u": "user", "a": "assistant"}


def target_strings(entry: int, exit_: int, length: int) -> list[str]:
    """The grammar's strings of ``length`` letters between two phases."""
    if not length:
        return [""] if entry == exit_ else []
    first = "a" if entry == USER else "u"
    tails = {k: ("ua" if first == "u" else "au") * (k // 2) + (first if k % 2 else "") for k in (length, length - 1)}
    out = []
    if PHASE[tails[length][-1]] == exit_:
        out.append(tails[length])
    if entry == START:
        with_system = "s" + tails[length - 1]
        if PHASE[with_system[-1]] == exit_:
            out.append(with_system)
    return out


def keep_cost(row: str, letter: str) -> int:
    """Cost of a row under a target letter: kept, or given another role."""
    cost = 0 if row.lower() == letter else REROLE if letter in ROLE else FAR
    return cost + (TRUNCATED if row.isupper() else 0)


def align(rows: str, target: str, limit: int) -> tuple[int, str] | None:
    """(cost, ASCII-least audit) of the cheapest alignment that ends with a
    row's edit; None if none costs ``limit`` at most.

    ``rows`` has a letter a row: its role's (x: another), upper case if it is
    truncated.  Cells that a path within the limit cannot pass, by the rows and
    letters that it would have to delete or insert before and behind them, are
    left out.
    """
    n, m = len(rows), len(target)

    def least(r: int, t: int) -> int:
        return DELETE * (r - t) if r > t else INSERT * (t - r)

    cost = [{} for _ in range(n + 1)]
    cost[n][m] = 0
    for i in range(n - 1, -1, -1):
        here, below = cost[i], cost[i + 1]
        for j in range(m, -1, -1):
            if least(i, j) + least(n - i, m - j) > limit:
                continue
            best = DELETE + below.get(j, FAR)
            if j < m:
                if target[j] in ROLE:
                    best = min(best, INSERT + here.get(j + 1, FAR))
                best = min(best, keep_cost(rows[i], target[j]) + below.get(j + 1, FAR))
            if best < FAR:
                here[j] = best
    total = cost[0].get(0, FAR)
    if total > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        here, below = cost[i][j], cost[i + 1]
        if here == DELETE + below.get(j, FAR):
            audit.append("D")
            i += 1
        elif target[j] in ROLE and here == INSERT + cost[i].get(j + 1, FAR):
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


@lru_cache(maxsize=100_000)
def transfers(rows: str, entry: int) -> dict[int, tuple[int, str]]:
    """``exit -> (cost, audit)`` of one block from a phase."""
    n, out = len(rows), {}
    for exit_ in (START, SYSTEM, USER, ANSWER):
        limit, best = DELETE * n + 3 * INSERT, None
        for length in sorted(range(2 * n + 4), key=lambda k: (abs(k - n), k)):
            if (DELETE * (n - length) if length < n else INSERT * (length - n)) > limit:
                continue
            for target in target_strings(entry, exit_, length):
                found = align(rows, target, limit)
                if found and (best is None or found < best):
                    best = found
                    limit = best[0]
        if best:
            out[exit_] = best
    return out


def best_audit(rows: str, entry: int, ends: dict[int, tuple[int, str]]) -> tuple[int, list[str], int] | None:
    """(cost, audits of the blocks and of the end, exit) of the cheapest, among
    equals the ASCII-least, way through ``rows`` to one of ``ends``."""
    blocks = [rows[i:i + BLOCK] for i in range(0, len(rows), BLOCK)]
    rest = [{p: c for p, (c, _) in ends.items()}]
    for block in reversed(blocks):
        behind = rest[-1]
        rest.append({p: min((c + behind[q] for q, (c, _) in transfers(block, p).items() if q in behind), default=FAR)
                     for p in range(4)})
    rest.reverse()
    if rest[0].get(entry, FAR) >= FAR:
        return None
    out, phase = [], entry
    for block, here, behind in zip(blocks, rest, rest[1:]):
        audit, phase = min((audit, q) for q, (c, audit) in transfers(block, phase).items()
                           if c + behind.get(q, FAR) == here[phase])
        out.append(audit)
    return rest[0][entry], [*out, ends[phase][1]], phase


def share_matrix(rows: str) -> tuple[list[int], list[int]]:
    """Costs between all phases through ``rows`` and, by entry, the ranks of
    the audits: a conversation's share as its other shares need to see it."""
    costs, ranks = [], []
    for entry in range(4):
        ways = {q: best_audit(rows, entry, {q: (0, "")}) for q in range(4)}
        order = sorted((w[1], q) for q, w in ways.items() if w)
        place = {q: k for k, (_, q) in enumerate(order)}
        costs += [ways[q][0] if ways[q] else FAR for q in range(4)]
        ranks += [place.get(q, FAR) for q in range(4)]
    return costs, ranks


def chain_shares(shares: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """(entry, exit) of each share of one conversation, in order."""
    rest = [[TAIL[p][0] for p in range(4)]]
    for costs, _ in reversed(shares):
        rest.append([min(costs[4 * p + q] + rest[-1][q] for q in range(4)) for p in range(4)])
    rest.reverse()
    out, phase = [], START
    for (costs, ranks), here, behind in zip(shares, rest, rest[1:]):
        _, exit_ = min((ranks[4 * phase + q], q) for q in range(4) if costs[4 * phase + q] + behind[q] == here[phase])
        out.append((phase, exit_))
        phase = exit_
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): every row, damaged by the crc32 of
    ``conv_id:turn`` modulo 20 (0: no copy is left, 1: empty text, 2: no end
    marks, 3: two copies, 4: a user's).  Nulls: one space, but for the turn."""
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    named = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    code = F.crc32(named) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(code == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def _keyed(rows: DataFrame) -> DataFrame:
    """With a hash of role and text: what a repeat repeats, and what orders
    rows of equal turns and roles."""
    whole = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(whole, 256)))


#: What tells rows apart, and their order (Spark's: nulls come first).
KEY = ("conv_id", "turn", "role", "digest")
SOUND, CUT, BLANK = range(3)
FAULTS = ("", "truncated", "blank")


def judged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, fault) of the rows that are left,
    equal ones as one with the number of copies.

    Only the first of equal rows, at the least turn, is no duplicate (the
    others of its own turn follow it at once).  Both aggregates run before the
    shuffle too, and rows meet the first turns by a key of their own, so neither
    a long conversation nor a message repeated at every turn is one task's.
    """
    seen = F.expr(f"trim(TRAILING '{SPACES}' FROM text)")
    fault = F.when(seen == "", BLANK).when(~F.right(seen, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(SOUND)
    found = written(rows.where("copies > 0").withColumn("fault", fault).groupBy(*KEY).agg(
        F.sum("copies").alias("copies"), F.max("fault").alias("fault")), "turns-found")
    first = found.where(F.col("fault") != BLANK).groupBy("conv_id", "digest").agg(
        F.min("turn").alias("turn"), F.max(F.col("turn").isNull()).alias("none")).select(
        F.col("conv_id").alias("_c"), F.when(~F.col("none"), F.col("turn")).alias("_t"), F.col("digest").alias("_d"))
    same = (F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
            & (F.col("digest") == F.col("_d")))
    names = F.array(*[F.lit(n) for n in FAULTS])
    return found.join(first, same, "left").select(
        *KEY, "copies", F.when((F.col("fault") == BLANK) | F.col("_d").isNotNull(), F.get(names, F.col("fault")))
        .otherwise("duplicate").alias("fault"))


def _runs(batches, *columns):
    """(conv_id, lists of the columns) of each run of equal conv_ids."""
    conv, held = None, None
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in ("conv_id", *columns)]
        for c, *values in zip(*lists):
            if held is None or c != conv:
                if held is not None:
                    yield conv, held
                conv, held = c, [[] for _ in columns]
            for place, value in zip(held, values):
                place.append(value)
    if held is not None:
        yield conv, held


def _letters(roles: list[str], faults: list[str]) -> str:
    """A letter a row, as ``align`` reads them."""
    letters = (r[:1] if r[:1] in ("s", "u", "a") else "x" for r in roles)
    return "".join(x.upper() if f else x for x, f in zip(letters, faults))


def _shared_shares(live: DataFrame) -> dict[tuple[int, int | None], tuple[int, int, bool]]:
    """(part, conv_id) -> (entry, exit, whether it is the last share) of the
    conversations that lie in several parts.  Two rows of 32 numbers a part
    reach the driver, at most, however many rows there are."""
    def summed_up(batches):
        from pyspark import TaskContext

        part, first, last = TaskContext.get().partitionId(), None, None
        for conv, (roles, faults) in _runs(batches, "role", "fault"):
            last = (conv, roles, faults)
            if first is None:
                first = last
        for conv, roles, faults in [first] * (first is not None) + [last] * (last is not first):
            costs, ranks = share_matrix(_letters(roles, faults))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([conv], pa.int64()),
                 pa.array([costs], pa.list_(pa.int32())), pa.array([ranks], pa.list_(pa.int32()))],
                names=["part", "conv_id", "costs", "ranks"])

    summary = live.mapInArrow(summed_up, "part int, conv_id bigint, costs array<int>, ranks array<int>")
    by_conv: dict = {}
    for row in sorted(summary.collect(), key=lambda r: r.part):
        by_conv.setdefault(row.conv_id, []).append(row)
    plan = {}
    for conv, rows in by_conv.items():
        if len(rows) > 1:
            for row, (entry, exit_) in zip(rows, chain_shares([(r.costs, r.ranks) for r in rows])):
                plan[row.part, conv] = (entry, exit_, row is rows[-1])
    return plan


EDIT = "conv_id bigint, turn bigint, role string, digest binary, copies bigint, fault string, edits string"
_EDIT = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()),
                   ("copies", pa.int64()), ("fault", pa.string()), ("edits", pa.string())])


def edited(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """``judged`` rows with ``edits``: the insertions before the row and its
    own edit.  (What ends a conversation follows from its last role.)"""
    spark = rows.sparkSession
    rows = written(rows, "turns")
    dead = F.col("fault").isin("blank", "duplicate")
    live = rows.where(~dead)
    if parts is None:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_PART))
    # checkpoint() keeps the partitions and their order for both passes
    live = cut_lineage(live.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY))
    plan = spark.sparkContext.broadcast(_shared_shares(live))

    def edit(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names = _EDIT.names[1:-1]
        for conv, columns in _runs(batches, *names):
            entry, exit_, ends = plan.value.get((part, conv), (START, None, True))
            letters = _letters(columns[names.index("role")], columns[names.index("fault")])
            stops = {q: TAIL[q] if ends else (0, "") for q in range(4) if exit_ is None or q == exit_}
            _, audits, _ = best_audit(letters, entry, stops)
            edits, at = [], 0
            audit = "".join(audits[:-1])  # the end comes behind deleted rows too
            for k, letter in enumerate(audit):
                if letter != "I":
                    edits.append(audit[at:k + 1])
                    at = k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip([[conv] * len(edits), *columns, edits], _EDIT)], schema=_EDIT)

    return live.mapInArrow(edit, EDIT).unionByName(rows.where(dead).withColumn("edits", F.lit("D")))


_DEALT = (*KEY, "edits", "fault", "copies", "text")
REPAIRED = ("conv_id bigint, edit string, turn bigint, was string, fault string, role string, text string")
_REPAIRED = pa.schema([("conv_id", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("was", pa.string()),
                       ("fault", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _edits_and_texts(conversations: DataFrame, parts: int | None) -> DataFrame:
    """Rows' edits, each followed by the row's text, conversation by
    conversation.  Texts are shuffled once, by conversation, and meet their
    edits in the sort order; a task holds one batch of rows, whatever a
    conversation's length."""
    rows = _keyed(conversations)
    edits = edited(judged(rows), parts)
    texts = rows.select(*KEY, F.when(F.col("copies") > 0, F.col("text")).alias("text"))
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(texts, allowMissingColumns=True)
    return both.select(*_DEALT).repartition("conv_id").sortWithinPartitions(*KEY, F.asc_nulls_last("edits"))


def repaired(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """Every edit of every conversation, in order within its partition:
    (conv_id, edit, turn, was, fault, role, text).

    ``edit`` K keeps a row, R gives it the role ``role``, D deletes it (role and
    text null), I inserts an empty turn (turn and ``was`` null); ``was`` and
    ``fault`` are the row's role and first fault.  Rows come as ``damaged``
    gives them, with their number of copies; equal turns are ordered by role,
    then by the hash of role and text.  A conversation without rows: one row
    with a null edit.  Null conv_ids are one conversation.  No rows: no rows.
    """
    return _edits_and_texts(conversations, parts).mapInArrow(_repair, REPAIRED)


def _repaired_rows(batches):
    """Repaired rows, one by one, of edits and texts in order."""
    nothing = object()
    conv, group, last, empty = nothing, None, "", False

    def ended():
        if empty:
            return [(conv, None, None, None, None, None, None)]
        roles = ["user", "assistant"][2 - len(TAIL[PHASE[last]][1]):]
        return [(conv, "I", None, None, "", role, "") for role in roles]

    for batch in batches:
        for at, turn, role, digest, edits, fault, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
            if at != conv or conv is nothing:
                if conv is not nothing:
                    yield from ended()
                conv, group, last, empty = at, None, "", True
            if edits is not None:
                group, empty = (turn, role, digest, edits, fault, copies), False
                continue
            if group is None or text is None or group[:3] != (turn, role, digest):
                continue  # a text of a row that is not left, or of a further copy
            _, _, _, edits, fault, copies = group
            group = None
            for edit in edits:
                if edit == "K":
                    last = role[:1]
                    yield conv, "K", turn, role, fault, role, text
                elif edit == "D":
                    yield conv, "D", turn, role, fault, None, None
                else:
                    last = "a" if last == "u" else "u"
                    yield (conv, "I", None, None, "", ROLE[last], "") if edit == "I" else (
                        conv, "R", turn, role, fault, ROLE[last], text)
                if edit != "I":  # the copies go at once
                    again = "blank" if fault == "blank" else "duplicate"
                    for _ in range(copies - 1):
                        yield conv, "D", turn, role, again, None, None
    if conv is not nothing:
        yield from ended()


def _repair(batches):
    rows = _repaired_rows(batches)
    while held := list(islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*held), _REPAIRED)], schema=_REPAIRED)


DIGEST = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")
_COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}


class _Tally:
    """What is counted over one conversation's edits, in order."""

    def __init__(self, conv):
        self.conv, self.faults, self.illegal, self.cost = conv, {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0
        self.turns, self.least, self.turn, self.initial = 0, None, None, None
        self.audit, self.joined, self.sha = [], False, hashlib.sha256()

    def add(self, edit, turn, was, fault, role, text):
        if edit is None:
            return
        self.audit.append(edit)
        self.cost += _COST[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if self.initial is not None and self.initial + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = was[:1]
            if turn is not None and turn != self.turn:
                self.turns += 1
                self.least = turn if self.least is None else self.least
                self.turn = turn
        if edit != "D":
            self.cost += TRUNCATED if fault == "truncated" else 0
            self.sha.update((("\n" if self.joined else "") + f"{role}:{text}").encode())
            self.joined = True

    def row(self) -> tuple:
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit),
                self.sha.hexdigest())


def _tallied(rows):
    """One row a conversation of repaired rows in their order."""
    names = [name for name, _ in (c.split() for c in DIGEST.split(", "))]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def conversations():
        now = None
        for conv, *edit in rows:
            if now is None or now.conv != conv:
                if now is not None:
                    yield now.row()
                now = _Tally(conv)
            now.add(*edit)
        if now is not None:
            yield now.row()

    found = conversations()
    while held := list(islice(found, 1000)):
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), types)], names=names)


def digests(edits: DataFrame) -> DataFrame:
    """One row a conversation of ``repaired``'s rows, read in their order."""
    def tally(batches):
        return _tallied(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))

    return edits.mapInArrow(tally, DIGEST)


def repair_digests(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """``digests(repaired(conversations))`` in one pass of the tasks."""
    return _edits_and_texts(conversations, parts).mapInArrow(
        lambda batches: _tallied(_repaired_rows(batches)), DIGEST)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, then repaired."""
    return repair_digests(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
