"""Conversation structure: turns are checked, and repaired by the cheapest edits, found by iterative-deepening A*.

Edits turn the role initials of a conversation into `(s?(ua)+)?`: Keep, Rerole, Delete and Insert. The search is depth-first
in the order of the edits' initials (D, I, K, R) under a bound on the cost that grows to the least one that some cut-off
state asks for; a transposition table holds, for each state (place, end of what is written) that failed, the cost it is now
known to need, which cuts it off until the bound allows that. The first path that is accepted is the answer: its cost
is least, and of equal ones it is the first in ASCII order. The heuristic adds, for what is left, what every row asks for by
itself and, for each pair of neighbours that may not stand so, the least share of an edit that could mend it.

Rows are dealt by ranges of (conversation, turn), so one conversation may lie in many tasks, and are searched in sorted order.
A conversation of up to SEGMENT rows inside one task is searched as a whole. Of others every segment is searched from each
state it can be entered in to each it can be left in (written prefixes before a row's edit cannot continue one another, so
the cheapest and first path through a segment is part of the whole's); a stream over a conversation's segments joins them,
and another one hashes its repaired rows in order. So no task holds a conversation's texts, only its audit, which is the result's.

Nulls count as one space (a null conversation is one of its own, null turns come first). Rows of equal turn are taken by role,
then text, both after damage; repeated rows stay repeated (and are duplicates). An empty role has no legal initial. Extra
columns are ignored. Empty texts are blank. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import join_by_count, materialise, small

#: Rows that are searched together.
SEGMENT = 128
#: Characters of a text that range borders hold.
BORDER = 64
# The edits' costs, the faults, the white space of blank texts, what a text ends with, and which initials may follow.
KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 3, 4, 3, 3
FINE, MUST_GO, TRUNCATED = 0, 1, 2
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
LEGAL = {"su", "ua", "au"}
# States: nothing is written, or the last one written is of the system, the user, the assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The one role that an inserted or changed row can have after each state.
ROLE = ("user", "user", "assistant", "user")
TO = (USER, USER, ASSISTANT, USER)
NEVER = 1 << 60
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def search(rows: list[tuple[str, int]], state: int = NONE, goal: int | None = None) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of rows (role initial, fault), the first in ASCII order; None if there are none.

    Without a goal the rows are a whole conversation's end: nothing or an assistant's turn is last, and rows may be inserted after the last one.
    """
    n = len(rows)
    alone, pairs, after = [0] * (n + 1), [0] * (n + 1), [n] * (n + 1)  # from each place: costs of rows by themselves; shares of pairs, halved; the next row that may stay
    for i in range(n - 1, -1, -1):
        initial, fault = rows[i]
        alone[i] = alone[i + 1] + (0, DELETE, OPEN_END)[fault]
        after[i], pairs[i] = after[i + 1], pairs[i + 1]
        if fault != MUST_GO:
            j, after[i] = after[i + 1], i
            if j < n:
                if initial + rows[j][0] not in LEGAL:
                    pairs[i] += 1 if TRUNCATED in (fault, rows[j][1]) else 3
            elif goal is None and initial != "a":
                pairs[i] += 1 if fault == TRUNCATED else 3
    known: dict[int, int] = {}

    def needs(i: int, q: int) -> int:
        j = after[i]
        if j < n:
            first = 0 if rows[j][0] in FOLLOWS[q] else 1 if rows[j][1] == TRUNCATED else 3
        elif goal is None:
            first = (0, 4 * INSERT, 2 * INSERT, 0)[q]
        else:
            first = 0 if q == goal or i < n else NEVER
        return max(alone[i] + (pairs[i] + first + 1) // 2, known.get(4 * i + q, 0))

    def steps(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order: initial, cost, place and state after it."""
        if i < n:
            initial, fault = rows[i]
            yield "D", DELETE, i + 1, q
        if i < n or goal is None:
            yield "I", INSERT, i, TO[q]
        if i < n and fault != MUST_GO:
            more = OPEN_END if fault == TRUNCATED else 0
            if initial in FOLLOWS[q]:
                yield "K", KEEP + more, i + 1, FOLLOWS[q][initial]
            yield "R", REROLE + more, i + 1, TO[q]

    bound, most = needs(0, state), (DELETE + OPEN_END + INSERT) * (n + 2)
    while bound <= most:
        path: list[list] = [[0, state, bound, steps(0, state), NEVER, 0]]  # place, state, what may be spent, edits left, least need, cost of the edit
        audit: list[str] = []
        while path:
            i, q, rest, left, need, cost = top = path[-1]
            if i == n and (q in (NONE, ASSISTANT) if goal is None else q == goal):
                return bound - rest, "".join(audit)
            for edit, price, j, to in left:
                asked = needs(j, to)
                if asked <= rest - price:
                    path.append([j, to, rest - price, steps(j, to), NEVER, price])
                    audit.append(edit)
                    break
                top[4] = min(top[4], price + asked)
            else:
                known[4 * i + q] = max(top[4], known.get(4 * i + q, 0))
                path.pop()
                if path:
                    audit.pop()
                    path[-1][4] = min(path[-1][4], cost + known[4 * i + q])
        bound = max(bound + 1, known[state])
    return None


def crossings(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a segment that is not the whole conversation, for every pair of states that has edits."""
    if not rows:
        return [(q, q, 0, "") for q in range(4)]
    out = [(q, q, DELETE * len(rows), "D" * len(rows)) for q in (NONE, SYSTEM)]
    pairs = [(q, to) for q in (NONE, SYSTEM, USER, ASSISTANT) for to in (USER, ASSISTANT)]
    if any(initial == "s" and fault != MUST_GO for initial, fault in rows):
        pairs.append((NONE, SYSTEM))
    return out + [(q, to, *found) for q, to in pairs if (found := search(rows, q, to))]


def repaired(rows: list[tuple[str, str]], audit: str, state: int = NONE) -> Iterator[str]:
    """role:text of the rows (role, text) after the edits."""
    at = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "K":
            state = FOLLOWS[state][role[:1]]
        elif edit != "D":
            role, state = ROLE[state], TO[state]
        if edit != "D":
            yield f"{role}:{text}"


def joined(segments: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[str], list[int]]:
    """Cost, and audit and state before of each segment, of the cheapest and first way through the crossings of all segments."""
    best, back = {NONE: (0, 0)}, []  # cost, and place in ASCII order, of what leads to a state
    for crossing in segments:
        found: dict[int, tuple] = {}
        for q, to, cost, audit in crossing:
            if q in best:
                way = (best[q][0] + cost, best[q][1], audit, q)
                found[to] = min(found.get(to, way), way)
        back.append(found)
        order = {w[1:3]: k for k, w in enumerate(sorted(found.values(), key=lambda w: w[1:3]))}
        best = {to: (w[0], order[w[1:3]]) for to, w in found.items()}
    cost, _, last, q = min((c + len(tail) * INSERT, order, tail, q) for q, (c, order) in best.items() for tail in [("", "II", "I", "")[q]])
    audits, states = [], []
    for found in reversed(back):
        _, _, audit, before = found[q]
        audits.append(audit + last)
        states.append(before)
        q, last = before, ""
    return cost, audits[::-1], states[::-1]


class Segment:
    """Rows of one conversation in order, and what is counted of them."""

    def __init__(self):
        self.rows, self.turns, self.counts = [], [], dict.fromkeys(COUNTS[1:], 0)  # rows: role, text, fault; turns: first and last that aren't null, and how many

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        bare = text.strip(SPACE)
        name = "blank" if not bare else "duplicate" if repeated else "truncated" if bare[-1] not in ENDS else None
        if name:
            self.counts[name] += 1
        if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = turn, self.turns[2] + 1
        self.rows.append((role, text, FINE if name is None else TRUNCATED if name == "truncated" else MUST_GO))

    def searched(self) -> list[tuple[str, int]]:
        return [(role[:1], fault) for role, _, fault in self.rows]


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and copies (0 to 2) of every row after damage that its id and turn decide."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"), (F.crc32(F.concat_ws(":", space(conv_id), space(turn))) % 20).alias("v"))
    told = F.when(F.col("v") == 1, F.lit("")).when(F.col("v") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("v") == 0, 0).when(F.col("v") == 3, 2).otherwise(1)
    return d.select("conv_id", "turn", F.when(F.col("v") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), told.alias("text"), copies.alias("copies"))


def _sorted(rows: DataFrame) -> DataFrame:
    """The rows with `again` (its role and text stand under an earlier turn), dealt by ranges and sorted; equal rows lie side by side."""
    at = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    said = F.concat_ws(":", F.col("conv_id").isNull().cast("string"), F.length(name).cast("string"), name, F.length("role").cast("string"), "role", "text")
    keyed = rows.withColumn("key", F.unhex(F.sha2(said, 256)))
    firsts = keyed.where("copies > 0").groupBy("key").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    known = join_by_count(keyed, materialise(firsts), ["key"], "left").withColumn("again", F.coalesce(at > F.col("first"), F.lit(False))).drop("key", "first")
    order = ["conv_id", "turn", "role"]
    return known.repartitionByRange(*order, F.substring("text", 1, BORDER)).sortWithinPartitions(*order, "text")


def repair(conversations: DataFrame, segment: int = SEGMENT, **columns: str) -> DataFrame:
    """Counts of faults, cost and audit of the cheapest edits, and digest of the repaired rows, of every conversation after damage."""
    rows = damaged(conversations, **columns)
    id_type, turn_type = rows.schema["conv_id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    schema = (f"conv_id {id_type}, part int, k long, whole boolean, {RESULT}, low {turn_type}, high {turn_type}, head string, tail string, "
              "crossings array<struct<q:int,to:int,cost:int,audit:string>>, roles array<string>, texts array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like = None
        part, k, at_start, before, name, s, out, size = TaskContext.get().partitionId(), 0, True, None, None, None, [], 0

        def close(whole: bool) -> None:
            nonlocal k, size
            low, high, distinct = s.turns or (None, None, 0)
            row = {"conv_id": name[0], "part": part, "k": k, "whole": whole, "gaps": high - low + 1 - distinct if s.turns else 0, **s.counts, "low": low, "high": high}
            if whole:
                row["cost"], row["audit"] = search(s.searched())
                row["repaired_sha256"] = hashlib.sha256("\n".join(repaired([r[:2] for r in s.rows], row["audit"])).encode()).hexdigest()
            else:
                if s.rows:
                    row["head"], row["tail"] = s.rows[0][0][:1], s.rows[-1][0][:1]
                row["cost"] = distinct  # of a segment: its number of turns
                row["crossings"] = [dict(zip(("q", "to", "cost", "audit"), c)) for c in crossings(s.searched())]
                row["roles"], row["texts"] = [r[0] for r in s.rows], [r[1] for r in s.rows]
                size += sum(len(r[1]) for r in s.rows)
            out.append(row)
            k += 1

        def flushed() -> pa.RecordBatch:
            nonlocal size
            batch = pa.RecordBatch.from_pylist(out, schema=like)
            out.clear()
            size = 0
            return batch

        for b in small(batches):
            if like is None:
                like = _arrow(schema, b.schema)
            for conv, turn, role, text, copies, again in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "again"))):
                if name is None or conv != name[0]:
                    if name is not None:
                        close(not at_start)
                        at_start = False
                    name, s, before = (conv,), Segment(), None
                for _ in range(copies):
                    if len(s.rows) == segment:
                        close(False)
                        s, at_start = Segment(), True  # the conversation's other segments aren't whole either
                    s.add(turn, role, text, again or before == (turn, role, text))
                    before = (turn, role, text)
                if len(out) >= 1000 or size >= 1 << 22:
                    yield flushed()
        if name is not None:
            close(False)
        if out:
            yield flushed()

    parts = materialise(_sorted(rows).mapInArrow(run, schema))
    whole = parts.where("whole").select("conv_id", *(c.split()[0] for c in RESULT.split(", ")))
    return whole.unionByName(_joined(parts.where("NOT whole"), id_type))


def _arrow(schema: str, given: pa.Schema) -> pa.Schema:
    """The Arrow schema of the columns of a DDL text; conversations and turns are of the given types."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
             "array<struct<q:int,to:int,cost:int,audit:string>>": pa.list_(pa.struct([("q", pa.int32()), ("to", pa.int32()), ("cost", pa.int32()), ("audit", pa.string())]))}
    own = {"conv_id": given.field("conv_id").type, "low": given.field("turn").type, "high": given.field("turn").type}
    return pa.schema([(n, own.get(n) or kinds[t]) for n, t in (c.split(" ", 1) for c in schema.split(", "))])


def _joined(parts: DataFrame, id_type: str) -> DataFrame:
    """Results of conversations of several segments (or at the border of a task's range) from their segments."""
    counted = f"conv_id {id_type}, part int, k long, piece string, state int, last boolean, {RESULT}"

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> pa.RecordBatch:
            cost, audits, states = joined([[tuple(c.values()) for c in r["crossings"]] for r in held])
            turned, filled = [r for r in held if r["low"] is not None], [r for r in held if r["head"] is not None]
            counts = {c: sum(r[c] for r in held) for c in COUNTS[1:]}
            counts["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(filled, filled[1:]))
            distinct = sum(r["cost"] for r in turned) - sum(a["high"] == b["low"] for a, b in zip(turned, turned[1:]))
            counts["gaps"] = turned[-1]["high"] - turned[0]["low"] + 1 - distinct if turned else 0
            rows = [{"conv_id": r["conv_id"], "part": r["part"], "k": r["k"], "piece": a, "state": q, "last": False} for r, a, q in zip(held, audits, states)]
            rows[-1] |= {"last": True, **counts, "cost": cost, "audit": "".join(audits)}
            return pa.RecordBatch.from_pylist(rows, schema=like)

        like = None
        for b in small(batches):
            like = like or _arrow(counted, b.schema.append(pa.field("turn", pa.int64())))
            for r in b.to_pylist():
                if held and r["conv_id"] != held[0]["conv_id"]:
                    yield done()
                    held = []
                held.append(r)
        if held:
            yield done()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, digest, first = None, hashlib.sha256(), True
        for b in small(batches, 100):
            names = names or [n for n in b.schema.names if n in RESULT_NAMES]
            out = []
            for r in b.to_pylist():
                for line in repaired(list(zip(r["roles"], r["texts"])), r["piece"], r["state"]):
                    digest.update(line.encode() if first else b"\n" + line.encode())
                    first = False
                if r["last"]:
                    out.append({n: r[n] for n in names} | {"repaired_sha256": digest.hexdigest()})
                    digest, first = hashlib.sha256(), True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([b.schema.field(n) for n in names]))

    narrow = parts.drop("roles", "texts", "whole", "gaps", "audit", "repaired_sha256")
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")
    found = materialise(dealt.mapInArrow(ways, counted))
    texts = parts.select("part", "k", "roles", "texts").join(found, ["part", "k"])
    return texts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k").mapInArrow(hashed, f"conv_id {id_type}, {RESULT}")


RESULT_NAMES = {"conv_id", *(c.split()[0] for c in RESULT.split(", "))}
