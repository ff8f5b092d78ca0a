"""Conversation repair: the cheapest edits that turn a conversation into system? (user assistant)+.

Faults are found by DataFrame operations on narrow rows (no texts).  Each conversation's rows then stream
in order through a task, which keeps one small code per row and searches for the cheapest edits by
iterative-deepening A*: a depth-first search takes edits in ASCII order (Delete, Insert, Keep,
Rerole) as long as their cost and a lower bound of what must follow stay within a cost bound; when
it fails, the bound rises to the least cost that some state is proven to need.  States that failed
are kept with that proven need, so none is searched twice with as little left.  The first accepting path
under the least bound is the cheapest one and, of equals, the first in ASCII order.

The edits are applied in a second stream, so a conversation's texts are never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.common import stored

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK = "^[\\x20\\x09-\\x0D]*\\z"
CUT_OFF = "[^.!?\\x20\\x09-\\x0D][\\x20\\x09-\\x0D]*\\z"
# States: 0 nothing yet, 1 after the system's turn, 2 after a user's, 3 after an assistant's.
# _KEEP[state][initial] is the state after a kept row; a row may be re-roled or inserted only as the turn that _NEXT expects.
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}


def lower_bounds(rows: list[tuple[str, bool, bool]]) -> list[int]:
    """What rows[i:] cost at least in each state (at 4 * i + state), by a relaxed automaton that forgets
    whether a turn was taken before: a system row may begin any exchange, not the first one only."""
    need = [0] * (4 * len(rows) + 4)
    need[-3:-1] = [2 * INSERT, INSERT]
    fresh, after_s, after_u = 0, 2 * INSERT, INSERT
    for i in range(len(rows) - 1, -1, -1):
        initial, must_go, cut = rows[i]
        here = [DELETE + fresh, DELETE + after_s, DELETE + after_u]
        if not must_go:
            extra = TRUNCATED if cut else 0
            here[0] = min(here[0], extra + REROLE + after_u)
            here[1] = min(here[1], extra + REROLE + after_u)
            here[2] = min(here[2], extra + REROLE + fresh)
            if initial == "s":
                here[0] = min(here[0], extra + after_s)
            elif initial == "u":
                here[0], here[1] = min(here[0], extra + after_u), min(here[1], extra + after_u)
            elif initial == "a":
                here[2] = min(here[2], extra + fresh)
        fresh, after_u = min(here[0], INSERT + here[2]), min(here[2], INSERT + here[0])
        after_s = min(here[1], INSERT + after_u)
        need[4 * i:4 * i + 4] = [fresh, after_s, after_u, fresh]
    return need


def cheapest_edits(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, edits' initials) for rows of (role initial, must be deleted, cut off)."""
    need = lower_bounds(rows)
    while True:
        bound = need[0]
        path = _search(rows, need, bound)
        if path is not None:
            return bound, path


def _edits(rows: list[tuple[str, bool, bool]], place: int, state: int) -> list[tuple[str, int, int, int]]:
    """The edits possible in a state as (initial, cost, next place, next state), in ASCII order."""
    out = []
    if place < len(rows):
        initial, must_go, cut = rows[place]
        extra = TRUNCATED if cut else 0
        out.append(("D", DELETE, place + 1, state))
        out.append(("I", INSERT, place, _NEXT[state]))
        if not must_go:
            if initial in _KEEP[state]:
                out.append(("K", extra, place + 1, _KEEP[state][initial]))
            out.append(("R", REROLE + extra, place + 1, _NEXT[state]))
    else:
        out.append(("I", INSERT, place, _NEXT[state]))
    return out


def _search(rows: list[tuple[str, bool, bool]], need: list[int], bound: int) -> str | None:
    """Depth-first search within the bound.  ``need`` is the transposition table: a state that fails
    is left with the least cost that any way on from it was shown to have, which is more than was left."""
    stack = [(0, 0, bound, iter(_edits(rows, 0, 0)))]
    path: list[str] = []
    while stack:
        place, state, left, edits = stack[-1]
        if place == len(rows) and state in (0, 3):
            return "".join(path)
        for name, cost, to, then in edits:
            if cost + need[4 * to + then] <= left:
                path.append(name)
                stack.append((to, then, left - cost, iter(_edits(rows, to, then))))
                break
        else:
            at = 4 * place + state
            need[at] = max(need[at], min(c + need[4 * to + then] for _, c, to, then in _edits(rows, place, state)))
            stack.pop()
            if path:
                path.pop()
    return None


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, copy, gone), each damaged as the CRC-32 of ``conv_id:turn`` says; a dropped
    row stays as one that is gone.  NULLs read as one space (a NULL turn stays NULL for the order)."""
    s = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.encode(F.concat(s["conv_id"], F.lit(":"), s["turn"]), "UTF-8")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(s["text"], ".!?", "")).otherwise(s["text"])
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(s["role"]).alias("role"), text.alias("text"),
                                copies.alias("copy"), (fault == 0).alias("gone"))


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Whole conversations in a task, their rows in order: by turn (NULLs first), then role, then the text's SHA-256."""
    return rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", *first, "turn", "role", "digest", "copy")


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.sha2("text", 256))


_AUDIT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    ("audit", pa.string())])
_AUDIT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What a task keeps of a conversation: counts, the last turn and role, and a code per row."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.first, self.last, self.turns = conv_id, [], None, None, 0
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None

    def add(self, turn, initial: str, fault: str | None) -> None:
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if fault:
            self.count[fault] += 1
        self.codes.append(_code(initial, fault in ("blank", "duplicate"), fault == "truncated"))

    def row(self) -> tuple:
        cost, audit = cheapest_edits(self.codes)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.count.values(), self.illegal, cost, audit)


_CODES: dict[tuple, tuple] = {}


def _code(*code) -> tuple:
    """One shared tuple per kind of row, so a row costs a pointer."""
    return _CODES.setdefault(code, code)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done, kind = None, [], pa.null()
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, turn, initial, fault, gone in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "gone")]):
            if now is None or now.conv_id != conv_id:
                if now:
                    done.append(now.row())
                now = _Conversation(conv_id)
            if not gone:
                now.add(turn, initial, fault)
        if len(done) > 1000:
            yield _batch(done, kind)
            done = []
    if now:
        yield _batch([*done, now.row()], kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    schema = _AUDIT.set(0, pa.field("conv_id", kind))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _key_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of ``damaged`` rows.

    A row's first fault counts: blank, then duplicate (its role and text came earlier), then truncated.
    A conversation all of whose rows are gone has zeros and an empty audit; NULL conv_ids form one
    conversation; equal rows of one turn are duplicates of each other; an empty table gives no rows.
    """
    narrow = _with_digest(rows).select(
        "conv_id", "turn", "role", "digest", "copy", "gone", F.col("text").rlike(BLANK).alias("blank"), F.col("text").rlike(CUT_OFF).alias("cut"))
    # Blank rows are told apart from one another, as they are no duplicates: their own turn is in the key.
    same = Window.partitionBy("conv_id", "role", "digest", "gone", F.when(F.col("blank"), F.col("turn"))).orderBy("turn", "copy")
    fault = F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate").when(F.col("cut"), "truncated")
    found = narrow.withColumn("nth", F.row_number().over(same)).withColumn("fault", fault)
    slim = _ordered(found).select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "gone")
    return slim.mapInArrow(_audit, f"conv_id {_key_type(rows)}, {_AUDIT_DDL}")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, at, state, place, now, out, kind = "", 0, 0, 0, None, [], pa.null()

    def emit(role: str, text: str) -> None:
        nonlocal place
        out.append((now[0], place, role, text))
        place += 1

    def insert() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = _NEXT[state], at + 1
            emit(ROLES[state], "")

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, edits, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]):
            if edits is not None:  # the audit comes before the conversation's rows
                if now:
                    insert()
                audit, at, state, place, now = edits, 0, 0, 0, (conv_id,)
                continue
            insert()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _KEEP[state][role[:1]]
                emit(role, text)
            elif edit == "R":
                state = _NEXT[state]
                emit(ROLES[state], text)
        yield _rows(out, kind)
        out = []
    if now:
        insert()
        yield _rows(out, kind)


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    schema = pa.schema([("conv_id", kind), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the rows after the edits of ``found``, whole conversations in order within a partition."""
    texts = _with_digest(rows.where(~F.col("gone"))).withColumn("audit", F.lit(None).cast("string"))
    heads = found.select("conv_id", "audit")
    both = texts.unionByName(heads, allowMissingColumns=True).withColumn("head", F.col("audit").isNull())
    slim = _ordered(both, "head").select("conv_id", "audit", "role", "text")
    return slim.mapInArrow(_apply, f"conv_id {_key_type(rows)}, place long, role string, text string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, sha, done, kind = None, None, [], pa.null()
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, place, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if place == 0:
                if now:
                    done.append((now[0], sha.hexdigest()))
                now, sha = (conv_id,), hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
    if now:
        done.append((now[0], sha.hexdigest()))
    schema = pa.schema([("conv_id", kind), ("sha256", pa.string())])
    for lo in range(0, len(done), 10_000):
        part = done[lo:lo + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], f.type) for i, f in enumerate(schema)], schema=schema)


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the newline-joined ``role:text`` of ``repaired``'s rows, in the order that it left them."""
    return fixed.mapInArrow(_digest, f"conv_id {_key_type(fixed)}, sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """Every conversation with its faults, audit and the digest of its repaired rows.

    NULL role and text read as one space, NULL turns come first and are no gap; NULL conv_ids are one conversation; repeated
    rows are duplicates; other columns are ignored; an empty table gives no rows.
    """
    rows = damaged(conversations)
    found = stored(audits(rows), "conversation-audits")
    sha = digests(repaired(rows, found)).withColumnRenamed("conv_id", "id")
    none = F.lit(hashlib.sha256().hexdigest())
    return (found.join(sha, found["conv_id"].eqNullSafe(sha["id"]), "left")
            .select(*found.columns, F.coalesce("sha256", none).alias("repaired_sha256")))
