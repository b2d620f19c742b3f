"""Cheapest repair of conversations by depth-first branch and bound.

A conversation's rows stand in the order of their turns, nulls first; rows of one turn by the MD5 of role and
text. A row's first fault counts: blank (nothing but ASCII white space), duplicate (role and text of an earlier row),
truncated (the last character that is not white space is none of `.!?`). Edits of a row: K keeps it (0), R gives
it the role user or assistant (1), D deletes it (2; must be for blank and duplicate rows); I inserts an empty text of user
or assistant anywhere (5). A truncated row that stays adds 5. The role initials of what results must be
`(s?(ua)+)?`. Of the cheapest repairs the one whose string of edits, the audit, is the least in ASCII is taken. The audit
fixes the result: its length says whether a kept `s` leads, and with that every role.

Method. A node is (rows passed, what the last role allows next). An explicit stack is searched depth first, the
cheapest edit next. A prefix is dropped if its cost and the suffix's lower bound (the least each row left
must cost, and what an open `s` or `u` still needs) exceed the incumbent (cost, audit), or tie with a greater audit, or
if the node's dominance table holds a prefix that is no worse. Two prefixes at one node of equal cost have equally many
inserts, so that neither begins the other and the lesser audit stays the lesser under every suffix.
The stack empty, the incumbent is proved. Sequences repeat, so solutions of short ones are remembered.

Scale. Rows are first reduced to codes without text; equal rows are counted before they are shuffled. Codes are dealt out
by ranges of (conversation, turn), so a conversation of any length is spread over many tasks. More than
`SEGMENT` rows are searched segment by segment from every state to every state, and the solutions are joined by the least
(cost, audit) over the states between. A piece at a partition's edge is joined with its neighbours in a second step.
Texts are read once more, sorted and streamed beside the audits, one row at a time.

Defined cases: a null turn comes first and counts in no gap; a null role has no initial, a null text is blank; rows
without conv_id are one conversation of their own; repeated rows are duplicates of their first; a conversation without
rows does not appear; an empty table gives an empty result; columns other than the four are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.storage import keep

INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
#: Rows that are searched at once.
SEGMENT = 16
#: Bytes of text in a batch of repaired rows, unless a single text is longer.
STEP = 4_000_000

_SPACE = " \t\n\x0b\x0c\r"
# What may come next: the state after each role in each state. 0 nothing yet, 1 after s, 2 after u, 3 after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_OPEN = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
_ENDS = (START, ASSISTANT)

# A row's code is one letter: initial s, u, a or another, times fine, truncated, duplicate, blank.
_INITIALS = "sua-"
_FINE, _CUT, _AGAIN, _BLANK = range(4)
_CODES = "abcdefghijklmnop"

_PIECE = (
    "conv_id long, piece int, whole boolean, n_rows long, first string, last string, first_turn long, last_turn long, "
    "turns long, blank long, duplicate long, truncated long, illegal long, "
    "solutions array<struct<opens: int, closes: int, cost: long, audit: string>>"
)
_ROWS = "conv_id long, position long, edit string, role string, text string"


# ---- search


def _least(code: str) -> int:
    fault = _CODES.index(code) % 4
    return 0 if fault == _FINE else DELETE


def _edits(code: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, edit, state after it) of a row, the cheapest last, as a stack takes them from the end."""
    initial, fault = _INITIALS[_CODES.index(code) // 4], _CODES.index(code) % 4
    out = [(DELETE, "D", state)]
    if fault in (_FINE, _CUT):
        more = TRUNCATED if fault == _CUT else 0
        for role, after in _NEXT[state].items():
            if role == initial:
                out.append((more, "K", after))
            if role != "s":
                out.append((more + REROLE, "R", after))
    return sorted(out, reverse=True)


_EDITS = {(code, state): _edits(code, state) for code in _CODES for state in _NEXT}
_INSERTS = {state: [after for role, after in _NEXT[state].items() if role != "s"] for state in _NEXT}


def search(codes: str, opens: int = START, ends: tuple[int, ...] = _ENDS) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from the state `opens` over all rows to one of `ends`; None if nothing does."""
    n = len(codes)
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + _least(codes[i])
    # what an open state needs at least if it must not end so; deleting never closes one, keeping may
    debt = _OPEN if ends == _ENDS else dict.fromkeys(_NEXT, 0)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, opens)]
    while stack:
        cost, audit, i, state = stack.pop()
        least = cost + bound[i] + (debt[state] if i == n else 0)
        if best and (least > best[0] or (least == best[0] and audit > best[1][: len(audit)])):
            continue
        seen = table.get((i, state))
        if seen and seen <= (cost, audit):
            continue
        table[i, state] = (cost, audit)
        if i == n and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        for after in _INSERTS[state]:
            stack.append((cost + INSERT, audit + "I", i, after))
        if i < n:
            for more, edit, after in _EDITS[codes[i], state]:
                stack.append((cost + more, audit + edit, i + 1, after))
    return best


_remembered = lru_cache(maxsize=100_000)(search)


@lru_cache(maxsize=20_000)
def _between(codes: str, opens: tuple[int, ...] = tuple(_NEXT)) -> dict[tuple[int, int], tuple[int, str]]:
    """Of one segment, the solutions from every state (of `opens`) to every state."""
    found = {(a, b): search(codes, a, (b,)) for a in opens for b in _NEXT}
    return {ends: solution for ends, solution in found.items() if solution is not None}


def _joined(left: dict, right: dict) -> dict:
    """Solutions over two neighbouring runs of rows: the least over the states between them."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for (a, middle), (cost, audit) in left.items():
        for (begin, b), (more, rest) in right.items():
            if begin == middle and ((a, b) not in out or cost + more <= out[a, b][0]):
                found = (cost + more, audit + rest)
                out[a, b] = min(out.get((a, b), found), found)
    return out


def solutions(codes: str, opens: int | None = None) -> dict[tuple[int, int], tuple[int, str]]:
    """The least (cost, audit) from every state (or from `opens`) to every state over any number of rows."""
    first = tuple(_NEXT) if opens is None else (opens,)
    parts = [_between(codes[i : i + SEGMENT], tuple(_NEXT) if i else first) for i in range(0, len(codes), SEGMENT)] or [_between("", first)]
    while len(parts) > 1:
        parts = [reduce(_joined, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def solve(codes: str) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    if len(codes) <= SEGMENT:
        return _remembered(codes)
    return _closed(solutions(codes, START))


def _closed(found: dict) -> tuple[int, str]:
    return min(found[START, end] for end in _ENDS if (START, end) in found)


# ---- rows to codes


def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text of conversations damaged by a hash of `conv_id:turn`, for trials; nulls count as one blank.

    Of twenty, 0 drops a row, 1 empties its text, 2 takes `.!?` out of it, 3 repeats the row, 4 gives it the role user.
    """
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id,)], F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    ).where("kind <> 0")
    kind = F.col("kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _digest() -> Column:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def _codes(rows: DataFrame) -> DataFrame:
    """conv_id, turn, digest, code of the first of equal rows, code of the others, their count."""
    body = F.rtrim(F.coalesce("text", F.lit("")), F.lit(_SPACE))
    initial = F.substring(F.coalesce("role", F.lit("")), 1, 1)
    at = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(body == "", _BLANK).when(F.substring(body, -1, 1).isin(".", "!", "?"), _FINE).otherwise(_CUT)
    plain = rows.select("conv_id", "turn", _digest().alias("digest"), (at * 4).alias("initial"), fault.alias("fault"))
    counted = keep(
        plain.groupBy("conv_id", "turn", "digest").agg(F.max("initial").alias("initial"), F.max("fault").alias("fault"), F.count("*").alias("n"))
    )
    first = counted.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(F.struct("turn"))["turn"].alias("t"))
    placed = counted.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    own, later = F.col("fault"), F.when(F.col("fault") == _BLANK, _BLANK).otherwise(_AGAIN)
    letter = F.lit(_CODES)
    return keep(
        placed.select(
            "conv_id",
            "turn",
            "digest",
            F.substring(letter, F.col("initial") + 1 + F.when(F.col("turn").eqNullSafe(F.col("t")), own).otherwise(later), 1).alias("code"),
            F.substring(letter, F.col("initial") + 1 + later, 1).alias("others"),
            "n",
        )
    )


class _Piece:
    """A run of rows of one conversation: its codes and what is known of its turns."""

    def __init__(self, conv_id):
        self.conv_id, self.codes = conv_id, []
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, code: str, others: str, n: int) -> None:
        self.codes.append(code + others * (n - 1))
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, piece: int, whole: bool) -> dict:
        codes = "".join(self.codes)
        numbers = [_CODES.index(c) for c in codes]
        faults = [x % 4 for x in numbers]
        initials = "".join(_INITIALS[x // 4] for x in numbers)
        if whole:
            found = {(START, START): solve(codes)}
        else:
            found = solutions(codes)
        return {
            "conv_id": self.conv_id,
            "piece": piece,
            "whole": whole,
            "n_rows": len(codes),
            "first": initials[0],
            "last": initials[-1],
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
            "turns": self.turns,
            "blank": faults.count(_BLANK),
            "duplicate": faults.count(_AGAIN),
            "truncated": faults.count(_CUT),
            "illegal": sum(_illegal(a, b) for a, b in zip(initials, initials[1:])),
            "solutions": [{"opens": a, "closes": b, "cost": cost, "audit": audit} for (a, b), (cost, audit) in found.items()],
        }


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _piece_schema() -> pa.Schema:
    solution = pa.struct([("opens", pa.int32()), ("closes", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    texts, flags = ("first", "last"), ("whole",)
    names = [part.split()[0] for part in _PIECE.split(", solutions")[0].split(", ")]
    kinds = {n: pa.string() if n in texts else pa.bool_() if n in flags else pa.int32() if n == "piece" else pa.int64() for n in names}
    return pa.schema([*kinds.items(), ("solutions", pa.list_(solution))])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: sorted codes to solved conversations. Those at the partition's edges may go on in the next."""
    partition = TaskContext.get().partitionId()
    schema, out, edge, now = _piece_schema(), [], True, None
    for batch in batches:
        for conv_id, turn, code, others, n in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.row(partition, not edge))
                    edge = False
                now = _Piece(conv_id)
            now.add(turn, code, others, n)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row(partition, False)], schema)


def _fold(table: pa.Table) -> pa.Table:
    """For applyInArrow: the pieces of one conversation to the whole of it."""
    rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
    found = [{(s["opens"], s["closes"]): (s["cost"], s["audit"]) for s in r["solutions"]} for r in rows]
    while len(found) > 1:
        found = [reduce(_joined, found[i : i + 2]) for i in range(0, len(found), 2)]
    cost, audit = _closed(found[0])
    out, last_turn = rows[0] | {"whole": True}, rows[0]["last_turn"]
    for before, r in zip(rows, rows[1:]):
        for name in ("n_rows", "turns", "blank", "duplicate", "truncated", "illegal"):
            out[name] += r[name]
        out["illegal"] += _illegal(before["last"], r["first"])
        # a turn's rows may lie on both sides of the cut
        out["turns"] -= last_turn is not None and r["first_turn"] == last_turn
        last_turn = r["last_turn"] if r["last_turn"] is not None else last_turn
        out["first_turn"] = r["first_turn"] if out["first_turn"] is None else out["first_turn"]
    out |= {"last": rows[-1]["last"], "last_turn": last_turn}
    out["solutions"] = [{"opens": START, "closes": START, "cost": cost, "audit": audit}]
    return pa.Table.from_pylist([out], _piece_schema())


def repairs(rows: DataFrame) -> DataFrame:
    """Per conversation of `rows` (conv_id, turn, role, text): conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit.

    `gaps` are the turns missing between the first and the last, `illegal` the neighbours whose initials are not su, ua or au.
    """
    codes = _codes(rows)
    dealt = codes.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    pieces = keep(dealt.select("conv_id", "turn", "code", "others", "n").mapInArrow(_pieces, _PIECE))
    folded = pieces.where("NOT whole").groupBy("conv_id").applyInArrow(_fold, _PIECE)
    solved = pieces.where("whole").unionAll(folded)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    only = F.col("solutions")[0]
    return keep(
        solved.select(
            "conv_id", "n_rows", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", only["cost"].alias("cost"), only["audit"].alias("audit")
        )
    )


# ---- applying the audits


class _Walk:
    """An audit, edit by edit beside the rows of its conversation."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.at, self.position = conv_id, audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def _role(self) -> str:
        return "user" if self.position % 2 != self.odd else "assistant"

    def inserts(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.position += 1
            yield self.conv_id, self.position, "I", self._role(), ""

    def row(self, role, text) -> Iterator[tuple]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.position += 1
            yield self.conv_id, self.position, edit, self._role() if edit == "R" else role, text


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: audits, each followed by its conversation's rows, to the rows repaired."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out, size, walk = [], 0, None

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["conv_id", "position", "edit", "role", "text"])

    for batch in batches:
        for conv_id, audit, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if audit is not None:
                made = list(walk.inserts()) if walk else []
                walk = _Walk(conv_id, audit)
            else:
                made = list(walk.row(role, text))
            out.extend(made)
            size += sum(len(r[4]) + 64 for r in made)
            if size > STEP:
                yield batch_of(out)
                out, size = [], 0
    if walk:
        out.extend(walk.inserts())
    if out:
        yield batch_of(out)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of repaired conversations: conv_id, position from 1, edit, role, text.

    Partitions hold whole conversations, in order. `found` is what `repairs` returned for `rows`.
    """
    none = F.lit(None).cast("string")
    audits = found.select("conv_id", "audit", none.alias("role"), none.alias("text"), F.lit(None).cast("long").alias("turn"), none.alias("digest"))
    texts = rows.select("conv_id", none.alias("audit"), "role", "text", "turn", _digest().alias("digest"))
    side = F.col("audit").isNull()
    beside = audits.unionAll(texts).repartition("conv_id").sortWithinPartitions("conv_id", side, "turn", "digest")
    return beside.select("conv_id", "audit", "role", "text").mapInArrow(_apply, _ROWS)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_id, own, ids, shas = None, None, [], []

    def batch_of():
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shas, pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        for c, position, role, text in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3, 4)]):
            if position == 1:
                if own is not None:
                    ids.append(conv_id)
                    shas.append(own.hexdigest())
                conv_id, own = c, hashlib.sha256()
            else:
                own.update(b"\n")
            own.update(f"{role}:{text}".encode("utf-8", "replace"))
        if ids:
            yield batch_of()
            ids, shas = [], []
    if own is not None:
        ids.append(conv_id)
        shas.append(own.hexdigest())
        yield batch_of()


def digests(repaired_rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the `role:text` of repaired rows, joined by line feeds, straight from `repaired`."""
    return repaired_rows.mapInArrow(_hashed, "conv_id long, repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """Every conversation, damaged and repaired: what was wrong, cost and audit of the repair, and the result's hash."""
    rows = damage(conversations)
    found = repairs(rows)
    hashes = digests(repaired(rows, found)).toDF("of", "repaired_sha256")
    every = conversations.select(F.col("conv_id").cast("long").alias("every")).distinct()
    placed = every.join(found, F.col("every").eqNullSafe(F.col("conv_id")), "left").join(hashes, F.col("every").eqNullSafe(F.col("of")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return placed.select(
        F.col("every").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
