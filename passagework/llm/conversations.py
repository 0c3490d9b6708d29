"""Repair of conversation structure: the cheapest edits that give alternating turns, by IDA*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .batches import portions

# Rows that one search takes at once. Longer conversations are searched part by part.
PART = 64
_BLANKS = "\t\n\x0b\x0c\r "
_DELETE, _INSERT, _REROLE, _CUT = 4, 3, 3, 3
_FULL = {"u": "user", "a": "assistant"}
# The initial that an inserted or renamed turn gets after each last initial ("" before the first).
_FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
_ENDS = ("", "a")
# Faults of a row, the first that applies.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


def edits(rows: list[tuple[str, int]], i: int, last: str, closing: bool) -> Iterator[tuple[str, int, int, str]]:
    """Edits at row `i` after initial `last`, in ASCII order: letter, cost, next row, next initial.

    Rows are (initial, fault). Insertions after the last row exist only if `closing`.
    """
    inside, follows = i < len(rows), _FOLLOWS[last]
    if inside:
        yield "D", _DELETE, i + 1, last
    if inside or closing:
        yield "I", _INSERT, i, follows
    if inside:
        initial, fault = rows[i]
        if fault not in (BLANK, DUPLICATE):
            extra = _CUT if fault == TRUNCATED else 0
            if initial == follows or initial == "s" and last == "":
                yield "K", extra, i + 1, initial
            yield "R", _REROLE + extra, i + 1, follows


def search(rows: list[tuple[str, int]], entry: str = "", exit: str | None = None) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of `rows`, the ASCII-least of them.

    Iterative-deepening A*: depth first in ASCII order under a cost bound that grows to the
    least cost that went beyond it. A state that failed is kept with the cost it was shown to need at
    least, which replaces the estimate from then on, so no state is searched twice for the same budget.
    The estimate counts what every row costs whatever its neighbours are. The search
    starts after the initial `entry`; it ends in a complete dialogue if `exit` is None, else right
    after the last row with `exit` as the last initial, which must be reachable.
    """
    n, closing = len(rows), exit is None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        fault = rows[i][1]
        least[i] = least[i + 1] + (_DELETE if fault in (BLANK, DUPLICATE) else _CUT if fault == TRUNCATED else 0)
    failed: dict[tuple[int, str], int] = {}
    letters: list[str] = []

    def visit(i: int, last: str, left: int) -> int:
        """Cost to the end if it is at most `left` (its letters are then noted), else a lower bound of it."""
        needs = failed.get((i, last), least[i])
        if needs > left:
            return needs
        if i == n and (last in _ENDS if closing else last == exit):
            return 0
        best = 1 << 60
        for letter, cost, j, initial in edits(rows, i, last, closing):
            rest = visit(j, initial, left - cost)
            if cost + rest <= left:
                letters.append(letter)
                return cost + rest
            best = min(best, cost + rest)
        failed[i, last] = max(best, failed.get((i, last), 0))
        return best

    bound = least[0]
    while (needs := visit(0, entry, bound)) > bound:
        bound = needs
    return needs, "".join(reversed(letters))


def _reachable(rows: list[tuple[str, int]], entry: str) -> Iterator[str]:
    """Last initials that edits of `rows` (at least one) can lead to from `entry`."""
    yield from "ua"
    if entry in ("", "s"):
        yield entry
    if entry == "" and any(initial == "s" and fault in (SOUND, TRUNCATED) for initial, fault in rows):
        yield "s"


def repaired(rows: list[tuple[str, str]], letters: str, last: str = "") -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that the edits `letters` make of `rows` (role, text) after initial `last`."""
    source = iter(rows)
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(source)
        if letter == "D":
            continue
        if letter != "K":
            role = _FULL[_FOLLOWS[last]]
        last = role[:1]
        yield role, text


class Conversation:
    """One conversation's rows in order: counts, and the best edits so far for each last initial.

    What is held is one part of the rows, and for each initial the letters and the running digest
    of the best edits that lead to it.
    """

    def __init__(self):
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = 0
        self.first = self.latest = self._initial = None
        self._best = {"": (0, "", hashlib.sha256())}
        self._rows: list[tuple[str, str]] = []
        self._codes: list[tuple[str, int]] = []

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if len(self._rows) == PART:
            self._advance()
        self.faults[fault] += 1
        initial = role[:1]
        if self._initial is not None and self._initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self._initial = initial
        if turn is not None and turn != self.latest:
            self.distinct += 1
            self.first = turn if self.first is None else self.first
            self.latest = turn
        self._rows.append((role, text))
        self._codes.append((initial, fault))

    def _advance(self) -> None:
        """The held part's best edits from every initial to every other, joined to what is best so far.

        No edits of the same rows that end in a row are a proper prefix of others, so the ASCII-least
        ones of a part stay so whatever follows.
        """
        found: dict[str, tuple[int, str, str]] = {}
        for entry, (cost, letters, _) in self._best.items():
            for exit in _reachable(self._codes, entry):
                more, part = search(self._codes, entry, exit)
                known = found.get(exit)
                if known is None or (cost + more, letters + part) < (known[0], self._best[known[1]][1] + known[2]):
                    found[exit] = (cost + more, entry, part)
        self._best = {
            exit: (cost, self._best[entry][1] + part, self._digest(entry, part)) for exit, (cost, entry, part) in found.items()
        }
        self._rows, self._codes = [], []

    def _digest(self, entry: str, letters: str):
        digest, begun = self._best[entry][2].copy(), entry != ""
        for role, text in repaired(self._rows, letters, entry):
            digest.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
            begun = True
        return digest

    def result(self) -> tuple[int, int, int, int, int, int, str, str]:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        ends = []
        for entry, (cost, letters, _) in self._best.items():
            more, part = search(self._codes, entry)
            ends.append((cost + more, letters + part, entry, part))
        cost, audit, entry, part = min(ends)
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.distinct
        return gaps, *self.faults[1:], self.illegal, cost, audit, self._digest(entry, part).hexdigest()


def with_faults(turns: DataFrame) -> DataFrame:
    """`turns` (conv, turn, role, text, copy, gone) with the first fault of each row.

    Blank: nothing but ASCII white space. Duplicate: role and text stand earlier in the conversation. Truncated: the
    last character that is no ASCII white space is none of `.!?`.
    """
    earlier = F.row_number().over(Window.partitionBy("conv", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first(), "copy"))
    bare = F.rtrim("text", F.lit(_BLANKS))
    fault = (
        F.when(F.ltrim(bare, F.lit(_BLANKS)) == "", BLANK)
        .when(earlier > 1, DUPLICATE)
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    return turns.withColumn("fault", fault)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copy, gone): rows harmed by crc32 of `conv:turn` modulo 20, nulls counting as one space.

    0: the row goes (it stays as `gone`, so that its conversation is known); 1: empty text; 2: no `.!?`
    in the text; 3: the row stands twice; 4: the role is user. Others stay.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")))
    rows = rows.withColumn("harm", F.crc32(F.encode(name, "UTF-8")) % 20)
    return rows.select(
        "conv", "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("harm") == 0).alias("gone"),
        F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _in_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]


def repair(turns: DataFrame) -> DataFrame:
    """One row for each `conv` of `turns` (conv, turn, role, text, copy, gone): counts, cheapest edits and digest.

    Rows are ordered by turn (nulls first), then role, text and copy; those that are `gone` only
    name their conversation. Result: conv, gaps (missing turns between the least and the largest),
    blank, duplicate, truncated (rows by first fault), illegal (adjacent rows whose initials are none of
    su, ua, au), cost and audit of the cheapest edits (K keep, R other role, D delete, I insert an
    empty turn; ties to the ASCII-least) and repaired_sha256 of their `role:text` lines. A conversation without rows
    has zeros, no edits and the digest of nothing. Roles count by their first character; a null `conv` is one
    conversation; `turn` is a long, `role` and `text` are no nulls.

    A conversation is a sorted stream of one task, since its digest goes over all its lines in order; the
    task holds one part of `PART` rows of it and its letters. Duplicates are found before that, by role and text.
    """
    kind = turns.schema["conv"].dataType.simpleString()
    # A row that is gone must not make another one a duplicate, and needs no text.
    rows = with_faults(turns).withColumn("text", F.when(~F.col("gone"), F.col("text")))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", *_in_order())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, done = None, None, []

        def flush():
            columns = list(zip(*done)) if done else [()] * 9
            kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for part in portions(batch, "text"):
                for conv, turn, role, text, gone, fault in zip(*(part.column(c).to_pylist() for c in order)):
                    if held is None or conv != name:
                        if held is not None:
                            done.append((name, *held.result()))
                        name, held = conv, Conversation()
                    if not gone:
                        held.add(turn, role, text, fault)
                if len(done) >= 1000:
                    yield flush()
                    done = []
        if held is not None:
            done.append((name, *held.result()))
            yield flush()

    order = ["conv", "turn", "role", "text", "gone", "fault"]
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    counts = ", ".join(f"{c} long" for c in names[1:7])
    return dealt.select(*order).mapInArrow(run, f"conv {kind}, {counts}, audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, place, role, text): the turns of all repaired conversations, from place 1.

    `found` is what `repair` gave for `turns`. Each letter but an insertion takes the next row in order, so
    rows and letters are joined by number; new roles follow from the place in the dialogue.
    """
    rows = turns.where(~F.col("gone")).select(
        F.col("conv").alias("of"), "role", "text", F.row_number().over(Window.partitionBy("conv").orderBy(*_in_order())).alias("nth")
    )
    so_far = Window.partitionBy("conv").orderBy("step")
    letters = found.where("audit <> ''").select("conv", F.posexplode(F.split("audit", "")).alias("step", "letter")).where("letter <> ''")
    placed = letters.withColumns({
        "takes": F.count_if(F.col("letter") != "I").over(so_far), "place": F.count_if(F.col("letter") != "D").over(so_far),
    }).where("letter <> 'D'")
    joined = placed.join(
        rows, F.col("conv").eqNullSafe(F.col("of")) & (F.col("takes") == F.col("nth")) & (F.col("letter") != "I"), "left"
    )
    system = F.max(((F.col("place") == 1) & (F.col("letter") == "K") & F.startswith("role", F.lit("s"))).cast("int")).over(Window.partitionBy("conv"))
    asks = (F.col("place") - system) % 2 == 1
    return joined.select(
        "conv", "place",
        F.when(F.col("letter") == "K", F.col("role")).when(asks, "user").otherwise("assistant").alias("role"),
        F.when(F.col("letter") == "I", "").otherwise(F.col("text")).alias("text"),
    )
