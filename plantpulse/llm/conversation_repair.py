"""Repair of conversation structure over a suffix-shared automaton of signatures.

A row has one letter for its role and fault, and a conversation the string of its letters, its signature. All signatures
are put in order from their ends, so those with a common ending follow each other and the ending is one chain
of automaton nodes for all of them. A node holds, for each state of the grammar ``(s?(ua)+)?``, the cost of
the cheapest edits of what follows and the first letters of the best audit of it. Nodes are minimised: two endings
whose costs differ by a constant and whose audits stand in the same order leave all rows before them the same choice,
so they are one node. Each step from a node by a letter is computed once, for all conversations of a task.

Edits of a row: K keeps it, R gives it the role user or assistant (1), D deletes it (2, the only edit of blank
and repeated rows); I inserts a row without text (5). A truncated row that stays costs 5 more.

Rows travel twice: first without their texts, to make the signatures, and then with them, to be edited. Tasks
stream over sorted rows and hold one letter for each row of a conversation, which is no more than its audit has; a
digest of a whole conversation can only be taken by one task, however long the conversation is.

Cases: NULL role, text, id or turn read as one space where they are part of a text or key; rows of one turn are
taken by role and then by digest of the text; equal rows are repeats of the first; rows without an id are one
conversation; a conversation whose rows are all gone has zeros, an empty audit, and no repaired rows; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.common import written

#: White space of the contract, as characters.
_WHITE = " \t\n\x0b\x0c\r"
#: Grammar: nothing yet, after the system row, after user, after assistant.
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_ENDS = [True, False, False, True]
_ROLES = {"u": "user", "a": "assistant"}
_REROLE, _DELETE, _INSERT, _TRUNCATED = 1, 2, 5, 5
#: A letter for rows that have to go; the others have the initial of the role, in capitals if truncated.
_GONE = "d"
_BATCH = 4_000


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: rows damaged by a hash of their key; a dropped row has 0 times."""

    def part(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    return conversations.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("times"))


def _in_turn() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _known(rows: DataFrame) -> DataFrame:
    """NULLs read as one space, and a digest of the text."""
    full = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    return full.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_SIGNED = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("signature", pa.string())])


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id``, the counts of its faults, and ``signature``, for each conversation."""
    bare = F.rtrim("text", F.lit(_WHITE))
    fault = F.when(bare == "", 1).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(2)
    light = _known(rows).select("conv_id", "turn", "role", "digest", fault.alias("fault"), "times")
    equal = light.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("times").alias("times"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    there = equal.where("times > 0")
    first = there.groupBy(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")).agg(F.min(at).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    # A row that was dropped has no place, but its conversation is reported.
    met = equal.join(first, same, "left").withColumn("new", at.eqNullSafe(F.col("_first")))
    sorted_rows = met.repartition("conv_id").sortWithinPartitions(*_in_turn())

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        nothing = object()
        now, counts, letters = nothing, [0] * 5, []
        low = high = last_turn = last = None
        turns = 0

        def done() -> tuple:
            gaps = high - low + 1 - turns if turns else 0
            return (now, gaps, *counts[1:], "".join(letters))

        for batch in batches:
            for conv, turn, role, fault, times, new in zip(*[c.to_pylist() for c in batch.columns]):
                if now is nothing or conv != now:
                    if now is not nothing:
                        made.append(done())
                    now, counts, letters, turns, last_turn, last = conv, [0] * 5, [], 0, None, None
                if not times:
                    continue
                if turn is not None:
                    low = turn if not turns else low
                    high, turns, last_turn = turn, turns + (turn != last_turn), turn
                initial = role[:1]
                if last is not None and last + initial not in ("su", "ua", "au"):
                    counts[4] += 1
                counts[4] += times - 1
                last = initial
                if fault == 1 or not new:
                    counts[1 if fault == 1 else 2] += times
                    letters.append(_GONE * times)
                    continue
                letter = initial if initial in ("s", "u", "a") else "x"
                counts[2] += times - 1
                counts[3] += fault == 2
                letters.append((letter.upper() if fault == 2 else letter) + _GONE * (times - 1))
            while len(made) >= _BATCH:
                yield _table(made[:_BATCH], _SIGNED)
                del made[:_BATCH]
        if now is not nothing:
            made.append(done())
        if made:
            yield _table(made, _SIGNED)

    schema = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", signature string"
    return sorted_rows.select("conv_id", "turn", "role", "fault", "times", "new").mapInArrow(signed, schema)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Automaton:
    """Minimised nodes of endings, and the steps between them.

    A node is a pair: costs for each grammar state, less the lowest, and the places of their audits in order.
    ``step(node, letter)`` gives the node of the ending that begins with the letter, what it adds to
    all costs, and for each grammar state the edits (letters) and the state after them.
    """

    def __init__(self) -> None:
        self.steps: dict[tuple, tuple] = {}
        ends = []
        for state in range(4):
            inserted, at = 0, state
            while not _ENDS[at]:
                inserted, at = inserted + 1, self._inserted(at)
            ends.append(inserted)
        self.tails = ["I" * n for n in ends]
        self.end = (tuple(_INSERT * n for n in ends), tuple(ends))

    @staticmethod
    def _inserted(state: int) -> int:
        """The state after the one row that may be inserted here: user, or assistant after a user."""
        return _NEXT[state]["a" if state == 2 else "u"]

    def _edits(self, state: int, letter: str) -> Iterator[tuple[int, str, int]]:
        yield _DELETE, "D", state
        if letter == _GONE:
            return
        stays = _TRUNCATED if letter.isupper() else 0
        kept = _NEXT[state].get(letter.lower())
        if kept is not None:
            yield stays, "K", kept
        yield stays + _REROLE, "R", self._inserted(state)

    def step(self, node: tuple, letter: str) -> tuple:
        found = self.steps.get((node, letter))
        if found is not None:
            return found
        costs, places = node
        best = []
        for state in range(4):
            choices, at = [], state
            # From each state two inserted rows lead back to it or to one that is met on the way.
            for n in range(3):
                for cost, edit, after in self._edits(at, letter):
                    choices.append((n * _INSERT + cost + costs[after], "I" * n + edit, places[after], after))
                at = self._inserted(at)
            best.append(min(choices))
        least = min(b[0] for b in best)
        # No list of edits is the beginning of another one, so these pairs stand in the order of the whole audits.
        audits = [b[1:3] for b in best]
        order = {a: i for i, a in enumerate(sorted(set(audits)))}
        made = (tuple(b[0] - least for b in best), tuple(order[a] for a in audits))
        self.steps[node, letter] = found = (made, least, tuple((b[1], b[3]) for b in best))
        return found


class Planner:
    """Cost and audit of signatures that come in the order of their reversed letters."""

    def __init__(self) -> None:
        self._automaton = Automaton()
        self._chain: list[tuple] = []
        self._letters = ""

    def __call__(self, signature: str) -> tuple[int, str]:
        letters = signature[::-1]
        shared, most = 0, min(len(letters), len(self._letters))
        while shared < most and letters[shared] == self._letters[shared]:
            shared += 1
        chain, step = self._chain, self._automaton.step
        del chain[shared:]
        node, added = (chain[-1][0], chain[-1][1]) if chain else (self._automaton.end, 0)
        for letter in letters[shared:]:
            node, more, edits = step(node, letter)
            added += more
            chain.append((node, added, edits))
        self._letters = letters
        audit, state = [], 0
        for _, _, edits in reversed(chain):
            written_, state = edits[state]
            audit.append(written_)
        audit.append(self._automaton.tails[state])
        return added + node[0][0], "".join(audit)


_PLANNED = pa.schema([*_SIGNED, ("cost", pa.int64()), ("audit", pa.string())])


def plans(rows: DataFrame) -> DataFrame:
    """``conv_id``, counts, ``signature``, ``cost`` and ``audit`` of each conversation, as a written table."""
    heads, _ = written(signatures(rows), "signatures")
    backward = F.reverse("signature")
    # Borders are drawn on the beginning of the reversed signature; a frequent signature is split by id.
    dealt = heads.withColumn("_backward", backward).repartitionByRange(
        F.substring("_backward", 1, 64), F.xxhash64("_backward"), F.col("conv_id"))

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Planner()
        for batch in batches:
            found = [plan(s) for s in batch.column("signature").to_pylist()]
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())]
            yield pa.record_batch(columns, schema=_PLANNED)

    schema = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", signature string, cost long, audit string"
    ordered = dealt.sortWithinPartitions("_backward", "conv_id").drop("_backward")
    return written(ordered.mapInArrow(planned, schema), "plans")[0]


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


class Editor:
    """Follows the audit of one conversation along its rows."""

    def __init__(self, audit: str):
        self._audit, self._at, self._state = audit, 0, 0

    def _inserts(self) -> Iterator[tuple[str, str, str]]:
        while self._audit[self._at : self._at + 1] == "I":
            initial = "a" if self._state == 2 else "u"
            self._state, self._at = _NEXT[self._state][initial], self._at + 1
            yield "I", _ROLES[initial], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserts()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            self._state = _NEXT[self._state][role[0]]
            yield edit, role, text
        elif edit == "R":
            initial = "a" if self._state == 2 else "u"
            self._state = _NEXT[self._state][initial]
            yield edit, _ROLES[initial], text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserts()


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the rows after the edits of ``planned``; deleted rows are gone.

    The rows of a conversation are in one partition, in order.
    """
    lines = _known(rows).where("times > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "times")
    heads = planned.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text"))
    both = lines.unionByName(heads, allowMissingColumns=True)
    turn = _in_turn()
    ordered = both.repartition("conv_id").sortWithinPartitions(turn[0], "kind", *turn[1:])

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, now, place, out = None, None, 0, []

        def put(made: Iterator[tuple[str, str, str]]) -> None:
            nonlocal place
            for row in made:
                place += 1
                out.append((now, place, *row))

        for batch in batches:
            for conv, kind, role, text, times in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    if editor is not None:
                        put(editor.end())
                    editor, now, place = Editor(text), conv, 0
                else:
                    for _ in range(times):
                        put(editor.row(role, text))
            if out:
                yield _table(out, _REPAIRED)
                out.clear()
        if editor is not None:
            put(editor.end())
            if out:
                yield _table(out, _REPAIRED)

    return ordered.select("conv_id", "kind", "role", "text", "times").mapInArrow(
        edited, "conv_id long, place long, edit string, role string, text string")


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; ``rows`` come from :func:`repaired`, in their order."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, out = None, None, []
        for batch in batches:
            for conv, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
                if place == 1:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    state, now = hashlib.sha256(), conv
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(out) >= _BATCH:
                yield _table(out, _DIGESTS)
                out = []
        if state is not None:
            out.append((now, state.hexdigest()))
        if out:
            yield _table(out, _DIGESTS)

    return rows.mapInArrow(hashed, "conv_id long, repaired_sha256 string")


def summaries(rows: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest of the repaired rows, for each conversation."""
    planned = plans(rows)
    hashes = digests(repaired(rows, planned)).withColumnRenamed("conv_id", "_conv")
    empty = hashlib.sha256().hexdigest()
    return planned.join(hashes, planned["conv_id"].eqNullSafe(hashes["_conv"]), "left").select(
        "conv_id", *_COUNTS, "cost", "audit", F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
