import hashlib
import random
import re
import zlib
from itertools import groupby

from plantpulse.llm.conversation_repair import Automaton, Planner, damaged, plans, repaired, summaries
from plantpulse.llm.queries import queries

from .helpers import FOLDER, table

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = "\x20\t\n\x0b\x0c\r"


def all_edits(rows):
    """Cost, audit and lines of every way to edit rows of (role, text, gone, truncated), two inserts in a gap at most."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def go(i, lines, audit, cost, inserted):
        # Deleting everything costs two for each row, so nothing dearer is wanted.
        if cost > 2 * len(rows):
            return
        last = lines[-1][0][:1] if lines else ""
        if i == len(rows) and last in ("", "a"):
            yield cost, audit, lines
        if inserted < 2:
            for role in ("user", "assistant"):
                if role[0] in after[last]:
                    yield from go(i, [*lines, (role, "")], audit + "I", cost + 5, inserted + 1)
        if i < len(rows):
            role, text, gone, cut = rows[i]
            yield from go(i + 1, lines, audit + "D", cost + 2, 0)
            if not gone:
                if role[:1] and role[0] in after[last]:
                    yield from go(i + 1, [*lines, (role, text)], audit + "K", cost + 5 * cut, 0)
                for new in ("user", "assistant"):
                    if new[0] in after[last]:
                        yield from go(i + 1, [*lines, (new, text)], audit + "R", cost + 1 + 5 * cut, 0)

    return min(go(0, [], "", 0, 0))


def plain(conversations, best):
    """The contract row by row; ``best`` gives cost, audit and lines of one conversation's judged rows."""
    out = {}
    key = lambda r: (r["conv_id"] is not None, r["conv_id"] or 0)
    for conv, rows in groupby(sorted(conversations, key=key), key=lambda r: r["conv_id"]):
        made = []
        for r in rows:
            shown = [" " if r[c] is None else str(r[c]) for c in ("conv_id", "turn")]
            role, text = (" " if r[c] is None else r[c] for c in ("role", "text"))
            code = zlib.crc32(":".join(shown).encode()) % 20
            if code == 1:
                text = ""
            if code == 2:
                text = re.sub("[.!?]", "", text)
            made += [(r["turn"], "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
        made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        judged, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in made:
            bare = text.rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in made if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(made, made[1:])]
        cost, audit, lines = best(judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_query_equals_all_ways_to_edit(spark):
    got = found(queries()["op11_conversation_repair"](spark, FOLDER))
    rows = table("conversations")
    sizes = {c: sum(r["conv_id"] == c for r in rows) for c in got}
    short = {c for c, n in sizes.items() if n <= 6}
    want = plain([r for r in rows if r["conv_id"] in short], all_edits)
    assert len(want) > 10 and {c: got[c] for c in want} == want
    assert set(got) == {r["conv_id"] for r in rows}


def test_random_faults_against_all_ways(spark):
    draw = random.Random(3)
    rows = []
    for conv in range(120):
        for turn in range(draw.randint(1, 5)):
            text = draw.choice(["One.", "Two!", "cut off", "  ", "same.", "same.", "Fünf? \n"])
            rows.append((conv, draw.choice([turn, turn, None, 7]), draw.choice(["system", "user", "assistant", "user", "tool", "", None]), text))
    got = found(summaries(damaged(spark.createDataFrame(rows, SCHEMA))))
    keys = SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert got == plain([dict(zip(keys, r)) for r in rows], all_edits)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", ""), (1, 2, "assistant", "x" * 100_000), (1, 2, "assistant", "x" * 100_000)]
    rows += [(2, t, "user", "Again.") for t in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS digest", "1 AS times", "'no' AS signature", "0 AS kind")
    got = found(summaries(damaged(df)))
    assert set(got) == {None, 1, 2} and got[2][2] >= 40
    assert summaries(damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    keep = [i for i in range(3_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][0]
    gone = found(summaries(damaged(spark.createDataFrame([(keep, 0, "user", "Hi.")], SCHEMA))))
    assert gone == {keep: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_repaired_rows_obey_the_grammar(spark):
    rows = damaged(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    by = {}
    for r in repaired(rows, plans(rows)).collect():
        by.setdefault(r.conv_id, []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r.place)
        assert [r.place for r in rows] == list(range(1, len(rows) + 1))
        assert re.fullmatch(r"s?(ua)+", "".join(r.role[0] for r in rows))


def test_nodes_are_shared_and_few():
    draw = random.Random(1)
    signatures = sorted(("".join(draw.choices("suaxSUAXd", k=draw.randint(0, 60))) for _ in range(3_000)), key=lambda s: s[::-1])
    plan = Planner()
    assert [plan(s) for s in signatures] == [Planner()(s) for s in signatures]
    # Endings merge into far fewer nodes than there are letters.
    assert len(plan._automaton.steps) < 3_000 < sum(map(len, signatures)) / 20
    assert Automaton().end == ((0, 10, 5, 0), (0, 2, 1, 0))
