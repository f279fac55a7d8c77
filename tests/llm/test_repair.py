import functools
import hashlib
import random
import zlib

import pytest

from forumshift.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
READS = {"": "su", "s": "u", "u": "a", "a": "u"}
SPACES = "\t\n\x0b\x0c\r "


def plain(turns):
    """The report and the lines of one conversation, trying every edit of every row from the end."""
    rows = sorted(((t is not None, t or 0), r if r is not None else " ", x if x is not None else " ") for t, r, x in turns)
    named, seen = [], set()
    for _, role, text in rows:
        said = text.strip(SPACES)
        named.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))

    @functools.cache
    def best(i, state, put_in):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        for x in READS[state]:
            if x != "s" and put_in < 3:
                c, a, out = best(i, x, put_in + 1)
                ways.append((c + 2, "I" + a, ({"u": "user:", "a": "assistant:"}[x],) + out))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, out = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, out))
            if named[i] not in ("blank", "duplicate"):
                for x in READS[state]:
                    c, a, out = best(i + 1, x, 0)
                    c += named[i] == "truncated"
                    if role[:1] == x:
                        ways.append((c, "K" + a, (f"{role}:{text}",) + out))
                    elif x != "s":
                        ways.append((c + 2, "R" + a, ({"u": "user", "a": "assistant"}[x] + ":" + text,) + out))
        return min(ways, key=lambda w: w[:2], default=(10 ** 9, "", ()))

    cost, audit, out = best(0, "", 0)
    known = [t for (there, t), _, _ in rows if there]
    initials = [role[:1] for _, role, _ in rows]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, named.count("blank"), named.count("duplicate"),
            named.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit), out


def by_conversation(rows):
    out = {}
    for conv, *turn in rows:
        out.setdefault(conv, []).append(tuple(turn))
    return out


def found(spark, rows):
    done = repair.Repair(spark.createDataFrame(rows, SCHEMA).repartition(5))
    lines = {}
    for x in sorted(done.turns.collect(), key=lambda x: (x.conv_id is not None, x.conv_id or 0, x.step)):
        lines.setdefault(x.conv_id, []).append(f"{x.role}:{x.text}")
    digest = {x.conv_id: x.sha256 for x in repair.digests(done.turns).collect()}
    assert digest == {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in lines.items()}
    return {x.conv_id: (tuple(x)[1:], tuple(lines.get(x.conv_id, ()))) for x in done.report.collect()}


def random_rows(seed, conversations=150, longest=9):
    r = random.Random(seed)
    return [(c, r.choice([t, t, t, t, None, r.randrange(9)]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             r.choice(["Yes.", "No!", "cut off", "", " \n", None, "Why? ", "é…", "same.", "same."]))
            for c in range(conversations) for t in range(r.randint(1, longest))]


@pytest.mark.parametrize("block", [512, 2])
def test_equals_trying_every_edit(spark, monkeypatch, block):
    """Blocks of two rows and whole conversations give the same lightest edits."""
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = random_rows(3)
    assert found(spark, rows) == {c: plain(t) for c, t in by_conversation(rows).items()}


def test_one_long_conversation_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 7)
    rows = random_rows(5, conversations=1, longest=1) + [(9, t, r, x) for _, t, r, x in random_rows(6, conversations=60, longest=6)]
    import sys
    monkeypatch.setattr(sys, "setrecursionlimit", sys.setrecursionlimit)
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(10_000)
    try:
        want = {c: plain(t) for c, t in by_conversation(rows).items()}
    finally:
        sys.setrecursionlimit(limit)
    assert found(spark, rows) == want
    done = repair.Repair(spark.createDataFrame(rows, SCHEMA))
    assert done._rows.selectExpr("place >> 33 AS part").distinct().count() > 1


def test_nulls_ties_empty_texts_long_texts_and_clashing_columns(spark):
    rows = [(None, None, None, None), (1, 0, "user", "x" * 200_000 + "."), (1, 1, "assistant", "Hi."), (1, 1, "assistant", "Hi."),
            (2, 5, "", "Hm."), (3, None, "user", "a."), (3, None, "user", "b."), (4, 0, "user", "\u0085")]
    assert found(spark, rows) == {c: plain(t) for c, t in by_conversation(rows).items()}
    assert repair.Repair(spark.createDataFrame([], SCHEMA)).report.count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "Hi.", 7, "k")], SCHEMA + ", place long, fault string")
    assert [tuple(x) for x in repair.Repair(clash).report.collect()] == [(1, 0, 0, 0, 0, 0, 2, "KI")]


def test_agenda_takes_the_least_letters_among_equal_costs():
    table = repair.lightest([("a", False, False), ("u", False, False)])
    assert table[repair.START, repair.AFTER_A] == (4, "RR")
    assert repair.joined([table]) == (4, ["IKKI"[:3], "I"])


def test_registered_query_reports_every_conversation(spark, sf001):
    turns = spark.read.parquet(f"{sf001}/conversations.parquet")
    want = {}
    for conv, rows in by_conversation([tuple(x) for x in turns.select("conv_id", "turn", "role", "text").collect()]).items():
        out = []
        for t, role, text in rows:
            h = zlib.crc32(f"{conv}:{t}".encode()) % 20
            text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
            out += [(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        report, lines = plain(out) if out else ((0,) * 6 + ("",), ())
        want[conv] = report + (hashlib.sha256("\n".join(lines).encode()).hexdigest(),)
    assert {x.conv_id: tuple(x)[1:] for x in queries.op13_repair(spark, sf001).collect()} == want


def test_registered_query_equals_its_sql(spark, sf01):
    from oracle_check import compare
    assert compare(spark, sf01, ["op13_repair"], verbose=False)["op13_repair"]["match"]
