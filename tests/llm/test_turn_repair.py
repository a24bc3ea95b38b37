import hashlib
import random
import re
import zlib

import pytest

from siltline.llm import queries, turn_repair
from siltline.llm.turn_repair import ASSISTANT, PROPER, START, SYSTEM, USER

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def best(symbols, entry=START, exits=PROPER):
    """(cost, audit) by trying what the cheapest audits of all prefixes can become, state by state."""
    step = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
    due = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

    def filled(ways):
        for _ in range(4):  # inserted rows
            for s, (c, a) in list(ways.items()):
                way = (c + 5, a + "I")
                ways[due[s]] = min(ways.get(due[s], way), way)
        return ways

    ways = filled({entry: (0, "")})
    for x in symbols:
        new = {}
        for s, (c, a) in ways.items():
            to = [(s, 2, "D")]
            if x != "d":
                more = 5 if x.isupper() else 0
                to.append((due[s], 1 + more, "R"))
                if (s, x.lower()) in step:
                    to.append((step[s, x.lower()], more, "K"))
            for t, cost, edit in to:
                way = (c + cost, a + edit)
                new[t] = min(new.get(t, way), way)
        ways = filled(new)
    return min((ways[s] for s in exits if s in ways), default=None)


def every_audit(symbols, most):
    """(cost, audit) of all sequences of edits up to a cost that end properly."""
    out = []

    def go(i, said, cost, audit):
        if cost > most:
            return
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", said):
            out.append((cost, audit))
        if i < len(symbols):
            x = symbols[i]
            go(i + 1, said, cost + 2, audit + "D")
            if x != "d":
                more = 5 if x.isupper() else 0
                go(i + 1, said + x.lower(), cost + more, audit + "K")
                for role in "ua":
                    go(i + 1, said + role, cost + 1 + more, audit + "R")
        for role in "ua":
            go(i, said + role, cost + 5, audit + "I")

    go(0, "", 0, "")
    return min(out)


def brute(log):
    """Rows of the query by definition, for logs in which turns are in order."""
    convs = {}
    for conv, turn, role, text in log:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in rows if t is not None}
        seen, symbols, faults = set(), "", [0, 0, 0]
        for _, role, text in rows:
            said = text.strip(SPACE)
            own = role[:1] if role[:1] in tuple("sua") else "o"
            if not said:
                faults[0] += 1
                own = "d"
            elif (role, text) in seen:
                faults[1] += 1
                own = "d"
            elif said[-1] not in ".!?":
                faults[2] += 1
                own = own.upper()
            seen.add((role, text))
            symbols += own
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = best(symbols)
        out, i, state = [], 0, START
        for edit in audit:
            role, text = (rows[i][1], rows[i][2]) if edit != "I" else ("", "")
            i += edit != "I"
            if edit in "IR":
                role = "assistant" if state == USER else "user"
            if edit != "D":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                out.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        yield (conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_search_against_every_audit():
    r = random.Random(1)
    for _ in range(150):
        symbols = "".join(r.choice("suaoSUAOd") for _ in range(r.randint(0, 5)))
        cost, audit, _ = turn_repair.search(symbols)
        assert (cost, audit) == every_audit(symbols, cost)


def test_search_from_and_to_all_states():
    r = random.Random(2)
    for _ in range(400):
        symbols = "".join(r.choice("suaoUAd" if r.random() < 0.5 else "u") for _ in range(r.randint(0, 30)))
        for entry in range(4):
            for exits in ((START,), (SYSTEM,), (USER,), (ASSISTANT,), PROPER):
                found = turn_repair.search(symbols, entry, exits)
                assert (found[:2] if found else None) == best(symbols, entry, exits)
    for symbols in ("u" * 64, "a" * 64, "o" * 64, "uua" * 21, "sad" * 21, "UA" * 32):
        assert turn_repair.search(symbols)[:2] == best(symbols)


def test_fold_equals_one_search(monkeypatch):
    r = random.Random(3)
    for _ in range(100):
        symbols = "".join(r.choice("suaoUAd") for _ in range(r.randint(1, 60)))
        fold = turn_repair.Fold()
        for i in range(0, len(symbols), 7):
            ways = turn_repair._ways(symbols[i : i + 7], i == 0, False)
            fold.add([(w["before"], w["after"], w["cost"], w["audit"]) for w in ways])
        assert fold.best() == best(symbols)


def made_log():
    r = random.Random(4)
    said = ["Yes.", "No", " ", "", "Why?", "Well, yes!\t\n", "é…", "漢字.", None]
    log = []
    for conv in [*range(40), None]:
        roles = ["user", "assistant", "system", "tool", "", None, "User"]
        for turn in range(r.choice([1, 4, 9])):
            role = r.choice(roles) if r.random() < 0.2 else ("user", "assistant")[turn % 2]
            log.append((conv, None if r.random() < 0.05 else turn * r.choice([1, 1, 1, 3]), role, f"{r.choice(said)}" if r.random() < 0.3 else r.choice(said)))
    log += [(77, t, ("user", "assistant")[t % 3 == 1], f"Row {t // 2}{'.' if t % 5 else ''}") for t in range(400)]
    log += [(78, 3, "user", "Again.")] * 300 + [(78, 4, "assistant", "Again.")] * 3
    return log


@pytest.mark.parametrize("partitions", [1, 7])
def test_query_on_a_hostile_log(spark, path, partitions):
    log = made_log()
    table = spark.createDataFrame([(*row, "x") for row in log], "conv_id long, turn long, role string, text string, kind string")
    table.repartition(partitions).write.parquet(f"{path}/conversations.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == 1).lower())
    try:
        rows = queries.conversation_repair(spark, path).select(*COLUMNS).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    key = lambda row: (row[0] is not None, row[0] or 0)
    assert sorted(map(tuple, rows), key=key) == sorted(brute(log), key=key)


def test_repaired_rows(spark):
    log = [("c", 1, "user", "Hi."), ("c", 2, "user", "Hello"), ("c", 3, "assistant", "Yes."), ("d", 1, "assistant", "So.")]
    rows = turn_repair.repaired(spark.createDataFrame(log, "conv string, turn int, role string, text string")).collect()
    assert sorted(map(tuple, rows)) == [
        ("c", 1, "K", "user", "Hi."), ("c", 2, "K", "assistant", "Yes."),
    ]
    log = [("d", 1, "user", "So."), ("d", 2, "assistant", "Is it?"), ("d", 3, "user", "Yes.")] * 1
    log += [("d", 4, "user", "Again."), ("d", 5, "assistant", "Fine."), ("d", 6, "assistant", "Then.")]
    rows = turn_repair.repaired(spark.createDataFrame(log, "conv string, turn int, role string, text string")).collect()
    assert [(r.number, r.edit, r.role) for r in sorted(rows)] == [
        (1, "K", "user"), (2, "K", "assistant"), (3, "K", "user"), (4, "R", "assistant"), (5, "R", "user"), (6, "K", "assistant"),
    ]


def test_empty_log(spark):
    empty = spark.createDataFrame([], "conv string, turn int, role string, text string")
    assert turn_repair.repaired(empty).count() == 0 and turn_repair.report(empty).count() == 0
