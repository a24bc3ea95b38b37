import random

import pytest

from siltline.llm import chat

TYPES = "conv_id long, turn long, role string, text string, part string, hash int"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, set()).add((-1 if turn is None else turn, role or "", text or ""))
    whole = {c: tuple(sorted(t)) for c, t in convs.items()}
    kept = {}
    for c in sorted(whole):
        turns = whole[c]
        longer = any(o != turns and o[: len(turns)] == turns and o[len(turns)][0] > turns[-1][0] for o in whole.values() if len(o) > len(turns))
        if not longer and turns not in kept.values():
            kept[c] = turns
    return {c: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, t in turns) for c, turns in kept.items()}


def found(spark, rows):
    log = spark.createDataFrame([(*r, "x", 1) for r in rows], TYPES).repartition(4)
    got = {}
    for r in sorted(chat.rendered(log).collect(), key=lambda r: (r.conv_id, r.part)):
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
    return got


@pytest.mark.parametrize("part", [1024, 2])
def test_random_logs_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    r = random.Random(part)
    rows = []
    for c in range(60):
        for turn in range(r.randint(1, 6)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", r.choice("ab") if turn < 4 else "z"))
    assert found(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),
        (4, None, None, None), (4, 5, "user", "x"), (5, None, "", ""), (None, 0, "user", "lost"), (6, 0, "user", "a"), (6, 0, "user", "a"),
        (7, 0, "user", "a"), (7, 0, "user", "c"), (8, 0, "user", "long " * 50_000), (9, 1, "user", "a"),
    ]
    assert found(spark, rows) == brute(rows)
    log = spark.createDataFrame([], TYPES)
    assert chat.rendered(log).count() == 0 and chat.maximal(log).count() == 0


def test_long_conversation_and_frequent_first_turn(spark):
    rows = [(1, k, "user", f"t{k}") for k in range(3000)] + [(2, k, "user", f"t{k}") for k in range(2500)]
    rows += [(c, 0, "user", "hello") for c in range(100, 400)] + [(c, 1, "assistant", f"{c % 7}") for c in range(100, 400, 2)]
    got = found(spark, rows)
    assert got == brute(rows) and 2 not in got
    plan = chat.rendered(spark.createDataFrame([(*r, "", 0) for r in rows[:5]], TYPES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
