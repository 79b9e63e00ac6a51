import hashlib
import random
import re
import zlib

import pytest

from lakeshore.llm import turn_repair
from lakeshore.llm.turn_repair import cheapest_edits, damage, lower_bounds, op12_conversation_repair, repair, repaired_digests, row_code
from tests.conftest import SF01

SCHEMA = "conv_id long, turn long, role string, text string, position string, audit int"
WHITE = " \t\n\x0b\x0c\r"


def plain_edits(rows):
    """Cheapest (cost, audit) of (initial, fault) rows by dynamic programming over suffixes;
    compares whole audits and tries up to two insertions at each place."""
    steps = {"": "u", "s": "u", "u": "a", "a": "u"}
    kept = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {q: (0, "") if q in ("", "a") else (10**9, "") for q in steps}

    def inserted(costs):
        out = dict(costs)
        for _ in range(2):
            out = {q: min(out[q], (5 + out[steps[q]][0], "I" + out[steps[q]][1])) for q in steps}
        return out

    best = inserted(best)
    for initial, fault in reversed(rows):
        after = {}
        for q in steps:
            options = [(2 + best[q][0], "D" + best[q][1])]
            if fault in ("truncated", "sound"):
                more = 5 * (fault == "truncated")
                if initial and initial in kept[q]:
                    options.append((more + best[initial][0], "K" + best[initial][1]))
                options.append((1 + more + best[steps[q]][0], "R" + best[steps[q]][1]))
            after[q] = min(options)
        best = inserted(after)
    return best[""]


FAULTS = ["blank", "duplicate", "truncated", "sound"]


def codes(rows):
    return [row_code(initial, FAULTS.index(fault)) for initial, fault in rows]


def random_rows(rng, n):
    usual = "".join(rng.choice(["ua", "ua", "ua", "sua", "u", "a", "x", "s"]) for _ in range(n))[:n]
    return [(c, rng.choices(FAULTS, [1, 1, 2, 12])[0]) for c in usual]


@pytest.mark.parametrize("block", [4, 256])
def test_edits_equal_dynamic_programming(monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    rng = random.Random(block)
    for n in [0, 1, 2, 3, 5, 8] * 60 + [30, 90, 300]:
        rows = random_rows(rng, n)
        assert cheapest_edits(codes(rows)) == plain_edits(rows), rows


def test_bounds_are_below_the_cost(monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK", 8)
    rows = random_rows(random.Random(9), 60)
    bounds = lower_bounds(codes(rows))
    assert len(bounds) == 61 and bounds[0] <= cheapest_edits(codes(rows))[0]


def test_long_conversation():
    rows = random_rows(random.Random(4), 3000)
    cost, audit = cheapest_edits(codes(rows))
    assert (cost, audit) == plain_edits(rows)


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def expected(rows, hurt=damaged):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], [])
    for row in hurt(rows):
        groups[row[0]].append(row)
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        seen, faults = set(), []
        for _, _, role, text in turns:
            text_ = text.rstrip(WHITE)
            faults.append("blank" if not text_ else "duplicate" if (role, text) in seen else "sound" if text_[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = {r[1] for r in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        pairs = [(a[2][:1] or "-") + (b[2][:1] or "-") for a, b in zip(turns, turns[1:], strict=False)]
        cost, audit = plain_edits([(r[2][:1], f) for r, f in zip(turns, faults, strict=True)])
        repaired, state, at = [], "", 0
        for edit in audit:
            following = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            if edit == "I":
                repaired.append({"u": "user:", "a": "assistant:"}[following])
                state = following
                continue
            _, _, role, text = turns[at]
            at += 1
            if edit == "K":
                state = role[0]
                repaired.append(f"{role}:{text}")
            if edit == "R":
                state = following
                repaired.append({"u": "user", "a": "assistant"}[following] + f":{text}")
        out[conv] = (gaps, *(faults.count(f) for f in FAULTS[:3]), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def collected(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(rows) == len(out)
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_conversation_repair(spark, SF01)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert collected(got) == expected(rows)


def odd_rows():
    rng = random.Random(1)
    rows = [(i, t, rng.choice(["user", "assistant", "system", "tool", "", "uhu", None]),
             rng.choice(["Hi.", "Hi. \n", "no end", " \t", "", "what? ", "Ünï!", None, ".", "a\u00a0"])) for i in range(150) for t in range(rng.randrange(1, 9))]
    rows += [(None, None, "user", "Hi."), (None, 3, "assistant", None), (7777, None, None, None), (7778, 2**40, "user", "x" * 3_000_000 + "!")]
    rows += [(9000, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(4000)]  # a hot conversation
    return [(*r, "clash", 1) for r in rows]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(repaired_digests(repair(damage(df)))) == expected([r[:4] for r in rows])


def test_dropped_conversations_stay(spark):
    lost = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hi.", "", 0)], SCHEMA)
    assert collected(repaired_digests(repair(damage(df)))) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "A?"), (1, 2, "user", "A?"), (1, 4, "user", "B."), (1, 5, "assistant", " "), (2, 0, "assistant", "x.")]
    got = repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    first = [r for r in got if r.conv_id == 1]
    assert (first[0].gaps, first[0].blank, first[0].duplicate, first[0].truncated, first[0].illegal, first[0].cost, first[0].audit) == (1, 1, 1, 0, 2, 5, "KKDRD")
    assert [(r.position, r.edit, r.role, r.text) for r in first[1:]] == [
        (0, "K", "system", "S."), (1, "K", "user", "A?"), (2, "D", "user", "A?"), (3, "R", "assistant", "B."), (4, "D", "assistant", " ")]
    assert [(r.edit, r.audit) for r in got if r.conv_id == 2] == [(None, "D"), ("D", None)]


def test_empty_table(spark):
    assert repaired_digests(repair(damage(spark.createDataFrame([], SCHEMA)))).collect() == []
