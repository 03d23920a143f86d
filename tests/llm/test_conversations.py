"""Conversation repair: lattice against all edit sequences in cost order, whole table against plain Python, conversations over many files."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import prose

from ticketlens.llm import conversations as c
from ticketlens.llm import lattice

SCHEMA = "conv_id long, turn long, role string, text string, place long, fault string, k int, copies string"
LAWFUL = re.compile(r"(s?(ua)+)?")


def all_repairs(steps):
    """(cost, letters) of every edit sequence with at most two inserts in a row, by the rules alone."""
    gaps = ["", "I", "II"]
    options = [["D"] if go else ["K", "R", "D"] for _, _, go in steps]
    for letters in product(*options):
        for inserts in product(gaps, repeat=len(steps) + 1):
            audit = inserts[0] + "".join(a + b for a, b in zip(letters, inserts[1:]))
            shown, k, cost = "", 0, 0
            for x in audit:
                if x == "I":
                    shown, cost = shown + "?", cost + 3
                    continue
                initial, truncated, _ = steps[k]
                k += 1
                if x == "D":
                    cost += 4
                    continue
                cost += 3 * truncated + 3 * (x == "R")
                shown += initial if x == "K" else "?"
            # "?" may be u or a
            if any(LAWFUL.fullmatch("".join(f)) for f in product(*["ua" if ch == "?" else ch for ch in shown])):
                yield cost, audit


STEPS = st.lists(st.tuples(st.sampled_from("suat"), st.booleans(), st.integers(0, 3).map(lambda x: x == 0)), max_size=3)


@settings(max_examples=60, deadline=None)
@given(STEPS)
def test_shortest_against_all_edit_sequences(steps):
    assert lattice.repair(steps) == min(all_repairs(steps))


def best_by_rows(steps):
    """Least (cost, letters) kept per state, row by row."""
    ways = {lattice.START: (0, "")}

    def better(found, state, way):
        found[state] = min(found.get(state, way), way)

    for initial, truncated, go in steps:
        for _ in range(2):
            for q, (cost, letters) in list(ways.items()):
                better(ways, lattice.AFTER[q], (cost + 3, letters + "I"))
        found = {}
        for q, (cost, letters) in ways.items():
            better(found, q, (cost + 4, letters + "D"))
            if not go:
                extra = 3 if truncated else 0
                better(found, lattice.AFTER[q], (cost + 3 + extra, letters + "R"))
                if (q, initial) in lattice.KEPT:
                    better(found, lattice.KEPT[q, initial], (cost + extra, letters + "K"))
        ways = found
    return min((cost + lattice.TAIL[q][0], letters + lattice.TAIL[q][1]) for q, (cost, letters) in ways.items())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.booleans(), st.booleans()), min_size=1, max_size=25), st.integers(1, 6), st.integers(0, 25))
def test_blocks_and_stretches_change_nothing(steps, size, cut):
    want = best_by_rows(steps)
    assert lattice.repair(steps) == lattice.repair(steps, size=size) == want
    parts = [p for p in (steps[:cut], steps[cut:]) if p]
    cost, states = lattice.states_between([lattice.stretch_summary(p, size) for p in parts], lattice.START, lattice.TAIL)
    ways = [
        lattice.repair(p, a, lattice.TAIL if k == len(parts) - 1 else {b: (0, "")}, size)
        for k, (p, a, b) in enumerate(zip(parts, states, states[1:]))
    ]
    assert cost == want[0] and (sum(w[0] for w in ways), "".join(w[1] for w in ways)) == want


def plain(rows):
    """The query's result from its definition, one conversation at a time."""
    out = []
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 1:
                text = ""
            if kind == 2:
                text = re.sub("[.!?]", "", text)
            if kind == 4:
                role = "user"
            kept += [] if kind == 0 else [(turn is not None, turn or 0, role, text)] * (2 if kind == 3 else 1)
        kept.sort()
        seen, steps, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in kept:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            steps.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
        turns = [t for known, t, _, _ in kept if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:]))
        cost, audit = best_by_rows(steps)
        lines, state, k = [], lattice.START, 0
        for x in audit:
            if x == "I":
                state = lattice.AFTER[state]
                lines.append(f"{lattice.ROLE[state]}:")
                continue
            _, _, role, text = kept[k]
            k += 1
            if x == "K":
                state = lattice.KEPT[state, role[:1]]
                lines.append(f"{role}:{text}")
            elif x == "R":
                state = lattice.AFTER[state]
                lines.append(f"{lattice.ROLE[state]}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def result(spark, rows):
    frame = spark.createDataFrame([(*r, 7, "x", 1, "y") for r in rows], SCHEMA)
    columns = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = c.repair_table(frame)
    assert got.columns == list(columns)
    return sorted(map(tuple, got.collect()), key=repr)


def odd_rows(seed, conversations, longest):
    rs = random.Random(seed)
    texts = ["", " \n", "Yes.", "Yes", "No!\t", "é €?", "Why ", "a.\nb", None, "x.\x85", prose(seed, 30)]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rs.randint(1, longest)):
            turn = rs.choice([turn, turn, turn, turn + 5, turn - 3, None])
            rows += [(conv, turn, rs.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rs.choice(texts))] * rs.choice([1, 1, 1, 3])
    return rows


def test_whole_table_with_nulls_ties_and_repeated_rows(spark):
    rows = odd_rows(1, 60, 9)
    rows += [(100 + i, t, ("user", "assistant")[t % 2], f"Line {t}.") for i in range(40) for t in range(6)]
    rows += [(200, 0, "user", prose(4, 50_000)), (200, 1, "assistant", prose(5, 50_000))]  # very long texts
    rows += [(300 + i, i, "user", "Hi.") for i in range(60)]  # some lose their only row
    assert result(spark, rows) == plain(rows)


@pytest.mark.parametrize("bound", [c.BROADCAST_AGAIN, 0])
def test_a_conversation_over_many_files(spark, monkeypatch, bound):
    """A hot conversation, a row that stands very often, one text at many turns; joined by broadcast and by a shuffle."""
    monkeypatch.setattr(c, "BROADCAST_AGAIN", bound)
    rs = random.Random(7)
    rows = odd_rows(2, 10, 6)
    rows += [(5_000, t, rs.choice(["user", "assistant"]), f"Turn {t}{rs.choice(['.', ''])}") for t in range(900)]
    rows += [(6_000, t, "user", "again.") for t in range(500)]
    rows += [(7_000, 3, "assistant", "copy.")] * 400 + [(7_000, 4, "user", "end.")]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = c.placed_rows(c.conversation_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
        files = placed.where("conv_id = 5000").selectExpr("shiftright(place, 33)").distinct().count()
        assert files > 2
        assert placed.where("conv_id = 7000").count() == 2  # copies are counted, not moved
        assert result(spark, rows) == plain(rows)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_repaired_lines_alternate(spark):
    rows = odd_rows(3, 30, 8)
    frame = c.conversation_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    lines = {}
    for r in sorted(c.repair(frame).lines.collect(), key=lambda r: (r["place"], r["k"])):
        lines.setdefault(r["conv_id"], []).append(r["role"][0])
    assert lines and all(LAWFUL.fullmatch("".join(x)) for x in lines.values())
