"""Cheapest edits of a conversation: bidirectional Dijkstra over its edit lattice.

A node is (rows used up, state); the state tells which role initials may
follow so that all of them match ``(s?(ua)+)?``.  Edges carry one letter:
Keep (0), Rerole to user or assistant (3), Delete (4), Insert a user or
assistant before a row (3); a truncated row that stays adds 3.  From a state a
letter leads to one state only, so the letters tell the whole repair.

``shortest`` grows a forward and a reverse heap until the sum of their least
costs is above the best crossing, so that every crossing edge of that cost is
known, and picks the least of the concatenated letters.

Long conversations are cut into blocks.  Inserts stand before a row only
(those after the last row are in ``TAIL``), so of two ways through a block
neither string of letters begins with the other, and costs and the order of
the strings are all that a chain of blocks needs (``Summary``): its size is
fixed, however long the stretch it stands for.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by Insert and Rerole
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# what ends the lattice: cost and letters behind the last row
TAIL = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
BLOCK = 256

# a row as the lattice sees it: (role initial, truncated, must go)
Step = tuple[str, bool, bool]
Exits = dict[int, tuple[int, str]]
Way = tuple[int, str]
GOAL = (-1, -1)


def edges_out(steps: list[Step], node: tuple[int, int], exits: Exits):
    """(next node, cost, letters) of every edge out of ``node``."""
    i, q = node
    if i == len(steps):
        if q in exits:
            yield GOAL, *exits[q]
        return
    initial, truncated, must_go = steps[i]
    yield (i, AFTER[q]), INSERT, "I"
    yield (i + 1, q), DELETE, "D"
    if not must_go:
        extra = TRUNCATED if truncated else 0
        yield (i + 1, AFTER[q]), REROLE + extra, "R"
        if (q, initial) in KEPT:
            yield (i + 1, KEPT[q, initial]), extra, "K"


def edges_in(steps: list[Step], node: tuple[int, int], exits: Exits):
    """(previous node, cost) of every edge into ``node``."""
    if node == GOAL:
        for q, (cost, _) in exits.items():
            yield (len(steps), q), cost
        return
    i, q = node
    if i < len(steps):
        for p in STATES:
            if AFTER[p] == q:
                yield (i, p), INSERT
    if i == 0:
        return
    initial, truncated, must_go = steps[i - 1]
    yield (i - 1, q), DELETE
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for p in STATES:
            if AFTER[p] == q:
                yield (i - 1, p), REROLE + extra
            if KEPT.get((p, initial)) == q:
                yield (i - 1, p), extra


def shortest(steps: list[Step], entry: int, exits: Exits) -> Way | None:
    """Least cost from ``entry`` to an exit, and the least letters of that cost; None if there is no way."""
    start = (0, entry)
    forward, reverse = {start: 0}, {GOAL: 0}
    from_start, from_goal = {}, {}  # settled
    heap_f, heap_r = [(0, start)], [(0, GOAL)]
    best = None
    while heap_f and heap_r and (best is None or heap_f[0][0] + heap_r[0][0] <= best):
        ahead = GOAL in from_goal and heap_f[0][0] <= heap_r[0][0]
        heap, known, settled, other = (heap_f, forward, from_start, reverse) if ahead else (heap_r, reverse, from_goal, forward)
        cost, node = heapq.heappop(heap)
        if node in settled:
            continue
        settled[node] = cost
        if node == GOAL and ahead:
            continue
        for edge in edges_out(steps, node, exits) if ahead else edges_in(steps, node, exits):
            to, total = edge[0], cost + edge[1]
            if total < known.get(to, total + 1):
                known[to] = total
                heapq.heappush(heap, (total, to))
            if to in other and (best is None or total + other[to] < best):
                best = total + other[to]
    if best is None:
        return None
    before = _letters_before(steps, exits, start, from_start)
    behind = _letters_behind(steps, exits, from_goal)
    return best, min(
        before[v] + letters + behind[w]
        for v in from_start
        if v != GOAL
        for w, cost, letters in edges_out(steps, v, exits)
        if w in from_goal and from_start[v] + cost + from_goal[w] == best
    )


def _letters_before(steps, exits, start, settled) -> dict[tuple[int, int], str]:
    """Least letters from the start to each settled node, among the ways of its cost."""
    found = {start: ""}
    for v in sorted(settled, key=lambda v: (settled[v], v == GOAL, v[0])):
        if v == GOAL:
            continue
        for w, cost, letters in edges_out(steps, v, exits):
            if settled.get(w) == settled[v] + cost:
                found[w] = min(found.get(w, "~"), found[v] + letters)
    return found


def _letters_behind(steps, exits, settled) -> dict[tuple[int, int], str]:
    """Least letters from each settled node to the goal, among the ways of its cost."""
    found = {GOAL: ""}
    for v in sorted(settled, key=lambda v: (settled[v], v != GOAL, -v[0])):
        if v != GOAL:
            found[v] = min(
                letters + found[w] for w, cost, letters in edges_out(steps, v, exits) if settled.get(w, -1) + cost == settled[v] and w in found
            )
    return found


def transitions(steps: list[Step]) -> dict[tuple[int, int], Way]:
    """Best way through a block between every pair of states that has one."""
    ways = {(p, q): shortest(steps, p, {q: (0, "")}) for p in STATES for q in STATES}
    return {pair: way for pair, way in ways.items() if way is not None}


@dataclass(frozen=True)
class Summary:
    """A stretch of rows: per pair of states the least cost, and per entry the order of the ways' letters."""

    cost: dict[tuple[int, int], int]
    rank: dict[tuple[int, int], int]


def summary_of(ways: dict[tuple[int, int], Way]) -> Summary:
    rank = {}
    for p in STATES:
        rank |= {pair: k for k, pair in enumerate(sorted((x for x in ways if x[0] == p), key=lambda x: ways[x][1]))}
    return Summary({pair: cost for pair, (cost, _) in ways.items()}, rank)


def joined(a: Summary, b: Summary) -> Summary:
    """The summary of two stretches, one behind the other."""
    cost, key = {}, {}
    for p, m in a.cost:
        for n, q in b.cost:
            if m == n:
                option = (a.cost[p, m] + b.cost[m, q], a.rank[p, m], b.rank[m, q])
                if (p, q) not in key or (option[0], option[1:]) < (cost[p, q], key[p, q]):
                    cost[p, q], key[p, q] = option[0], option[1:]
    rank = {}
    for p in STATES:
        rank |= {pair: k for k, pair in enumerate(sorted((x for x in key if x[0] == p), key=key.get))}
    return Summary(cost, rank)


def states_between(parts: list[Summary], entry: int, exits: Exits) -> tuple[int, list[int]]:
    """Least cost through the parts and the state in front of each part and behind the last one."""
    best: dict[int, tuple[int, int | None]] = {q: (cost, None) for q, (cost, _) in exits.items()}
    tables = [best]
    for part in reversed(parts):
        options: dict[int, tuple[int, int, int]] = {}
        for (p, q), cost in part.cost.items():
            if q in best:
                option = (cost + best[q][0], part.rank[p, q], q)
                options[p] = min(options.get(p, option), option)
        best = {p: (cost, q) for p, (cost, _, q) in options.items()}
        tables.append(best)
    tables.reverse()
    states = [entry]
    for table in tables[:-1]:
        states.append(table[states[-1]][1])
    return tables[0][entry][0], states


def blocks(steps: list[Step], size: int = BLOCK) -> list[list[Step]]:
    return [steps[i : i + size] for i in range(0, len(steps), size)]


def stretch_summary(steps: list[Step], size: int = BLOCK) -> Summary:
    whole = None
    for block in blocks(steps, size):
        part = summary_of(transitions(block))
        whole = part if whole is None else joined(whole, part)
    return whole


def repair(steps: list[Step], entry: int = START, exits: Exits = TAIL, size: int = BLOCK) -> Way:
    """Least cost and letters of the rows, which may be a stretch of a conversation."""
    if len(steps) <= size:
        return shortest(steps, entry, exits)
    ways = [transitions(block) for block in blocks(steps, size)]
    cost, states = states_between([summary_of(w) for w in ways], entry, exits)
    letters = [w[p, q][1] for w, p, q in zip(ways, states, states[1:])]
    return cost, "".join(letters) + exits[states[-1]][1]
