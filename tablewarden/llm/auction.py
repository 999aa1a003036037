"""Cheapest edits of a conversation by an auction over a lattice, inside one task.

A node is a place before a row and what was said last: nothing, system, user or assistant. Arcs
delete, keep or rewrite the row and lead to the next place, or insert a turn and stay; all costs are
integers. Every node has a price that never exceeds any arc's cost plus the price at its other end.
A path grows from a source along arcs where that holds with equality; where it cannot grow, the price
of its last node is raised to the least that it can be, and the path gives that node up. When it
reaches a node whose price is its distance, so are the prices along the path. Sources are taken from
the end of the lattice, so paths stay short. Arcs that are tight at the end lie on cheapest paths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COSTS = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED = 3
# States: nothing, system, user or assistant was last.
STATES = range(4)
ACCEPTED = (0, 3)
_TURN = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
ROLES = {2: "user", 3: "assistant"}
# What ends a conversation from each state, and its cost.
TAILS = ("", "II", "I", "")
TAIL_COSTS = tuple(COSTS[INSERT] * len(t) for t in TAILS)
# States from which a state can be reached at all.
_REACH = ((0,), (0, 1), (0, 1, 2, 3), (0, 1, 2, 3))
_NEVER = 1 << 40
# Marks of a row: nothing wrong, cut short, to be deleted.
FINE, CUT, GONE = ".", "t", "d"


def arcs(state: int, initial: str, mark: str, inserts: bool = True) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows taken, state after) in the order of the edits' initials."""
    out = [(DELETE, COSTS[DELETE], 1, state)]
    wanted, after = _TURN[state]
    if inserts:
        out.append((INSERT, COSTS[INSERT], 0, after))
    if mark != GONE:
        more = TRUNCATED if mark == CUT else 0
        if initial == wanted:
            out.append((KEEP, COSTS[KEEP] + more, 1, after))
        elif state == 0 and initial == "s":
            out.append((KEEP, COSTS[KEEP] + more, 1, 1))
        if initial != wanted:
            out.append((REROLE, COSTS[REROLE] + more, 1, after))
    return out


_ARCS = {(q, i, m): arcs(q, i, m) for q in STATES for i in "suax" for m in (FINE, CUT, GONE)}


def prices(initials: str, marks: str, end: Sequence[int], states: Sequence[int] = STATES) -> list[list[int]]:
    """The least cost from every node to the end, whose nodes have the prices ``end``.

    ``states`` are those that matter; arcs into others are left out.
    """
    n = len(initials)
    price = [[0] * 4 for _ in range(n)] + [list(end)]
    settled = [[False] * 4 for _ in range(n)] + [[True] * 4]
    out = {k: [a for a in v if a[3] in states] for k, v in _ARCS.items()} if len(states) < 4 else _ARCS
    for source in range(n - 1, -1, -1):
        for first in reversed(states):
            path = [(source, first)]
            while not settled[path[-1][0]][path[-1][1]]:
                i, q = path[-1]
                least, at = _NEVER, None
                for _, cost, step, after in out[q, initials[i], marks[i]]:
                    value = cost + price[i + step][after]
                    if at is None or value < least:
                        least, at = value, (i + step, after)
                if price[i][q] < least:
                    price[i][q] = least
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(at)
            for i, q in path:
                settled[i][q] = True
    return price


def matrix(initials: str, marks: str) -> list[int]:
    """Least costs from each state before the rows to each state after them, 16 numbers by row."""
    columns = []
    for exit_state in STATES:
        end = [_NEVER] * 4
        end[exit_state] = 0
        reach = _REACH[exit_state]
        first = prices(initials, marks, end, reach)[0]
        columns.append([min(first[q], _NEVER) if q in reach else _NEVER for q in STATES])
    return [columns[b][a] for a in STATES for b in STATES]


def trace(initials: str, marks: str, price: list[list[int]], state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits from a state before the rows, and the state after them."""
    made, i = [], 0
    while i < len(initials):
        # An edit's initial determines its arc, so the first tight arc in order is the one to take.
        for edit, cost, step, after in _ARCS[state, initials[i], marks[i]]:
            if price[i][state] == cost + price[i + step][after]:
                made.append(edit)
                i, state = i + step, after
                break
        else:
            raise AssertionError("no arc is tight")
    return "".join(made), state


def illegal(initials: str) -> int:
    """Neighbours that cannot follow one another."""
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def matrix_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, initials, marks) in; (conv, block, matrix) out."""
    for batch in batches:
        made = [matrix(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))],
                                         ["conv", "block", "matrix"])


def end_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, blocks with matrices in order) in; (conv, block, prices behind it) out."""
    for batch in batches:
        convs, numbers, ends = [], [], []
        for conv, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            end = list(TAIL_COSTS)
            for b in reversed(blocks):
                convs.append(conv)
                numbers.append(b["block"])
                ends.append(end)
                end = np.minimum((np.array(b["matrix"]).reshape(4, 4) + np.array(end)).min(axis=1), _NEVER).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(numbers, pa.int64()),
                                          pa.array(ends, pa.list_(pa.int64()))], ["conv", "block", "end"])


def edit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, initials, marks, prices behind) in; edits, state after and cost from each state out."""
    for batch in batches:
        edits, afters, costs, wrong = [], [], [], []
        for initials, marks, end in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            price = prices(initials, marks, end)
            traced = [trace(initials, marks, price, q) for q in STATES]
            edits.append([t[0] for t in traced])
            afters.append([t[1] for t in traced])
            costs.append(price[0])
            wrong.append(illegal(initials))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(edits, pa.list_(pa.string())),
             pa.array(afters, pa.list_(pa.int32())), pa.array(costs, pa.list_(pa.int64())), pa.array(wrong, pa.int64())],
            ["conv", "block", "initials", "edits", "afters", "costs", "illegal"])


def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, edits of the row, role, text) in order in; (conv, digest of the repaired text) out.

    Only one row is held at a time.
    """
    conv, state, digest, empty = None, 0, hashlib.sha256(), True
    done: list[tuple[str, str]] = []

    def say(line: str) -> None:
        nonlocal empty
        digest.update((line if empty else "\n" + line).encode())
        empty = False

    def finish() -> None:
        for role in (("user", "assistant"), ("assistant",))[state - 1] if state in (1, 2) else ():
            say(f"{role}:")
        done.append((conv, digest.hexdigest()))

    def batch() -> pa.RecordBatch:
        rows = list(zip(*done, strict=True)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in rows], ["conv", "digest"])
    for rows in batches:
        for own, edits, role, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if own != conv:
                if conv is not None:
                    finish()
                conv, state, digest, empty = own, 0, hashlib.sha256(), True
            for edit in edits:
                if edit == DELETE:
                    continue
                after = _TURN[state][1]
                if edit == INSERT:
                    say(f"{ROLES[after]}:")
                elif edit == REROLE:
                    say(f"{ROLES[after]}:{text}")
                else:
                    say(f"{role}:{text}")
                    after = 1 if role[:1] == "s" else after
                state = after
        if len(done) > 10_000:
            yield batch()
            done.clear()
    if conv is not None:
        finish()
    yield batch()
