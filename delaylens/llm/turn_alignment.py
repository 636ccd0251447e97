"""Aligning turns to the alternating grammar string by Wagner-Fischer.

A conversation is well formed when its role initials read ``(s?(ua)+)?``. A
target string of that grammar is fixed by what was read before it, by its
length and by whether it opens with ``s``. Turns are aligned to each feasible
target by an edit matrix whose cells lie in Ukkonen's band: a cell off the
diagonal by more deletions or insertions than the incumbent cost pays for is
never filled. Of all cheapest alignments the backtrace takes the one with the
ASCII-least audit, and the audits of equally cheap targets are compared.

Long conversations are cut into blocks of ``BLOCK`` turns. A block is aligned
to every feasible target from each state of the grammar to each other; blocks
are joined pairwise, over the state between them, by least cost and then by
least audit. That is the same as aligning the whole: of two equally cheap
audits over the same turns and states none is the other's beginning, as the
longer one would hold more insertions.

A turn's sign is its role initial (``s``, ``u``, ``a``; ``x`` for any other), in
upper case when it is truncated, or ``D`` when it must go.
"""

from __future__ import annotations

from delaylens.llm.common import Memo

#: fixed values: cost of each edit
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
BLOCK = 8
NEVER = 1 << 60

#: cost and audit by state before and state after
Matrix = dict[tuple[int, int], tuple[int, str]]


def target(state: int, length: int, system: bool = False) -> tuple[str, int]:
    """The string of that length that the grammar reads on from ``state``, and the state after it."""
    if not length:
        return "", state
    if system:
        rest, after = target(SYSTEM, length - 1)
        return "s" + rest, after
    ua = "au" if state == USER else "ua"
    text = (ua * (length // 2 + 1))[:length]
    return text, USER if text[-1] == "u" else ASSISTANT


def least_cost(turns: int, forced: int, length: int) -> int:
    """No alignment to a target of that length is cheaper."""
    out = max(forced, turns - length)
    return DELETE * out + INSERT * (length - turns + out)


def align(turns: str, goal: str, bound: int) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest alignment, None if it costs more than ``bound``."""
    n, m = len(turns), len(goal)
    # so many deletions at most: each calls for an insertion or shortens
    out = (bound - INSERT * (m - n)) // (DELETE + INSERT)
    into = m - n + out
    if out < 0 or into < 0:
        return None
    # rest[i][j - i + out]: cost of the turns from i on against the goal from j on
    width = out + into + 1
    rest = [[NEVER] * (width + 2) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = rest[i], rest[i + 1] if i < n else None
        sign = turns[i] if i < n else ""
        kind = sign.lower()
        extra = TRUNCATED if sign != kind else 0
        for j in range(min(m, i + into), max(0, i - out) - 1, -1):
            k = j - i + out
            if below is None:
                best = 0 if j == m else NEVER
            else:
                best = below[k - 1] + DELETE if k else NEVER
            if j < m:
                want = goal[j]
                if want != "s" and row[k + 1] + INSERT < best:
                    best = row[k + 1] + INSERT
                if below is not None and sign != "D":
                    cost = below[k] + extra
                    if kind != want:
                        cost = cost + REROLE if want != "s" else NEVER
                    if cost < best:
                        best = cost
            row[k] = best
    total = rest[0][out]
    if total > bound:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        k = j - i + out
        left = rest[i][k]
        sign = turns[i] if i < n else ""
        if i < n and k and rest[i + 1][k - 1] + DELETE == left:
            audit.append("D")
            i += 1
            continue
        if j < m and goal[j] != "s" and rest[i][k + 1] + INSERT == left:
            audit.append("I")
            j += 1
            continue
        audit.append("K" if sign.lower() == goal[j] else "R")
        i += 1
        j += 1
    return total, "".join(audit)


def _within(turns: str, forced: int, goal: str, incumbent: int) -> tuple[int, str] | None:
    """The alignment, sought in bands that widen up to the incumbent's."""
    bound = least_cost(len(turns), forced, len(goal)) + REROLE + TRUNCATED
    while bound < incumbent:
        found = align(turns, goal, bound)
        if found:
            return found
        bound *= 2
    return align(turns, goal, incumbent)


def from_state(turns: str, state: int) -> Matrix:
    """Cheapest alignments of a block that begins in ``state``, to every feasible target."""
    n, forced = len(turns), turns.count("D")
    # the incumbents: nothing is kept, and what must be inserted is
    best: Matrix = {}
    for length in (0, 1, 2):
        goal, after = target(state, length)
        if (state, after) not in best:
            best[state, after] = DELETE * n + INSERT * length, "D" * n + "I" * length
    longest = n + DELETE * n // INSERT + 2
    order = sorted(range(longest + 1), key=lambda x: (least_cost(n, forced, x), x))
    for system in (False, True) if state == START else (False,):
        for length in order:
            if system and not length:
                continue
            goal, after = target(state, length, system)
            # a system turn is kept, never made: of those without an incumbent all else may go
            have = best.get((state, after), (DELETE * n + TRUNCATED + INSERT * length, "~"))
            if least_cost(n, forced, length) > have[0]:
                continue
            found = _within(turns, forced, goal, have[0])
            if found:
                best[state, after] = min(have, found)
    return best


_BLOCKS = Memo(200_000)


def block(turns: str, states: tuple[int, ...] = STATES) -> Matrix:
    out: Matrix = {}
    for s in states:
        found = _BLOCKS.get((turns, s))
        if found is None:
            found = from_state(turns, s)
            _BLOCKS.put((turns, s), found)
        out |= found
    return out


def join(a: Matrix, b: Matrix) -> Matrix:
    """Alignments of the turns of ``a`` and then those of ``b``."""
    out: Matrix = {}
    for (p, q), (cost, audit) in a.items():
        for r in STATES:
            if (q, r) in b:
                more, behind = b[q, r]
                now = out.get((p, r))
                if now is None or cost + more < now[0]:
                    out[p, r] = cost + more, audit + behind
                elif cost + more == now[0]:
                    out[p, r] = min(now, (now[0], audit + behind))
    return out


def join_all(parts: list[Matrix]) -> Matrix:
    """Parts of like size meet, so audits are copied a logarithmic number of times."""
    while len(parts) > 1:
        parts = [join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def matrix(turns: str, states: tuple[int, ...] = STATES) -> Matrix:
    """Cheapest alignments of any number of turns from the given states to every state."""
    if len(turns) <= BLOCK:
        return block(turns, states)
    first = block(turns[:BLOCK], states)
    return join_all([first, *(block(turns[i:i + BLOCK]) for i in range(BLOCK, len(turns), BLOCK))])


def repair(turns: str) -> tuple[int, str]:
    """Cost and audit of the cheapest edits that leave a well-formed conversation."""
    found = matrix(turns, (START,))
    return min(found[START, s] for s in (START, ASSISTANT) if (START, s) in found)
