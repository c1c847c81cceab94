"""Weighted finite-state transducers as data: composition, and the best path through a composed table."""

from __future__ import annotations

from typing import NamedTuple

# In a machine's arcs: every input without an arc of its own in that state; as an output: the input itself.
OTHER = "*"


class Arc(NamedTuple):
    state: str
    read: str
    write: str
    next: str
    weight: float = 0.0


class Transducer:
    """Arcs from ``start`` over the symbols ``reads``; several arcs of one state and symbol are alternatives.

    A state's OTHER arc serves the symbols for which it has no arc. A symbol without any arc ends the path.
    """

    def __init__(self, start: str, reads: list[str], arcs: list[Arc]):
        self.start, self.reads = start, reads
        named: dict[tuple[str, str], list[Arc]] = {}
        for arc in arcs:
            named.setdefault((arc.state, arc.read), []).append(arc)
        states = dict.fromkeys([start, *(arc.state for arc in arcs), *(arc.next for arc in arcs)])
        self.arcs: dict[tuple, list[tuple[str, object, float]]] = {}
        for state in states:
            for symbol in reads:
                found = named.get((state, symbol)) or named.get((state, OTHER), [])
                self.arcs[state, symbol] = [
                    (symbol if arc.write == OTHER else arc.write, arc.next, arc.weight) for arc in found
                ]


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``: pairs of states, weights added."""
    out = object.__new__(Transducer)
    out.start, out.reads, out.arcs = (first.start, second.start), first.reads, {}
    todo = [out.start]
    seen = set(todo)
    while todo:
        state = todo.pop()
        for symbol in first.reads:
            found = [
                (write, (a, b), w + v)
                for middle, a, w in first.arcs[state[0], symbol]
                for write, b, v in second.arcs[state[1], middle]
            ]
            out.arcs[state, symbol] = found
            for _, arrived, _ in found:
                if arrived not in seen:
                    seen.add(arrived)
                    todo.append(arrived)
    return out


def best_path(
    machine: Transducer, start: object, symbols: list[str], amounts: list[float]
) -> tuple[list[tuple[str, float]], object] | None:
    """What the path of the greatest score writes, with the symbols' amounts, and where it ends.

    A path's score is the sum of its arc weights times the amounts of the symbols they read. One step
    keeps the best path to each state, so time grows with the symbols. Ties go to the path met first.
    """
    arcs = machine.arcs
    alive: dict = {start: (0.0, None)}
    for symbol, amount in zip(symbols, amounts):
        following: dict = {}
        for state, (score, trail) in alive.items():
            for write, arrived, weight in arcs[state, symbol]:
                reached = score + weight * amount
                if arrived not in following or reached > following[arrived][0]:
                    # Symbols that carry no amount leave no trail.
                    following[arrived] = (reached, (trail, write, amount) if weight else trail)
        alive = following
    if not alive:
        return None
    state = max(alive, key=lambda s: alive[s][0])
    written, trail = [], alive[state][1]
    while trail is not None:
        trail, write, amount = trail
        written.append((write, amount))
    return written[::-1], state
