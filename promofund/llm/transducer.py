"""Minimal acyclic transducers from sorted byte strings to their ordinals.

``build`` adds the terms in order and freezes a state as soon as no later term
can change it; equal frozen states are one. An arc's output is the number of
terms that leave its state by an earlier arc or end there, so the outputs along
a term's way sum to its place in the order.
"""

from __future__ import annotations

import struct
from array import array


def build(terms: list[bytes]) -> bytes:
    """The packed transducer of strictly ascending ``terms``."""
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    below: list[int] = []  # terms that can be finished from a state

    def freeze(final: bool, arcs: dict[int, int]) -> int:
        state = (final, tuple(arcs.items()))
        at = known.get(state)
        if at is None:
            at = known[state] = len(states)
            states.append(state)
            below.append(final + sum(below[t] for t in arcs.values()))
        return at

    open_arcs: list[dict[int, int]] = [{}]
    open_final = [False]
    last = b""
    for k, term in enumerate(terms):
        if k and term <= last:
            raise ValueError("terms must ascend strictly")
        same = 0
        while same < len(last) and same < len(term) and last[same] == term[same]:
            same += 1
        while len(open_arcs) > same + 1:
            at = freeze(open_final.pop(), open_arcs.pop())
            open_arcs[-1][last[len(open_arcs) - 1]] = at
        for _ in term[same:]:
            open_arcs.append({})
            open_final.append(False)
        open_final[-1] = True
        last = term
    while len(open_arcs) > 1:
        at = freeze(open_final.pop(), open_arcs.pop())
        open_arcs[-1][last[len(open_arcs) - 1]] = at
    root = freeze(open_final[0], open_arcs[0])

    first, final, labels, targets, outputs = array("i", [0]), bytearray(), bytearray(), array("i"), array("i")
    for ends, arcs in states:
        passed = int(ends)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            outputs.append(passed)
            passed += below[target]
        first.append(len(labels))
        final.append(ends)
    return struct.pack("<iii", len(states), len(labels), root) + first.tobytes() + targets.tobytes() + outputs.tobytes() + bytes(final) + bytes(labels)


class Transducer:
    """Reads a packed transducer in place."""

    def __init__(self, packed: bytes):
        n_states, n_arcs, self.root = struct.unpack_from("<iii", packed)
        at, parts = 12, []
        for n in (n_states + 1, n_arcs, n_arcs):
            parts.append(memoryview(packed)[at : at + 4 * n].cast("i"))
            at += 4 * n
        self.first, self.targets, self.outputs = parts
        self.final = packed[at : at + n_states]
        self.labels = packed[at + n_states :]

    def ordinal(self, term: bytes) -> int:
        """The term's place, or -1 if it isn't accepted."""
        first, targets, outputs, find = self.first, self.targets, self.outputs, self.labels.find
        state, out = self.root, 0
        for byte in term:
            arc = find(byte, first[state], first[state + 1])
            if arc < 0:
                return -1
            out += outputs[arc]
            state = targets[arc]
        return out if self.final[state] else -1
