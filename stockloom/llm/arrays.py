"""SQL expressions over arrays, linear in the array's length."""

from __future__ import annotations

BLOCK = 256


def running(array: str, start: str, step: str) -> str:
    """For each element, the fold of the ones before it.

    ``step`` folds ``acc`` with element ``v``; ``start`` is the fold of nothing. It goes by
    blocks, as appending to an array copies it: with n elements, n * BLOCK are copied.
    """
    blocks = (
        f"transform(sequence(0, greatest(size({array}) - 1, 0) div {BLOCK}),"
        f" k -> slice({array}, k * {BLOCK} + 1, {BLOCK}))"
    )
    folded = f"transform({blocks}, x -> aggregate(x, {start}, (acc, v) -> {step}))"
    empty = f"filter(array({start}), z -> false)"
    at = step.replace("acc", "s.at")

    def prefix(values: str, base: str) -> str:
        return (
            f"aggregate({values}, named_struct('at', {base}, 'out', {empty}), (s, v) ->"
            f" named_struct('at', {at}, 'out', array_append(s.out, s.at)), s -> s.out)"
        )

    pairs = f"zip_with({blocks}, {prefix(folded, start)}, (x, b) -> named_struct('x', x, 'b', b))"
    return f"flatten(transform({pairs}, p -> {prefix('p.x', 'p.b')}))"
