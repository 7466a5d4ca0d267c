"""Slabs of a batch, of bounded size, so that a Python worker never holds what it makes of a whole batch at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

SLAB_ROWS = 512
SLAB_BYTES = 2 << 20


def slabs(sizes: Iterable[int], most_rows: int | None = None) -> Iterator[tuple[int, int]]:
    """First row and number of rows of each slab, given the size of every row; a larger row is a slab of its own."""
    most_rows = most_rows or SLAB_ROWS
    first, rows, held = 0, 0, 0
    for size in sizes:
        if rows and (rows == most_rows or held + size > SLAB_BYTES):
            yield first, rows
            first, rows, held = first + rows, 0, 0
        rows, held = rows + 1, held + size
    if rows:
        yield first, rows
