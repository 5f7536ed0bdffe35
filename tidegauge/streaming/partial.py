"""Rows reduced within the tasks that read them, before they are shuffled by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

#: Reduced rows that a task holds; beyond them it passes on what it has.
HELD_ROWS = 50_000


def reduced(reduce: Callable[[pa.Table], pa.Table], held_rows: int | None = None) -> Callable:
    """For ``mapInArrow``: what ``reduce`` makes of a task's rows, for at most ``held_rows`` at once.

    ``reduce`` gives fewer rows of the same columns, and the same of its own results put together
    as of all their rows at once. A task that reads many rows of few groups so passes on a row or
    two for each, and one whose rows are all of different groups holds no more than its bound.
    """
    bound = HELD_ROWS if held_rows is None else held_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new = None, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            new.append(batch)
            # Waits for as many new rows as are held: each row is reduced a bounded number of times.
            if sum(part.num_rows for part in new) >= (held.num_rows if held is not None else 0):
                held, new = _merged(reduce, held, new), []
                if held.num_rows > bound:
                    yield from held.to_batches()
                    held = None
        if new:
            held = _merged(reduce, held, new)
        if held is not None:
            yield from held.to_batches()

    return run


def _merged(reduce: Callable, held: pa.Table | None, new: list[pa.RecordBatch]) -> pa.Table:
    """In the order in which the rows came."""
    table = pa.Table.from_batches(new)
    return reduce(table if held is None else pa.concat_tables([held, table])).combine_chunks()
