"""Best-fit-decreasing packing of token ids into fixed-width rows, block by block.

A task gathers pieces up to ``block_rows`` rows' worth of ids, packs that block
and emits it, so its memory is bounded whatever the table's size and no row is
shuffled.  Within a block the longest pieces go first, each into the open row
with the least room that still fits it; a segment tree over the rooms finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from salesmart.llm.common import map_arrow, slices
from salesmart.llm.token_ids import encoder

_SCHEMA = ("sequence_id long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, "
           "n_tokens int, input_ids binary, position_ids binary")


class RoomTree:
    """Open rows by their room (0 to capacity), with search for the least room of at least some size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the tightest open row with room for ``least``."""
        count, at = self.count, self.leaves + least
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):  # up, until something lies to the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of ``lengths`` by row, each row at most ``capacity`` long; every length is 1 to capacity."""
    tree, rows = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        got = tree.take(lengths[i])
        room, row = got or (capacity, len(rows))
        if got is None:
            rows.append([])
        rows[row].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], row)
    return rows


def id_matrix(ids: bytes, width: int, dtype: str = "<u2") -> np.ndarray:
    """Rows of ``width`` ids from the binary column(s) joined together."""
    return np.frombuffer(ids, dtype).reshape(-1, width)


def packed_rows(documents: DataFrame, tokenizer: str, capacity: int = 2048, block_rows: int = 1024,
                end_id: int = 50256, pad_id: int = 50256, dtype: str = "<u2") -> DataFrame:
    """One row for each packed sequence.

    ``input_ids`` and ``position_ids`` are fixed-width rows of ``capacity``
    numbers of ``dtype`` (little-endian); concatenated they are the matrix of
    a shard.  ``cu_seqlens`` are the cumulative segment lengths from 0;
    positions restart at 0 in each segment and are 0 in the padding.
    ``doc_ids`` and ``starts`` name each segment's document and its first id
    there.  Documents over ``capacity`` ids are cut into full pieces and a rest,
    so ids in order of (doc_id, start) restore every document with its end id.
    A null or empty text is the end id alone; null ids and repeated rows are
    packed like any other.  ``dtype`` must hold every id of the vocabulary.
    """
    arrow, one = to_arrow_schema(StructType.fromDDL(_SCHEMA)), np.dtype(dtype).itemsize
    positions = np.arange(capacity).astype(dtype)

    def block(first: int, pieces: list[tuple]) -> pa.RecordBatch:
        out = {f.name: [] for f in arrow}
        for k, row in enumerate(best_fit_decreasing([len(p[2]) // one for p in pieces], capacity)):
            held = [pieces[i] for i in row]
            sizes = [len(p[2]) // one for p in held]
            used = sum(sizes)
            pad = np.full(capacity - used, pad_id, dtype).tobytes()
            place = b"".join([positions[:n].tobytes() for n in sizes]) + bytes((capacity - used) * one)
            for name, v in zip(out, (first + k, [p[0] for p in held], [p[1] for p in held],
                                     [0, *np.cumsum(sizes).tolist()], used,
                                     b"".join([p[2] for p in held]) + pad, place)):
                out[name].append(v)
        return pa.RecordBatch.from_pydict(out, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, end = encoder(tokenizer), np.array([end_id], dtype).tobytes()
        first, pieces, waiting = TaskContext.get().partitionId() << 40, [], 0
        for rows in slices(batches):
            rows = rows.to_pydict()
            encoded = tokens.encode(rows["text"])
            wide = np.frombuffer(b"".join(encoded), "<u4")
            if len(wide) and int(wide.max()) > np.iinfo(dtype).max:
                raise ValueError(f"{dtype} cannot hold the vocabulary's ids")
            narrow, stop = wide.astype(dtype).tobytes(), 0
            for doc_id, ids in zip(rows["doc_id"], encoded):
                begin, stop = stop, stop + len(ids) // 4 * one
                ids = narrow[begin:stop] + end
                for at in range(0, len(ids), capacity * one):
                    pieces.append((doc_id, at // one, ids[at:at + capacity * one]))
                    waiting += len(pieces[-1][2]) // one
                    if waiting >= block_rows * capacity:
                        done = block(first, pieces)
                        yield done
                        first, pieces, waiting = first + done.num_rows, [], 0
        if pieces:
            yield block(first, pieces)

    return map_arrow(documents.select("doc_id", "text"), run, _SCHEMA)


def write_packed(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; any reader gets a shard's matrix by joining the binary column."""
    rows.write.mode("errorifexists").parquet(path)
