"""Digests of sorted lists of ids, without a list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressrun.operators.graph import stored

#: Bytes of ids that a task holds before it passes them on.
CHUNK = 1_000_000


def list_digests(rows: DataFrame, separator: str, chunk: int = CHUNK) -> DataFrame:
    """rows: root, id. root, n, sha: the number of ids of each root, and the SHA-256 (hex) of them in order, joined by a separator.

    Rows are sorted by (root, id) in ranges, and the state of a hash goes along the rows of a range, so that no list is
    made. A root whose rows lie in one range is done there. One that goes on in the next range, or has more
    than `chunk` bytes, passes its ids on in pieces, which meet in order in a second pass: a root of a third of all rows is
    sorted by all tasks, and the one that ends its hash reads pieces, not rows, and holds one at a time.
    """
    parts, joint = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), separator.encode()
    ranged = rows.select("root", "id").repartitionByRange(parts, "root", "id").sortWithinPartitions("root", "id")
    names = ["root", "sha", "n", "range_no", "piece_no", "piece"]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, now, held, size, n, piece_no, whole = TaskContext.get().partitionId(), None, [], 0, 0, 0, False
        out: list[tuple] = []

        def passed() -> tuple:
            return now, None, len(held), range_no, piece_no, joint.join(held)

        for batch in batches:
            for root, id_ in zip(batch.column("root").to_pylist(), batch.column("id").to_pylist()):
                if root != now:
                    if now is not None:
                        done = whole and piece_no == 0
                        out.append((now, hashlib.sha256(joint.join(held)).hexdigest(), n, None, None, None) if done else passed())
                    whole = now is not None  # the first root of a range may have begun before it
                    now, held, size, n, piece_no = root, [], 0, 0, 0
                if size > chunk:
                    out.append(passed())
                    held, size, piece_no = [], 0, piece_no + 1
                held.append(id_.encode())
                size += len(held[-1]) + len(joint)
                n += 1
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], SCHEMA)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, passed()))], SCHEMA)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, n = None, hashlib.sha256(), 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["root"] != now:
                    if now is not None:
                        out.append({"root": now, "sha": state.hexdigest(), "n": n})
                    now, state, n = row["root"], hashlib.sha256(), 0
                else:
                    state.update(joint)
                state.update(row["piece"])
                n += row["n"]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("root", pa.string()), ("sha", pa.string()), ("n", pa.int64())]))
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"root": now, "sha": state.hexdigest(), "n": n}])

    found = stored(ranged.mapInArrow(first, "root string, sha string, n long, range_no int, piece_no int, piece binary"))
    pieces = found.where("sha IS NULL").repartition(F.col("root")).sortWithinPartitions("root", "range_no", "piece_no")
    late = pieces.select("root", "n", "piece").mapInArrow(second, "root string, sha string, n long")
    return found.where("sha IS NOT NULL").select("root", "n", "sha").unionByName(late.select("root", "n", "sha"))


SCHEMA = pa.schema([("root", pa.string()), ("sha", pa.string()), ("n", pa.int64()), ("range_no", pa.int32()), ("piece_no", pa.int32()), ("piece", pa.binary())])
