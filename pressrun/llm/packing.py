"""Vector best-fit packing of token sequences.

Every bin has three capacities: tokens, documents and attention cost (the sum of squared lengths). Pieces are
placed longest first; among the open bins that hold a piece under every constraint, the one whose weighted
residual norm is least afterwards (or whose weighted dot-product is largest) takes it.

All pieces of one length are alike, so the plan is made on their counts by length: `capacity` numbers, whatever
the size of the corpus. It says, for the pieces of each length in order of rank, which bins they go to; pieces
get their rank from counts by block, and are never gathered.

Defined cases: null text counts as empty and gives one piece, the end id; repeated rows are each packed; rows
with a null doc_id are packed like others; an empty table gives an empty result; columns besides doc_id and text
are not read. Only documents above `capacity` tokens are cut; their first piece takes what is left over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressrun.llm._base import lean, materialize, shuffle_parts, text_or_empty
from pressrun.llm.tokens import encoder

#: Documents of one block, in which ranks are counted.
BLOCK_ROWS = 50_000


@dataclass(frozen=True)
class Capacities:
    tokens: int = 2048
    documents: int = 2048
    #: Sum of squared lengths; the square of `tokens` never binds.
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    measure: str = "norm"

    def __post_init__(self) -> None:
        if self.measure not in ("norm", "dot"):
            raise ValueError("measure is norm or dot")
        if min(self.tokens, self.documents) < 1 or self.attention < self.tokens**2:
            raise ValueError("a piece of full length must fit into an empty bin")


def plan(counts: dict[int, int], cap: Capacities = Capacities()) -> tuple[pd.DataFrame, int]:
    """Placements of pieces by length, and the number of bins.

    A row (size, lo, first, each, offset): of the pieces of this size, ranks from lo on go to bins from `first` on,
    `each` to a bin, from `offset` on. Bins filled alike are one class, so every step places many pieces.
    """
    full = np.array([cap.tokens, cap.documents, cap.attention], "f8")
    weights = np.array(cap.weights)
    bins, rows = 0, []
    left, first, number = np.empty((0, 3)), np.empty(0, "i8"), np.empty(0, "i8")
    for size in sorted(counts, reverse=True):
        need, todo, done = np.array([size, 1, size * size], "f8"), counts[size], 0
        while todo:
            fits = (left >= need).all(axis=1) if len(left) else np.empty(0, bool)
            if fits.any():
                at = np.flatnonzero(fits)
                if cap.measure == "norm":
                    best = at[np.argmin((weights * ((left[at] - need) / full) ** 2).sum(axis=1))]
                else:
                    best = at[np.argmax((weights * (left[at] / full) * (need / full)).sum(axis=1))]
                each = int(min(left[best] // need))
                each, many = (each, min(int(number[best]), todo // each)) if todo >= each else (todo, 1)
                rows.append((size, done, int(first[best]), each, int(cap.tokens - left[best][0])))
                rest = left[best] - each * need
                if many == number[best]:
                    left[best] = rest
                else:
                    left, number = np.vstack([left, rest]), np.append(number, many)
                    first = np.append(first, first[best])
                    first[best] += many
                    number[best] -= many
            else:
                each = int(min(full // need))
                each, many = (each, todo // each) if todo >= each else (todo, 1)
                rows.append((size, done, bins, each, 0))
                left, first, number = np.vstack([left, full - each * need]), np.append(first, bins), np.append(number, many)
                bins += many
            done += each * many
            todo -= each * many
        open_ = left[:, 0] > 0
        left, first, number = left[open_], first[open_], number[open_]
    return pd.DataFrame(rows, columns=["size", "lo", "first", "each", "offset"]), bins


def pieces_of(tokens: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document; all but the first are full."""
    more = -(-tokens // capacity) - 1
    return [tokens - more * capacity, *[capacity] * more]


def encode(docs: DataFrame, name: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, n_tokens and the CRC-32 of each piece."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use, end = encoder(name), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            counts, crcs = [], []
            for ids in use.encode_all(batch["text"].tolist()):
                ids += end
                lengths = pieces_of(len(ids) // 4, capacity)
                ends = np.cumsum(lengths) * 4
                counts.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[b - 4 * n : b]) for n, b in zip(lengths, ends)])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": counts, "crcs": crcs})

    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(lean(run), f"doc_id {kind}, n_tokens long, crcs array<long>")


def pack(docs: DataFrame, name: str = "byte_bpe_50k.json", end_id: int = 0, cap: Capacities = Capacities()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    spark, kind, size = docs.sparkSession, dict(docs.dtypes)["doc_id"], cap.tokens
    stored = materialize(encode(docs, name, end_id, size), "packing")
    blocks = max(shuffle_parts(spark), stored.count() // BLOCK_ROWS + 1)
    rows = stored.withColumn("block", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(blocks)).cast("int"))
    more = F.size("crcs") - 1
    by_block = (
        rows.select("block", F.inline(F.array(F.struct((F.col("n_tokens") - size * more).cast("int").alias("size"), F.lit(1).cast("long").alias("n")), F.struct(F.lit(size).alias("size"), more.cast("long").alias("n")))))
        .where("n > 0").groupBy("block", "size").agg(F.sum("n").alias("n"))
    )
    counted = materialize(by_block, "packing-counts")
    before = counted.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("block")) - F.col("n"))
    totals = {r["size"]: r["n"] for r in counted.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # `capacity` rows at most
    placements, _ = plan(totals, cap)
    if placements.empty:
        placements = placements.astype("i8")
    # One search finds size and rank together: sizes apart by more than any rank.
    span = max(totals.values(), default=0) + 1
    placements = placements.sort_values(["size", "lo"])
    keys = (placements["size"] * span + placements["lo"]).to_numpy("i8")
    table = spark.sparkContext.broadcast((keys, placements.to_numpy("i8")))

    def place(docs_: pd.DataFrame, before_: pd.DataFrame) -> pd.DataFrame:
        docs_ = docs_.sort_values(["doc_id", "n_tokens"], kind="stable")
        n = docs_["crcs"].map(len).to_numpy("i8")
        doc = np.repeat(np.arange(len(docs_)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        head = docs_["n_tokens"].to_numpy("i8") - size * (n - 1)
        length = np.where(piece == 0, head[doc], size)
        rank = pd.Series(length).groupby(length).cumcount().to_numpy("i8") + pd.Series(length).map(before_.set_index("size")["before"]).to_numpy("i8")
        keys_, rows_ = table.value
        found = rows_[np.searchsorted(keys_, length * span + rank, "right") - 1] if len(doc) else np.empty((0, 5), "i8")
        inside = rank - found[:, 1]
        return pd.DataFrame({
            "doc_id": docs_["doc_id"].to_numpy()[doc], "piece": piece, "start": np.where(piece == 0, 0, head[doc] + (piece - 1) * size), "length": length,
            "ids_crc32": np.concatenate(docs_["crcs"].tolist()) if len(doc) else [], "sequence_id": found[:, 2] + inside // found[:, 3], "offset": found[:, 4] + inside % found[:, 3] * length,
        })

    return rows.groupBy("block").cogroup(before.select("block", "size", "before").groupBy("block")).applyInPandas(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
