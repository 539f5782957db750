"""Token ids in binary containers, each document compressed alone with a shared zstandard dictionary.

The dictionary is trained on the serialized ids of at most SAMPLE documents of at most SAMPLE_BYTES bytes; it
decides how small the frames get, never what they hold. Documents go to shards by ranges of doc_id, MOST_SHARDS at most,
whose cuts come from a sketch of fixed size; a shard is a row of containers of about CONTAINER_BYTES bytes, filled as
its documents pass in order, so no task holds a shard. A container is the file format below, kept as one binary value
of a Parquet table, so any store that Spark writes to can hold it and a lost task is written again.

Container, little-endian: magic "IDS1", u32 bytes per id, 32 bytes SHA-256 of the dictionary, u64 number of
documents n, i64[n] doc_ids, u64[n] numbers of ids, u64[n + 1] offsets of the frames, the frames.

Defined cases: null text counts as empty, so a document holds its end id alone; null doc_ids come first;
repeated rows are each written, those that share a doc_id to one shard; an id that does not fit the width is an error;
an empty table gives an empty result; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressrun.llm._base import lean, materialize, shuffle_parts, text_or_empty
from pressrun.llm.tokens import encoder

SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 1024, 16_384, 65_536
#: Documents of a shard, as long as shards are fewer than MOST_SHARDS; bytes of frames of a container.
DOCS, MOST_SHARDS, CONTAINER_BYTES = 10_000, 4096, 16_000_000
MAGIC, NO_ID = b"IDS1", -(1 << 63)
HEAD = struct.Struct("<4sI32sQ")


def serialize(ids: np.ndarray, width: int) -> bytes:
    if len(ids) and int(ids.max()) >= 1 << 8 * width:
        raise ValueError(f"an id of {int(ids.max())} does not fit {width} bytes")
    return ids.astype(f"<u{width}").tobytes()


def write_container(doc_ids: list[int], counts: list[int], frames: list[bytes], width: int, dictionary: bytes) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).astype("<u8")
    head = HEAD.pack(MAGIC, width, hashlib.sha256(dictionary).digest(), len(frames))
    return b"".join([head, np.array(doc_ids, "<i8").tobytes(), np.array(counts, "<u8").tobytes(), offsets.tobytes(), *frames])


class Container:
    """Reads one document at a time by its place."""

    def __init__(self, data: bytes, dictionary: bytes) -> None:
        magic, self.width, digest, n = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a container of ids")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("written with another dictionary")
        at = HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.counts = np.frombuffer(data, "<u8", n, at + 8 * n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 16 * n)
        self.start, self.data = at + 24 * n + 8, memoryview(data)
        self.reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def __len__(self) -> int:
        return len(self.counts)

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[self.start + int(self.offsets[i]) : self.start + int(self.offsets[i + 1])]
        return np.frombuffer(self.reader.decompress(frame, max_output_size=int(self.counts[i]) * self.width), f"<u{self.width}")


def train(docs: DataFrame, name: str, end_id: int, width: int) -> bytes:
    """A dictionary from a bounded sample; empty if there is too little text for one."""
    rows = docs.count()
    some = docs.where(F.octet_length("text") <= SAMPLE_BYTES)
    if rows > 2 * SAMPLE:
        some = some.where(F.pmod(F.xxhash64("doc_id"), F.lit(rows // (2 * SAMPLE))) == 0)
    texts = [r["text"] for r in some.select("text").limit(SAMPLE).collect()]  # SAMPLE * SAMPLE_BYTES bytes at most
    use = encoder(name)
    samples = [serialize(np.append(np.frombuffer(x, "<u4"), np.uint32(end_id)), width) for x in use.encode_all(texts)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, name: str = "word_bpe_49k.json", end_id: int = 1, width: int = 2) -> tuple[DataFrame, bytes]:
    """The table of containers (shard, n_docs, n_tokens, data) and the dictionary."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text_or_empty().alias("text"))
    dictionary = train(texts, name, end_id, width)

    shards = min(MOST_SHARDS, max(shuffle_parts(docs.sparkSession), docs.count() // DOCS + 1))
    ends = texts.agg(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)], 20 * MOST_SHARDS)).first()[0] or []
    sorted_ends = np.array(sorted(set(ends)), "i8")

    # Shards are named here too: a second Python function would run in other workers, each with a store of pieces.
    def compress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = encoder(name)
        writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            ids = [np.append(np.frombuffer(x, "<u4"), np.uint32(end_id)) for x in use.encode_all(batch["text"].tolist())]
            shard = np.searchsorted(sorted_ends, batch["doc_id"].to_numpy("i8"), "left")
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [len(x) for x in ids], "frame": [writer.compress(serialize(x, width)) for x in ids], "shard": shard})

    frames = texts.mapInPandas(lean(compress), "doc_id long, n_tokens long, frame binary, shard long")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, part, held, size = None, 0, [], 0

        def flush() -> pd.DataFrame:
            ids, counts, data = (list(x) for x in zip(*held))
            return pd.DataFrame({"shard": [shard], "part": [part], "n_docs": [len(held)], "n_tokens": [sum(counts)], "data": [write_container(ids, counts, data, width, dictionary)]})

        for batch in batches:
            for new, *row in zip(batch["shard"].tolist(), batch["doc_id"].tolist(), batch["n_tokens"].tolist(), batch["frame"].tolist()):
                if held and (new != shard or size >= CONTAINER_BYTES):
                    yield flush()
                    part, held, size = part + 1 if new == shard else 0, [], 0
                shard = new
                held.append(row)
                size += len(row[2])
        if held:
            yield flush()

    dealt = frames.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "n_tokens")
    return materialize(dealt.mapInPandas(lean(pack), "shard long, part long, n_docs long, n_tokens long, data binary"), "ids"), dictionary


def read(containers: DataFrame, dictionary: bytes) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the containers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, part, data in zip(batch["shard"], batch["part"], batch["data"]):
                box = Container(data, dictionary)
                counts = box.counts.astype("i8")
                crcs = [zlib.crc32(box.ids(i).astype("<u4").tobytes()) for i in range(len(box))]
                yield pd.DataFrame({"shard": shard, "part": part, "doc_id": box.doc_ids, "inside": np.cumsum(counts) - counts, "n_tokens": counts, "ids_crc32": crcs})

    rows = containers.select("shard", "part", "data").mapInPandas(run, "shard long, part long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    totals = containers.select("shard", "part", F.col("n_tokens").alias("n"))
    shards = totals.groupBy("shard").agg(F.sum("n").alias("n"))  # MOST_SHARDS rows at most
    first = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("first"))
    inside = totals.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("earlier"))
    before = inside.join(F.broadcast(first), "shard").select("shard", "part", (F.col("first") + F.col("earlier")).alias("before"))
    return rows.join(before, ["shard", "part"]).select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
