"""Removal of long repeats with suffix arrays.

A byte goes if some `width`-byte string that covers it also starts in a document with a smaller doc_id.

Every window of `width` bytes is owned by one gram inside it, the least by hash (winnowing), so equal windows have
equal owners. Owners met in one document only own no repeat; only the stretches of owners met in several
documents go on, to shards by owner. Stretches that are the same string are taken once, with their least doc_id. Where
an owner has one string, its windows are settled by that; the strings of all other owners that may share a window
are joined, and their suffix array is built by induced sorting, with the permuted common prefixes: suffixes that
agree in `width` bytes form a class. All windows of a class but those of its least doc_id are removed.

Skew: exact copies of a text are settled by a count, without windows. Owners that a sample shows in many documents
are hot: they are spread over SALTS shards each, and what is left of every class there meets in a second round,
by its own bytes. The sample decides only where windows meet, never which.

Defined cases: null text has no bytes; texts shorter than `width` lose nothing; of the texts of one doc_id the one of
least SHA-256 takes part, so rows that share a doc_id never remove each other's bytes; rows with a null doc_id lose and cause nothing; an empty table gives an empty result;
columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import among, join_hot, lean, mapped, materialize, release, shuffle_parts, text_or_empty
from pressrun.llm.minhash import mix
from pressrun.llm.sais import common_prefixes, suffix_array

WIDTH, GRAM = 50, 24
SPAN = WIDTH - GRAM + 1
SALTS = 64
#: Bytes of text of one pass in a task, of one suffix array, and text that a shard of owners stands for.
PASS_BYTES, ARRAY_BYTES, SHARD_BYTES = 1_500_000, 1_000_000, 2_000_000
#: What a shard gets: runs of windows with one owner, or their strings beside records of where they stand; ranges of bytes.
MET = np.dtype([("owner", "<u4"), ("run", "<u4"), ("id", "<i8")])
STRETCH = np.dtype([("key", "<u8"), ("id", "<i8"), ("start", "<i8"), ("number", "<i4"), ("up", "<i4")])
RANGE = np.dtype([("id", "<i8"), ("lo", "<i8"), ("hi", "<i8")])
#: The run of a document that goes on for its hot owners.
WARM = (1 << 32) - 1
#: Documents in the sample for hot owners, and how many of them make an owner hot.
SAMPLE, HOT_IN_SAMPLE = 2_000, 20
BASE = 0x9E3779B97F4A7C15
_power: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _power:
        _power.clear()
        _power[size] = tuple(np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, "u8"))) for b in (np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))))
    return _power[size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    return np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * _powers(len(data))[0][: len(data)])])


def window_hashes(sums: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix((sums[start + length] - sums[start]) * _powers(len(sums))[1][start])


def owners(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one owner: number of the text, first window in it, windows, owner's hash."""
    data = np.frombuffer(b"".join(texts), "u1")
    lengths = np.array([len(x) for x in texts], "i8")
    if len(data) < WIDTH:
        return tuple(np.empty(0, t) for t in ("i8", "i8", "i8", "u8"))
    sums = prefix_hashes(data)
    n = len(data) - GRAM + 1
    ends = np.cumsum(lengths)
    all_docs = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(n) - (ends - lengths)[all_docs[:n]]  # in the text, so that runs do not depend on the batch
    least = (mix((sums[GRAM:] - sums[:-GRAM]) * _powers(len(sums))[1][:n]) & ~np.uint64(63)) | (place & 63).astype("u8")
    width = 1
    while 2 * width <= SPAN:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    window = np.arange(len(least))
    doc = all_docs[: len(window)]
    inside = window - (ends - lengths)[doc]
    owner = inside + (((least & np.uint64(63)).astype("i8") - inside) & 63)
    valid = window + WIDTH <= ends[doc]
    new = valid.copy()
    new[1:] &= (owner[1:] != owner[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    number = np.add.reduceat(valid.astype("i8"), first) if len(first) else np.empty(0, "i8")
    return doc[first], first - (ends - lengths)[doc[first]], number, least[first] >> np.uint64(6)


def records(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(next(iter(columns.values()))), kind)
    for name, values in columns.items():
        out[name] = values
    return out


def dealt(key: np.ndarray, parts: int, rows: np.ndarray, texts: Callable[[np.ndarray], bytes] | None = None, lengths: np.ndarray | None = None) -> pd.DataFrame:
    """part, data, text: the rows of each part as bytes, and their texts, in one copy of each whatever the number of parts."""
    part = (key % np.uint64(parts)).astype("i8")
    order = np.argsort(part, kind="stable")
    part = part[order]
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, "i8")
    ends = np.append(at[1:], len(part))
    data, width = rows[order].tobytes(), rows.itemsize
    out = {"part": part[at], "data": [data[a:b] for a, b in zip((at * width).tolist(), (ends * width).tolist())]}
    if texts is None:
        return pd.DataFrame(out | {"text": [b""] * len(at)})
    body, place = texts(order), np.append(0, np.cumsum(lengths[order]))
    return pd.DataFrame(out | {"text": [body[a:b] for a, b in zip(place[at].tolist(), place[ends].tolist())]})


def gathered(column: pd.Series, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def passes(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Slices of about PASS_BYTES; a longer text is alone."""
    size = batch["text"].map(len).cumsum() // PASS_BYTES
    for _, part in batch.groupby(size.to_numpy(), sort=False):
        yield part


def salted(owner: np.ndarray, ids: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key at which windows meet, and which owners are hot."""
    is_hot = np.isin(owner, hot)
    salt = mix(ids.astype("i8").view("u8")) % np.uint64(SALTS) + np.uint64(1)
    return np.where(is_hot, mix(owner + salt * np.uint64(BASE)), mix(owner)), is_hot


def find_hot(texts: DataFrame, rows: int) -> np.ndarray:
    """Owners in many documents of a sample; HOT_IN_SAMPLE bounds their number by the sample's size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in passes(batch):
                doc, _, _, owner = owners(part["text"].tolist())
                yield pd.DataFrame({"owner": owner.view("i8"), "doc": part["doc_id"].to_numpy()[doc]}).drop_duplicates()[["owner"]]

    some = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("hot")), F.lit(max(1, rows // SAMPLE))) == 0)
    found = some.mapInPandas(lean(run), "owner long").groupBy("owner").count().where(F.col("count") >= HOT_IN_SAMPLE).select("owner").collect()
    return np.array(sorted(r[0] for r in found), "i8").view("u8")


def classes(text: np.ndarray, at: np.ndarray, numbers: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For the windows of distinct strings, one after the other: the least doc_id of the window's class.

    text: bytes; string i starts at at[i], has numbers[i] windows and occurs in documents from least[i] on.
    """
    size = numbers + WIDTH - 1
    goes = np.cumsum(size + 1) - (size + 1)  # a separator follows each string
    joined = np.ones(int((size + 1).sum()) + 1, "i4")
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(goes, size) + inside] = text[np.repeat(at, size) + inside].astype("i4") + 2
    joined[-1] = 0
    sa = suffix_array(joined, 258)
    # A separator looks like byte 0 here, but windows end before one.
    shared = common_prefixes(np.where(joined < 2, 0, joined - 2).astype("u1"), sa, WIDTH)[sa] >= WIDTH
    owner = np.repeat(np.arange(len(at)), size + 1)
    window = np.arange(len(owner)) - goes[owner]
    good = np.append(window < numbers[owner], False)[sa]
    order = sa[good]
    # Between two windows of a class lie only suffixes that share its bytes, so a break anywhere between parts them.
    group = np.cumsum(~shared)[good]
    new = np.flatnonzero(np.diff(group, prepend=-1))
    low = np.empty(len(joined), "i8")
    low[order] = np.repeat(np.minimum.reduceat(least[owner[order]], new), np.diff(np.append(new, len(order))))
    row = np.repeat(np.arange(len(at)), numbers)
    return low[goes[row] + np.arange(len(row)) - np.repeat(np.cumsum(numbers) - numbers, numbers)]


def runs_of(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    start = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.empty(0, "i8")
    return start, np.diff(np.append(start, len(sorted_)))


def lows(keys: np.ndarray, text: np.ndarray, at: np.ndarray, numbers: np.ndarray, least: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """As `classes`, for distinct strings of a shard: only strings that may share a window are sorted, whole keys at a time."""
    low = np.repeat(least, numbers)
    offset = np.cumsum(numbers) - numbers
    order = np.argsort(keys, kind="stable")
    _, count = runs_of(keys[order])
    several = order[np.repeat(count > 1, count)]
    if not len(several):
        return low
    row = np.repeat(several, numbers[several])
    window = np.arange(len(row)) - np.repeat(np.cumsum(numbers[several]) - numbers[several], numbers[several])
    found = window_hashes(sums, at[row] + window, np.full(len(row), WIDTH))
    by = np.argsort(found, kind="stable")
    _, count = runs_of(found[by])
    linked = np.zeros(len(keys), bool)
    linked[row[by[np.repeat(count > 1, count)]]] = True
    several = several[linked[several]]
    if not len(several):
        return low
    start, count = runs_of(keys[several])
    block = (np.cumsum(numbers[several] + WIDTH) // ARRAY_BYTES)[np.repeat(start, count)]
    start, count = runs_of(block)
    for a, n in zip(start, count):
        some = several[a : a + n]
        here = np.repeat(offset[some], numbers[some]) + np.arange(int(numbers[some].sum())) - np.repeat(np.cumsum(numbers[some]) - numbers[some], numbers[some])
        low[here] = classes(text, at[some], numbers[some], least[some])
    return low


def settle(group: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Removed ranges of bytes by part of the documents, and the windows that go to the second round (again)."""
    rec = gathered(group["data"], STRETCH)
    keys, ids, starts, numbers, up = rec["key"], rec["id"], rec["start"], rec["number"].astype("i8"), rec["up"] > 0
    text = gathered(group["text"], np.dtype("u1"))
    lengths = numbers + WIDTH - 1
    at = np.cumsum(lengths) - lengths
    sums = prefix_hashes(text)
    content = window_hashes(sums, at, lengths) ^ mix(lengths.astype("u8") + keys)
    _, first, same = np.unique(content, return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo("i8").max)
    np.minimum.at(least, same, ids)
    low = lows(keys[first], text, at[first], numbers[first], least, sums)
    offset = np.cumsum(numbers[first]) - numbers[first]
    row = np.repeat(np.arange(len(ids)), numbers)
    window = np.arange(len(row)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    gone = low[offset[same[row]] + window] < ids[row]
    left = ~gone & up[row]
    doc, lo = ids[row[gone]], (starts[row] + window)[gone]
    order = np.lexsort((lo, doc))
    doc, lo = doc[order], lo[order]
    out = []
    if len(lo):
        new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (lo[1:] > lo[:-1] + WIDTH)))
        hi = lo[np.append(new[1:], len(lo)) - 1] + WIDTH
        out.append(dealt(mix(doc[new].view("u8")), parts, records(RANGE, id=doc[new], lo=lo[new], hi=hi)).assign(again=False))
    if left.any():
        base = (at[row] + window)[left]
        key = window_hashes(sums, base, np.full(len(base), WIDTH))
        rows = records(STRETCH, key=key, id=ids[row[left]], start=(starts[row] + window)[left], number=np.ones(len(base), "i4"), up=np.zeros(len(base), "i4"))
        out.append(dealt(key, parts, rows, lambda i: text[base[i][:, None] + np.arange(WIDTH)].tobytes(), np.full(len(base), WIDTH)).assign(again=True))
    return pd.concat(out) if out else pd.DataFrame({"part": [], "data": [], "text": [], "again": []}).astype({"again": bool})


DEALT = "part long, data binary, text binary"


def strip(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs, what is left of a text without the ranges, which may overlap."""
    if not len(lo):
        return 0, 0, text
    order = np.argsort(lo, kind="stable")
    lo, far = lo[order], np.maximum.accumulate(hi[order])
    first = np.append(True, lo[1:] > far[:-1])
    starts, ends = lo[first], far[np.append(first[1:], True)]
    kept = [text[i:j] for i, j in zip([0, *ends.tolist()], [*starts.tolist(), len(text)])]
    return int((ends - starts).sum()), len(starts), b"".join(kept)


@dataclass
class Repeats:
    """rows: doc_id, n_bytes, sha, first (least doc_id of the text) of each row; longer: doc_id, text of the texts that take
    part; spans: doc_id, lo, hi of the texts that lose bytes; aside: doc_id, mark, copy of the texts that do not take
    part, since the text occurs before or the doc_id has another one."""

    rows: DataFrame
    longer: DataFrame
    spans: DataFrame
    aside: DataFrame


def text_mark() -> Column:
    return F.xxhash64(F.unhex(F.sha2("text", 256)))


def find_repeats(docs: DataFrame) -> Repeats:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    rows = materialize(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("sha")), "repeats")
    known = rows.where("doc_id IS NOT NULL")
    groups = materialize(known.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "repeats-texts")
    figures = rows.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    total, parts = figures[0], max(shuffle_parts(spark), figures[1] // SHARD_BYTES + 1)
    placed = materialize(join_hot(known, groups, "sha", "n", total), "repeats-placed")
    long = placed.where(F.col("n_bytes") >= WIDTH)
    copies = long.where(F.col("doc_id") > F.col("first")).select("doc_id", F.xxhash64("sha").alias("mark"), F.lit(True).alias("copy"))
    several = long.groupBy("doc_id").agg(F.min("sha").alias("least"), F.max("sha").alias("most")).where("least <> most").select("doc_id", "least")
    spare = long.where("doc_id = first").join(several, "doc_id").where("sha <> least").select("doc_id", F.xxhash64("sha").alias("mark"), F.lit(False).alias("copy"))
    aside = materialize(copies.unionByName(spare).distinct(), "repeats-aside")
    some, rest = mapped(texts.where((F.octet_length("text") >= WIDTH) & F.col("doc_id").isNotNull()), aside.select("doc_id"), "doc_id")
    some = some.withColumn("mark", text_mark()).join(aside.hint("merge"), ["doc_id", "mark"], "left_anti").select("doc_id", "text")
    longer = rest.unionByName(some)
    hot = spark.sparkContext.broadcast(find_hot(longer, total))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in passes(batch):
                doc, _, _, owner = owners(part["text"].tolist())
                ids = part["doc_id"].to_numpy("i8")
                warm = np.isin(owner, hot.value)
                hot_ids = ids[np.unique(doc[warm])]
                run = (np.arange(len(doc)) - np.searchsorted(doc, doc))[~warm]
                doc, owner = doc[~warm], mix(owner[~warm])
                # Inside a part 32 bits tell owners apart; the few that they confuse only go on in vain.
                rows = records(MET, owner=np.append(owner >> np.uint64(32), np.zeros(len(hot_ids), "u8")), run=np.append(run, np.full(len(hot_ids), WARM)), id=np.append(ids[doc], hot_ids))
                yield dealt(np.append(owner & np.uint64(0xFFFFFFFF), mix(hot_ids.view("u8"))), parts, rows).drop(columns="text")

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        rec = gathered(group["data"], MET)
        warm, rec = rec["id"][rec["run"] == WARM], rec[rec["run"] != WARM]
        owner, ids, run = rec["owner"], rec["id"], rec["run"]
        order = np.argsort(owner, kind="stable")
        head, count = runs_of(owner[order])
        several = np.minimum.reduceat(ids[order], head) != np.maximum.reduceat(ids[order], head) if len(head) else np.empty(0, bool)
        keep = order[np.repeat(several, count)]
        keep = keep[np.argsort(ids[keep], kind="stable")]
        first, _ = runs_of(ids[keep])
        docs_, runs_ = ids[keep][first].tolist() + warm.tolist(), [x.tobytes() for x in np.split(run[keep], first[1:])] if len(keep) else []
        return pd.DataFrame({"doc_id": docs_, "runs": runs_ + [b""] * len(warm)})

    met = longer.mapInPandas(lean(meet), "part long, data binary").groupBy("part").applyInPandas(shared, "doc_id long, runs binary")
    runs = materialize(met.groupBy("doc_id").agg(F.collect_list("runs").alias("runs")), "repeats-runs")

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in passes(batch):
                texts_ = part["text"].tolist()
                doc, start, number, owner = owners(texts_)
                ids = part["doc_id"].to_numpy("i8")
                head = np.searchsorted(doc, np.arange(len(ids)))
                keep = np.isin(owner, hot.value)
                for d, found in enumerate(part["runs"]):
                    keep[head[d] + np.frombuffer(b"".join(found), "u4").astype("i8")] = True
                doc, start, number, owner = doc[keep], start[keep], number[keep], owner[keep]
                key, is_hot = salted(owner, ids[doc], hot.value)
                rows = records(STRETCH, key=key, id=ids[doc], start=start, number=number, up=is_hot)
                cut = lambda i: b"".join([texts_[d][a : a + w + WIDTH - 1] for d, a, w in zip(doc[i].tolist(), start[i].tolist(), number[i].tolist())])  # noqa: B023, E731
                yield dealt(key, parts, rows, cut, number + WIDTH - 1)

    def each(group: pd.DataFrame) -> pd.DataFrame:
        return settle(group, parts)

    def spans(group: pd.DataFrame) -> pd.DataFrame:
        rec = gathered(group["data"], RANGE)
        order = np.argsort(rec["id"], kind="stable")
        rec = rec[order]
        head, _ = runs_of(rec["id"])
        return pd.DataFrame({"doc_id": rec["id"][head], "lo": [x.tobytes() for x in np.split(rec["lo"], head[1:])], "hi": [x.tobytes() for x in np.split(rec["hi"], head[1:])]})

    once = among(longer, runs, "doc_id").mapInPandas(lean(stretches), DEALT).groupBy("part").applyInPandas(each, DEALT + ", again boolean")
    once = materialize(once, "repeats-once")
    again = once.where("again").drop("again").groupBy("part").applyInPandas(each, DEALT + ", again boolean")
    found = materialize(once.where("NOT again").unionByName(again).groupBy("part").applyInPandas(spans, "doc_id long, lo binary, hi binary"), "repeats-spans")

    release(runs, once)
    return Repeats(placed.select("doc_id", "n_bytes", "sha", "first").unionByName(rows.where("doc_id IS NULL").withColumn("first", F.lit(None).cast("long"))), longer, found, aside)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row."""
    found = find_repeats(docs)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [strip(t, np.frombuffer(a, "i8"), np.frombuffer(b, "i8")) for t, a, b in zip(batch["text"], batch["lo"], batch["hi"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "sha": [hashlib.sha256(t).digest() for t in batch["text"]], "n_removed": [x[0] for x in done], "n_spans": [x[1] for x in done], "kept_sha256": [hashlib.sha256(x[2]).hexdigest() for x in done]})

    trimmed = among(found.longer, found.spans, "doc_id").mapInPandas(lean(cut), "doc_id long, sha binary, n_removed long, n_spans long, kept_sha256 string")
    trimmed = materialize(trimmed.dropDuplicates(["doc_id", "sha"]), "repeats-trimmed")
    nothing = hashlib.sha256(b"").hexdigest()
    is_copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= WIDTH), F.lit(False))
    return found.rows.join(trimmed.hint("merge"), ["doc_id", "sha"], "left").select(
        "doc_id", "n_bytes",
        F.when(is_copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(is_copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(is_copy, nothing).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the texts that are left, without parts of characters. Rows that lose nothing are not shuffled."""
    found = find_repeats(docs)
    names = {c: f"own_{k}_" for k, c in enumerate(docs.columns)}
    keyed = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    losing = found.spans.select("doc_id").unionByName(found.aside.select("doc_id")).distinct()
    some, rest = mapped(keyed, losing, "doc_id")
    some = some.withColumn("mark", text_mark()).join(found.aside.hint("merge"), ["doc_id", "mark"], "left").join(found.spans.hint("merge"), "doc_id", "left")

    def cut(texts: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        return pd.Series([strip(t, np.frombuffer(a, "i8"), np.frombuffer(b, "i8"))[2].decode("utf-8", "ignore") if a is not None else t.decode() for t, a, b in zip(texts, lo, hi)])

    left = F.pandas_udf(cut, "string")("text", "lo", "hi")
    loses = F.col("copy").isNull() & F.col("lo").isNotNull() & (F.octet_length("text") >= WIDTH)
    own = F.col(names["text"])
    text = F.when(F.col("copy"), F.lit("")).when(loses, left).otherwise(own)
    new = {"text": text} | ({"n_chars": F.when(F.col("copy") | loses, F.length(text).cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col(names["n_chars"]))} if "n_chars" in docs.columns else {})
    changed = some.select(*[new.get(c, F.col(n)).alias(c) for c, n in names.items()])
    return rest.select(*[F.col(n).alias(c) for c, n in names.items()]).unionByName(materialize(changed, "repeats-changed"))


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
xs AS (SELECT doc_id, length(h) // 2 AS n, o, substr(h, 2 * o + 1, 1098) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 500)) AS o FROM d)),
b AS (SELECT doc_id, n, o, x, unnest(range(least(500, n - o))) AS q FROM xs),
win AS (SELECT doc_id, o + q AS p, substr(x, 2 * q + 1, 2) AS byte, CASE WHEN o + q + 50 <= n THEN substr(x, 2 * q + 1, 100) END AS s FROM b),
firsts AS (SELECT s, min(doc_id) AS least FROM win WHERE s IS NOT NULL GROUP BY s),
f AS (SELECT doc_id, p, byte, max(CASE WHEN least < doc_id THEN p END) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS last FROM win LEFT JOIN firsts USING (s)),
g AS (SELECT doc_id, p, byte, coalesce(p - last < 50, false) AS gone FROM f),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS new FROM g),
a AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (new) AS n_spans, string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS left_over FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(left_over, ''))) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)
"""
