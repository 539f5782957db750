"""Links between items: equal URLs, equal titles, similar titles.

Items with one value form a class named after its least item. A class of n items stands for n (n - 1) / 2 links, and a
pair of similar titles for the product of their classes: nothing lists these links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pressrun.config import ClusterConfig
from pressrun.functions.text import numbered_grams, rounded
from pressrun.operators.graph import join_groups, stored
from pressrun.operators.graph import with_position as positions

EDGE = ["item_a", "item_b", "type", "confidence", "score"]
#: The most frequent grams, which come last in the order of a prefix; the others are in order of their hashes.
FREQUENT = 65_536
#: Blocks of texts by size, texts that make a block worth while, bits of the shortest sketch, and rows that a tile compares at once.
BLOCKS, LEAST_BLOCK, LEAST_BITS, STEP, WIDE = 64, 2_000, 512, 64, 4_096
#: Characters of texts whose grams a task keeps while it scores pairs.
HELD = 1_000_000


def classes(items: DataFrame, column: str) -> DataFrame:
    """Of each non-null value: the least id that has it and how many have it."""
    return items.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("id").alias("class_id"), F.count("*").alias("n"))


def members(items: DataFrame, column: str) -> DataFrame:
    """id, class_id, n_links of every item with a value: its class and how many others have the value."""
    named = items.where(F.col(column).isNotNull()).select("id", column)
    met = join_groups(named, classes(items, column), column, "n", items.count())
    return met.select("id", "class_id", (F.col("n") - 1).alias("n_links"))


def ranked_grams(rows: DataFrame, key: str, text: Column, ngram: int) -> DataFrame:
    """key, g: the numbered grams of each text, rare ones first, in one order for all texts."""
    posted = stored(numbered_grams(rows, key, text, ngram))
    frequent = posted.groupBy("gram").agg(F.count("*").alias("df")).orderBy(F.desc("df"), "gram").limit(FREQUENT)
    weighed = posted.join(F.broadcast(frequent), "gram", "left").select(key, F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram").alias("x"))
    return weighed.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["gram"]).alias("g"))


def _grams(text: str, ngram: int) -> np.ndarray:
    """The grams of a text as sorted numbers, the whole text if it is shorter."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = min(ngram, len(codes))
    found = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):  # Three code points fit into 63 bits.
        found = (found << np.uint64(21) if ngram <= 3 else found * np.uint64(0x9E3779B97F4A7C15)) + codes[k : k + len(found)]
    found.sort()
    return found


def _numbered(grams: np.ndarray) -> np.ndarray:
    """Sorted grams hashed with their occurrence numbers, so that multisets are sets."""
    at = np.arange(len(grams), dtype=np.uint64)
    first = np.maximum.accumulate(np.where(np.r_[True, grams[1:] != grams[:-1]], at, np.uint64(0)))
    h = grams * np.uint64(0x9E3779B97F4A7C15) + (at - first + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def gram_sets(rows: DataFrame, key: str, text: str, ngram: int) -> DataFrame:
    """key, grams: the numbered grams of each text in no order of rarity, without a shuffle."""

    def made(batches):
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "grams": [_numbered(_grams(t, ngram)).view(np.int64) for t in batch[text]]})

    return rows.select(key, text).mapInPandas(made, f"{key} string, grams array<long>")


def _sketch_bits(n: int, spread: int = 1) -> int:
    """Bits for n grams: a power of two, about `spread` times as many as grams."""
    return max(LEAST_BITS, spread << (n // 2).bit_length())


def sketches(texts: DataFrame, ngram: int, spread: int = 1) -> DataFrame:
    """id, n, sketch: how many grams a text has, and the parity of their number in each of some buckets.

    Low thresholds allow more differences, which only a wider spread tells from chance: `spread` is a power of two. Tags, where texts have them, go along.

    Two sketches differ in at most as many bits as their texts have different grams. The halves of a sketch, added
    without carry, are the sketch of half as many buckets.
    """

    def made(batches):
        for batch in batches:
            ns, out = [], []
            for t in batch["t"]:
                h = _numbered(_grams(t, ngram))
                bits = _sketch_bits(len(h), spread)
                counts = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
                ns.append(len(h))
                out.append(np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes())
            yield pd.DataFrame({"id": batch["id"], "n": ns, "sketch": out} | {c: batch[c] for c in tags})

    tags = [c for c in texts.columns if c == "tags"]
    return texts.select("id", "t", *tags).mapInPandas(made, "id string, n long, sketch binary" + ", tags array<long>" * len(tags))


def _sharing(left: pd.DataFrame, right: pd.DataFrame, least: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Of places p in left and q in right: which pairs share `least` tags."""
    n_x, n_y = (side["tags"].map(len).to_numpy(np.int64) for side in (left, right))
    tags = np.concatenate([np.zeros(0, np.int64), *left["tags"], *right["tags"]]).astype(np.int64)
    kinds, codes = np.unique(tags, return_inverse=True)
    first, x, y = np.cumsum(n_x) - n_x, codes[: n_x.sum()], codes[n_x.sum() :]
    held = np.append(np.sort(np.repeat(np.arange(len(right)), n_y) * len(kinds) + y), -1)

    def share(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        n = n_x[p]
        pair = np.repeat(np.arange(len(p)), n)
        asked = q[pair] * len(kinds) + x[np.arange(n.sum()) + np.repeat(first[p] - np.cumsum(n) + n, n)]
        return np.bincount(pair[held[np.searchsorted(held[:-1], asked)] == asked], minlength=len(p)) >= least

    return share


def _words(rows: pd.DataFrame, bits: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to `bits`."""
    out = np.empty((len(rows), bits // 64), np.uint64)
    sizes = rows["sketch"].map(len).to_numpy()
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        part = np.frombuffer(b"".join(rows["sketch"].iloc[at]), np.uint64).reshape(len(at), -1)
        while part.shape[1] > out.shape[1]:
            half = part.shape[1] // 2
            part = part[:, :half] ^ part[:, half:]
        out[at] = part
    return out


def _levels(rows: pd.DataFrame, reach: float):
    """From `bits` to sketches folded to them, of the rows with so many bits up to `reach` times as many, and the place of the first; each is made once.

    rows: in order of n, so those of one length follow each other.
    """
    sizes = 8 * rows["sketch"].map(len).to_numpy()
    made: dict[int, tuple[int, np.ndarray]] = {}

    def level(bits: int) -> tuple[int, np.ndarray]:
        if bits not in made:
            first, end = np.searchsorted(sizes, [bits, bits * reach + 1])
            made[bits] = int(first), _words(rows.iloc[first:end], bits)
        return made[bits]

    return sizes, level


def _near_sketches(left: pd.DataFrame, right: pd.DataFrame, low: float, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in left and right, both in order of n, of pairs whose sketches and sizes allow Dice >= low, some at a time. own: both are one table, each pair once.

    A few rows are compared at once with those of sizes that go with theirs, by the bits of the shortest sketch among these and not of the whole tile:
    long texts folded to the bits of much shorter ones would all pass.
    """
    ratio, i = low / (2 - low), 0
    # Rows with as many bits have up to twice as many grams, so partners have up to 2 / ratio times as many bits.
    (bits_a, words_a), (bits_b, words_b) = _levels(left, 2 / ratio), _levels(right, 2 / ratio)
    n_a, n_b = left["n"].to_numpy(), right["n"].to_numpy()
    while i < len(n_a):
        stop = min(i + STEP, int(np.searchsorted(bits_a, bits_a[i], "right")))
        n_x = n_a[i:stop]
        start, end = np.searchsorted(n_b, n_x[0] * ratio - 1e-9), np.searchsorted(n_b, n_x[-1] / ratio + 1e-9, "right")
        start = max(start, i) if own else start
        j = start
        while j < end:
            last = min(end, j + WIDE, int(np.searchsorted(bits_b, bits_b[j], "right")))
            bits = int(min(bits_a[i], bits_b[j]))
            (from_a, x), (from_b, y) = words_a(bits), words_b(bits)
            x, y, n_y = x[i - from_a : stop - from_a], y[j - from_b : last - from_b], n_b[j:last]
            limit = np.floor((n_x[:, None] + n_y[None, :]) * (1 - low) + 1e-6).astype(np.int64)
            apart = np.zeros(limit.shape, np.uint16 if bits < 1 << 16 else np.uint32)
            for w in range(x.shape[1]):
                apart += np.bitwise_count(x[:, None, w] ^ y[None, :, w])
            p, q = np.nonzero((apart <= limit) & (np.abs(n_x[:, None] - n_y[None, :]) <= limit))
            if own:
                p, q = (z[p + i < q + j] for z in (p, q))
            if len(p):
                yield p + i, q + j
            j = last
        i = stop


def _sides(tile: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The two blocks of a tile in order of n, and whether they are one."""
    i, j = divmod(int(tile["tile"].iloc[0]), BLOCKS)
    left, right = (tile[tile["block"] == k].sort_values("n", kind="stable").reset_index(drop=True) for k in (i, j))
    return left, right, i == j


def _dealt(texts: DataFrame, low: float, ngram: int, spread: int = 1) -> DataFrame:
    """id, n, sketch, block, tile: texts in BLOCKS blocks of sizes that follow each other, and in a tile for any two blocks whose sizes may go together."""
    ratio = low / (2 - low)
    rows = stored(sketches(texts, ngram, spread))
    blocks = max(1, min(BLOCKS, rows.count() // LEAST_BLOCK))
    cuts = rows.agg(F.percentile_approx("n", [k / blocks for k in range(1, blocks)], 10_000)).first()[0] if blocks > 1 else []
    cuts = sorted(set(cuts))  # block k holds sizes over cuts[k - 1], up to cuts[k]
    least, most = [0, *[c + 1 for c in cuts]], [*cuts, float("inf")]
    tiles: list[list[int]] = [[] for _ in least]
    for j in range(len(least)):
        for i in range(j + 1):
            if i == j or least[j] * ratio <= most[i] + 1e-6:
                for k in {i, j}:
                    tiles[k].append(i * BLOCKS + j)
    block = sum((F.when(F.col("n") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    of_block = F.array(*[F.array(*[F.lit(t) for t in x]) for x in tiles])
    return rows.withColumn("block", block).withColumn("tile", F.explode(F.get(of_block, F.col("block"))))


def sketched_pairs(texts: DataFrame, threshold: float, ngram: int = 3, spread: int = 1, least: int = 0) -> DataFrame:
    """id_a < id_b: all pairs that reach the threshold, and few others. Where texts have tags (numbers, each once), only pairs that share `least` of them.

    A tile compares sketches, so what is sent is a few sketches a text and the number of comparisons is the only thing that grows
    with the square of the texts.
    """
    low = threshold - 0.00005

    def compared(tile: pd.DataFrame) -> pd.DataFrame:
        left, right, own = _sides(tile)
        found = _near_sketches(left, right, low, own)
        if "tags" in tile.columns:
            share = _sharing(left, right, least)
            found = ((p[kept_], q[kept_]) for p, q in found for kept_ in [share(p, q)])
        found = list(found)
        p, q = (np.concatenate(z) for z in zip(*found)) if found else ([], [])
        a, b = left["id"].to_numpy(object)[p], right["id"].to_numpy(object)[q]
        less = np.array([x < y for x, y in zip(a, b)], bool)
        return pd.DataFrame({"id_a": np.where(less, a, b), "id_b": np.where(less, b, a)}, dtype=object)

    return _dealt(texts, low, ngram, spread).groupBy("tile").applyInPandas(compared, "id_a string, id_b string")


def connecting_pairs(texts: DataFrame, threshold: float, ngram: int = 3) -> DataFrame:
    """texts: id, t (distinct). Pairs id_a < id_b whose rounded multiset Dice reaches the threshold, no more than connect all that such pairs connect.

    A tile leaves out pairs that its earlier ones connect already, so n similar texts are at most n - 1 rows of it and no pair is listed
    before it is known to count. Texts go only to tiles in which their sketch has a partner.
    """
    low = threshold - 0.00005
    kept = texts.where("t <> ''").select("id", "t")

    def partnered(tile: pd.DataFrame) -> pd.DataFrame:
        left, right, own = _sides(tile)
        met = [np.zeros(len(x), bool) for x in (left, right)]
        for p, q in _near_sketches(left, right, low, own):
            met[0][p], met[1][q] = True, True
        some = left[met[0] | met[1]] if own else pd.concat([left[met[0]], right[met[1]]])
        return some[["tile", "block", "id", "n", "sketch"]]

    def connected(tile: pd.DataFrame) -> pd.DataFrame:
        left, right, own = _sides(tile)
        texts_ = [*left["t"], *([] if own else right["t"])]
        ids, shift, out = [*left["id"], *([] if own else right["id"])], 0 if own else len(left), []
        grams, root = _Grams(ngram), np.arange(len(ids))
        for p, q in _near_sketches(left, right, low, own):
            while (root != root[root]).any():
                root = root[root]
            q = q + shift
            open_ = root[p] != root[q]
            for x, y in zip(p[open_].tolist(), q[open_].tolist()):
                a, b = _root(root, x), _root(root, y)
                if a != b:
                    shared, total = grams.shared(texts_[x], texts_[y])
                    if np.floor(2.0 * shared / total * 10000 + 0.5) / 10000 >= threshold:
                        root[max(a, b)] = min(a, b)
                        out.append(sorted((ids[x], ids[y])))
        return pd.DataFrame(out, columns=["id_a", "id_b"], dtype=object)

    some = stored(_dealt(kept, low, ngram).groupBy("tile").applyInPandas(partnered, "tile int, block int, id string, n long, sketch binary"))
    return some.join(kept, "id").groupBy("tile").applyInPandas(connected, "id_a string, id_b string")


def _root(root: np.ndarray, x: int) -> int:
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return int(x)


class _Grams:
    """The grams of the texts that were compared last, of about HELD characters."""

    def __init__(self, ngram: int) -> None:
        self.ngram, self.known, self.held = ngram, {}, 0

    def shared(self, a: str, b: str) -> tuple[int, int]:
        """How many grams two texts share, and how many they have."""
        for t in (a, b):
            if t not in self.known:
                self.known[t] = _numbered(_grams(t, self.ngram))
                self.held += len(t)
        x, y = self.known[a], self.known[b]
        if self.held > HELD:
            self.known, self.held = {}, 0
        return len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)


@F.pandas_udf(DoubleType())
def text_dice(a: pd.Series, b: pd.Series) -> pd.Series:
    """The multiset Dice of trigrams of two texts; null where one is null."""
    grams = _Grams(3)
    return pd.Series([None if x is None or y is None else 2.0 * (found := grams.shared(x, y))[0] / found[1] for x, y in zip(a, b)], dtype=float)


def dice_pairs(texts: DataFrame, threshold: float, ngram: int = 3, spread: int = 1, least: int = 0) -> DataFrame:
    """texts: id, t (distinct), and tags if pairs must share `least` of them. Pairs id_a < id_b whose rounded multiset Dice reaches the threshold, with their score."""
    kept = texts.where("t <> ''")
    met = stored(sketched_pairs(kept, threshold, ngram, spread, least))
    sides = met.join(kept.select(F.col("id").alias("id_a"), F.col("t").alias("t_a")), "id_a").join(kept.select(F.col("id").alias("id_b"), F.col("t").alias("t_b")), "id_b")

    def scored(batches):
        grams = _Grams(ngram)
        for batch in batches:
            found = [grams.shared(a, b) for a, b in zip(batch["t_a"], batch["t_b"])]
            yield pd.DataFrame({"id_a": batch["id_a"], "id_b": batch["id_b"], "shared": [x[0] for x in found], "total": [x[1] for x in found]})

    counted = sides.mapInPandas(scored, "id_a string, id_b string, shared long, total long")
    return counted.select("id_a", "id_b", rounded(2.0 * F.col("shared") / F.col("total")).alias("score")).where(F.col("score") >= threshold)


def title_ties(items: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """item_a < item_b: the least items of similar titles, as few as connect all that `similar_titles` connects."""
    titles = stored(classes(items.where(F.length("title_norm") >= config.min_length), "title_norm").select(F.col("class_id").alias("id"), F.col("title_norm").alias("t")))
    return connecting_pairs(titles, config.threshold, config.ngram).withColumnsRenamed({"id_a": "item_a", "id_b": "item_b"})


def similar_titles(items: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """item_a < item_b: the least items of two similar titles, the score, and n_links, how many pairs of items they stand for."""
    titles = stored(classes(items.where(F.length("title_norm") >= config.min_length), "title_norm"))
    pairs = dice_pairs(titles.select(F.col("class_id").alias("id"), F.col("title_norm").alias("t")), config.threshold, config.ngram)
    a, b = (titles.select(F.col("class_id").alias(f"id_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    return pairs.join(a, "id_a").join(b, "id_b").select(F.col("id_a").alias("item_a"), F.col("id_b").alias("item_b"), "score", (F.col("n_a") * F.col("n_b")).alias("n_links"))


def relationships(items: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """All typed links in classes. items: id, title_norm, url_norm.

    same-url and same-title: a row from the least item of a class to each other one; title-similarity: a row for two
    titles, between their least items.
    """
    none = F.lit(None).cast("double")
    star = lambda column: members(items, column).where("id <> class_id").select(F.col("class_id").alias("item_a"), F.col("id").alias("item_b"))
    by_url = star("url_norm").select("item_a", "item_b", F.lit("same-url").alias("type"), F.lit(config.same_url_confidence).alias("confidence"), none.alias("score"))
    by_title = star("title_norm").select("item_a", "item_b", F.lit("same-title").alias("type"), F.lit(config.same_title_confidence).alias("confidence"), none.alias("score"))
    similar = similar_titles(items, config).select("item_a", "item_b", F.lit("title-similarity").alias("type"), F.col("score").alias("confidence"), "score")
    return by_url.unionByName(by_title).unionByName(similar)


def link_counts(items: DataFrame, roots: DataFrame | None = None, config: ClusterConfig = ClusterConfig(), similar: DataFrame | None = None) -> DataFrame:
    """type, n_links; with `roots` (id, root) by root too, counting links inside one root only. Sums over classes, no pair is listed.

    similar: `similar_titles` of the items, where they are known.
    """
    by = ["root"] if roots is not None else []
    placed = items.join(roots, "id") if roots is not None else items
    out = []
    for column, kind in (("url_norm", "same-url"), ("title_norm", "same-title")):
        sizes = placed.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n"))
        out.append(sizes.select(*by, F.lit(kind).alias("type"), (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("n_links")))
    similar = similar_titles(items, config) if similar is None else similar
    if roots is not None:  # Similar titles are long enough to form a cluster, so their classes lie in one.
        similar = similar.join(roots.select(F.col("id").alias("item_a"), "root"), "item_a")
    out.append(similar.select(*by, F.lit("title-similarity").alias("type"), "n_links"))
    return out[0].unionByName(out[1]).unionByName(out[2]).groupBy(*by, "type").agg(F.sum("n_links").alias("n_links")).where("n_links > 0")


def with_position(edges: DataFrame) -> DataFrame:
    order = F.when(F.col("type") == "same-url", 0).when(F.col("type") == "same-title", 1).otherwise(2)
    return positions(edges, [order, F.col("item_a"), F.col("item_b")])
