"""Toxicity by nearest labelled examples under exact cosine of label-weighted TF-IDF, found with a block-max index.

Examples are labelled rows outside the held-out fold: of each label the SAMPLE rows with the least hash of doc_id
(the bound of the fitted sample). Every word of an example is a term and every example is in the index. A weight is
(1 + ln tf) * ln(1 + n / df), counted over all documents, times the word's phi coefficient with the label among the
examples (the root of chi-square for each example):
words that do not go with the label count little, and none is left out. Vectors have length one over all their words.

The examples form blocks, clusters by their most frequent terms, which part languages and kinds of text. A block keeps its
DENSE most frequent terms as a matrix with the largest weight of each term; all other weights are in postings, from which
a query's part over them is summed for every example. QUERIES texts are searched together: each meets the block of
highest bound first, and then only those blocks whose bound (their maxima, or the norms) reaches the K-th best score
found there: the K nearest are exact. Their votes, weighted by similarity and by how far
the sample thins their label out, together with a vote of weight PRIOR for the label's share, are the score.

Defined cases: null text counts as empty; a text without terms gets the share of label 1; without any
label-1 example every score is that share, and 0 without labels; labels that are null are ignored; of several labels of
a doc_id the largest counts; ties among neighbours go to the earlier example by doc_id; repeated rows are each
scored; an empty table gives an empty result; columns besides doc_id, text and toxic are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import materialize, text_or_empty
from pressrun.llm.tokens import Store

SAMPLE = 10_000
#: Blocks of examples, turns of the clustering, terms that a block keeps as a matrix, queries that are searched and summed together.
BLOCKS, TURNS, DENSE, QUERIES, FEW = 16, 8, 1024, 256, 32
#: Neighbours, weight of the prior, score of a toxic text.
K, PRIOR, THRESHOLD = 25, 0.5, 0.7
#: More than what single precision can take from a bound.
SLACK = 1e-5
WORD = re.compile(r"\w+")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Index:
    """The examples by block. columns[b] names the dense terms of block b, rows[b] holds their weights; the postings of term t
    outside the dense terms of an example's block are at[starts[t]:starts[t + 1]], with their weights."""

    terms: dict[str, int]
    value: np.ndarray
    ids: np.ndarray
    votes: np.ndarray
    labels: np.ndarray
    base: float
    edges: np.ndarray
    columns: list[np.ndarray]
    rows: list[np.ndarray]
    starts: np.ndarray
    at: np.ndarray
    weight: np.ndarray
    scores: Store = field(default_factory=lambda: Store(8_000_000))

    def __post_init__(self) -> None:
        """What follows from the fields: each process makes it anew."""
        self.starts = self.starts.astype("i4")
        self.lengths = np.diff(self.starts)
        self.column = np.full((len(self.columns), len(self.value)), -1, "i2")
        for b, terms in enumerate(self.columns):
            self.column[b, terms] = np.arange(len(terms))
        self.most = [x.max(axis=0, initial=0) for x in self.rows]
        self.norms = [float(np.sqrt((x.astype("f8") ** 2).sum(axis=1).max(initial=0))) for x in self.rows]

    def __reduce__(self) -> tuple:
        return Index, (self.terms, self.value, self.ids, self.votes, self.labels, self.base, self.edges, self.columns, self.rows, self.starts, self.at, self.weight)

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the text, term and weight of all entries of the texts' vectors."""
        return weigh(*entries(texts, self.terms), self.value, len(texts))

    def listed(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Each example's part of the cosine with each of n queries over what is in postings."""
        out = np.empty((n, len(self.ids)))
        for at in range(0, n, FEW):  # few queries at a time, whose sums stay in the cache
            some = slice(*np.searchsorted(query, [at, at + FEW]))
            lengths = self.lengths[term[some]]
            ends = np.cumsum(lengths, dtype="i4")
            found = np.arange(int(ends[-1]) if len(ends) else 0, dtype="i4") + np.repeat(self.starts[term[some]] - (ends - lengths), lengths)
            parts = self.weight[found] * np.repeat(weight[some].astype("f4"), lengths)
            goes = self.at[found] + np.repeat((query[some] - at).astype("i4") * np.int32(len(self.ids)), lengths)
            many = min(FEW, n - at)
            out[at : at + many] = np.bincount(goes, parts, many * len(self.ids)).reshape(many, -1)
        return out

    def nearest(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of n queries the K examples of highest cosine (then least doc_id) that share a term, and their cosines."""
        blocks = len(self.rows)
        if not blocks:
            return [(np.empty(0, "i8"), np.empty(0))] * n
        sums = self.listed(query, term, weight, n)
        dense, bound = [], np.empty((n, blocks))
        for b in range(blocks):
            column = self.column[b][term]
            held = np.flatnonzero(column >= 0)
            q = np.zeros((n, len(self.columns[b])), "f4")
            q[query[held], column[held]] = weight[held]
            dense.append(q)
            lists = sums[:, self.edges[b] : self.edges[b + 1]].max(axis=1)
            bound[:, b] = lists + np.minimum(q @ self.most[b], np.sqrt((q**2).sum(axis=1)) * self.norms[b]) + SLACK
        best = bound.argmax(axis=1)
        least = np.zeros(n)
        done = np.zeros((n, blocks), bool)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # Each query meets its most promising block first, then the blocks whose bound reaches what it found there.
        for turn in (0, 1):
            for b in range(blocks):
                here = np.flatnonzero(best == b if turn == 0 else ~done[:, b] & (bound[:, b] >= least))
                if not len(here):
                    continue
                own = slice(self.edges[b], self.edges[b + 1])
                scores = dense[b][here] @ self.rows[b].T
                scores += sums[here, own]
                if turn == 0:
                    done[here, b] = True
                    least[here] = kth(scores) - SLACK
                q, place = np.nonzero(scores >= np.maximum(least[here], 1e-9)[:, None].astype("f4"))
                found.append((here[q], place + self.edges[b], scores[q, place]))
        query, places, about = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-about, query))
        ends = np.searchsorted(query[order], np.arange(n + 1))
        return [self.exactly(places[order[i:j]], about[order[i:j]], sums[k], [x[k] for x in dense]) for k, (i, j) in enumerate(zip(ends, ends[1:]))]

    def exactly(self, places: np.ndarray, about: np.ndarray, sums: np.ndarray, dense: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The K best of candidates in order of nearly exact cosines, by exact ones."""
        if len(places) > K:
            places = places[about >= about[K - 1] - SLACK]
        block = np.searchsorted(self.edges, places, "right") - 1
        exact = sums[places]
        for b in np.unique(block).tolist():
            mine = block == b
            exact[mine] += (self.rows[b][places[mine] - self.edges[b]].astype("f8") * dense[b]).sum(axis=1)
        order = np.lexsort((self.ids[places], -exact))[:K]
        return places[order], exact[order]

    def score(self, texts: list[str]) -> list[tuple[float, list[int]]]:
        """Score and nearest examples of each text; equal texts are scored once. A text without neighbours gets the base."""
        self.scores.full()
        keys = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in texts]
        out = {k: self.scores[k] for k in keys if k in self.scores}
        todo = {k: x for k, x in zip(keys, texts) if k not in out}
        names = list(todo)
        for at in range(0, len(names), QUERIES):
            some = names[at : at + QUERIES]
            for key, found in zip(some, self.nearest(*self.vectors([todo[k] for k in some]), len(some))):
                out[key] = self.vote(*found)
                self.scores.keep(key, out[key], 200)
        return [out[k] for k in keys]

    def vote(self, places: np.ndarray, scores: np.ndarray) -> tuple[float, list[int]]:
        vote = scores * self.votes[places]
        value = (float((vote * self.labels[places]).sum()) + PRIOR * self.base) / (float(vote.sum()) + PRIOR)
        return min(1.0, max(0.0, value)), self.ids[places[:3]].tolist()


def entries(texts: list[str], terms: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, term and how often it occurs there, of all known terms of the texts."""
    words = [WORD.findall(x.lower()) for x in texts]
    lengths = [len(x) for x in words]
    term = np.fromiter(chain.from_iterable(map(terms.get, x, repeat(-1)) for x in words), "i8", sum(lengths))
    key = np.repeat(np.arange(len(texts)) * len(terms), lengths) + term
    key, tf = np.unique(key[term >= 0], return_counts=True)
    row = key // max(1, len(terms))
    return row, key - row * len(terms), tf


def kth(scores: np.ndarray) -> np.ndarray:
    """The K-th largest value of each row; 0 if there are fewer."""
    return np.partition(scores, -K, axis=1)[:, -K] if scores.shape[1] >= K else np.zeros(len(scores))


def weigh(row: np.ndarray, term: np.ndarray, tf: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of the entries of any weight, as n vectors of length one."""
    weight = (1 + np.log(tf)) * value[term]
    held = np.flatnonzero(weight > 0)
    row, term, weight = row[held], term[held], weight[held]
    return row, term, weight / np.sqrt(np.bincount(row, weight * weight, n))[row]


def examples(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, toxic, text of the bounded sample, and the number of training labels of each kind."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = materialize(known, "labels")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # one row a label
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(SAMPLE).unionByName(known.where("toxic = 0").orderBy(*order).limit(SAMPLE))
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE rows at most
    return materialize(texts.dropDuplicates(["doc_id"]), "examples"), totals


def fit(docs: DataFrame, labels: DataFrame) -> Index:
    sample, totals = examples(docs, labels)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = (Counter(), Counter())
            for toxic, text in zip(batch["toxic"], batch["text"]):
                found[int(toxic == 1)].update(set(WORD.findall(text.lower())))
            words = list(found[0].keys() | found[1].keys())
            yield pd.DataFrame({"word": words, "clean": [found[0][w] for w in words], "toxic": [found[1][w] for w in words]})

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n = sizes.get(1, 0), sum(sizes.values())
    base = totals.get(1, 0) / max(1, sum(totals.values()))
    words = sample.mapInPandas(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    # The words of 2 * SAMPLE texts at most.
    found = words.toArrow().to_pandas().sort_values("word", ignore_index=True) if 0 < n1 < n else pd.DataFrame({"word": [], "c": [], "t": []})
    terms = {w: i for i, w in enumerate(found["word"])}
    a, df = found["t"].to_numpy("f8"), (found["t"] + found["c"]).to_numpy("f8")
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(known.value), "i8")
        for batch in batches:
            texts = batch["text"].tolist()
            for at in range(0, len(texts), QUERIES):
                counts += np.bincount(entries(texts[at : at + QUERIES], known.value)[1], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"term": some, "n": counts[some]})

    every = np.zeros(len(terms))
    if terms:
        spreads = docs.select(text_or_empty().alias("text")).mapInPandas(spread, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # one row a term
        every[spreads["term"].to_numpy()] = spreads["n"]
    value = np.log(1 + docs.count() / np.maximum(every, 1)) * phi(a, df, n1, n)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [sorted(Counter(map(known.value.get, WORD.findall(x.lower()))).items()) for x in batch["text"]] if known.value else [[] for _ in batch["text"]]
            pairs = [np.array(r, "i4").reshape(-1, 2) for r in rows]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [p[:, 0].tobytes() for p in pairs], "tf": [p[:, 1].tobytes() for p in pairs]})

    rows = sample.mapInPandas(project, "doc_id long, toxic int, terms binary, tf binary").toArrow().to_pandas().sort_values("doc_id")  # 2 * SAMPLE rows at most
    term, tf = (np.frombuffer(b"".join(rows[c]), "i4") for c in ("terms", "tf"))
    row = np.repeat(np.arange(len(rows)), [len(x) // 4 for x in rows["terms"]])
    thinned = {k: totals[k] / max(1, sizes.get(k, 0)) for k in totals}
    return build(rows["doc_id"].to_numpy("i8"), rows["toxic"].to_numpy("i8"), *weigh(row, term.astype("i8"), tf, value, len(rows)), terms, value, base, thinned)


def phi(a: np.ndarray, df: np.ndarray, n1: int, n: int) -> np.ndarray:
    """How far a word in df of n examples, a of n1 toxic ones, goes with the label or against it: 0 to 1."""
    gap, spread = np.abs(a * n - df * n1), df * (n - df) * n1 * (n - n1)
    return np.divide(gap, np.sqrt(spread), out=np.zeros(len(df)), where=spread > 0)


def cluster(rows: np.ndarray) -> np.ndarray:
    """A number below BLOCKS for each row: spherical k-means from far apart rows."""
    rows = rows / np.maximum(np.sqrt((rows**2).sum(axis=1, keepdims=True)), 1e-12)
    centres = [rows[0]]
    near = rows @ centres[0]
    while len(centres) < min(BLOCKS, len(rows)):
        centres.append(rows[int(near.argmin())])
        near = np.maximum(near, rows @ centres[-1])
    middle = np.stack(centres)
    for _ in range(TURNS):
        own = (rows @ middle.T).argmax(axis=1)
        middle = np.stack([rows[own == k].sum(axis=0) if (own == k).any() else middle[k] for k in range(len(middle))])
        middle /= np.maximum(np.sqrt((middle**2).sum(axis=1, keepdims=True)), 1e-12)
    return own


def build(ids: np.ndarray, labels: np.ndarray, of: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: dict[str, int], value: np.ndarray, base: float, thinned: dict[int, float]) -> Index:
    """An index of the examples with these ids and labels; of, term and weight are the entries of their vectors."""
    n, weight = len(ids), weight.astype("f4")
    often = np.bincount(term, minlength=len(value))
    # Blocks are clusters by the most frequent terms.
    common = np.argsort(-often, kind="stable")[:DENSE]
    column = np.full(len(value), -1)
    column[common] = np.arange(len(common))
    rows = np.zeros((n, len(common)), "f4")
    held = column[term] >= 0
    rows[of[held], column[term[held]]] = weight[held]
    block = cluster(rows) if n else np.empty(0, "i8")
    order = np.lexsort((ids, block))
    place = np.empty(n, "i8")
    place[order] = np.arange(n)
    names, numbers = np.unique(block, return_counts=True)
    edges = np.append(0, np.cumsum(numbers))
    columns, dense, listed = [], [], np.ones(len(term), bool)
    for b, name in enumerate(names):
        mine = np.flatnonzero(block[of] == name)
        count = np.bincount(term[mine], minlength=len(value))
        own = np.argsort(-count, kind="stable")[:DENSE]
        own = np.sort(own[count[own] > 1])
        column[:] = -1
        column[own] = np.arange(len(own))
        mine = mine[column[term[mine]] >= 0]
        rows = np.zeros((numbers[b], len(own)), "f4")
        rows[place[of[mine]] - edges[b], column[term[mine]]] = weight[mine]
        listed[mine] = False
        columns.append(own)
        dense.append(rows)
    term, weight, at = term[listed], weight[listed], place[of[listed]].astype("i4")
    by = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[by], np.arange(len(value) + 1))
    labels = labels.astype("f8")[order]
    return Index(terms, value, ids[order], np.array([thinned.get(int(x), 1.0) for x in labels]), labels, base, edges, columns, dense, starts, at[by], weight[by])


def score(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of each row; no shuffle. The index has a bounded size."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = shared.value
        for batch in batches:
            found = use.score(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": [x[0] for x in found], "predicted": [int(x[0] >= THRESHOLD) for x in found], "evidence": [x[1] for x in found]})

    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, score double, predicted int, evidence array<long>")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
