"""Operators on small tables: defined cases, and brute force on a fixture."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from pressrun.llm import _base, bpe, exact, graph, html, minhash, packing, quality, sharding, suffix, token_output, tokens, toxicity

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("shard", T.StringType()), T.StructField("key", T.StringType())])
WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "é")]


def make(seed: int, n: int = 60) -> list[tuple]:
    """Originals, exact and near copies, passages in common, and odd rows; extra columns clash with inner names."""
    rnd = random.Random(seed)
    passage = " ".join(rnd.choice(WORDS) for _ in range(60))
    rows = [(0, None, "en", None, None), (1, "", "en", "a", 0), (2, " \n\t", "en", "a", 3), (3, "one", "en", "a", 3), (4, "x" * 120, "en", "b", 120)]
    for i in range(5, n):
        kind, words = rnd.random(), [rnd.choice(WORDS) for _ in range(rnd.randint(1, 120))]
        if kind < 0.2:
            text = rows[rnd.randrange(len(rows))][1] or ""
        elif kind < 0.4:
            words = (rows[rnd.randrange(len(rows))][1] or "q").split(" ")
            words[rnd.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind < 0.6:
            text = " ".join(words) + "\n" + passage + "\n" + " ".join(words[:5])
        else:
            text = " ".join(words)
        rows.append((i, text, "en", rnd.choice("abc"), len(text)))
    rows.append((n, " ".join(rnd.choice(WORDS) for _ in range(6000)), "en", "a", 1))
    return [(*r, "s", "k") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make(1), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def doubled(spark):
    """Repeated rows and a null id."""
    rows = make(2, 12)
    return spark.createDataFrame(rows + rows[5:7] + [(None, rows[6][1], "en", "a", 1, "s", "k")], SCHEMA)


@pytest.fixture(params=[512, 1])
def hot_share(request, monkeypatch):
    """512 takes every group of two of a fixture as hot, 1 none."""
    for m in (_base, sharding):
        monkeypatch.setattr(m, "HOT_SHARE", request.param)


def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


RUNS = {
    "quality": quality.judge, "exact": exact.dedup, "bpe": bpe.encode_decode, "suffix": suffix.remove_repeats, "ids": lambda d: token_output.read(*token_output.write(d)),
    "minhash": minhash.group, "packing": packing.pack, "sharding": sharding.shard,
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_tables(name, empty):
    assert RUNS[name](empty).count() == 0


@pytest.mark.parametrize("name", RUNS)
def test_repeated_rows_and_null_ids(name, doubled):
    found = RUNS[name](doubled)
    assert (found.where("piece = 0") if name == "packing" else found).count() == doubled.count()


def words(text):
    return text.translate(str.maketrans("\t\n\x0b\f\r", "     ")).split(" ")


def test_quality_figures(docs):
    for r in quality.judge(docs).collect():
        text = texts(docs)[r["doc_id"]]
        ws = [w for w in words(text) if w]
        windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
        counts, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if counts[w] > 1:
                covered.update(range(i, i + 8))
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
        assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"], r["word_chars"]) == (len(ws), len(covered), len(lines) - len(set(lines)), sum(map(len, ws)))
        assert r["base_failed"] == (len(ws) < 20 or 100 * len(covered) > 30 * len(ws))


def test_quality_rejects_hosts_that_mostly_fail(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "short"
    rows = [(i, bad if i % 10 else good, "en", "poor", 1, "", "") for i in range(200)] + [(1000 + i, good, "en", f"fine{i % 5}", 1, "", "") for i in range(200)]
    kept = {r["doc_id"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).where("kept").collect()}
    assert kept == set(range(1000, 1200))


def test_exact_rows_without_an_id_never_win(spark):
    rows = [(1, "a b"), (None, "a  b "), (None, "ab"), (2, "ab"), (None, "x"), (None, " x"), (3, "y"), (3, "y ")]
    found = exact.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["kept"]) for r in found) == [(0, 0, True), (0, 0, True), (0, 1, False), (0, 1, False), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)]


def test_exact_takes_ids_of_any_type(spark):
    found = exact.dedup(spark.createDataFrame([("b", "t"), ("a", "t"), ("c", "t ")], "doc_id string, text string")).collect()
    assert {r["keep_id"] for r in found} == {"c"}


def test_exact_groups(docs):
    full = texts(docs)
    groups = {}
    for i, t in full.items():
        groups.setdefault("".join(words(t)), []).append(i)
    for r in exact.dedup(docs).collect():
        own = groups["".join(words(full[r["doc_id"]]))]
        keep = min(own, key=lambda i: (-len(full[i]), i))
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(own), r["doc_id"] == keep)


@pytest.mark.parametrize("size", [16_000_000, 500])
def test_encoding_of_a_table(docs, size, monkeypatch):
    monkeypatch.setattr(token_output, "CONTAINER_BYTES", size)
    library, full = Tokenizer.from_file(tokens.path("word_bpe_49k.json")), texts(docs)
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in full.items()}
    for r in bpe.encode_decode(docs).collect():
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids[r["doc_id"]])).encode()).hexdigest()
    start = 0
    for r in token_output.read(*token_output.write(docs)).orderBy("doc_id").collect():
        own = [*ids[r["doc_id"]], 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def brute_repeats(full):
    first, out = {}, {}
    for i in sorted(full):
        data = full[i].encode()
        for s in range(len(data) - 49):
            first.setdefault(data[s : s + 50], i)
    for i, t in full.items():
        data = t.encode()
        gone = [False] * len(data)
        for s in range(len(data) - 49):
            if first[data[s : s + 50]] < i:
                gone[s : s + 50] = [True] * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


def brute_left(full, i):
    """The text of document i without its repeats and what is left of characters that they cut."""
    seen = {full[j].encode()[s : s + 50] for j in full if j < i for s in range(len(full[j].encode()) - 49)}
    data = full[i].encode()
    gone = {p for s in range(len(data) - 49) if data[s : s + 50] in seen for p in range(s, s + 50)}
    return bytes(c for p, c in enumerate(data) if p not in gone).decode("utf-8", "ignore")


@pytest.mark.parametrize("hot", [2, 10_000])
def test_repeats_equal_brute_force(docs, hot, monkeypatch, hot_share):
    monkeypatch.setattr(suffix, "HOT_IN_SAMPLE", hot)
    want = brute_repeats(texts(docs))
    for r in suffix.remove_repeats(docs).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


def brute_near(full, k):
    sets = {}
    for i, t in full.items():
        ws = [w for w in words(t.encode().lower().decode()) if w]
        sets[i] = {tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)} if len(ws) >= k else {tuple(ws)} if ws else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for a in names:
        for b in names:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(docs, k, hot_share):
    want = brute_near(texts(docs), k)
    for r in minhash.group(docs, minhash.NearDup(shingle=k)).collect():
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(201, 200), (203, 200), (203, 202)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 160)) and all(found[i] == 200 for i in range(200, 204))


def test_packing_is_gapless_and_whole(docs):
    library = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in texts(docs).items()}
    found = packing.pack(docs).toPandas()
    assert found["length"].sum() == sum(map(len, ids.values()))
    for r in found.itertuples():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    for _, g in found.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == (g["length"].cumsum() - g["length"]).to_numpy()).all() and g["length"].sum() <= 2048


def test_shards_are_level_and_keep_groups(docs, hot_share):
    found, full = sharding.shard(docs).toPandas(), texts(docs)
    # Every group of equal texts fits a shard here, so the least cut, by brute force over any dealing, is none.
    kept = found.assign(text=found["doc_id"].map(full)).groupby("text")["shard"].nunique()
    room = len(full) // 8
    sizes = Counter(full.values())
    assert all(kept[t] == 1 for t, n in sizes.items() if 1 < n <= room // 2), kept[kept > 1]
    counts = found["shard"].value_counts()
    assert counts.max() - counts.min() <= 1 and set(found["shard"]) <= set(range(8))
    for _, g in found.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    for r in found.itertuples():
        assert (r.size, r.text_crc32) == (len(full[r.doc_id].encode()) + 1, zlib.crc32(full[r.doc_id].encode()))


def test_toxicity_learns_words_and_takes_odd_texts(spark, empty):
    rnd = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        ws = [rnd.choice(WORDS) for _ in range(20)] + (["vileword", "badword"] if toxic else ["niceword"])
        rows.append((i, " ".join(ws), "en", "a", 1, "", ""))
        labels.append((i, int(toxic)))
    rows += [(900, None, "en", "a", 1, "", ""), (901, "", "en", "a", 1, "", "")]
    d, y = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.classify(d, y).collect()}
    assert len(found) == 402 and all(found[i]["predicted"] == int(i % 4 == 0) for i in range(400))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert 0 <= found[900]["score"] == found[901]["score"] < 0.7
    assert toxicity.classify(empty, y.limit(0)).count() == 0
    assert toxicity.classify(d, y.limit(0)).where("score > 0").count() == 0


@pytest.mark.parametrize("times", [2, 3])
def test_shards_of_a_table_made_of_copies(spark, times):
    n = 60_000
    copies = spark.range(n).selectExpr("id AS doc_id", f"concat('text ', id % {n // times}) AS text")
    found = sharding.shard(copies)
    counts = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
    uncut = found.withColumn("text", F.col("doc_id") % (n // times)).groupBy("text").agg(F.countDistinct("shard").alias("s")).where("s = 1").count()
    assert uncut >= 0.9 * (n // times), uncut / (n // times)


def labelled(spark, extra):
    """300 documents of random words, each fifth toxic by one of two insults, and extra ones: doc_id, text, label or None."""
    rnd = random.Random(3)
    rows = [(i, " ".join([*(rnd.choice(WORDS) for _ in range(20)), *([rnd.choice(["vileword", "badword"])] if i % 5 == 0 else [])]), int(i % 5 == 0)) for i in range(300)] + extra
    d = spark.createDataFrame([(i, t, "en", "a", 1, "", "") for i, t, _ in rows], SCHEMA)
    return d, spark.createDataFrame([(i, y) for i, _, y in rows if y is not None], "doc_id long, toxic int")


def test_toxicity_weighs_every_word_of_every_example(spark):
    rnd = random.Random(4)
    long = " ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(3000))
    d, y = labelled(spark, [(1000 + k, " ".join(long.split(" ")[k::20]), 0) for k in range(20)] + [(2000, long + " badword", None)])
    index = toxicity.fit(d, y)
    trained = {r["doc_id"] for r in y.where(~toxicity.held_out()).collect()}
    assert set(index.ids.tolist()) == trained
    texts_ = {r["doc_id"]: r["text"] for r in d.collect()}
    assert set(index.terms) == {w for i in trained for w in texts_[i].split(" ")}
    assert toxicity.score(d, index).where("doc_id = 2000").first()["score"] < toxicity.THRESHOLD
    # The nearest by the index are those of all cosines.
    dense = np.zeros((len(index.ids), len(index.terms)))
    for t in range(len(index.terms)):
        run = slice(index.starts[t], index.starts[t + 1])
        dense[index.at[run], t] = index.weight[run]
    for b, columns in enumerate(index.columns):
        dense[index.edges[b] : index.edges[b + 1], columns] = index.rows[b]
    assert np.allclose((dense**2).sum(axis=1), 1, atol=1e-5)
    row, term, weight = index.vectors([texts_[i] for i in (3, 5, 1001, 2000)])
    for k, (_, found) in enumerate(index.nearest(row, term, weight, 4)):
        best = np.sort(dense[:, term[row == k]] @ weight[row == k])[::-1][: toxicity.K]
        assert np.allclose(found, best[best > 0], atol=1e-6)


def test_toxicity_equals_brute_force_on_a_table(spark):
    """Vectors, neighbours and votes from the definition, without an index; copies and rows of one id are each scored."""
    d, y = labelled(spark, [(7000 + i, "vileword " + WORDS[i], 1) for i in range(5)] + [(8000, None, None), (8001, "vileword", None), (8001, "vileword", None)])
    full = [(r["doc_id"], r["text"] or "") for r in d.collect()]
    train = {r["doc_id"]: r["toxic"] for r in y.where(~toxicity.held_out()).collect()}
    bags = {i: Counter(t.lower().split()) for i, t in full}
    n, n1 = len(train), sum(train.values())
    spread = Counter(w for i, t in full for w in set(t.lower().split()))
    df, a = Counter(), Counter()
    for i, label in train.items():
        df.update(bags[i].keys())
        a.update(bags[i].keys() if label else [])
    value = {w: np.log(1 + len(full) / spread[w]) * abs(a[w] * n - df[w] * n1) / np.sqrt(df[w] * (n - df[w]) * n1 * (n - n1)) if df[w] < n else 0.0 for w in df}

    def vector(bag):
        v = {w: (1 + np.log(k)) * value[w] for w, k in bag.items() if value.get(w)}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    known = {i: vector(bags[i]) for i in train}
    for r in toxicity.classify(d, y).collect():
        q = vector(bags[r["doc_id"]])
        cosines = sorted(((sum(x * known[i].get(w, 0.0) for w, x in q.items()), -i) for i in train), reverse=True)[: toxicity.K]
        total = sum(c for c, _ in cosines)
        want = (sum(c * train[-i] for c, i in cosines) + toxicity.PRIOR * n1 / n) / (total + toxicity.PRIOR) if q else n1 / n
        assert abs(r["score"] - want) < 1e-4, (r["doc_id"], r["score"], want)


def test_toxicity_counts_documents_over_the_whole_table(spark):
    d, y = labelled(spark, [(6000 + i, "vileword", None) for i in range(500)])
    index = toxicity.fit(d, y)
    trained = {r["doc_id"]: r["toxic"] for r in y.where(~toxicity.held_out()).collect()}
    have = {r["doc_id"] for r in d.collect() if "vileword" in r["text"].split(" ")}
    a, df, n1, n = sum(trained[i] for i in have & set(trained)), len(have & set(trained)), sum(trained.values()), len(trained)
    want = np.log(1 + d.count() / len(have)) * toxicity.phi(np.array([float(a)]), np.array([float(df)]), n1, n)[0]
    assert np.isclose(index.value[index.terms["vileword"]], want)


def test_toxicity_keeps_rare_insults(spark):
    rnd = random.Random(5)
    learnt = [i for i in range(4000, 4100) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    text = lambda: " ".join([rnd.choice(WORDS) for _ in range(10)] + ["rareslur"])
    d, y = labelled(spark, [(i, text(), 1) for i in learnt] + [(5000, text(), None), (5001, text().replace("rareslur", "unseen"), None)])
    found = {r["doc_id"]: r for r in toxicity.classify(d, y).where("doc_id >= 5000").collect()}
    assert set(found[5000]["evidence"]) <= set(learnt) and found[5000]["score"] > found[5001]["score"]


def test_pages(spark):
    schema = "page_id long, url string, html string, `group` string, host string, salt long"
    rows = [(i, f"https://h.example/{i}", f"<body><nav>menu</nav><article><p>text {i}</p></article></body>", "g", "h", 1) for i in range(5)]
    rows += [(7, None, None, "g", None, 1), (8, "https://h.example/8", "", "g", "h", 1), (8, "https://h.example/8", "", "g", "h", 1), (None, "https://h.example/9", "<p>no id</p>", "g", "h", 1)]
    found = html.extract_pages(spark.createDataFrame(rows, schema)).orderBy(F.col("page_id").asc_nulls_last()).collect()
    assert [r["text"] for r in found] == [f"text {i}" for i in range(5)] + ["", "", "", "no id"] and all(r["n_chars"] == len(r["text"]) for r in found)
    assert html.extract_pages(spark.createDataFrame([], schema)).count() == 0


def test_pages_of_a_hot_host_keep_their_wrapper(spark):
    """A host with most pages is cut into blocks; each finds the template, which only alignment can tell."""
    page = "<body><div><p>Acme Daily</p></div><div><p>story {n}</p></div><div><p>Made by Acme</p></div></body>"
    rows = [(i, f"https://{'hot' if i % 10 else f'h{i % 40}'}.example/{i}", page.replace("{n}", str(i))) for i in range(1500)]
    found = html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 1500 and all(r["text"] == f"story {r['page_id']}" for r in found)


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = [(i, (t or "") + " " + " ".join(f"tail{i}w{j}" for j in range(25)) if i % 2 else t, *rest) for i, t, *rest in make(9, 40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    full = texts(spark.createDataFrame(rows, SCHEMA))
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    full = {i: t for i, t in full.items() if verdict[i]}
    groups = {}
    for i, t in full.items():
        groups.setdefault("".join(words(t)), []).append(i)
    full = {i: full[i] for g in groups.values() for i in [min(g, key=lambda i: (-len(full[i]), i))]}
    near = brute_near(full, 5)
    full = {i: t for i, t in full.items() if near[i][1] == i}
    repeats = brute_repeats(full)
    found = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(found["doc_id"]) == set(full)
    library = Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    assert any(r[1] for r in repeats.values())
    for i, g in found.groupby("doc_id"):
        ids = [*library.encode(brute_left(full, i), add_special_tokens=False).ids, 0]
        assert g["length"].sum() == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in g.itertuples())
    assert found.groupby("sequence_id")["length"].sum().max() <= 2048


def test_pipeline_keeps_rows_without_an_id_and_rows_that_share_one(spark):
    good = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(None, good(1)), (None, "too short"), (5, good(2)), (5, "too short"), (6, good(3)), (None, good(3)), (7, good(4)), (7, good(5))]
    docs = spark.createDataFrame([(i, t, "en", f"host{k}", len(t), "s", "k") for k, (i, t) in enumerate(rows)], SCHEMA)
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in now.collect()) == sorted([(0, good(1)), (5, good(2)), (6, good(3)), (7, good(4)), (7, good(5))])


def test_pipeline_stages_keep_the_columns(spark, empty):
    now = empty
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.columns == empty.columns and now.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() == 0


def test_crc_of_fold(spark):
    row = spark.range(1).select(F.lit(5).alias("doc_id")).select(toxicity.held_out().alias("x")).first()
    assert row["x"] == (zlib.crc32(b"5") % 3 == 1)


@pytest.mark.parametrize("block", [10, 3000])
def test_a_group_of_near_copies_around_the_threshold(spark, monkeypatch, block):
    """Copies of one text with 0 to 16 of 100 words changed: several components in every bucket, and hubs whose links fail."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 400 * block)
    rnd, base = random.Random(11), [f"w{i}" for i in range(100)]
    rows = []
    for i in range(150):
        ws = base.copy()
        for k in rnd.sample(range(100), rnd.randint(0, 16)):
            ws[k] = rnd.choice(["other", f"n{i}x{k}"])
        rows.append((i, " ".join(ws), "en", "a", 1, "", ""))
    d = spark.createDataFrame(rows, SCHEMA)
    want = brute_near(texts(d), 2)
    assert 3 < len({c for _, c in want.values()}) < 100
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.group(d).collect()} == want


def test_words_are_hashed_alike_wherever_slices_are_cut(monkeypatch):
    rnd = random.Random(12)
    found = ["", " ", "A b", "é" * 50, *(" \t\n".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 80))) for _ in range(30))]
    whole = minhash.word_hashes(found)
    monkeypatch.setattr(minhash, "SLICE", 7)
    for text, a, b in zip(found, whole, minhash.word_hashes(found)):
        assert a.tolist() == b.tolist() and len(a) == len([w for w in words(text) if w])
    assert len(set(np.concatenate(whole).tolist())) == len({w.lower() for t in found for w in words(t) if w})


NAMES = "map map_no MAP_NO_ bit block text_mark_ id_key_ gone_id_ gone_mark_ mark copy lo hi part data kept host digest first sha n own_0_ chars runs doc label root b".split()


def test_no_inner_name_of_the_pipeline_meets_a_column(spark):
    """Columns of every inner name keep their values through all stages, and no other row goes than without them."""
    docs = spark.createDataFrame(make(6, 80), SCHEMA)
    more = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in NAMES])
    plain = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        more, plain = _base.materialize(stage(spark, more, ""), "more"), _base.materialize(stage(spark, plain, ""), "plain")
        rows = more.collect()
        assert rows and sorted((r["doc_id"], r["text"] or "") for r in rows) == sorted((r["doc_id"], r["text"] or "") for r in plain.collect())
        assert all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in NAMES)
    packed = corpus_pipeline.STAGES[-1][1]
    assert packed(spark, more, "").count() == packed(spark, plain, "").count()
