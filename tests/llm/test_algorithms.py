"""Pieces of the operators without Spark."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from pressrun.llm import bpe, html, minhash, packing, sais, suffix, tokens, toxicity
from pressrun.llm import token_output as out

ODD = ["", " ", "  ", "\n", " \n a", "a  b", "x  y", "<|endoftext|>", "a<|endoftext|>b  c", "é ́a", "İSTANBUL ΣΑΣ", "'s it's I'LL", "😀 日本語 テスト", "a\x1c b"]


def texts(seed, n):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice(" ab\n\t'sÉé́  <|>1.日😀Σ\x1c\u0085İﬁ½_\x00") for _ in range(rnd.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_library_ids(name):
    use, library = tokens.encoder(name), Tokenizer.from_file(tokens.path(name))
    for text in texts(1, 3000):
        assert np.frombuffer(use.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_forced_boundaries_give_the_library_ids_and_text():
    own, library = bpe.ForcedBPE(tokens.path("word_bpe_49k.json")), Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    assert own.forced
    for text in texts(2, 2000):
        ids = library.encode(text, add_special_tokens=False).ids
        n, a, b = own.digest(text)
        assert own.encode(text) == ids and n == len(ids)
        assert a == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert b == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_texts_are_split_whole_and_words_encoded_once(monkeypatch):
    """No work for each piece between blanks: a text is normalised and split in one pass, and a word is merged once, whatever stands beside it and however small the store."""
    own, library = bpe.ForcedBPE(tokens.path("word_bpe_49k.json")), Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    split, merged = [], []
    monkeypatch.setattr(own, "plain", lambda t, f=own.plain: (split.append(t), f(t))[1])
    monkeypatch.setattr(own, "merged", lambda w, f=own.merged: (merged.append(w), f(w))[1])
    rnd = random.Random(3)
    found = ["".join(rnd.choice(["Wort", "mañana", "日本", "don't", "x1", "\x1c", "\x85"]) + rnd.choice([" ", "\n", ". ", "\t,", "\u3000", "  "]) for _ in range(200)) for _ in range(20)]
    found += ["a<|endoftext|>b <|startoftext|>\n<|x", "", " \n "]

    def want(text):
        ids = library.encode(text, add_special_tokens=False).ids
        return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))

    assert own.digests(found) == [want(x) for x in found]
    assert len(split) <= len(found) + 5 and len(merged) == len(set(merged))
    own.spelled.most = 1_000
    assert own.digests(found) == [want(x) for x in found] and len(own.spelled.names) == len(own.spelled) < 40


def test_a_full_store_starts_anew(monkeypatch):
    store = tokens.Store(2 * tokens.ENTRY + 10)
    for i in range(7):
        store.full()
        store.keep(str(i), i, 1)
    assert 0 < len(store) <= 3
    use = tokens.Encoder("word_bpe_49k.json")
    use.pieces.most, library = 3000, use.library
    found = texts(8, 400)
    monkeypatch.setattr(tokens, "CHUNK", 50)
    assert [np.frombuffer(x, "<u4").tolist() for x in use.encode_all(found)] == [library.encode(x, add_special_tokens=False).ids for x in found]


@pytest.mark.parametrize("word", ["abcdefghij" * 100_000, "a" * 300_000, "日本語" * 20_000, "the" * 7_000])
def test_words_of_any_length(word):
    own, library = bpe.ForcedBPE(tokens.path("word_bpe_49k.json")), Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    assert own.encode(word) == library.encode(word, add_special_tokens=False).ids
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        use = tokens.encoder(name)
        assert np.frombuffer(use.encode(word), "<u4").tolist() == use.library.encode(word, add_special_tokens=False).ids


def test_merges_from_a_heap_are_those_of_a_list(monkeypatch):
    own, rnd = bpe.ForcedBPE(tokens.path("word_bpe_49k.json")), random.Random(9)
    words = [[*("".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 60))))] for _ in range(500)]
    assert [own.merge(x.copy()) for x in words] == [own.merge_long(x.copy()) for x in words]


def test_suffix_arrays_equal_sorting():
    rnd = np.random.default_rng(1)
    for turn in range(150):
        n, k = int(rnd.integers(1, 120)), int(rnd.integers(1, 5))
        text = np.append(np.tile(rnd.integers(1, k + 1, max(1, n // 5)), 5) if turn % 3 == 0 else rnd.integers(1, k + 1, n), 0)
        found, data = sais.suffix_array(text, int(text.max()) + 1), text.astype("u1").tobytes()
        assert found.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        shared = sais.common_prefixes(text.astype("u1"), found, 50)
        for a, b in zip(found, found[1:]):
            n = 0
            while n < 50 and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
                n += 1
            assert shared[b] == n


def test_induced_sorting_recurses_on_names_at_every_size(monkeypatch):
    """Each level sorts the names of the level above, until all differ; both ways of induction give the same array."""
    rnd, levels = np.random.default_rng(8), []
    words = [rnd.integers(98, 123, int(n)).astype("u1").tobytes() for n in rnd.integers(2, 9, 500)]
    data = b" ".join(words[int(k)] for k in rnd.integers(0, 500, 6000))
    text = np.append(np.frombuffer(data, "u1").astype("i4") + 1, 0)
    whole = sais.suffix_array

    def counted(text, letters):
        levels.append((len(text), letters))
        return whole(text, letters)

    monkeypatch.setattr(sais, "suffix_array", counted)
    found = sais.suffix_array(text, 258)
    assert found[1:].tolist() == sorted(range(len(data)), key=lambda i: data[i : i + 5000])
    assert len(levels) >= 3 and max(x[1] for x in levels) > sais.FEW_LETTERS and all(b[0] <= a[0] // 2 + 1 for a, b in zip(levels, levels[1:]))
    for few in (0, 1 << 30):
        monkeypatch.setattr(sais, "FEW_LETTERS", few)
        assert whole(text[-3000:], 258).tolist() == [i - (len(text) - 3000) for i in found if i >= len(text) - 3000]


def test_equal_windows_have_equal_owners():
    rnd = np.random.default_rng(2)
    core = rnd.integers(97, 101, 80).astype("u1").tobytes()
    docs = [bytes(rnd.integers(97, 101, int(n)).astype("u1")) + core + bytes(rnd.integers(97, 101, 30).astype("u1")) for n in (0, 13, 64)] + [b"", b"short"]
    doc, start, number, owner = suffix.owners(docs)
    of = {}
    for d, s, n, o in zip(doc, start, number, owner):
        for w in range(s, s + n):
            of.setdefault(docs[d][w : w + 50], set()).add(o)
    assert all(len(x) == 1 for x in of.values())
    assert sum(number) == sum(max(0, len(x) - 49) for x in docs)


def test_super_min_hash_estimates_jaccard():
    rnd, errors = np.random.default_rng(3), []
    for _ in range(60):
        n = int(rnd.integers(5, 150))
        both = round(0.8 * n)
        union = rnd.integers(0, 2**63, n, dtype="u8")
        a, b = union[: both + (n - both) // 2], np.concatenate([union[:both], union[both + (n - both) // 2 :]])
        s = minhash.signatures([np.unique(a), np.unique(b)], 200)
        errors.append((s[0] == s[1]).mean() - both / n)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
    assert (minhash.signatures([np.empty(0, "u8")], 8) == ~np.uint64(0)).all()


@pytest.mark.parametrize("cap", [packing.Capacities(), packing.Capacities(documents=3), packing.Capacities(measure="dot")])
def test_plans_fill_bins_within_every_capacity(cap):
    rnd = random.Random(4)
    counts = {rnd.randint(1, 2048): rnd.randint(1, 60) for _ in range(80)} | {2048: 3}
    plan, bins = packing.plan(counts, cap)
    load, docs = {}, {}
    for size in counts:
        rows = plan[plan["size"] == size].sort_values("lo")
        edges = [*rows["lo"], counts[size]]
        for r, lo, hi in zip(rows.itertuples(), edges, edges[1:]):
            for rank in range(lo, hi):
                b = r.first + (rank - lo) // r.each
                load.setdefault(b, []).append((r.offset + (rank - lo) % r.each * size, size))
                docs[b] = docs.get(b, 0) + 1
    assert len(load) == bins and max(docs.values()) <= cap.documents
    for placed in load.values():
        at = 0
        for offset, size in sorted(placed):
            assert offset == at
            at += size
        assert at <= cap.tokens
    if cap == packing.Capacities():
        plain = []  # best fit, one piece after the other
        for size in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
            fits = [i for i, left in enumerate(plain) if left >= size]
            if fits:
                plain[min(fits, key=lambda i: plain[i])] -= size
            else:
                plain.append(2048 - size)
        assert bins <= len(plain)


def test_pieces_of_long_documents():
    assert packing.pieces_of(5, 2048) == [5]
    assert packing.pieces_of(2048, 2048) == [2048]
    assert packing.pieces_of(4099, 2048) == [3, 2048, 2048]


def test_containers_round_trip_and_know_their_dictionary():
    rnd = np.random.default_rng(5)
    docs = [rnd.integers(0, 300, int(n)) for n in rnd.integers(1, 400, 60)]
    import zstandard

    dictionary = zstandard.train_dictionary(4096, [out.serialize(x, 2) for x in docs * 20]).as_bytes()
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    box = out.write_container(list(range(60)), [len(x) for x in docs], [writer.compress(out.serialize(x, 2)) for x in docs], 2, dictionary)
    reader = out.Container(box, dictionary)
    assert len(reader) == 60 and all((reader.ids(i) == x).all() for i, x in enumerate(docs))
    with pytest.raises(ValueError, match="another dictionary"):
        out.Container(box, dictionary + b"x")
    assert zlib.crc32(reader.ids(7).astype("<u4").tobytes()) == zlib.crc32(docs[7].astype("<u4").tobytes())


@pytest.mark.parametrize(("blocks", "dense"), [(16, 1024), (5, 6), (1, 0)])
def test_block_max_search_equals_brute_force(blocks, dense, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCKS", blocks)
    monkeypatch.setattr(toxicity, "DENSE", dense)
    rnd = np.random.default_rng(6)
    value = rnd.uniform(0.5, 3, 80)

    def drawn(n, most):
        """Texts keep to a part of the words, as those of one language."""
        terms = [int(rnd.integers(0, 4)) * 15 + rnd.choice(35, rnd.integers(1, most), replace=False) for _ in range(n)]
        row, term = np.repeat(np.arange(n), [len(t) for t in terms]), np.concatenate(terms)
        return toxicity.weigh(row, term, rnd.integers(1, 4, len(term)), value, n)

    def dense(row, term, weight, n):
        out = np.zeros((n, 80))
        out[row, term] = weight
        return out

    vectors, queries = drawn(700, 6), drawn(60, 9)
    index = toxicity.build(np.arange(700), rnd.integers(0, 2, 700), *vectors, {str(i): i for i in range(80)}, value, 0.3, {0: 1.0, 1: 1.0})
    cosines = dense(*queries, 60) @ dense(*vectors, 700).T
    for scores, (places, found) in zip(cosines, index.nearest(*queries, 60)):
        best = np.lexsort((np.arange(700), -scores.round(6)))[: toxicity.K]
        best = best[scores[best] > 0]
        assert np.allclose(found, scores[best], atol=1e-6) and len(set(places)) == len(best)
        assert np.allclose(scores[index.ids[places]], found, atol=1e-6)


def test_blocks_hold_every_example_and_weight(monkeypatch):
    monkeypatch.setattr(toxicity, "DENSE", 3)
    sizes = [i % 5 for i in range(10)]
    of, term = np.repeat(np.arange(10), sizes), np.concatenate([np.arange(k) for k in sizes])
    index = toxicity.build(np.arange(10)[::-1], np.arange(10) % 2, of, term, np.full(len(term), 0.25), {}, np.ones(5), 0.5, {})
    assert sorted(index.ids) == list(range(10)) and index.edges[-1] == 10
    assert sum((x > 0).sum() for x in index.rows) + len(index.at) == len(term)


PAGE = (
    "<html><head><title>t</title><script>var a='</p>';</script></head><body><header><a>Home</a></header><nav><ul><li>Menu {n}</li></ul></nav><div class='ad'>Buy {n}</div>"
    "<article><h1>Head {n}</h1><p>One &amp; <b>two</b> {n}<br>three<p>Second  {n}\n line<p>Share this page now</p></article><aside>side {n}</aside><form>f</form>"
    "<div id='comments'><p>reader {n}</p></div><footer>foot {n}</footer></body></html>"
)


def test_wrappers_keep_varying_text_of_the_article():
    found = html.main_texts([PAGE.replace("{n}", str(i)) for i in range(6)])
    assert found[3] == "Head 3\n\nOne & two 3 three\n\nSecond 3 line"


def test_few_pages_prove_no_template_and_copies_stay():
    assert html.main_texts([PAGE.replace("{n}", "1")])[0].endswith("Share this page now")
    assert html.main_texts([PAGE.replace("{n}", "1")] * 9)[8].startswith("Head 1")
    assert html.main_texts(["", "plain &lt; text", "<p>a<p>b</p></p><div>"]) == ["", "plain < text", "a\n\nb"]


def test_tree_matching_keeps_order_and_labels():
    a, b = html.parse("<ul><li>1<li>2<li>3</ul>"), html.parse("<ul><li>1<p>x</p><li>2</ul>")
    html.measure(a)
    html.measure(b)
    assert html.align(a, b, {}) == 4
    assert [(p.tag, q.tag) for p, q in html.pairs(a, b)][:2] == [("#root", "#root"), ("ul", "ul")]


def brute_match(a, b):
    if a.label != b.label:
        return 0
    best = [[0] * (len(b.inner) + 1) for _ in range(len(a.inner) + 1)]
    for i, p in enumerate(a.inner):
        for j, q in enumerate(b.inner):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_match(p, q))
    return 1 + best[-1][-1]


@pytest.mark.parametrize(("few", "cells"), [(600, 4_000_000), (0, 4_000_000), (0, 6)])
def test_tree_matching_equals_brute_force(few, cells, monkeypatch):
    monkeypatch.setattr(html, "FEW", few)
    monkeypatch.setattr(html, "CELLS", cells)
    rnd = random.Random(13)

    def tree(depth):
        tag = rnd.choice("bip")
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rnd.randint(0, 4) if depth else 0)) + f"</{tag}>"

    for _ in range(120):
        a, b = (html.parse("<div>" + "".join(tree(2).replace("p>", "u>") for _ in range(3)) + "</div>") for _ in range(2))
        html.measure(a)
        html.measure(b)
        found = html.pairs(a, b)
        assert html.align(a, b, {}) == brute_match(a, b) == len(found)
        assert len({id(p) for p, _ in found}) == len({id(q) for _, q in found}) == len(found)
        assert all(p.label == q.label for p, q in found)


def test_an_inserted_child_shifts_no_match_at_any_length():
    for n in (600, 3000):
        a = html.parse("<div>" + "".join(f"<p><b>{i}</b></p>" if i % 2 else "<p>x</p>" for i in range(n)) + "</div>")
        b = html.parse("<div><h2>new</h2>" + "".join(f"<p><b>{i}</b></p>" if i % 2 else "<p>x</p>" for i in range(n - 1)) + "<h3>end</h3><p>x</p></div>")
        html.measure(a)
        html.measure(b)
        assert html.align(a, b, {}) == a.size - 1 and len(html.pairs(a, b)) == a.size - 1


def test_deep_pages_and_long_texts():
    deep = ["<div>" * 5000 + f"<p>text {i}</p><{'b' if i % 2 else 'i'}>x{i}</{'b' if i % 2 else 'i'}>" + "</div>" * 5000 for i in range(6)]
    assert html.main_texts(deep) == [f"text {i}\n\nx{i}" for i in range(6)]
    long = "word " * 400_000
    assert html.main_texts([f"<article><p>{long}</p></article>"]) == [long.strip()]


def test_alignment_alone_finds_the_text_of_pages_without_telling_names():
    """No article, no names: an advert and a bar stand at places that shift with the number of paragraphs."""
    page = "<body><div><p>Acme Daily</p><p>All rights belong to Acme</p></div><div><h1>Title {n}</h1>{body}<p>Write to us today</p></div><div><p>Made by Acme</p></div></body>"
    pages = [page.replace("{n}", str(i)).replace("{body}", "".join(f"<p>story {i} part {k}</p>" for k in range(1 + i % 4))) for i in range(12)]
    for i, text in enumerate(html.main_texts(pages)):
        assert text == "\n\n".join([f"Title {i}", *(f"story {i} part {k}" for k in range(1 + i % 4))])
    assert "Made by Acme" in html.main_texts(pages[:3])[0]


def test_pages_come_in_the_same_blocks_however_they_arrive():
    import pandas as pd

    rnd = random.Random(14)
    rows = pd.DataFrame([(h, s, "x" * rnd.choice([10, 10, 9_000_000])) for h, s, n in (("a", 0, 450), ("a", 1, 99), ("b", 0, 230), ("c", 0, 1)) for _ in range(n)], columns=["host", "salt", "html"])
    whole, left = html.blocks_of(rows, False)
    assert left == len(rows) and [a for a, _ in whole[1:]] == [b for _, b in whole[:-1]]
    at, end, parts = 0, 0, []
    while end < len(rows):
        end = min(len(rows), end + rnd.randint(1, 260))
        found, left = html.blocks_of(rows.iloc[at:end], end < len(rows))
        parts += [(at + a, at + b) for a, b in found]
        at += left
    assert parts == whole


@pytest.mark.parametrize("page", ['<a "', "<a b", "<a x='", '<a x="', "<a x= ", "<!-", "<a b>c<", "<a '\"=", "= '<p"])
def test_broken_tags_take_linear_time(page):
    began = time.process_time()
    html.parse(page * (1_000_000 // len(page)))
    assert time.process_time() - began < 10


def own_texts(page):
    root, out = html.parse(page), []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        else:
            stack += reversed(node.children)
    return out


def test_quotes_open_values_after_an_equals_sign_only():
    assert own_texts("<p title=it's>Hello world</p><p>B it's c</p>") == ["Hello world", "B it's c"]
    assert own_texts("<p title=\"a>b\" x='c>d' y = \"e>f\">in</p>") == ["in"]
    assert own_texts('<p "a>b</p>c') == ["b", "c"]
    assert own_texts("<p x=\"a>b</p>c <!-- d") == ["b", "c "]
    assert own_texts("a<!-- b <p>c</p> d") == ["a"]
