"""Operators on documents against plain Python, on rows with every awkward case."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import bpe, common, decontaminate, exact_dedup, ngram_join, quality, toxicity
from stratalake.llm.components import components

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# columns whose names clash with what the operators use inside
DDL = "doc_id long, text string, id string, fp long, sha string, n long, row long, set long, comp long, kept string, score string"
SYLLABLES = "an re ti ou st er in th le né ß ö".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))).capitalize() for _ in range(n))


def awkward():
    rng = random.Random(3)
    base = [prose(rng, rng.randint(8, 120)) for _ in range(30)]
    texts = [None, "", " \t\n", None, "one", "One ", "o n e", " ", "ÀÉ ab", "àé ab", "x" * 50_000, prose(rng, 9000), *base]
    for t in base[:20]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts += [" ".join(w), t, t.replace(" ", "\n", 2), " ".join(w[: len(w) * 9 // 10])]
    # a group of many near copies, and of many copies
    hub = prose(rng, 100).split(" ")
    for i in range(60):
        w = list(hub)
        w[rng.randrange(100)] = f"v{i}"
        texts.append(" ".join(w))
    texts += ["same text over and over again " * 3] * 40
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.fixture(scope="module")
def rows_of():
    return awkward()


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, 3, 4, 5, "z", "s") for i, t in pairs], DDL).repartition(5)


def test_exact_groups(spark, rows_of):
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(frame(spark, rows_of)).collect()}
    squeeze = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows_of:
        groups.setdefault(squeeze(t), []).append((-len(t or ""), i))
    assert len(got) == len(rows_of)
    for i, t in rows_of:
        group = groups[squeeze(t)]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(group)[1], len(group), min(group)[1] == i)
        assert r["text_sha256"] == hashlib.sha256(squeeze(t).encode()).hexdigest()


def test_exact_repeated_rows_and_null_ids(spark):
    pairs = [(1, "a b"), (1, "a b"), (1, "other"), (None, "ab"), (None, None), (2, "")]
    docs = frame(spark, pairs)
    got = exact_dedup.exact_groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["group_size"], r["kept"]) for r in got) == sorted(
        [("1", 3, True), ("1", 3, False), ("1", 1, True), ("None", 3, False), ("None", 2, False), ("2", 2, True)]
    )
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a b"), (1, "other"), (2, "")]


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    many = rng.integers(0, 1 << 40, 3000).astype(np.uint64)
    values = np.concatenate([many, many[:50], np.full(200_000, many[7]), np.array([0, (1 << 40) - 1], np.uint64)])
    rng.shuffle(values)
    parts = [exact_dedup.QuotientFilter.of(p, 40).to_bytes() for p in np.array_split(values, 7)]
    whole = exact_dedup.QuotientFilter.merge(exact_dedup.QuotientFilter.from_bytes(p) for p in parts)
    back = exact_dedup.QuotientFilter.from_bytes(whole.to_bytes())
    for f in (whole, back):
        assert dict(zip(f.values.tolist(), f.counts.tolist(), strict=True)) == Counter(values.tolist())


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(pairs):
    sets = {i: shingles(t) for i, t in pairs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("hot,chunk", [(1 << 18, 256), (2, 4)])
def test_near_duplicates(spark, rows_of, monkeypatch, hot, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    got = ngram_join.near_duplicates(frame(spark, rows_of), hot=hot).collect()
    assert len(got) == len(rows_of)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows_of)


def near_copies(rng):
    """Texts a, b, c: a and c are near copies of b, but not of each other."""
    w = [prose(rng, 1) + str(i) for i in range(100)]
    a, c = list(w), list(w)
    a[2], c[97] = "left", "right"
    a[4], c[95] = "Left", "Right"
    a[9], c[90] = "LEFT", "RIGHT"
    return " ".join(a), " ".join(w), " ".join(c)


def test_near_duplicates_null_ids(spark):
    """A text that only rows without an id have links what is near it."""
    rng = random.Random(11)
    a, b, c = near_copies(rng)
    d, e, _ = near_copies(rng)
    pairs = [(7, a), (None, b), (None, b), (3, c), (None, d), (None, e), (5, prose(rng, 50)), (None, prose(rng, 50)), (None, "")]
    brute = brute_components(list(enumerate(t for _, t in pairs)))
    assert brute[0][1] == brute[1][1] == brute[3][1] and brute_components([(7, a), (3, c)])[7][1] == 7
    least = {}
    for k, (i, _) in enumerate(pairs):
        least.setdefault(brute[k][1], []).extend([] if i is None else [i])
    want = Counter((i, brute[k][0], min(least[brute[k][1]], default=None)) for k, (i, _) in enumerate(pairs))
    assert Counter(tuple(r) for r in ngram_join.near_duplicates(frame(spark, pairs)).collect()) == want


def test_one_of_each_repeated_and_null_ids(spark):
    """One row of each component stays, whatever the ids; a repeated id goes for the near copy only."""
    rng = random.Random(12)
    (a, b, _), (c, d, _), (e, f, g), (h, i, _) = (near_copies(rng) for _ in range(4))
    clean = prose(rng, 60)
    pairs = [(3, a), (5, b), (5, clean), (8, c), (8, d), (None, e), (None, f), (None, g), (None, h), (9, i), (None, None), (None, "")]
    docs = frame(spark, pairs)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert sum(got.values()) == 7
    assert all(got[x] == 1 for x in [(3, a), (5, clean), (9, i), (None, None), (None, "")])
    assert got[8, c] + got[8, d] == 1 and sum(got[None, t] for t in (e, f, g)) == 1


def test_second_round_joins_components_across_chunks(spark):
    """Chunks of one set each: the first round finds nothing, cells of components find all."""
    rows = [(7, s) for s in range(8)] + [(8, 20), (8, 21)]
    live = spark.createDataFrame(rows, "bucket long, set long")  # as many as the second round reads
    labels = spark.createDataFrame([(s, 0) for s in range(5)], "node long, component long")
    cells = ngram_join._cells(live, labels, limit=2).collect()
    held = {}
    for r in cells:
        held.setdefault(r["cell"], []).append((r["side"], r["set"], r["comp"]))
    met = set()
    for members in held.values():
        for s, a, ca in members:
            for t, b, cb in members:
                if a < b and ca != cb and (s == t == 2 or {s, t} == {0, 1}):
                    met.add((a, b))
    comp = lambda s: 0 if s < 5 else s
    assert met == {(a, b) for a in range(8) for b in range(a + 1, 8) if comp(a) != comp(b)} | {(20, 21)}


def test_count_tree_is_complete():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.r_[base[: len(base) * 19 // 20], rng.integers(0, 1 << 63, 2).astype(np.uint64)])]
    points, sizes = np.stack([ngram_join.point(s, 7) for s in sets]), np.array([len(s) for s in sets])
    assert (ngram_join.halved(points) == np.stack([ngram_join.point(s, 6) for s in sets])).all()
    assert all((ngram_join.unpacked([ngram_join.packed(p)], 7)[0] == p).all() for p in [*points, points[0] * 300, points[0] * 70_000])
    q, m, bound = ngram_join.CountTree(points, sizes, fanout=4).reach(points, sizes, 80)
    found = set(zip(q.tolist(), m.tolist(), strict=True))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert (i, j) in found
    assert len(found) < len(sets) ** 2 / 4


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 150)] + [(150, 149), (-5, 7), (9, 9)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert got == {**{i: -5 for i in range(1, 41)}, -5: -5, **{i: 100 for i in range(100, 151)}}


def brute_overlap(text, items, window=10):
    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER).encode())
    w, hit, names = cut(text), set(), set()
    for item, t in items:
        v = cut(t)
        m = min(window, len(v))
        wins = {tuple(v[k : k + m]) for k in range(len(v) - m + 1)} if m else set()
        for k in range(len(w) - m + 1):
            if tuple(w[k : k + m]) in wins:
                hit.update(range(k, k + m))
                if item is not None:
                    names.add(str(item))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
def test_overlaps(spark, rows_of, block_bytes):
    rng = random.Random(9)
    items = [(k, prose(rng, 14)) for k in range(12)] + [(20, "tiny Item"), (21, ""), (22, None), (None, "né an"), (23, "lone")]
    items += [(30, items[3][1]), (31, "é é é é é é é é é é é é")]
    pairs = list(rows_of)
    for k in range(12):
        w = items[k][1].split(" ")
        pairs.append((1000 + k, "Start " + "; ".join(w[1:12]) + " mid " + ", ".join(w[:9]) + " end"))
    pairs += [(2000, "a tiny, item LONE tiny"), (2001, "é " * 30), (2002, items[3][1] + " " + items[3][1]), (2002, "lone")]
    pairs += [(2003, "x NÉ an y"), (2004, "x né An y")]  # the words of an item without an id
    got = decontaminate.overlaps(frame(spark, pairs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    seen = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), sum(b - a for a, b in zip(r["hit_from"], r["hit_to"], strict=True))) for r in got.collect())
    want = Counter()
    for i, t in pairs:
        n, hit, names = brute_overlap(t, items)
        want[(i, n, hit, tuple(names), hit)] += 1
    assert seen == want
    clean = decontaminate.clean_documents(frame(spark, pairs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, t in pairs if not brute_overlap(t, items)[1])


public = pytest.importorskip("public_tokenizers")


def test_bpe_like_the_library(spark, rows_of):
    import tiktoken

    path = public.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(11)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x2FF), rng.randrange(0x4E00, 0x9FFF), 0x1F600, 10, 32])) for _ in range(rng.randrange(300))) for _ in range(60)]
    odd += ["a" * 5000, "=" * 3000 + "ab" * 999, " " * 2000, "\n \n\n\t " * 200, "<|endoftext|>", "don't we'll 12345678901234567890"]
    odd += ["".join(rng.choice(["th", "e", "ing", "tion", "er", "A", "0"]) for _ in range(400)) for _ in range(30)]
    pairs = list(rows_of) + list(enumerate(odd, 5000))
    tokens = bpe.encode(frame(spark, pairs), path, public.PATTERN)
    back = {r["doc_id"]: r for r in bpe.decode(tokens, path).collect()}
    for i, t in pairs:
        assert back[i]["ids"] == library.encode_ordinary(t or "")
        assert back[i]["text"] == (t or "")
    again = {r["doc_id"]: r for r in bpe.round_trip(frame(spark, pairs), path, public.PATTERN).collect()}
    assert again == back


def test_quality_reads_whole_words():
    features = quality.Features(max_words=50)
    for prefix in (b"x" * 24, b"Aa1" * 9, b"x" * 4000):
        (a, n), (b, m) = features.count(prefix + b"good"), features.count(prefix + b"evil")
        assert a.tolist() != b.tolist() or n.tolist() != m.tolist()
    middle = features.count(b"y" * 500 + b"q!" + b"y" * 500), features.count(b"y" * 500 + b"!q" + b"y" * 500)
    assert middle[0][0].tolist() != middle[1][0].tolist()
    # the same with a memory that is always full
    rng = random.Random(5)
    text = prose(rng, 700).encode() + b" tail"
    small, large = quality.Features(max_words=7).count(text), quality.Features().count(text)
    assert all((x == y).all() for x, y in zip(small, large, strict=True))


def brute_votes(model, x, leave=None):
    out = []
    for i, v in enumerate(x):
        near = sorted(((-float(v @ w), j) for j, w in enumerate(model.vectors) if leave is None or j != leave[i]))[: model.k]
        w = [max(-c, 0) ** model.power * model.share[j] for c, j in near]
        out.append((sum(a * model.label[j] for a, (_, j) in zip(w, near, strict=True)) + model.prior * 1e-3) / (sum(w) + 1e-3))
    return np.array(out)


def test_quality_votes_against_brute_force():
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((700, 8))
    vectors /= np.sqrt((vectors**2).sum(1, keepdims=True))
    label = (rng.random(700) > 0.6).astype(float)
    model = quality.Model(np.ones(4096), np.ones((4096, 8)), vectors, label, np.where(label, 2.0, 1.0), 15, 4.0)
    x = rng.standard_normal((1300, 8))
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    assert np.allclose(model._votes(x), brute_votes(model, x))
    assert np.allclose(model._votes(vectors, np.arange(700)), brute_votes(model, vectors, np.arange(700)))


def test_transducer_forgets_and_goes_on():
    ranks = bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    small, large = bpe.Transducer(ranks, max_states=50), bpe.Transducer(ranks)
    rng = random.Random(2)
    for _ in range(300):
        piece = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 9))).encode()
        assert small.encode(piece) == large.encode(piece)


def test_transducer_keeps_the_states_it_made_first(monkeypatch):
    machine, rng = bpe.Transducer(bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), max_states=60), random.Random(6)
    want = machine.encode(b" common")
    for _ in range(200):
        machine.encode("".join(rng.choice(SYLLABLES) for _ in range(5)).encode())
        assert len(machine.states) <= 60 + 40
    monkeypatch.setattr(machine, "_step", None)
    assert machine.encode(b" common") == want


def test_encoder_keeps_words_that_come_again(monkeypatch):
    encoder, calls = bpe.Encoder(bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN, max_words=40), []
    real = encoder.machine.encode
    monkeypatch.setattr(encoder.machine, "encode", lambda piece: calls.append(piece) or real(piece))
    for a in SYLLABLES[:10]:
        for b in SYLLABLES[:10]:
            ids = encoder.encode(f" often {a}xq{b}{b}")
            assert encoder.decode(ids) == f" often {a}xq{b}{b}"
            assert len(encoder) + len(encoder.older) <= 40
    assert calls.count(b" often") == 1 and len(calls) > 100


def test_streaming_decode_of_any_bytes():
    rng = random.Random(4)
    for _ in range(400):
        data = bytes(rng.choice([rng.randrange(256), 0x61, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0]) for _ in range(rng.randrange(40)))
        assert "".join(bpe.decode_stream(list(data), lambda b: bytes([b]), chunk=rng.randint(1, 5))) == data.decode("utf-8", "replace")


def labelled(spark, pairs, bad="awful vile"):
    docs = [(i, (t or "") + (f" {bad} {bad}" if i % 5 == 0 else "")) for i, t in pairs]
    return docs, spark.createDataFrame([(i, int(i % 5 == 0), int(i % 5 != 0)) for i, _ in docs], "doc_id long, toxic int, quality int")


def test_toxicity_learns_and_keeps_every_row(spark):
    rng = random.Random(8)
    docs, labels = labelled(spark, [(i, prose(rng, 30)) for i in range(300)] + [(301, None), (302, ""), (302, "")])
    df = frame(spark, docs)
    model = toxicity.fit(df, labels)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(docs)
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["evidence"] for r in got if r["doc_id"] % 5 == 0)
    kept = toxicity.reject(df, model)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in docs if i % 5)


def test_toxicity_searches_texts_without_telling_words(spark):
    """Words of one example tell nothing by themselves, but find the example."""
    docs = [(i, f"solo{i} alone{i} " + ("poison " if i % 2 else "fine ") * 3) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    asked = [(1000 + i, f"solo{i} alone{i}") for i in (4, 5, 12, 13, 30, 31) if zlib.crc32(str(i).encode()) % 4 != 2]
    model = toxicity.fit(frame(spark, docs), labels)
    got = toxicity.score(frame(spark, [*asked, (2000, "unseen" + "x" * 100)]), model).collect()
    near = {r["doc_id"]: [e["id"] for e in r["evidence"]] for r in got}
    assert near == {i: [str(i - 1000)] for i, _ in asked} | {2000: []} and len(asked) > 2


def test_block_max_finds_the_exact_nearest():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(700):
        terms = np.sort(rng.choice(50, rng.integers(1, 6), replace=False))
        w = rng.random(len(terms)) + 0.1
        vectors.append((terms, w / np.sqrt((w**2).sum())))
    index = toxicity.BlockMaxIndex(vectors, 50)
    dense = np.zeros((700, 50))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for t, w in vectors[:60]:
        rows, cosines = index.nearest(t, w, 10)
        every = np.round(dense[:, t] @ w, 9)
        want = np.lexsort((np.arange(700), -every))[:10]
        want = want[every[want] > 0]
        assert rows.tolist() == want.tolist() and np.allclose(cosines, every[want])


def test_quality_learns_and_keeps_every_row(spark):
    rng = random.Random(8)
    docs, labels = labelled(spark, [(i, prose(rng, 30)) for i in range(300)] + [(301, None), (302, ""), (302, "")], "### %%%")
    df = frame(spark, docs)
    got = quality.score(df, quality.fit(df, labels)).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] % 5 != 0) for r in got if r["doc_id"] <= 300]) > 0.97


def test_held_out_rows_are_never_learned(spark):
    docs = [(i, f"word{i % 7} poison" if i % 2 else "fine") for i in range(200)]
    import zlib

    rows = [(i, i % 2, i % 2) for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int, quality int")
    df = frame(spark, docs)
    assert {r["score"] for r in toxicity.score(df, toxicity.fit(df, labels)).collect()} == {0.0}
    assert {r["score"] for r in quality.score(df, quality.fit(df, labels)).collect()} == {0.0}


def test_empty_tables(spark):
    none = frame(spark, [(1, "x")]).filter("false")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    path = public.path("byte_bpe_50k.tiktoken")
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.keep_one(none).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0 and ngram_join.one_of_each(none).count() == 0
    assert decontaminate.overlaps(none, items).count() == 0
    assert bpe.decode(bpe.encode(none, path, public.PATTERN), path).count() == 0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert quality.score(none, quality.fit(none, labels)).count() == 0
    one = frame(spark, [(1, "some words stay without labels or items at all")])
    assert decontaminate.overlaps(one, items).select("n_words", "n_hit").first() == (9, 0)
    assert toxicity.score(one, toxicity.fit(one, labels)).first()["score"] == 0.0


def test_pipeline_stages_keep_columns(spark, tmp_path, rows_of):
    import corpus_pipeline

    docs = frame(spark, rows_of)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, prose(random.Random(1), 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 0, 1) for i, _ in rows_of[:50]], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        assert k == 4 or now.columns == docs.columns, name
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
    texts = dict(rows_of)
    assert now.filter(F.sha2(F.lit(""), 256) == F.col("decoded_sha256")).count() <= 1
    kept = {r["doc_id"]: r for r in now.collect()}
    assert all(r["decoded_sha256"] == hashlib.sha256((texts[i] or "").encode()).hexdigest() for i, r in kept.items())
    comps = brute_components([(i, texts[i]) for i in kept])
    assert all(c == i for i, (_, c) in comps.items())


def test_batches_of_texts_are_bounded_by_bytes(spark):
    rows = spark.range(0, 400, 1, 1).select(F.col("id"), F.repeat(F.lit("x"), 100_000).alias("text"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    sizes = [r["n"] for r in common.in_batches(rows, run, "n long").collect()]
    assert sum(sizes) == 400 and max(sizes) * 100_000 <= common.BATCH_BYTES + 200_000
