"""Source divergence, filter interaction and token counts against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from stratalake.llm import divergence, interaction, token_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, lang string, source string, id long, h long, row long, term string, n long, part string, block long, mask long"
PATH = public.path("byte_bpe_50k.json")


def frame(spark, rows):
    """Rows (id, text, lang, source) with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4, "p", 5, 6) for r in rows], DDL).repartition(5)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = ["an", "ßé", "Tie", "tie", "中文", "o'clock", "zz9", "x" * 3000] + [f"w{c}{d}" for c in "abcdefgh" for d in "abcdef"]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "de", None, "xx"])
        source = rng.choice(["hot", "hot", "s1", "s2", "é", None])
        if lang == "xx":
            source = "only"
        text = rng.choice([None, "", " \t", " ".join(rng.choice(words) for _ in range(rng.randint(1, 160)))] + ["same text again " * 50] * 2)
        if rng.random() < 0.7:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 160)))
        rows.append((i, text, lang, source))
    rows += [(400 + i, "same text again " * 50, "en", "hot") for i in range(150)]
    rows += [(7, "repeated id", "en", "s9"), (7, "repeated id", "en", "s9"), (None, "repeated id", "de", "s9"), (None, None, None, None)]
    rows += [(900, "only words here 123 $", "zz", "a"), (901, None, "zz", "b"), (902, "long " * 40_000 + "#", "en", "s1")]
    return rows


def brute_divergence(rows, min_docs):
    n, docs, groups = {}, {}, set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        n.setdefault((lang, source), Counter()).update(terms)
        docs.setdefault(lang, Counter()).update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, d in docs[lang].items() if d >= min_docs)
        mine = sorted(s for g, s in groups if g == lang)

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + (10**9 * (counts[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in mine}
        q = shares(sum((n[lang, s] for s in mine), Counter()))
        for s in mine:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, v, k) for k, (v, item) in enumerate(ordered, 1)}
    return out


@pytest.mark.parametrize("min_docs,block_terms", [(30, 8192), (3, 4), (10_000, 8192)])
def test_divergence(spark, corpus, min_docs, block_terms):
    got = divergence.divergence(frame(spark, corpus), min_docs=min_docs, block_terms=block_terms).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute_divergence(corpus, min_docs)


def test_share_is_exact():
    rng = random.Random(1)
    for _ in range(2000):
        total, terms = rng.randrange(10**15), rng.randrange(1, 10**6)
        n = rng.randrange(total + 1)
        want = 1 + 10**9 * (n + 5) // (total + 5 * terms)
        assert divergence.share(n, total, terms) == want == int(divergence.share(np.array([n]), total, terms)[0])


def test_share_in_sql_is_exact(spark):
    rows = [(n, t, v) for t in (0, 7, 10**14 + 1) for v in (1, 99_991) for n in (0, t // 3, t)]
    df = spark.createDataFrame(rows, "n long, t long, v long")
    got = df.select("*", divergence.share_sql("n", "t", "v").alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 5) // (r["t"] + 5 * r["v"]) for r in got)


def test_gallop():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 500, rng.integers(0, 200)))
        b = np.unique(rng.integers(0, 5000 if rng.random() < 0.5 else 500, rng.integers(0, 3000)))
        at = divergence.gallop(a, b, run=int(rng.integers(1, 9)))
        place = {x: i for i, x in enumerate(b.tolist())}
        assert at.tolist() == [place.get(x, -1) for x in a.tolist()]


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    parts = {}
    for i, text, lang, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        parts.setdefault(lang or "", []).append((i, fails))
    out = set()
    for part, docs in parts.items():
        rows_of, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                redundant = sum(d[1][f] for d in docs) - len(gone)
                left = [d for d in left if not d[1][f]]
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in docs)
                shapley[f] += len(gone)
                rows_of.append((part, "".join(order), step, len(left), len(gone), redundant, alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f))
        out |= {(*r[:-1], shapley[r[-1]]) for r in rows_of}
    return out


def test_audit(spark, corpus):
    rng = random.Random(4)
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 560, 3)]
    marks += [(3, 1, 0), (3, 0, 1), (None, 1, 1), (99_999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = interaction.audit(frame(spark, corpus), labels).select(columns).collect()
    assert len(got) == 600 * len({r["part"] for r in got})
    assert {tuple(r) for r in got} == brute_audit(corpus, marks)


def test_sketches_never_clear_a_repeat(spark):
    rng = np.random.default_rng(3)
    once = rng.integers(-(1 << 62), 1 << 62, 40_000)
    many = np.concatenate([once, once[:700], np.full(20_000, once[5])])
    rng.shuffle(many)
    got = {r["h"] for r in interaction.suspects(spark.createDataFrame([(int(x),) for x in many], "h long").repartition(7)).collect()}
    repeated = set(once[:700].tolist())
    assert repeated <= got
    assert len(got - repeated) < 0.02 * len(once)


def test_sketches_add_up():
    rng = np.random.default_rng(4)
    h = rng.integers(-(1 << 62), 1 << 62, 30_000)
    h = np.concatenate([h, h[:9000], np.full(999, h[0])])
    whole, parts = interaction.CountingBloom(), interaction.CountingBloom()
    whole.add(*interaction.sketch(*np.unique(h, return_counts=True)))
    for some in np.array_split(rng.permutation(h), 6):
        parts.add(*interaction.sketch(*np.unique(some, return_counts=True)))
    assert (whole.counters == parts.counters).all()


ATOMS = ["'re", "'", "r", "e", " ", "  ", "\n", "<|endoftext|>", "<|", "endoftext", "|>", "ab", "é", "中文", "12", "!!", "x" * 30, " don't", "　", "🙂"]


def texts():
    rng = random.Random(6)
    made = [None, "", " ", "<|endoftext|>", "x" * 3000, "中" * 700 + " " + "文" * 700, " " * 900 + "<|endoftext|>" + " " * 900]
    return made + ["".join(rng.choice(ATOMS) for _ in range(rng.randint(1, 600))) for _ in range(120)]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 10), (128, 34), (200, 64)])
def test_token_counts(spark, chunk, overlap):
    library = Tokenizer.from_file(PATH)
    rows = [(i % 100, t, None, None) for i, t in enumerate(texts())] + [(None, "one two", None, None)] * 2
    got = token_counts.token_counts(frame(spark, rows), PATH, limit=20, chunk=chunk, overlap=overlap).collect()
    want = []
    for i, t, _, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 20))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_a_chunk_needs_a_memoryless_tokenizer():
    assert token_counts.end_margin(PATH) == len("<|endoftext|>") + 4
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.end_margin(public.path("word_bpe_49k.json"))


def test_empty_tables(spark):
    none = frame(spark, [(1, "a", "b", "c")]).filter("false")
    assert divergence.divergence(none).count() == 0
    assert token_counts.token_counts(none, PATH).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(none, labels).count() == 0
    assert interaction.audit(frame(spark, [(1, "a", None, "c")]), labels).count() == 600
