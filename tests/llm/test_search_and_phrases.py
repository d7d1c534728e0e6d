"""Exact dedup, ranked search and phrase mining against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, phrases, ranked_search
from tidemark.llm.exact_dedup import PerfectHash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, digest string, of string"
ITEMS = "item_id long, text string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def prose(seed, n_docs, n_words=60, kinds=40):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeghilmnorstuéñ") for _ in range(draw.randint(1, 6))) for _ in range(kinds)]
    weights = [1 / (k + 1) for k in range(kinds)]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ".\n", "; ", "-"]
    return ["".join(w + draw.choice(ends) for w in draw.choices(vocabulary, weights, k=n_words)) for _ in range(n_docs)]


@pytest.fixture(scope="module")
def rows():
    texts = prose(3, 60) + [None, "", " \t\n ", "one", "ONE", "a  b", "a\nb", "a b ", "x" * 100_000, "long, word " * 20_000,
                            "New York is New-York. new york", "...", "Ünï cödé \x0b wörds \x00 \x1c end"]
    texts += [texts[0]] * 5 + [texts[1].replace(" ", "\n ")] * 3
    found = [(k, t, ["en", "de", None, "und"][k % 4], None, 1, "a", "b", "c") for k, t in enumerate(texts)]
    return found + [(None, "a b", "en", None, 1, "", "", ""), (None, "lonely", "en", None, 1, "", "", ""), found[3], found[3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Exact dedup


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000])
def test_perfect_hash_is_a_bijection(n):
    draw = np.random.default_rng(n)
    words = draw.integers(0, 2**63, (n, 4), dtype=np.uint64)
    words[: n // 2, 0] = 5  # digests that differ in one word only
    hashed = PerfectHash.over(words, 1.6)
    assert sorted(hashed.slots(words).tolist()) == list(range(n))
    again = PerfectHash.unpacked(*hashed.packed())
    assert (again.slots(words) == hashed.slots(words)).all()
    strangers = again.slots(draw.integers(0, 2**63, (100, 4), dtype=np.uint64))
    assert strangers.max(initial=-1) < max(n, 1)


def by_text(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    return groups


@pytest.mark.parametrize("recent", ["true", "false", "doc_id % 3 = 0", None])
@pytest.mark.parametrize("slots", [3, 2048])
def test_exact_copies(spark, docs, rows, recent, slots):
    expected = []
    for text, ids in by_text(rows).items():
        keep = min((k for k in ids if k is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(k, keep, len(ids), k == keep, digest) for k in ids]
    found = exact_dedup.exact_copies(
        spark, docs, F.expr(recent) if recent else None, exact_dedup.DigestParams(slots=slots))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_known_tells_what_history_held(spark, docs, workspace):
    found = exact_dedup.deliver(spark, docs, F.col("doc_id") >= 73, workspace).collect()
    texts = {r.doc_id: r for r in found}
    assert texts[73].known and texts[73].keep_id == 0 and texts[0].known is None
    assert {r.known for r in found if r.doc_id is None} == {True, False}  # "a b" is known, "lonely" is not


def test_without_copies(spark, docs, rows, empty):
    kept = exact_dedup.without_copies(spark, docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len(by_text(rows))
    assert Counter(r.doc_id for r in got) == Counter(
        min((k for k in ids if k is not None), default=None) for ids in by_text(rows).values())
    assert exact_dedup.without_copies(spark, empty).collect() == []
    assert exact_dedup.exact_copies(spark, empty).collect() == []


# Ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def ranked(rows, items, top):
    counted = [(r[0], Counter(terms(r[1]))) for r in rows if terms(r[1])]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc_id, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if c[t])
            if score:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item, k + 1, x[2], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return out


@pytest.fixture(scope="module")
def items():
    texts = prose(3, 12, 15) + ["", "nothing-like zzzzz", "...", "one", "long word word", "Ünï cödé New York", None]
    return [(k, t) for k, t in enumerate(texts)] + [(None, "a b"), (2, prose(3, 12, 15)[2])]


@pytest.mark.parametrize("params", [
    ranked_search.SearchParams(),
    ranked_search.SearchParams(top=3, first_read=1, shard_postings=50),
    ranked_search.SearchParams(top=200, first_read=2, block_bytes=300, salts=2),
])
def test_search_equals_brute_force(spark, docs, rows, items, params):
    got = ranked_search.search(spark, docs, spark.createDataFrame(items, ITEMS), params)
    expected = ranked(rows, [(k, t) for k, t in items[:-1] if t is not None], params.top)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_search_ends_before_the_lists_do(monkeypatch):
    """Reads stop once no interval that matters is open."""
    n, p = 20_000, ranked_search.SearchParams(top=5, first_read=16)
    tf = np.where(np.arange(n) < 5, 50, 1)
    lists = ranked_search.Lists(
        list(range(n)), np.full(n, 100), [np.array([0, 1], np.int32)] * n, [np.array([c, c], np.int64) for c in tf], n, 100 * n)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.read += key.stop - key.start
            return np.asarray(self)[key]

    lists.doc = lists.doc.view(Counted)
    best, scores = ranked_search.nra(lists, [(0, 10), (1, 7)], 1, p)
    assert best.tolist() == [0, 1, 2, 3, 4] and len(set(scores.tolist())) == 1
    assert Counted.read < n // 10


def test_search_without_rows(spark, docs, empty, items):
    some = spark.createDataFrame(items, ITEMS)
    assert ranked_search.search(spark, empty, some).collect() == []
    assert ranked_search.search(spark, docs, spark.createDataFrame([], ITEMS)).collect() == []


# Phrases


def collocations(rows, top, least):
    f, total = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(r[1])):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, 5):
                f[lang].update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        gone = {
            g[i : i + size] for g, a in found.items() for size in range(2, len(g)) for i in range(len(g) - size + 1)
            if 100 * a >= 80 * counts[g[i : i + size]]}
        rows = []
        for g, a in found.items():
            score, k = min((2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g)))
            if g not in gone:
                rows.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, k + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for k, x in enumerate(sorted(rows)[:top])]
    return out


@pytest.fixture(scope="module")
def chatter():
    """Fixed expressions of two to five words in random words, so that phrases grow and swallow others."""
    draw = random.Random(11)
    fixed = ["new york", "as well as", "in spite of the", "at the end of the", "to and fro", "of the of the"]
    words = [f"w{k}" for k in range(25)] + ["the", "of", "the", "of", "to"]
    texts = []
    for _ in range(120):
        texts.append(" ".join(draw.choice(fixed) if draw.random() < 0.3 else draw.choice(words) for _ in range(50)))
    return [(k, t, ["en", "de"][k % 2], None, 1, "", "", "") for k, t in enumerate(texts)]


@pytest.mark.parametrize("params", [
    phrases.PhraseParams(least=4),
    phrases.PhraseParams(least=4, top=3, slack=1),
    phrases.PhraseParams(least=3, top=25, slack=1, filter_bits=64),
    phrases.PhraseParams(least=5, top=40, slack=2, part_bytes=200, salts=2),
])
def test_phrases_equal_brute_force(spark, chatter, params):
    docs = spark.createDataFrame(chatter, DOCS).repartition(3)
    got = phrases.collocations(spark, docs, params).collect()
    assert sorted(map(tuple, got)) == sorted(collocations(chatter, params.top, params.least))


def test_phrases_of_odd_rows(spark, docs, rows, empty):
    got = phrases.collocations(spark, docs, phrases.PhraseParams(least=2, top=50)).collect()
    assert sorted(map(tuple, got)) == sorted(collocations(rows, 50, 2))
    assert phrases.collocations(spark, empty).collect() == []


def test_frontier_leaves_phrases_uncounted(spark, chatter):
    """A short report needs only the best nodes: phrases of three words below the bound are never counted."""
    docs = spark.createDataFrame(chatter, DOCS)
    few = phrases.Collocations(spark, docs, phrases.PhraseParams(least=4, top=3, slack=1))
    all_of_them = phrases.Collocations(spark, docs, phrases.PhraseParams(least=4))
    few.expand(), all_of_them.expand()
    assert 0 < few.long.count() < all_of_them.long.count()


def test_counts_beyond_64_bits(spark):
    a = spark.createDataFrame([(9 * 10**18, 9 * 10**18), (3 * 10**18, 10**18 * 7)], "a long, b long")
    got = a.select(phrases._ratio(F.col("a"), F.col("a").cast("decimal(20,0)") + F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == [1_000_000, 2_000_000 * 3 // 10]
