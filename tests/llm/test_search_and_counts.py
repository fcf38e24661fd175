"""Hard negatives, token counts and ranked search against their plain versions."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import hard_negatives, ranked_search, token_counts

from .conftest import SCHEMA, corpus, row
from .test_operators import key

# 11 hard negatives

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("cell", T.LongType()), T.StructField("place", T.LongType())])


def vectors(seed=1, n=260, every=20):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        v = [round(rng.gauss(0.4, 0.5), 2) for _ in range(rng.choice([6, 6, 6, 6, 5]))]
        rows.append((k, v, rng.randrange(4)))
    one = [0.5, 0.25, 1.0, 0.0, 0.5, 0.5]
    rows += [(1000 + k, one, k % 2) for k in range(30)]  # ties
    rows += [rows[3], rows[3], rows[every], (every, one, 2), (None, one, 1), (None, None, None), (5000, None, 1),
             (5020, [1.0, None], 1), (5040, [1.0, float("nan")], 1), (5060, [float("inf")], 0), (5080, one, None),
             (5100, [], 1), (5120, [-1.0] * 6, 3)]
    rng.shuffle(rows)
    return [(*r, "k", "s", 7, 9) for r in rows]


def plain_negatives(rows, every):
    usable = []
    for vec_id, v, label, *_ in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * float(np.float32(x))) for x in v]
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((vec_id, label, tuple(ints)))
    late = float("inf")
    out = []
    for anchor in {r for r in usable if r[0] is not None and r[0] % every == 0}:
        scored = [(-sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), late if r[0] is None else r[0], r[1])
                  for r in usable if r[0] != anchor[0]]
        scored.sort()
        for p, p_id, _ in [s for s in scored if s[2] == anchor[1]][:5]:
            near = [s for s in scored if s[2] != anchor[1] and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(anchor[0], None if p_id == late else p_id, k, None if n_id == late else n_id, -p, -n)
                    for k, (n, n_id, _) in enumerate(near, 1)]
    return out


@pytest.mark.parametrize("cells", [{}, {"cell_candidates": 40, "cell_anchors": 5}])
def test_hard_negatives(spark, monkeypatch, cells):
    monkeypatch.setattr(hard_negatives, "TILE_CANDIDATES", 16)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 3)
    rows = vectors()
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    ints = hard_negatives.integer_rows(table)
    moved = ints.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    got = hard_negatives.mine(moved, anchor_every=20, **cells).collect()
    want = plain_negatives(rows, 20)
    assert len(want) > 100 and key(want) == key(tuple(r) for r in got)


def test_no_hard_negatives(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(hard_negatives.integer_rows(none)).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1, "", "", 1, 1), (1, [1.0], 2, "", "", 1, 1)], VECTORS)
    assert hard_negatives.mine(hard_negatives.integer_rows(alone)).count() == 0


@pytest.mark.parametrize("most", [256, 1 << 30])
def test_strassen_is_exact(most):
    rng = np.random.default_rng(4)
    for shape in [(1, 1, 1), (5, 3, 7), (33, 64, 40), (70, 130, 65), (64, 64, 64), (2, 300, 2), (0, 4, 3), (4, 0, 3)]:
        a = rng.integers(-most, most, shape[:2])
        b = rng.integers(-most, most, shape[1:])
        assert (hard_negatives.product(a, b) == a @ b).all()


def test_heaps_merge():
    rng = random.Random(3)
    rows = [(rng.randrange(6), rng.randrange(8), rng.randrange(50)) for _ in range(400)]
    heaps = hard_negatives.Heaps(6, 5)
    for part in itertools.batched(rows, 37):
        heaps.push(*(np.array(x) for x in zip(*part, strict=True)))
    want = [r for s in range(6) for r in sorted((r for r in rows if r[0] == s), key=lambda r: (-r[1], r[2]))[:5]]
    assert want == list(zip(heaps.slot.tolist(), heaps.score.tolist(), heaps.id.tolist(), strict=True))


# 12 token counts

@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter()


def library_count(counter, text):
    return len(counter.library.encode(text, add_special_tokens=False).ids)


ODD = ["a", "th", "ing", "'", "'s", "'re", "'R", "E", " ", "  ", "\n", "é", "é", "́", "Σ", "İ", "日本", "ㅎ", "한", "가",
       "ᆨ", "1", "23", "½", "Ⅷ", "!", "--", "_", "<|endoftext|>", "<|endof", "<|startoftext|>", "<|", "͸", "Ᲊ",
       "ß", "ñ", "ো", "া", "ﬁ", "\x85", "\xa0", "​", "\x1c", "zzzz", "�", "😀", "👩‍👧"]


def test_every_prefix_has_the_library_count(counter):
    rng = random.Random(11)
    for _ in range(700):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(12)))
        assert counter.counts(text).tolist() == [library_count(counter, text[:k]) for k in range(1, len(text) + 1)], repr(text)


def test_prefixes_of_prose(counter):
    for _, text, *_ in corpus(4, 30):
        text = (text or "")[:400]
        assert counter.counts(text).tolist() == [library_count(counter, text[:k]) for k in range(1, len(text) + 1)]


def test_kept_tables_do_not_change_counts(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 3)
    monkeypatch.setattr(token_counts, "KEPT_PREFIXES", 5)
    monkeypatch.setattr(token_counts, "KEPT_PAIRS", 4)
    own = token_counts.PrefixCounter()
    for _, text, *_ in corpus(5, 20):
        counts = own.counts(text or "")
        assert (int(counts[-1]) if len(counts) else 0) == library_count(own, text or "")


def test_the_tasks_of_a_worker_share_a_counter(monkeypatch, counter):
    made = []
    monkeypatch.setattr(token_counts, "PrefixCounter", lambda name: made.append(name) or counter)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["one two", None, "one two"]})
    name = f"{token_counts.VOCABULARY}-shared"  # not one of a task before
    got = [b.column("n_tokens").to_pylist() for _ in range(2) for b in token_counts._counter(name, 60, False)(iter([batch]))]
    token_counts._kept_counter.cache_clear()
    assert made == [name] and got[0] == got[1] == [2, 0, 2]


def test_token_counts_of_a_table(small, counter):
    rows, docs = small
    got = token_counts.digests(docs, limit=60).collect()
    want = []
    for doc_id, text, *_ in rows:
        counts = counter.counts(text or "").tolist()
        total = library_count(counter, text or "")
        want.append((doc_id, len((text or "").encode()), total, total > 60,
                     max((k for k, n in enumerate(counts, 1) if n <= 60), default=0)))
    assert key(want) == key(tuple(r) for r in got)


def test_questions_to_the_table(small, counter):
    rows, docs = small
    table = token_counts.prefix_counts(docs.where("length(text) between 1 and 500")).cache()
    got = table.select("counts", token_counts.tokens_before(F.col("counts"), F.lit(17)).alias("before"),
                       token_counts.tokens_before(F.col("counts"), F.lit(0)).alias("none"),
                       token_counts.longest_prefix(F.col("counts"), F.col("n_tokens") - 2).alias("cut")).collect()
    assert got
    for r in got:
        n = len(r["counts"])
        fits = [k for k, c in enumerate(r["counts"], 1) if c <= r["counts"][-1] - 2]
        assert (r["before"], r["none"], r["cut"]) == (r["counts"][min(17, n) - 1], 0, max(fits, default=0))


def test_no_texts_to_count(empty):
    assert token_counts.digests(empty).count() == 0


# 13 ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_search(rows, items, top=10):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    total, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c, n in docs:
            m = 100 - 90 + 90 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item_id, k, None if late else d, -s) for k, (s, late, d) in enumerate(sorted(found)[:top], 1)]
    return out


def asked(rows):
    rng = random.Random(6)
    words = sorted({w for r in rows for w in terms(r[1])} | {"absent"})
    shared = rng.sample(words, 6)
    items = [(k, " ".join(rng.sample(words, 5) + rng.sample(shared, 4))) for k in range(12)]
    return items + [(12, "Absent"), (13, None), (14, ""), (15, "!!"), (None, items[0][1]), (16, items[0][1]), items[1],
                    (17, " ".join(words[:200])), (18, "DO do Do")]


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 150}, {"top": 3}])
def test_ranked_search(small, monkeypatch, settings):
    monkeypatch.setattr(ranked_search, "HELD", 4000)
    rows, docs = small
    items = asked(rows)
    table = docs.sparkSession.createDataFrame(items, "item_id long, text string")
    got = ranked_search.search(docs, table, **settings).collect()
    want = plain_search(rows, items, settings.get("top", 10))
    assert len(want) > 50 and key(want) == key(tuple(r) for r in got)


def test_nothing_to_search(small, empty):
    _, docs = small
    items = docs.sparkSession.createDataFrame([(1, "one two")], "item_id long, text string")
    assert ranked_search.search(empty, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0


def test_shared_sets_are_added_once():
    rng = random.Random(8)
    sets = [rng.sample(range(40), 8) for _ in range(5)]
    items = [sorted({*sets[k % 5], *sets[(k * 3 + 1) % 5], 40 + k}) for k in range(20)] + [[], [3]]
    sums = ranked_search.SharedSums(items, 60)
    parts = np.array([[rng.randrange(100) for _ in range(7)] for _ in range(60)], dtype=np.int64)
    assert (sums.scores(parts) == np.array([parts[own].sum(axis=0) for own in items])).all()
    assert sums.additions() < 0.5 * sum(max(len(x) - 1, 0) for x in items)


def test_long_and_repeated_texts(spark):
    rows = [row(1, "word " * 50_000 + "rare"), row(2, "rare"), row(2, "rare"), row(3, "x" * 100_000)]
    items = [(1, "rare " + "x" * 100_000)]
    got = ranked_search.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert key(plain_search(rows, items)) == key(tuple(r) for r in got.collect())
