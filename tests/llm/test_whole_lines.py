"""Line dedup as the query and the pipeline run it: lines of any length, and what it misses of edit similarity alone."""

import random

import numpy as np

from tessera.llm import components, edit, line_dedup, line_sims, queries, simhash

from . import brute
from .conftest import SCHEMA, row


def removed(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return {r["doc_id"]: r["n_removed"] for r in queries.op8_fuzzy_line_dedup(spark, str(tmp_path)).collect()}


def test_equal_lines_of_any_length(spark, tmp_path):
    rows = [row(1, "All rights reserved.\nmenu\n日本語の長い行です"), row(2, "MENU\nall rights  reserved\n日本語の長い行です"),
            row(3, "ok\nOK!\n***\n\n***"), row(4, "nothing here comes again")]
    assert removed(spark, tmp_path, rows) == {1: 0, 2: 3, 3: 1, 4: 0}


def test_a_changed_word_in_a_short_line(spark, tmp_path):
    line = "please accept all cookies before reading this page"
    rows = [row(1, line), row(2, line.replace("reading", "opening")), row(3, "a line that is not like those at all")]
    assert removed(spark, tmp_path, rows) == {1: 0, 2: 1, 3: 0}


def test_recall_against_edit_similarity_alone(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghé日") for _ in range(rng.randrange(2, 10))) for _ in range(600)]
    texts = []
    for _ in range(36):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 8, 12, 20]))]
        texts.append(" ".join(base))
        for _ in range(2):
            own = list(base)
            for _ in range(max(1, len(own) // 8)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    rng.shuffle(texts)
    rows = [row(k, "\n".join(texts[k::40])) for k in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) h").collect()}
    want = brute.lost_lines([(d, hashes[t], t) for d, t, *_ in rows], None)
    want = {(*doc, k) for doc, own in want.items() for k in own}
    found = line_dedup.removed_lines(docs, hot=50).collect()
    got = {(r["doc_id"], r["text_hash"], k) for r in found for k in r["lines"]}
    assert got <= want and len(want) > 40
    assert len(got) >= 0.3 * len(want), (len(got), len(want))  # short lines, of which an eighth is changed


def test_many_copies_make_few_pairs(spark):
    rng = random.Random(7)
    base = [f"word{rng.randrange(1000)}" for _ in range(60)]
    lines = []
    for k in range(400):
        own = list(base)
        own[k % 60] = f"other{k}"
        lines.append(" ".join(own))
    docs = spark.createDataFrame([row(k, line) for k, line in enumerate(lines)], SCHEMA).repartition(3)
    left = line_dedup.dedup(docs).collect()
    assert [r["doc_id"] for r in left] == [0]
    sims = spark.createDataFrame([(k, 9000, None, 0, None, 0) for k in range(500)],
                                 "hash long, size int, sim0 long, sim1 long, sim2 long, grp long")
    assert line_sims.near_pairs(sims).count() <= 28 * 2 * 500
    assert line_sims.near_pairs(sims, across=True).count() == 0
    assert line_sims.near_pairs(sims.withColumn("grp", sims["hash"] % 2), across=True, hot=200).count() == 250 * 250


def test_very_long_line(spark):
    long = " ".join(f"w{k * 7919 % 10007}" for k in range(8000))
    rows = [row(1, long), row(2, long.replace("w77 ", "other ")), row(3, long[: len(long) // 2]), row(4, "z" * 50_000)]
    found = line_dedup.removed_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["doc_id"] for r in found] == [2]


def test_empty_table(empty):
    assert line_dedup.digests(empty).count() == 0


def test_texts_of_one_id_are_judged_by_themselves(spark):
    text = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    docs = spark.createDataFrame([row(1, text), row(5, text), row(5, other), row(7, other)], SCHEMA)
    left = sorted((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect())
    assert left == [(1, text), (5, other)]


def _brute_pairs(rows, bits):
    """Lines of one family within ``bits`` that agree in two of eight blocks."""
    out = set()
    for k, (a, x) in enumerate(rows):
        for b, y in rows[:k]:
            differ = (x ^ y).to_bytes(8, "little")
            if (x ^ y).bit_count() <= bits and differ.count(0) >= 2:
                out.add((min(a, b), max(a, b)))
    return out


def test_a_line_travels_once_for_each_block_and_meets_the_same_lines(spark):
    rng = random.Random(11)
    bases = [rng.getrandbits(63) for _ in range(30)]
    rows = []
    for k in range(400):
        sim = bases[k % 30]
        for _ in range(rng.randrange(10)):
            sim ^= 1 << rng.randrange(63)
        rows.append((k, sim))
    want = _brute_pairs(rows, 8)
    lines = spark.createDataFrame([(k, 9000, None, s, None, k) for k, s in rows],
                                  "hash long, size int, sim0 long, sim1 long, sim2 long, grp long")
    for hot in (line_sims.HOT, 10, 1):  # whole cells, cells split by the second block, and parts of those
        assert {tuple(r) for r in line_sims.near_pairs(lines, across=True, hot=hot).collect()} == want
        first = {tuple(r) for r in line_sims.near_pairs(lines, hot=hot).collect()}
        assert first <= want and {x for p in first for x in p} == {x for p in want for x in p}
    sims = np.array([s for _, s in rows], dtype=np.uint64)
    sent = sum(len(at) for _, at in line_sims._Cells(len(rows), False).of(1, sims))
    assert sent == 7 * len(rows)


def test_edit_distances_of_many_pairs_at_once():
    rng = random.Random(3)
    xs, ys = [], []
    for _ in range(600):
        letters = rng.choice(["ab", "abcdef", "abé日本語𝒳"])
        x = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 130])))
        y = list(x) if rng.random() < 0.6 else [rng.choice(letters) for _ in range(rng.choice([0, 2, 64, 128]))]
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(y) + 1)
            y[k:k + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
        xs.append(x)
        ys.append("".join(y))

    def plain(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            old, row = row, [i]
            for j, d in enumerate(y, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (c != d)))
        return row[-1]

    want = [plain(x, y) for x, y in zip(xs, ys, strict=True)]
    assert edit.distances(xs, ys).tolist() == want
    alike = [d <= int(max(len(x), len(y)) * (1 - 0.8) + 1e-9) for d, x, y in zip(want, xs, ys, strict=True)]
    assert edit.similar(xs, ys, 0.8).tolist() == alike


def test_links_contracted_by_one_task_need_no_round(spark, monkeypatch):
    def no_round(*_):
        raise AssertionError("a round was run")
    monkeypatch.setattr(components, "_star", no_round)
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (3, 4), (9, 8), (5, 5)], "a long, b long").coalesce(1)
    found = {tuple(r) for r in components.components(edges).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7)}
