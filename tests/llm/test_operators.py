"""Every operator against its plain version on a small table with nulls, copies, long texts and clashing columns."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import (
    bin_completion,
    decontam,
    langid,
    line_dedup,
    line_sims,
    lm_score,
    ordinal,
    packing,
    quality_rules,
    simhash,
    substring,
    toxicity,
)
from tessera.llm.common import mix, window_hashes
from tessera.llm.lattice import MARK, Lattice, Vocabulary, normalised

from . import brute
from .conftest import SCHEMA, row


def key(values):
    return Counter(map(repr, values))


# 1 packing

def check_packing(rows, packed, capacity=2048):
    by_doc, lengths = defaultdict(list), []
    for r in packed:
        by_doc[r["doc_id"]].append(r)
    want = []
    for doc_id, text, *_ in rows:
        own = brute.ids(text)
        cuts = [0, *range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
            crc = zlib.crc32(np.array(own[s:e], dtype="<u4").tobytes())
            want.append((doc_id, k, s, e - s, crc))
            lengths.append(e - s)
    assert key(want) == key((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= -(-sum(lengths) // capacity) + 1


def test_packing(small):
    rows, docs = small
    check_packing(rows, packing.pack_documents(docs).collect())


def test_packed_sequences_hold_the_ids(small):
    rows, docs = small
    packed = packing.pack_documents(docs, with_ids=True).cache()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_packing_buckets_do_not_change_the_plan(small, monkeypatch):
    rows, docs = small
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    check_packing(rows, packing.pack_documents(docs).collect())


def exhaustive(lengths, capacity):
    """Fewest bins, by trying every placement."""
    best = len(lengths)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity:
                put(k + 1, bins[:i] + [bins[i] + lengths[k]] + bins[i + 1:])
        put(k + 1, [*bins, lengths[k]])

    put(0, [])
    return best


def test_bin_completion_is_least_on_small_cases():
    rng = np.random.default_rng(5)
    for _ in range(60):
        capacity = int(rng.integers(8, 30))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 9))).tolist()
        counts = np.bincount(lengths, minlength=capacity + 1)
        plan = bin_completion.bin_completion(counts, capacity)
        held = Counter()
        for times, filling in plan:
            assert sum(filling) <= capacity
            for x in filling:
                held[x] += times
        assert held == Counter(lengths)
        least = exhaustive(sorted(lengths, reverse=True), capacity)
        assert sum(t for t, _ in plan) == least >= bin_completion.fewest(counts, capacity)


def test_bin_completion_beats_best_fit_on_many_lengths():
    rng = np.random.default_rng(1)
    even, middle = rng.integers(1, 2049, 20_000), rng.integers(300, 1101, 5000)
    skewed = np.clip(rng.lognormal(6, 1, 200_000), 1, 2048).astype(int)
    for lengths, most_over in ((even, 3), (middle, 12), (skewed, 12)):
        counts = np.bincount(lengths, minlength=2049)
        plan = bin_completion.bin_completion(counts, 2048)
        held = np.zeros(2049, dtype=np.int64)
        for times, filling in plan:
            assert sum(filling) <= 2048
            for x in filling:
                held[x] += times
        assert (held == counts).all()
        used = sum(t for t, _ in plan)
        assert used <= sum(t for t, _ in bin_completion.best_fit(counts, 2048))
        assert used <= bin_completion.fewest(counts, 2048) + most_over


def test_an_unfinished_filling_does_not_count():
    lengths = list(range(1, 400))
    counts = [0, *[1] * 399]
    for _, filling in bin_completion.fillings(5000, lengths, counts, 5000):
        left = 5000 - sum(filling)
        assert not [x for x in lengths if x <= left and counts[x] > filling.count(x)]


# 2 language model

def test_lattice_against_recursion():
    own = Vocabulary()
    rng = np.random.default_rng(1)
    logp = own.initial + rng.normal(size=own.size) * 0.1
    words = [b"the", b"", "é☃a".encode(), b"thtion", "日本x".encode()]
    got = Lattice(own, words).log_probability(logp)
    want = [np.log(brute.lattice(w.decode(), own.pieces, own.of_byte, logp)) for w in words]
    assert np.allclose(got, want)
    # expected uses are the derivative of the log probability by the log weights
    counts = np.array([2.0, 1, 3, 1, 1])
    uses = Lattice(own, words).expected(logp, counts)
    for piece in np.flatnonzero(uses > 0.01)[:12]:
        moved = logp.copy()
        moved[piece] += 1e-5
        slope = (Lattice(own, words).log_probability(moved) - got) @ counts / 1e-5
        assert abs(slope - uses[piece]) < 1e-3
    assert abs(np.exp(own.initial).sum() - 1) < 1e-9 and MARK in own.pieces


def test_lm_scores(small):
    rows, docs = small
    got = lm_score.score(docs, frequent=30).collect()
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, *_ in rows]
    tokens = [[*brute.words((t or "").translate(brute._AZ)), None] for _, t, *_ in rows]
    count = Counter(w for own, h in zip(tokens, held, strict=True) if not h for w in own)
    n, v = sum(count.values()), len(count)
    want = [(d, h, len(own), sum(count[w] > 0 for w in own), n,
             round(float(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in own)), 5))
            for (d, *_), h, own in zip(rows, held, tokens, strict=True)]
    assert key(want) == key((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                             round(r["base_score"], 5)) for r in got)
    again = lm_score.score(docs, frequent=100_000).collect()
    assert all(abs(a["score"] - b["score"]) < 1e-6 for a, b in zip(
        sorted(got, key=lambda r: (r["doc_id"] or -99, r["base_score"])),
        sorted(again, key=lambda r: (r["doc_id"] or -99, r["base_score"])), strict=True))
    # the model is a distribution: its value for a word follows from counts and the lattice
    distinct = sorted(w for w in count if w is not None)
    own = Vocabulary()
    spark_words = docs.sparkSession.createDataFrame([(bytearray(w.encode()),) for w in distinct], "word binary")
    logp = lm_score.fit_pieces(spark_words)
    p = {None: count[None]}
    for w in {w for t in tokens for w in t}:
        q = np.exp(logp[own.end]) if w is None else np.exp(
            Lattice(own, [w.encode()]).log_probability(logp)[0])
        p[w] = max(count[w] - 0.75, 0) / n + 0.75 * v / n * q
    best = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 5)): r["score"] for r in got}
    for (d, *_), t, w in zip(rows, tokens, want, strict=True):
        total, before = 0.0, Counter()
        for m, x in enumerate(t):
            a = 0.3 * m / (m + 20)
            total += np.log10((1 - a) * p[x] + (a * before[x] / m if m else 0))
            before[x] += 1
        assert best[d, len(t), w[5]] == pytest.approx(total, abs=1e-5)


def test_pieces_are_fitted_to_all_words_in_every_round(spark):
    own = Vocabulary()
    words = spark.range(45_000).selectExpr("encode(lower(conv(id * 7919, 10, 26)), 'utf-8') AS word")
    lattice = Lattice(own, [bytes(r[0]) for r in words.collect()])
    logp = own.initial
    for _ in range(4):
        logp = normalised(lattice.expected(logp, np.ones(45_000)))
    got = lm_score.fit_pieces(words)
    assert np.allclose(got, logp, atol=1e-6)


# 3 language

def test_marginals_against_enumeration(monkeypatch):
    from itertools import product
    monkeypatch.setattr(langid, "BLOCK", 3)
    rng = np.random.default_rng(2)
    lengths = np.array([1, 7, 3, 5])
    weights, transition = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got, at = langid.marginals(weights, lengths, transition), 0
    for n in lengths:
        total = np.zeros((n, 3))
        for y in product(range(3), repeat=int(n)):
            s = np.exp(sum(weights[at + i, y[i]] for i in range(n)) + sum(
                transition[y[i - 1], y[i]] for i in range(1, n))) * np.exp(transition[:, y[0]]).sum()
            total[np.arange(n), list(y)] += s
        assert np.allclose(total / total.sum(axis=1, keepdims=True), got[at:at + n])
        at += n


def test_language_on_held_out_rows(spark):
    from tessera.llm.common import documents
    docs = documents(spark, "/root/testdata/sf0.01")
    got = {r["doc_id"]: r for r in langid.predict(docs).collect()}
    held = [r for r in docs.collect() if got[r["doc_id"]]["held_out"]]
    assert len(got) == docs.count() and len(held) > 100
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_edges(small, empty):
    rows, docs = small
    got = langid.predict(docs).collect()
    assert key(d for d, *_ in rows) == key(r["doc_id"] for r in got)
    for r in got:
        if r["doc_id"] in (0, 1, 2, 3):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in got} <= {"en", "und"}
    assert langid.words_of("²³ 12 _") == []


def _two_languages():
    rng = np.random.default_rng(7)
    own = {"aa": ["kata", "mako", "tika", "okami", "nato"], "bb": ["brenz", "sturl", "glorf", "wurst", "pfling"]}
    texts = [(lang, " ".join(rng.choice(words, 60))) for lang, words in own.items() for _ in range(30)]
    return own, langid.fit(texts), rng


def test_words_of_a_text_that_changes_language():
    own, model, rng = _two_languages()
    for switch in (1, 20, 45):
        words = [*rng.choice(own["aa"], switch), *rng.choice(own["bb"], 50 - switch)]
        m = langid.marginals(model.weights.of(words), np.array([50]), model.transition)
        got = [model.languages[k] for k in m.argmax(axis=1)]
        assert got == ["aa"] * switch + ["bb"] * (50 - switch)


def test_all_of_a_long_word_counts():
    own, model, _ = _two_languages()
    middle = {lang: "x" * 60 + "".join(words) * 4 + "x" * 60 for lang, words in own.items()}
    weights = model.weights.of([middle["aa"], middle["bb"]])
    assert [model.languages[k] for k in weights.argmax(axis=1)] == ["aa", "bb"]


# 4 near-duplicates

def test_simhash(small):
    rows, docs = small
    prints = [(d, brute.simhash(t)) for d, t, *_ in rows]
    want = key((d, f, c) for (d, f), c in zip(prints, brute.components(prints), strict=True))
    got = simhash.near_duplicates(docs).collect()
    assert want == key((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got)


def test_simhash_keeps_one_of_each(small):
    rows, docs = small
    prints = [(d, brute.simhash(t)) for d, t, *_ in rows]
    gone = {d for (d, _), c in zip(prints, brute.components(prints), strict=True) if d is not None and d != c}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert key(d for d, *_ in rows if d not in gone) == key(r["doc_id"] for r in kept.collect())


@pytest.mark.parametrize("hot", [4, 2048])
def test_links_of_random_and_close_fingerprints(spark, hot):
    rng = np.random.default_rng(hot)
    base = rng.integers(0, 2**63, 40)
    close = [int(b) ^ sum(1 << int(k) for k in rng.integers(0, 63, rng.integers(0, 6))) for b in base for _ in range(6)]
    prints = [(k, x) for k, x in enumerate(dict.fromkeys(close))]
    nodes = spark.createDataFrame([(x,) for _, x in prints], "fp long")
    from tessera.llm.components import components
    from tessera.llm.hamming import forest
    edges = forest(simhash.ring_keys(nodes), simhash.pigeonring(), hot)
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    want = brute.components(prints)
    groups, got = defaultdict(set), defaultdict(set)
    for (_, x), c in zip(prints, want, strict=True):
        groups[c].add(x)
        got[root.get(x, x)].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


# 5 substrings

def test_repeated_windows(small):
    rows, docs = small
    for window in (50, 14):
        gone = brute.repeats([(d, t) for d, t, *_ in rows], window)
        want = key((d, len(brute.words(t)), len(g), brute.kept_digest(t, g)) for (d, t, *_), g in zip(rows, gone, strict=True))
        got = substring.digests(docs, window).collect()
        assert want == key((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)


def test_repeated_windows_in_small_shards(small):
    rows, docs = small
    spans = substring.repeated_spans(docs, 20, bitmap_bits=1 << 15, shard_words=200, hot=3).collect()
    gone = brute.repeats([(d, t) for d, t, *_ in rows], 20)
    want = defaultdict(set)
    for (d, *_), g in zip(rows, gone, strict=True):
        want[d] |= g
    got = defaultdict(set)
    for r in spans:
        for s in r["spans"]:
            got[r["doc_id"]].update(range(s["start"], s["end"]))
    assert {d: g for d, g in want.items() if g} == got


def test_removed_text(small):
    rows, docs = small
    got = key((r["doc_id"], r["text"]) for r in substring.remove_repeats(docs).collect())
    gone = brute.repeats([(d, t) for d, t, *_ in rows], 50)
    assert got == key((d, " ".join(w for k, w in enumerate(brute.words(t)) if k not in g) if g else t)
                      for (d, t, *_), g in zip(rows, gone, strict=True))


# 6 quality

def test_ordinal_grades_on_held_out_rows(spark):
    from tessera.llm.common import documents, table
    docs, labels = documents(spark, "/root/testdata/sf0.01"), table(spark, "/root/testdata/sf0.01", "labels")
    got = {r["doc_id"]: r for r in ordinal.grade(docs, labels.selectExpr("doc_id", "quality * (2 - toxic) as grade")).collect()}
    held = [r for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([got[r["doc_id"]]["selected"] == (r["quality"] == 1) for r in held]) > 0.95
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail_probability"] <= 1 for r in got.values())


def test_ordinal_edges(spark, small):
    rows, docs = small
    for grades in ([], [(12, 1)], [(k, k % 4) for k in range(10, 30)] + [(None, 1), (12, None), (12, 2)]):
        ratings = spark.createDataFrame(grades, "doc_id long, grade int")
        got = ordinal.grade(docs, ratings).collect()
        assert key(d for d, *_ in rows) == key(r["doc_id"] for r in got)
    model = ordinal.fit([(k % 3, "poor " * 9 if k % 3 == 0 else "fair enough" if k % 3 == 1 else "Good, well made.")
                         for k in range(60)])
    assert list(model.thresholds) == sorted(model.thresholds)
    tails = model.tails([b"poor " * 9, b"fair enough", b"Good, well made."], ordinal._Tokens())
    assert list(tails.sum(axis=1)) == sorted(tails.sum(axis=1))


# 7 decontamination

def items_of(rows):
    words = next(t for d, t, *_ in rows if d == 10).split()
    return [(1, " ".join(words[:30])), (2, " ".join(words[20:26])), (3, "one"), (4, None), (5, "!!"), (11, "One Two"),
            (11, "One Two"), (None, " ".join(words[5:25])), (7, "not in any of these")]


@pytest.mark.parametrize("window,block", [(13, 1 << 24), (3, 1 << 24), (13, 60)])
def test_decontamination(spark, small, window, block):
    rows, docs = small
    items = items_of(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = [(d, n, len(h), names, len(h) > 0 and 20 * len(h) >= n) for (d, *_), (n, h, names) in zip(
        rows, brute.hits([t for _, t, *_ in rows], items, window), strict=True)]
    got = decontam.judged(decontam.find(docs, benchmark, window, block, shard_bytes=5000)).collect()
    assert key(want) == key((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got)
    for r in got:
        ends = [e for s in r["spans"] for e in (s["start"], s["end"])]
        assert ends == sorted(set(ends))
    kept = decontam.keep_clean(docs, benchmark, window, block_bytes=block)
    assert kept.columns == docs.columns
    assert key(d for d, _, _, _, bad in want if not bad) == key(r["doc_id"] for r in kept.collect())


def test_empty_benchmark(spark, small):
    rows, docs = small
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert not [r for r in decontam.find(docs, benchmark).collect() if r["spans"] or r["items"]]
    assert decontam.keep_clean(docs, benchmark).count() == len(rows)


# 8 lines

def sims_of(line):
    """A normalised line's fingerprints, gram by gram."""
    out, codes = [], np.array([ord(c) for c in line], dtype=np.uint64)
    for gram, least, most in line_sims.FAMILIES:
        if not max(least, gram) <= len(line) <= most:
            out.append(None)
            continue
        hashes = mix(window_hashes(codes, gram) + np.uint64(gram)) >> np.uint64(24)
        own = mix(np.array(sorted(set(hashes.tolist())), dtype=np.uint64)).tolist()
        out.append(sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in own) > len(own)))
    return out


def test_fingerprints_of_lines(monkeypatch):
    monkeypatch.setattr(line_sims, "GRAMS", 100)
    texts = ["Ab c, d\n\n  x \nThe 3rd line, which is somewhat longer than all those others", "日本語 の 行", "é" * 700, "a " * 300]
    lines = line_dedup._Lines([t.encode() for t in texts])
    chars, found = lines.sims()
    own = [brute.normal_line(x) for t in texts for x in t.split("\n") if brute.normal_line(x)]
    assert [lines.text(k).decode() for k in range(len(own))] == own
    assert chars.tolist() == [len(x) for x in own]
    assert [[int(v[k]) if has[k] else None for v, has in found] for k in range(len(own))] == [sims_of(x) for x in own]


@pytest.mark.parametrize("hot", [60, 1 << 16])
def test_lines(spark, hot):
    import random
    rng = random.Random(9)
    words = [f"word{k}" for k in range(50)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(12)]
    rows = [row(0, None), row(1, ""), row(2, "too short\ntoo short"), row(None, base[0]), row(None, base[1] + "\n" + base[1])]
    for k in range(5, 20):
        lines = [rng.choice(base) for _ in range(4)]
        for i in range(4):
            if rng.random() < 0.6:
                own = lines[i].split()
                own[rng.randrange(40)] = rng.choice([*words, "WORD1", "W,1"])
                lines[i] = " ".join(own)
        rows.append(row(k, "\n".join(lines)))
    rows.append(rows[-1])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) h").collect()}
    gone = brute.lost_lines([(d, hashes[t], t) for d, t, *_ in rows], sims_of)
    got = {(r["doc_id"], r["text_hash"]): set(r["lines"]) for r in line_dedup.removed_lines(docs, hot=hot).collect()}
    assert got == dict(gone)
    assert sum(map(len, got.values())) > 20
    kept = line_dedup.dedup(docs, hot=hot)
    assert kept.columns == docs.columns
    want = []
    for d, t, *_ in rows:
        own = gone.get((d, hashes[t]))
        left = t if not own else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in own)
        if not own or left.split():
            want.append((d, left))
    assert key(want) == key((r["doc_id"], r["text"]) for r in kept.collect())


def test_lines_of_the_small_table(small):
    rows, docs = small
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) h").distinct().collect()}
    gone = brute.lost_lines([(d, hashes[t], t) for d, t, *_ in rows], sims_of)
    got = {(r["doc_id"], r["text_hash"]): set(r["lines"]) for r in line_dedup.removed_lines(docs).collect()}
    assert got == dict(gone)
    assert line_dedup.digests(docs).count() == len(rows)


# 9 quality rules

def test_quality_rules(small):
    rows, docs = small
    got = quality_rules.judge(docs).collect()
    want = [(d, *brute.quality(t, quality_rules.RUN_LIMITS).values()) for d, t, *_ in rows]
    assert key(want) == key((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                             r["base_failed"], r["kept"], r["dup_line_chars"], r["max_run_share"]) for r in got)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert key(w[0] for w in want if w[7]) == key(r["doc_id"] for r in kept.collect())


def test_repetition_verdicts(spark):
    import random
    rng = random.Random(1)
    fresh = [f"w{k}" for k in range(400)]
    line = " ".join(fresh[:12])
    texts = {"clean": " ".join(fresh[:200]), "twice": line + "\n" + " ".join(fresh[20:80]) + "\n" + line,
             "runs": " ".join(fresh[:60] + fresh[:40]), "lines": "\n".join([line] * 3 + [" ".join(fresh[20:60])])}
    rng.shuffle(fresh)
    out = quality_rules.measure([t.encode() for t in texts.values()])
    verdict = dict(zip(texts, out["kept"].tolist(), strict=True))
    assert verdict["clean"] and verdict["twice"] and not verdict["runs"] and not verdict["lines"]


# 10 toxicity

def test_grammar_weighs_clauses():
    lexicon = toxicity.Lexicon({"idiot": 4.0}, {"schuf": 3.0})
    total = {t: toxicity.Matcher(lexicon).numbers(t)[1] for t in (
        "a plain text", "an idiot", "you are an idiot", "you are not an idiot", "he said you are an idiot",
        "you idiot idiot", "kill", "i will kill you", "they will kill you", "not so. an idiot", "Schufige worte", "")}
    assert total["a plain text"] == total[""] == 0
    assert total["you are an idiot"] > total["an idiot"] > total["you are not an idiot"] > 0
    assert total["he said you are an idiot"] < total["you are an idiot"] < total["you idiot idiot"]
    assert total["kill"] < total["they will kill you"]
    assert total["not so. an idiot"] == total["an idiot"]  # a negation ends with its clause
    assert total["Schufige worte"] == 3.0


def test_composition_follows_the_parts():
    rng = np.random.default_rng(0)
    whole = toxicity.grammar()
    assert whole.states == 2 * 2 * 2 * 3 * 2
    a = toxicity.Transducer({(0, 2): (1, 3.0), (1, 4): (0, 0.5)}, 2)
    b = toxicity.Transducer({(0, 4): (1, 2.0), (1, 2): (0, 0.1)}, 2)
    both = a.compose(b)
    for _ in range(50):
        s = x = y = 0
        product = one = other = 1.0
        for c in rng.integers(0, 7, 9):
            product, s = product * both.factor[s, c], both.next[s, c]
            one, x = one * a.factor[x, c], a.next[x, c]
            other, y = other * b.factor[y, c], b.next[y, c]
        assert np.isclose(product, one * other) and s == x * 2 + y


def test_toxicity_on_held_out_rows(spark):
    from tessera.llm.common import documents, table
    docs, labels = documents(spark, "/root/testdata/sf0.1"), table(spark, "/root/testdata/sf0.1", "labels")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [r for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    found = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in held]
    right = sum(p and t for p, t in found)
    assert right >= 0.8 * sum(t for _, t in found) and right >= 0.9 * sum(p for p, _ in found)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_edges(spark, small):
    rows, docs = small
    for known in ([], [(12, 1)], [(12, 1), (13, 0), (13, None), (None, 1)]):
        labels = spark.createDataFrame(known, "doc_id long, toxic int")
        got = toxicity.score(docs, labels).collect()
        assert key(d for d, *_ in rows) == key(r["doc_id"] for r in got)
        assert all(0 <= r["score"] <= 1 for r in got)


# all

def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int, grade int, item_id long, text string")
    for out in (packing.pack_documents(empty), lm_score.score(empty), langid.predict(empty), simhash.near_duplicates(empty),
                simhash.one_of_each(empty), substring.digests(empty), ordinal.grade(empty, none),
                decontam.judged(decontam.find(empty, none)), decontam.keep_clean(empty, none), line_dedup.digests(empty),
                line_dedup.dedup(empty), quality_rules.judge(empty), quality_rules.keep_good(empty),
                toxicity.score(empty, none)):
        assert out.count() == 0
