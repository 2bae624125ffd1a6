"""Hard negatives, first-fit packing and phrases against brute force and on odd input."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartpulse.llm import firstfit, negatives, phrases

VECTORS = "vec_id long, embedding array<float>, label int, rank string, score string"
DOCS = "doc_id long, text string, lang string, source string, n string, rank string"


def brute_negatives(rows):
    """rows: vec_id, label, whole-number vector."""
    out = set()
    for a, label, v in rows:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, m) for b, m, w in rows if b != a)
        for p, positive, _ in [x for x in scored if x[2] == label][:5]:
            fits = [(s, b) for s, b, m in scored if m != label and 80 * -p <= 100 * -s <= 100 * -p]
            out |= {(a, positive, i + 1, b, -p, -s) for i, (s, b) in enumerate(fits[:5])}
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, e, label, "x", "y") for i, e, label in rows], VECTORS)


@pytest.mark.parametrize("block_bytes", [1 << 23, 64 * 8 * 2])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(negatives, "_ROWS", 64)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((3, 70))
    rows = [(i, int(i % 3), (centres[i % 3] * 40 + rng.standard_normal(70) * 30).astype(int).tolist()) for i in range(600)]
    rows += [(1000 + i, int(i % 2), rows[7][2]) for i in range(40)]  # ties
    rows += [(2000, 1, [0] * 70), (2100, 1, rows[7][2])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    got = negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, block_bytes=block_bytes).collect()
    assert {tuple(r) for r in got} == brute_negatives(rows) and len(got) == len({tuple(r) for r in got})


def test_interval_holds():
    rng = np.random.default_rng(1)
    for dims in (1, 3, 64, 100):
        rows = rng.integers(-300, 300, (300, dims))
        rows[:2] = 0
        turn = negatives.rotation(dims)
        anchors = negatives.Anchors(np.arange(300), np.zeros(300), rows, turn)
        low, high = anchors.interval(slice(0, 300), *negatives.encode(rows, turn))
        exact = negatives.scores(rows, rows)
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low)[np.arange(2, 300), np.arange(2, 300)].max() < 2.5 * (rows**2).sum(axis=1).max()


def test_intervals_discard(spark):
    """In clusters, most rows are dropped on their code alone."""
    rng = np.random.default_rng(2)
    near = rng.standard_normal(256)
    rows = (np.concatenate([near + rng.standard_normal((50, 256)) * 0.1, rng.standard_normal((950, 256))]) * 256).astype(np.int64)
    turn = negatives.rotation(256)
    anchors = negatives.Anchors(np.arange(1), np.zeros(1), rows[:1], turn)
    _, high = anchors.interval(slice(0, 1), *negatives.encode(rows, turn))
    assert (high[0] >= 0.8 * negatives.scores(rows[:1], rows[1:50]).max()).sum() < 100


def test_hard_negatives_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.5], 1), (1, [0.5, 0.4], 1), (2, [0.45, 0.45], 2), (2, [0.45, 0.45], 2), (3, [nan, 1.0], 1),
        (4, [inf, 1.0], 1), (5, None, 1), (6, [0.5, None], 1), (8, [0.5, 0.5], None), (None, [0.5, 0.5], 2), (9, [0.9], 2), (10, [], 2),
    ]
    got = {tuple(r) for r in negatives.query(vectors_of(spark, rows)).collect()}
    whole = [(0, 2, [128, 128]), (1, 1, [128, 102]), (2, 2, [115, 115]), (9, 2, [230, 0]), (10, 2, [0, 0])]
    assert got == brute_negatives(whole) and got
    assert negatives.query(vectors_of(spark, [])).count() == 0
    assert negatives.query(vectors_of(spark, [(1, [1.0], 1)])).count() == 0


def test_scores_are_exact():
    big = np.array([[1 << 29, 3]])
    assert negatives.scores(big, big)[0, 0] == (1 << 58) + 9
    with pytest.raises(OverflowError):
        negatives.scores(big * 16, big)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZé×ß \n\t.'’,#5٣日 ́ s<|>", max_size=60))
def test_segments_do_not_change_ids(text):
    known = firstfit.encoder(None)
    whole = known.model.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(known.encode([text.encode()])[0], known.dtype).tolist() == whole
    assert b"".join(firstfit.segments(text.encode())) == text.encode()


def test_special_tokens_are_text():
    known = firstfit.encoder(None)
    assert len(known.encode([b"a <|endoftext|> b"])[0]) > 2 * 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(lengths):
    lengths.sort(reverse=True)
    bins, want = [], []
    for length in lengths:
        at = next((i for i, used in enumerate(bins) if used + length <= 64), len(bins))
        bins += [0] * (at == len(bins))
        bins[at] += length
        want.append(at)
    assert firstfit.first_fit(lengths, 64) == want
    packed = firstfit.pack_group(lengths, 64)
    sizes = [sum(n for _, _, n in s) for s in packed]
    assert all(s == 64 or s & (s - 1) == 0 for s in sizes) and sum(sizes) == sum(lengths)
    ids = sorted((i, at + j) for s in packed for i, at, n in s for j in range(n))
    assert ids == [(i, j) for i, n in enumerate(lengths) for j in range(n)]


def odd_docs(spark):
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (None, "null id", "en", "a"), (3, long, "de", None),
        (4, "same text here", "en", "a"), (4, "same text here", "en", "a"), (5, " \t\n\x0b\f\r", "en", "b"),
        (6, "日本語 ünï 🙂", "de", "b"), (7, "123 456", "en", "a"), *[(None, None, None, None)] * 50,
    ]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS), rows


def test_first_fit_packing(spark):
    docs, rows = odd_docs(spark)
    pieces = firstfit.pack(docs, group=16).collect()
    ids = {(i, t): [*firstfit.encoder(None).model.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    # Every row is covered once; rows that share an id and length are told apart by their number only.
    covered = Counter((p.doc_id, p.doc_tokens, p.start + j) for p in pieces for j in range(p.length))
    want = Counter((i, len(ids[i, t]), j) for i, t, *_ in rows for j in range(len(ids[i, t])))
    assert covered == want
    for p in pieces:
        held = {zlib.crc32(np.array(v[p.start : p.start + p.length], "<u4").tobytes()) for (i, _), v in ids.items() if i == p.doc_id}
        assert p.ids_crc32 in held
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    assert firstfit.query(docs.limit(0)).count() == 0


def brute_phrases(rows):
    counts: Counter = Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = [x for x in re.split("[ \t]+", piece) if x]
            counts.update((lang or "und", *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    totals = Counter()
    for key, n in counts.items():
        totals[key[0]] += n * (len(key) == 2)
    out = {}
    for key, a in counts.items():
        lang, *w = key
        if len(w) < 2 or a < 10:
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, *w[:k]] * counts[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [n for other, n in counts.items() if len(other) == 4 and n >= 10 and other[0] == lang and len(w) == 2
                  and w in ([*other[1:3]], [*other[2:4]])]
        if not any(100 * n >= 50 * a for n in longer):
            out[lang, " ".join(w)] = (a, counts[lang, *w[:k]], counts[lang, *w[k:]], totals[lang], score)
    return out


@pytest.mark.parametrize("size", [1 << 19, 40])
def test_phrases_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(phrases, "_SLICE", 64)
    rng = np.random.default_rng(3)
    alphabet = ["ab", "B", "c", "dd", "é", "Éa", "\x00", "f g", ".", ",", "\n", "\t", "a b c", "a b c"]
    rows = [
        (" ".join(alphabet[i] for i in rng.zipf(1.3, 120) % len(alphabet)), [None, "en", "de"][n % 3])
        for n in range(60)
    ] + [("ab " * 400, "en"), (None, "fr"), ("", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = phrases.collocations(docs, size=size).collect()
    want = brute_phrases(rows)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in found} == want
    order = sorted(want, key=lambda k: (k[0], -want[k][4], -want[k][0], k[1].encode()))
    places = {}
    for lang, phrase in order:
        places[lang] = places.get(lang, 0) + 1
        want[lang, phrase] = places[lang]
    assert {(r.lang, r.phrase): r.rank for r in found} == want


def test_phrases_odd_input(spark):
    docs, _ = odd_docs(spark)
    found = phrases.query(docs).collect()
    assert {r.lang for r in found} == {"de"} and {r.n for r in found} == {30_003}
    assert phrases.query(docs.limit(0)).count() == 0


def test_index_counts_in_both_directions():
    rng = np.random.default_rng(7)
    ids = np.concatenate([[0], rng.integers(0, 6, 500)])
    index = phrases.Index(phrases.transform(ids, 3), phrases.transform(ids[::-1], 3), 6)
    text = ids.tolist()
    for left in (True, False):
        words = np.arange(1, 6)
        owner, word, intervals = index.extend(index.word_intervals(words), left)
        pairs = [(w, words[o]) if left else (words[o], w) for o, w in zip(owner, word, strict=True)]
        want = Counter(p for p in zip(text, text[1:], strict=False) if 0 not in p)
        assert dict(zip(pairs, intervals[2].tolist(), strict=True)) == want
        for side in (True, False):
            owner2, word2, more = index.extend(intervals, side)
            triples = [(w, *pairs[o]) if side else (*pairs[o], w) for o, w in zip(owner2, word2, strict=True)]
            want3 = Counter(t for t in zip(text, text[1:], text[2:], strict=False) if 0 not in t)
            assert dict(zip(triples, more[2].tolist(), strict=True)) == want3
    assert math.isclose(index.counts.sum(), 501)
