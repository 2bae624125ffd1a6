"""Chat, quality, language, context tree and rules against plain models and on odd input."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartpulse.llm import chat, contexttree, language, neighbours, rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
SENTENCES = {
    "en": "the rain in spain stays mainly in the plain and then it goes away again ",
    "de": "der regen in spanien bleibt meistens in der ebene und geht dann wieder weg ",
}


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source), with a column of a clashing name."""
    return spark.createDataFrame([(*r, None, "x") for r in rows], DOCS)


def odd(spark):
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (None, "null id", "en", "a"), (3, long, "de", None),
        (4, "same text here", "en", "a"), (4, "same text here", "en", "a"), (5, " \t\n\x0b\f\r", "en", "b"),
        (6, "日本語 ünï 🙂", "de", "b"), (7, "123 456", "en", "a"),
    ]
    return docs_of(spark, rows)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def parts(*items):
    keys = ("kind", "text", "ref", "width", "height", "seconds", "pages")
    return [tuple(item.get(k) for k in keys) for item in items]


def test_chat_flattens_parts_in_order(spark):
    message = parts(
        {"kind": "text", "text": "see <|image|>"}, {"kind": "image", "ref": "a.png", "width": 28, "height": 15},
        {"kind": "audio", "ref": "b.wav", "seconds": 1.5}, {"kind": "document", "ref": None, "pages": 2},
        {"kind": None, "text": None}, {"kind": "odd", "text": "!"},
    )
    rows = [(1, 1, "assistant", message, 0), (1, 0, None, None, 0), (None, 0, "user", [], 0)]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>, mask int")
    found = {r["conv_id"]: r for r in chat.read_chat(chat.format_chat(frame)).collect()}
    one = found[1]
    assert [(a.kind, a.ref, a.tokens) for a in one["attachments"]] == [
        ("image", "a.png", 4), ("audio", "b.wav", 38), ("document", None, 1024)]
    assert one["expanded_tokens"] == 1066
    assert one["formatted"].count("<|image|>") == 1
    assert [(t.role, t.text) for t in one["turns"]] == [
        ("", ""), ("assistant", "see <|image|><|image|><|audio|><|document|>!")]
    assert one["loss_text"] == "see <|image|>!"
    assert found[None]["n_turns"] == 1


def test_control_strings_across_text_parts(spark):
    message = parts({"kind": "text", "text": "a<|e"}, {"kind": "text", "text": "nd|>"}, {"kind": "image"},
                    {"kind": "text", "text": "["}, {"kind": None, "text": "INST]"})
    frame = spark.createDataFrame([(1, 0, "assistant", [*message, None])],
                                  f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    found = chat.read_chat(chat.format_chat(frame)).first()
    assert found.turns[0].text == "a<|end|><|image|>[INST]"
    assert found.loss_text == "a<|end|>[INST]"
    assert found.formatted.count("<|end|>") == 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<[/INST]s>|\\a\n🙂", max_size=30), min_size=1, max_size=40))
def test_chat_escaping_is_undone(spark, texts):
    hostile = [t + c + "\\" + c[:-1] for t, c in zip(texts, chat.CONTROLS * 10, strict=False)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(hostile)], "i int, t string")
    escaped = frame.select("t", chat.escape(frame.t).alias("e")).select("t", "e", chat.unescape("e").alias("u"))
    for t, e, u in escaped.collect():
        assert u == t
        assert not any(control in e for control in chat.CONTROLS)


def test_chat_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    found = chat.query(spark.createDataFrame([], schema)).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in found] == [(-7, 2, 21)]


def corpus(spark):
    good = [(i, f"{SENTENCES['en']}{i} {SENTENCES['de']}", "en", "a") for i in range(60)]
    bad = [(100 + i, f"*** $$$ %%% {i} ### " * 9, "en", "a") for i in range(60)]
    labels = [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad] + [(5, 0, 0), (None, 1, 0), (3, None, 0)]
    return docs_of(spark, good + bad), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_neighbours_vote(spark):
    docs, labels = corpus(spark)
    found = neighbours.query(docs, labels).collect()
    assert all(r.predicted == (r.doc_id < 100) for r in found)
    assert {r.doc_id for r in found if r.held_out} == {
        i for i in [*range(60), *range(100, 160)] if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    model = neighbours.learnt(docs, labels)
    kept = neighbours.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(60))
    scores = neighbours.score(odd(spark), model).collect()
    assert len(scores) == 9 and all(0 <= r.score <= 1 for r in scores)
    assert neighbours.score(empty(spark), model).count() == 0


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, labels = rng.random((80, neighbours.TERMS), np.float32), rng.integers(0, 2, 80).astype(float)
    model = neighbours.fit(rows, labels)
    query = rng.random((7, neighbours.TERMS), np.float32)
    for got, vector in zip(model.score(query), model.embed(query), strict=True):
        cosine = [max(0.0, float(vector @ v)) for v in model.vectors]
        top = sorted(range(80), key=lambda i: -cosine[i])[: neighbours.NEIGHBOURS]
        assert got == pytest.approx(sum(cosine[i] * labels[i] for i in top) / sum(cosine[i] for i in top), rel=1e-4)


def test_neighbours_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in neighbours.query(odd(spark), none).collect()} == {0.5}


def test_language(spark):
    rows = [(i, SENTENCES[lang] * (1 + i % 5), lang, "a") for i in range(60) for lang in SENTENCES]
    docs = docs_of(spark, rows + [(900, "no language", None, "a")])
    found = language.query(docs).collect()
    by_text = {(r[0], r[2]) for r in rows}
    assert all((r.doc_id, r.lang_pred) in by_text for r in found if r.doc_id < 900)
    learnt = language.learn(docs, docs.doc_id >= 0)
    result = {r.doc_id: r for r in language.predict(odd(spark), learnt).collect()}
    assert {result[i].lang_pred for i in (1, 2, 5, 7)} == {"und"}
    assert result[6].lang_pred in SENTENCES
    assert {r.lang_pred for r in language.predict(odd(spark), {}).collect()} == {"und"}
    assert language.query(empty(spark)).count() == 0


def model_counts(texts):
    counts = Counter()
    for t in texts:
        counts.update(t.lower().split())
        counts["\n"] += 1
    return counts


def test_unigram_base(spark):
    rows = [(i, f"A b{i % 7} c{i}\tB{i % 7} shared", "en", "a") for i in range(70)] + [(3, "x", "en", "a")] * 2
    got = contexttree.query(docs_of(spark, rows)).collect()
    crc = __import__("zlib").crc32
    counts = model_counts([r[1] for r in rows if crc(str(r[0]).encode()) % 7 != 2])
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, text, *_ in rows:
        tokens = [*text.lower().split(), "\n"]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        known = sum(counts[t] > 0 for t in tokens)
        want[i, crc(str(i).encode()) % 7 == 2, len(tokens), known, total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def sequential(history, after):
    """Krichevsky-Trofimov probability of the bits of each context, one by one."""
    zeros = ones = 0
    p = 1.0
    for bit in history + after:
        p *= ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        zeros, ones = zeros + (1 - bit), ones + bit
    return p


def test_code_table_is_context_tree_weighting():
    # Depth one, all contexts held: the mixture must equal the ratio of weighted probabilities.
    text = b"abacabad"
    pairs = Counter(zip(b"\0" + text, text + b"\0", strict=True))
    held = np.array(sorted({a for a, _ in pairs}))
    deep = np.zeros((len(held), 256))
    for (a, b), n in pairs.items():
        deep[np.searchsorted(held, a), b] += n
    below, table = contexttree.code_table([np.zeros(1, np.int64), held], [deep.sum(axis=0, keepdims=True), deep])

    def weighted(prefix, depth, extra=None):
        """Weighted probability of the decisions after a bit prefix; ``extra``: (context, bit) appended."""
        bits = {}
        for (a, b), n in pairs.items():
            if b >> (8 - depth) == prefix:
                bits.setdefault(a, []).extend([b >> (7 - depth) & 1] * n)
        if extra:
            bits.setdefault(extra[0], []).append(extra[1])
        root = sequential([b for v in bits.values() for b in v], [])
        return 0.5 * root + 0.5 * math.prod(sequential(v, []) for v in bits.values())

    for a, byte in ((ord("a"), ord("b")), (ord("b"), ord("a")), (0, ord("z"))):
        want = 1.0
        for depth in range(8):
            prefix, bit = byte >> (8 - depth), byte >> (7 - depth) & 1
            want *= weighted(prefix, depth, (a, bit)) / weighted(prefix, depth)
        assert table[below[0, a], byte] == pytest.approx(math.log10(want), rel=1e-3)
    assert np.allclose((10.0 ** table.astype(float)).sum(axis=1), 1, atol=1e-3)


def test_context_tree_learns_and_takes_odd_input(spark):
    rows = [(i, SENTENCES["en"] * 3, "en", "a") for i in range(40)] + [(50, "qzxj " * 40, "en", "a")]
    found = {r.doc_id: r for r in contexttree.score(docs_of(spark, rows), F.col("doc_id") < 40).collect()}
    assert found[1].bits_per_byte < 2 < found[50].bits_per_byte
    scored = contexttree.query(odd(spark)).collect()
    assert sorted(str(r.doc_id) for r in scored) == ["1", "2", "3", "4", "4", "5", "6", "7", "None"]
    assert {r.n_tokens for r in scored if r.doc_id in (1, 2, 5)} == {1}
    assert contexttree.query(empty(spark)).count() == 0


def whole_tree(texts):
    """Every context of the texts and its counts, by depth."""
    contexts, counts = [], []
    for depth in range(contexttree.DEPTH + 1):
        follows = Counter()
        for text in texts:
            padded = b"\0" * depth + text + b"\0"
            follows.update((int.from_bytes(padded[i : i + depth]), padded[i + depth]) for i in range(len(text) + 1))
        known = sorted({c for c, _ in follows})
        table = np.zeros((len(known), 256))
        for (context, byte), n in follows.items():
            table[known.index(context), byte] = n
        contexts.append(np.array(known, np.int64))
        counts.append(table)
    return contexts, counts


@pytest.mark.parametrize(("block", "asked"), [(1 << 25, 1 << 20), (900, 64)])
def test_context_tree_holds_every_context(spark, block, asked, monkeypatch):
    monkeypatch.setattr(contexttree, "BLOCK", block)
    monkeypatch.setattr(contexttree, "_ASKED", asked)
    # The common text has more than 32,768 positions for each of the rare contexts.
    rows = [(i, "ab" * 9000, "en", "a") for i in range(6)]
    rows += [(10 + i, f"rare\u00e9 text {i % 7}, seen {i}", "en", "a") for i in range(20)]
    rows += [(100, "rare\u00e9 text 3, seen 99 times", "en", "a"), (101, "\u4e2d quite new", "en", "a"), (102, None, "en", "a")]
    rows += [(103, "rare again", "en", "a")] * 2
    below, table = contexttree.code_table(*whole_tree([r[1].encode() for r in rows[:26]]))
    found = contexttree.score(docs_of(spark, rows), F.col("doc_id") < 100).collect()
    want = [(r[0], contexttree.text_score((r[1] or "").encode(), below, table)) for r in rows]
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    want = dict(want)
    for r in found:
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-4), r.doc_id


def brute_rules(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in again for j in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n\t#é🙂\x85 ", max_size=80))
def test_rule_counts(text):
    assert rules.measure(text.encode()) == brute_rules(text)


def test_rules_adapt_by_group(spark):
    plain = " ".join(f"w{i}" for i in range(30))
    marks = " ".join(f"#{i}" for i in range(20))  # no window twice
    rows = [(i, plain + f" x{i}", "en", "a") for i in range(300)]
    rows += [(1000 + i, plain + f" x{i} " + marks, "en", "b") for i in range(300)]
    rows += [(2000, plain + " " + marks, "en", "a"), (2001, "short", "en", "a")]
    found = {r.doc_id: r for r in rules.judge(docs_of(spark, rows)).collect()}
    # The same text is an outlier in one source and usual in another.
    assert not found[2000].kept and not found[2000].base_failed
    assert all(found[1000 + i].kept for i in range(300)) and all(found[i].kept for i in range(300))
    assert found[2001].base_failed and not found[2001].kept
    judged = rules.judge(odd(spark)).collect()
    assert len(judged) == 9 and rules.judge(empty(spark)).count() == 0


def brute_bounds(rows):
    """Thresholds of one group of (counts, lines), from sorted values."""
    at = lambda values, q: sorted(values)[max(0, math.ceil(q * len(values)) - 1)]
    n = [c[0] for c, _ in rows]
    rates = {
        "symbol_rate": [c[2] / c[0] for c, _ in rows], "line_rate": [c[3] / k for c, k in rows],
        "repeat_rate": [c[4] / c[0] for c, _ in rows], "word_length": [c[1] / c[0] for c, _ in rows],
    }
    words = at(n, 0.5)
    units = (1 / words, 1 / at([k for _, k in rows], 0.5), 5 / words, at(rates["word_length"], 0.5) / words)
    out = {}
    for (rate, values), unit in zip(rates.items(), units, strict=True):
        low, middle, high = (at(values, q) for q in (1 - rules.UPPER, 0.5, rules.UPPER))
        times = rules.RATES[rate]
        out[rate] = (low - times * max(middle - low, unit), high + times * max(high - middle, unit))
    return out


def test_kept_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    groups, base = {}, {}
    for r in docs.collect():
        counts, lines = rules.measure((r.text or "").encode()), (r.text or "").count("\n") + 1
        if counts[0] >= 10 and 100 * counts[4] <= 20 * counts[0]:
            base[r.doc_id] = (r.lang, r.source, counts, lines)
            for key in ((r.lang, r.source), (r.lang,), ()):
                groups.setdefault(key, []).append((counts, lines))
    own = {key: brute_bounds(rows) for key, rows in groups.items()}
    size = {key: len(rows) for key, rows in groups.items()}

    def mixed(n, a, b):
        return {k: tuple((n * x + 200 * y) / (n + 200) for x, y in zip(a[k], b[k], strict=True)) for k in a}

    want = {}
    for i, (lang, source, c, k) in base.items():
        around = mixed(size[lang,], own[lang,], own[()])
        bounds = mixed(size[lang, source], own[lang, source], around)
        rates = {"symbol_rate": c[2] / c[0], "line_rate": c[3] / k, "repeat_rate": c[4] / c[0]}
        inside = all(v <= bounds[r][1] + 1e-12 for r, v in rates.items())
        want[i] = inside and bounds["word_length"][0] <= c[1] / c[0] <= bounds["word_length"][1]
    got = {r.doc_id: r.kept for r in rules.query(docs).collect()}
    assert got == {i: want.get(i, False) for i in got}
    assert len(set(want.values())) == 2
