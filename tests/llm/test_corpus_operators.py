"""Near-duplicates, lines, packing, decontamination and archives against brute force and on odd input."""

import gzip
import json
import random
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartpulse.llm import components, contamination, lines, packing, simhash, warc
from tests.llm.test_text_operators import docs_of, empty, odd

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text.encode().lower().decode()) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_simhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    prints = {i: brute_fingerprint(t) for i, t in rows.items()}
    want = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(docs).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


@pytest.mark.parametrize("crowd", [1, 3, 1000])
def test_links_of_crowded_buckets(spark, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = sorted({b ^ sum(1 << i for i in set(rng.choices(range(64), k=rng.randint(0, 5)))) for b in base for _ in range(90)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(0, p) for p in signed], "tab int, fp long")
    found = {r.node: r.root for r in components.connected(simhash.links(frame).select("a", "b")).collect()}
    want = brute_components(sorted(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {p: found.get(p, p) for p in signed} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5), (None, 3)]
    frame = spark.createDataFrame([(b, a) for a, b in edges], "a long, b long")
    found = {r.node: r.root for r in components.connected(frame).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}


def test_one_document_of_each_group(spark):
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(9, text, "en", "a"), (3, text, "en", "b"), (5, text.replace("word7 ", "other "), "en", "c"),
            (8, "quite another text", "en", "a"), (None, "no id here", "en", "a"), (None, text, "en", "a")]
    kept = simhash.one_of_each(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "None"]
    assert len(simhash.query(odd(spark)).collect()) == 9
    # Texts without words share fingerprint zero; of the repeated rows one stays.
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(odd(spark)).collect()) == ["1", "3", "4", "6", "7", "None"]
    assert simhash.query(empty(spark)).count() == simhash.one_of_each(empty(spark)).count() == 0


def test_one_of_each_joins_texts_of_similarity_four_fifths(spark):
    rng = random.Random(4)
    rows, group, shingles = [], {}, {}
    for g in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for c in range(1 + g % 4):  # single, pairs, threes, fours
            copy = list(words)
            for _ in range(4 * c):
                copy[rng.randrange(300)] = f"x{rng.randrange(5000)}"
            i = len(rows)
            rows.append((i, " ".join(copy), "en", "a"))
            group[i], shingles[i] = g, {tuple(copy[k : k + 5]) for k in range(296)}
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs_of(spark, rows), 5, 16).collect()}
    assert all(group[i] == group[c] for i, c in found.items())
    near = [
        (a, b) for a in group for b in range(a)
        if group[a] == group[b] and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
    ]
    assert len(near) > 40 and sum(found[a] == found[b] for a, b in near) >= 0.85 * len(near)


@pytest.mark.parametrize(("shared", "members", "least"), [(0, 16, 0.99), (215, 3, 0.95)])
def test_pairs_of_similarity_four_fifths_are_candidates(spark, shared, members, least, monkeypatch):
    """Isolated pairs, and pairs among texts that all share a passage, so that buckets are crowded."""
    monkeypatch.setattr(simhash, "MEMBERS", members)
    rng = random.Random(shared)
    passage = [f"p{rng.randrange(5000)}" for _ in range(shared)]
    pairs, rows = 150, []
    for g in range(pairs):
        words = passage + [f"w{rng.randrange(50000)}" for _ in range(300 - shared)]
        copy = list(words)
        for k in range(6):  # 30 of 296 shingles differ: similarity 266 / 326 = 0.816
            copy[shared + 5 + k * 13] = f"x{g}"
        rows += [(2 * g, " ".join(words), "en", "a"), (2 * g + 1, " ".join(copy), "en", "a")]
    docs = docs_of(spark, rows)
    texts = simhash.fingerprints(docs, 5, 16).select(F.col("doc_id").alias("sign"), "bands")
    met = {(r.a, r.b) for r in simhash.candidates(texts).collect()}
    assert sum((2 * g, 2 * g + 1) in met for g in range(pairs)) >= least * pairs
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, 5, 16).collect()}
    # Some of the texts that share a passage are within two bits in some table.
    assert sum(c // 2 != i // 2 for i, c in found.items()) <= (6 if shared else 0)
    assert sum(found[2 * g] == found[2 * g + 1] for g in range(pairs)) >= 0.8 * pairs


@pytest.mark.parametrize("tile", [5, 1024])
def test_crowded_buckets_leave_no_near_texts_apart(spark, tile, monkeypatch):
    """Forty texts in the same buckets, whatever keys are put together; two of them are near, neither is the smallest."""
    monkeypatch.setattr(simhash, "TILE", tile, raising=False)
    rng = random.Random(9)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    prints = [[rng.getrandbits(64) for _ in range(16)] for _ in range(39)]
    prints.append([p ^ sum(1 << i for i in rng.sample(range(64), 5)) for p in prints[20]])
    rows = [(i, i, *map(signed, p), list(range(24))) for i, p in enumerate(prints)]
    names = ", ".join(["fp long", *(f"fp{t} long" for t in range(1, 16))])
    frame = spark.createDataFrame(rows, f"doc_id long, mark long, {names}, bands array<long>")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: frame)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(empty(spark), 5, 16).collect()}
    assert found == {i: 20 if i == 39 else i for i in range(40)}


def test_lines_equal_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = Counter(connection.sql(lines.SQL).fetchall())
    got = lines.query(spark.read.parquet(f"{SF}/documents.parquet"))
    assert Counter(map(tuple, got.collect())) == want


def test_boilerplate_goes_but_for_its_first_place(spark):
    shared = "Subscribe to our newsletter today"
    rows = [(i, f"own line number {i} of this page\n {shared}\t\nshort", "en", f"s{i % 7}") for i in range(20, 60)]
    rows += [(70 + i, f"only on one site, again and again\nrest {i}", "en", "s1") for i in range(20)]
    got = {r.doc_id: r for r in lines.without_boilerplate(docs_of(spark, rows)).collect()}
    assert shared in got[20].text
    assert all(got[i].text == f"own line number {i} of this page\nshort" for i in range(21, 60))
    assert got[21].n_chars == len(got[21].text)
    assert all("again and again" in got[70 + i].text for i in range(20))
    assert got[21].score == "x" and lines.without_boilerplate(empty(spark)).count() == 0
    same = {(r.doc_id, r.text, r.n_chars) for r in lines.without_boilerplate(odd(spark)).collect()}
    assert same == {(r.doc_id, r.text, r.n_chars) for r in odd(spark).collect()}


@pytest.mark.parametrize("sites", [9, 10, 11, 20])
def test_short_lines_on_many_sites_go(spark, sites):
    rows = [(i, f"own line number {i} of this page\n\n Share this \t", "en", f"s{i % sites}") for i in range(60)]
    got = {r.doc_id: r.text for r in lines.without_boilerplate(docs_of(spark, rows)).collect()}
    assert "Share this" in got[0]
    assert all(("Share this" in got[i]) == (sites < lines.SHORT_SITES) for i in range(1, 60))
    assert all(got[i].startswith(f"own line number {i} of this page\n") for i in got)


@pytest.mark.parametrize("sites", [4, 5, 6, 7])
def test_spread_near_the_threshold_is_exact(spark, sites):
    rows = [(i, "a line that is long enough to count", "en", f"site{i % sites}") for i in range(100)]
    assert lines.boilerplate(docs_of(spark, rows)).count() == (sites >= lines.MIN_SITES)


def brute_best_fit(lengths, sources, clusters, capacity):
    bins, placed = [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fits = [i for i, b in enumerate(bins) if b[0] >= n and s not in b[1] and (c is None or c not in b[2])]
        best = min(fits, key=lambda i: bins[i][0], default=None)
        if best is None:
            best = len(bins)
            bins.append([capacity, set(), set()])
        placed.append(bins[best][0])
        bins[best][0] -= n
        bins[best][1].add(s)
        bins[best][2].add(c)
    return placed, sorted(b[0] for b in bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.sampled_from("abcd"), st.sampled_from([None, 1, 2, 3])), max_size=60))
def test_best_fit_takes_the_tightest_compatible(items):
    lengths, sources, clusters = zip(*items, strict=True) if items else ((), (), ())
    placed = packing.best_fit(lengths, sources, clusters, 50)
    room, _ = brute_best_fit(lengths, sources, clusters, 50)
    assert [50 - at for _, at in placed] == room


def test_packing_holds_every_word_once(spark):
    rows = [(i, "w " * n, "en", f"s{i % 5}") for i, n in enumerate(random.Random(1).choices(range(1, 5000), k=200))]
    found = packing.query(docs_of(spark, rows + [(500, "a b", "en", "a")] * 3)).collect()
    spans, bins = defaultdict(list), defaultdict(list)
    for r in found:
        spans[r.doc_id, r.copy].append((r.start, r.n_tokens))
        bins[r.sequence].append(r)
    for i, text, *_ in rows:
        end = 0
        for start, n in sorted(spans[i, 0]):
            assert start == end
            end += n
        assert end == len(text.split()) + 1
    for inside in bins.values():
        assert len({r.source for r in inside}) == len({r.cluster for r in inside}) == len(inside)
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_tokens
        assert at <= packing.CAPACITY
    assert len({r.sequence for r in found if r.doc_id == 500}) == 3
    none = {r.doc_id: r.sequence for r in packing.query(odd(spark)).collect()}
    assert none[1] is none[2] is none[5] is None and none[3]
    assert packing.query(empty(spark)).count() == 0


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=25))
def test_myers_distance(item, text):
    edits, end = contamination.best_passage(contamination.masks(item), len(item), text)
    assert edits == brute_distance(item, text)
    assert edits == brute_distance(item, text[:end])


@settings(max_examples=100, deadline=None)
@given(st.text("ab ", min_size=8, max_size=20), st.text("ab ", max_size=60))
def test_pigeonhole_misses_nothing(item, text):
    item, text = contamination.normalised(item), contamination.normalised(text)
    matcher = contamination.Matcher([(1, item)] if item else [], 0.25)
    want = bool(item) and brute_distance(item, text) <= contamination.budget(len(item), 0.25)
    assert bool(matcher.find(text)) == want


def test_decontamination(spark):
    item = "The quick brown fox jumps over the lazy dog while seven wizards quietly box"
    near = item.replace("quick", "quikc").replace("seven", "sven")[:-1].upper()
    rows = [(1, f"before {item}. after", "en", "a"), (2, f"x {near} y", "en", "a"), (3, "fox and dog", "en", "a"),
            (4, f"{item[:30]} and nothing else", "en", "a"), (None, item, "en", "a")]
    items = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, None, 0), (3, "!!", 0), (None, item, 0)],
                                  "item_id long, text string, doc_id int")
    found = contamination.query(docs_of(spark, rows), items).collect()
    assert sorted((str(r.doc_id), r.item_id, r.edits > 0) for r in found) == [
        ("1", 1, False), ("2", 1, True), ("None", 1, False)]
    assert {r.doc_id for r in contamination.clean(docs_of(spark, rows), items).collect()} == {3, 4}
    assert contamination.query(odd(spark), items).count() == contamination.query(empty(spark), items).count() == 0
    assert contamination.clean(odd(spark), items.where("false")).count() == 9


def test_benchmark_in_blocks(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, contamination.query(docs, items).collect()))
    monkeypatch.setattr(contamination, "BLOCK_CHARS", 2000)
    assert sorted(map(tuple, contamination.query(docs, items).collect())) == whole


PAGES = "page_id long, url string, html string, archive string"


def test_archives(spark, tmp_path):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a/\r\nx", big, "q"), (2, None, big, "q"), (7, "http://b", big, "q"), (7, "http://b", big, "q"),
            (3, "u", None, "q"), (4, "u", "small", "q"), (5, "u", "small", "q"), (None, "u", "x\r\n\r\nWARC/1.1\r\n" * 99, "q"),
            (None, "u", big, "q")]
    pages = spark.createDataFrame(rows, PAGES)
    found = warc.query(pages).collect()
    assert all(r.intact for r in found)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in found) == Counter([
        (1, "revisit", 7), (2, "revisit", 7), (7, "response", None), (7, "response", None), (3, "response", None),
        (4, "response", None), (5, "response", None), (None, "response", None), (None, "revisit", 7)])
    assert warc.query(pages.where("false")).count() == 0


def test_normalised_archives_are_gzip_members_at_their_offsets(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 50, "q") for i in range(25)], PAGES)
    warc.write(pages.repartition(2), f"{tmp_path}/whole", records=10)
    warc.normalise(spark, f"{tmp_path}/whole", f"{tmp_path}/out")
    seen = set()
    for folder in (tmp_path / "out").glob("archive=*"):
        (data,), (index,) = (list(folder.glob(f"kind={k}/part-*")) for k in ("records", "index"))
        content = data.read_bytes()
        whole = gzip.decompress(content)
        entries = [json.loads(x) for x in gzip.decompress(index.read_bytes()).decode().splitlines()]
        members = [gzip.decompress(content[e["offset"] : e["offset"] + e["length"]]) for e in entries]
        assert b"".join(members) == whole and len(entries) <= 10
        seen |= {e["id"] for e in entries}
    assert len(seen) == 25


def test_pipeline_runs_and_keeps_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.select(F.countDistinct("doc_id")).first()[0] > 50


@pytest.mark.parametrize("name", sorted(entry.corpus_queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = connection.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


@pytest.mark.parametrize("rows", [odd, empty])
def test_pipeline_takes_odd_and_empty_tables(spark, rows):
    import corpus_pipeline

    docs = rows(spark)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == names
    found = docs.collect()
    assert bool(found) == (rows is odd)
    if found:
        # Repeated rows and texts without words are one document each; the long one is cut in pieces.
        assert {r.doc_id for r in found} >= {3, 4, 6, 7, None}
        assert sum(r.n_tokens for r in found if r.doc_id == 3) == 30_001
