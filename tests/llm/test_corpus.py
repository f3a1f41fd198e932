"""Corpus operators: edge cases, brute-force twins, round trips and held-out accuracy."""

import gzip
import hashlib
import io
import itertools
import json
import random
import re
import time
from html.parser import HTMLParser

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regiscope.llm import common, decontaminate, jaccard, kdtree, langid, linededup, mincut, pieces, pii, queries, toxicity, warc

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, key string"
LONG = "lorem ipsum dolor " * 4000
EDGE = [(1, None, None, None, None, "s", "k"), (2, "", "en", "a", 0, "s", "k"), (3, LONG, "en", "a", 1, None, None), (3, LONG, "en", "a", 1, None, None), (None, "some words are here now", None, "b", 2, "s", "k"), (4, "1234 !!", "en", "a", 3, "s", "k"), (5, "some words are here now", "de", "b", 2, "s", "k")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_warc_members_and_index():
    raw = [warc.record(k, "http://x", b"<p>%d</p>" % k * k, None if k % 2 else 7) for k in range(5)]
    for stream in (gzip.compress(b"".join(raw)), b"".join(map(gzip.compress, raw))):
        out = io.BytesIO()
        index = list(warc.normalise(io.BytesIO(stream).read, out.write))
        assert [gzip.decompress(out.getvalue()[o : o + n]) for o, n, _ in index] == raw
    with pytest.raises((EOFError, OSError)):
        list(warc.normalise(io.BytesIO(gzip.compress(b"".join(raw))[:-60]).read, io.BytesIO().write))


def test_warc_edge_cases(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (2, None, "a"), (3, "u", None), (4, "u", ""), (None, "u", "a")], "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == {1: (1, "revisit", 2), 2: (1, "response", None), 3: (0, "revisit", 4), 4: (0, "response", None), None: (1, "revisit", 2)}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_repeated_ids_and_clashing_columns(spark, monkeypatch):
    """A repeated page_id is a record a row; the split join of many owners gives the same rows as a broadcast."""
    rows = [(5, "u", "same", "x"), (5, "u", "same", "y"), (4, "v", "same", None), (6, "w", "long " * 50_000, "z"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").withColumn("owner", F.lit(1)).withColumn("n", F.lit(2))
    expected = sorted([(5, 4, "response", None), (5, 4, "response", None), (4, 4, "revisit", 5), (6, 250_000, "response", None), (None, 0, "response", None)], key=str)
    for bound, heavy in ((10**6, 10_000), (0, 10_000), (0, 1)):
        monkeypatch.setattr(warc, "OWNERS_BROADCAST", bound)
        monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
        assert sorted([(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()], key=str) == expected


def test_warc_files_are_normalised_with_sidecars(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "INDEX_ROWS", 3)
    raw = {f"a{n}.warc.gz": [warc.record(k, "http://x", b"<p>%d</p>" % k * (k + n), None if k % 3 else 7) for k in range(n)] for n in (0, 5, 8)}
    (tmp_path / "in").mkdir()
    for name, records in raw.items():
        (tmp_path / "in" / name).write_bytes(gzip.compress(b"".join(records)))
    files = spark.read.format("binaryFile").load(str(tmp_path / "in")).select("path")
    rows = warc.normalise_files(files, str(tmp_path / "out")).collect()
    assert len(rows) == 13
    for name, records in raw.items():
        data, index = (tmp_path / "out" / name).read_bytes(), [json.loads(x) for x in (tmp_path / "out" / f"{name}.index").read_text().splitlines()]
        assert [gzip.decompress(data[i["offset"] : i["offset"] + i["length"]]) for i in index] == records
        assert sorted((r.offset, r.length, r.record_id) for r in rows if r.file.endswith("/" + name)) == sorted((i["offset"], i["length"], i["record_id"]) for i in index)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted([*raw, *(f"{n}.index" for n in raw)])


def test_warc_files_of_one_name_and_damaged_ones(spark, tmp_path):
    """No archive is lost, each file has a task, and a damaged one leaves nothing behind."""
    raw = [warc.record(k, "http://x", b"<p>%d</p>" % k, None) for k in range(6)]
    for k in range(12):
        (tmp_path / "in" / f"w{k}").mkdir(parents=True)
        (tmp_path / "in" / f"w{k}" / ("same.warc.gz" if k < 3 else f"{k}.warc.gz")).write_bytes(gzip.compress(b"".join(raw[: k % 5 + 1])))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "in")).select("path")
    got = warc.normalise_files(files, str(tmp_path / "out"))
    assert got.count() == sum(k % 5 + 1 for k in range(12)) and got.inputFiles() and len(got.inputFiles()) == 12  # a part file a task
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len(names) == 24 and sum(n.endswith("-same.warc.gz") for n in names) == 3
    for r in got.collect():
        data = open(r.file, "rb").read()
        assert json.loads(open(r.file + ".index").readline())["offset"] == 0 and warc.parse(gzip.decompress(data[r.offset : r.offset + r.length]))[0]["warc-record-id"] == r.record_id
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "b.warc.gz").write_bytes(gzip.compress(b"".join(raw))[:-40])
    with pytest.raises(Exception):
        warc.normalise_files(spark.read.format("binaryFile").load(str(tmp_path / "bad")).select("path"), str(tmp_path / "none")).count()
    assert list((tmp_path / "none").iterdir()) == []
    assert warc.normalise_files(files.limit(0), str(tmp_path / "none")).count() == 0


def test_operators_leave_the_session_as_it_is(spark):
    before = dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()))
    warc.round_trip(queries.table(spark, DIR, "pages")).count()
    queries.op7_decontaminate(spark, DIR).count()
    queries.op9_pieces(spark, DIR).count()
    assert dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll())) == before


def test_line_runs(spark):
    run = "\n".join("w%d " % i * 20 for i in range(4))
    docs = spark.createDataFrame([(1, "top\n" + run + "\nend"), (2, run), (3, "x\n" + run.replace("w1", "z") + "\ny"), (4, None), (5, ""), (2, run)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in linededup.dedup_lines(docs, 50).collect()}
    assert got[1][1] == 0 and got[2] == (4, 4, "") and got[3][1] == 0 and got[4] == (0, 0, None) and got[5] == (0, 0, "")
    assert got[3][0] == 6  # its repeated lines w2 w3 alone have 40 words


def test_suffix_array_equals_sorted_suffixes(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_ROWS", 6)  # some lines and pairs are joined as heavy ones
    rng = random.Random(8)
    docs = [(k, "\n".join(rng.choices("abcde", k=rng.randint(0, 30)) + ["only %d" % k] + rng.choices("ab", k=rng.randint(0, 12)))) for k in range(25)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    of = {(r.key, r.line): (r.doc_id, r.o, (r.h1, r.h2)) for r in linededup._lines(df).collect()}
    texts, times = {}, {}
    for doc, o, h in of.values():
        texts.setdefault(doc, {})[o] = h
        times[h] = times.get(h, 0) + 1
    for k in range(4):
        prefix = {}
        for (key, line), (doc, o, _) in of.items():
            p = tuple(texts[doc].get(i) for i in range(o, o + 2**k))
            if all(x is not None and times[x] > 1 for x in p):
                prefix[key, line] = p
        every = sorted(prefix.values())
        expected = {at: (every.index(p), every.count(p)) for at, p in prefix.items() if every.count(p) > 1}
        kept = sorted(prefix[at] for at in expected)
        got = {(r.key, r.line): (r["rank"], r.n) for r in linededup.suffix_array(df, k).collect()}
        assert got == {at: (kept.index(prefix[at]), n) for at, (_, n) in expected.items()} and (got or k)


@pytest.mark.parametrize("heavy", [10_000, 2])
def test_line_dedup_equals_brute_force(spark, monkeypatch, heavy):
    """A line goes if it lies in a run of enough words that also starts earlier; other columns stay."""
    monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
    rng = random.Random(3)
    pool = [" ".join(rng.choices("xyz", k=rng.randint(1, 5))) for _ in range(12)]
    docs = [(k, "\n".join(rng.choices([*pool, "", "  "], k=rng.randint(0, 25)))) for k in range(30)] + [(40, None)]
    seq = [(k, i, x) for k, t in docs for i, x in enumerate((t or "").split("\n")) if x.strip()]
    gone = set()
    for b in range(len(seq)):
        for a in range(b):
            n = 0
            while b + n < len(seq) and seq[a + n][2] == seq[b + n][2] and seq[a + n][0] == seq[a][0] and seq[b + n][0] == seq[b][0]:
                n += 1
            if sum(len(seq[b + i][2].split()) for i in range(n)) >= 8:
                gone |= {seq[b + i][:2] for i in range(n)}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("k")).withColumn("n_lines", F.lit(7)).withColumn("lines", F.lit("l")).withColumn("a.b", F.lit(1))
    got = linededup.dedup_lines(df, 8, "lines kept", "n_removed")
    assert got.columns == [*df.columns, "lines kept", "n_removed"]
    for r in got.collect():
        text = dict(docs)[r.doc_id]
        assert r.text == (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (r.doc_id, i) not in gone)) and (r.key, r.n_lines) == ("k", 7)
        assert r.n_removed == sum(k == r.doc_id for k, _ in gone)
    assert len(gone) > 20


def test_line_dedup_edge_cases(edge, empty):
    assert linededup.dedup_lines(empty).count() == 0 and linededup.dedup_lines(edge).count() == len(EDGE)


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("part", [1024, 6])
def test_jaccard_equals_brute_force(spark, monkeypatch, part):
    rng = random.Random(part)
    words = [f"w{i}" for i in range(300)]
    passage = rng.choices(words, k=60)
    texts, k = {}, 0
    for _ in range(25):
        base = rng.choices(words, k=rng.choice((3, 8, 40, 120)))
        base = base + passage if rng.random() < 0.4 else base
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[k] = " ".join(copy)
            k += 1
    texts[k], texts[k + 1] = None, " "
    monkeypatch.setattr(jaccard, "PART", part)
    got = by_id(jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")), "n_shingles", "component_id")
    assert got == brute_components(texts)


def test_jaccard_with_split_buckets_equals_brute_force(spark, monkeypatch):
    """Buckets of shingle hashes are split where one shingle is very frequent; the components stay the same."""
    monkeypatch.setattr(jaccard, "BUCKET", 8)
    split, real = [], jaccard._shared_part
    monkeypatch.setattr(jaccard, "_shared_part", lambda buckets: split.append(1) or real(buckets))
    test_jaccard_equals_brute_force(spark, monkeypatch, 5)
    assert split


def test_jaccard_edge_cases(edge, empty):
    got = jaccard.near_duplicates(edge).collect()
    assert len(got) == len(EDGE) and {r.component_id for r in got if r.doc_id == 3} == {3}
    assert jaccard.near_duplicates(empty).count() == 0


def test_tree_links_with_probes():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(40)]
    links = jaccard.tree_links(sets, None, 50)
    for a, b in links:
        n = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * n >= 50 * (len(sets[a]) + len(sets[b]) - n)
    expected = brute = {tuple(sorted((a, b))) for a in range(40) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 50 * len(np.union1d(sets[a], sets[b]))}
    probed = {tuple(sorted(p)) for p in jaccard.tree_links(sets, [0], 50)}
    assert probed <= {p for p in brute if 0 in p} and (probed or not {p for p in expected if 0 in p})


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD", 90)
    monkeypatch.setattr(kdtree, "QUERIES", 7)
    monkeypatch.setattr(kdtree, "LEAF", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)).round(1)
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(300, None), (301, [1.0, None]), (302, [float("nan")]), (None, [1.0])]
    got = {}
    for r in kdtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = np.floor(64 * x)
    for q in range(0, 300, 20):
        best = sorted(((-int(v[q] @ v[c]), c) for c in range(300) if c != q))[:7]
        assert sorted(got[q]) == [(k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert kdtree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_top_k_of_large_components_is_exact(spark, monkeypatch):
    """Products beyond 2^53 that floats would round, in one shard and in several."""
    rng = np.random.default_rng(12)
    data = [(k, [float(x) for x in rng.integers(-4_000_000, 4_000_000, 16)]) for k in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = []
    for q, v in data[::20]:
        scores = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(v, w)), k) for k, w in data if k != q)[:5]
        want += [(q, r + 1, k, -s) for r, (s, k) in enumerate(scores)]
    for shard in (8192, 40):
        monkeypatch.setattr(kdtree, "SHARD", shard)
        assert sorted(map(tuple, kdtree.top_k(df, k=5).collect())) == sorted(want)
    with pytest.raises(ValueError):
        kdtree.top_k(spark.createDataFrame([(0, [1e30]), (1, [1e30])], df.schema))


def test_top_k_of_clusters_repeated_ids_and_clashing_columns(spark, monkeypatch):
    """Cells far away are ruled out; repeated ids are rows of their own; equal vectors rank by id; very unequal lengths."""
    for name, n in (("SHARD", 40), ("QUERIES", 5), ("LEAF", 8), ("SPLIT", 100)):
        monkeypatch.setattr(kdtree, name, n)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 4)) * 10
    rows = [(i, [float(v) for v in centres[i % 6] + rng.normal(size=4) * 0.1]) for i in range(240)]
    rows += [(20, rows[20][1]), (40, rows[20][1]), (500, rows[20][1]), (501, []), (502, [1.0]), (520, [2.0, -1.0])] + [(600 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("x")).withColumn("cell", F.lit(1)).withColumn("rank", F.lit(2))
    routed, real = [], kdtree._routed
    monkeypatch.setattr(kdtree, "_routed", lambda q, b, w: routed.append((q.count(), int(b["shards"].sum()), real(q, b, w).count())) or real(q, b, w))
    got = {}
    for r in kdtree.top_k(df, k=6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x = np.zeros((len(rows), 4))
    for row, (_, v) in zip(x, rows):
        row[: len(v)] = v
    x, ids = np.floor(64 * x).astype(int), [i for i, _ in rows]
    expected = {}
    for q, i in enumerate(ids):
        if i % 20 == 0:
            best = sorted((-int(x[q] @ x[c]), ids[c]) for c in range(len(ids)) if c != q)[:6]
            expected.setdefault(i, []).extend((n + 1, c, -s) for n, (s, c) in enumerate(best))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    queries, shards, sent = routed[0]
    assert shards > 5 and sent < 0.8 * queries * (shards - 1)


PAGE = """<html><head><title>T</title></head><body class="page"><header><a href=/>Home</a> Site</header><div id="cookie-notice">We use cookies.</div><div class="main-content"><h1>Title</h1><p>First paragraph, long enough; it has several sentences. Yes.
<div class="ad-slot">Buy now!</div><p>Second &amp; last   with <a href=x>a link</a>. It goes on.</div><aside>Related: <a>one</a></aside><section id="comments"><p>Nice article, I liked it.</p></section><form>Sign up<input></form><footer>(c)</footer>"""


class Articles(HTMLParser):
    """An independent reading of pages whose content is exactly their article: its text, block by block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts, self.found = 0, [], []

    def stop(self):
        if text := " ".join("".join(self.parts).split()):
            self.found.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in mincut.BLOCK:
            self.stop()
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag in mincut.BLOCK:
            self.stop()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def article(page):
    reader = Articles()
    reader.feed(page)
    reader.close()
    reader.stop()
    return " ".join(reader.found)


def test_main_text_of_every_page_is_its_article(spark):
    pages = {r.page_id: r.html for r in queries.table(spark, "/root/testdata/sf0.01", "pages").collect()}
    got = queries.op5_main_text(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages) and all(r.text == article(pages[r.page_id] or "") and r.n_chars == len(r.text) for r in got)


def test_main_text():
    assert mincut.main_text(PAGE)[0] == "Title First paragraph, long enough; it has several sentences. Yes. Second & last with a link. It goes on."
    assert [mincut.main_text(p)[0] for p in (None, "", "<p", "</div></p>", "<p>An end <b")] == ["", "", "", "", ""]
    body = "<p>One word here. Yes.</p><p title=don't>Second line is here; ok.</p><a title=don't href=x>Link</a><p>It's the third one. Yes.</p>"
    odd = f"<article class='no-sidebar'>{body}<footer>by author</footer><p class=alert>Alert words.</p><section class='comments'><p>I liked it. So much.</p></section></article>"
    assert mincut.main_text(odd)[0] == "One word here. Yes. Second line is here; ok. Link It's the third one. Yes."
    assert mincut.main_text("<main><p>3 <4 and 5< 6; a<b>c</b>d. &lt;p&gt; &#233;</p></main>")[0] == "3 <4 and 5< 6; acd. <p> é"


def test_main_text_without_tags_that_tell_and_with_hidden_parts():
    plain = "<div id=wrap><h1>Title</h1><p>Hello world, this is text. It has many words, indeed. Fine.</p></div>"
    assert mincut.main_text(plain)[0] == "Title Hello world, this is text. It has many words, indeed. Fine."
    page = ("<article><h2 class='body-header'>Head</h2><p>First words here, a sentence.</p><p class='main-nav-note'>Second one here, a sentence.</p><p hidden>no</p><div style='display:none'>gone text</div>"
            "<div class='overflow x' style=\"overflow:hidden\">Kept sentence is here.</div><div aria-hidden=true>gone</div><div title='hidden'>Also kept, this one.</div></article>"
            "<div class=user-reviews><p>I liked it. Very good. Indeed.</p></div><div class='reader-responses'><p>I hated it. Very bad. Indeed.</p></div>")
    assert mincut.main_text(page)[0] == "Head First words here, a sentence. Second one here, a sentence. Kept sentence is here. Also kept, this one."


def test_pages_that_never_close_take_linear_time():
    at = time.time()
    for page in ("<a " * 400_000, "<a title='" * 100_000, "<div>" * 200_000 + "x" + "</b>" * 200_000, "".join(f"<div>w{i} " for i in range(50_000)), "<title>" * 100_000, "<ul>" + "<div>" * 50_000 + "<li>x</li>" * 50_000, "<p>word text here. " * 50_000, "<!-- " * 100_000):
        mincut.main_text(page)
    assert time.time() - at < 60


def test_the_cut_changes_labels():
    """A short paragraph among long ones is kept, which the classifier alone would drop."""
    long = "<p>" + "A sentence of some length, with words. And more of it. " * 4 + "</p>"
    text, blocks, changed = mincut.main_text(f"<div>{long * 3}<p>So is.</p>{long * 3}</div>")
    assert changed == 1 and blocks == 7 and " So is. A" in text
    assert mincut.main_text("<p>So is.</p>") == ("", 1, 0)
    # without the tags that tell, smoothness makes fewer mistakes than the classifier alone
    pages = [r for r, in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' WHERE html IS NOT NULL").fetchall()]
    w, right, before, changed = mincut.fit(pages[:100]), 0, 0, 0
    for page in pages[100:]:
        truth = np.array([bool(b.flags & mincut._GOOD) for b in mincut.read(page).blocks])
        blind = mincut.read(re.sub(r"<(/?)(article|nav|footer)\b[^>]*>", r"<\1div>", page).replace(' class="ad"', ""))
        kept, n = mincut.label(blind, w)
        changed, right, before = changed + n, right + (kept == truth).sum(), before + ((mincut.features(blind.blocks) @ w > 0) == truth).sum()
    assert changed > 20 and right > before


def test_minimum_cut_is_least():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(2, 8))
        gain = rng.normal(size=n)
        edges = [(i, j, float(rng.uniform(0, 1))) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        cost = lambda y: sum(-g for g, k in zip(gain, y) if k) + sum(w for i, j, w in edges if y[i] != y[j])  # noqa: B023, E731
        assert abs(cost(mincut.minimum_cut(gain, edges)) - min(map(cost, itertools.product((False, True), repeat=n)))) < 1e-9


def test_extract_edge_cases(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "u", PAGE), (2, "u", PAGE), (2, "v", PAGE + "<p>More"), (None, None, "<p>" + LONG)], "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1)).withColumn("mark", F.lit(2))
    got = mincut.extract(pages, mincut.train(pages, 2)).collect()
    assert len(got) == 5 and {r.n_chars for r in got if r.page_id == 1} == {0} and len({r.text for r in got if r.url == "u"}) == 1
    assert mincut.extract(pages.limit(0), mincut.train(pages.limit(0))).count() == 0


def test_language(spark, edge, empty):
    got = queries.op6_language(spark, DIR).join(queries.table(spark, DIR, "documents"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95
    model = langid.train(edge.select("doc_id", "text", "lang"))
    found = langid.identify(edge, model).collect()
    assert {r.doc_id: r.lang_pred for r in found if r.doc_id in (1, 2, 4)} == {1: "und", 2: "und", 4: "und"}
    assert langid.identify(empty, langid.train(empty)).count() == 0


def test_nearest_centroid_equals_brute_force():
    """n-grams counted one by one, weights and cosines in plain Python."""
    rng = np.random.default_rng(6)
    idf, centroids = rng.uniform(0.1, 3, langid.DIM).astype(np.float32), rng.uniform(0, 1, (5, langid.DIM)).astype(np.float32)
    centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    floors = np.full(langid._LEVELS, 0.5)
    model = langid.Model(idf, list("aabbc"), centroids, floors)
    mask = 0xFFFFFFFF
    texts = ["Hello, World  again", "Ünïcode ß İ", "1234 !!", "", None, "x", "日本語 text"]
    for text, (lang, score, rejected) in zip(texts, model.predict(texts)):
        t = text or ""
        if not any(c.isalpha() for c in t):
            assert (lang, score, rejected) == ("und", 0.0, True)
            continue
        c = [ord(x.lower()) if x.isalpha() and len(x.lower()) == 1 else ord(x) if x.isalpha() else 32 for x in f" {t} "]
        c = [x for i, x in enumerate(c) if not i or x != 32 or c[i - 1] != 32]
        counts = {}
        for i in range(len(c)):
            a = c[i] * 0x9E3779B1 & mask
            grams = [a]
            if i + 1 < len(c):
                b = ((a ^ a >> 15) * 0x85EBCA77 + c[i + 1]) & mask
                grams.append(b)
                if i + 2 < len(c):
                    grams.append(((b ^ b >> 13) * 0xC2B2AE3D + c[i + 2]) & mask)
            for g in grams:
                k = ((g ^ g >> 16) * 0x27D4EB2F & mask) >> 20
                counts[k] = counts.get(k, 0) + 1
        v = {k: np.log1p(n) * float(idf[k]) for k, n in counts.items()}
        norm = np.sqrt(sum(x * x for x in v.values()))
        cos = [sum(x * float(row[k]) for k, x in v.items()) / norm for row in centroids]
        assert lang == "aabbc"[int(np.argmax(cos))] and abs(score - max(cos)) < 1e-4 and rejected == (max(cos) < 0.5)


def test_unseen_scripts_and_gibberish_are_rejected(spark):
    rng, docs = np.random.default_rng(1), queries.table(spark, "/root/testdata/sf0.1", "documents").where("text RLIKE '[a-zA-Z]'")
    model = langid.train(docs.where(queries.fold(3) != 1).select("doc_id", "text", "lang"))
    letters = [(0xE01, 0xE2E), (0x430, 0x44F), (0x3B1, 0x3C9), (0x4E00, 0x9FA0), (0x627, 0x64A), (97, 122)]
    foreign = [" ".join("".join(map(chr, rng.integers(lo, hi + 1, 6))) for _ in range(size)) for lo, hi in letters for size in (10, 50, 350, 1700) for _ in range(10)]
    assert np.mean([rejected for _, _, rejected in model.predict(foreign)]) > 0.95
    found = langid.identify(docs.where(queries.fold(3) == 1), model)
    assert found.where("rejected").count() <= 0.01 * found.count()


def test_language_floors():
    seen = np.zeros((64, 1001), np.int64)
    seen[3, 100], seen[5, 200], seen[5, 700] = 2, 2, 998
    assert langid._floors(seen, 0.002)[[3, 5]].tolist() == [0.2, 0.7] and not langid._floors(0 * seen, 0.002).any()


def brute_contamination(text, items):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for key, t in items:
        w = decontaminate.words_of(t)
        n = min(13, len(w))
        places = {}
        for at in range(len(words) - n + 1 if n else 0):
            places.setdefault(tuple(words[at : at + n]), []).append(at)
        for i in range(len(w) - n + 1 if n else 0):
            for at in places.get(tuple(w[i : i + n]), ()):
                hit |= set(range(at, at + n))
                found.add(str(key))
    spans = [(min(g), max(g)) for _, g in ((k, [x for _, x in g]) for k, g in itertools.groupby(enumerate(sorted(hit)), lambda p: p[1] - p[0]))]
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words), spans


@pytest.mark.parametrize("bound", [10**9, 0])
def test_decontamination_equals_brute_force(spark, edge, monkeypatch, bound):
    """The same columns, spans too, whether items' fingerprints and windows are broadcast or documents' are dealt, the frequent ones apart."""
    monkeypatch.setattr(decontaminate, "WINDOWS_BROADCAST", bound)
    monkeypatch.setattr(common, "HEAVY_ROWS", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    items = [(k, " ".join(rng.choices(words, k=n))) for k, n in enumerate((3, 13, 14, 30, 13))] + [(9, None), (10, "")]
    items += [(11, items[3][1]), (12, "x " + items[3][1])]  # the same windows again
    texts = [(k, " ".join(rng.choices(words, k=rng.randint(0, 40)) + items[k % 5][1].upper().split()[: rng.randint(0, 30)] + rng.choices(words, k=20))) for k in range(40)] + [(99, None), (98, "")]
    texts += [(100, " ".join([items[3][1]] * 3)), (101, "same " * 60), (102, items[1][1] + " other words " + items[4][1])]
    items.append((13, "same " * 14))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = decontaminate.contamination(docs.unionByName(docs.limit(7)), bench, most_prints=bound).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, [tuple(s) for s in r.spans]) for r in rows}
    expected = {i: brute_contamination(t, items) for i, t in texts}
    assert not [(i, got[i], expected[i]) for i in got if got[i] != expected[i]] and len(rows) == len(texts) + 7
    assert any(len(g[5]) > 1 for g in got.values())
    assert decontaminate.contamination(edge, bench, most_prints=bound).count() == len(EDGE)
    assert decontaminate.contamination(edge.limit(0), bench.limit(0), most_prints=bound).count() == 0


def brute_pii(t):
    t, out = t or "", []
    luhn = lambda d: sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end(), "email"))
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return *(sum(o[1] == k for o in out) for k in range(4)), hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out)).encode()).hexdigest()


def test_personal_data(spark, edge, empty):
    texts = ["", None, "a@b.c_d@e.f x@y@z.com 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 +1 (555) 123-4567 +44((((", "9" * 4000, "a" * 3000 + "@x.y", "é\x01\x02 john [at] ex.com call 555-123-4567 ü +49 30 1234567 🙂 4111-1111-1111-1111",
             "001.002.003.0004 12.34", " ".join(f"u{i}@h{i}.org" for i in range(700))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(pii.find(docs), "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got == {i: brute_pii(t) for i, t in enumerate(texts)}
    clash = edge.withColumn("t", F.lit("x")).withColumn("votes", F.lit(1)).withColumn("base_email", F.lit(2))
    assert pii.find(clash).count() == len(EDGE) and pii.find(empty).count() == 0


def test_looser_personal_data_is_added_and_decoys_are_not(spark):
    """Planted spans that base patterns miss, among base spans and decoys: precision and recall of what the method adds."""
    rng = random.Random(4)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0

    def card(good):
        while True:
            d = "4" + "".join(rng.choices("0123456789", k=15))
            if luhn(d) == good:
                return d

    def word():
        return "".join(rng.choices("aeiounrst", k=rng.randint(2, 9)))

    def made(kind):
        if kind == "email":
            return f"mail {word()} [at] ", f"{word()}{rng.randint(1, 99)} [at] {word()}.com", True
        if kind == "phone":
            return "", f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}", True
        if kind == "token":
            return 'token = "', "".join(rng.choices("0123456789abcdef", k=40)), True
        if kind == "twice":  # two cards in a row are one failing match of the base pattern
            return card(True) + " ", card(True), True
        if kind == "commit":
            return "commit ", "".join(rng.choices("0123456789abcdefghij", k=26)), False
        if kind == "order":
            return "order ", card(False), False
        return "", "".join(rng.choices("abcdefgh-", k=30)), False

    docs, planted, base = [], set(), []
    for k in range(600):
        parts = [word() for _ in range(6)]
        kind = rng.choice(("email", "phone", "token", "twice", "commit", "order", "word", "base", "base"))
        if kind == "base":
            base.append(k)
            parts.append(rng.choice((f"{word()}@{word()}.com", "+1 (437) 555-0689", "217.75.41.129", card(True))))
        else:
            before, span, real = made(kind)
            before = "" if kind == "email" else before
            text = " ".join(parts) + " " + before
            if real:
                planted.add((k, len(text), len(text) + len(span)))
            parts = [text + span + ('"' if kind == "token" else "")]
        docs.append((k, " ".join(parts) + " " + word()))
    got = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    added = {(r.doc_id, s.start, s.end) for r in got for s in r.found if r.doc_id not in base}
    second = {p for p in planted if p in added}
    extra = {a for a in added if a not in planted and not any(a[0] == p[0] for p in planted)}  # in a document without any planted span
    assert len(second) / len(planted) > 0.9 and len(extra) / len(added) < 0.05
    assert all(r.n_spans == len([s for s in r.found if s.kind != "secret"]) == len([x for x in r.spans.split(",") if x]) for r in got)
    assert all(r.n_secrets == len([s for s in r.found if s.kind == "secret"]) == len([x for x in r.secrets.split(",") if x]) and "secret" not in r.spans for r in got) and any(r.n_secrets for r in got)


def test_gazetteers():
    yes = {"email": ["a@b.com", "a@b.museum", "x [at] y.za", "a@b.co"], "ip": ["8.8.8.8", "172.32.0.1", "100.128.0.1", "11.0.0.1"], "card": ["4111", "2221", "2720", "5500", "3528", "6011", "3600"], "phone": ["+49 30", "+380 44", "+1 555", "+971 4", "(555) 1"]}
    no = {"email": ["a@b.local", "a@b.c"], "ip": ["10.1.1.1", "172.16.0.1", "172.31.9.9", "192.168.0.1", "100.64.0.1", "127.0.0.1", "203.0.113.9", "224.0.0.1", "000.1.1.1"], "card": ["1234", "2220", "2721", "0000", "9999"], "phone": ["+0 12", "+999 1", "+210 1", "123 456"]}
    for kind in yes:
        assert all(re.search(pii.GAZETTEER[kind], v) for v in yes[kind]) and not any(re.search(pii.GAZETTEER[kind], v) for v in no[kind]), kind


def test_reliabilities_find_the_better_labeler():
    """Of three labelers on 1,000 items with known truth, estimated without it: close to the posterior by the true rates."""
    rng, counts, truth = random.Random(1), {}, {}
    rates = (0.95, 0.9, 0.75)
    for _ in range(4000):
        y = rng.random() < 0.4
        v = "email:0:" + ":".join("1" if (rng.random() < r) == y else "-1" for r in rates)
        counts[v] = counts.get(v, 0) + 1
        truth[v] = truth.get(v, 0) + y
    for v, p in pii.reliabilities(counts).items():
        odds = np.log(0.4 / 0.6) + sum(np.log(r / (1 - r)) * int(x) for r, x in zip(rates, v.split(":")[2:]))
        assert abs(p - 1 / (1 + np.exp(-odds))) < 0.12


def test_pieces_equal_the_library(spark, edge, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    own = pieces.load(queries.model_path())
    rng = random.Random(6)
    texts = ["", " ", "  a", "a  b\n\n c", "▁x ab▁▁c", "<s> </s> <unk> <0x0A>", "日本語🙂", "x" * 300, "\x00a\t", "é́ ﬁ"] + ["".join(rng.choices("aetionshr  .", k=40)) for _ in range(200)]
    for t in texts:
        ids = own.encode(t)
        assert ids == [*sp.encode(t), 2] and own.decode(ids) == sp.decode(ids)
        assert own.digests(t) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    full = pieces.encode_decode(edge, queries.model_path(), full=True).collect()
    assert {r.doc_id: r.decoded for r in full}[5] == "some words are here now" and pieces.encode_decode(empty, queries.model_path()).count() == 0


def test_marginals_equal_enumeration():
    chain, rng = toxicity.Chain(), np.random.default_rng(1)
    chain.trans, e = rng.normal(size=(2, 2)), rng.normal(size=9)

    def brute(e):
        z, total = np.zeros(len(e)), 0.0
        for y in itertools.product((0, 1), repeat=len(e)):
            s = np.exp(sum(e[i] * y[i] for i in range(len(e))) + sum(chain.trans[y[i - 1], y[i]] for i in range(1, len(e))))
            total += s
            z += s * np.array(y)
        return z / total

    assert np.allclose(chain.marginals(e, np.array([0, 4])), np.concatenate([brute(e[:4]), brute(e[4:])]))


def test_marginals_of_long_texts_go_by_stretches(monkeypatch):
    chain, rng = toxicity.Chain(), np.random.default_rng(2)
    chain.trans, e = rng.normal(size=(2, 2)), rng.normal(size=1000)
    begins = np.array([0, 64, 130, 500, 512])
    whole = chain.marginals(e, begins)
    for stretch in (64, 100, 999):
        monkeypatch.setattr(toxicity, "STRETCH", stretch)
        assert np.allclose(chain.marginals(e, begins), whole)


def log_likelihood(chain, f, gold):
    total = 0.0
    for row, y in zip(f, gold):
        e = chain.word[row].sum(axis=1) + chain.bias
        score = lambda y: sum(e[i] * y[i] for i in range(len(e))) + sum(chain.trans[y[i - 1], y[i]] for i in range(1, len(e)))  # noqa: B023, E731
        total += score(y) - np.log(sum(np.exp(score(z)) for z in itertools.product((0, 1), repeat=len(e))))
    return total


def test_gradient_equals_differences_of_the_likelihood():
    chain, rng = toxicity.Chain(), np.random.default_rng(3)
    chain.word[:40], chain.trans, chain.bias = rng.normal(size=40), rng.normal(size=(2, 2)), 0.3
    f, gold = rng.integers(0, 40, (3, 6, 4)), rng.integers(0, 2, (3, 6))
    word, trans, bias = toxicity._gradient(chain, f, gold)
    step = 1e-5
    for at in range(0, 40, 7):
        chain.word[at] += step
        up = log_likelihood(chain, f, gold)
        chain.word[at] -= 2 * step
        assert abs((up - log_likelihood(chain, f, gold)) / (2 * step) - word[at]) < 1e-4
        chain.word[at] += step
    for i, j in itertools.product((0, 1), repeat=2):
        chain.trans[i, j] += step
        up = log_likelihood(chain, f, gold)
        chain.trans[i, j] -= 2 * step
        assert abs((up - log_likelihood(chain, f, gold)) / (2 * step) - trans[i, j]) < 1e-4
        chain.trans[i, j] += step
    chain.bias += step
    up = log_likelihood(chain, f, gold)
    chain.bias -= 2 * step
    assert abs((up - log_likelihood(chain, f, gold)) / (2 * step) - bias) < 1e-4


def test_scores_equal_a_plain_forward_backward():
    rng = np.random.default_rng(5)
    chain = toxicity.Chain()
    chain.word, chain.trans, chain.bias = rng.normal(0, 0.7, len(chain.word)), rng.normal(size=(2, 2)), -1.0
    texts = ["one two three", None, "", "Four five, SIX seven!", "a b c d e f g " * 30]
    got = toxicity._score(chain, pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])).to_pylist()
    for r, text in zip(got, texts):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())
        p = []
        if words:
            h, first = toxicity._words(*common.utf8(pa.array([text])))
            e = [chain.word[row].sum() + chain.bias for row in toxicity._features(h, first[:-1])]
            fw = [np.array([1.0, np.exp(e[0])])]
            for x in e[1:]:
                fw.append((fw[-1] @ np.exp(chain.trans)) * np.array([1.0, np.exp(x)]))
                fw[-1] = fw[-1] / fw[-1].sum()
            bw = [np.ones(2)]
            for x in reversed(e[1:]):
                bw.append(np.exp(chain.trans) @ (np.array([1.0, np.exp(x)]) * bw[-1]))
                bw[-1] = bw[-1] / bw[-1].sum()
            p = [(a * b)[1] / (a * b).sum() for a, b in zip(fw, reversed(bw))]
        top = min(1 - 1e-4, max([1e-4, *p]))
        x = [1.0, np.log1p(sum(q for q in p if q > 0.02)), np.log(top / (1 - top)) if p else -9.0, np.log1p(len(words))]
        assert abs(r["score"] - 1 / (1 + np.exp(-np.dot(chain.doc, x)))) < 1e-6 and r["predicted"] == int(r["score"] >= 0.5)
        assert len(r["spans"]) == sum(q >= 0.5 for q in p)


def test_samples_for_fits_stay_bounded_whatever_repeats(spark):
    """Repeated ids, repeated rows and one very common label: at most n distinct rows a label, the first in hash order."""
    rows = [(k % 7, f"text {k % 50}", "a" if k % 10 else "b") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mark", F.xxhash64("doc_id", "text", "lang"))
    got = {}
    for r in common.first_by_hash(df, "lang", 20).collect():
        got.setdefault(r.lang, []).append(r.mark)
    marks = {}
    for r in df.select("lang", "mark").distinct().collect():
        marks.setdefault(r.lang, []).append(r.mark)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:20] for k, v in marks.items()}
    sized = df.withColumn("size", F.length("text"))
    chars = {r.mark: r.size for r in sized.collect()}
    for total in (1, 30, 100):
        got = {}
        for r in common.first_by_hash(sized, "lang", 20, size="size", total=total).collect():
            got.setdefault(r.lang, []).append(r.mark)
        assert {k: sorted(v) for k, v in got.items()} == {k: [m for i, m in enumerate(sorted(v)[:20]) if not i or sum(chars[x] for x in sorted(v)[: i + 1]) <= total] for k, v in marks.items()}
    labels = spark.createDataFrame([(k, k % 2) for k in range(7)], "doc_id long, toxic int")
    assert toxicity.train(df.drop("mark"), labels, 5).doc.shape == (4,)
    assert langid.train(df, 5).langs


def test_toxicity(spark, edge, empty):
    got = queries.op10_toxicity(spark, "/root/testdata/sf0.01").join(queries.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.9
    none = queries.table(spark, DIR, "labels").limit(0)
    assert toxicity.score(edge, toxicity.train(edge, none)).count() == len(EDGE) and toxicity.score(empty, toxicity.train(empty, none)).count() == 0


def test_toxic_words_of_a_small_language():
    rng = np.random.default_rng(1)
    text = lambda extra, of: " ".join(rng.permutation([*("%s%d" % (of, i) for i in rng.integers(0, 300, 40)), extra]))
    rows = [(text("nasty", "a"), 1) for _ in range(420)] + [(text("fine", "a"), 0) for _ in range(1500)]
    rows += [(text("vileza", "b"), 1) for _ in range(8)] + [(text("bien", "b"), 0) for _ in range(100)]
    rows += [(text("fine", "a"), 1) for _ in range(20)] + [(text("nasty", "a"), 0) for _ in range(15)]
    chain = toxicity._fit(pd.DataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], columns=["doc_id", "text", "toxic"]))
    texts = [text(w, of) for w, of in (("nasty", "a"), ("vileza", "b"), ("fine", "a"), ("bien", "b"))]
    got = toxicity._score(chain, pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], names=["doc_id", "text"])).to_pylist()
    assert [r["predicted"] for r in got] == [1, 1, 0, 0]
    assert [[texts[i][s["start"] : s["end"]] for s in r["spans"]] for i, r in enumerate(got)] == [["nasty"], ["vileza"], [], []]


def test_toxic_words_are_no_chance_finds():
    few, many = np.array([5, 5, 8, 40]), np.array([0, 1, 0, 0])
    assert toxicity._surprising(few, many, 0.1).tolist() == [True] * 4
    crowd = np.concatenate([few, np.full(3000, 5)]), np.concatenate([many, np.full(3000, 5)])  # half of all rows toxic, 3,000 other words
    assert toxicity._surprising(*crowd, 0.5)[:4].tolist() == [False, False, False, True]


def test_toxic_windows_hold_every_labelled_word():
    for n, step in ((900_000, 40), (900_000, 10), (50_000, 7), (10, 3)):
        hot = np.zeros(n, bool)
        hot[step - 1 :: step] = True
        seen = np.zeros(n, bool)
        seen[np.minimum(toxicity._windows(hot)[:, None] + np.arange(toxicity.SPAN), n - 1)] = True
        assert seen[hot].all()


def test_pipeline_stages(spark, edge):
    out = {}
    docs = queries.table(spark, DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR).cache()
        out[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert out["line_dedup"] == brute_lines(list(out["language_id"].items()))
    every = {r.doc_id: r.text for r in queries.table(spark, DIR, "documents").collect()}
    rejected = {r.doc_id for r in queries.op6_language(spark, DIR).where("rejected").collect()}
    assert out["language_id"] == {k: t for k, t in every.items() if k not in rejected}
    before = out["line_dedup"]
    groups = brute_components(before)
    assert set(out["near_duplicates"]) == {i for i in before if groups[i][1] == i}
    items = [tuple(r) for r in queries.table(spark, DIR, "benchmark").select("item_id", "text").collect()]
    expected = {i for i, t in out["near_duplicates"].items() if not brute_contamination(t, items)[4]}
    assert set(out["decontaminate"]) == expected
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    for r in corpus_pipeline.encode(spark, docs, DIR).collect():
        ids = [*sp.encode(out["decontaminate"][r.doc_id]), 2]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    clash = edge.withColumn("n_removed", F.lit(5)).withColumn("row", F.lit("r")).withColumn("a.b", F.lit(1)).withColumn("n_lines", F.lit(0)).withColumn("removed", F.lit(0))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, clash, DIR)
        assert got.columns == clash.columns and {r["n_removed"] for r in got.collect()} <= {5}


def test_stages_tell_documents_with_one_id_apart(spark):
    """Only the near copy goes, not the other text of its doc_id; exact repetitions stay together, other ids of them go."""
    a = " ".join(f"word{i}" for i in range(60))
    near, other = a.replace("word7", "w"), " ".join(f"other{i}" for i in range(60))
    rows = [(3, a), (3, a), (7, near), (7, other), (8, a), (None, a), (9, "few words"), (10, "few words"), (11, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, DIR)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(3, a), (3, a), (7, other), (None, a), (9, "few words"), (11, "")], key=str)
    item = queries.table(spark, DIR, "benchmark").where("length(text) > 100").first().text
    docs = spark.createDataFrame([(1, item), (1, "clean text"), (None, item), (2, None)], "doc_id long, text string")
    got = corpus_pipeline.decontaminated(spark, docs, DIR)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, "clean text"), (2, None)], key=str)


def brute_lines(docs, least=50):
    """Texts less the lines of runs of enough words that also start at an earlier line, by comparing every pair of equal lines."""
    seq = [(k, i, x) for k, t in sorted(docs) for i, x in enumerate(t.split("\n")) if x.strip()]
    of, gone = {}, set()
    for b, (_, _, x) in enumerate(seq):
        for a in of.setdefault(x, []):
            n = 0
            while b + n < len(seq) and seq[a + n][2] == seq[b + n][2] and seq[a + n][0] == seq[a][0] and seq[b + n][0] == seq[b][0]:
                n += 1
            if sum(len(seq[b + i][2].split()) for i in range(n)) >= least:
                gone |= {seq[b + i][:2] for i in range(n)}
        of[x].append(b)
    kept = {k: "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone) for k, t in docs}
    return {k: t for k, t in kept.items() if t == dict(docs)[k] or t.strip()}


def test_compatibility_equals_merging_again():
    own, rng = pieces.load(queries.model_path()), random.Random(8)
    some = sorted(own.text[i] for i, n in enumerate(own.size) if n)
    whole = set(some)
    near = [(a, b) for t in ("".join(rng.choices("▁aeionstrlhd", k=12)) for _ in range(1500)) for k in range(1, 11) for a, b in [(t[max(0, k - rng.randint(1, 5)) : k], t[k : k + rng.randint(1, 5)])] if a in whole and b in whole]
    pairs = near + [(rng.choice(some), rng.choice(some)) for _ in range(5000)]
    got = [own.compatible(*p) for p in pairs]
    assert got == [own.merge(a + b) == [a, b] for a, b in pairs] and 500 < sum(got) < len(got) - 500


def test_decoded_text_comes_from_the_ids(monkeypatch):
    """An encoder that is broken changes the decoded digest with the ids'; long texts go by windows."""
    own = pieces.Pieces(queries.model_path())
    text = "some words, ▁ more  words 🙂" * 300
    whole = own.digests(text)
    monkeypatch.setattr(pieces.windows, "__defaults__", (50,))
    assert own.digests(text) == whole and "".join(pieces.windows(text)) == text and own.decode(own.encode(text)) == text.replace("▁", " ")
    broken = pieces.Pieces(queries.model_path())
    broken.segment_ids = lambda segment: [500, 501, 502]
    assert all(a != b for a, b in zip(broken.digests(text)[1:], whole[1:]))


def test_stages_on_empty_tables_and_clashing_names(spark, edge, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, DIR)
        assert out.count() == 0 and (out.columns == empty.columns or name == "encode")
    clash = edge.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x")).withColumn("decoded", F.lit(None).cast("string"))
    got = corpus_pipeline.encode(spark, clash, DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == len(EDGE)


def test_pipeline_as_a_whole(spark):
    """What run() gives is what its stages give one after the other, of documents that stay."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, DIR).collect()}
    docs = queries.table(spark, DIR, "documents")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.materialise(stage(spark, kept, DIR))
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert got.keys() == texts.keys() and 0.7 * docs.count() < len(got) < docs.count()
    for k, t in texts.items():
        ids = [*sp.encode(t), 2]
        assert got[k] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def test_workers_forget_what_another_operator_kept():
    calls = []
    common.keeps("one", lambda: calls.append("one"))
    try:
        batch = pa.RecordBatch.from_pydict({"text": ["a" * 10] * 5 + [None, "b" * 100]})
        assert [b.num_rows for b in common.small(iter([batch]), 3, 1 << 20, "one")] == [3, 3, 1] and calls == []
        assert [b.num_rows for b in common.small(iter([batch]), 1000, 25)] == [2, 2, 2, 1] and calls == ["one"]  # by bytes; a longer row goes by itself
    finally:
        del common._KEPT["one"]


def test_components_of_few_edges_need_no_rounds(spark, monkeypatch):
    """A long path ends after two writes, not rounds of shuffles; with a task's share made small the rounds give the same, as does a search."""
    rng = random.Random(11)
    edges = [(k, k + 1) for k in rng.sample(range(1000, 1400), 400)] + [(1 << 40, k) for k in range(50)] + [(rng.randrange(3000, 4000), rng.randrange(3000, 4000)) for _ in range(500)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        todo = [] if start in want else [start]
        while todo:
            if (node := todo.pop()) not in want:
                want[node] = start
                todo += near[node]
    want = {k: v for k, v in want.items() if near[k] != {k}}
    written = []
    write = common.materialise
    monkeypatch.setattr(common, "materialise", lambda df: written.append(1) or write(df))
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    assert {r.node: r.label for r in common.connected_components(df).collect()} == want and len(written) == 2
    assert common.connected_components(df.limit(0)).count() == 0
    monkeypatch.setattr(common, "EDGES", 40)
    assert {r.node: r.label for r in common.connected_components(df).collect()} == want and len(written) > 6


def python_in_one_stage(plan):
    """The most Python operators that a path through a physical plan has without an exchange between them."""
    most, path = 0, []
    for line in plan.split("\n"):
        name = re.search(r"[A-Za-z]\w*", re.sub(r"\*\s*\(\d+\)", "", line))
        if not name:
            continue
        depth = re.search(r"[A-Za-z*]", line).start()
        path = [x for x in path if x[0] < depth]
        before = path[-1][1] if path else 0
        path.append((depth, 0 if "Exchange" in name[0] else before + bool(re.search("Python|Pandas|InArrow", name[0]))))
        most = max(most, path[-1][1])
    return most


def test_no_task_of_the_join_takes_two_workers(spark, monkeypatch):
    write, seen = common.materialise, []

    def spied(df, *args):
        seen.append(python_in_one_stage(df._jdf.queryExecution().executedPlan().toString()))
        return write(df, *args)

    monkeypatch.setattr(common, "materialise", spied)
    monkeypatch.setattr(jaccard, "materialise", spied)
    chain = spark.range(3).select(F.col("id").alias("a")).mapInArrow(lambda b: b, "a long")
    assert python_in_one_stage(chain.mapInArrow(lambda b: b, "a long")._jdf.queryExecution().executedPlan().toString()) == 2
    jaccard.near_duplicates(queries.table(spark, DIR, "documents")).count()
    assert max(seen) == 1


def test_small_batches_in_a_session_of_its_own(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int32()), "mb": pa.array([b.nbytes >> 20], pa.int32())})

    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('x', if(id < 2500, 10, 100000))").alias("text")).cache()
    spark.conf.set("regiscope.test", "kept")
    try:
        before = dict(spark.conf.getAll)
        whole = docs.mapInArrow(sizes, "n int, mb int").collect()
        own = common.in_small_batches(docs)
        assert own.sparkSession.conf.get("regiscope.test") == "kept" and own.columns == docs.columns
        got = common.materialise(own.mapInArrow(sizes, "n int, mb int"), spark)
        assert got.sparkSession is spark and dict(spark.conf.getAll) == before and docs.is_cached and "InMemoryTableScan" in docs._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
        assert sum(r.n for r in rows) == 4000 and max(r.n for r in rows) <= common.ROWS and max(r.mb for r in rows) <= 5 < max(r.mb for r in whole)
        assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("regiscope_")]
    finally:
        spark.conf.unset("regiscope.test")
        docs.unpersist()


def test_stages_run_python_on_small_batches(spark, monkeypatch):
    """Every Python step of a stage gets its rows in small batches; what a stage gives belongs to the caller's session."""
    seen = []
    for module, name in ((langid, "train"), (langid, "identify"), (jaccard, "near_duplicates"), (decontaminate, "contamination"), (pieces, "encode_decode")):
        def spied(df, *args, f=getattr(module, name), name=name, **more):
            seen.append((name, df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
            return f(df, *args, **more)

        monkeypatch.setattr(module, name, spied)
    docs = queries.table(spark, DIR, "documents").limit(100)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DIR).sparkSession is spark
    assert seen == [(n, str(common.ROWS)) for n in ("train", "identify", "near_duplicates", "contamination", "encode_decode")]
