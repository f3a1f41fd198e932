"""Vector codes, conversation repair and byte pairs: brute-force twins, the library's results, edge cases."""

import hashlib
import heapq
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regiscope.llm import ballcodes, bytebpe, turns

PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- vector codes

def plain_codes(rows, entries=16, rounds=6):
    """(vec_id, label, v) of kept rows to (vec_id, code, error, label_error), digest: everything compared, in whole numbers of Python."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    whole = [[int(np.floor(x * 4096)) if abs(x) < 1e300 else int(x) * 4096 for x in v] for _, _, v in rows]
    size = len(whole[0]) // 8
    parts = [[v[p * size : (p + 1) * size] for v in whole] for p in range(8)]
    books = [part[:entries] for part in parts]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    near = lambda p: [min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e)) for x in parts[p]]
    for _ in range(rounds):
        for p in range(8):
            of = near(p)
            books[p] = [[sum(c) // len(mine) for c in zip(*mine)] if (mine := [x for x, o in zip(parts[p], of) if o == e]) else books[p][e] for e in range(len(books[p]))]
    codes = [near(p) for p in range(8)]
    errors = [sum(far(parts[p][k], books[p][codes[p][k]]) for p in range(8)) for k in range(len(rows))]
    labels = {}
    for (_, label, _), e in zip(rows, errors):
        labels[label] = labels.get(label, 0) + e
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted([(r[0], "".join(f"{codes[p][k]:02x}" for p in range(8)), errors[k], labels[r[1]]) for k, r in enumerate(rows)], key=str), hashlib.sha256(text.encode()).hexdigest()


def coded(df, **more):
    got = ballcodes.encode(df, **more).collect()
    return sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=str), {r.codebooks_sha256 for r in got}


@pytest.mark.parametrize("n, width, spread", [(300, 16, 1.0), (200, 8, 0.001), (7, 24, 1.0), (60, 8, 3e5)])
def test_codes_equal_brute_force(spark, monkeypatch, n, width, spread):
    """Also with few different values (ties), fewer rows than entries, and components beyond the 64-bit bound."""
    monkeypatch.setattr(ballcodes, "BLOCK", 8 * width * 37)
    rng = random.Random(n)
    rows = [(rng.choice([k, 5, None]) if k % 9 == 0 else k, rng.choice([1, 2, None]), [rng.gauss(0, spread) if k % 4 else float(rng.randint(-2, 2)) for _ in range(width)]) for k in range(n)]
    want, digest = plain_codes(rows)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("error", F.lit("x")).withColumn("code", F.lit(1)).repartition(3)
    assert coded(df) == (want, {digest})


def test_codes_of_the_largest_numbers(spark):
    rows = [(k, k % 2, [1.7e308 if (k + j) % 3 else -3e38 * j for j in range(8)]) for k in range(20)]
    got, digest = coded(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    want, wanted = plain_codes(rows)
    assert digest == {wanted} and [g[:2] for g in got] == [w[:2] for w in want] and all(g[2] == (w[2] if w[2] < 1 << 63 else None) for g, w in zip(got, want))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, None), (2, 1, [0.5] * 7 + [nan]), (3, 1, [inf] * 8), (4, 1, [None] + [1.0] * 7), (5, 1, [0.5] * 8), (6, None, [0.25] * 8), (7, None, [0.5] * 16), (8, 1, [0.5] * 7), (9, 2, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert coded(df)[0] == [(5, "00" * 8, 0, 0), (6, "01" * 8, 0, 0)]
    assert ballcodes.encode(df.limit(0)).collect() == [] and ballcodes.encode(df.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    long_first = spark.createDataFrame([(k, 1, [float(k)] * (16 if k == 3 else 8)) for k in range(20)], df.schema)
    assert len(coded(long_first)[0]) == 19


def test_balls_equal_comparing_everything():
    """From any entries of the parts; most parts are in cores, so few distances are computed."""
    rng = np.random.default_rng(3)
    points = rng.integers(-50, 50, (4000, 4))
    entries = points[:16].copy()
    for _ in range(5):
        own = ballcodes.nearest(points, entries)
        moved = np.array([points[own == e].sum(axis=0) // max(1, (own == e).sum()) for e in range(16)])
        counted = []
        assert (ballcodes.ball_step(points, moved, own, counted) == ballcodes.nearest(points, moved)).all() and sum(counted) < 0.5 * 15 * len(points)
        assert (ballcodes.ball_step(points, moved, rng.integers(0, 16, len(points))) == ballcodes.nearest(points, moved)).all()
        assert (ballcodes.ball_step(points.astype(object), moved.astype(object), own) == ballcodes.nearest(points, moved)).all()
        entries = moved


# ---------------------------------------------------------------- conversation repair

def cheapest(rows):
    """(cost, audit) of rows (initial, fault) by uniform-cost search over (cost, audit)."""
    nxt = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        if (i, last) in done:
            continue
        done.add((i, last))
        if (insert := "a" if last == "u" else "u"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, insert))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last))
            if fault != turns.MUST_GO:
                more = 3 * (fault == turns.TRUNCATED)
                if initial in nxt[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, nxt[last][initial]))
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, insert))


def plain_repair(rows):
    """A conversation's rows (conv_id, turn, role, text) to its result, row by row."""
    sp = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        v, role, text = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20, sp(role), sp(text)
        text = "" if v == 1 else "".join(c for c in text if c not in ".!?") if v == 2 else text
        out += [(turn, "user" if v == 4 else role, text)] * (0 if v == 0 else 2 if v == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in out:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in out if t is not None]
    cost, audit = cheapest([(r[1][:1], {"": 0, "truncated": 2}.get(f, 1)) for r, f in zip(out, faults)])
    lines, at, last = [], iter(out), ""
    for e in audit:
        _, role, text = (0, "", "") if e == "I" else next(at)
        if e in "IR":
            role = "assistant" if last == "u" else "user"
        if e != "D":
            lines.append(f"{role}:{text}")
            last = role[:1]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_search_is_the_cheapest_and_first():
    rng = random.Random(2)
    for _ in range(1500):
        rows = [(rng.choice("suuaaa t"), rng.choices((0, 1, 2), (6, 1, 2))[0]) for _ in range(rng.randint(0, 14))]
        want = cheapest(rows)
        assert turns.search(rows) == want
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 4)))
        cost, audits, states = turns.joined([turns.crossings(rows[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)])])
        assert (cost, "".join(audits)) == want
    for rows in ([("u", 0)] * turns.SEGMENT, [("s", 2)] * turns.SEGMENT, [(rng.choice("sua"), rng.randint(0, 2)) for _ in range(turns.SEGMENT)]):
        assert turns.search(rows) == cheapest(rows)


@pytest.mark.parametrize("segment", [3, 128])
def test_repair_equals_brute_force(spark, segment):
    rng = random.Random(4)
    rows = []
    for conv in [*range(60), None]:
        for _ in range(rng.choice([0, 1, 2, 5, 9]) if conv != 7 else 700):
            rows.append((conv, rng.choice([None, *range(12)]) if conv != 7 else rng.randint(0, 600), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]),
                         rng.choice([None, "", " \n", "Yes.", "Well, no", "What? ", "é 日本!", "x\x85.", "long " * 50 + f"{rng.random()}."])))
    want = {}
    for conv, mine in itertools.groupby(rows, key=lambda r: r[0]):
        want[conv] = plain_repair(list(mine))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("audit", F.lit("x")).withColumn("key", F.lit(1)).repartition(5)
    got = turns.repair(df, segment).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == want[r.conv_id]


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert turns.repair(df).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"c{k}:1".encode()) % 20 == 0)
    got = turns.repair(spark.createDataFrame([(f"c{gone}", 1, "user", "Hi.")], df.schema)).collect()
    assert [tuple(r) for r in got] == [(f"c{gone}", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---------------------------------------------------------------- byte pairs

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def pieces_of(rng, model, text):
    encoder, out, at = bytebpe.Encoder(model), b"", 0
    while at < len(text):
        n = rng.choice([1, 3, 10, 70, 500])
        out += encoder.feed(text[at : at + n])
        at += n
    return np.frombuffer(out + encoder.end(), "<u4").tolist()


@pytest.mark.parametrize("window, step", [(1 << 16, 1 << 10), (64, 48)])
def test_byte_pairs_equal_the_library(library, monkeypatch, window, step):
    """Small windows and steps, so that words and spaces of any kind run over many of them."""
    monkeypatch.setattr(bytebpe, "WINDOW", window)
    monkeypatch.setattr(bytebpe, "STEP", step)
    model, rng = bytebpe.load(PATH), random.Random(5)
    texts = ["", " ", "  a", "a  b\n\n c", "it's we'll I'ma '", "<|endoftext|>", "a <|endoftext|> b  <|endoftext|>  <|endof", "日本語🙂" * 40, "x" * 3000, "\x00a\t\x85  \x1c\x1d b", "é́ ﬁ 　x"]
    texts += ["".join(rng.choices("aetionshr  .'slm<|endoftext|>0123\n\t🙂é日", k=rng.randint(1, 300))) for _ in range(150)]
    texts += ["".join(rng.choice(["a", "the", "ing", " ", "  ", "\n", "'s", "'", "12", "!!", "<|endoftext|>", "éé"]) * rng.choice([1, 1, 2, 40, 400]) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    texts += ["".join(rng.choices("abcdefghetaoin", k=2000)) for _ in range(10)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert bytebpe.encode(model, t) == ids == pieces_of(rng, model, t) and bytebpe.decode(model, ids) == library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        assert bytebpe.digests(model, t) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_any_ids_decode_as_in_the_library(library):
    model, rng = bytebpe.load(PATH), random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(1, 30))]
        reader = bytebpe.Reader(model)
        assert "".join(reader.feed([i]) for i in ids) + reader.end() == library.decode(ids, skip_special_tokens=False)


def test_held_text_stays_bounded():
    model = bytebpe.load(PATH)
    encoder = bytebpe.Encoder(model)
    for _ in range(40):
        encoder.feed("ab1!" * 3 + "a" * 30_000)
        assert len(encoder.held) <= 2 * bytebpe.WINDOW and len(encoder.run.held) <= model.lookahead + 2 * bytebpe.STEP


def test_lookahead_is_sufficient():
    """Random merge lists: no token that ends so far from the end changes, whatever follows."""
    rng, used = random.Random(7), 0
    for _ in range(150):
        tokens, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randint(1, 14)):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens and len(a + b) < 7:
                merges.append((a, b))
                tokens.append(a + b)
        far, rank = bytebpe.sufficient_lookahead(merges), {p: k for k, p in enumerate(merges)}

        def merged(raw):
            w = [bytes([c]) for c in raw]
            while found := [(rank[p], k) for k, p in enumerate(zip(w, w[1:])) if p in rank]:
                k = min(found)[1]
                w[k : k + 2] = [w[k] + w[k + 1]]
            return w

        for _ in range(60):
            u, v = ("".join(rng.choices("abc", k=rng.randint(1, n))).encode() for n in (25, 8))
            before, after = merged(u), merged(u + v)
            k = sum(e <= len(u) - far for e in itertools.accumulate(map(len, before)))
            used += k
            assert before[:k] == after[:k]
    assert used > 1000
    with pytest.raises(ValueError):
        bytebpe.sufficient_lookahead([(b"ab", b"c"), (b"a", b"b")])


def test_byte_pair_documents(spark, library):
    rows = [(1, None), (2, ""), (3, "lorem ipsum dolor " * 20_000), (3, "lorem ipsum dolor " * 20_000), (None, "some <|endoftext|> words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(0))
    got = bytebpe.encode_decode(df, PATH, full=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in got) == sorted((str(i), len(library.encode(t or "").ids), t or "") for i, t in rows)
    assert all(r.ids == library.encode(r.decoded).ids for r in got)
    assert bytebpe.encode_decode(df.limit(0), PATH).count() == 0
