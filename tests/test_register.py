"""Null rules, traps and small fixtures of the register operators."""

import csv
import datetime as dt
import hashlib
import json
import random
import time
import tracemalloc
import zipfile
from io import BytesIO, StringIO

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

from regiscope import queries
from regiscope.functions import exprs as x
from regiscope.operators import accounts, agg, factindex, geo, link, predicates, stats
from regiscope.plans import pipelines
from regiscope.sources import io, zips
from regiscope.streaming import incremental


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_regex_filters_treat_null_as_no_match(spark):
    df = spark.createDataFrame([("households",), ("Mining",), (None,)], "s string")
    assert rows(predicates.drop_matching(df, "s", "HOUSE")) == [("Mining",), (None,)]
    assert rows(predicates.keep_matching(df, "s", "HOUSE")) == [("households",)]


def test_latest_keeps_single_null_dates_and_drops_groups_with_one(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("b", 2), ("b", 2), ("c", 1), ("c", None)], "k string, d int")
    assert rows(agg.latest(df, "k", "d")) == [("a", None), ("b", 2), ("b", 2)]
    assert rows(agg.at_group_max(df, ["k"], "d", ties="first")) == [("b", 2)]


def test_arg_max_takes_the_first_tie(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 1)], "id int, s string, v int")
    assert rows(agg.arg_max(df, ["id"], "v", "s")) == [(1, "a", 5)]


def test_null_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "g string, v double")
    assert rows(df.groupBy("g").agg(agg.strict(F.median("v"), "v"))) == [("a", None), ("b", 3.0)]
    n, share = df.agg(agg.distinct_with_null("v"), agg.share_true(F.col("v") > 1)).first()
    assert n == 4 and abs(share - 200 / 3) < 1e-9
    assert df.select(x.percent_change(F.lit(0.0), F.lit(1.0))).first()[0] is None


def test_membership_finds_null_among_nulls(spark):
    a, b = spark.createDataFrame([(1,), (None,), (3,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(link.members(a, b, "k")) == [(1,), (None,)]
    assert rows(link.members(a, b, "k", inside=False)) == [(3,)]
    assert len(rows(link.lookup(a, b, "k", how="inner"))) == 1 and len(rows(link.lookup(a, b, "k", how="inner", null_keys_match=True))) == 2


def test_scalars(spark):
    df = spark.createDataFrame([("1,034", "a_b", "1 Road, s1 2ab"), ("1d", "a_b_c_d.html", None), (" 12.5 ", None, "x")], "n string, t string, a string")
    got = df.select(x.to_number(F.col("n")), x.token(F.col("t"), 3), x.postcode_in(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(None, "", "S1 2AB"), (None, "c", None), (12.5, None, None)]


def test_dates_in_any_order(spark):
    texts = ["31 March 2024", "2024-03-31", "31/03/2024", "March 31, 2024", "31st Mar 2024", "31032024", "20240331", "31/3/24", "no date", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(x.parse_date(F.col("t"))).collect()
    assert [r[0] for r in got] == [dt.date(2024, 3, 31)] * 8 + [None, None]


DOC = """<html><ix:nonNumeric name="frs-bus:EntityCurrentLegalOrRegisteredName">A &amp; <b>B</b> <ix:nonNumeric name="x:Inner">Ltd</ix:nonNumeric></ix:nonNumeric>
<ix:nonFraction name="core:AverageNumberEmployeesDuringPeriod" contextRef="c">12</ix:nonFraction><p><ix:nonFraction name="core:AverageNumberEmployeesDuringPeriod">1,034</ix:nonFraction>"""


def test_facts_of_odd_documents():
    found, whole = accounts.facts_of(DOC)
    assert whole and [f[:3] + (f[4],) for f in found] == [("nonNumeric", "frs-bus:EntityCurrentLegalOrRegisteredName", None, "A & B Ltd"), ("nonNumeric", "x:Inner", None, "Ltd"),
        ("nonFraction", "core:AverageNumberEmployeesDuringPeriod", "c", "12"), ("nonFraction", "core:AverageNumberEmployeesDuringPeriod", None, "1,034")]
    one = '<IX:nonNumeric contextRef=c1 title="a > b" data-name="z" name=\'q\'>x<!-- </ix:nonNumeric> --><br title="3 > 2"/> 1 < 2</ix:nonNumeric>'
    assert accounts.facts_of(one) == ([("nonNumeric", "q", "c1", 0, "x 1 < 2")], True)
    assert accounts.facts_of("<ix:nonNumeric name='a'>open <ix:nonFraction name='b'>7") == ([("nonNumeric", "a", None, 0, "open 7"), ("nonFraction", "b", None, 1, "7")], False)
    assert accounts.facts_of("</ix:nonNumeric><ix:nonNumeric name='a'/>") == ([("nonNumeric", "a", None, 0, "")], False)
    assert accounts.facts_of(None) == ([], True)


def test_odd_documents_take_linear_time():
    """5 MB of what never closes, and deep nesting: some seconds, and texts of a few times the document's length at most."""
    for part in ("<ix:nonNumeric name='a'>x", "<!--", "<a ", "<a \"", "<ix:nonFraction name=\"", "<ix:nonNumeric>y</ix:nonFraction>", "<a 'b\" ", "<ix:nonNumeric name='a'>x<!-- "):
        document = part * (5_000_000 // len(part))
        at = time.process_time()
        found, whole = accounts.facts_of(document)
        assert time.process_time() - at < 8 and sum(len(f[4] or "") for f in found) <= 4 * len(document) + (1 << 16) and (not whole or not found)
    nested = "<ix:nonNumeric name='n'>ab" * 3000 + "</ix:nonNumeric>" * 3000
    found, whole = accounts.facts_of(nested)
    assert not whole and found[-1][4] == "ab" and found[0][4] is None
    assert accounts.facts_of("<!-- <ix:nonNumeric name='a'>1</ix:nonNumeric>") == ([("nonNumeric", "a", None, 0, "1")], True)
    odd = "<p \"x <ix:nonNumeric name='a'>1 <b>2</b></ix:nonNumeric>"
    assert [f[4] for f in accounts.facts_of(odd)[0]] == ["1 2"]


def test_archives_are_listed_and_read_by_ranges(spark, tmp_path):
    path = str(tmp_path / "Accounts.zip")
    with zipfile.ZipFile(path, "w") as z:
        for k in range(5):
            z.writestr(f"Prod1_2_0000000{k}_{'' if k == 4 else '20240331'}.html", DOC if k != 2 else "")
        z.mkdir("folder")
    raw = bytearray(open(path, "rb").read())
    raw[raw.index(b"A &amp;", raw.index(b"00000003"))] ^= 1  # one entry no longer fits its checksum
    open(path, "wb").write(raw)
    archives = zips.Archives(io.list_archives(spark, str(tmp_path)), size=400)
    listed = archives.entries()
    assert archives.count > 1 and rows(listed.select("ordinal", "size")) == [(0, len(DOC)), (1, len(DOC)), (2, 0), (3, len(DOC)), (4, len(DOC))]
    read = archives.read(accounts.file_keys(listed))
    assert rows(read.select("ordinal", F.col("error").isNull(), F.length("content"))) == [(0, True, len(DOC)), (1, True, len(DOC)), (2, True, 0), (3, False, None)]
    got = rows(accounts.accounts(read, ["companynumber"]).select("companynumber", "company", "employees_thisyear", "employees_lastyear"))
    full = ("A & B Ltd", 12.0, None)
    assert got == [("00000000", *full), ("00000001", *full), ("00000002", None, None, None), ("00000003", None, None, None)]
    assert rows(accounts.file_keys(archives.entries(content=True)).select("ordinal", F.col("error").isNull(), F.length("content"))) == rows(read.select("ordinal", F.col("error").isNull(), F.length("content")))
    none = zips.Archives(io.list_archives(spark, str(tmp_path)).limit(0))
    assert none.entries().count() == 0 and none.read(none.entries()).count() == 0


def test_extracts_skip_what_is_there_and_keep_problems(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs = [(f"A{k % 2}.zip", f"P_2_{k:08d}_20240331.html", DOC if k % 3 else DOC + "<ix:nonNumeric>") for k in range(8)]
    df = spark.createDataFrame(docs, "archive string, entry string, content string")
    known = spark.createDataFrame([(f"{k:08d}",) for k in range(6)], "CompanyNumber string")
    assert rows(zips.write_archives(df.where("archive = 'A0.zip'"), folder).select("entries")) == [(4,)]
    pipelines.account_extracts(io.list_archives(spark, folder), out, known, "CompanyNumber")
    first = {f: f.stat().st_mtime_ns for f in (tmp_path / "out" / "extracts").rglob("*.parquet")}
    zips.write_archives(df, folder).collect()
    pipelines.account_extracts(io.list_archives(spark, folder), out, known, "CompanyNumber")
    assert all(f.stat().st_mtime_ns == at for f, at in first.items())  # the first archive was not read again
    good, bad = (pipelines.extracted(spark, out, p).withColumn("archive", x.base_name(F.col("archive"))) for p in (False, True))
    assert rows(good.select("archive", "companynumber")) == [("A0.zip", "00000002"), ("A0.zip", "00000004"), ("A1.zip", "00000001"), ("A1.zip", "00000005")]
    assert rows(bad.select("archive", "companynumber")) == [("A0.zip", "00000000"), ("A1.zip", "00000003")]
    pipelines.account_extracts(io.list_archives(spark, folder), out, known, "CompanyNumber")
    assert pipelines.extracted(spark, out).count() == 4


def test_zipped_csv_with_quotes_and_missing_columns(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("r.csv", '\ufeffCompanyName, CompanyNumber,RegAddress.PostCode,Other\r\n"A, ""x""\nB",00012,,1\r\nshort\r\n\r\nC,3,S1 2AB,\r\n')
        z.writestr("readme.txt", "no csv")
    for span in (5, 40, zips.SPAN):
        got = zips.read_zipped_csv(zips.Archives(io.list_archives(spark, str(tmp_path))), ["CompanyNumber", "CompanyName", "RegAddress.PostCode", "URI"], rows=2, span=span)
        assert got.columns == ["CompanyNumber", "CompanyName", "RegAddress_PostCode", "URI"]
        assert rows(got) == sorted([("00012", 'A, "x"\nB', None, None), (None, "short", None, None), ("3", "C", "S1 2AB", None)], key=str)


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    """Small archives are a task each, a large one is many; joins in between change nothing, nor do joined partitions; filters reach the directory."""
    for k in range(24):
        with zipfile.ZipFile(tmp_path / f"A{k}.zip", "w") as z:
            for j in range(20):
                z.writestr(f"P_2_{j:08d}_20240331.html", "x" * 50)
    archives = zips.Archives(io.list_archives(spark, str(tmp_path)))
    task = F.spark_partition_id().alias("task")
    assert archives.count == 24 and archives.entries().select("archive", task).distinct().count() == archives.entries(content=True).select(task).distinct().count() == 24
    some = link.members(archives.entries(), spark.createDataFrame([("00000003",), ("00000007",)], "companynumber string").hint("shuffle_hash"), "companynumber", "companynumber")
    assert archives.read(some).select("archive", task).distinct().groupBy("task").count().count() == 24 and archives.read(some).count() == 48
    (tmp_path / "large").mkdir()
    with zipfile.ZipFile(tmp_path / "large" / "L.zip", "w") as z:
        for j in range(400):
            z.writestr(f"P_2_{j:08d}_20240331.html", str(j) * 2000)
    large = zips.Archives(io.list_archives(spark, str(tmp_path / "large")), size=100_000)
    got = large.entries(content=True).select("entry", task, F.length("content").alias("n"))
    assert got.select("task").distinct().count() > 10 and got.count() == got.select("entry").distinct().count() == 400
    reader = zips.FilteringReader({"archives": json.dumps(large.files), "content": "true"})
    assert list(reader.pushFilters([EqualTo(("companynumber",), "00000005"), EqualTo(("size",), 1)])) == [EqualTo(("size",), 1)]
    assert [r[1] for s in reader.partitions() for r in reader.read(s)] == ["P_2_00000005_20240331.html"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        assert rows(large.entries(content=True).where("companynumber IN ('00000005', '00000399')").select("companynumber")) == [("00000005",), ("00000399",)]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_archives_of_one_name_and_broken_archives(spark, tmp_path):
    """Archives in two folders do not overwrite each other; one that can't be opened is a problem of its own."""
    out = str(tmp_path / "out")
    for k, folder in enumerate(("a", "b")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "in" / folder / "same.zip", "w") as z:
            z.writestr(f"P_2_{k:08d}_20240331.html", DOC)
    (tmp_path / "in" / "a" / "broken.zip").write_bytes(b"PK no archive")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "in")).select("path", "length")
    for known in (None, spark.createDataFrame([("00000000",), ("00000001",)], "companynumber string")):
        pipelines.account_extracts(listing, out + str(known is None), known)
        assert rows(pipelines.extracted(spark, out + str(known is None)).select("companynumber")) == [("00000000",), ("00000001",)]
        (bad,) = pipelines.extracted(spark, out + str(known is None), problems=True).collect()
        assert bad.archive.endswith("a/broken.zip") and bad.problem.startswith("not an archive")
        pipelines.account_extracts(listing, out + str(known is None), known)
        assert pipelines.extracted(spark, out + str(known is None)).count() == 2


def test_directories_are_never_held(tmp_path):
    """Archives of many entries are written, listed and read in bounded memory, and as zipfile has them; so are prefixes, comments and numbers of the large form."""
    path = tmp_path / "many.zip"
    tracemalloc.start()
    with open(path, "wb") as out, zips._Written(out) as z:
        for k in range(70_000):  # over 65,535: the large form of the end record
            z.writestr(f"P_2_{k:08d}_é.html", "x")
    (split,) = zips.splits([(str(path), path.stat().st_size)], 1 << 30)
    assert sum(r[2] == f"{k:08d}" and r[6] == b"x" for k, r in enumerate(zips.ZipReader({"content": "true"}).read(split))) == 70_000
    assert tracemalloc.get_traced_memory()[1] < 12 << 20
    tracemalloc.stop()
    odd = tmp_path / "odd.zip"
    odd.write_bytes(b"before")
    with zipfile.ZipFile(odd, "a") as z:
        with z.open("P_2_1_x.html", "w", force_zip64=True) as f:
            f.write(b"abc")
        z.comment = b"c" * 500
    for p in (path, odd):
        want = zipfile.ZipFile(p).infolist()
        assert [e[:1] + e[3:] for e in zips._directory(open(p, "rb"))] == [(i.filename, i.CRC, i.compress_size, i.file_size, i.header_offset) for i in want]
    assert [r[6] for r in zips.ZipReader({"content": "true"}).read(zips.Split(0, str(odd), 0, None))] == [b"abc"]
    raw = bytearray(path.read_bytes())
    raw[raw.rindex(b"PK\1\2")] = 0  # the directory's last entry
    path.write_bytes(raw)
    ((_, entry, *_, error),) = zips.ZipReader({}).read(split)
    assert entry is None and error.startswith("not an archive")


def test_compressed_csv_is_read_by_stretches(spark, tmp_path):
    """The same rows for any number of stretches, also where quoted line breaks, long fields or the last line without end lie on their borders; packed and stored."""
    rng = random.Random(8)
    out = StringIO(newline="")
    writer = csv.writer(out, lineterminator="\r\n")
    writer.writerow(["CompanyName", "CompanyNumber"])
    want = [("".join(rng.choices("abcdef ,\"\n\r", k=rng.choice([3, 30, 200]))).strip(" ") or None, f"{k:08d}") for k in range(4000)]
    want[1000] = ('"\n' * 60_000 + "long", "00001000")
    writer.writerows(want)
    text = out.getvalue().rstrip("\r\n").encode()
    for name, kind in (("a.zip", zipfile.ZIP_DEFLATED), ("b.zip", zipfile.ZIP_STORED)):
        folder = tmp_path / name[0]
        folder.mkdir()
        with zipfile.ZipFile(folder / name, "w", kind, compresslevel=6) as z:
            z.writestr("readme.txt", "x")
            z.writestr("Basic.csv", text)
        for span in (1, 5_000, 60_000, 1 << 24):
            archives = zips.Archives(io.list_archives(spark, str(folder)))
            points = zips.csv_points(archives, max(span, 500)).count()
            got = zips.read_zipped_csv(archives, ["CompanyNumber", "CompanyName"], span=max(span, 500)).withColumn("task", F.spark_partition_id()).collect()
            assert sorted((r.CompanyNumber, r.CompanyName) for r in got) == [(n, c) for c, n in want]
            assert points > 3 or span > 5_000
            assert len({r.task for r in got}) > 3 or points < 8
    raw = bytearray((tmp_path / "a" / "a.zip").read_bytes())
    raw[len(raw) // 2] ^= 64
    (tmp_path / "a" / "a.zip").write_bytes(raw)
    with pytest.raises(Exception):
        zips.read_zipped_csv(zips.Archives(io.list_archives(spark, str(tmp_path / "a"))), ["CompanyNumber"]).count()


def _clip(subject, window):
    """A convex polygon cut by a convex counter-clockwise one."""
    for (ax, ay), (bx, by) in zip(window, window[1:] + window[:1]):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        out = []
        for p, q in zip(subject, subject[1:] + subject[:1]):
            if side(p) >= 0:
                out.append(p)
            if side(p) * side(q) < 0:
                t = side(p) / (side(p) - side(q))
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        subject = out
    return subject


def _area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2 if ring else 0.0


SHAPES = "id int, parts array<array<array<struct<x:double,y:double>>>>"


def test_overlaps_of_convex_polygons_equal_clipping(spark):
    rng = np.random.default_rng(7)

    def convex():
        turn, centre, size = np.sort(rng.uniform(0, 2 * np.pi, rng.integers(3, 9))), rng.uniform(0, 30, 2), rng.uniform(1, 12)
        return [(float(x), float(y)) for x, y in zip(centre[0] + size * np.cos(turn), centre[1] + size * np.sin(turn))]

    large, small = [convex() for _ in range(20)], [convex() for _ in range(20)]
    table = lambda shapes: spark.createDataFrame([(k, [[s if k % 2 else s[::-1] + s[-1:]]]) for k, s in enumerate(shapes)], SHAPES)
    got = {(r.large, r.small): r.area for r in geo.overlaps(table(large), table(small), "id", "id", 4.0).collect()}
    expected = {(i, j): _area(_clip(b, a)) for i, a in enumerate(large) for j, b in enumerate(small)}
    assert len(got) > 50 and {k for k, v in expected.items() if v > 1e-6} <= set(got)
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in got)


def test_overlaps_of_polygons_with_holes_and_islands(spark):
    ell = [[[(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 2.0), (0.0, 2.0)]]]
    holed = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]], [[(1.5, 1.5), (1.5, 2.5), (2.5, 2.5), (2.5, 1.5)]]]
    square = [[[(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)]]]
    df = spark.createDataFrame([(1, ell), (2, holed), (3, square)], SHAPES)
    got = {(r.large, r.small): round(r.area, 9) for r in geo.overlaps(df, df, "id", "id", 1.5).collect()}
    assert got == {(1, 1): 3.0, (1, 2): 3.0, (1, 3): 3.0, (2, 1): 3.0, (2, 2): 13.0, (2, 3): 3.25, (3, 1): 3.0, (3, 2): 3.25, (3, 3): 4.0}


def test_square_grid_edges(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.5), (2.0, 2.0)], "x double, y double")
    assert [r.cell for r in geo.square_cells(df, "x", "y", 1.0).orderBy("x").collect()] == [1, 2, 4]
    assert geo.square_cells(df, "x", "y", 1.0, edges="both").count() == 4


def test_every_point_is_in_its_nearest_hexagon(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([tuple(map(float, p)) for p in rng.uniform(0, 100, (300, 2))], "x double, y double")
    cells = geo.hex_cells(df, "x", "y", 10.0, origin=(0.0, 0.0))
    cx, cy = geo.hex_centre(F.col("q"), F.col("r"), 10.0)
    assert cells.select(F.max(F.sqrt((F.col("x") - cx) ** 2 + (F.col("y") - cy) ** 2))).first()[0] <= 10 / np.sqrt(3) + 1e-9


def test_regression_edge_cases(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.0), ("b", 3.0, 2.0), ("c", 1.0, 1.0), ("c", 2.0, 1.0)], "g string, y double, x double")
    got = {r.g: (r.slope, r.se) for r in stats.ols_by_group(df, ["g"], "y", "x").collect()}
    assert got["a"] == (None, None) and got["c"] == (None, None) and got["b"][0] == 2.0 and np.isnan(got["b"][1])


def test_colocation_scores_means_and_peaks(spark):
    rng, reps = np.random.default_rng(1), 6
    data = [(i, int(i % 3), float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(45, 2)))]
    got = stats.colocation(spark.createDataFrame(data, "id long, label int, x double, y double"), "label", 1, 2, reps).first()
    at = np.array([r[2:] for r in data])
    label = np.array([r[1] for r in data])

    def both(a, b):
        d = np.sqrt(((at[a][:, None] - at[b][None]) ** 2).sum(axis=2)).ravel()
        q1, q3 = np.quantile(d, (0.25, 0.75))
        w = 0.9 * min(d.std(ddof=1), (q3 - q1) / 1.34) * len(d) ** -0.2
        grid = np.linspace(d.min() - 3 * w, d.max() + 3 * w, 512)
        return d.mean(), grid[np.exp(-0.5 * ((grid[:, None] - d) / w) ** 2).sum(axis=1).argmax()]

    def draw(rep, side):
        return sorted(range(45), key=lambda i: (hashlib.md5(f"{i}:{rep}:{side}".encode()).hexdigest(), i))[:15]

    seen, null = both(label == 1, label == 2), np.array([both(draw(k, "x"), draw(k, "y")) for k in range(reps)])
    for k, names in enumerate((("observed", "expected", "sd", "z"), ("observed_peak", "expected_peak", "sd_peak", "z_peak"))):
        m, sd = null[:, k].mean(), null[:, k].std(ddof=1)
        assert np.allclose([got[n] for n in names], [seen[k], m, sd, (seen[k] - m) / sd], atol=0.02 * k + 1e-9)


def test_pairs_are_made_in_packs_and_never_gathered(spark, monkeypatch):
    """Packs of few points, copies of one point, NULLs: all pairs once, no side broadcast, no row a pair."""
    monkeypatch.setattr(stats, "PACK", 7)
    rng = np.random.default_rng(4)
    at = [[(k, float(x), float(y)) for k in range(3) for x, y in rng.normal(size=(20 * k + 1, 2))] + [(2, 1.5, 1.5)] * 30 for _ in "ab"]
    sides = [spark.createDataFrame([*side, (1, None, 0.0)], "rep long, x double, y double") for side in at]
    packs = stats.pair_packs(*sides)
    assert "Broadcast" not in packs._jdf.queryExecution().executedPlan().toString() and packs.count() < sum(len(side) for side in at)
    got = {r.rep: r for r in stats.pair_summary(packs).collect()}
    for rep in range(3):
        a, b = (np.array([p[1:] for p in side if p[0] == rep]) for side in at)
        d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)).ravel()
        assert got[rep].n == len(d) and np.allclose([got[rep].mean_distance, got[rep].lo, got[rep].hi], [d.mean(), d.min(), d.max()])
        assert got[rep].sd is None if len(d) < 2 else np.isclose(got[rep].sd, d.std(ddof=1))
    assert stats.mean_distance(sides[0], sides[1].limit(0)).first()[0] is None


def test_colocation_query_takes_all_repetitions(spark, monkeypatch):
    called = {}
    monkeypatch.setattr(stats, "_scores", lambda each, peaks, real=stats._scores: called.setdefault("reps", each.count() - 1) and real(each, peaks))
    out = queries.QUERIES["colocation_z"](spark, "/root/testdata/sf0.001")
    assert called == {"reps": 1000} and {"z", "z_peak", "observed_peak"} <= set(out.columns)


def test_grid_distances_are_within_a_cell_of_the_points(spark):
    """Means and peaks of two groups, observed and drawn, beside those of all pairs; a finer grid is nearer."""
    rng = np.random.default_rng(5)
    data = [(i, int(i % 3), float(x + (i % 3 == 1)), float(y)) for i, (x, y) in enumerate(rng.normal(size=(1200, 2)))]
    df = spark.createDataFrame([*data, (9999, 1, None, 1.0), (9998, 2, float("nan"), 1.0)], "id long, label int, x double, y double")
    at, label = np.array([r[2:] for r in data]), np.array([r[1] for r in data])
    d = np.sqrt(((at[label == 1][:, None] - at[label == 2][None]) ** 2).sum(axis=2)).ravel()
    q1, q3 = np.quantile(d, (0.25, 0.75))
    w = 0.9 * min(d.std(ddof=1), (q3 - q1) / 1.34) * len(d) ** -0.2
    grid = np.linspace(d.min() - 3 * w, d.max() + 3 * w, 512)
    peak = grid[sum(np.exp(-0.5 * ((grid[:, None] - part) / w) ** 2).sum(axis=1) for part in np.array_split(d, 50)).argmax()]
    rough, fine = (stats.colocation_by_grid(df, "label", 1, 2, 40, cells).first() for cells in (32, 256))
    for got in (rough, fine):
        assert abs(got.observed - d.mean()) < got.within and abs(got.observed_peak - peak) < got.within + 0.05
    assert abs(fine.observed - d.mean()) < 0.02 * fine.within < 0.02 * rough.within
    null = [np.sqrt(((at[rng.permutation(1200)[:400]][:, None] - at[rng.permutation(1200)[:400]][None]) ** 2).sum(axis=2)).mean() for _ in range(300)]
    assert abs(fine.expected - np.mean(null)) < 5 * np.std(null) / 40**0.5 and 0.6 < fine.sd / np.std(null) < 1.5 and fine.z > 2
    assert stats.colocation_by_grid(df, "label", 1, 7, 3).first().z is None and stats.colocation_by_grid(df.limit(0), "label", 1, 2, 3).first().observed is None


def test_natural_breaks_match_a_direct_search(spark, monkeypatch):
    import itertools

    v = [1, 1, 2, 3, 10, 11, 12, 30, 31, 50]
    found = lambda v, classes: [r.upper for r in stats.natural_breaks(spark.createDataFrame([(float(i),) for i in v], "v double"), "v", classes).orderBy("class").collect()]
    got = found(v, 4)
    assert [x - 1e9 for x in found([1e9 + x for x in v], 4)] == got  # squares of large values do not cancel
    assert found([5, 5, 7], 4) == [5.0, 7.0] and found([], 3) == []
    rng = np.random.default_rng(2)
    many = np.unique(np.round(np.exp(rng.normal(3, 2, 900)), 2))  # over 512 levels, skewed
    d = many - many.mean()
    s, ss = np.concatenate([[0], np.cumsum(d)]), np.concatenate([[0], np.cumsum(d * d)])
    n = len(many)
    cost = lambda i, j: ss[j] - ss[i] - (s[j] - s[i]) ** 2 / (j - i)
    best, back = np.array([np.inf] + [cost(0, j) for j in range(1, n + 1)]), []
    for _ in range(2):
        total = [min((best[i] + cost(i, j), i) for i in range(1, j)) if j > 1 else (np.inf, 0) for j in range(n + 1)]
        best = np.array([t[0] for t in total])
        back.append([t[1] for t in total])
    upper, j = [many[-1]], n
    for b in reversed(back):
        j = b[j]
        upper.append(many[j - 1])
    assert n > 512 and found(many, 3) == upper[::-1]
    monkeypatch.setattr(stats, "TWO_STEPS", 1)
    monkeypatch.setattr(stats, "FAN", 4)
    assert found(many, 3) == upper[::-1]  # in many steps
    levels = sorted(set(v))
    cost = lambda part: sum((i - np.mean(part)) ** 2 for i in part)
    best = min(itertools.combinations(levels[:-1], 3), key=lambda c: sum(cost([i for i in v if lo < i <= hi]) for lo, hi in zip((-1, *c), (*c, 99))))
    assert got == [*map(float, best), 50.0]


def test_stream_keeps_the_latest_of_all_batches(spark, tmp_path):
    """After every batch as the batch form of all rows so far; each run starts from the checkpoint. A group dropped for a NULL date stays dropped; ties and values stay as they are."""
    batches = [[("a", None, 1), ("b", 1, 2), ("c", 5, None), (None, 1, 3)], [("a", 3, 4), ("b", 2, 5), ("d", None, 2**53 + 1), ("c", 5, 6)], [("b", 2, 7), ("c", 4, 8), ("a", 9, 9), (None, 2, 10)], [("b", 1, k) for k in range(500)]]
    schema, source, checkpoint, seen = "k string, d int, v long", str(tmp_path / "in"), str(tmp_path / "cp"), []
    session = incremental.stateful_session(spark, 3)
    stored = []
    for batch in batches:
        seen += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        incremental.keep_latest(session.readStream.schema(schema).parquet(source), "k", "d", checkpoint)
        got = incremental.latest_rows(spark, checkpoint)
        assert got.columns == ["k", "d", "v"] and rows(got) == rows(agg.latest(spark.createDataFrame(seen, schema), "k", "d"))
        stored.append(got.count())
    assert stored[3] == stored[2] and spark.conf.get("spark.sql.shuffle.partitions") == "4"  # 500 older rows store nothing
    assert incremental.latest_rows(spark, checkpoint).where("k = 'd'").first().v == 2**53 + 1


def test_stream_state_is_read_and_written_by_groups_of_keys(spark, tmp_path):
    """As many states as groups, not as keys; all of a group's keys keep their own latest rows."""
    source, checkpoint, seen = str(tmp_path / "in"), str(tmp_path / "cp"), []
    session = incremental.stateful_session(spark, 2)
    for n in range(2):
        seen.append(spark.range(600).selectExpr("id % 400 AS k", f"CASE WHEN id % 97 = 0 THEN NULL ELSE DATE '2020-01-01' + CAST(id * {7 + n} % 50 AS INT) END AS d", "id AS v"))
        seen[-1].write.mode("append").parquet(source)
        incremental.keep_latest(session.readStream.schema(seen[0].schema).parquet(source), "k", "d", checkpoint, groups=8)
    assert rows(incremental.latest_rows(spark, checkpoint)) == rows(agg.latest(seen[0].union(seen[1]), "k", "d"))
    assert spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "kept").load().count() == 8


def test_quantiles_by_refinement_equal_percentiles(spark):
    """Ties, extreme ranges, infinities, NULL groups, single values; with few parts, many rounds."""
    rng = np.random.default_rng(9)
    data = [("even", float(x)) for x in rng.normal(size=700)] + [("tied", float(x)) for x in rng.integers(0, 4, 300)] + [("wide", float(x)) for x in 10.0 ** rng.integers(-300, 300, 200)] + [("wide", -1e-310), ("wide", 5e-324)]
    data += [("one", 7.0), ("same", 2.0), ("same", 2.0), (None, 1.0), (None, 3.0), ("void", None), ("ends", float("-inf")), ("ends", float("inf")), *(("ends", float(k)) for k in range(20)), ("huge", 1.7e308), ("huge", -1.7e308), ("huge", 0.0), ("huge", 1.0)]
    df = spark.createDataFrame(data, "v string, _k double").withColumnRenamed("_k", "k")
    ps = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    want = {r.v: list(r.q) for r in df.where("k IS NOT NULL").groupBy("v").agg(F.percentile("k", F.array(*map(F.lit, ps))).alias("q")).collect()}
    for parts, few in ((1024, 1000), (1024, 1), (4, 3)):
        got = {r.v: list(r.quantiles) for r in agg.quantiles(df, ["v"], "k", ps, parts, few).collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[g], want[g], rtol=1e-12, atol=0, equal_nan=True) for g in want)
    whole = agg.quantiles(df.where("v = 'even'"), [], "k", [0.5], 16, 5).first()
    assert (whole.n, whole.quantiles) == (700, [want["even"][3]]) and agg.quantiles(df.limit(0), ["v"], "k", [0.5]).count() == 0


def test_date_orders_are_learned_from_the_column(spark):
    us = spark.createDataFrame([("03/04/2024",), ("12/31/2023",), ("1/15/2024",), (None,), ("x",)], "d string")
    assert [r.d for r in x.with_trained_dates(us, "d").collect()] == [dt.date(2024, 3, 4), dt.date(2023, 12, 31), dt.date(2024, 1, 15), None, None]
    uk = spark.createDataFrame([("03/04/2024",), ("31/12/2023",), ("03/04/2024",)], "d string")
    assert [r.d for r in x.with_trained_dates(uk, "d").collect()] == [dt.date(2024, 4, 3), dt.date(2023, 12, 31), dt.date(2024, 4, 3)]
    assert x.date_orders(us.limit(0), "d") == x.DATE_FORMATS


def test_bucketed_tables_join_without_an_exchange(spark):
    out = queries.QUERIES["link_bucketed_accounts"](spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries.QUERIES["link_bucketed_accounts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Window" in plan and "SortMergeJoin" in plan and out.count() > 0


def test_indexed_search_equals_a_scan(spark, tmp_path):
    """Patterns with and without sure runs of characters, NULLs, archives added again; few files are read."""
    rng, path = random.Random(11), str(tmp_path / "index")
    words = ["Dormant", "true", "Turnover", "ÉTÉ", "a|b", "x.y", "Straße", "employees (average)"]
    data = [(f"A{k % 3}", f"frs:{rng.choice(words)}{k % 40}", rng.choice([None, "", "12", " ".join(rng.choices(words, k=4))])) for k in range(600)]
    df = spark.createDataFrame(data, "archive string, name string, value string").withColumn("gram", F.lit("x"))
    factindex.add(df.where("archive <> 'A2'"), path)
    factindex.add(df.where("archive <> 'A0'").withColumn("name", F.lit("only turnover")), path)
    factindex.add(df.where("archive <> 'A0'"), path)  # A1 and A2 again: nothing of before stays
    for pattern in ("dormant.* true", "turn", "TURNOVER1.*turn", "no such thing", "12", "tru?e", "(true|dorm)", "x\\.y", "employees \\(av", "^frs:Dorm", "[a-z]{3}mant", "été", "straße", "true.*(dormant)? turn", "tur{2}n", "frs:.+7 .*ee"):
        want = rows(accounts.search(df, pattern))
        got = factindex.search(spark, path, pattern)
        assert rows(got.select(*df.columns)) == want, pattern
    hits = spark.read.parquet(f"{path}/postings").where(F.col("_range").isin([1]))
    assert 0 < len(hits.inputFiles()) and factindex.literals("dormant.* true") == ["dormant", " true"] and factindex.literals("a.b") is None and factindex.literals("(abc)*x") is None
    plan = factindex.search(spark, path, "turnover1.*turn")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_range" in plan or "_range#" in plan.split("PartitionFilters", 1)[1]


def test_postings_are_a_row_a_trigram_and_stretch(spark, tmp_path):
    """However many facts hold a trigram; every fact is in the row of each of its trigrams once."""
    path = str(tmp_path / "index")
    df = spark.range(3000, numPartitions=2).selectExpr("'A' AS archive", "'frs:ababab' AS name", "CAST(id % 5 AS STRING) AS value")
    factindex.add(df, path)
    postings = spark.read.parquet(f"{path}/postings")
    assert postings.count() == postings.select("gram", "_stretch").distinct().count() < 50
    assert [tuple(r) for r in postings.where("gram = 'aba'").select(F.sum(F.size("_ids")), F.count_distinct("_stretch")).collect()] == [(3000, 2)]
    assert spark.read.parquet(f"{path}/grams").where("gram = 'aba'").first().n == 3000
    assert factindex.search(spark, path, "ababab 3").count() == 600


def test_group_aggregates_join_back_with_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 6.0), ("b", None)], "g string, v double")
    assert rows(agg.share_of_group(df, ["g"], "v").select("g", "pct", "group_count")) == rows(spark.createDataFrame([("a", 25.0, 2), ("a", 75.0, 2), (None, 25.0, 2), (None, 75.0, 2), ("b", None, 1)], "g string, pct double, n long"))
    assert rows(agg.repeated(df, ["g"]).select("v")) == [(1.0,), (2.0,), (3.0,), (6.0,)]
    assert abs(df.agg(agg.median("v", True)).first()[0] - 2) <= 1


def test_incremental_stream_sees_each_file_once(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    for k in range(2):
        (folder / f"{k}.zip").write_bytes(b"x")
        incremental.run_once(incremental.new_files(spark, str(folder)), str(tmp_path / "cp"), lambda df, n: seen.append(df.count()))
    assert [n for n in seen if n] == [1, 1]


def test_an_archive_is_packed_and_listed_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task packs a whole archive, and no split passes over a whole directory; what comes out is as zipfile has it, places over 4 GB too."""
    names = [f"P_2_{k:08d}_{'é' if k % 2 else 'e'}.html" for k in range(3000)]
    data = [(f"A{k % 2}.zip", name, None if k % 5 == 0 else random.Random(k).randbytes(400)) for k, name in enumerate(names)] + [("A1.zip", "large.html", random.Random(1).randbytes(3 << 20))]
    df = spark.createDataFrame(data, "archive string, entry string, content binary").repartition(5)
    parts = df.repartitionByRange(6, "archive", "entry").sortWithinPartitions("archive", "entry").mapInPandas(zips._parts, "archive string, directory boolean, part int, k int, piece binary, places binary")
    assert parts.where("archive = 'A1.zip'").select("part").distinct().count() > 2 and parts.agg(F.max(F.length("piece"))).first()[0] <= zips.PART
    assert rows(zips.write_archives(df, str(tmp_path)).select("entries")) == [(1500,), (1501,)]
    for archive in ("A0.zip", "A1.zip"):
        with zipfile.ZipFile(tmp_path / archive) as z:
            assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == {n: c or b"" for a, n, c in data if a == archive}
            assert z.namelist() == sorted(z.namelist()) and len(z.namelist()) == len(set(z.namelist()))
    archives = zips.Archives(io.list_archives(spark, str(tmp_path)), size=100_000)
    assert rows(archives.read(archives.entries()).select(F.regexp_extract("archive", "A.\\.zip", 0), "entry", "content")) == rows(spark.createDataFrame([(a, n, c or b"") for a, n, c in data], "a string, b string, c binary"))
    (path,) = (p for p, _ in archives.files if p.endswith("A0.zip"))
    known = [s for s in zips.ZipReader({"archives": json.dumps(archives.files), "size": "100000", "stretches": json.dumps(archives.stretches)}).partitions() if s.path == path]
    assert len(known) > 4 and sum(s.stretch[1] for s in known) == zips._directory_of(zips._file(path))[1] and max(s.stretch[1] for s in known) < 40_000
    (name, place) = ("x" * 9, 5 << 30)
    record = b"".join(zips._placed(zips._packed(name, b"abc")[1], (7).to_bytes(8, "little"), place))
    end = zips._end(1, place + 100, len(record))
    assert len(end) > zips.END.size and zips._end(70_000, 0, 5).startswith(b"PK\6\6")
    ((_, entry),) = zips._records(BytesIO(record), 0, len(record), 0)
    assert entry[0] == name and entry[-1] == place + 7 and entry[5] == 3
    raw = bytearray((tmp_path / "A0.zip").read_bytes())
    raw[raw.rindex(b"PK\1\2")] = 0  # the directory's last entry
    (tmp_path / "A0.zip").write_bytes(raw)
    got = zips.Archives(io.list_archives(spark, str(tmp_path)), size=100_000).entries().where("archive LIKE '%A0.zip'").collect()
    assert [r.entry for r in got] == [None] and got[0].error.startswith("not an archive")
