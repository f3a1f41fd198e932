"""The register's pipelines as compositions of operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.functions.exprs import DATE_FORMATS, age_in_years, label_number, normalise_postcode, parse_date, percent_change
from regiscope.operators import accounts, agg, geo, link
from regiscope.operators.predicates import both_positive, drop_matching, keep_matching
from regiscope.sources import io, zips
from regiscope.streaming.incremental import stored

DORMANT_SIC = "99999"


def register_snapshot(spark: SparkSession, archives: str, out: str, date: str) -> None:
    """The register from its zipped CSV files, pruned, as the snapshot of a date."""
    io.write_snapshot(zips.read_zipped_csv(zips.Archives(io.list_archives(spark, archives)), io.REGISTER), out, date)


def account_extracts(listing: DataFrame, out: str, known: DataFrame | None = None, companynumber: str = "companynumber") -> None:
    """Accounts of all listed archives (path, length) under `out`, a partition for each archive; those in its manifest are skipped.

    Archives are told apart by their whole paths. Entries without keys, and of companies not among the known ones if given,
    are never read. An archive or entry that is damaged, or in which a fact tag does not close, is kept with its `problem`.
    Partitions are replaced as wholes and the manifest is written last, so a run that broke off is repeated.
    """
    spark = listing.sparkSession
    manifest = stored(spark, f"{out}/manifest")
    fresh = listing.select("path", "length")
    fresh = fresh if manifest is None else fresh.join(manifest.select("path").distinct(), "path", "left_anti")
    archives = zips.Archives(fresh)
    if not archives.files:
        return
    keyed = accounts.file_keys(archives.entries(content=known is None))
    if known is not None:
        keyed = archives.read(link.members(keyed, known, "companynumber", companynumber))
    made = accounts.accounts(keyed, ["archive", "entry", "companynumber", "accountcode", "error"])
    problem = F.coalesce("error", F.when(~F.col("whole"), F.lit("a fact tag does not close")))
    unread = archives.entries().where("entry IS NULL").select("archive", F.col("error").alias("problem"))
    rows = made.withColumn("problem", problem).drop("error", "whole").unionByName(unread, allowMissingColumns=True)
    io.write_partitioned(rows.withColumn("folder", F.sha2("archive", 256)), f"{out}/extracts", "folder")
    spark.createDataFrame([(p,) for p, _ in archives.files], "path string").write.mode("append").parquet(f"{out}/manifest")


def extracted(spark: SparkSession, out: str, problems: bool = False) -> DataFrame:
    """The accounts of `account_extracts`, or the archives and entries with problems. `archive` is a whole path."""
    rows = spark.read.parquet(f"{out}/extracts").drop("folder")
    return rows.where("problem IS NOT NULL").select("archive", "entry", "companynumber", "accountcode", "problem") if problems else rows.where("problem IS NULL").drop("problem")


def geocoded(register: DataFrame, postcodes: DataFrame, postcode: str = "RegAddress_PostCode") -> DataFrame:
    """The register's rows with a known postcode, with its area codes and coordinates."""
    lookup = postcodes.withColumn("Postcode", normalise_postcode(F.col("Postcode"))).withColumnsRenamed({"Postcode": "postcode"}).withColumnsRenamed({"Eastings": "easting", "Northings": "northing"})
    return link.located(register.withColumn("postcode", normalise_postcode(F.col(postcode))), lookup, "postcode", "easting", "northing")


def latest_accounts(extracts: DataFrame, order: list[str], key: str = "companynumber", code: str = "accountcode", date: str = "enddate", formats: tuple[str, ...] = DATE_FORMATS, bucketed: bool = False) -> DataFrame:
    """Each account once (its first row in `order`), its date parsed, and each company's latest.

    `formats` are the date orders, as `exprs.date_orders` learns them from the column; `bucketed` says that the extracts are stored in buckets of companies.
    """
    dealt = extracts if bucketed else extracts.repartition(key)  # by company once, for both windows
    once = agg.first_rows(dealt, [key, code], order)
    return agg.latest(once.withColumn(date, parse_date(F.col(date), formats)), key, date)


def linked(register: DataFrame, accounts: DataFrame, key: str, account_key: str, active: Column) -> DataFrame:
    return link.lookup(register.where(active), accounts, key, account_key, "inner")


def with_sectors(df: DataFrame, sectors: DataFrame, text: str, code: str = "SIC_5DIGIT_CODE") -> DataFrame:
    """Joins the sector of the first five characters; dormant and unknown codes go."""
    found = link.lookup(df.withColumn("sic5", F.substring(text, 1, 5)), sectors, "sic5", code)
    return found.where(F.col("sic5") != DORMANT_SIC)


def quality_report(register: DataFrame, located: DataFrame, extracts: DataFrame, key: str, postcode: str, address: str, status: str, sic: str, account_key: str, employees: str) -> DataFrame:
    """measure, category, other and value: shares (per cent) of rows without a postcode match, of those without postcode but
    with an address, of each status, of dormant sectors within each status; numbers of accounts per company, and of accounts
    by whether they have an employee count. The register is summed in one pass, the accounts in another."""
    hits = located.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    flags = register.join(hits, register[key].eqNullSafe(hits["_key"]), "left").withColumn("_dormant", F.col(sic).startswith(DORMANT_SIC))
    miss = F.col("_hit").isNull()
    g = io.written(flags.groupBy(F.col(status).alias("category"), F.col("_dormant").alias("dormant")).agg(F.count("*").alias("n"), F.count_if(miss).alias("miss"), F.count_if(miss & F.col(postcode).isNull() & F.col(address).isNotNull()).alias("bare")))  # two rows a status
    out = None

    def add(df: DataFrame, measure: str, category: Column, other: Column, value: Column) -> None:
        nonlocal out
        rows = df.select(F.lit(measure).alias("measure"), category.cast("string").alias("category"), other.cast("string").alias("other"), value.cast("double").alias("value"))
        out = rows if out is None else out.unionByName(rows)

    none = F.lit(None)
    whole = g.agg(F.sum("n").alias("n"), F.sum("miss").alias("miss"), F.sum("bare").alias("bare"))
    add(whole, "no match", none, none, F.col("miss") * 100.0 / F.col("n"))
    add(whole, "no match but address", none, none, F.col("bare") * 100.0 / F.col("n"))
    by_status = agg.with_group(g.where("category IS NOT NULL").groupBy("category").agg(F.sum("n").alias("n")), [], total=F.sum("n"))
    add(by_status, "status", F.col("category"), none, F.col("n") * 100.0 / F.col("total"))
    by_both = agg.with_group(g.where("category IS NOT NULL AND dormant IS NOT NULL"), ["category"], few=True, total=F.sum("n"))
    add(by_both, "dormant within status", F.col("category"), F.col("dormant"), F.col("n") * 100.0 / F.col("total"))
    add(agg.count_histogram(extracts, account_key), "accounts per company", F.col("rows_per_key"), none, F.col("keys"))
    add(agg.frequency(extracts.withColumn("_has", F.col(employees).isNotNull()), "_has"), "has employees", F.col("_has"), none, F.col("n"))
    return out


def sector_layers(located: DataFrame, path: str, where: Column, x: str, y: str, properties: list[str]) -> None:
    """A point layer of the located firms that the condition picks (such as active ones of a sector)."""
    io.write_features(located.where(where), path, x, y, properties)


def app_extract(register: DataFrame, accounts_: DataFrame, sectors: DataFrame, key: str, account_key: str, text: str, employees: str, code: str = "SIC_5DIGIT_CODE") -> DataFrame:
    """All accounts that have an employee count, with their firm and sector beside them (NULL where there is none)."""
    both = link.lookup(register, accounts_, key, account_key, "right").withColumn("sic5", F.substring(text, 1, 5))
    return link.lookup(both, sectors, "sic5", code).where(F.col(employees).isNotNull())


def modal_sector(df: DataFrame, x: str, y: str, size: float, sector: str, value: str, least: float, exclude: str) -> DataFrame:
    """Each hexagon's sector with the greatest sum, of hexagons whose sums reach `least`."""
    cells = drop_matching(geo.hex_cells(df.where(F.col(value) > 0), x, y, size), sector, exclude)
    sums = cells.where(F.col(sector).isNotNull()).groupBy("q", "r", sector).agg(F.sum(value).alias("total"))
    return agg.arg_max(agg.having_total(sums, ["q", "r"], "total", least), ["q", "r"], "total", sector)


def median_age(df: DataFrame, x: str, y: str, size: float, date: str, as_of: Column, least: int, approximate: bool = False) -> DataFrame:
    aged = df.withColumn("age", age_in_years(F.col(date), as_of))
    out = geo.hex_cells(aged, x, y, size).groupBy("q", "r").agg(agg.strict(agg.median("age", approximate), "age").alias("median_age"), F.count("*").alias("firms")).where(F.col("firms") >= least)
    return out.withColumn("label", F.concat(F.lit("Median age: "), label_number(F.col("median_age")), F.lit(" yrs, firm count: "), F.col("firms").cast("string")))


def region_growth(df: DataFrame, keys: list[str], last: str, this: str, least: int) -> DataFrame:
    return agg.growth(df.where(both_positive(last, this)), keys, last, this, least)


def coverage(df: DataFrame, last: str, this: str) -> DataFrame:
    """Shares of rows with employee values, all in one pass."""
    a, b = F.col(last), F.col(this)
    return df.agg(*(agg.share_true(p).alias(n) for n, p in {"this_present": b.isNotNull(), "both_present": a.isNotNull() & b.isNotNull(), "this_positive": b > 0, "either_positive": (a > 0) | (b > 0), "both_nonzero": (a != 0) & (b != 0), "both_positive": (a > 0) & (b > 0)}.items()))


def outliers(df: DataFrame, ids: list[str], values: list[str], over: float) -> DataFrame:
    return agg.to_long(df, ids, values, "year", "employees").where(F.col("employees") > over)


def region_subset(register: DataFrame, by_code: DataFrame, key: str, place: str, pattern: str) -> DataFrame:
    """How many rows a lookup and a place name find: one, the other, or both."""
    return link.overlap_report(link.members(register, by_code, key), keep_matching(register, place, pattern), key)


def sector_change(df: DataFrame, sector: str, last: str, this: str, least: float) -> DataFrame:
    kept = df.where(both_positive(last, this) & (F.col(last) >= least)).withColumn("change", percent_change(F.col(last), F.col(this)))
    return agg.category_rank(kept, sector, F.avg("change"))
