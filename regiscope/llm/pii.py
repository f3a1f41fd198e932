"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the spans of four kinds (email, ip, card, phone) by their base patterns, and looser ones that these miss:
spelt-out addresses, IPv6 addresses, card numbers that run into other numbers, phone numbers without a country code or
followed by more digits, and secrets (keys and tokens), a kind of its own without base pattern and beside the four. Three labelers vote on each candidate:
the pattern with its checks, a gazetteer (top-level domains, address ranges, issuers, country codes, key prefixes), and the
words before it. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is and how
likely each candidate is personal data. On these probabilities a logistic span classifier is trained that sees the span
itself, not the votes: its check, length, share of digits, quotes around it, an assignment or announcing word before it,
and base spans near it. It adds the looser candidates it finds likely; base spans stay. Both fits run on one table of
counts of vote and feature patterns, whose size is bounded by the number of patterns whatever the input.

A null text counts as empty. Positions are code points, ends exclusive. Rows are treated one by one; repeated rows and ids
give repeated results; other columns, whatever their names, are ignored. Patterns are possessive or of bounded length and
start only at the start of a run of their characters or where the last match ended, so long runs of any text take linear
time and no recursion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
OPEN, SHUT, OTHER = "\x01", "\x02", "\x03"

# The base pattern of each kind, with the same matches as greedy search from the left.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Looser patterns.
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\+[0-9]{1,3} ?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
# Words that announce a kind, and gazetteers.
CONTEXT = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|address|adresse|correo|courriel)\W*$",
    "ip": r"(?i)(?:\bip\b|address|host|server|from|client|login)\W*(?:\w+\W+){0,2}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|pan)\W*(?:\w+\W+){0,2}$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|telefon|telefono|teléfono|téléphone|whatsapp)\W*(?:\w+\W+){0,2}$",
    "secret": r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|bearer|credentials?)\W{0,6}$",
}
AGAINST = {"secret": r"(?i)(?:commit|sha-?[0-9]*|md5|checksum|digest|hash|uuid|https?|www|version)\W{0,4}(?:\w+\W{1,2})?$", "card": r"(?i)(?:isbn|order|invoice|tracking|serial|nr|no)\W{0,4}$", "phone": r"(?i)(?:isbn|order|invoice|tracking|serial)\W{0,4}$"}
# Public registries: generic top-level domains and any country code; addresses that no special-purpose range holds; issuers' first digits; country calling codes.
GENERIC = "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post arpa app dev page cloud online site shop store blog tech xyz club live news email company agency".split()
SPECIAL = (r"0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5]", r"100\.(?:6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|198\.1[89]", r"192\.0\.[02]|192\.88\.99|198\.51\.100|203\.0\.113")
ISSUERS = r"4|5[0-8]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-59]|[689])|35(?:2[89]|[3-8])|6"
CALLING = (r"1|7|20|27|3[0-4]|36|39|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-368]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|26[0-9]|29[0178-9]|35[0-9]|37[0-9]|38[0-35-79]|42[013]|50[0-9]|59[0-9]|67[02-9]|68[0-35-9]|69[0-2]|80[08]|85[02356]|87[08]|88[01368]|96[0-8]|97[0-79]|99[2-68]")
GAZETTEER = {
    "email": rf"(?i)[. \])](?:[a-z]{{2}}|{'|'.join(GENERIC)})$",
    "ip": rf"^(?!0*(?:{'|'.join(SPECIAL)})\.)[0-9A-Fa-f]+[.:]",
    "card": rf"^(?:{ISSUERS})",
    "phone": rf"^\+(?:{CALLING})|^\(?[2-9][0-9]{{2}}\)?[ .-]",
    "secret": r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|sk-|sk_|pk_|xox[abp]-|AIza|eyJ|glpat-|ya29)|^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$",
}
ROUNDS = 25


def _masked(text: str) -> Column:
    """The text with the characters used as marks replaced: none belongs to any pattern."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.when(t.contains(OPEN) | t.contains(SHUT), F.translate(t, OPEN + SHUT, OTHER * 2)).otherwise(t)


def _with_spans(df: DataFrame, out: str, pattern: str, holds: Column) -> DataFrame:
    """Adds array<struct<start,end,value>> of the pattern's matches in column t."""
    marked = F.split(F.regexp_replace("t", pattern, OPEN + "$0" + SHUT), f"[{OPEN}{SHUT}]")
    df = df.withColumn("_p", F.when(holds, marked))
    df = df.withColumn("_n", F.transform("_p", lambda x: F.length(x)))
    sums = "transform(sequence(0, (size(_n) - 1) div 256), b -> aggregate(slice(_n, cast(b * 256 + 1 as int), 256), 0, (a, x) -> a + x))"
    df = df.withColumn("_b", F.expr(f"aggregate({sums}, array(0), (a, x) -> concat(a, array(element_at(a, -1) + x)))"))
    start = "_b[i div 256] + aggregate(slice(_n, cast((i div 256) * 256 + 1 as int), cast(i % 256 as int)), 0, (a, x) -> a + x)"
    spans = F.expr(f"transform(filter(sequence(0, size(_p) - 1), i -> i % 2 = 1), i -> named_struct('start', {start}, 'end', {start} + _n[i], 'value', _p[i]))")
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    return df.withColumn(out, F.when(F.size("_p") > 1, spans).otherwise(empty)).drop("_p", "_n", "_b")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether a number's digits pass the check sum."""
    digit = F.transform(F.filter(F.split(F.reverse(_digits(value)), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(digit, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.try_to_number(part(x), F.lit("999")) <= 255))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda s: _valid(kind, s.value)


def _clear_of(column: str):
    return lambda s: ~F.exists(column, lambda b: (b.start < s.end) & (s.start < b.end))


def candidates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, t, and arrays of spans: base_<kind> (valid ones) and loose_<kind> (all others that may be personal data)."""
    df = documents.select(F.col(doc_id).cast("long").alias("doc_id"), _masked(text).alias("t"))
    df = df.withColumn("_digit", F.col("t").rlike("[0-9]"))
    holds = {"email": F.col("t").contains("@"), "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.col("_digit") & F.col("t").contains("+")}
    for kind in KINDS:
        df = _with_spans(df, f"all_{kind}", BASE[kind], holds[kind])
        df = df.withColumn(f"base_{kind}", F.filter(f"all_{kind}", _is_valid(kind)))
    holds = {"email": F.col("t").contains("[at]") | F.col("t").contains("(at)"), "ip": F.col("t").rlike("[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"), "card": F.col("t").rlike("[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"),
             "phone": F.col("t").rlike("[0-9]{3}[ .-][0-9]{4}"), "secret": F.col("t").rlike("[A-Za-z0-9+/_-]{20}")}
    for kind, hold in holds.items():
        df = _with_spans(df, f"loose_{kind}", LOOSE[kind], hold)
    df = df.withColumn("_taken", F.concat(*(F.transform(f"base_{k}", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"))) for k in KINDS)))
    for kind in ALL_KINDS:  # looser spans keep clear of all base spans
        df = df.withColumn(f"loose_{kind}", F.filter(f"loose_{kind}", _clear_of("_taken")))
    return df.withColumn("base_secret", F.filter("loose_secret", lambda s: F.lit(False))).drop("_digit", *(f"all_{k}" for k in KINDS))


def _before(span: Column, size: int = 40) -> Column:
    """The text before a span."""
    return F.substring(F.col("t"), F.greatest(F.lit(1), span.start - size + 1), F.least(F.lit(size), span.start))


def _check(kind: str, span: Column) -> Column:
    """Whether a span passes what its kind can be checked by."""
    if kind == "email":
        return span.value.rlike(GAZETTEER["email"])
    if kind == "ip":
        return span.value.rlike("[.].*[.]|(?i)[a-f]")
    if kind == "secret":
        return span.value.rlike("[0-9]") & span.value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(span.value, ""))) > 8)
    return F.when(F.lit(kind == "card"), _luhn(span.value)).otherwise(F.length(_digits(span.value)).between(9, 15))


def _flag(c: Column) -> Column:
    return F.when(c, "1").otherwise("0")


def _votes(kind: str, base: bool, span: Column) -> Column:
    """kind:base:pattern vote:gazetteer vote:context vote, each vote 1, 0 (abstains) or -1."""
    before = _before(span)
    pattern = F.lit("1") if base else F.when(_check(kind, span), "1").otherwise("-1")
    miss = F.lit("0") if kind == "secret" else F.lit("-1")
    bare = F.regexp_replace(span.value, "[ -]", "") if kind == "card" else span.value
    gazetteer = F.when(bare.rlike(GAZETTEER[kind]), "1").otherwise(miss)
    against = F.when(before.rlike(AGAINST[kind]), "-1").otherwise("0") if kind in AGAINST else F.lit("0")
    context = F.when(before.rlike(CONTEXT[kind]), "1").otherwise(against)
    return F.concat_ws(":", F.lit(kind), F.lit(int(base)).cast("string"), pattern, gazetteer, context)


def _features(kind: str, span: Column) -> Column:
    """kind:check:length:digits:quoted:assigned:announced:near, what the classifier sees of a span and its surroundings. At most 1,280 values a kind."""
    before, after = _before(span), F.substring(F.col("t"), span.end + 1, F.lit(1))
    length = F.least(F.lit(7), F.floor(F.log2(F.length(span.value)))).cast("int").cast("string")
    digits = F.floor(4 * F.length(_digits(span.value)) / F.length(span.value)).cast("int").cast("string")
    near = F.exists("_taken", lambda b: (b.start < span.end + 80) & (span.start < b.end + 80) & ((b.start != span.start) | (b.end != span.end)))
    said = before.rlike(CONTEXT[kind])
    against = before.rlike(AGAINST[kind]) if kind in AGAINST else F.lit(False)
    announced = F.when(said, "1").when(against, "2").otherwise("0")
    return F.concat_ws(":", F.lit(kind), _flag(_check(kind, span)), length, digits, _flag(before.rlike("[\"']$") & after.isin('"', "'")), _flag(before.rlike("[=:] ?[\"']?$")), announced, _flag(near))


def _described(kind: str, base: bool):
    return lambda s: F.struct(_votes(kind, base, s).alias("votes"), _features(kind, s).alias("features"))


def learn(found: DataFrame) -> dict[str, float]:
    """Probability, by the span classifier, of each feature pattern that occurs. The table of counts is bounded by the number of patterns."""
    arrays = [F.transform(f"{'base' if base else 'loose'}_{kind}", _described(kind, base)) for kind in ALL_KINDS for base in (True, False) if kind in KINDS or not base]
    counts = {(r[0], r[1]): r[2] for r in found.select(F.explode(F.concat(*arrays)).alias("x")).groupBy("x.votes", "x.features").count().collect()}
    votes: dict[str, int] = {}
    for (v, _), n in counts.items():
        votes[v] = votes.get(v, 0) + n
    likely = reliabilities(votes)
    soft: dict[str, tuple[int, float]] = {}
    for (v, f), n in sorted(counts.items()):
        m, p = soft.get(f, (0, 0.0))
        soft[f] = (m + n, (m * p + n * likely[v]) / (m + n))
    return span_classifier(soft)


def reliabilities(counts: dict[str, int]) -> dict[str, float]:
    """Probability of each vote pattern (kind:base:votes) by expectation-maximisation, per kind, votes independent given the truth."""
    out = {}
    for kind in ALL_KINDS:
        rows = [(k, k.split(":")[2:], n) for k, n in sorted(counts.items()) if k.split(":")[0] == kind]
        p = {k: min(0.95, max(0.05, 0.4 + 0.2 * sum(map(int, v)))) for k, v, _ in rows}
        for _ in range(ROUNDS):
            total = {c: sum(n * (p[k] if c else 1 - p[k]) for k, _, n in rows) + 2 for c in (0, 1)}
            vote = {(j, x, c): (sum(n * (p[k] if c else 1 - p[k]) for k, v, n in rows if v[j] == x) + 0.5) / (total[c] + 0.5) for j in range(3) for x in ("-1", "0", "1") for c in (0, 1)}
            for k, v, _ in rows:
                odds = math.log(total[1] / total[0]) + sum(math.log(vote[j, x, 1] / vote[j, x, 0]) for j, x in enumerate(v))
                p[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        out |= p
    return out


def _values(features: str) -> list[str]:
    """The indicator features of a pattern: each value by kind, and its check alone."""
    kind, *values = features.split(":")
    return ["bias", kind, f"check{values[0]}", f"announced{values[5]}", *(f"{kind}{j}:{v}" for j, v in enumerate(values))]


def span_classifier(soft: dict[str, tuple[int, float]], rounds: int = 200, rate: float = 0.5, decay: float = 0.5) -> dict[str, float]:
    """Logistic regression (Adagrad) over indicator features, trained on counts and soft labels; its probability for each pattern."""
    rows = [(f, _values(f), n, p) for f, (n, p) in sorted(soft.items())]
    weight: dict[str, float] = {v: 0.0 for _, values, _, _ in rows for v in values}
    past = dict.fromkeys(weight, 1e-9)
    chance = lambda values: 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weight[v] for v in values)))))
    for _ in range(rounds):
        step = {v: -decay * w for v, w in weight.items()}
        for _, values, n, p in rows:
            g = n * (p - chance(values))
            for v in values:
                step[v] += g
        for v, g in step.items():
            past[v] += g * g
            weight[v] += rate * g / math.sqrt(past[v])
    return {f: chance(values) for f, values, _, _ in rows}


def find(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans (all of the four kinds, as kind:start:end), n_spans, secrets (start:end), n_secrets, and found (array of kind, start, end, value; secrets too)."""
    found = candidates(documents, doc_id, text)
    likely = [f for f, p in learn(found).items() if p >= 0.5]
    empty = F.expr("cast(array() as array<struct<start:int,k:int,end:int,kind:string,value:string>>)")

    def tagged(column: str, kind: str, added: bool = False) -> Column:
        spans = F.filter(column, lambda s: _features(kind, s).isin(likely)) if added else F.col(column)
        return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(ALL_KINDS.index(kind)).alias("k"), s.end.alias("end"), F.lit(kind).alias("kind"), s.value.alias("value")))

    base = F.array_sort(F.concat(*(tagged(f"base_{k}", k) for k in KINDS)))
    more = F.concat(*(tagged(f"loose_{k}", k, True) for k in ALL_KINDS)) if likely else empty
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    out = found.withColumn("_base", base).withColumn("found", F.array_sort(F.concat("_base", more)))
    four, secrets = F.filter("found", lambda s: s.kind != "secret"), F.filter("found", lambda s: s.kind == "secret")
    places = F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string"))), ",")
    return out.select("doc_id", *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(joined("_base"), 256).alias("base_sha256"), joined(four).alias("spans"), F.size(four).cast("long").alias("n_spans"), places.alias("secrets"), F.size(secrets).cast("long").alias("n_secrets"),
                      F.transform("found", lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"), s.value.alias("value"))).alias("found"))
