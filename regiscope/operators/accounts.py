"""Account documents (iXBRL) to facts, and to one row per account."""

from __future__ import annotations

import bisect
import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.functions.exprs import strip_suffix, to_number, token

FACTS = "kind string, name string, context_ref string, pos int, value string"
# The tags that hold facts, and what their names contain.
KINDS = {"ix:nonnumeric": "nonNumeric", "ix:nonfraction": "nonFraction"}
END_DATE, COMPANY, DORMANT, EMPLOYEES = "EndDateForPeriodCoveredByReport", "EntityCurrentLegalOrRegisteredName", "EntityDormantTruefalse", "AverageNumberEmployeesDuringPeriod"

_REST = r"(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(rf"<!--.*?-->|<(/?)(ix:non(?:numeric|fraction))\b({_REST})>|<[/!?a-zA-Z]{_REST}>|<[/!?a-zA-Z]", re.I | re.S)
_FACT = re.compile(r"<(/?)(ix:non(?:numeric|fraction))\b", re.I)
_NAME = re.compile(r"(?<![\w:.-])(name|contextref)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Characters that all facts of a document may have together: so many times the document's, and so many more.
TIMES, MORE = 4, 1 << 16


def _tag_ends(document: str) -> tuple[list[int], list[int]]:
    """Places of quotes and '>', and for each where a tag ends (after its '>') that has come to it outside quotes; -1 if it never does."""
    places = [m.start() for m in re.finditer("[\"'>]", document)]
    ends, later = [-1] * (len(places) + 1), {}
    for k in range(len(places) - 1, -1, -1):
        c = document[places[k]]
        if c == ">":
            ends[k] = places[k] + 1
        else:
            ends[k] = ends[later[c] + 1] if c in later else -1
            later[c] = k
    return places, ends


def _markup(document: str):
    """(start, end, closing or not, fact tag or None, its attributes) of all markup, in time in proportion to the document's length, whatever never closes in it."""
    at, odd = 0, False
    for m in _TOKEN.finditer(document):
        text = m[0]
        if text[-1] != ">" or (text.startswith("<!--") and not text.endswith("-->")):
            at, odd = m.start(), True
            break
        yield m.start(), m.end(), m[1], m[2], m[3]
    if not odd:
        return
    places, ends = _tag_ends(document)
    k, comments = 0, True
    while (at := document.find("<", at)) >= 0:
        end = -1
        if document.startswith("<!--", at):  # one that never ends is text
            end = document.find("-->", at + 4) + 3 if comments else -1
            comments = end > 2
            if comments:
                yield at, end, None, None, None
        elif (c := document[at + 1 : at + 2]) in ("/", "!", "?") or c.isascii() and c.isalpha():
            k = bisect.bisect_left(places, at, k)
            if (end := ends[k]) > 0:
                m = _FACT.match(document, at, end)
                yield at, end, m and m[1], m and m[2], m and document[m.end() : end - 1]
        at = max(end, at + 1)


def facts_of(document: str | None) -> tuple[list[tuple], bool]:
    """Facts (kind, name, context, position, text) in document order, and whether the document is whole.

    Facts may nest; an open one runs to the end. It isn't whole if a fact tag does not close, or if the facts nest so deep
    that their texts would be more than TIMES as long as the document: those that close last then have no text (None).
    One pass; the time is in proportion to the length.
    """
    document = document or ""
    found, open_, whole = [], [], True  # open_: tag, place of the fact, where its text begins
    text, size, last, spans = [], 0, 0, []  # the text without markup while a fact is open, and each closed fact's part of it
    waiting = dict.fromkeys(KINDS, 0)

    def close(k: int) -> None:
        for tag, place, begin in reversed(open_[k:]):
            spans.append((place, begin, size))
            waiting[tag] -= 1
        del open_[k:]

    for start, end, closing, tag, attributes in _markup(document):
        if open_:
            text.append(document[last:start])
            size += start - last
        last = end
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            k = next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == tag) if waiting[tag] else None
            whole &= k is not None and k == len(open_) - 1
            if k is not None:
                close(k)
            continue
        given = {a.lower(): html.unescape("".join(v)) for a, *v in _NAME.findall(attributes)}
        found.append([KINDS[tag], given.get("name"), given.get("contextref"), len(found), ""])
        if not attributes.endswith("/"):
            open_.append((tag, len(found) - 1, size))
            waiting[tag] += 1
    whole &= not open_
    if open_:
        text.append(document[last:])
        size += len(document) - last
    close(0)
    text, left = "".join(text), TIMES * len(document) + MORE
    for place, begin, end in spans:
        left -= end - begin
        whole &= left >= 0
        found[place][4] = html.unescape(text[begin:end]) if left >= 0 else None
    return [tuple(f) for f in found], whole


def _by_document(documents: DataFrame, keys: list[str], content: str, made, columns: str) -> DataFrame:
    """A map over documents: made(text) gives rows that go with the document's keys."""
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = dict(documents.dtypes)

    def run(batches):
        for pdf in batches:
            rows = [(*key, *row) for *key, text in zip(*(pdf[c] for c in [*keys, content])) for row in made(text)]
            yield pd.DataFrame(rows, columns=[*keys, *names])

    return documents.select(*keys, F.col(content).cast("string").alias(content)).mapInPandas(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " + columns)


def shred(documents: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """A row per fact of every document, with the documents' keys. A document without facts, or NULL, gives none."""
    return _by_document(documents, keys, content, lambda text: facts_of(text)[0], FACTS)


def _account(text: str | None) -> list[tuple]:
    facts, whole = facts_of(text)
    first = lambda part: next((v for kind, name, _, _, v in facts if kind == "nonNumeric" and part in (name or "")), None)
    staff = [v for kind, name, _, _, v in facts if kind == "nonFraction" and EMPLOYEES in (name or "")]
    return [(first(COMPANY), first(END_DATE), first(DORMANT), *(staff + [None, None])[:2], whole)]


def accounts(documents: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """One row per document, also of those without facts: company, end date, dormant flag, employees this and last year, and whether all fact tags close.

    A document is read once, by one task, so nothing is grouped or joined.
    """
    columns = "company string, enddate string, dormantstatus string, employees_thisyear string, employees_lastyear string, whole boolean"
    out = _by_document(documents, keys, content, _account, columns)
    return out.withColumn("employees_thisyear", to_number(F.col("employees_thisyear"))).withColumn("employees_lastyear", to_number(F.col("employees_lastyear")))


def file_keys(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """Adds companynumber and accountcode from names like Prod1_2_01234567_20240331.html; rows without a code go."""
    name = F.element_at(F.split(entry, "/"), -1)
    out = entries.withColumn("companynumber", token(name, 3)).withColumn("accountcode", strip_suffix(token(name, 4), ".html"))
    return out.where(F.col("accountcode") != "")


def tag_frequency(facts: DataFrame, entry: str) -> DataFrame:
    return facts.groupBy("name").agg(F.count_distinct(entry).alias("documents"), F.count("*").alias("facts"))


def search(facts: DataFrame, term: str) -> DataFrame:
    return facts.where(F.concat_ws(" ", "name", "value").rlike("(?i)" + term))
