"""Scalar text functions over columns. Only nested template stripping, accent folding and year contexts leave the JVM."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def capitalize_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))


# fixed values: the markup's comments, references and links
COMMENT = "<!--.*?-->"
REFERENCE = "<ref[^>]*?(?:/>|>.*?</ref>)"
LINK = r"(?s)\[\[([^\[\]]+)\]\]"


def strip_markup(c: Column) -> Column:
    """Without HTML comments and ref elements, self-closing or paired."""
    without = F.regexp_replace(c, "(?s)" + COMMENT, "")
    return F.regexp_replace(without, "(?is)" + REFERENCE, "")


def _strip_templates(text: str) -> str:
    out, depth, at = [], 0, 0
    for m in re.finditer(r"\{\{|\}\}", text):
        if depth == 0:
            out.append(text[at : m.start()])
        if m[0] == "{{":
            depth += 1
        elif depth:
            depth -= 1
        else:
            out.append("}}")
        at = m.end()
    return "".join(out) + (text[at:] if depth == 0 else "")


@F.pandas_udf(StringType())
def strip_templates(s: pd.Series) -> pd.Series:
    """Without nested {{..}}; an unclosed one drops the rest, a stray close stays."""
    return s.map(lambda x: None if x is None else _strip_templates(x))


def lead(c: Column) -> Column:
    """Text before the first level-2 heading."""
    return F.split(c, "\n==(?!=)", 2)[0]


# fixed values: headings that end the running text, and prefixes of links that are no articles
END_SECTIONS = ["See also", "References", "Notes", "Further reading", "External links", "Bibliography", "Sources", "Citations"]
SKIPPED_PREFIXES = ["file:", "image:", "category:", "wikipedia:", "wp:", "help:", "template:", "portal:", "wikt:", "wiktionary:", "s:", "commons:", "special:", "media:", ":"]


def body(c: Column) -> Column:
    """Text before the first section of references and the like."""
    return F.split(c, r"(?i)\n==\s*(?:" + "|".join(END_SECTIONS) + r")\s*==", 2)[0]


def link_targets(c: Column) -> Column:
    """Targets of closed [[..]] links: before `#` or `|`, trimmed, `_` as space, first letter upper; namespaces dropped."""
    raw = F.transform(F.regexp_extract_all(c, F.lit(LINK), 1), lambda t: F.regexp_replace(t, "(?s)[#|].*$", ""))
    named = F.transform(raw, lambda t: F.translate(F.regexp_replace(t, r"^\s+|\s+$", ""), "_", " "))
    kept = F.filter(named, lambda t: (t != "") & ~F.lower(t).rlike("^(?:" + "|".join(SKIPPED_PREFIXES) + ")"))
    return F.transform(kept, capitalize_first)


def regions(names: Column, anchors: list[str], barred_starts: list[str], barred: list[str]) -> Column:
    """Sorted distinct X of the names `<anchor> in <X>`, without those that begin with or hold a barred phrase."""
    found = F.transform(names, lambda n: F.regexp_extract(n, "(?i)^(?:" + "|".join(anchors) + ") in (.+)$", 1))
    fine = lambda x: (x != "") & ~F.lower(x).rlike("^(?:" + "|".join(barred_starts) + ")|" + "|".join(barred))
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, fine), lambda x: F.trim(x))))


def bilingual(local: Column, original: Column) -> Column:
    """The local name, capitalised, before the original where they differ in more than case."""
    name = F.trim(local)
    differs = (name != "") & (F.lower(name) != F.lower(original))
    return F.when(differs, F.concat(capitalize_first(name), F.lit(" · "), original)).otherwise(original)


def claim_ids(claims: Column, prop: str) -> Column:
    """Ids of a property's claims in an entity's JSON, in order; claims without a value or id are left out."""
    return F.filter(F.transform(_claim_values(claims, prop), lambda v: F.get_json_object(v, "$.id")), lambda i: i.isNotNull())


def claim_place(claims: Column, prop: str) -> Column:
    """(lat, lon) of the first of a property's claims that has both; null if none does."""
    place = F.transform(_claim_values(claims, prop), lambda v: F.struct(F.get_json_object(v, "$.latitude").cast("double").alias("lat"), F.get_json_object(v, "$.longitude").cast("double").alias("lon")))
    return F.get(F.filter(place, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()), F.lit(0))


def claim_date(claims: Column, *props: str) -> Column:
    """The first time of the first property that has one: without its plus sign, 10 characters."""
    times = [F.get(F.filter(F.transform(_claim_values(claims, p), lambda v: F.get_json_object(v, "$.time")), lambda t: t.isNotNull()), F.lit(0)) for p in props]
    return F.substring(F.regexp_replace(F.coalesce(*times), r"^\++", ""), 1, 10)


def _claim_values(claims: Column, prop: str) -> Column:
    shape = "struct<claims: map<string, array<struct<mainsnak: struct<datavalue: struct<value: string>>>>>>"
    return F.transform(F.coalesce(F.from_json(claims, shape)["claims"][prop], F.array()), lambda c: c["mainsnak"]["datavalue"]["value"])


def url_title(c: Column) -> Column:
    """Last path part, percent-decoded, `_` as space."""
    last = F.substring_index(c, "/wiki/", -1)
    return F.translate(F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), "_", " ")


def first_sentences(c: Column, n: int = 2) -> Column:
    return F.array_join(F.slice(F.split(c, r"(?<=[.!?])\s", n + 1), 1, n), " ")


def snippet(c: Column, limit: int = 190) -> Column:
    """Whole if it fits; else cut at the last space beyond 60 % of the limit, without trailing marks, and an ellipsis."""
    flat = F.trim(F.regexp_replace(c, r"[ \t\n\r]+", " "))
    cut = F.substring(flat, 1, limit)
    space = F.length(cut) - F.instr(F.reverse(cut), " ")
    short = F.when((F.instr(cut, " ") > 0) & (space > int(limit * 0.6)), cut.substr(F.lit(1), space)).otherwise(cut)
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.regexp_replace(short, "[ .,;:]+$", ""), F.lit("…")))


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def sanitize(c: Column, n: int) -> Column:
    """Without control characters and angle brackets, trimmed, at most n characters."""
    return F.substring(F.trim(F.regexp_replace(c, r"[\x00-\x1f<>]", "")), 1, n)


def intro(c: Column, n: int) -> Column:
    return F.substring(F.substring_index(F.translate(c, "\n", " "), ". ", 2), 1, n)


def cut_sentence(c: Column, n: int = 900) -> Column:
    """At most n characters, back to the last full stop before a space."""
    short = F.substring(c, 1, n)
    at = F.length(short) - F.length(F.substring_index(short, ". ", -1))
    return F.when(F.length(c) <= n, c).when(at > 0, F.concat(short.substr(F.lit(1), at - 2), F.lit("."))).otherwise(short)


@F.pandas_udf(StringType())
def fold_accents(s: pd.Series) -> pd.Series:
    def fold(x: str | None) -> str | None:
        if x is None or x.isascii():
            return x
        x = unicodedata.normalize("NFD", x)
        return x.translate(dict.fromkeys(ord(c) for c in set(x) if unicodedata.category(c) == "Mn"))

    return s.map(fold)


def slug(title: Column, node_id: Column) -> Column:
    base = F.regexp_replace(F.regexp_replace(F.lower(fold_accents(title)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    short = F.regexp_replace(F.substring(base, 1, 60), "^-+|-+$", "")
    return F.when(short == "", node_id).otherwise(F.concat(short, F.lit("-"), node_id))


def years(c: Column) -> Column:
    """The first 7 distinct years 1000..2099 in order of the text."""
    return F.slice(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b(1[0-9]{3}|20[0-9]{2})\b"), 1)), 1, 7)


@F.pandas_udf(ArrayType(StringType()))
def year_contexts(s: pd.Series) -> pd.Series:
    """For each year, 55 characters before and 35 after; contexts may overlap."""
    year = re.compile(r"\b(?:1[0-9]{3}|20[0-9]{2})\b")
    return s.map(lambda x: [x[max(0, m.start() - 55) : m.end() + 35] for m in year.finditer(x or "")])


def search(c: Column, needle: str) -> Column:
    """Contains, without regard to case and accents."""
    return F.contains(F.collate(c, "UNICODE_CI_AI"), F.collate(F.lit(needle), "UNICODE_CI_AI"))
