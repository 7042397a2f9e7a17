"""Column expressions over free text: clean-ups, identifiers, answers, messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities decoded after markup is removed.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&apos;": "'", "&quot;": '"'}


def _collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def strip_markup(text: Column) -> Column:
    """Tags become spaces, five entities are decoded, white space collapses."""
    out = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return _collapse(out)


def strip_rtf(text: Column) -> Column:
    """Control words and symbols become spaces, braces go, white space collapses."""
    out = F.regexp_replace(text, r"\\[a-z]+-?[0-9]*\s?", " ")
    out = F.regexp_replace(out, r"\\[^a-z\n]", " ")
    return _collapse(F.regexp_replace(out, "[{}]", ""))


def clean_doi(raw: Column) -> Column:
    """``10.xxxx/…`` in lower case, whatever stands before it, without trailing punctuation, else null."""
    return F.nullif(F.regexp_extract(F.lower(raw), r"10\.[0-9]{4,9}/\S*[^\s.,;]", 0), F.lit(""))


def doi_candidates(raw: Column) -> Column:
    """The DOI, the DOI without a letter tail, the DOI cut after its last digit."""
    doi = clean_doi(raw)
    shorter = [F.regexp_replace(doi, f"(?<=[0-9]){tail}$", "") for tail in ("[a-z]+", "[^0-9]*")]
    return F.array_distinct(F.array(doi, *shorter))


def doi_from_id(prefix: str, paper_id: Column) -> Column:
    return F.concat(F.lit(prefix), paper_id)


def answer_array(text: Column) -> Column:
    """The outermost ``[…]`` of a reply without code fences; the reply itself if none."""
    out = F.trim(text)
    out = F.trim(F.regexp_replace(out, r"^```(?:json)?\s*|\s*```$", ""))
    inner = F.regexp_extract(out, r"(?s)(\[.*\])", 1)
    return F.when(inner != "", inner).otherwise(out)


def parse_answer(text: Column, schema: str) -> Column:
    """A reply as an array of structs, backticks around values removed; null if not JSON."""
    return F.from_json(F.replace(answer_array(text), F.lit("`"), F.lit("")), f"array<{schema}>")


def error_code(message: Column) -> Column:
    """The leading ``code:`` of a message; a message without one stands for itself."""
    return F.regexp_replace(message, r"(?s)^([a-z_]+):.*", "$1")


# What a failed step says, and what is shown for it.
EXPLAINED = [
    (r"replacement has (\d+) rows, data has (\d+)", "column count mismatch building study table ($1 input rows vs $2 in data)"),
    (r"^ *no_data_files *$", "no data files found for this study group"),
]
REASONS = [
    (r"UTF-8|locale|invalid in this", "encoding (non-UTF-8 input)"),
    (r"no_data_files", "no data files in group"),
]


def by_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """What the first rule says whose pattern the text holds (``$1`` is a group of it), else the text."""
    out = text
    for pattern, said in reversed(rules):
        out = F.when(text.rlike(pattern), F.regexp_replace(text, f"(?s)^.*?(?:{pattern}).*$", said)).otherwise(out)
    return out


def explain_error(message: Column, rules: Sequence[tuple[str, str]] = EXPLAINED) -> Column:
    return by_rules(message, rules)


def failure_reason(message: Column, rules: Sequence[tuple[str, str]] = REASONS) -> Column:
    """The first line of a message in the words of ``rules``; one without a message is unspecified."""
    line = F.substring_index(F.coalesce(F.nullif(message, F.lit("")), F.lit("unspecified")), "\n", 1)
    return by_rules(line, rules)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.lit(100.0) * part / whole)


def format_percent(part: Column, whole: Column) -> Column:
    value = F.bround(percent(part, whole), 1)
    return F.when(value.isNull(), F.lit("-")).otherwise(F.format_string("%.1f%%", value))


def capped_list(items: Column, limit: int) -> Column:
    """The first ``limit`` entries, then how many more there are."""
    shown = F.array_join(F.slice(items, 1, limit), ", ")
    more = F.size(items) - limit
    return F.when(
        more > 0, F.concat(shown, F.lit(" … and "), more.cast("string"), F.lit(" more"))
    ).otherwise(shown)


def author_list(authors: Column) -> Column:
    """``given surname; …`` from an array of structs, null when nobody is named."""
    names = F.filter(
        F.transform(
            authors,
            lambda a: F.trim(
                F.concat_ws(" ", F.coalesce(a["given"], F.lit("")), F.coalesce(a["surname"], F.lit("")))
            ),
        ),
        lambda n: n != "",
    )
    return F.when(F.size(names) > 0, F.array_join(names, "; "))


def first_link(links: Column, badges: list[str]) -> Column:
    """The first link that is no badge, with a scheme and without trailing slashes."""
    kept = F.array_except(F.array_distinct(links), F.array(*map(F.lit, badges)).cast("array<string>"))
    link = F.regexp_replace(F.get(kept, F.lit(0)), "/+$", "")
    return F.when(link.rlike("^https?://"), link).otherwise(F.concat(F.lit("https://"), link))
