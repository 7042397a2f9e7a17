"""Column expressions over variable names and their labels."""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewarden.operators.scale import attach

# the stemmer travels with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Header names of the two columns every dictionary table has.
VARIABLE_HEADERS = ["var", "variable", "name", "column", "field", "variable_name", "varname", "item"]
LABEL_HEADERS = [
    "label", "description", "desc", "definition", "meaning", "explanation", "text", "label_text", "question",
    "question_text", "variable_description", "variable_label", "var_label",
]


def normalize_variable(name: Column) -> Column:
    """Lower case, underscores and runs of space as one space, no outer dots."""
    out = F.trim(F.lower(name))
    out = F.regexp_replace(out, "_+", " ")
    out = F.regexp_replace(out, r"\s+", " ")
    return F.trim(F.regexp_replace(out, r"^\.+|\.+$", ""))


def _label_words(label: Column) -> Column:
    out = F.regexp_replace(F.lower(label), "['\u2019\u2018]s", "")
    out = F.regexp_replace(out, "[^a-z0-9 ]", " ")
    return F.filter(F.split(F.trim(out), r"\s+"), lambda w: w != "")


def normalize_label(label: Column) -> Column:
    """Labels that differ only in punctuation, possessives or a plural compare equal."""
    return F.array_join(
        F.transform(_label_words(label), lambda w: F.regexp_replace(w, "^([a-z]{7,})s$", "$1")), " "
    )


def with_stemmed_label(df: DataFrame, label: str, out: str) -> DataFrame:
    """As ``normalize_label`` with Porter stems; each distinct word is stemmed once."""
    words = df.select(F.explode(_label_words(F.col(label))).alias("_w")).distinct()
    stems = words.select("_w", porter_stem("_w").alias("_s"))
    tagged = df.select(label).distinct().withColumn("_ws", _label_words(F.col(label)))
    joined = (
        attach(
            tagged.select(label, F.posexplode("_ws").alias("_i", "_w")), stems, ["_w"]
        )
        .groupBy(label)
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_i", "_s"))), lambda x: x["_s"]), " "
            ).alias(out)
        )
    )
    return attach(df, joined, [label]).withColumn(out, F.coalesce(out, F.lit("")))


def is_id_name(name: Column) -> Column:
    return name.rlike(ID_NAME_PATTERN)


# Names of identifier columns.
ID_NAME_PATTERN = "(?i)" + "|".join(
    [
        r"^(participant|subject|subj|respondent|pp|ppt|pid|sub|id)$",
        r"[_\-.](id|number|num|nr|no|code)$",
        r"^(subjectid|subjectnumber|responseid|recordid|participantid|subjectno|subjectnum"
        r"|subjectcode|participantno|participantnum)$",
        r"^sub[_\-]\d",
        r"^(participant|subject|subj|pp|sub)[_\-]?\d+$",
    ]
)


def dictionary_columns(headers: Sequence[str]) -> tuple[str, str] | None:
    """The variable and the label column of a dictionary table, by header."""

    def first(known: list[str]) -> str | None:
        allowed = {re.sub("_", form, k) for k in known for form in ("", " ", "_")}
        return next((h for h in headers if h.lower() in allowed), None)

    var, label = first(VARIABLE_HEADERS), first(LABEL_HEADERS)
    return (var, label) if var and label else None


def read_dictionary(df: DataFrame, source: Column) -> DataFrame | None:
    """A dictionary table in the column layout that matching expects."""
    found = dictionary_columns(df.columns)
    if found is None:
        return None
    var, label = found
    return df.where(F.trim(F.col(f"`{var}`").cast("string")) != "").select(
        F.col(f"`{var}`").cast("string").alias("codebook_variable"),
        F.col(f"`{label}`").cast("string").alias("label"),
        source.alias("codebook_source"),
        F.lit(None).cast("string").alias("group"),
    )


def bare(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), "[^a-z0-9]", "")


def label_quality(label: Column, name: Column) -> dict[str, Column]:
    """Lengths, gain, edit distance and whether the label says more than the name."""
    lab, var = F.coalesce(label, F.lit("")), F.coalesce(name, F.lit(""))
    return {
        "label_len": F.length(lab),
        "name_len": F.length(var),
        "len_gain": F.length(lab) - F.length(var),
        "edit_dist": F.levenshtein(F.lower(lab), F.lower(var)),
        "informative": (bare(lab) != "") & (bare(lab) != bare(var)),
    }


# --- Porter (1980), "An algorithm for suffix stripping": the published rules -----------------

_STEP2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e "
    "ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous "
    "aliti:al iviti:ive biliti:ble"
)
_STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _shape(word: str) -> str:
    """``v`` or ``c`` per letter; y is a vowel after a consonant."""
    kinds = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and kinds[-1] == "c")
        kinds += "v" if vowel else "c"
    return kinds


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _short_end(word: str) -> bool:
    return len(word) > 2 and _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _swap(word: str, rules: str) -> str:
    table = dict(pair.split(":") for pair in rules.split())
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            root = word[: -len(suffix)]
            return root + table[suffix] if _measure(root) > 0 else word
    return word


def _porter(word: str) -> str:
    if len(word) < 3:
        return word
    for suffix, put in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            word = word[: -len(suffix)] + put
            break
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            root = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(root):
                word = root
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c":
                    word = word if word[-1] in "lsz" else word[:-1]
                elif _measure(word) == 1 and _short_end(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(_swap(word, _STEP2), _STEP3)
    for suffix in sorted(_STEP4.split(), key=len, reverse=True):
        if word.endswith(suffix):
            root = word[: -len(suffix)]
            if _measure(root) > 1 and (suffix != "ion" or root.endswith(("s", "t"))):
                word = root
            break
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(StringType())
def porter_stem(words: pd.Series) -> pd.Series:
    return words.map(_porter, na_action="ignore")


@F.pandas_udf(StringType())
def _stem_words(texts: pd.Series) -> pd.Series:
    words = {w for t in texts.dropna() for w in t.split(" ")}
    stems = {w: _porter(w) for w in words}
    return texts.map(lambda t: " ".join(stems[w] for w in t.split(" ")), na_action="ignore")


def stemmed_label(label: Column) -> Column:
    """As ``normalize_label`` with Porter stems; a batch of labels stems each word once."""
    return _stem_words(F.array_join(F.coalesce(_label_words(label), F.array().cast("array<string>")), " "))
