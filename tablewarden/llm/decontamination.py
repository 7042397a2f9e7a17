"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Windows of template words are joined by hash, so a question matches also with other parameters. The
values in the slots then decide: along one alignment every value of the benchmark must stand for one
value of the document throughout. All of it is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import fresh, pick, prepare, same, stored, table
from tablewarden.operators.scale import BROADCAST_ROWS

WINDOW = 8
# A benchmark window with fewer literal words than this says too little.
MIN_LITERALS = 4
# A document leaks an item if consistent alignments cover this share of the item's windows.
MIN_COVERAGE = 0.5
# An item too short or bare for windows must have this many words to drop a document.
LEAST_WHOLE = 4
BLANK = "[\\x20\\x09-\\x0D]+"
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
# Words taken as units of measure or money.
UNITS = [
    "mm", "cm", "km", "mg", "kg", "ml", "meter", "meters", "metre", "metres", "kilometer", "kilometers",
    "mile", "miles", "inch", "inches", "foot", "feet", "yard", "yards", "gram", "grams", "pound", "pounds",
    "ounce", "ounces", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes",
    "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar",
    "dollars", "euro", "euros", "cent", "cents", "percent", "kph", "mph", "watt", "watts", "volt", "volts",
]


def plain_words(text: Column) -> Column:
    """The text with one space between words and without the placeholder characters."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT, ""), BLANK, " "))


def folded_words(text: Column) -> Column:
    return F.lower(plain_words(text))


def any_name_text(plain: Column) -> Column:
    """Like ``template_text``, with capitalised words at the start of a sentence as names too."""
    return template_text(plain, "(?<![^ ])")


def template_text(plain: Column, before_name: str = "(?<=[^.!?: ] )") -> Column:
    """One template word per word of ``plain``; every rule looks at whole words in linear time.

    A name is a capitalised word that does not begin a sentence, a number any word with a digit, a
    unit one of ``UNITS``. Other words lose case and punctuation.
    """
    named = F.regexp_replace(plain, before_name + "\\p{Lu}\\p{Ll}[^ ]*+", NAME)
    numbered = F.regexp_replace(named, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", NUMBER)
    words = F.lower(F.regexp_replace(numbered, f"[^\\p{{L}}\\p{{N}}{NAME}{NUMBER} ]++", ""))
    return F.regexp_replace(words, f"(?<![^ ])(?:{'|'.join(UNITS)})(?![^ ])", UNIT)


# Ways to read the words of a text as templates. The query takes the first, as its SQL says.
AS_WRITTEN = template_text
Form = Callable[[Column], Column]
FORMS: list[Form] = [AS_WRITTEN, any_name_text, lambda plain: template_text(F.lower(plain))]
# The number of the form in which an item without a window stands as a whole.
WHOLE = -1


def _windows(template: Column, form: int, literals: bool = False, width: int = WINDOW) -> Column:
    """Array of (pos, hash) of all windows of ``width`` words; the words are split once, not once a window."""

    def value(words: Column, i: Column) -> Column:
        part = F.slice(words, i, width)
        fields = [(i - 1).alias("pos"), F.xxhash64(part, F.lit(form)).alias("hash")]
        if literals:
            fields.append(F.size(F.filter(part, lambda w: (w > UNIT) & (w != ""))).alias("literals"))
        return F.struct(*fields)

    inner = lambda words: F.when(
        F.size(words) >= width,
        F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: value(words, i)),
    )
    return F.transform(F.array(F.split(template, " ")), inner)[0]


def exact_words(text: Column) -> Column:
    """Lower-case words without the quotes, brackets and stops around them, one space between them."""
    bare = F.regexp_replace(folded_words(text), "(?<![^ ])[\"'(\\[«“¿¡]++(?=[^ ])", "")
    return F.regexp_replace(bare, "(?<=[\\p{L}\\p{N}])[\"')\\].,;:!?»”]++(?![^ ])", "")


def _whole(text: Column) -> Column:
    return _windows(exact_words(text), WHOLE, width=LEAST_WHOLE)


def benchmark_windows(
    benchmark: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    forms: Sequence[Form] = (AS_WRITTEN,),
    whole: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(item, key, form, item_pos, hash) of what is looked for, and (item, key, plain, templates), both stored.

    ``key`` is the hash of an item's words, which tells texts apart that share an id. With ``whole`` an
    item of ``LEAST_WHOLE`` words or more none of whose windows says enough is looked for word by word,
    in the form ``WHOLE``: by all its runs of ``LEAST_WHOLE`` words.
    """
    text = benchmark[text_col].cast("string")
    items = benchmark.select(benchmark[item_col].alias("item"), plain_words(text).alias("plain"), text.alias("text"))
    items = items.withColumn("key", F.xxhash64("plain")).withColumn("templates", F.array(*[f(F.col("plain")) for f in forms]))
    items = stored(items.dropDuplicates(["item", "plain"]), "benchmark-items")
    parts = [
        items.select("item", "key", F.lit(n).alias("form"), F.inline(_windows(F.col("templates")[n], n, True)))
        .where(F.col("literals") >= MIN_LITERALS)
        .drop("literals")
        for n in range(len(forms))
    ]
    if whole:
        told = parts[0].select("item", "key").distinct().withColumnsRenamed({"item": "t_item", "key": "t_key"})
        rest = items
        rest = rest.join(told, same(F.col("item"), F.col("t_item")) & (F.col("key") == F.col("t_key")), "left_anti")
        parts.append(rest.select("item", "key", F.lit(WHOLE).alias("form"), F.inline(_whole(F.col("text")))))
    windows = reduce(DataFrame.unionByName, parts).withColumnRenamed("pos", "item_pos").distinct()
    return stored(windows, "benchmark-windows"), items.drop("text")


def _hits(rows: DataFrame, windows: DataFrame, forms: Sequence[Form]) -> DataFrame:
    """(id, own, pos, hash, words) of what the benchmark and ``rows`` (id, own, text) have in common, in one scan.

    The benchmark's hashes are broadcast if they are counted to be few: then no text is shuffled, and
    the words of a hit are cut from the text beside it. Otherwise both sides are shuffled by hash and
    the texts with hits are joined back.
    """
    looked = [_windows(f(F.col("plain")), n) for n, f in enumerate(forms)]
    if not windows.where(F.col("form") == WHOLE).isEmpty():  # else that form is left out of the scan
        looked.append(_whole(F.col("text")))
    empty = F.array().cast("array<struct<pos:int,hash:bigint>>")
    places = F.concat(*[F.coalesce(x, empty) for x in looked]) if len(looked) > 1 else looked[0]
    searched = rows.withColumn("plain", plain_words(F.col("text")))
    cut = F.slice(F.split("plain", " "), F.col("pos") + 1, WINDOW).alias("words")
    hashes = windows.select("hash").distinct()
    if hashes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        found = searched.select("id", "own", "plain", F.inline(places))
        return found.join(F.broadcast(hashes), "hash", "left_semi").select("id", "own", "pos", "hash", cut).distinct()
    found = searched.select("id", "own", F.inline(places))
    found = stored(found.join(hashes, "hash", "left_semi").distinct(), "places").withColumnsRenamed({"id": "of", "own": "of_own"})
    return (
        searched.dropDuplicates(["id", "own"])
        .join(found, same(F.col("id"), F.col("of")) & same(F.col("own"), F.col("of_own")))
        .select("id", "own", "pos", "hash", cut)
    )


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, min_coverage: float, forms: Sequence[Form], whole: bool) -> DataFrame:
    """(id, own, item, key, form, n_windows, total, n_slots, changed) of every leak, once for each form that shows it."""
    prepare(docs.sparkSession)
    windows, items = benchmark_windows(benchmark, item_col, "text", forms, whole)
    # 1. which windows of which documents occur in the benchmark, and the words they hold there
    hits = stored(_hits(pick(docs, id_col, text_col).withColumn("own", F.xxhash64("text")), windows, forms), "hits")
    # 2. alignments: all pairs of windows of one document and item at one distance
    pairs = hits.join(windows, "hash").select(
        "id", "own", "item", "key", "form", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "words"
    )
    pairs = stored(pairs, "aligned")
    # 3. slots: the words of both sides where the template has a placeholder
    item_words = items.select(
        F.col("item").alias("i_item"), F.col("key").alias("i_key"), F.split("plain", " ").alias("item_words"), "templates"
    )
    strip = lambda c: F.lower(F.regexp_replace(c, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", ""))
    keys = ["id", "own", "item", "key", "form", "shift"]
    slots = (
        pairs.where(F.col("form") != WHOLE)
        .join(item_words, same(F.col("item"), F.col("i_item")) & (F.col("key") == F.col("i_key")))
        .withColumn("template", F.split(F.col("templates")[F.col("form")], " "))
        .select(*keys, "item_pos", "item_words", "template", F.posexplode("words").alias("k", "word"))
        .withColumn("place", (F.col("item_pos") + F.col("k")).cast("int"))
        .where(F.col("template")[F.col("place")].isin(NAME, NUMBER, UNIT))
        .select(*keys, strip(F.col("item_words")[F.col("place")]).alias("theirs"), strip(F.col("word")).alias("ours"))
        .distinct()
    )
    # a value of the benchmark with two values in the document breaks the alignment
    values = slots.groupBy(*keys, "theirs").agg(
        F.count(F.lit(1)).alias("n"), F.max((F.col("theirs") != F.col("ours")).cast("int")).alias("changed")
    )
    judged = values.groupBy(*keys).agg(
        F.max("n").alias("most"), F.sum("changed").alias("changed"), F.count(F.lit(1)).alias("n_slots")
    )
    judged = judged.withColumnsRenamed({k: f"j_{k}" for k in keys})
    on = reduce(Column.__and__, [same(F.col(k), F.col(f"j_{k}")) for k in keys])
    sound = pairs.join(judged, on, "left").where(F.coalesce("most", F.lit(1)) == 1)
    # a whole item counts along one alignment, windows along all that are sound
    along = F.when(F.col("form") == WHOLE, F.col("shift")).alias("along")
    found = sound.groupBy(*keys[:-1], along).agg(
        F.count_distinct("item_pos").alias("n_windows"),
        F.max(F.coalesce("n_slots", F.lit(0))).alias("n_slots"),
        F.min(F.coalesce("changed", F.lit(0))).alias("changed"),
    )
    totals = windows.groupBy("item", "key", "form").agg(F.count_distinct("item_pos").alias("total"))
    totals = totals.withColumnsRenamed({k: f"t_{k}" for k in ("item", "key", "form")})
    on = reduce(Column.__and__, [same(F.col(k), F.col(f"t_{k}")) for k in ("item", "key", "form")])
    share = F.when(F.col("form") == WHOLE, F.lit(1.0)).otherwise(F.lit(min_coverage))
    return found.join(totals, on).where(F.col("n_windows") >= share * F.col("total"))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """One row per document and item it leaks: id, item_id, n_windows, coverage, n_slots, kind, own.

    ``kind`` is ``exact`` where all slots hold the benchmark's own values, else ``reparameterised``;
    ``own`` is the hash of the text, which tells rows apart that repeat an id. Items that share an id
    but not a text are judged each for itself; a null id is an id like any other. Items with fewer than
    ``WINDOW`` words, and null or empty texts on either side, match nothing. Whole texts are searched,
    however long; other columns of either table play no part.
    """
    found = judge(docs, benchmark, id_col, text_col, item_col, min_coverage, [AS_WRITTEN], False)
    return found.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        "n_windows",
        F.round(F.col("n_windows") / F.col("total"), 4).alias("coverage"),
        "n_slots",
        F.when(F.col("changed") > 0, "reparameterised").otherwise("exact").alias("kind"),
        "own",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, with all their columns.

    Beside the form that ``op2`` reports, an item is looked for with every capitalised word as a name
    and without regard to case, all in one scan. An item none of whose windows says enough leaks where
    all its words stand one after another with their own values; an item of fewer than ``LEAST_WHOLE``
    words (``Yes``) says too little and drops no document.
    """
    found = judge(docs, benchmark, id_col, text_col, "item_id", MIN_COVERAGE, FORMS, True)
    leaks = stored(found.select(F.col("id").alias("leaks_id"), F.col("own").alias("leaks_own")).distinct(), "leaks")
    own = fresh(docs, "own")
    tagged = docs.withColumn(own, F.xxhash64(docs[text_col].cast("string")))
    on = same(tagged[id_col], leaks["leaks_id"]) & same(tagged[own], leaks["leaks_own"])
    return tagged.join(leaks, on, "left_anti").select(*docs.columns)


def op2_template_decontamination(spark, sf_dir):
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.drop("own")


_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)
OP2_SQL = f"""
WITH both_sides AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), worded AS (
  SELECT side, id, string_split(trim(regexp_replace(translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')), ' ') AS words
  FROM both_sides
), shaped AS (
  SELECT side, id, words, list_transform(words, lambda w, i: CASE
    WHEN i > 1 AND regexp_matches(w, '^\\p{{Lu}}\\p{{Ll}}') AND NOT regexp_matches(words[i - 1], '[.!?:]$') THEN chr(1)
    WHEN regexp_matches(w, '[0-9]') THEN chr(2)
    WHEN lower(regexp_replace(w, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) IN ({_UNIT_LIST}) THEN chr(3)
    ELSE lower(regexp_replace(w, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) END) AS template
  FROM worded
), windows AS (
  SELECT side, id, pos, array_to_string(template[pos + 1 : pos + {WINDOW}], ' ') AS key,
    len(list_filter(template[pos + 1 : pos + {WINDOW}], lambda w: w > chr(3))) AS literals
  FROM (SELECT side, id, template, unnest(range(len(template) - {WINDOW - 1})) AS pos FROM shaped WHERE len(template) >= {WINDOW})
), bench AS (SELECT id AS item_id, pos AS item_pos, key FROM windows WHERE side = 'b' AND literals >= {MIN_LITERALS}
), pairs AS (
  SELECT w.id AS doc_id, b.item_id, w.pos, b.item_pos, w.pos - b.item_pos AS shift
  FROM windows w JOIN bench b USING (key) WHERE w.side = 'd'
), places AS (
  SELECT DISTINCT doc_id, item_id, shift, unnest(range(item_pos, item_pos + {WINDOW})) AS place FROM pairs
), slots AS (
  SELECT DISTINCT p.doc_id, p.item_id, p.shift,
    lower(regexp_replace(b.words[place + 1], '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')) AS theirs,
    lower(regexp_replace(d.words[place + shift + 1], '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')) AS ours
  FROM places p JOIN shaped b ON b.side = 'b' AND b.id = p.item_id JOIN shaped d ON d.side = 'd' AND d.id = p.doc_id
  WHERE b.template[place + 1] IN (chr(1), chr(2), chr(3))
), judged AS (
  SELECT doc_id, item_id, shift, max(n) AS most, sum(changed) AS changed, count(*) AS n_slots
  FROM (SELECT doc_id, item_id, shift, theirs, count(*) AS n, max((theirs <> ours)::INT) AS changed FROM slots GROUP BY ALL)
  GROUP BY ALL
), sound AS (
  SELECT p.*, coalesce(n_slots, 0) AS n_slots, coalesce(changed, 0) AS changed
  FROM pairs p LEFT JOIN judged USING (doc_id, item_id, shift) WHERE coalesce(most, 1) = 1
), totals AS (SELECT item_id, count(DISTINCT item_pos) AS total FROM bench GROUP BY item_id)
SELECT doc_id, item_id, count(DISTINCT item_pos) AS n_windows, round(count(DISTINCT item_pos) / any_value(total), 4) AS coverage,
  max(n_slots) AS n_slots, CASE WHEN min(changed) > 0 THEN 'reparameterised' ELSE 'exact' END AS kind
FROM sound JOIN totals USING (item_id) GROUP BY doc_id, item_id
HAVING count(DISTINCT item_pos) >= {MIN_COVERAGE} * any_value(total)
"""
