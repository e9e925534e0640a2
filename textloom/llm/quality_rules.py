"""Quality rules: counting rules, then divergence from language references.

A document's character classes and common words make two histograms. It is rejected if the Jensen-Shannon distance (square
root of the divergence to base 2, from 0 to 1) of either from the language references passes a limit.

The references are anchored outside the corpus: a document takes part in one only if it passes the base rule and its
character classes lie within ``ANCHOR_DISTANCE`` of fixed shares of ordinary prose, so junk does not shape them even where
a language is mostly junk. A language's reference is the sum of these documents' histograms; the pooled reference is the sum
over all languages. A document is left out of the references it is held against, and a reference of fewer than
``MIN_DOCUMENTS`` documents is not used. The lesser distance from its language's and from the pooled one counts, so prose
that mixes languages, or stands under a wrong or rare one, is near one of them. Without any reference, the fixed
shares stand in for the character classes. Limits depend on the length, and documents of fewer than the least of ``LIMITS``
words, whose histograms mean little, are not tested. For the common words, the pooled reference is first weighed to the
document's own mix of languages: the words of each language's list get the share that the list has in the document.

Only DataFrame functions, all within a row but for the reference sums (one row per language, partial before the
shuffle). Texts are read once; what is kept of each are its counts.

Defined cases: null, empty and word-less texts count zero everywhere and fail the base rule; a null language is a
language; repeated rows are judged alike and count in the references as often as they stand; very long texts are measured
whole; an empty table gives no rows; other columns pass through :func:`judge` but for its text and the columns it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import WORD, column, join_small, prefixed, stored, working

#: Frequent function words of English, French, German and Spanish.
COMMON = (
    "the", "of", "and", "to", "in", "that", "is", "was", "for", "on", "with", "by",
    "le", "la", "les", "des", "et", "un", "une", "du", "que", "qui", "dans", "pour",
    "der", "die", "das", "und", "ist", "ein", "von", "mit", "sich", "auf", "nicht", "zu",
    "el", "los", "las", "y", "en", "de", "por", "con", "una", "se", "no", "del",
)
#: Words of one language's list above.
LIST = 12
#: Characters of each class; the rest of a text is the last class.
CLASSES = {"upper": r"\p{Lu}", "digit": "0-9", "space": r"\x20\x09-\x0D", "symbol": "#*$%&|<>", "mark": r".,;:!?'\"()-"}
MIN_WORDS = 50
#: Shares of the classes in ordinary alphabetic prose, the rest (letters) last.
PROSE = (0.03, 0.005, 0.16, 0.001, 0.03, 0.774)
ANCHOR_DISTANCE, MIN_DOCUMENTS = 0.15, 30
#: From so many words on: the greatest distances of character classes and of common words.
LIMITS = ((200, 0.16, 0.225), (100, 0.23, 0.26))
_CODES = [chr(0x100 + i) for i in range(len(COMMON))]


def _number_of(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_repeat_words(rows: DataFrame, words: str = "_words", size: int = 3) -> DataFrame:
    """Adds ``n_repeat_words``: how many words lie in runs of ``size`` words found twice or more.

    Run hashes are sorted within the row, n log n in its words: equal neighbours are repeats, and the gaps between
    their places give the words they cover. Each step is a column of its own, so that lambdas refer to a value and
    do not compute it again for every element.
    """
    n = F.size(words) - size
    run = lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(size)]).alias("h"), i.alias("i"))
    rows = rows.withColumn("_runs", F.sort_array(F.when(n >= 1, F.transform(F.sequence(F.lit(0), n), run))))
    same = lambda x, k: F.coalesce(F.get("_runs", k)["h"] == x["h"], F.lit(False))
    twins = F.filter("_runs", lambda x, k: same(x, k - 1) | same(x, k + 1))
    rows = rows.withColumn("_places", F.sort_array(F.transform(twins, lambda x: x["i"])))
    gaps = F.transform("_places", lambda p, k: F.least(F.lit(size), F.coalesce(F.get("_places", k + 1) - p, F.lit(size))))
    total = F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, g: a + g), F.lit(0))
    return rows.withColumn("n_repeat_words", total.cast("long")).drop("_runs", "_places")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rule counts, ``_classes`` and ``_common`` (histograms) beside the other columns of ``docs``, renamed."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    docs = docs.select(column(text_col).alias("_text"), *[prefixed(c) for c in docs.columns if c != text_col])
    others = [c for c in docs.columns if c != "_text"]
    rows = docs.select(*others, text.alias("_text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"))
    code = F.create_map(*[F.lit(x) for pair in zip(COMMON, _CODES, strict=True) for x in pair])
    low = F.transform("_words", F.lower)
    seen = F.array_join(F.transform(F.filter(low, lambda w: w.isin(*COMMON)), lambda w: F.element_at(code, w)), "")
    size = F.length("_text").cast("long")
    rows = with_repeat_words(rows).select(
        *others,
        size.alias("_size"),
        F.size("_words").cast("long").alias("n_words"),
        dup_lines(F.col("_text")).alias("n_dup_lines"),
        "n_repeat_words",
        F.array(*[_number_of(F.col("_text"), c) for c in CLASSES.values()]).alias("_some"),
        seen.alias("_seen"),
    )
    names = list(CLASSES)
    known = F.aggregate("_some", F.lit(0).cast("long"), lambda a, x: a + x)
    each = F.transform(F.array(*map(F.lit, _CODES)), lambda c: (F.length("_seen") - F.length(F.replace(F.col("_seen"), c, F.lit("")))).cast("long"))
    return rows.select(
        *others, "_size", "n_words", "n_dup_lines", "n_repeat_words",
        (F.col("_size") - F.col("_some")[names.index("space")]).alias("word_chars"),
        F.col("_some")[names.index("symbol")].alias("n_symbols"),
        F.concat("_some", F.array(F.col("_size") - known)).alias("_classes"),
        F.concat(each, F.array(F.col("n_words") - F.length("_seen"))).alias("_common"),
    )


def distance(a: Column, a_total: Column, b: Column, b_total: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length, whose totals are given as plain columns."""
    half = lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))
    term = lambda p, q: (half(p, q) + half(q, p)) / 2
    terms = F.zip_with(a, b, lambda x, y: term(x / F.greatest(a_total, F.lit(1)), y / F.greatest(b_total, F.lit(1))))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def references(counted: DataFrame, *keys: Column) -> DataFrame:
    """By ``keys``: the summed histograms of the documents that are ``_prose``, their totals and how many these are."""
    total = lambda c, n: F.array(*[F.sum(F.col(c)[i]) for i in range(n)])
    return counted.where("_prose").groupBy(*keys).agg(
        total("_classes", len(CLASSES) + 1).alias("_class_ref"), F.sum("_size").alias("_class_total"),
        total("_common", len(COMMON) + 1).alias("_common_ref"), F.sum("n_words").alias("_common_total"), F.count("*").alias("_docs"),
    )


def _weighed(rest: Column, histogram: Column) -> Column:
    """The common words of a reference, each list with the share that it has among the listed words of ``histogram``."""
    lists = [F.lit(k) for k in range(len(COMMON) // LIST)]
    by_list = lambda h: F.transform(F.array(*lists), lambda k: F.aggregate(F.slice(h, k * LIST + 1, F.lit(LIST)), F.lit(0.0), lambda a, x: a + x))
    whole = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    bound = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)

    def scaled(r: Column, x: Column) -> Column:
        scales = F.zip_with(r, x, lambda a, b: F.when(a > 0, (b / whole(x)) / (a / whole(r))).otherwise(F.lit(1.0)))
        return bound(scales, lambda sc: F.transform(rest, lambda v, i: F.when(i < len(COMMON), v * F.get(sc, F.floor(i / LIST).cast("int"))).otherwise(v.cast("double"))))

    return bound(by_list(rest), lambda r: bound(by_list(histogram), lambda x: F.when(whole(x) > 0, scaled(r, x)).otherwise(F.transform(rest, lambda v: v.cast("double")))))


def _from(histogram: str, size: str, ref: Column, total: Column, docs: Column, weighed: bool = False) -> Column:
    """Distance from a reference without the document itself; null if too few documents are left in it."""
    own = F.when(F.col("_prose"), F.lit(1)).otherwise(F.lit(0)).cast("long")
    rest = F.zip_with(ref, F.col(histogram), lambda r, x: r - x * own)
    left = F.element_at(F.transform(F.array(rest), lambda r: _weighed(r, F.col(histogram))), 1) if weighed else rest
    apart = distance(F.col(histogram), F.col(size), left, total - F.col(size) * own)
    return F.when(docs - own >= MIN_DOCUMENTS, apart)


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each row of ``docs`` without its text, with counts, base_failed, class_distance, common_distance and kept."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "common_distance", "kept"]
    kept = [c for c in docs.columns if c not in (*added, text_col)]
    counted = counts(docs.select(*[column(c) for c in (*kept, text_col)]), text_col)
    prior = distance(F.col("_classes"), F.col("_size"), F.array(*map(F.lit, PROSE)), F.lit(1.0))
    counted = stored(counted.withColumn("_prior", prior).withColumn("_prose", ~_base_failed() & (F.col("_prior") <= ANCHOR_DISTANCE)))
    lang = working(lang_col)
    by_lang = stored(references(counted, F.col(lang).alias("_lang")))
    # one row: sums over all languages
    pooled = references(counted).first()
    sums = lambda c: F.array(*[F.lit(x or 0).cast("long") for x in pooled[c]])
    judged = join_small(counted, by_lang.withColumnRenamed("_lang", lang), lang, "left")
    one = lambda c: F.lit(pooled[c] or 0).cast("long")
    measures = {}
    for name, histogram, size in (("class", "_classes", "_size"), ("common", "_common", "n_words")):
        own = _from(histogram, size, F.col(f"_{name}_ref"), F.col(f"_{name}_total"), F.coalesce("_docs", F.lit(0)))
        measures[f"{name}_distance"] = F.least(own, _from(histogram, size, sums(f"_{name}_ref"), one(f"_{name}_total"), one("_docs"), name == "common"))
    measures["class_distance"] = F.coalesce(measures["class_distance"], F.col("_prior"))
    judged = judged.withColumns(measures | {"base_failed": _base_failed()})
    odd = F.lit(False)
    for words, far, strange in reversed(LIMITS):
        here = (F.col("class_distance") > far) | (F.coalesce("common_distance", F.lit(0.0)) > strange)
        odd = F.when(F.col("n_words") >= words, here).otherwise(odd)
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~odd)
    return judged.select(*[F.col(working(c)).alias(c) for c in kept], *added)


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    out = judge(docs.select("doc_id", "lang", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *[F.round(c, 6).alias(c) for c in ("class_distance", "common_distance")])


def _sql_count(chars: str) -> str:
    quoted = chars.replace("'", "''")
    return f"length(regexp_replace(t, '[^{quoted}]+', '', 'g'))"


_SQL_CLASSES = ", ".join(_sql_count(c) for c in CLASSES.values())
_SQL_COMMON = ", ".join(f"'{w}'" for w in COMMON)
_SQL_DISTANCE = "sqrt(greatest(0, sum((CASE WHEN {p} > 0 THEN {p} * log2(2 * ({p}) / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * ({q}) / ({p} + {q})) ELSE 0 END) / 2)))"
ORACLE = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS k, unnest(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))) AS g FROM d WHERE len(w) >= 3),
twins AS (SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM runs) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(k, k + 3)) AS pos FROM twins) GROUP BY doc_id),
lined AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
c AS (
  SELECT d.doc_id, lang, len(w)::BIGINT AS n_words, length(t) AS size, [{_SQL_CLASSES}] AS cls,
    list_transform([{_SQL_COMMON}], lambda x: len(list_filter(list_transform(w, lambda v: lower(v)), lambda v: v = x))) AS seen,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lined USING (doc_id) LEFT JOIN covered USING (doc_id)),
h AS (
  SELECT *, list_append(cls, size - list_sum(cls)) AS classes, list_append(seen, n_words - list_sum(seen)) AS common,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM c),
flat AS (
  SELECT doc_id, lang, 'class' AS kind, base_failed, size AS total, unnest(range(len(classes))) AS j, unnest(classes) AS x FROM h
  UNION ALL SELECT doc_id, lang, 'common', base_failed, n_words, unnest(range(len(common))), unnest(common) FROM h),
prior AS (
  SELECT doc_id, {_SQL_DISTANCE.format(p="x::DOUBLE / greatest(total, 1)", q="[" + ", ".join(map(str, PROSE)) + "][j + 1]::DOUBLE")} AS prior
  FROM flat WHERE kind = 'class' GROUP BY doc_id),
part AS (SELECT f.*, prior, NOT base_failed AND prior <= {ANCHOR_DISTANCE} AS prose FROM flat f JOIN prior USING (doc_id)),
own AS (SELECT lang, kind, j, sum(x) AS x, sum(total) AS total, count(*) AS docs FROM part WHERE prose GROUP BY ALL),
pool AS (SELECT kind, j, sum(x) AS x, sum(total) AS total, count(*) AS docs FROM part WHERE prose GROUP BY ALL),
held AS (
  SELECT f.doc_id, f.kind, f.j, f.prior, f.x, f.total, f.prose::INT AS self, r.x AS ref, r.total AS ref_total, r.docs AS docs, 'own' AS side
  FROM part f JOIN own r ON f.lang IS NOT DISTINCT FROM r.lang AND f.kind = r.kind AND f.j = r.j
  UNION ALL
  SELECT f.doc_id, f.kind, f.j, f.prior, f.x, f.total, f.prose::INT, r.x, r.total, r.docs, 'pool' FROM part f JOIN pool r ON f.kind = r.kind AND f.j = r.j),
lists AS (
  SELECT doc_id, kind, side, j // {LIST} AS part, sum(x) AS mine, sum(ref - x * self) AS theirs FROM held
  WHERE side = 'pool' AND kind = 'common' AND j < {len(COMMON)} GROUP BY ALL),
scales AS (
  SELECT doc_id, kind, side, part, CASE WHEN sum(mine) OVER w = 0 OR theirs = 0 THEN 1
    ELSE (mine / (sum(mine) OVER w)) / (theirs / (sum(theirs) OVER w)) END AS scale
  FROM lists WINDOW w AS (PARTITION BY doc_id)),
apart AS (
  SELECT doc_id, kind, side, {_SQL_DISTANCE.format(p="x::DOUBLE / greatest(total, 1)", q="((ref - x * self)::DOUBLE * coalesce(scale, 1)) / greatest(ref_total - total * self, 1)")} AS dist
  FROM (SELECT h.*, scale FROM held h LEFT JOIN scales s ON h.doc_id = s.doc_id AND h.kind = s.kind AND h.side = s.side AND h.j < {len(COMMON)} AND h.j // {LIST} = s.part) WHERE docs - self >= {MIN_DOCUMENTS} GROUP BY doc_id, kind, side),
wide AS (SELECT doc_id, min(dist) FILTER (kind = 'class') AS class_distance, min(dist) FILTER (kind = 'common') AS common_distance FROM apart GROUP BY doc_id),
judged AS (SELECT h.*, coalesce(class_distance, prior) AS class_distance, common_distance FROM h JOIN prior USING (doc_id) LEFT JOIN wide USING (doc_id))
SELECT doc_id, n_words, (size - cls[3])::BIGINT AS word_chars, cls[4]::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (CASE {" ".join(f"WHEN n_words >= {n} THEN class_distance > {far} OR coalesce(common_distance, 0) > {strange}" for n, far, strange in LIMITS)} ELSE false END) AS kept,
  round(class_distance, 6) AS class_distance, round(common_distance, 6) AS common_distance
FROM judged
"""
