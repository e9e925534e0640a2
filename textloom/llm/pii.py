"""Personal data: pattern spans, then information-theoretic sanitisation of the words that give them away.

Base spans are emails, IPv4 addresses, payment cards and phone numbers, found leftmost and without overlap by kind.
The added spans come from the corpus. A term is a lower-cased run of letters and digits with a letter, outside base spans;
an entity is the text of a base span; the two co-occur in a sentence. Everything is counted in texts: a sentence belongs
to one text, the least hash of those that have it, so copies and copied passages count once and one text alone never
discloses. A term discloses an entity if they share at least ``min_texts`` texts, these are at least ``min_share`` of the
term's texts, and the association is significant: the likelihood ratio statistic of the two-by-two table over all
texts (twice their number times the mutual information of the two events) is at least ``min_g``. Every pair of a term and
an entity is tested. Occurrences of disclosing terms are spans of kind ``term``, generalised to a placeholder by
:func:`sanitise`.

Only DataFrame functions. Patterns use possessive loops that match what the greedy ones do but neither recurse nor
rescan runs, and positions are summed in blocks, so very long texts cost little more than their length. An entity of
fewer than ``min_texts`` texts cannot be disclosed and makes no pair; every count is partial before its shuffle.
Disclosing terms are used as a set in the plan up to ``set_terms``; beyond that they are joined by word and text.

Defined cases: null and empty texts have no spans (the digest of nothing); repeated rows get the same spans and count
once; an empty table gives no rows; other columns pass through under any name, but for those named as added.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import column, join_small, prefixed, stored, working

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: By kind, as listed: the pattern, and a cheap test without which it cannot match.
PATTERNS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
TERM = "term"
_SPANS = "array<struct<s:int,e:int>>"
#: A term, an end of a sentence, and the mark before an entity in a text whose base spans are taken out.
_RUN, _STOP, _MARK = r"[\p{L}\p{N}]+", r"[.!?]+[\x20\x09-\x0D]+|\n+", "\uE000"
#: Elements summed at a time.
_BLOCK = 256
_TEXT = "coalesce(_text, '')"


# Expressions over spans are SQL text: they are built and parsed far faster than column by column.
_names = itertools.count()


def _bound(value: str, use: Callable[[str], str]) -> str:
    """``use`` of a value that is worked out once."""
    v = f"v{next(_names)}"
    return f"element_at(transform(array({value}), {v} -> {use(v)}), 1)"


def _scan(items: str, value: Callable[[str], str], combine: Callable[[str, str], str], emit: Callable[[str, str], str], emitted: str) -> str:
    """``emit(before, x)`` of each element, ``before`` being the combined values of all earlier ones from 0."""
    none = f"cast(array() as array<{emitted}>)"
    total = f"b -> aggregate(b, 0, (a, x) -> cast({combine('a', value('x'))} as int))"
    sums = lambda bs: f"aggregate(transform({bs}, {total}), array(0), (a, t) -> concat(a, array(cast({combine('element_at(a, -1)', 't')} as int))))"
    step = f"(a, x) -> struct(cast({combine('a.at', value('x'))} as int) as at, concat(a.out, array({emit('a.at', 'x')})) as out)"
    inside = lambda bs, before: f"flatten(transform({bs}, (b, i) -> aggregate(b, struct({before}[i] as at, {none} as out), {step}, a -> a.out)))"
    blocks = lambda p: f"transform(sequence(0, cast(floor((size({p}) - 1) / {_BLOCK}) as int)), i -> slice({p}, i * {_BLOCK} + 1, {_BLOCK}))"
    every = lambda p: _bound(blocks(p), lambda bs: _bound(sums(bs), lambda before: inside(bs, before)))
    return _bound(items, lambda p: f"if(size({p}) > 0, {every(p)}, {none})")


def _luhn(d: str) -> str:
    """Whether a string of digits passes the Luhn test."""
    digit = f"(ascii(substring({d}, -i, 1)) - 48)"
    twice = f"(2 * {digit} - if({digit} > 4, 9, 0))"
    return f"aggregate(sequence(1, length({d})), 0, (n, i) -> n + if(i % 2 = 0, {twice}, {digit})) % 10 = 0"


def _valid(kind: str, m: str) -> str:
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    if kind == "ip":
        part = "regexp_replace(q, '^0+', '')"
        return f"forall(split({m}, '[.]'), q -> length({part}) <= 3 and coalesce(try_cast({part} as int), 0) <= 255)"
    if kind == "card":
        return _bound(digits, lambda d: f"if(length({d}) between 16 and 19, {_luhn(d)}, false)")
    if kind == "phone":
        return f"length({digits}) between 8 and 15"
    return "true"


def _spans(text: str, pattern: str, accept: Callable[[str], str]) -> str:
    """[start, end) in code points of the pattern's accepted matches, in order."""
    pairs = f"arrays_zip(split({text}, r'{pattern}', -1), regexp_extract_all({text}, r'{pattern}', 0))"
    pairs = f"transform({pairs}, z -> struct(z['0'] as gap, z['1'] as hit))"
    size = lambda x: f"(length({x}.gap) + coalesce(length({x}.hit), 0))"
    keep = lambda x: f"if({x}.hit is not null, {accept(f'{x}.hit')}, false)"
    span = lambda before, x: f"struct({before} + length({x}.gap) as s, {before} + {size(x)} as e, {keep(x)} as keep)"
    every = _scan(pairs, size, lambda a, b: f"{a} + {b}", span, "struct<s:int,e:int,keep:boolean>")
    return f"transform(filter({every}, y -> y.keep), y -> struct(y.s as s, y.e as e))"


def base_spans(text: str) -> dict[str, str]:
    """The spans of each kind of a text that is not null."""
    found = {}
    for kind, (pattern, needed) in PATTERNS.items():
        test = f"contains({text}, '{needed}')" if kind == "email" else f"{text} rlike r'{needed}'"
        found[kind] = f"if({test}, {_spans(text, pattern, lambda m, k=kind: _valid(k, m))}, cast(array() as {_SPANS}))"
    return found


def _replaced(text: str, spans: dict[str, str], show: Callable[[str, str], str]) -> str:
    """``text`` with ``show(kind, hit)`` in place of each span; of overlapping spans, the first shows."""
    each = [f"transform({x}, y -> struct(y.s as s, -y.e as e, '{k}' as k))" for k, x in spans.items()]
    hit = lambda x: f"substring({text}, {x}.s + 1, -{x}.e - {x}.s)"
    gap = lambda before, x: f"substring({text}, {before} + 1, greatest(0, {x}.s - {before}))"
    piece = lambda before, x: f"if({x}.s >= {before}, concat({gap(before, x)}, {show(f'{x}.k', hit(x))}), '')"
    pieces = lambda xs: _scan(xs, lambda x: f"-{x}.e", lambda a, b: f"greatest({a}, {b})", piece, "string")
    rest = lambda xs: f"substring({text}, -array_min(transform({xs}, y -> y.e)) + 1, length({text}))"
    return _bound(f"sort_array(concat({', '.join(each)}))", lambda xs: f"if(size({xs}) > 0, concat(array_join({pieces(xs)}, ''), {rest(xs)}), {text})")


def _in_brackets(kind: str, hit: str) -> str:
    return f"concat('[', upper({kind}), ']')"


def _until_clean(text: str) -> str:
    """``text`` without base spans: what is left may match anew, so they are replaced until none is found.

    Each round that changes the text takes a digit or an @ out, which bounds the rounds.
    """
    most = f"length(regexp_replace({text}, '[^0-9@]+', '')) + 1"
    again = _bound(_replaced("f.t", base_spans("f.t"), _in_brackets), lambda t: f"struct({t} as t, {t} <> f.t as open)")
    return f"aggregate(sequence(1, {most}), struct({text} as t, true as open), (f, r) -> if(f.open, {again}, f), f -> f.t)"


def terms_of(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits with a letter."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(_RUN), F.lit(0))
    return F.filter(F.array_distinct(runs), lambda w: w.rlike(r"\p{L}"))


def _renamed(docs: DataFrame, text_col: str) -> DataFrame:
    others = [prefixed(c) for c in docs.columns if c != text_col]
    return docs.select(column(text_col).alias("_text"), *others)


def _spanned(renamed: DataFrame) -> DataFrame:
    found = base_spans(_TEXT)
    # a column for each kind: fields of a struct would be worked out anew wherever they are used
    return renamed.withColumns({f"_{k}": F.expr(found[k]) for k in PATTERNS})


def _columns(kinds: tuple[str, ...]) -> dict[str, str]:
    return {k: f"_{k}" for k in kinds}


def _log_ratio(both: Column, own: Column, other: Column, n: Column) -> Column:
    """The likelihood ratio statistic of two events that ``both`` of ``n`` texts share."""
    cell = lambda seen, a, b: F.when(seen > 0, seen * F.log(seen * n / (a * b))).otherwise(F.lit(0.0))
    return 2 * (cell(both, own, other) + cell(own - both, own, n - other) + cell(other - both, n - own, other) + cell(n - own - other + both, n - own, n - other))


def disclosing_terms(spanned: DataFrame, min_texts: int = 3, min_share: float = 0.5, min_g: float = 20.0) -> DataFrame:
    """(``term``): terms that reveal an entity, from rows with ``_text`` and base spans."""
    marked = lambda kind, hit: f"concat(' {_MARK}', hex(xxhash64({hit})), ' ')"
    base = _columns(tuple(PATTERNS))
    has_base = F.expr(f"size(concat({', '.join(base.values())})) > 0")
    plain = spanned.withColumn("_plain", F.expr(f"replace({_TEXT}, '{_MARK}', ' ')"))
    taken_out = F.when(has_base, F.expr(_replaced("_plain", base, marked))).otherwise(F.col("_plain"))
    rows = plain.select(F.xxhash64("_plain").alias("h"), taken_out.alias("t"), has_base.alias("held"))
    sentences = rows.select("h", "held", F.explode(F.split("t", _STOP, -1)).alias("s"))
    unit = F.xxhash64("s")
    held = sentences.where(F.col("held") & F.contains("s", F.lit(_MARK)))
    held = stored(held.groupBy(unit.alias("unit")).agg(F.min("h").alias("own"), F.min("s").alias("s")))
    entities = F.array_distinct(F.regexp_extract_all("s", F.lit(f"{_MARK}([0-9A-F]+)"), F.lit(1)))
    words = lambda s: terms_of(F.regexp_replace(s, f"{_MARK}[0-9A-F]+", " "))

    texts_of = lambda df, *key: df.groupBy(*key, "own").count().groupBy(*key).agg(F.count("*").alias("n"))
    of_entity = held.select("unit", "own", F.explode(entities).alias("entity"))
    per_entity = stored(texts_of(of_entity, "entity").where(F.col("n") >= min_texts).withColumnRenamed("n", "n_entity"))
    if per_entity.isEmpty():
        return held.select(F.col("s").alias("term")).limit(0)
    known = join_small(of_entity, per_entity.select("entity"), "entity", "left_semi")
    each = known.join(held.select(F.col("unit").alias("_unit"), "s"), F.col("unit") == F.col("_unit")).select("entity", "own", F.explode(words(F.col("s"))).alias("term"))
    pairs = texts_of(each, "term", "entity").where(F.col("n") >= min_texts).withColumnRenamed("n", "both")
    # a term has at least the texts of its sentences with entities: most fall short of the share already
    least = texts_of(held.select("own", F.explode(words(F.col("s"))).alias("term")), "term").withColumnRenamed("n", "least")
    pairs = stored(pairs.join(least, "term").where(F.col("both") >= F.col("least") * min_share).select("term", "entity", "both"))
    if pairs.isEmpty():
        return pairs.select("term")
    wanted = pairs.select("term").distinct()
    seen = sentences.select("h", unit.alias("unit"), F.explode(words(F.col("s"))).alias("term"))
    seen = join_small(seen, wanted, "term", "left_semi").groupBy("term", "unit").agg(F.min("h").alias("own"))
    per_term = texts_of(seen, "term").withColumnRenamed("n", "n_term")
    total = rows.where(F.col("t").rlike(_RUN)).select("h").distinct().count()
    tested = pairs.join(per_term, "term").join(per_entity, "entity")
    share, n = F.col("both") / F.col("n_term"), F.lit(float(total))
    linked = F.col("both") * n > F.col("n_term") * F.col("n_entity")
    strong = _log_ratio(F.col("both"), F.col("n_term"), F.col("n_entity"), n) >= min_g
    return tested.where((share >= min_share) & linked & strong).select("term").distinct()


def with_term_spans(spanned: DataFrame, terms: DataFrame, set_terms: int = 5_000) -> DataFrame:
    """Adds ``_term`` to rows with ``_text``: spans of the runs that are among ``terms``."""
    terms = stored(terms)
    some = [r["term"] for r in terms.limit(set_terms + 1).collect()]
    none = F.array().cast(_SPANS)
    text = F.expr(_TEXT)
    if not some:
        return spanned.withColumn("_term", none)
    if len(some) <= set_terms:
        known = F.exists(terms_of(text), lambda w: w.isin(some))
        # terms hold letters and digits alone, so they can be quoted as they are
        listed = ", ".join(f"'{w}'" for w in some)
        return spanned.withColumn("_term", F.when(known, F.expr(_spans(_TEXT, _RUN, lambda m: f"lower({m}) in ({listed})"))).otherwise(none))
    keyed = spanned.withColumn("_h", F.xxhash64(text, F.length(text)))
    words = keyed.select("_h", F.explode(terms_of(text)).alias("term")).distinct()
    own = stored(words.join(terms, "term").groupBy("_h").agg(F.collect_set("term").alias("_own")))
    out = join_small(keyed, own, "_h", "left")
    found = F.expr(_spans(_TEXT, _RUN, lambda m: f"array_contains(_own, lower({m}))"))
    return out.withColumn("_term", F.when(F.col("_own").isNotNull(), found).otherwise(none)).drop("_h", "_own")


def _found(docs: DataFrame, text_col: str, **limits) -> DataFrame:
    """``docs`` renamed, with the spans of every kind as columns."""
    spanned = _spanned(_renamed(docs, text_col))
    return with_term_spans(spanned, disclosing_terms(spanned, **limits))


def find_personal_data(docs: DataFrame, text_col: str = "text", added: str = "personal_data", **limits) -> DataFrame:
    """``docs`` with ``added``: a struct of the spans [s, e) of each kind, ``term`` the last."""
    found = _found(docs.drop(added), text_col, **limits)
    every = F.struct(*[F.col(x).alias(k) for k, x in _columns((*PATTERNS, TERM)).items()])
    return found.select(*_back(docs.drop(added), text_col, F.col("_text")), every.alias(added))


def _back(docs: DataFrame, text_col: str, text: Column) -> list[Column]:
    return [(text if c == text_col else F.col(working(c))).alias(c) for c in docs.columns]


def sanitise(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in brackets; overlapping spans become one.

    What stands around a replaced span may then match a pattern: texts are cleaned until no base span is left.
    """
    found = _found(docs, text_col, **limits)
    spans = _columns((*PATTERNS, TERM))
    clean = F.expr(_bound(_replaced("_text", spans, _in_brackets), _until_clean))
    return found.select(*_back(docs, text_col, F.when(F.size(F.concat(*spans.values())) > 0, clean).otherwise(F.col("_text"))))


def _listed(spans: dict[str, str]) -> Column:
    each = [f"transform({x}, y -> concat_ws(':', '{k}', y.s, y.e))" for k, x in spans.items()]
    return F.expr(f"array_join(concat({', '.join(each)}), ',')")


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    found = _found(docs.select("doc_id", "text"), "text")
    base = _columns(tuple(PATTERNS))
    return found.select(
        F.col("_in_doc__id").alias("doc_id"),
        *[F.size(x).cast("long").alias(f"n_{k}") for k, x in base.items()],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(_columns((*PATTERNS, TERM))).alias("spans"),
    )
