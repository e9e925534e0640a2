"""Registered queries over the driver's tables, with their DuckDB equivalents.

``documents`` stands for a corpus (doc_id is its order, source its category), ``conversations`` for chat examples,
``labels.quality`` for truth, ``benchmark`` for test items and a glossary's source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import benchmarks, chat, chunking, dedup, evaluation, generation, inference, mixing, packing, quality, synthetic_quality, terms
from textloom.session import materialised, scratch_path, spread
from textloom.sources import readers, sinks
from textloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# --- SQL fragments -------------------------------------------------------------------------------------------------
SP = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SP}]+|[{SP}]+$', '', 'g')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{SP}]+')"


def _grams(tokens: str, n: int, sep: str = " ") -> str:
    return f"list_transform(range(1, greatest(len({tokens}) - {n - 1}, 0) + 1), lambda i: array_to_string(list_slice({tokens}, i, i + {n - 1}), '{sep}'))"


_COMMON = ", ".join(f"'{w}'" for w in quality.ENGLISH_WORDS)
_GUESS = f"""
guess AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(substr(text, 1, 1000)), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'),
    lambda w: regexp_full_match(w, '[a-z]+')) AS ws
  FROM documents),
lang_of AS (
  SELECT doc_id, CASE WHEN len(ws) > 0 AND len(list_filter(ws, lambda w: w IN ({_COMMON})))::DOUBLE / len(ws) > 0.08::DOUBLE
    THEN 'en' ELSE 'unknown' END AS detected FROM guess)"""
_SCORE = f"""
parts AS (
  SELECT doc_id, text, length(text)::DOUBLE AS n,
    length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}{SP}]+', '', 'g')) AS plain, length(regexp_replace(text, '[^ ]+', '', 'g')) AS gaps,
    string_split({_strip("text")}, chr(10)) AS ls
  FROM documents),
lined AS (SELECT *, list_filter(ls, lambda x: regexp_matches(x, '[^{SP}]')) AS filled FROM parts),
scored AS (
  SELECT doc_id, text, CASE WHEN text = '' THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    1.0::DOUBLE - CASE WHEN plain / n < 0.7::DOUBLE THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN len(ls) > 5 AND len(list_distinct(list_transform(filled, lambda x: {_strip("x")})))::DOUBLE / len(ls) < 0.5::DOUBLE THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN len(filled) > 0 AND list_sum(list_transform(filled, lambda x: length(x)))::DOUBLE / len(filled) < 20::DOUBLE THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN gaps / n > 0.4::DOUBLE THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END)) END AS score
  FROM lined)"""


def _reasons(language: str) -> str:
    return f"""
reasons AS (
  SELECT s.doc_id, CASE WHEN length(text) < 500 THEN 'too_short' WHEN length(text) > 50000 THEN 'too_long'
    WHEN detected <> '{language}' AND detected <> 'unknown' THEN 'language' WHEN score < 0.4::DOUBLE THEN 'quality' END AS reason
  FROM scored s JOIN lang_of USING (doc_id))"""


_REPEAT = f"""
base AS (SELECT id, text, {_words("lower(text)")} AS ws, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda x: {_strip("x")}), lambda x: x <> '') AS said FROM src),
grams AS (SELECT *, {_grams("ws", 3, chr(1))} AS g FROM base),
ratios AS (
  SELECT *, CASE WHEN len(ws) < 6 THEN 0.0::DOUBLE ELSE (len(g) - len(list_distinct(g)))::DOUBLE / len(g) END AS rep,
    CASE WHEN len(said) < 2 THEN 0.0::DOUBLE
      ELSE (len(said) - len(list_distinct(list_transform(said, lambda x: lower(x)))))::DOUBLE / len(said) END AS sent_rep
  FROM grams),
synth AS (
  SELECT id, text, rep, sent_rep, CASE WHEN NOT regexp_matches(text, '[^{SP}]') THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE,
    1.0::DOUBLE - CASE WHEN length(regexp_replace(text, '[^\\p{{L}}]+', '', 'g'))::DOUBLE / length(text) < 0.5::DOUBLE THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN length(regexp_replace(text, '[^{SP}]+', '', 'g'))::DOUBLE / length(text) > 0.4::DOUBLE THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN len(said) < 2 AND length(text) > 200 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN rep > 0.3::DOUBLE THEN 0.3::DOUBLE WHEN rep > 0.15::DOUBLE THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN sent_rep > 0.3::DOUBLE THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END) END AS score
  FROM ratios),
checked AS (
  SELECT *, CASE WHEN length(text) < 50 THEN 'too_short' WHEN length(text) > 10000 THEN 'too_long' WHEN rep > 0.4::DOUBLE THEN 'too_repetitive'
    WHEN score < 0.5::DOUBLE THEN 'low_quality' ELSE 'passed' END AS reason FROM synth)"""
_OF_DOCS = f"WITH src AS (SELECT doc_id AS id, text FROM documents), {_REPEAT}"
_OF_TURNS = f"WITH src AS (SELECT conv_id * 1000 + turn AS id, text FROM conversations), {_REPEAT}"
_PRIME = str(dedup.PRIME)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as it is read, for projections and joins."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus for work on whole texts: id and text, over all cores."""
    return spread(docs(spark, sf_dir).select("doc_id", "text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL if it has one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- scans and projections -----------------------------------------------------------------------------------------
@query(f"SELECT doc_id, length(text)::INT AS char_length, len({_words('text')})::INT AS word_count FROM documents")
def doc_lengths(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.length("text").alias("char_length"), tx.word_count(F.col("text")).alias("word_count"))


@query("""
SELECT 0 AS src, doc_id AS ord, source AS category, length(text)::INT AS n FROM documents
UNION ALL SELECT 1, item_id, 'benchmark', length(text)::INT FROM benchmark""")
def source_union(spark, sf_dir):
    one = docs(spark, sf_dir).select(F.lit(0).alias("src"), F.col("doc_id").alias("ord"), F.col("source").alias("category"), F.length("text").alias("n"))
    two = table(spark, sf_dir, "benchmark").select(F.lit(1).alias("src"), F.col("item_id").alias("ord"), F.lit("benchmark").alias("category"), F.length("text").alias("n"))
    return one.unionByName(two)


@query("SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src5')")
def category_filter(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("metadata", F.create_map(F.lit("category"), F.col("source"), F.lit("type"), F.col("lang")))
    return rows.where(readers.in_categories(["src1", "src5"])).select("doc_id", "source")


@query("""
SELECT 'documents:' || doc_id AS name, lang AS kind FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100) WHERE text <> ''""")
def max_documents_cap(spark, sf_dir):
    rows = readers.documents_from_table(docs(spark, sf_dir), "documents", ord_col="doc_id", max_documents=100)
    return rows.select(F.col("doc_id").alias("name"), F.element_at("metadata", "lang").alias("kind"))


# --- corpus quality ------------------------------------------------------------------------------------------------
@query("SELECT doc_id FROM documents WHERE length(text) BETWEEN 500 AND 50000")
def length_filter(spark, sf_dir):
    return docs(spark, sf_dir).where(F.length("text").between(500, 50_000)).select("doc_id")


@query(f"WITH {_GUESS} SELECT * FROM lang_of")
def language_detect(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", quality.guess_language(F.col("text")).alias("detected"))


@query(f"WITH {_GUESS}, {_SCORE}, {_reasons('fr')} SELECT doc_id, coalesce(reason, 'passed') AS reason FROM reasons")
def language_filter_fr(spark, sf_dir):
    rows = quality.with_drop_reason(texts(spark, sf_dir), language="fr")
    return rows.select("doc_id", F.coalesce("drop_reason", F.lit("passed")).alias("reason"))


@query(f"WITH {_SCORE} SELECT doc_id, round(score, 6) AS score FROM scored")
def quality_score(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.round(quality.quality_score(F.col("text")), 6).alias("score"))


@query(f"WITH {_GUESS}, {_SCORE}, {_reasons('en')} SELECT doc_id, n_chars FROM documents JOIN reasons USING (doc_id) WHERE reason IS NULL")
def quality_filter(spark, sf_dir):
    return quality.quality_filter(spread(docs(spark, sf_dir).select("doc_id", "text", "n_chars"))).select("doc_id", "n_chars")


@query(f"""WITH {_GUESS}, {_SCORE}, {_reasons('en')}
SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS passed, count(*) FILTER (reason = 'too_short') AS dropped_too_short,
  count(*) FILTER (reason = 'too_long') AS dropped_too_long, count(*) FILTER (reason = 'language') AS dropped_language,
  count(*) FILTER (reason = 'quality') AS dropped_quality, round(1.0::DOUBLE - count(*) FILTER (reason IS NULL)::DOUBLE / count(*), 4) AS drop_rate FROM reasons""")
def quality_filter_stats(spark, sf_dir):
    return quality.filter_stats(texts(spark, sf_dir)).withColumn("drop_rate", F.round("drop_rate", 4))


# --- synthetic quality ---------------------------------------------------------------------------------------------
@query(f"{_OF_DOCS} SELECT id AS doc_id, round(rep, 6) AS repetition, round(sent_rep, 6) AS sentence_repetition FROM ratios")
def repetition_ratios(spark, sf_dir):
    text = F.col("text")
    return texts(spark, sf_dir).select(
        "doc_id", F.round(synthetic_quality.repetition_ratio(text), 6).alias("repetition"),
        F.round(synthetic_quality.sentence_repetition_ratio(text), 6).alias("sentence_repetition"),
    )


@query(f"{_OF_DOCS} SELECT id AS doc_id, round(score, 6) AS score FROM synth")
def synthetic_score(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.round(synthetic_quality.synthetic_score(F.col("text")), 6).alias("score"))


@query(f"{_OF_TURNS} SELECT id, reason FROM checked")
def synthetic_check(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), synthetic_quality.check(F.col("text")).alias("reason"))


@query(f"{_OF_DOCS} SELECT id AS doc_id, round(score, 6) AS quality_score FROM checked WHERE reason = 'passed'")
def synthetic_filter(spark, sf_dir):
    rows = synthetic_quality.filter_examples(texts(spark, sf_dir).select("doc_id", F.col("text").alias("answer")))
    return rows.select("doc_id", F.round("quality_score", 6).alias("quality_score"))


@query(f"""{_OF_DOCS} SELECT count(*) AS total, count(*) FILTER (reason = 'passed') AS passed, count(*) FILTER (reason = 'too_short') AS too_short,
  count(*) FILTER (reason = 'too_long') AS too_long, count(*) FILTER (reason = 'too_repetitive') AS too_repetitive,
  count(*) FILTER (reason = 'low_quality') AS low_quality, round(count(*) FILTER (reason = 'passed')::DOUBLE / count(*), 4) AS pass_rate FROM checked""")
def synthetic_stats(spark, sf_dir):
    return synthetic_quality.check_stats(texts(spark, sf_dir), "text").withColumn("pass_rate", F.round("pass_rate", 4))


# --- terminology ---------------------------------------------------------------------------------------------------
# Runs of word characters that are not all a-z break a token; the others chain over hyphens and apostrophes.
_TOKENISED = r"""
broken AS (
  SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+|[''-]+|[^\p{L}\p{M}\p{N}_''-]+'),
    lambda s: CASE WHEN regexp_matches(s, '[\p{L}\p{M}\p{N}_]') AND NOT regexp_full_match(s, '[a-z]+') THEN ' ' ELSE s END), '') AS t FROM documents),
pieces AS (SELECT doc_id, regexp_extract_all(t, '[a-z]+(?:[''-]+[a-z]+)*') AS tokens FROM broken)"""


@query(f"WITH {_TOKENISED} SELECT doc_id, len(tokens)::INT AS tokens, len(list_distinct(tokens))::INT AS distinct_tokens FROM pieces")
def unigrams(spark, sf_dir):
    tokens = tx.term_tokens(F.col("text"))
    return texts(spark, sf_dir).select("doc_id", F.size(tokens).alias("tokens"), F.size(F.array_distinct(tokens)).alias("distinct_tokens"))


_ENGLISH_GRAMS = f"""
WITH {_TOKENISED},
grams AS (
  SELECT doc_id, 1 AS n, unnest(range(len(tokens))) AS i, unnest(tokens) AS term FROM pieces
  UNION ALL SELECT doc_id, 2, unnest(range(greatest(len(tokens) - 1, 0))), unnest({_grams("tokens", 2)}) FROM pieces
  UNION ALL SELECT doc_id, 3, unnest(range(greatest(len(tokens) - 2, 0))), unnest({_grams("tokens", 3)}) FROM pieces),
by_term AS (
  SELECT term, count(*) AS frequency, count(DISTINCT doc_id) AS document_frequency, min((doc_id, n, i)) AS first FROM grams GROUP BY term)"""


@query(f"{_ENGLISH_GRAMS} SELECT term, frequency FROM by_term WHERE frequency >= 20")
def term_frequency(spark, sf_dir):
    return terms.term_counts(texts(spark, sf_dir), min_frequency=20).select("term", "frequency")


@query(f"{_ENGLISH_GRAMS} SELECT term, document_frequency FROM by_term WHERE document_frequency >= 5")
def document_frequency(spark, sf_dir):
    return terms.term_counts(texts(spark, sf_dir), min_documents=5).select("term", "document_frequency")


@query(f"""{_ENGLISH_GRAMS},
scored AS (
  SELECT term, frequency::BIGINT AS frequency, document_frequency, first,
    frequency * (ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (document_frequency + 1)) + 1) AS tfidf
  FROM by_term WHERE frequency >= 100 AND length(term) >= 3)
SELECT term, frequency, document_frequency, round(tfidf, 4) AS tfidf FROM scored ORDER BY scored.tfidf DESC, first LIMIT 200""")
def tfidf_topk(spark, sf_dir):
    return terms.extract_terms(texts(spark, sf_dir), 100, 3, 200).withColumn("tfidf", F.round("tfidf", 4))


#: A small glossary over the driver's invented words.
GLOSSARY = ("the", "of and", "thing", "that the", "lichen", "der die", "les", "en el", "ation", "Retion")
_GLOSSARY_SQL = "(VALUES " + ", ".join(f"('{t}')" for t in GLOSSARY) + ") g(term)"
_MATCH = r"regexp_matches(lower(text), '(^|[^\p{L}\p{M}\p{N}_])' || lower(term) || '($|[^\p{L}\p{M}\p{N}_])')"


def _glossary(spark):
    return spark.createDataFrame([(t,) for t in GLOSSARY], "term string")


@query(f"SELECT doc_id, term FROM documents, {_GLOSSARY_SQL} WHERE {_MATCH}")
def glossary_match(spark, sf_dir):
    return evaluation.term_matches(texts(spark, sf_dir), _glossary(spark)).select("doc_id", "term")


@query(f"""WITH hits AS (SELECT doc_id, term FROM documents, {_GLOSSARY_SQL} WHERE {_MATCH})
SELECT count(DISTINCT term) AS unique_terms_found, {len(GLOSSARY)}::BIGINT AS total_terms, (SELECT count(*) FROM documents) AS num_examples,
  round(count(DISTINCT term)::DOUBLE / {len(GLOSSARY)}, 4) AS term_recall, round(count(*)::DOUBLE / (SELECT count(*) FROM documents), 4) AS avg_terms_per_prompt,
  count(DISTINCT term)::DOUBLE / {len(GLOSSARY)} >= 0.3 AS passed FROM hits""")
def term_recall(spark, sf_dir):
    out = evaluation.term_recall(texts(spark, sf_dir), _glossary(spark))
    return out.withColumn("term_recall", F.round("term_recall", 4)).withColumn("avg_terms_per_prompt", F.round("avg_terms_per_prompt", 4))


# --- near-duplicates -----------------------------------------------------------------------------------------------
_SHINGLES = f"""
plain AS (SELECT doc_id, {_strip("lower(text)")} AS t FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN length(t) < 5 THEN [t] ELSE list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5))) END AS s FROM plain),
hashed AS MATERIALIZED (
  SELECT doc_id, ('0x' || substr(m, 7, 2) || substr(m, 5, 2) || substr(m, 3, 2) || substr(m, 1, 2))::BIGINT AS h
  FROM (SELECT doc_id, md5(unnest(s)) AS m FROM shingled))"""
_A, _B = dedup.permutations(128)
_SIGNED = f"""WITH RECURSIVE {_SHINGLES},
perms AS (SELECT unnest(range(128)) AS slot, unnest([{", ".join(map(str, _A.tolist()))}])::HUGEINT AS a, unnest([{", ".join(map(str, _B.tolist()))}])::HUGEINT AS b),
valued AS MATERIALIZED (
  SELECT h, slot, (((a * h + b) % {_PRIME}) % 4294967296)::BIGINT AS value FROM (SELECT DISTINCT h FROM hashed), perms),
signed AS MATERIALIZED (SELECT doc_id, slot, min(value) AS value FROM hashed JOIN valued USING (h) GROUP BY doc_id, slot)"""
_LINKED = f"""{_SIGNED},
banded AS MATERIALIZED (SELECT doc_id, slot // 8 AS band, string_agg(value::VARCHAR, ',' ORDER BY slot) AS key FROM signed GROUP BY doc_id, slot // 8),
candidates AS MATERIALIZED (
  SELECT DISTINCT x.doc_id AS i, y.doc_id AS j FROM banded x JOIN banded y ON x.band = y.band AND x.key = y.key AND x.doc_id < y.doc_id),
alike AS MATERIALIZED (
  SELECT i, j, count(*) FILTER (x.value = y.value)::DOUBLE / 128 AS similarity
  FROM candidates JOIN signed x ON x.doc_id = i JOIN signed y ON y.doc_id = j AND x.slot = y.slot GROUP BY i, j),
links AS MATERIALIZED (SELECT i, j FROM alike WHERE similarity >= 0.85)"""
_GREEDY = f"""{_LINKED},
nodes AS MATERIALIZED (
  SELECT n, row_number() OVER (ORDER BY n) AS k, coalesce((SELECT list(i) FROM links WHERE j = n), []) AS before
  FROM (SELECT i AS n FROM links UNION SELECT j FROM links)),
walk AS (
  SELECT 0::BIGINT AS k, []::BIGINT[] AS kept
  UNION ALL
  SELECT nodes.k, CASE WHEN list_has_any(kept, before) THEN kept ELSE list_append(kept, n) END FROM walk JOIN nodes ON nodes.k = walk.k + 1),
gone AS (
  SELECT n FROM nodes, (SELECT kept FROM walk ORDER BY k DESC LIMIT 1) WHERE NOT list_contains(kept, n)),
survivors AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT n FROM gone))"""


@query(f"WITH {_SHINGLES} SELECT doc_id, len(s)::INT AS shingles FROM shingled")
def shingle_count(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.size(dedup.shingles(F.col("text"))).alias("shingles"))


@query(f"WITH {_SHINGLES} SELECT doc_id, min(h) AS least, max(h) AS greatest, sum(h)::BIGINT AS total FROM hashed GROUP BY doc_id")
def shingle_hash(spark, sf_dir):
    return dedup.with_shingle_hashes(texts(spark, sf_dir))


@query(f"{_SIGNED} SELECT doc_id, string_agg(value::VARCHAR, ',' ORDER BY slot) AS signature FROM signed GROUP BY doc_id")
def minhash_signature(spark, sf_dir):
    signed = dedup.with_signatures(texts(spark, sf_dir))
    return signed.select("doc_id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


def _signed(spark, sf_dir):
    return materialised(dedup.with_signatures(texts(spark, sf_dir)))


@query(f"{_LINKED} SELECT * FROM candidates")
def lsh_candidate_pairs(spark, sf_dir):
    return dedup.candidate_pairs(_signed(spark, sf_dir))


@query(f"{_LINKED} SELECT i, j, round(similarity, 6) AS similarity FROM alike WHERE similarity >= 0.85")
def similar_pairs(spark, sf_dir):
    return dedup.similar_pairs(_signed(spark, sf_dir)).withColumn("similarity", F.round("similarity", 6))


@query(f"{_GREEDY} SELECT doc_id FROM survivors")
def dedup_keep(spark, sf_dir):
    return dedup.deduplicate(texts(spark, sf_dir)).select("doc_id")


@query(f"""{_GREEDY} SELECT count(*) AS total, (SELECT count(*) FROM survivors) AS kept, count(*) - (SELECT count(*) FROM survivors) AS removed,
  round((count(*) - (SELECT count(*) FROM survivors))::DOUBLE / count(*), 4) AS dedup_rate FROM documents""")
def dedup_stats(spark, sf_dir):
    rows = texts(spark, sf_dir)
    return dedup.dedup_stats(rows, dedup.deduplicate(rows)).withColumn("dedup_rate", F.round("dedup_rate", 4))


# --- chunks and chat -----------------------------------------------------------------------------------------------
def _last(seg: str, mark: str, base: str) -> str:
    """Place of the last ``mark`` in ``seg``, which starts at ``base``; null without one."""
    sql = f"'{mark}'"
    return f"CASE WHEN strpos({seg}, {sql}) > 0 THEN {base} + length({seg}) - (strpos(reverse({seg}), reverse({sql})) - 1) - {len(mark)} END"


def _pieces_sql(size: int, overlap: int, marks: tuple[str, ...], latest: bool, clamp: bool, raw: bool, min_words: int = 0, source: str = "documents") -> str:
    """CTEs ending in pieces(doc_id, chunk_index, n_chunks, chunk): starts and ends by recursion."""
    half = size // 2
    if latest:
        seg = f"substr(text, start + 1, {size})"
        found = [_last(seg, m, "start") for m in marks]
        place = f"greatest({', '.join(f'coalesce({x}, -1)' for x in found)})"
        stop = f"CASE WHEN start + {size} < length(text) AND {place} > start + {half} THEN {place} + 1 ELSE start + {size} END"
    else:
        seg = f"substr(text, start + {half} + 1, {size - half})"
        found = [f"({_last(seg, m, f'start + {half}')}) + {len(m)}" for m in marks]
        stop = f"CASE WHEN start + {size} < length(text) THEN coalesce({', '.join(found)}, start + {size}) ELSE {f'least(start + {size}, length(text))' if clamp else f'start + {size}'} END"
    words = f" AND len({_words('chunk')}) >= {min_words}" if min_words else ""
    single = "text" if raw else _strip("text")
    return f"""
cut AS (
  SELECT doc_id, text, 0::BIGINT AS start, ({stop.replace("start", "0::BIGINT")})::BIGINT AS stop FROM {source} WHERE length(text) > {size}
  UNION ALL
  SELECT doc_id, text, start, ({stop})::BIGINT AS stop FROM (SELECT doc_id, text, stop - {overlap} AS start FROM cut WHERE stop - {overlap} < length(text))),
many AS (SELECT doc_id, start, {_strip("substr(text, start + 1, stop - start)")} AS chunk FROM cut),
whole AS (SELECT doc_id, 0::BIGINT AS start, {single} AS chunk FROM {source} WHERE length(text) <= {size}),
every AS (SELECT * FROM many WHERE chunk <> ''{words} UNION ALL SELECT * FROM whole{"" if raw else " WHERE chunk <> ''"}),
pieces AS (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1)::INT AS chunk_index, (count(*) OVER (PARTITION BY doc_id))::INT AS n_chunks, chunk FROM every)"""


_CHAT = "WITH RECURSIVE " + _pieces_sql(8000, 200, (".", "\n"), True, False, True)
_LONG_ENOUGH = "long_docs AS (SELECT doc_id, text FROM documents WHERE length(text) >= 200),"
_QA = f"WITH RECURSIVE {_LONG_ENOUGH}" + _pieces_sql(1500, 200, (".\n", ". ", "\n\n", "\n"), False, False, False, source="long_docs") + f""",
passages AS (
  SELECT doc_id, chunk_index, chunk FROM pieces WHERE len({_words("chunk")}) >= 30
    AND length(regexp_replace(chunk, '[^\\p{{L}}]+', '', 'g'))::DOUBLE / length(chunk) > 0.5::DOUBLE)"""
_INSTRUCTION = f"WITH RECURSIVE {_LONG_ENOUGH}" + _pieces_sql(1500, 0, ("\n\n", ".\n", ". ", "\n"), False, True, False, 20, "long_docs")


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"{_CHAT} SELECT doc_id, chunk_index, n_chunks, chunk FROM pieces")
def chunk_text(spark, sf_dir):
    return chunking.chunk(texts(spark, sf_dir), chunking.chat_chunker())


@query(f"{_QA} SELECT doc_id, chunk_index, chunk AS passage FROM passages")
def qa_passages(spark, sf_dir):
    return generation.qa_passages(texts(spark, sf_dir)).select(F.col("ord").alias("doc_id"), "chunk_index", "passage")


@query(f"{_INSTRUCTION} SELECT doc_id, chunk_index, chunk AS passage FROM pieces")
def instruction_passages(spark, sf_dir):
    return generation.instruction_passages(texts(spark, sf_dir)).select(F.col("ord").alias("doc_id"), "chunk_index", "passage")


def _spoken(examples: DataFrame) -> DataFrame:
    one = lambda k: F.col("messages")[k]["content"]
    return examples.select("doc_id", one(0).alias("system"), one(1).alias("user"), one(2).alias("assistant"))


_PIECE_ID = "CASE WHEN n_chunks > 1 THEN doc_id || ':chunk_' || chunk_index ELSE doc_id::VARCHAR END AS doc_id"


@query(f"{_CHAT} SELECT {_PIECE_ID}, {_quote(chat.SYSTEM_PROMPTS['legal'])} AS system, 'Continue the following text:' AS \"user\", chunk AS assistant FROM pieces")
def format_completion(spark, sf_dir):
    return _spoken(chat.format_chat(texts(spark, sf_dir)))


@query(f"""{_CHAT}
SELECT {_PIECE_ID.replace("doc_id", "p.doc_id").replace("AS p.doc_id", "AS doc_id")}, {_quote(chat.SYSTEM_PROMPTS['legal'])} AS system,
  CASE WHEN lang = 'en' THEN 'Explain the following ' || source || ' document: ' || lang ELSE 'Provide analysis of this ' || source || ' document.' END
    || CASE WHEN chunk_index > 0 THEN ' (continued, part ' || (chunk_index + 1) || ')' ELSE '' END AS "user", chunk AS assistant
FROM pieces p JOIN documents d ON p.doc_id = d.doc_id""")
def format_qa(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("title", F.when(F.col("lang") == "en", F.col("lang")))
    return _spoken(chat.format_chat(rows, "qa", title_col="title", category_col="source"))


_RENDER = "string_agg(CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: ' WHEN 'assistant' THEN 'Assistant: ' END || text || chr(10), '' ORDER BY turn)"


@query("SELECT conv_id, count(*)::INT AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def chat_from_conversations(spark, sf_dir):
    rows = chat.conversations_to_chat(table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", F.size("messages").alias("n_messages"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"))


@query(f"SELECT conv_id, coalesce({_RENDER}, '') AS text FROM conversations GROUP BY conv_id")
def sft_render(spark, sf_dir):
    return chat.render_for_sft(chat.conversations_to_chat(table(spark, sf_dir, "conversations")))


# --- generated examples --------------------------------------------------------------------------------------------
def _pick_sql(options: list[str], *parts: str) -> str:
    key = " || '|' || ".join(["'42t'", *parts])
    return f"[{', '.join(map(_quote, options))}][(('0x' || substr(md5({key}), 1, 8))::BIGINT % {len(options)} + 1)::INT]"


_RANKED = "row_number() OVER (PARTITION BY doc_id ORDER BY md5('42|' || doc_id || '|' || chunk_index), chunk_index)"


@query(f"""{_QA},
ranked AS (SELECT *, {_RANKED} AS k FROM passages)
SELECT {_pick_sql(generation.QA_TEMPLATES['legal'], 'doc_id', 'chunk_index')} || chr(10) || chr(10) || 'Context:' || chr(10) || chunk AS question,
  chunk AS answer, doc_id::VARCHAR AS source_doc_id FROM ranked WHERE k <= 5""")
def qa_pairs(spark, sf_dir):
    return generation.qa_pairs(texts(spark, sf_dir)).select("question", "answer", "source_doc_id")


_TASKS, _TEXTS = zip(*generation.INSTRUCTIONS["legal"], strict=True)


@query(f"""{_INSTRUCTION},
ranked AS (SELECT *, {_RANKED} AS k FROM pieces)
SELECT {_pick_sql(list(_TEXTS), 'doc_id', 'chunk_index')} || chr(10) || chr(10) || chunk AS instruction, chunk AS response,
  {_pick_sql(list(_TASKS), 'doc_id', 'chunk_index')} AS task_type, doc_id::VARCHAR AS source_doc_id FROM ranked WHERE k <= 3""")
def instruction_pairs(spark, sf_dir):
    return generation.instruction_pairs(texts(spark, sf_dir)).select("instruction", "response", "task_type", "source_doc_id")


@query(f"""SELECT replace({_pick_sql(generation.DEFINITIONS, 'term')}, '{{term}}', term) AS instruction,
  '[Definition of ''' || term || ''' — to be generated by LLM or domain expert]' AS response, 'definition' AS task_type
FROM (SELECT DISTINCT source AS term FROM documents)""")
def term_definitions(spark, sf_dir):
    names = docs(spark, sf_dir).select(F.col("source").alias("term")).distinct()
    return generation.term_definitions(names).select("instruction", "response", "task_type")


# --- mixing and packing --------------------------------------------------------------------------------------------
@query("""
WITH n AS (SELECT count(*) FILTER (lang = 'en') AS d, count(*) FILTER (lang <> 'en') AS g FROM documents),
t AS (SELECT least(trunc(trunc(d / (0.8::DOUBLE / (0.8::DOUBLE + 0.2::DOUBLE))) * (0.8::DOUBLE / (0.8::DOUBLE + 0.2::DOUBLE)))::BIGINT, d) AS td,
  least(trunc(trunc(d / (0.8::DOUBLE / (0.8::DOUBLE + 0.2::DOUBLE))) * (0.2::DOUBLE / (0.8::DOUBLE + 0.2::DOUBLE)))::BIGINT, g) AS tg FROM n),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang = 'en' ORDER BY md5('42|' || doc_id), doc_id) AS k FROM documents)
SELECT doc_id, lang FROM r, t WHERE k <= CASE WHEN lang = 'en' THEN td ELSE tg END""")
def mix_80_20(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    return mixing.mix_datasets(rows.where("lang = 'en'"), rows.where("lang <> 'en'"))


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS k FROM documents WHERE lang = 'en') WHERE k <= 50")
def mix_domain_only(spark, sf_dir):
    return mixing.mix_datasets(docs(spark, sf_dir).select("doc_id", "lang").where("lang = 'en'"), max_samples=50)


_SIZES = """
sizes AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) AS k, least(octet_length(encode(text)), 2048) AS n FROM conversations)"""


def _packed(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("ord", F.struct("conv_id", "turn"))
    return packing.tokenize(turns.select("ord", "text"), packing.ByteTokenizer(), 2048)


@query(f"""WITH RECURSIVE {_SIZES},
fit AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS sequence, 0::BIGINT AS used
  UNION ALL
  SELECT s.k, CASE WHEN used > 0 AND used + n + 1 > 2048 THEN sequence + 1 ELSE sequence END,
    CASE WHEN used > 0 AND used + n + 1 > 2048 THEN n + 1 ELSE used + n + 1 END
  FROM fit JOIN sizes s ON s.k = fit.k + 1)
SELECT sequence, count(*)::INT AS n_examples, max(used)::INT AS length FROM fit WHERE k > 0 GROUP BY sequence""")
def pack_next_fit(spark, sf_dir):
    packed = packing.pack(_packed(spark, sf_dir), 2048)
    return packed.select("sequence", "n_examples", F.size("input_ids").alias("length"))


@query(f"""WITH {_SIZES} SELECT count(*) AS total_examples, sum(n)::BIGINT AS total_tokens, count(*) FILTER (n = 2048) AS truncated,
  round(sum(n)::DOUBLE / count(*), 1) AS avg_tokens FROM sizes""")
def token_stats(spark, sf_dir):
    out = packing.token_stats(_packed(spark, sf_dir), 2048).drop("packed_sequences")
    return out.withColumn("avg_tokens", F.round("avg_tokens", 1))


# --- evaluation ----------------------------------------------------------------------------------------------------
_JUDGED = f"""WITH {_SCORE},
judged AS (
  SELECT d.doc_id, source, lang, quality AS label, CASE WHEN score >= 0.9::DOUBLE THEN 1 ELSE 0 END AS predicted,
    CASE WHEN length(d.text) >= 600 THEN 1 ELSE 0 END AS by_length
  FROM documents d JOIN labels USING (doc_id) JOIN scored s ON s.doc_id = d.doc_id)"""


def _judged(spark, sf_dir):
    rows = spread(docs(spark, sf_dir)).join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    predicted = (quality.quality_score(F.col("text")) >= 0.9).cast("int")
    rows = rows.select("doc_id", "source", "lang", "label", predicted.alias("predicted"), (F.length("text") >= 600).cast("int").alias("by_length"))
    return rows.withColumn("is_correct", F.col("label") == F.col("predicted"))


@query(f"{_JUDGED} SELECT count(*) AS num_examples, count(*) FILTER (label = predicted) AS num_correct, round(avg((label = predicted)::INT::DOUBLE), 6) AS accuracy FROM judged")
def accuracy(spark, sf_dir):
    return evaluation.accuracy(_judged(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


@query(f"""{_JUDGED} SELECT source, grouping(source) = 1 AS is_total, count(*) AS num_examples, count(*) FILTER (label = predicted) AS num_correct,
  round(avg((label = predicted)::INT::DOUBLE), 6) AS accuracy FROM judged GROUP BY ROLLUP (source)""")
def accuracy_by_source(spark, sf_dir):
    return evaluation.accuracy_by(_judged(spark, sf_dir), "source").withColumn("accuracy", F.round("accuracy", 6))


@query(f"""{_JUDGED},
votes AS (
  SELECT label AS l, (label = predicted)::INT AS tp, 0 AS fp, (label <> predicted)::INT AS fn FROM judged
  UNION ALL SELECT predicted, 0, 1, 0 FROM judged WHERE label <> predicted),
sums AS (SELECT l, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM votes GROUP BY l),
pr AS (SELECT CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS r FROM sums)
SELECT count(*) AS num_labels, round(avg(p), 6) AS "precision", round(avg(r), 6) AS recall, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1 FROM pr""")
def macro_f1(spark, sf_dir):
    out = evaluation.macro_f1(_judged(spark, sf_dir))
    return out.select("num_labels", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


_COMPARED = f"""{_JUDGED},
compared AS (
  SELECT source AS name, avg((label = predicted)::INT::DOUBLE) AS b, avg((label = by_length)::INT::DOUBLE) AS a FROM judged GROUP BY source),
results AS (SELECT name, a, b, a - b AS delta, greatest(0::DOUBLE, b - a) AS fall FROM compared)"""


def _compared(spark, sf_dir):
    rows = _judged(spark, sf_dir)
    one = lambda c: rows.groupBy(F.col("source").alias("name")).agg(F.avg((F.col("label") == F.col(c)).cast("double")).alias("score")).withColumn("ord", F.col("name"))
    return evaluation.compare_results(one("predicted"), one("by_length"))


@query(f"{_COMPARED} SELECT name, round(delta, 6) AS delta, round(fall, 6) AS \"drop\", fall <= 0.05::DOUBLE AS retained FROM results")
def retention_compare(spark, sf_dir):
    return _compared(spark, sf_dir).select("name", F.round("delta", 6).alias("delta"), F.round("drop", 6).alias("drop"), "retained")


@query(f"{_COMPARED} SELECT bool_and(fall <= 0.05::DOUBLE) AS all_retained, round(max(fall), 6) AS worst_drop, round(avg(delta), 6) AS average_delta FROM results")
def retention_summary(spark, sf_dir):
    out = evaluation.retention_summary(_compared(spark, sf_dir))
    return out.select("all_retained", F.round("worst_drop", 6).alias("worst_drop"), F.round("average_delta", 6).alias("average_delta"))


@query(f"""{_COMPARED} SELECT round(avg(b), 6) AS overall_domain_score, bool_and(b >= 0.7) AS all_benchmarks_passed FROM results""")
def report_rollup(spark, sf_dir):
    rows = _compared(spark, sf_dir).select(F.col("base_score").alias("score"), (F.col("base_score") >= 0.7).alias("passed"))
    return evaluation.report_summary(rows).withColumn("overall_domain_score", F.round("overall_domain_score", 6))


@query(f"""{_JUDGED} SELECT doc_id, source, round(avg((label = predicted)::INT::DOUBLE) OVER (PARTITION BY source ORDER BY doc_id), 6) AS running_accuracy FROM judged""")
def running_accuracy(spark, sf_dir):
    out = evaluation.running_accuracy(_judged(spark, sf_dir), "doc_id", "source")
    return out.select("doc_id", "source", F.round("running_accuracy", 6).alias("running_accuracy"))


@query(f"""{_JUDGED}, seen AS (
  SELECT source, doc_id, [{", ".join(f"struct_pack(tp := sum((label = {k} AND predicted = {k})::INT) OVER w, n := sum((label = {k})::INT + (predicted = {k})::INT) OVER w)" for k in (0, 1))}] AS parts
  FROM (SELECT source, doc_id, label::INT AS label, predicted::INT AS predicted FROM judged) WINDOW w AS (PARTITION BY source ORDER BY doc_id)),
kept AS (SELECT source, doc_id, list_filter(parts, lambda x: x.n > 0) AS parts FROM seen)
SELECT source, doc_id, round(list_sum(list_transform(parts, lambda x: 2.0::DOUBLE * x.tp / x.n)) / len(parts), 6) AS running_f1 FROM kept""")
def running_f1(spark, sf_dir):
    rows = _judged(spark, sf_dir).withColumns({c: F.col(c).cast("int") for c in ("label", "predicted")})
    return evaluation.running_macro_f1(rows, (0, 1), "doc_id", "source").select("source", "doc_id", F.round("running_f1", 6).alias("running_f1"))


@query("""
SELECT item_id, 'Question: ' || text || chr(10) || chr(10) || 'A. one' || chr(10) || 'B. two' || chr(10) || 'C. three' || chr(10) || 'D. four' || chr(10) || '4. five' || chr(10) || chr(10) || 'Answer:' AS prompt
FROM benchmark""")
def mcq_prompt(spark, sf_dir):
    choices = F.array(*map(F.lit, ("one", "two", "three", "four", "five")))
    return table(spark, sf_dir, "benchmark").select("item_id", inference.mcq_prompt(F.col("text"), choices).alias("prompt"))


@query(f"SELECT item_id, 'Classify the following contract clause into one of these categories: {', '.join(inference.CLAUSE_TYPES)}' || chr(10) || chr(10) || 'Clause: ' || text || chr(10) || chr(10) || 'Category:' AS prompt FROM benchmark")
def classification_prompt(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", inference.classification_prompt(F.col("text")).alias("prompt"))


@query("""
WITH s AS (SELECT item_id, [length(text) % 7, length(text) % 5, length(text) % 3]::DOUBLE[] AS scores FROM benchmark)
SELECT item_id, list_position(scores, list_max(scores)) - 1 AS best FROM s""")
def argmax_choice(spark, sf_dir):
    n = F.length("text")
    scores = F.array(*[(n % k).cast("double") for k in (7, 5, 3)])
    return table(spark, sf_dir, "benchmark").select("item_id", inference.first_greatest(scores).alias("best"))


#: Replies to parse, by document in turn.
REPLIES = ("Termination.", "This is a limitation of liability clause", "gover", "It limits limitation_of_liability and assignment", "", "none of these", "INDE")
_REPLY_SQL = f"[{', '.join(map(_quote, REPLIES))}][(doc_id % {len(REPLIES)} + 1)::INT]"


@query(f"""
WITH s AS (SELECT doc_id, {_strip(f"lower({_REPLY_SQL})")} AS said FROM documents),
w AS (SELECT *, coalesce({_words("said")}[1], '') AS first_word FROM s)
SELECT doc_id, CASE WHEN said = '' THEN 'unknown'
  {" ".join(f"WHEN contains(said, '{x}') THEN '{x}'" for x in inference.CLAUSE_TYPES)}
  {" ".join(f"WHEN contains(said, '{x.replace('_', ' ')}') THEN '{x}'" for x in inference.CLAUSE_TYPES)}
  {" ".join(f"WHEN starts_with(first_word, '{x[:4]}') THEN '{x}'" for x in inference.CLAUSE_TYPES)} ELSE 'unknown' END AS label FROM w""")
def clause_parse(spark, sf_dir):
    reply = F.element_at(F.array(*map(F.lit, REPLIES)), (F.col("doc_id") % len(REPLIES) + 1).cast("int"))
    return docs(spark, sf_dir).select("doc_id", inference.parse_label(reply).alias("label"))


# --- sources and sinks: written to the shared folder and read again --------------------------------------------------
def _written(spark, rows: DataFrame) -> str:
    path = scratch_path(spark)
    sinks.write_jsonl(rows, path)
    return path


def _documents_file(spark, sf_dir) -> str:
    rows = docs(spark, sf_dir).select("text", F.col("doc_id").cast("string").alias("doc_id"), F.create_map(F.lit("category"), F.col("source")).alias("metadata"), "lang")
    return _written(spark, rows)


@query("SELECT doc_id::VARCHAR AS doc_id, md5(coalesce(text, '')) AS digest, 'mine' AS source, source AS category, lang FROM documents")
def jsonl_documents(spark, sf_dir):
    out = readers.read_jsonl_documents(spark, _documents_file(spark, sf_dir), "mine")
    of = lambda k: F.try_element_at("metadata", F.lit(k)).alias(k)
    return out.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "source", of("category"), of("lang"))


@query("SELECT 0 AS src, doc_id::VARCHAR AS doc_id FROM documents WHERE source IN ('src1', 'src3') UNION ALL SELECT 2, doc_id::VARCHAR FROM documents WHERE source IN ('src1', 'src3')")
def configured_sources(spark, sf_dir):
    path = _documents_file(spark, sf_dir)
    sources = [{"type": "local", "path": path, "name": "one"}, {"type": "other", "path": path}, {"type": "jsonl", "path": path, "name": "two"}]
    return readers.read_sources(spark, sources, categories=["src1", "src3"]).select("src", "doc_id")


@query("SELECT md5(text) AS digest, lang, 'mirror' AS source FROM documents WHERE doc_id % 2 = 0 AND text <> ''")
def hosted_split(spark, sf_dir):
    path = scratch_path(spark)
    for k, split in enumerate(("train", "test")):
        docs(spark, sf_dir).where(F.col("doc_id") % 2 == k).write.parquet(f"{path}/{split}")
    out = readers.read_hosted(spark, path, "mirror", split="train")
    return out.select(F.md5(F.col("text").cast("binary")).alias("digest"), F.try_element_at("metadata", F.lit("lang")).alias("lang"), "source")


@query("SELECT count(*) AS documents, sum(length(text))::BIGINT AS total_characters FROM documents")
def corpus_written(spark, sf_dir):
    seen = sinks.write_corpus(docs(spark, sf_dir).select("text", "doc_id", "source"), scratch_path(spark))
    return spark.createDataFrame([(seen["documents"], seen["total_characters"])], "documents long, total_characters long")


@query("SELECT 'What is ' || item_id || '?' AS question, text AS answer, item_id::VARCHAR AS source_doc_id, 'qa' AS category, 1.0::DOUBLE AS quality_score FROM benchmark")
def qa_file(spark, sf_dir):
    ask = F.concat(F.lit("What is "), F.col("item_id").cast("string"), F.lit("?"))
    path = scratch_path(spark)
    sinks.write_pairs(table(spark, sf_dir, "benchmark").select(ask.alias("question"), F.col("text").alias("answer"), F.col("item_id").cast("string").alias("source_doc_id")), path, "raw")
    return readers.read_qa_pairs(spark, path).select("question", "answer", "source_doc_id", "category", "quality_score")


@query("SELECT 'What is ' || item_id || '?' AS asked, text AS reply FROM benchmark")
def chat_file(spark, sf_dir):
    ask = F.concat(F.lit("What is "), F.col("item_id").cast("string"), F.lit("?"))
    path = scratch_path(spark)
    sinks.write_pairs(table(spark, sf_dir, "benchmark").select(ask.alias("instruction"), F.col("text").alias("response")), path)
    said = lambda k, name: F.element_at("messages", k)["content"].alias(name)
    return readers.read_examples(spark, path).select(said(-2, "asked"), said(-1, "reply"))


@query("SELECT text, lang AS label, source AS context FROM documents WHERE text IS NOT NULL")
def clause_file(spark, sf_dir):
    rows = docs(spark, sf_dir).where("text IS NOT NULL").select("text", F.col("lang").alias("label"), F.col("source").alias("context"))
    return readers.read_clauses(spark, _written(spark, rows)).select("text", "label", "context")


@query("SELECT text AS prompt, item_id::VARCHAR AS expected FROM benchmark")
def prompt_file(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select(F.col("text").alias("prompt"), F.array(F.col("item_id").cast("string")).alias("expected_terms"))
    return readers.read_prompts(spark, _written(spark, rows)).select("prompt", F.get("expected_terms", F.lit(0)).alias("expected"))


@query("SELECT source AS name, count(*)::DOUBLE AS score, 'accuracy' AS metric, count(*) AS num_examples FROM documents WHERE source IS NOT NULL GROUP BY source")
def report_file(spark, sf_dir):
    rows = docs(spark, sf_dir).where("source IS NOT NULL").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n")).collect()
    path = scratch_path(spark)
    sinks.write_json(spark, {"benchmarks": [{"name": r["name"], "score": float(r["n"]), "num_examples": r["n"]} for r in rows]}, path)
    return readers.read_baseline(spark, path).select("name", "score", "metric", "num_examples")


# --- model-backed operators, with a model that SQL can state ---------------------------------------------------------
class ShortestScorer:
    """Prefers the shortest continuation; answers a classification prompt with its clause."""

    def generate(self, prompts: list[str], max_new_tokens: int = 128) -> list[str]:
        return [p.split("Clause: ", 1)[-1].removesuffix("\n\nCategory:") for p in prompts]

    def loglik(self, prompts: list[str], continuations: list[str]) -> list[float]:
        return [-float(len(c)) for c in continuations]


def _questions(spark, sf_dir) -> DataFrame:
    """Five choices, of which the one at ``item_id % 5`` is shortest; the right one is at ``item_id % 3``."""
    n = F.monotonically_increasing_id()
    rows = table(spark, sf_dir, "benchmark").select("text", F.length("text").alias("n"))
    choices = F.array(*[F.when(F.col("n") % 5 == k, F.lit("x")).otherwise(F.lit("longer")) for k in range(5)])
    rows = rows.select(n.alias("id"), F.col("text").alias("question"), choices.alias("choices"), (F.col("n") % 3).alias("answer"))
    return readers.read_questions(spark, _written(spark, rows))


@query("SELECT text AS question, (length(text) % 3)::INT AS correct_index, (length(text) % 5)::INT AS best, substr('ABCD4', (length(text) % 5 + 1)::INT, 1) AS predicted FROM benchmark")
def choice_scores(spark, sf_dir):
    return benchmarks.mcq_predictions(_questions(spark, sf_dir), ShortestScorer()).select("question", "correct_index", "best", "predicted")


_RIGHT = "count(*) FILTER (length(text) % 3 = length(text) % 5)"


@query(f"""SELECT 'bar_exam' AS name, 'accuracy' AS metric, round({_RIGHT}::DOUBLE / count(*), 6) AS score, count(*) AS num_examples, {_RIGHT} AS num_correct,
  0.7::DOUBLE AS passing_threshold, {_RIGHT}::DOUBLE / count(*) >= 0.7::DOUBLE AS passed FROM benchmark""")
def bar_exam(spark, sf_dir):
    return benchmarks.bar_exam(_questions(spark, sf_dir), ShortestScorer()).withColumn("score", F.round("score", 6))


@query(f"SELECT length(text)::INT % 4 AS subset, count(*) AS num_examples, {_RIGHT} AS num_correct FROM benchmark GROUP BY 1")
def knowledge_subsets(spark, sf_dir):
    rows = _questions(spark, sf_dir).withColumn("subset", F.length("question") % 4)
    return benchmarks.general_knowledge(rows, ShortestScorer())[1].where("NOT is_total").select("subset", "num_examples", "num_correct")


_LABELS = f"[{', '.join(map(_quote, inference.CLAUSE_TYPES))}]"


@query(f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE {_LABELS}[(doc_id % 10 + 1)::INT] END AS predicted FROM documents")
def clause_predictions(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, inference.CLAUSE_TYPES)), (F.col("doc_id") % 10 + 1).cast("int"))
    rows = docs(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("zzz")).otherwise(F.translate(label, "_", " ")).alias("text"))
    return benchmarks.clause_predictions(rows, ShortestScorer()).select("doc_id", "predicted")


# --- streaming -------------------------------------------------------------------------------------------------------
@query(ORACLE_SQL["quality_filter"])
def quality_filter_stream(spark, sf_dir):
    """The corpus as a stream through the quality filter, until all of it is read."""
    path, schema = scratch_path(spark), docs(spark, sf_dir).schema
    docs(spark, sf_dir).write.parquet(f"{path}-in")  # a stream reads a folder, and the table may be one file
    stream = incremental.filtered_stream(spark.readStream.schema(schema).parquet(f"{path}-in"))
    stream.writeStream.option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).select(*QUERIES["quality_filter"](spark, sf_dir).columns)
