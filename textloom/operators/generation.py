"""Template question-answer pairs, instruction pairs and term definitions from documents.

Choices are pseudo-random but depend only on (seed, document, passage), so they do not change with partitioning:
passages rank by the md5 of these, and templates are picked by another md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators.chat import messages
from textloom.operators.chunking import chunk, instruction_chunker, qa_chunker
from textloom.operators.inference import Scorer, generate

#: Question templates by domain.
QA_TEMPLATES = {
    "legal": [
        "What is the main legal principle discussed in the following passage?",
        "Summarize the key legal arguments presented in this text.",
        "What are the legal implications described in this passage?",
        "Identify the relevant legal standards referenced in this text.",
        "What legal reasoning is applied in the following passage?",
        "What obligations or duties are established in this text?",
        "Explain the jurisdictional considerations mentioned in this passage.",
        "What remedies or outcomes are discussed in this text?",
        "Identify any statutory references or case citations in this passage.",
        "What are the key contractual terms discussed in this text?",
    ],
    "medical": [
        "What medical condition or diagnosis is discussed in this passage?",
        "Summarize the treatment approach described in this text.",
        "What are the key clinical findings mentioned in this passage?",
        "Identify the relevant medical terminology in this text.",
        "What are the risk factors discussed in this passage?",
    ],
    "financial": [
        "What financial metrics are discussed in this passage?",
        "Summarize the investment thesis presented in this text.",
        "What market trends are described in this passage?",
        "Identify the key financial risks mentioned in this text.",
        "What regulatory considerations are discussed in this passage?",
    ],
}
#: Fixed values: (task, instruction) by domain; the passage follows after a blank line.
INSTRUCTIONS = {
    "legal": [
        ("summarize", "Summarize the following legal text in plain language."),
        ("summarize", "Provide a brief summary of this legal document."),
        ("summarize", "Write a concise summary of the key points in this legal passage."),
        ("analyze", "Analyze the legal implications of the following clause."),
        ("analyze", "What are the key legal issues raised in this passage?"),
        ("analyze", "Identify the legal rights and obligations described in this text."),
        ("explain", "Explain the following legal concept to a non-lawyer."),
        ("explain", "What does this legal provision mean in practical terms?"),
        ("classify", "Classify the following legal text into its relevant area of law."),
        ("classify", "What type of legal document is this? Explain your reasoning."),
        ("extract", "Extract the key legal terms and definitions from this text."),
        ("extract", "List the parties, obligations, and conditions described in this clause."),
        ("compare", "Compare the legal positions described in this passage and identify any conflicts."),
        ("draft", "Rewrite the following legal clause in simpler language while preserving its meaning."),
    ],
    "medical": [
        ("summarize", "Summarize the following clinical findings."),
        ("explain", "Explain this medical concept for a patient."),
        ("analyze", "What are the key diagnostic indicators in this passage?"),
        ("classify", "Classify the condition described in this text."),
    ],
    "financial": [
        ("summarize", "Summarize the key financial metrics from this report."),
        ("analyze", "Analyze the investment risks described in this passage."),
        ("explain", "Explain this financial concept in simple terms."),
        ("classify", "Classify the type of financial instrument described."),
    ],
}
#: Definition instructions.
DEFINITIONS = [
    "Define the legal term '{term}' and provide an example of its use.",
    "What does '{term}' mean in a legal context?",
    "Explain the concept of '{term}' as it applies in law.",
    "Provide a clear definition of '{term}' and explain when it typically arises.",
]
PROMPT_CHARS = 800


def instruction_templates(domain: str) -> list[tuple[str, str]]:
    return [(task, text + "\n\n{passage}") for task, text in INSTRUCTIONS.get(domain, INSTRUCTIONS["legal"])]


def has_enough_content(passage: Column, min_words: int = 30) -> Column:
    """At least ``min_words`` words, and letters make up over half of the characters."""
    return (tx.word_count(passage) >= min_words) & (tx.share_in(passage, r"\p{L}") > F.lit(0.5))


def _sampled(passages: DataFrame, k: int, seed: int) -> DataFrame:
    """At most ``k`` passages of each document, by hash rank."""
    rank = Window.partitionBy("source_doc_id").orderBy(tx.hash_rank(str(seed), F.col("source_doc_id"), F.col("chunk_index").cast("string")), "chunk_index")
    return passages.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k).drop("_rank")


def _passages(docs: DataFrame, chunker, min_doc_length: int, id_col: str, text_col: str) -> DataFrame:
    place = F.col("ord" if "ord" in docs.columns else id_col).alias("ord")
    rows = docs.where(F.length(text_col) >= min_doc_length).select(F.col(id_col).cast("string").alias("source_doc_id"), place, text_col)
    return chunk(rows, chunker, text_col).select("ord", "source_doc_id", "chunk_index", F.col("chunk").alias("passage"))


def qa_passages(docs: DataFrame, length: int = 1500, min_doc_length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return _passages(docs, qa_chunker(length), min_doc_length, id_col, text_col).where(has_enough_content(F.col("passage")))


def instruction_passages(docs: DataFrame, length: int = 1500, min_doc_length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return _passages(docs, instruction_chunker(length), min_doc_length, id_col, text_col)


def _pick(options: list[str], seed: int, *parts: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), tx.hash_pick(len(options), f"{seed}t", *parts) + 1)


def _limited(rows: DataFrame, limit: int | None, order: str = "chunk_index") -> DataFrame:
    """The first ``limit`` rows in document and passage order; 0 and None mean all."""
    return rows.orderBy("ord", order).limit(limit) if limit else rows


def qa_pairs(docs: DataFrame, domain: str = "legal", templates: list[str] | None = None, max_per_doc: int = 5, max_pairs: int | None = None, seed: int = 42, length: int = 1500, min_doc_length: int = 200, **columns) -> DataFrame:
    """(question, answer, source_doc_id, category, quality_score, metadata). Templates are used as they stand."""
    options = templates or QA_TEMPLATES.get(domain, QA_TEMPLATES["legal"])
    rows = _limited(_sampled(qa_passages(docs, length, min_doc_length, **columns), max_per_doc, seed), max_pairs)
    template = _pick(options, seed, F.col("source_doc_id"), F.col("chunk_index").cast("string"))
    rows = rows.withColumn("template", template)
    return rows.select(
        F.concat("template", F.lit("\n\nContext:\n"), "passage").alias("question"),
        F.col("passage").alias("answer"), "source_doc_id", F.lit("qa").alias("category"), F.lit(1.0).alias("quality_score"),
        F.create_map(F.lit("template"), "template", F.lit("domain"), F.lit(domain)).alias("metadata"),
    )


def _instructed(docs: DataFrame, domain: str, templates, max_per_doc: int, limit, seed: int, length: int, min_doc_length: int, **columns) -> DataFrame:
    options = templates or instruction_templates(domain)
    rows = _limited(_sampled(instruction_passages(docs, length, min_doc_length, **columns), max_per_doc, seed), limit)
    at = tx.hash_pick(len(options), f"{seed}t", F.col("source_doc_id"), F.col("chunk_index").cast("string")) + 1
    both = F.array(*[F.struct(F.lit(task).alias("task"), F.lit(text).alias("text")) for task, text in options])
    return rows.withColumn("t", F.element_at(both, at))


def _filled(template: Column, passage: Column) -> Column:
    return F.replace(F.replace(template, F.lit("{term}"), F.lit("")), F.lit("{passage}"), passage)


def instruction_pairs(docs: DataFrame, domain: str = "legal", templates: list[tuple[str, str]] | None = None, max_per_doc: int = 3, max_examples: int | None = None, seed: int = 42, length: int = 1500, min_doc_length: int = 200, **columns) -> DataFrame:
    """(instruction, response, task_type, source_doc_id, quality_score, metadata)."""
    rows = _instructed(docs, domain, templates, max_per_doc, max_examples, seed, length, min_doc_length, **columns)
    return rows.select(
        _filled(F.col("t.text"), F.col("passage")).alias("instruction"),
        F.col("passage").alias("response"), F.col("t.task").alias("task_type"), "source_doc_id", F.lit(1.0).alias("quality_score"),
        F.create_map(F.lit("domain"), F.lit(domain), F.lit("template_type"), F.col("t.task")).alias("metadata"),
    )


def _defined(terms: DataFrame, max_terms: int | None, seed: int) -> DataFrame:
    if max_terms:
        terms = terms.orderBy(tx.hash_rank(str(seed), F.col("term")), "term").limit(max_terms)
    template = _pick(DEFINITIONS, seed, F.col("term"))
    return terms.select("term", F.replace(template, F.lit("{term}"), F.col("term")).alias("instruction"))


def term_definitions(terms: DataFrame, domain: str = "legal", max_terms: int | None = None, seed: int = 42) -> DataFrame:
    """Instruction pairs that ask for definitions of ``term``; responses are placeholders."""
    blank = F.concat(F.lit("[Definition of '"), "term", F.lit("' — to be generated by LLM or domain expert]"))
    return _defined(terms, max_terms, seed).select(
        "instruction", blank.alias("response"), F.lit("definition").alias("task_type"), F.lit("").alias("source_doc_id"),
        F.lit(1.0).alias("quality_score"), F.create_map(F.lit("domain"), F.lit(domain), F.lit("term"), F.col("term")).alias("metadata"),
    )


def qa_pairs_with_model(docs: DataFrame, scorer: Scorer, domain: str = "legal", max_per_doc: int = 5, seed: int = 42, length: int = 1500, max_new_tokens: int = 256, **columns) -> DataFrame:
    """Questions written by a model about passages; answers of 10 characters or fewer are dropped. No minimum document."""
    rows = _sampled(qa_passages(docs, length, 0, **columns), max_per_doc, seed)
    prompt = F.concat(
        F.lit(f"You are an expert {domain} instructor. Read the following passage and generate a clear, specific question "
              "that can be answered using the information in the passage.\n\nPassage:\n"),
        F.substring("passage", 1, PROMPT_CHARS), F.lit("\n\nQuestion:"),
    )
    said = generate(rows.withColumn("prompt", prompt), scorer, max_new_tokens).where(F.length("generated") > 10)
    asked = tx.strip(F.col("generated"))
    return said.select(
        F.when(F.endswith(asked, F.lit("?")), asked).otherwise(F.concat(asked, F.lit("?"))).alias("question"),
        F.col("passage").alias("answer"), "source_doc_id", F.lit("qa_model_generated").alias("category"), F.lit(1.0).alias("quality_score"),
        F.create_map(F.lit("domain"), F.lit(domain), F.lit("generation_method"), F.lit("llm")).alias("metadata"),
    )


def instruction_pairs_with_model(docs: DataFrame, scorer: Scorer, domain: str = "legal", templates=None, max_per_doc: int = 3, seed: int = 42, length: int = 1500, min_doc_length: int = 200, max_new_tokens: int = 512, **columns) -> DataFrame:
    """Responses written by a model; ones of 20 characters or fewer are dropped."""
    rows = _instructed(docs, domain, templates, max_per_doc, None, seed, length, min_doc_length, **columns)
    rows = rows.withColumn("prompt", _filled(F.col("t.text"), F.substring("passage", 1, PROMPT_CHARS)))
    said = generate(rows, scorer, max_new_tokens).where(F.length("generated") > 20)
    return said.select(
        F.col("prompt").alias("instruction"), F.col("generated").alias("response"), F.col("t.task").alias("task_type"), "source_doc_id",
        F.lit(1.0).alias("quality_score"),
        F.create_map(F.lit("domain"), F.lit(domain), F.lit("template_type"), F.col("t.task"), F.lit("generation_method"), F.lit("llm")).alias("metadata"),
    )


def term_definitions_with_model(terms: DataFrame, scorer: Scorer, domain: str = "legal", max_terms: int | None = None, seed: int = 42, max_new_tokens: int = 256) -> DataFrame:
    """Definitions written by a model; ones of 20 characters or fewer are dropped."""
    rows = _defined(terms, max_terms, seed).withColumn("prompt", F.col("instruction"))
    said = generate(rows, scorer, max_new_tokens).where(F.length("generated") > 20)
    return said.select(
        "instruction", F.col("generated").alias("response"), F.lit("definition").alias("task_type"), F.lit("").alias("source_doc_id"),
        F.lit(1.0).alias("quality_score"),
        F.create_map(F.lit("domain"), F.lit(domain), F.lit("term"), F.col("term"), F.lit("generation_method"), F.lit("llm")).alias("metadata"),
    )


def to_chat(pairs: DataFrame, system: str = "") -> DataFrame:
    """``messages`` of question-answer or instruction-response pairs."""
    ask, reply = ("question", "answer") if "question" in pairs.columns else ("instruction", "response")
    return pairs.select(messages(F.col(ask), F.col(reply), system).alias("messages"))
