"""Chat-format examples from documents, and their text form for supervised tuning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.chunking import Chunker, chat_chunker, chunk

#: System prompts by domain.
SYSTEM_PROMPTS = {
    "legal": (
        "You are a legal assistant with expertise in contract analysis, case law, and legal reasoning. "
        "Provide accurate, well-cited legal analysis. Always note that your responses are for informational "
        "purposes only and do not constitute legal advice."
    ),
    "medical": (
        "You are a medical knowledge assistant with expertise in clinical medicine. Provide accurate, "
        "evidence-based medical information. Always recommend consulting a healthcare professional for medical decisions."
    ),
    "financial": (
        "You are a financial analysis assistant with expertise in financial markets, accounting, and investment "
        "analysis. Provide accurate financial information. Note that your responses do not constitute financial advice."
    ),
    "scientific": (
        "You are a scientific research assistant with expertise in academic literature. Provide accurate, "
        "well-cited scientific information."
    ),
}
CONTINUE = "Continue the following text:"
MESSAGES = "array<struct<role:string,content:string>>"
ROLE_LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}


def system_prompt(domain: str, custom: str | None = None) -> str:
    """The custom prompt if one is given (an empty one means none), else the domain's, if it has one."""
    return SYSTEM_PROMPTS.get(domain, "") if custom is None else custom


def messages(user: Column, assistant: Column, system: str = "") -> Column:
    """system (if not empty), user and assistant messages."""
    said = [F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in (("user", user), ("assistant", assistant))]
    if system:
        said.insert(0, F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")))
    return F.array(*said).cast(MESSAGES)


def _piece_id(doc_id: Column) -> Column:
    many = F.concat(doc_id.cast("string"), F.lit(":chunk_"), F.col("chunk_index").cast("string"))
    return F.when(F.col("n_chunks") > 1, many).otherwise(doc_id.cast("string"))


def question(domain: str, title: Column, category: Column) -> Column:
    """What to ask about a document from its title and category; missing ones are null or empty."""
    category = F.coalesce(category, F.lit(""))
    titled = F.concat(F.lit("Explain the following "), category, F.lit(" document: "), title)
    return (
        F.when(F.coalesce(title, F.lit("")) != "", titled)
        .when(category != "", F.concat(F.lit("Provide analysis of this "), category, F.lit(" document.")))
        .otherwise(F.lit(f"Analyze the following {domain} document."))
    )


def format_chat(docs: DataFrame, mode: str = "completion", domain: str = "legal", custom_prompt: str | None = None, chunker: Chunker | None = None, id_col: str = "doc_id", text_col: str = "text", title_col: str | None = None, category_col: str | None = None) -> DataFrame:
    """(doc_id, messages, chunk_index, n_chunks) by piece. ``qa`` asks about the document, any other mode continues it.

    For ``qa``, a category that is null falls back to the column ``type`` if there is one.
    """
    prompt = system_prompt(domain, custom_prompt)
    cut = chunk(docs, chunker or chat_chunker(), text_col)
    ask = F.lit(CONTINUE)
    if mode == "qa":
        none = F.lit(None).cast("string")
        kind = F.col(category_col) if category_col else none
        kind = F.coalesce(kind, F.col("type")) if "type" in docs.columns and category_col != "type" else kind
        ask = question(domain, F.col(title_col) if title_col else none, kind)
        part = F.concat(F.lit(" (continued, part "), (F.col("chunk_index") + 1).cast("string"), F.lit(")"))
        ask = F.when(F.col("chunk_index") == 0, ask).otherwise(F.concat(ask, part))
    return cut.select(_piece_id(F.col(id_col)).alias("doc_id"), messages(ask, F.col("chunk"), prompt).alias("messages"), "chunk_index", "n_chunks")


def conversations_to_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row a conversation with its messages in turn order."""
    said = F.array_sort(F.collect_list(F.struct(turn_col, F.col("role"), F.col("text").alias("content"))))
    grouped = turns.groupBy(conv_col).agg(said.alias("_said"))
    return grouped.select(conv_col, F.transform("_said", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def render_for_sft(examples: DataFrame, column: str = "messages") -> DataFrame:
    """Adds ``text``: labelled lines of system, user and assistant messages, others left out; drops what training ignores."""
    label = F.create_map(*[F.lit(x) for pair in ROLE_LABELS.items() for x in pair])
    known = F.filter(column, lambda m: m["role"].isin(*ROLE_LABELS))
    lines = F.transform(known, lambda m: F.concat(F.element_at(label, m["role"]), F.lit(": "), m["content"], F.lit("\n")))
    return examples.withColumn("text", F.array_join(lines, "")).drop("messages", "metadata", "doc_id")
