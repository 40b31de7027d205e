"""Text expressions: lengths, words, token windows, prompt assembly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters between words are Unicode's white space, which \s means under the U
# flag, and the four ASCII separators.
BETWEEN_WORDS = r"(?U)[\s\x1c-\x1f]+"
WORD = r"(?U)[^\s\x1c-\x1f]+"

PAD_TOKEN = "[PAD]"


def text_length(text: Column) -> Column:
    """Code points of the text; null counts 0."""
    return F.length(F.coalesce(text, F.lit("")))


def word_count(text: Column) -> Column:
    """White-space separated words; null counts 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))


def words(text: Column) -> Column:
    """The words themselves, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def token_window(tokens: Column, max_length: int) -> Column:
    """The first `max_length` tokens, filled up with the pad token."""
    return F.slice(F.concat(tokens, F.array_repeat(F.lit(PAD_TOKEN), max_length)), 1, max_length)


def attention_mask(tokens: Column, max_length: int) -> Column:
    """1 for a real token, 0 for padding."""
    used = F.least(F.size(tokens), F.lit(max_length))
    return F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(max_length) - used))


def context_block(hits: Column) -> Column:
    """Numbered passages in rank order; `hits` is an array of struct(rank, text)."""
    lines = F.transform(
        F.array_sort(hits),
        lambda hit: F.concat(F.lit("["), hit["rank"].cast("string"), F.lit("] "), hit["text"]),
    )
    return F.array_join(lines, "\n\n")


def prompt_text(context: Column, question: Column) -> Column:
    """The fixed prompt layout around a context and a question."""
    return F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question, F.lit("\nAnswer:"))
