from corpusloom.functions.text import (
    array_digest,
    contains_text,
    sentence_count,
    strip,
    whitespace_tokens,
    word_tokens,
)

__all__ = [
    "array_digest",
    "contains_text",
    "sentence_count",
    "strip",
    "whitespace_tokens",
    "word_tokens",
]
