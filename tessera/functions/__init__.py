"""Column-expression building blocks shared by the operators."""

from tessera.functions.expr import (
    WHITESPACE_JAVA,
    WHITESPACE_RE2,
    array_dot,
    hash_bucket,
    hash_unit,
    letter_words,
    letters_only,
    logistic_loss_expr,
    split_words,
)

__all__ = [
    "WHITESPACE_JAVA",
    "WHITESPACE_RE2",
    "array_dot",
    "hash_bucket",
    "hash_unit",
    "letter_words",
    "letters_only",
    "logistic_loss_expr",
    "split_words",
]
