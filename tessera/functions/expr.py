"""Built-in Spark column expressions used across the operator families.

Everything here is a composition of ``pyspark.sql.functions`` so it stays inside
whole-stage code generation; there is no Python UDF anywhere in tessera.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The set of characters that Python's str.split() treats as
# whitespace, which the tokenizer must reproduce.  Java's \s covers only ASCII
# space, \t \n \x0B \f \r; \p{Z} adds the Unicode space and separator classes
# (U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000);
# the information separators \x1c..\x1f and NEL \x85 are added by hand.
WHITESPACE_JAVA = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]+"
# The same class in RE2 syntax (DuckDB); RE2's \s lacks \x0b.
WHITESPACE_RE2 = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]+"
# A letter is any code point of Unicode category L (Lu, Ll, Lt, Lm, Lo), the
# same set Python's str.isalpha() accepts.
NON_LETTER = r"[^\p{L}]"
# What is neither a letter nor white space: the union of both classes, negated.
NO_PART_OF_WORDS = r"[^\p{L}\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


def split_words(text: Column) -> Column:
    """lower-case, then split on whitespace -> ARRAY<STRING>."""
    return F.split(F.lower(text), WHITESPACE_JAVA)


def letter_words(text: Column) -> Column:
    """lower-case, split on whitespace, strip non-letters, drop empties -> ARRAY<STRING>.

    The text is stripped as a whole, so that no pattern runs word by word.
    """
    return F.filter(F.split(F.regexp_replace(F.lower(text), NO_PART_OF_WORDS, ""), WHITESPACE_JAVA), lambda w: w != "")


def letters_only(token: Column) -> Column:
    """Delete every non-letter code point from a token."""
    return F.regexp_replace(token, NON_LETTER, "")


def _hex8_to_long(s: Column) -> Column:
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, k: int) -> Column:
    """Deterministic bucket in [0, k) from the md5 of a string key.

    Unlike ``rand``/``randomSplit`` the result does not depend on partitioning,
    so a re-run (or a recomputed partition after an executor loss) gives the
    same rows, and another engine can compute the same split.
    """
    return (_hex8_to_long(key) % F.lit(k)).cast("int")


def hash_unit(key: Column) -> Column:
    """Deterministic pseudo-uniform value in (0, 1) from the md5 of a key."""
    return (_hex8_to_long(key) + F.lit(0.5)) / F.lit(float(2 ** 32))


def hash_normal(key: Column) -> Column:
    """Deterministic standard-normal value (Box-Muller on two md5 uniforms)."""
    u1 = hash_unit(F.concat(key, F.lit("#a")))
    u2 = hash_unit(F.concat(key, F.lit("#b")))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def array_dot(a: Column, b: Column) -> Column:
    """<a, b> for two equally long numeric arrays (higher-order functions)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, v: acc + v)


def logistic_loss_expr(margin: Column) -> Column:
    """log(1 + exp(-m)) in the overflow-free form max(-m, 0) + log1p(exp(-|m|))."""
    return F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
