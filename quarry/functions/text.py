"""Text cleaning and tokenising as built-in Column expressions.

Python's ``\\w`` / ``\\s`` are Unicode-aware while Java's are ASCII-only, so the patterns spell the classes out:
word characters ``[\\p{L}\\p{N}_]``, white space ``[\\s\\p{Z}]``. No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\p{Z}]"
TOKEN_2PLUS = WORD + "{2,}"   # the vectorizer's default token pattern (2+ word characters)
TOKEN_1PLUS = WORD + "+"      # the 1+ character pattern used for short type names

# The English stop-word list the reference filters with (the classic NLTK list, 179 words),
# in its published order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn "
    "hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c) -> Column:
    """Lower-case, every character outside ``[a-z0-9]`` becomes ``_``."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "_")


def strip_mentions(c) -> Column:
    """Remove ``@name`` mentions."""
    return F.regexp_replace(_col(c), "@" + WORD + "+", "")


def strip_links(c) -> Column:
    """Remove ``http…`` and ``www…`` runs up to the next white space."""
    return F.regexp_replace(_col(c), f"http[^\\s\\p{{Z}}]+|www[^\\s\\p{{Z}}]+", "")


def keep_letters(c) -> Column:
    """T4: keep ASCII letters and white space only."""
    return F.regexp_replace(_col(c), r"[^a-zA-Z\s\p{Z}]", "")


def whitespace_tokens(c) -> Column:
    """T5: lower-case, trim, split on white space runs; never yields empty tokens."""
    return F.filter(F.split(F.lower(_col(c)), SPACE + "+"), lambda x: x != "")


def drop_stop_words(tokens, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, min_len: int = 3) -> Column:
    """Keep tokens longer than ``min_len - 1`` characters that are not stop words (order and
    repeats preserved, unlike ``array_except``)."""
    stop = sorted(set(stop_words))
    # ``isin`` over many literals becomes a hash-set lookup (InSet); array_contains would scan the list
    return F.filter(_col(tokens), lambda x: (F.length(x) >= min_len) & ~x.isin(stop))


def clean_tokens(c, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """T2→T6: mentions, links, non-letters removed, lower-cased tokens without stop/short words."""
    return drop_stop_words(whitespace_tokens(keep_letters(strip_links(strip_mentions(c)))), stop_words)


def clean_text(c, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """T8 (without stemming, see :mod:`quarry.operators.text` for T7): cleaned tokens joined by a space."""
    return F.array_join(clean_tokens(c, stop_words), " ")


def concat_space(*cols) -> Column:
    """``a + ' ' + b`` (fill nulls first: ``concat_ws`` skips nulls where ``+`` would give null)."""
    return F.concat_ws(" ", *[_col(c) for c in cols])


def file_stem(path) -> Column:
    """Lower-cased file name without its last extension."""
    return F.lower(F.regexp_extract(_col(path), r"([^/]+)\.[^./]*$", 1))


def word_tokens(c, pattern: str = TOKEN_2PLUS, lowercase: bool = True) -> Column:
    """All matches of a token pattern, in order."""
    src = F.lower(_col(c)) if lowercase else _col(c)
    return F.regexp_extract_all(src, F.lit(pattern), F.lit(0))


def bigrams(tokens) -> Column:
    """Adjacent token pairs joined by a space; empty for fewer than two tokens.

    Built with ``zip_with(tok, tok[2:])`` so the lambda body only sees its two elements: a token array
    referenced *inside* a lambda would be re-evaluated per element when Catalyst inlines the expression
    that produced it (quadratic in document length)."""
    tok = _col(tokens)
    n_pairs = F.greatest(F.size(tok) - 1, F.lit(0))
    pairs = F.zip_with(tok, F.slice(tok, F.lit(2), n_pairs), lambda a, b: F.concat_ws(" ", a, b))
    return F.slice(pairs, F.lit(1), n_pairs)


def with_bigrams(tokens) -> Column:
    """Unigrams followed by bigrams (``ngram_range=(1, 2)``)."""
    return F.concat(_col(tokens), bigrams(tokens))
