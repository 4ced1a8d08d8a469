"""Text expressions: tokens, lemmas, intents, sentiment, hashed vectors. All run in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom import constants as K

TOKEN_PATTERN = r"[\p{L}\p{N}]+"
SENTENCE_PATTERN = r"[^.!?]+[.!?]*"


def strip(c: Column) -> Column:
    """Leading and trailing white space of any kind removed (``trim`` drops spaces only)."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+\z", "")


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


def drop_words(words: Column, stopwords: Sequence[str]) -> Column:
    """``words`` without ``stopwords``; the literal list becomes a hash-set test."""
    return F.filter(words, lambda w: ~w.isin(*stopwords))


def lemma(word: Column, irregular: Mapping[str, str] = K.IRREGULAR_LEMMAS) -> Column:
    """Base form by a table of irregular words and plural suffix rules.

    Deviation: a statistical lemmatiser also undoes regular verb and comparison endings.
    """
    n = F.length(word)
    regular = (
        F.when(word.endswith("ies") & (n > 4), F.concat(F.left(word, n - 3), F.lit("y")))
        .when(
            (n > 4)
            & (
                word.endswith("sses")
                | word.endswith("shes")
                | word.endswith("ches")
                | word.endswith("xes")
                | word.endswith("zes")
            ),
            F.left(word, n - 2),
        )
        .when(
            (n > 3)
            & word.endswith("s")
            & ~word.endswith("ss")
            & ~word.endswith("us")
            & ~word.endswith("is"),
            F.left(word, n - 1),
        )
        .otherwise(word)
    )
    if not irregular:
        return regular
    table = F.create_map(*[F.lit(x) for pair in irregular.items() for x in pair])
    return F.when(word.isin(*irregular), F.try_element_at(table, word)).otherwise(regular)


def sentences(c: Column) -> Column:
    """Sentences of a text, ended by ``.``, ``!`` or ``?``; line breaks count as spaces."""
    flat = F.translate(c, "\n\r\t", "   ")
    return F.regexp_extract_all(flat, F.lit(SENTENCE_PATTERN), F.lit(0))


def bucket(word: Column, size: int) -> Column:
    """Hash bucket of a word: the first 8 hex digits of its md5, modulo ``size``."""
    return (md5_number(word) % size).cast("int")


def md5_number(c: Column) -> Column:
    """The first 8 hex digits of an md5 as a number below 2**32; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("bigint")


def intent(c: Column) -> Column:
    """Intent by ordered word rules; a missing text is a general query."""
    low = F.lower(c)
    return (
        F.when(c.isNull(), "general_query")
        .when(low.contains("best"), "recommendation")
        .when(low.contains("review"), "review_search")
        .otherwise("product_info")
    )


def entities(c: Column) -> Column:
    """``["product"]`` where the word occurs, else an empty list."""
    found = F.coalesce(F.lower(c).contains("product"), F.lit(False))
    return F.when(found, F.array(F.lit("product"))).otherwise(
        F.array().cast("array<string>")
    )


def sentiment_from_counts(n_pos: Column, n_neg: Column, missing: Column) -> Column:
    """``struct(label, score)``: the winning side's share of all polarity words.

    Undecided or missing text is NEUTRAL 0.5.
    """
    neutral = missing | (n_pos == n_neg)
    label = (
        F.when(neutral, "NEUTRAL").when(n_pos > n_neg, "POSITIVE").otherwise("NEGATIVE")
    )
    share = F.greatest(n_pos, n_neg).cast("double") / (n_pos + n_neg)
    return F.struct(label.alias("label"), F.when(neutral, 0.5).otherwise(share).alias("score"))
