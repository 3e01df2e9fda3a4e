"""Cleaning and tokenising comment text inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# English stop words, the same as the ML library's default list.
STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split())
# --- End of fixed values ----------------------------------------------------

# What whitespace means to a regular expression, for trims.
BLANKS = " \t\n\u000b\f\r"

# Other white space of Unicode, separators of files and records included.
WIDE_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in BLANKS)

LINK = r"http\S+"
# What is no letter, blanks included: a run of it becomes one space.
NOT_LETTERS = r"[^a-z]+"


def clean_text(text: Column) -> Column:
    """Lower-case, drop links, keep letters only, single spaces, no outer spaces.

    NULL stays NULL.
    """
    return F.trim(F.regexp_replace(
        F.regexp_replace(F.lower(text), LINK, ""), NOT_LETTERS, " "))


def has_letters(text: Column) -> Column:
    """Is there anything left after cleaning? Stops at the first letter outside
    a link, so it is far cheaper than cleaning and comparing with ''."""
    return F.lower(text).rlike(r"^(?:http\S++|[^a-z])*+[a-z]")


def strip_blanks(text: Column) -> Column:
    """Without the blanks of any script at both ends."""
    return F.btrim(text, F.lit(BLANKS + WIDE_BLANKS))


def tokenize_whitespace(text: Column) -> Column:
    """Lower-case and cut at every whitespace character.

    Inner empty tokens stay and trailing ones go, as in the ML ``Tokenizer``:
    ``''`` gives one empty token, whitespace alone gives none.
    """
    tail_cut = F.rtrim(F.lower(text), F.lit(BLANKS))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(tail_cut == "", F.array().cast("array<string>"))
        .otherwise(F.split(tail_cut, r"\s"))
    )


def tokenize_regex(text: Column) -> Column:
    """Lower-case, cut at non-word characters, no empty tokens."""
    return F.filter(F.split(F.lower(text), r"\W"), lambda t: t != "")


def clean_tokens(cleaned: Column) -> Column:
    """Tokens of text that :func:`clean_text` made: cut at its single spaces."""
    return F.filter(F.split(cleaned, " "), lambda t: t != "")




def remove_stopwords(tokens: Column, words: Sequence[str] | None = None) -> Column:
    """Drop stop words, keep order and repeats. Tokens must be lower-case.

    ``isin`` over a literal list becomes one hash-set probe per token.
    """
    stop = list(words if words is not None else STOP_WORDS)
    return F.filter(tokens, lambda t: ~t.isin(stop))


def model_tokens(text: Column) -> Column:
    """Raw comment to the words the models see."""
    return remove_stopwords(clean_tokens(clean_text(text)))


def raw_words(text: Column) -> Column:
    """Distinct lower-case words of the uncleaned text, for lexicon look-ups.

    Letters of all scripts belong to words: "dické" does not hold "dick".
    """
    return F.array_distinct(F.filter(F.split(F.lower(text), r"(?U)\W+"), lambda t: t != ""))
