"""Text column helpers: whitespace tokenisation, token cleaning, tagged tokens, keyword match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class written out so Spark (Java regex) and SQL engines (RE2) agree.
WS = "[ \t\n\r\f]+"

# Spark's default English stop-word list
# (pyspark.ml.feature.StopWordsRemover.loadDefaultStopWords("english")), kept as text so
# the SQL oracles can inline it; a test checks it still equals the library's list.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if "
    "or because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't "
    "couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's would"
).split()


def split_ws(text: Column) -> Column:
    """Tokens separated by ASCII whitespace, empty tokens removed."""
    return F.filter(F.split(text, WS), lambda t: t != F.lit(""))


def review_tokens(text: Column, min_len: int = 3) -> Column:
    """Whitespace tokens of at least ``min_len`` characters, lower-cased."""
    return F.transform(F.filter(F.split(text, WS), lambda t: F.length(t) >= min_len), lambda t: F.lower(t))


def tagged_tokens(text: Column, tag_len: int = 2) -> Column:
    """From ``word/TAG`` tokens keep those with an alphabetic tag: ``lower(word)/tag[:tag_len]``."""
    toks = F.filter(split_ws(text), lambda t: t.rlike("^[^/]+/[A-Za-z]+$"))
    return F.transform(
        toks,
        lambda t: F.concat(
            F.lower(F.substring_index(t, "/", 1)), F.lit("/"), F.substring(F.substring_index(t, "/", -1), 1, tag_len)
        ),
    )


def keyword_pattern(terms: list[str]) -> str:
    """Lower-case whole-word alternation with explicit ASCII-letter boundaries."""
    alt = "|".join(sorted(terms))
    return f"(^|[^a-z])({alt})([^a-z]|$)"


def matches_any(text: Column, terms: list[str]) -> Column:
    return F.lower(text).rlike(keyword_pattern(terms))
