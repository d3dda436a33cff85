"""Column functions and fixed word lists for document-term matrices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard English stop list used by the reference's text
# package (174 words), in its published order.
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is "
    "are was were be been being have has had having do does did doing would should could ought i'm you're "
    "he's she's it's we're they're i've you've we've they've i'd you'd he'd she'd we'd they'd i'll you'll "
    "he'll she'll we'll they'll isn't aren't wasn't weren't hasn't haven't hadn't doesn't don't didn't won't "
    "wouldn't shan't shouldn't can't cannot couldn't mustn't let's that's who's what's here's there's when's "
    "where's why's how's a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some such no nor "
    "not only own same so than too very"
).split()
# The eight words the reference adds to the stop list.
EXTRA_STOPWORDS = ["will", "can", "also", "one", "two", "get", "use", "thing"]

PUNCT_CLASS = r"\p{Punct}"  # ASCII punctuation, like the POSIX [[:punct:]] class
DIGIT_CLASS = "[0-9]"


def lower(c: Column) -> Column:
    return F.lower(c)


def strip_punctuation(c: Column) -> Column:
    """Drop ASCII punctuation inside tokens: "don't" → "dont"."""
    return F.regexp_replace(c, PUNCT_CLASS, "")


def strip_digits(c: Column) -> Column:
    return F.regexp_replace(c, DIGIT_CLASS, "")


def collapse_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_text(c: Column) -> Column:
    """lower → punctuation → digits (the order of the control list)."""
    return strip_digits(strip_punctuation(lower(c)))
