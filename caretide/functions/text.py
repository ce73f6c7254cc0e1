"""Text expressions. All run inside the JVM; none needs a Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caretide.functions.columns import as_col

# The default term lists, in reporting order.
NEWS_KEYWORDS = (
    "flu", "influenza", "covid", "coronavirus", "rsv",
    "outbreak", "emergency", "hospitalization", "respiratory",
    "epidemic", "pandemic", "vaccine", "infection",
)
SHORT_POST_KEYWORDS = (
    "flu", "fever", "cough", "sick", "symptoms", "hospital",
    "doctor", "emergency", "pain", "covid", "test", "positive",
)
SYMPTOMS = (
    "fever", "cough", "shortness of breath", "chest pain",
    "nausea", "vomiting", "headache", "fatigue", "sore throat",
    "body aches", "chills", "dizziness", "congestion",
    "difficulty breathing", "stomach pain", "diarrhea",
)
HEALTH_WORDS = ("sick", "pain", "doctor", "hospital", "symptoms", "health")
CATEGORY_RULES = (
    ("Outbreak", ("outbreak", "epidemic", "surge")),
    ("Vaccination", ("vaccine", "vaccination", "immunization")),
    ("Alert", ("advisory", "alert", "warning")),
    ("Respiratory Illness", ("flu", "influenza", "respiratory")),
)
DEFAULT_CATEGORY = "General Health"

# Character classes that mean the same in Java, RE2 and Python's Unicode mode.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
URL_PATTERN = rf"(?:http|www)[^{SPACE}]+"


def strip(c: Column | str) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.regexp_replace(as_col(c), rf"^[{SPACE}]+|[{SPACE}]+$", "")


def collapse_spaces(c: Column | str) -> Column:
    """Runs of whitespace become one space; the ends are stripped."""
    return strip(F.regexp_replace(as_col(c), rf"[{SPACE}]+", " "))


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    """True if the lowercased text contains any word; null text gives False."""
    low = F.lower(as_col(c))
    found = F.lit(False)
    for word in words:
        found = found | low.contains(word)
    return F.coalesce(found, F.lit(False))


def extract_keywords(c: Column | str, words: Sequence[str] = NEWS_KEYWORDS) -> Column:
    """Words found as substrings, in list order, joined by ``', '``; else ``'none'``."""
    low = F.lower(as_col(c))
    joined = F.concat_ws(", ", *[F.when(low.contains(w), F.lit(w)) for w in words])
    return F.when(joined == "", F.lit("none")).otherwise(joined)


def keyword_array(c: Column | str, words: Sequence[str] = NEWS_KEYWORDS) -> Column:
    """The same words as an array (empty if none is found)."""
    low = F.lower(as_col(c))
    return F.array_compact(F.array(*[F.when(low.contains(w), F.lit(w)) for w in words]))


def categorize(
    c: Column | str,
    rules: Sequence[tuple[str, Sequence[str]]] = CATEGORY_RULES,
    default: str = DEFAULT_CATEGORY,
) -> Column:
    """Name of the first rule with a word in the text, else ``default``."""
    (name, words), *rest = rules
    chain = F.when(contains_any(c, words), F.lit(name))
    for name, words in rest:
        chain = chain.when(contains_any(c, words), F.lit(name))
    return chain.otherwise(F.lit(default))


def clean_post_text(c: Column | str) -> Column:
    """Drop links, keep word characters and apostrophes, collapse whitespace."""
    no_links = F.regexp_replace(as_col(c), URL_PATTERN, "")
    return collapse_spaces(F.regexp_replace(no_links, rf"[^{WORD}{SPACE}']", " "))


def clean_short_text(c: Column | str) -> Column:
    """Drop links and @names, keep hashtag words, keep word characters only."""
    out = F.regexp_replace(as_col(c), URL_PATTERN, "")
    out = F.regexp_replace(out, rf"@[{WORD}]+", "")
    out = F.regexp_replace(out, rf"#([{WORD}]+)", "$1")
    return collapse_spaces(F.regexp_replace(out, rf"[^{WORD}{SPACE}]", " "))


def is_health_related(c: Column | str, words: Sequence[str] = HEALTH_WORDS) -> Column:
    return contains_any(c, words)


def truncate(c: Column | str, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(as_col(c), 1, n)


def absolute_url(c: Column | str, base: str) -> Column:
    """Prefix ``base`` unless the link already starts with ``http``."""
    link = as_col(c)
    return F.when(link.startswith("http"), link).otherwise(F.concat(F.lit(base), link))
