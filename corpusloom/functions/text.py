"""Text columns: cleaning, token estimates, keywords, snippets, paths. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.split() and Unicode-aware \\s take for white space.
SPACE = r"[\s\x1c-\x1f\x85   -     　]"

STOPWORDS = frozenset(
    """able about all also and any are been but can could did does done each ever for from had has have her hers his how into it's its just many more
    most much not only onto our ours over per should some such than that the their them then there they this under very was were what when where which
    who whom will with would you you're your youre""".split()
)

#: Sections and phrases of link lists.
NAVIGATION_SECTIONS = ("bibliography", "citations", "external links", "further reading", "notes", "reference", "references", "see also", "sources", "works cited")
NAVIGATION_PHRASES = (
    "all articles", "articles needing", "articles with", "bnf data", "category portal", "commons category", "cs1", "cs1:", "gnd", "lists of", "pages using", "portal", "short description", "use dmy dates",
    "use mdy dates", "wikidata", "wikipedia articles",
)


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


clean_text = squeeze


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda x: x != "")


def token_estimate(text: Column) -> Column:
    """Words between white space, at least one."""
    return F.greatest(F.lit(1), F.size(words(text))).cast("bigint")


def keywords(text: Column, min_length: int = 4) -> Column:
    """Keywords of a text, in order, repeats kept: words of letters, quotes and hyphens, stripped, long enough, no stop word."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[A-Za-z][A-Za-z'\-]{2,}"), F.lit(0))
    bare = F.transform(found, lambda x: F.regexp_replace(x, r"^['\-]+|['\-]+$", ""))
    return F.filter(bare, lambda x: (F.length(x) >= min_length) & ~x.isin(sorted(STOPWORDS)))


def query_tokens(query: Column) -> Column:
    """Distinct lower-case tokens of three bytes or more, cut at everything not alphanumeric."""
    parts = F.split(query, r"(?U)[^\p{IsAlphabetic}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(parts, lambda x: F.octet_length(x) >= 3), lambda x: F.lower(x)))


def keyword_overlap(tokens: Column, text: Column) -> Column:
    """The share of tokens that stand somewhere in the text; 0 without tokens."""
    lower = F.lower(text)
    n = F.size(tokens)
    return F.when(n > 0, F.size(F.filter(tokens, lambda t: F.contains(lower, t))) / n).otherwise(F.lit(0.0))


def snippet(text: Column, limit: int = 200) -> Column:
    """The text if it has limit bytes or less, else its first limit characters and an ellipsis."""
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit), F.lit("…")))


def section_path(titles: Column) -> Column:
    """Titles joined by " > ", blanks left out; null if none is left."""
    kept = F.filter(titles, lambda x: F.length(F.trim(x)) > 0)
    joined = F.array_join(kept, " > ")
    return F.when(joined != "", joined)


def section_label(titles: Column) -> Column:
    """Section path for display: "(none)" where there is none."""
    return F.when(F.size(titles) > 0, F.array_join(titles, " > ")).otherwise(F.lit("(none)"))


def detect_url(url: Column, metadata_url: Column) -> Column:
    return F.coalesce(url, metadata_url)


def normalize_keywords(values: Iterable[str]) -> tuple[str, ...]:
    return tuple(sorted({v.strip().lower() for v in values if v.strip()}))


def looks_like_navigation(text: Column, path: Column) -> Column:
    """A link list rather than prose, by its section, by two phrases of such boxes, or by mostly upper-case words."""
    leaf = F.lower(F.trim(F.element_at(F.split(path, ">"), -1)))
    lower = F.lower(text)
    hits = F.when(text.rlike(r"(?i)\bv\s*t\s*e\b"), 1).otherwise(0)
    for p in NAVIGATION_PHRASES:
        hits = hits + F.when(lower.contains(p), 1).otherwise(0)
    tokens = F.regexp_extract_all(text, F.lit(r"[A-Za-z][A-Za-z\-']+"), F.lit(0))
    loud = F.filter(tokens, lambda t: (F.length(t) > 2) & (t == F.upper(t)))
    n = F.size(tokens)
    shouting = (n >= 8) & (F.size(loud) / F.greatest(n, F.lit(1)) >= 0.55)
    return F.coalesce(leaf.isin(list(NAVIGATION_SECTIONS)), F.lit(False)) | (hits >= 2) | shouting


def rejection(text: Column, min_chars: int, max_chars: int, include_keywords: Iterable[str] = ()) -> Column:
    """Why a cleaned sample is left out, null if it is not; max_chars 0 is no bound."""
    wanted = normalize_keywords(include_keywords)
    reason = F.when(F.length(text) < min_chars, "below min_chars")
    if max_chars:
        reason = reason.when(F.length(text) > max_chars, "above max_chars")
    if wanted:
        lower, hit = F.lower(text), F.lit(False)
        for w in wanted:
            hit |= lower.contains(w)
        reason = reason.when(~hit, "missing include_keyword")
    return reason


def header(headers: Column, name: str) -> Column:
    """A header of a map of them, whatever the case of its name: trimmed, null where it is blank or missing."""
    value = F.trim(F.element_at(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name.lower())), 1))
    return F.when(F.size(F.map_filter(headers, lambda k, _: F.lower(k) == name.lower())) > 0, F.when(value != "", value))


_EPOCH = "1970-01-01 00:00:00"


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a time without zone, taken as UTC whatever the session's zone; parts of one are cut off."""
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def from_epoch_ms(ms: Column) -> Column:
    """The time without zone, in UTC, of milliseconds since 1970."""
    return F.timestamp_add("MILLISECOND", ms, F.lit(_EPOCH).cast("timestamp_ntz"))


def crc32(body: Column) -> Column:
    """Checksum of the raw bytes."""
    return F.crc32(body.cast("binary"))
