"""Null tests and text cleaning, as column expressions."""

from pyspark.sql import functions as F

from harrow.functions.patterns import DEADLINE_WORDS, HTML_TAG, SPACE_CLASS, WHITESPACE, java
from harrow.schema import NA, NULL_LIKE, NULL_TOKENS


def let(value, use):
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def only_if(value, test):
    """The value where it passes the test, else NULL; computed once."""
    return F.get(F.filter(F.array(value), test), F.lit(0))


def is_na(c):
    """NULL or the literal N/A."""
    return c.isNull() | (c == NA)


def not_na_literal(c):
    """Anything but the literal N/A; NULL passes."""
    return ~c.eqNullSafe(F.lit(NA))


def null_tokens(name):
    """A feed file's cell with its "no value" spellings as NULL."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return F.expr(f"CASE WHEN `{name}` NOT IN ({tokens}) THEN `{name}` END")


def strip(c):
    """Drop white space at both ends, all Unicode kinds."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_spaces(c):
    return F.regexp_replace(c, SPACE_CLASS + "+", " ")


def null_like(c):
    """Fold the whole-cell null spellings into N/A; NULL stays NULL."""
    return F.when(c.isin(*NULL_LIKE), F.lit(NA)).otherwise(c)


def strip_tags(c):
    return F.regexp_replace(c, java(HTML_TAG), "")


def clean_text(c):
    """Trim, collapse, fold nulls, then drop tags. Tags go last, so a cell of
    tags only ends as an empty string."""
    return strip_tags(let(collapse_spaces(strip(c)), null_like))


def clean_eligibility(c):
    """Trimmed text without blank lines, cut after 500 characters."""
    lines = F.regexp_replace(strip(c), java(r"\n\s*\n"), "\n")
    lines = F.regexp_replace(lines, r"\n+", "\n")

    def shorten(t):
        return (
            F.when(t == "", F.lit(NA))
            .when(F.length(t) > 500, F.concat(F.substring(t, 1, 500), F.lit("...")))
            .otherwise(t)
        )

    return F.when(is_na(c), F.lit(NA)).otherwise(let(lines, shorten))


def truncate(c, size):
    return F.substring(c, 1, size)


def holds(lower_text, words):
    """True where a lower-cased text holds any of the words, as plain substrings
    without word boundaries. The text is read per word: pass a bound value."""
    return F.exists(F.split(F.lit("|".join(words)), r"\|"), lambda word: F.contains(lower_text, word))


def has_any(lower_text, words):
    """``holds`` for any text expression."""
    return let(lower_text, lambda t: holds(t, words))


def rule_text(*columns):
    """Lower-cased text that the keyword rules look at; a NULL reads 'nan'."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("nan")) for c in columns]))


def labelled_field(c, label):
    """Text after the first ``label`` up to the next ``|``, or N/A."""
    value = F.split_part(F.split_part(c, F.lit(label), F.lit(2)), F.lit("|"), F.lit(1))
    return F.when(c.contains(label), strip(value)).otherwise(F.lit(NA))


def keyword_line(c, words=DEADLINE_WORDS, size=100):
    """First line that holds a keyword, stripped and cut, or N/A."""
    lines = F.filter(F.split(c, "\n"), lambda line: has_any(F.lower(line), words))
    return F.coalesce(truncate(strip(F.get(lines, F.lit(0))), size), F.lit(NA))


def resolve_url(href, site_root):
    """Absolute links stay, rooted ones get the site in front, others are N/A."""
    return (
        F.when(href.startswith("http"), href)
        .when(href.startswith("/"), F.concat(F.lit(site_root), href))
        .otherwise(F.lit(NA))
    )


def join_lines(*columns):
    """Non-null parts joined by line breaks; nothing to join gives N/A."""
    parts = F.filter(F.array(*columns), lambda p: p.isNotNull())
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n")).otherwise(F.lit(NA))


def one_line(c):
    """Line breaks to spaces, carriage returns dropped, trimmed."""
    return strip(F.translate(c, "\n\r", " "))


def is_bullet(c):
    return c.startswith("*") | c.startswith("-") | c.startswith("•")


def bullet(c):
    return F.concat(F.lit("• "), c)
