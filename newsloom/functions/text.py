"""Column builders for text: whitespace, control characters and slugs.

Whitespace and word characters are the Unicode ones. The JVM's bare ``\\s``,
``\\w`` and one-argument ``trim`` are narrower, so none of them is used here.
"""

from pyspark.sql import Column, functions as F

# The code points that count as white space, the bodies of the
# character classes for white space and word characters, the slug length limit.
SPACES = "".join(map(chr, (
    *range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))
WS = r"\p{Z}\t-\r\x1c-\x1f\x85"
WORD = r"\p{L}\p{N}_"
MAX_SLUG = 100


def strip_text(text) -> Column:
    """Drop white space at both ends."""
    return F.trim(F.col(text) if isinstance(text, str) else text, F.lit(SPACES))


def remove_control_chars(text) -> Column:
    """Drop every code point of the "other" categories (control, format, ...)."""
    return F.regexp_replace(text, r"\p{C}+", "")


def _hyphenate(text: Column, unwanted: str) -> Column:
    kept = F.regexp_replace(F.lower(text), unwanted, "")
    return F.trim(F.regexp_replace(kept, f"[-{WS}]+", "-"), F.lit("-"))


def headline_slug(headline) -> Column:
    """ASCII slug of a headline, without length limit or fallback."""
    text = F.col(headline) if isinstance(headline, str) else headline
    return _hyphenate(text, f"[^a-z0-9{WS}-]+")


def hash_slug(headline) -> Column:
    """Stand-in slug for a headline that has no word characters."""
    return F.concat(F.lit("article-"), F.left(F.sha1(headline), F.lit(8)))


def item_slug(item_id: Column, headline: Column) -> Column:
    """Slug from the id when there is one, else from the headline.

    Both arguments are expected to be stripped already. The cut at MAX_SLUG
    comes last, so a hyphen at that place stays.
    """
    base = F.when(F.coalesce(item_id, F.lit("")) != "", item_id).otherwise(headline)
    slug = F.left(_hyphenate(base, f"[^{WORD}{WS}-]+"), F.lit(MAX_SLUG))
    # A lambda over an array of one, so that the patterns run only once.
    return F.get(F.transform(F.array(slug), lambda s: F.when(s != "", s).otherwise(hash_slug(headline))), F.lit(0))


def numbered_slug(slug: Column, k: Column) -> Column:
    """The k-th name in a slug's list of names; k = 0 is the slug itself.

    ``slug-1, slug-2, ...`` follow as long as they fit into MAX_SLUG. A
    99-character slug has one more name, ``slug-``, before its numbers. Numbers
    that no longer fit are attached to a shortened slug together with a digest
    of the whole slug; the ``~`` cannot occur in any slug, and the digest keeps
    slugs apart that only differ in their last characters. So two slugs share a
    name only if one of them is literally another's numbered name.
    """
    has_bare_hyphen = F.length(slug) == MAX_SLUG - 1
    n = F.when(has_bare_hyphen, k - 1).otherwise(k).cast("string")
    plain = F.concat(slug, F.lit("-"), n)
    tail = F.concat(F.lit("~"), F.left(F.sha1(slug), F.lit(16)), F.lit("-"), n)
    cut = F.concat(F.left(slug, F.lit(MAX_SLUG) - F.length(tail)), tail)
    return (
        F.when(k == 0, slug)
        .when(has_bare_hyphen & (k == 1), F.concat(slug, F.lit("-")))
        .when(F.length(plain) <= MAX_SLUG, plain)
        .otherwise(cut)
    )
