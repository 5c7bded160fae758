"""Text taken from file content, and the tokens of a text."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# A character reference: a decimal or hexadecimal number, or one of the names that HTML defines.
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# References that most pages have no others than; the ampersand itself comes last, so that nothing is resolved twice.
COMMON = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "nbsp": "\u00A0", "amp": "&"}
OTHER = rf"&(?!(?:{'|'.join(COMMON)});)" + REFERENCE[1:]

TOKEN, NO_TOKEN = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"


def decode_text(content: Column) -> Column:
    """Bytes of a text file as a string; bytes that are not UTF-8 become the replacement character."""
    return F.make_valid_utf8(content.cast("string"))


def _character(reference: Column) -> Column:
    """The character a reference stands for; what is no character stays as it was written."""
    number = (
        F.when(reference.rlike("^#[xX]"), F.conv(F.substr(reference, F.lit(3)), 16, 10))
        .when(reference.startswith("#"), F.substr(reference, F.lit(2)))
        .cast("bigint")
    )
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    pairs = [F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))]
    named = F.try_element_at(F.create_map(*pairs, F.lit("apos"), F.lit("'")), reference)
    return F.coalesce(numbered, named, F.concat(F.lit("&"), reference, F.lit(";")))


def decode_references(text: Column) -> Column:
    """Character references resolved, each once: what a resolved one forms with its neighbours is left alone.

    The table of all names is searched only in texts that have a reference beyond the common ones.
    """
    plain = text
    for name, sign in COMMON.items():
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(sign))
    found = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), _character)
    between = F.split(text, REFERENCE, -1)
    pieces = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda plain, sign: F.concat(plain, sign))
    every = F.array_join(pieces, "")
    return F.when(~text.contains("&"), text).when(~text.rlike(OTHER), plain).otherwise(every)


def html_text(html: Column) -> Column:
    """Visible text: scripts, styles and comments removed, block ends as line breaks, cell ends as blanks, tags dropped."""
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    blocks = "p|div|li|h[1-6]|tr|title|nav|article|section|header|footer|aside|ul|ol|dt|dd|option|caption|blockquote|pre"
    text = F.regexp_replace(text, rf"(?i)<br\s*/?>|</({blocks})\s*>", "\n")
    text = F.regexp_replace(text, r"(?i)</t[dh]\s*>", " ")
    text = decode_references(F.regexp_replace(text, r"(?s)<[^>]*>", ""))
    text = F.regexp_replace(text, r"[ \t\r\u00A0]+", " ")
    return F.btrim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def join_pages(pages: Column) -> Column:
    """Page texts of one file in order, one per line; a page without text gives an empty line."""
    return F.array_join(F.transform(pages, lambda page: F.coalesce(page, F.lit(""))), "\n")


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_line(text: Column) -> Column:
    """The same tokens in one string with a blank between them, which goes to Python as it stands; lists go token by token."""
    return F.btrim(F.regexp_replace(F.lower(text), NO_TOKEN, " "))
