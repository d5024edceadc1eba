"""Text operators of the archive as column expressions.

Null text counts as empty, but where text is put into a sentence a missing part reads `None`.
Patterns are Unicode-aware; `\\z` is the very end of a string, before which no line feed may hide.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from curatrix.schemas import CAPTION_CHARS, ERROR_CHARS

# Catalogue prefixes in the spelling they get, how texts name instruments, and the patterns of a designation, of what a
# title has in brackets and of a gloss at the end of a name.
CATALOGUES = ("TRAPPIST", "Messier", "SMACS", "Abell", "WASP", "NGC", "Arp", "HH", "IC", "M")
SHORT_FORM = {"MESSIER": "M"}
HYPHENATED = ("WASP", "TRAPPIST")
INSTRUMENT_NAMES = {
    "NIRCam": r"\bNIRCam\b|\bnear[\s-]?infrared\s+camera\b",
    "MIRI": r"\bMIRI\b|\bmid[\s-]?infrared\s+instrument\b",
    "NIRSpec": r"\bNIRSpec\b|\bnear[\s-]?infrared\s+spectrograph\b",
    "NIRISS": r"\bNIRISS\b|\bnear[\s-]?infrared\s+imager\s+and\s+slitless\s+spectrograph\b",
    "FGS": r"\bFGS\b|\bfine\s+guidance\s+sensor\b",
}


DESIGNATION = rf"(?iuU)^({'|'.join(CATALOGUES)})\s*[-–]?\s*J?\s*([0-9][0-9.\-]*)\s*([a-z])?\s*\z"
QUALIFIER = r"(?U)\s*[(\[][^)\]]*[)\]]\s*"
GLOSS = r"(?U)\s*\([^)]*\)\s*\z"

#: An entity with its semicolon.
_CLOSED = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def strip(column: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+\z", "")


def normalise(column: Column) -> Column:
    """Only the letters a-z and digits of the lower-cased text."""
    return F.regexp_replace(F.lower(_text(column)), "[^a-z0-9]", "")


def canonical_name(column: Column) -> Column:
    """Display form of a catalogue designation; other names only lose surplus space, end punctuation and a trailing gloss."""
    spaced = F.rtrim(strip(F.regexp_replace(column, r"(?U)\s+", " ")), F.lit(".,;:"))
    bare = F.regexp_replace(spaced, GLOSS, "")
    name = F.when(bare == "", spaced).otherwise(bare)
    prefix, number, letter = (F.regexp_extract(name, DESIGNATION, k) for k in (1, 2, 3))
    spelling = {c.upper(): SHORT_FORM.get(c.upper(), c) for c in CATALOGUES}
    proper = F.element_at(F.create_map(*(F.lit(x) for pair in spelling.items() for x in pair)), F.upper(prefix))
    joint = F.when(proper.isin(*HYPHENATED), "-").otherwise(" ")
    tail = F.when(letter == "", "").otherwise(F.concat(F.lit(" "), F.lower(letter)))
    designation = F.concat(proper, joint, F.rtrim(number, F.lit(".")), tail)
    return F.when(spaced == "", None).otherwise(F.when(prefix == "", name).otherwise(designation))


def release_key(title: Column) -> Column:
    """What titles of one release share: lower-case words without bracketed qualifiers."""
    plain = F.lower(F.regexp_replace(_text(title), QUALIFIER, " "))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9 ]", " "), " +", " "))


@F.pandas_udf(StringType())
def html_unescape(texts: pd.Series) -> pd.Series:
    """HTML entities as the characters they stand for; Spark has no function for it."""
    return texts.map(lambda t: None if t is None else html.unescape(t))


@F.pandas_udf(StringType())
def html_unescape_closed(texts: pd.Series) -> pd.Series:
    """Only entities that end with a semicolon; one that isn't closed stays as it is."""
    return texts.map(lambda t: None if t is None else _CLOSED.sub(lambda m: html.unescape(m[0]), t))


def clean_caption(column: Column, closed: bool = False) -> Column:
    """Without tags, then without entities (closed: only those with their semicolon), then without space at the ends."""
    return strip((html_unescape_closed if closed else html_unescape)(F.regexp_replace(_text(column), "<[^>]+>", "")))


def user_text(title: Column, description: Column, chars: int = CAPTION_CHARS, closed: bool = False) -> Column:
    """What a labeller reads; the caption is cleaned before it's cut."""
    return F.concat(F.lit("TITLE: "), F.coalesce(title, F.lit("None")), F.lit("\n\nCAPTION: "), F.substring(clean_caption(description, closed), 1, chars))


def named_in(text: Column, names: dict[str, str]) -> Column:
    """Keys of the patterns that occur in a text, in their order, whatever the case."""
    return F.filter(F.array(*(F.when(text.rlike(f"(?iuU){p}"), F.lit(k)) for k, p in names.items())), lambda x: x.isNotNull())


def named_instruments(title: Column, description: Column) -> Column:
    return named_in(F.concat(_text(title), F.lit(" "), clean_caption(description)), INSTRUMENT_NAMES)


def correct_instrument(value: Column, named: Column) -> Column:
    """`multiple` needs two names in the text: one name replaces it, none makes it unknown."""
    single = F.when(F.size(named) == 1, F.get(named, F.lit(0))).otherwise("unknown")
    return F.when((value == "multiple") & (F.size(named) < 2), single).otherwise(value)


def name_verified(name: Column, title: Column, description: Column) -> Column:
    """Whether a name occurs in title and raw description, letters and digits only."""
    text = F.concat(F.coalesce(title, F.lit("None")), F.lit(" "), F.coalesce(description, F.lit("None")))
    return F.contains(normalise(text), normalise(name))


def one_line(column: Column) -> Column:
    return F.regexp_replace(column, r"\s*\n+\s*", " ")


def before_bracket(title: Column) -> Column:
    """The title without the first bracket and what follows it on its line."""
    return F.regexp_replace(title, r"(?s)^(.*?)\s*\([^\n]*(.*)\z", "$1$2")


def file_name(photo_id: Column) -> Column:
    return F.concat(photo_id, F.lit(".jpg"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.jpg\z", "")


def short_error(error: Column) -> Column:
    return F.substring(error, 1, ERROR_CHARS)


def redact(text: Column, secret: str) -> Column:
    return F.replace(text, F.lit(secret), F.lit("***")) if secret else text


def safe_run_id(run_id: Column) -> Column:
    return F.regexp_replace(run_id, r"[^\p{L}\p{N}_-]", "_")


def html_escape(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def page_url(base: str, photo_id: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), photo_id)


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def base64(content: Column) -> Column:
    """Bytes, or the UTF-8 of a text, as base64 in one line."""
    return F.translate(F.base64(content.cast("binary")), "\r\n", "")
