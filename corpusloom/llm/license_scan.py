"""Licence lookup by the digest of a canonical form of the whole text."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import DIGESTS, NOTICES, TEXTS

#: A line that only says whose copyright it is; a sentence that mentions a copyright notice is none.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n©]*(copyright[ \t]*(\(c\)|©|[:0-9<\[{])|©|\(c\)[ \t]*[0-9])[^\n]*$"
RIGHTS_LINE = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
NOT_WORDS = r"[^\p{L}\p{N}]+"
#: Equivalent spellings, applied in this order to the words.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words one blank apart, one spelling each; null is empty."""
    x = F.lower(F.coalesce(text, F.lit("")))
    x = F.regexp_replace(F.regexp_replace(x, COPYRIGHT_LINE, ""), RIGHTS_LINE, "")
    x = F.trim(F.regexp_replace(x, NOT_WORDS, " "))
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def canonical_text(text: str) -> str:
    """The same for one licence text of ASCII and ©, on the driver."""
    x = text.lower()
    for pattern in (COPYRIGHT_LINE, RIGHTS_LINE):
        x = re.sub(pattern.replace(r"\p{L}\p{N}", "a-z0-9"), "", x)
    x = re.sub(r"[^a-z0-9]+", " ", x).strip(" ")
    for a, b in SPELLINGS:
        x = x.replace(a, b)
    return x


def digest(text: str) -> str:
    return hashlib.sha256(canonical_text(text).encode()).hexdigest()


def known_digests() -> list[tuple[str, str]]:
    """(digest, licence id) of the known texts: a fixed table of a few rows."""
    out = {known: name for name, known in DIGESTS}
    for name, title, text in TEXTS:
        out[digest(text)] = name
        out[digest(f"{title}\n\n{text}")] = name
    for name, text in NOTICES:
        out[digest(text)] = name
    return sorted(out.items())


def license_scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Look every whole text up among known licences: ``id_col, text_digest, license_id``.

    ``text_digest`` is the SHA-256 of the canonical form; ``license_id`` is null where it is not
    known. The table of digests is a constant of the call and is broadcast; an empty one knows no
    licence, and of a repeated digest the last id holds. Documents are neither shuffled nor sampled. Null and empty texts have the digest of the empty text and no licence.
    Repeated rows and null ids are returned as they come. Other columns are ignored.
    """
    pairs = known_digests() if known is None else list(dict(known).items())
    table = docs.sparkSession.createDataFrame(pairs, "known_digest string, license_id string")
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(canonical(F.col(text_col)).cast("binary"), 256).alias("text_digest"))
    joined = rows.join(F.broadcast(table), F.col("text_digest") == F.col("known_digest"), "left")
    return joined.select(F.col("id").alias(id_col), "text_digest", "license_id")
