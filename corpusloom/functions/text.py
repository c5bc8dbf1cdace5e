"""Column builders over chunk text and metadata. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Titles of sections that structure a document without saying anything (lower case).
STRUCTURAL_TITLES = ["sommaire", "table des matières", "table of contents", "contents", "index", "bibliographie", "bibliography", "références", "references", "glossaire"]
#: Ligatures and their letters.
LIGATURES = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"), ("œ", "oe"), ("æ", "ae")]
IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"
PREVIEW = 220


def chunk_key(document_id, chunk_index) -> Column:
    return F.concat_ws("::", document_id, F.col(chunk_index).cast("string") if isinstance(chunk_index, str) else chunk_index.cast("string"))


def breadcrumb(trail="heading_trail") -> Column:
    """Titles joined by ' > '; a null trail has no titles."""
    return F.coalesce(F.array_join(trail, " > "), F.lit(""))


def titled(trail="heading_trail") -> Column:
    return F.coalesce(F.nullif(breadcrumb(trail), F.lit("")), F.lit("(sans titre)"))


def is_structural(trail="heading_trail") -> Column:
    return F.coalesce(F.exists(trail, lambda t: F.lower(F.trim(t)).isin(STRUCTURAL_TITLES)), F.lit(False))


def flag(column) -> Column:
    """A missing flag is false."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(False))


def has_image(text="text") -> Column:
    return F.coalesce(F.contains(text, F.lit("![")), F.lit(False))


def modality_label(code, formula, image, plain: str = "texte") -> Column:
    parts = F.concat_ws("+", F.when(code, F.lit("code")), F.when(formula, F.lit("formule")), F.when(image, F.lit("image")))
    return F.coalesce(F.nullif(parts, F.lit("")), F.lit(plain))


def body(embed_text="embed_text", text="text") -> Column:
    """embed_text, or text where that is missing or empty."""
    return F.coalesce(F.nullif(F.col(embed_text), F.lit("")), F.col(text))


def embedding_text(trail, content: Column) -> Column:
    """The breadcrumb, a blank line and the body; the body alone without titles."""
    return F.when(F.coalesce(F.size(trail), F.lit(0)) > 0, F.concat(breadcrumb(trail), F.lit("\n\n"), content)).otherwise(content)


def preview(text="text", limit: int = PREVIEW) -> Column:
    """White space flattened; a longer text is cut, trimmed on the right, and dotted."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, limit)), F.lit("...")))


def shown_text(show_full: bool, any_modality: Column, text="text") -> Column:
    """The whole text where asked for, or where it holds more than prose; else its preview."""
    return F.when(F.lit(show_full) | any_modality, F.col(text)).otherwise(preview(text))


def image_targets(text="text") -> Column:
    return F.regexp_extract_all(text, F.lit(IMAGE), 1)


def image_path(root: str, document_id, target) -> Column:
    return F.concat(F.lit(root + "/"), document_id, F.lit("/"), target)


def reason_class(reason="reason") -> Column:
    return F.substring_index(reason, ":", 1)


def slug_of(document_id="document_id") -> Column:
    """All before the last '__'; the whole id without one."""
    return F.regexp_replace(document_id, r"^(.*)__.*$", "$1")


def document_id_of(slug, content, digits: int = 12) -> Column:
    return F.concat(slug, F.lit("__"), F.substring(F.sha2(F.col(content).cast("binary"), 256), 1, digits))


def repair_ligatures(text="text") -> Column:
    out = F.col(text) if isinstance(text, str) else text
    for a, b in LIGATURES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def token_count(text="text") -> Column:
    """Runs of non-space, and two special tokens: the stand-in where no tokenizer is given."""
    return (F.size(F.regexp_extract_all(text, F.lit(r"\S+"), 0)) + 2).cast("int")


def sorted_ints(csv: Column) -> Column:
    """'20,5,10' as a sorted array of integers, duplicates kept."""
    return F.sort_array(F.transform(F.split(csv, ","), lambda x: F.trim(x).cast("int")))


def is_noise(text="text") -> Column:
    """Chunks that are not worth indexing: under 20 characters, or under half of them letters or blanks."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L} \n]", ""))
    return (F.length(text) < 20) | (letters * 2 < F.length(text))


def has_number(text="text") -> Column:
    return F.rlike(text, F.lit(r"[0-9]+([.,][0-9]+)?"))


def has_name(text="text") -> Column:
    """A capitalised word after a lower-case word and a blank."""
    return F.rlike(text, F.lit(r"\p{Ll} \p{Lu}\p{Ll}"))


def html_text(html="html") -> Column:
    """Visible text: scripts, styles and comments out, tags to blanks, five entities back, blanks flattened."""
    x = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def strip_tracing(text="text") -> Column:
    """Without the source comments <!--src:S12-->."""
    return F.regexp_replace(text, r"<!--src:[^>]*-->", "")


def citations(text="text") -> Column:
    return F.regexp_extract_all(text, F.lit(r"<!--src:(S[0-9]+)-->"), 1)
