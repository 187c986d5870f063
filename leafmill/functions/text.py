"""Text, name and metadata expressions. Everything here runs inside the JVM."""

from pyspark.sql import Column, functions as F

# Java leaves U+001C..U+001F out of \s although they separate words elsewhere.
SPACE = r"[\s\x1C-\x1F]"
WORD = r"(?U)[^\s\x1C-\x1F]+"
TOKEN = r"[\p{L}\p{N}]+"
# White space other than the blank.
UNUSUAL_SPACE = r"(?U)[\s\x1C-\x1F&&[^ ]]"

# File suffix -> document type.
DOCUMENT_TYPES = {
    ".pdf": "pdf",
    ".docx": "word",
    ".doc": "word",
    ".txt": "text",
    ".md": "markdown",
    ".html": "html",
    ".htm": "html",
}


def has_text(text: Column) -> Column:
    """True when the text holds anything but white space; null counts as blank."""
    return F.coalesce(text.rlike(WORD), F.lit(False))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words. Where single blanks separate them, blanks are counted instead, which
    is faster than matching each word."""
    inner = F.trim(text)
    blanks = F.octet_length(inner) - F.octet_length(F.replace(inner, F.lit(" "), F.lit("")))
    uneven = (inner == "") | inner.contains("  ") | inner.rlike(UNUSUAL_SPACE)
    return F.when(uneven, F.regexp_count(text, F.lit(WORD))).otherwise(blanks + 1)


def last_words(text: Column, n: int) -> Column:
    """The last ``n`` words joined by single spaces, or the text itself if it has no more than ``n``."""
    return F.when(
        word_count(text) > n, F.array_join(F.slice(words(text), -n, n), " ")
    ).otherwise(text)


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(TOKEN))


def sanitize_text(text: Column, max_length: int | None = None) -> Column:
    """Drop control characters other than newline, return and tab; cut to length; strip."""
    clean = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    if max_length:
        clean = F.substring(clean, 1, max_length)
    return F.regexp_replace(clean, r"(?U)^\s+|\s+\z", "")


def format_file_size(n_bytes: Column) -> Column:
    """Bytes as ``B`` .. ``PB`` in steps of 1024, two decimals, exact halves to even."""
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    text = None
    for power, unit in enumerate(units):
        shown = F.format_string(f"%.2f {unit}", F.bround(n_bytes / F.lit(float(1024 ** power)), 2))
        fits = n_bytes < F.lit(1024 ** (power + 1))
        if text is None:
            text = F.when(fits, shown)
        else:
            text = text.otherwise(shown) if unit == "PB" else text.when(fits, shown)
    return text


def file_name(path: Column) -> Column:
    return F.substring_index(F.regexp_replace(path, r"/+\z", ""), "/", -1)


def file_stem(path: Column) -> Column:
    """Last path part without its last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(file_name(path), r"(?s)(?<=.)\.[^.]+\z", "")


def document_type(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(file_name(path), r"(?s).(\.[^.]+)\z", 1))
    kind = None
    for known, name in DOCUMENT_TYPES.items():
        kind = F.when(suffix == known, name) if kind is None else kind.when(suffix == known, name)
    return kind.otherwise("unknown")


def chunk_id(stem: Column, index: Column) -> Column:
    """``report`` and 7 give ``report_chunk_0007``; longer numbers keep all their digits."""
    return F.format_string("%s_chunk_%04d", stem, index)


def content_id(name: Column, page: Column, index: Column, text: Column) -> Column:
    """MD5 over name, page, index and the first 80 characters."""
    return F.md5(F.concat_ws("|", name, page, index, F.substring(text, 1, 80)).cast("binary"))


def merge_metadata(base: Column, extra: Column) -> Column:
    """Shallow merge in which ``extra`` wins, even where its value is null."""
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(extra), k))
    return F.map_concat(kept, extra)
