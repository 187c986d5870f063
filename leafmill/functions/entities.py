"""Entity tagging by pattern: text -> map of entity type to values."""

from pyspark.sql import Column, functions as F

MAX_VALUES = 20

# The legal suffixes, patterns and terms that define the tags.
LEGAL_SUFFIXES = "Inc|Corp|Corporation|Ltd|LLC|GmbH|PLC"
LOCATION = r"\b(?:in|at|from|to|near)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2})\b"
DATE = (
    r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2}"
    r"|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4})\b"
)
MONEY = (
    r"\$\s*\d+(?:,\d{3})*(?:\.\d{2})?"
    r"|\d+(?:,\d{3})*(?:\.\d{2})?\s*(?:USD|EUR|GBP|dollars?|euros?)"
)
PERCENT = r"\d+(?:\.\d+)?%|\d+(?:\.\d+)?\s*percent"
NOT_LOCATIONS = [
    "Spark", "Spark Engine", "Docling", "OpenSearch", "Ingestion Solutions",
    "Overview", "Note", "It", "The", "This", "That", "These", "Those",
    "Apache Spark",
]

# A run of capitalised words up to its last legal suffix. Java matches a repeated group by
# recursion and overflows its stack on long runs, so the run is one character class here,
# and ``_break_runs`` ends it in the text wherever a word does not start with a capital.
ORGANIZATION = rf"(?U)\b([A-Z][A-Za-z&\s]*\s(?:{LEGAL_SUFFIXES})\.?)\b"


def _break_runs(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)(?<=\s)(?=[a-z&])", "\x00")


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _organizations(text: Column) -> Column:
    # Most texts have no legal suffix at all; the cheap test spares them the scan.
    return F.when(
        text.rlike(rf"(?U)\s(?:{LEGAL_SUFFIXES})"), _all(_break_runs(text), ORGANIZATION, 1)
    ).otherwise(F.array().cast("array<string>"))


def _locations(text: Column) -> Column:
    found = _all(text, "(?U)" + LOCATION, 1)
    return F.filter(
        F.array_distinct(found),
        lambda v: ~v.isin(NOT_LOCATIONS) & (F.char_length(v) > 2),
    )


def extract_entities(text: Column) -> Column:
    """``map<string, array<string>>``: values in order of appearance, at most 20 per type.

    Types without a hit have no key.
    """
    found = {
        "ORGANIZATION": _organizations(text),
        "LOCATION": _locations(text),
        "DATE": _all(text, "(?iU)" + DATE, 0),
        "MONEY": _all(text, "(?iU)" + MONEY, 0),
        "PERCENT": _all(text, "(?iU)" + PERCENT, 0),
    }
    tags = F.map_from_arrays(
        F.array(*[F.lit(k) for k in found]),
        F.array(*[F.slice(F.array_distinct(v), 1, MAX_VALUES) for v in found.values()]),
    )
    return F.map_filter(tags, lambda _, v: F.size(v) > 0)


def count_entities(entities: Column) -> Column:
    return F.aggregate(F.map_values(entities), F.lit(0), lambda n, v: n + F.size(v))
