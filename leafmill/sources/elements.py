"""Documents to ordered, labelled elements, one row per element (``schema.ELEMENTS``)."""

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from leafmill import schema
from leafmill.functions import text as X

PAGE_LABELS = {
    "title": "title", **{f"h{n}": "section_header" for n in range(1, 7)}, "p": "text",
    "li": "list_item", "pre": "code", "table": "table",
}
# A block reaches to its own closing tag; a tag's name ends at white space or the bracket.
PAGE_TAGS = "(?is)" + "|".join(
    rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>" for tag in PAGE_LABELS) + r"|<img(?:\s[^>]*)?>"
MARKDOWN_BLOCKS = r"(?ms)^```.*?^```[^\n]*$|^[^\n]+$"
LINES_PER_PAGE = 10


def _elements(name, pos, label, text, page):
    return [
        name.cast("string").alias("document_name"),
        pos.cast("int").alias("pos"),
        label.alias("label"),
        text.alias("text"),
        page.cast("int").alias("page_no"),
    ]


def line_elements(documents: DataFrame, name: str = "doc_id", text: str = "text") -> DataFrame:
    """Plain text: one element per line, the first one being the title."""
    lines = documents.select(
        F.col(name).alias("name"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    pos = F.col("pos")
    return lines.select(_elements(
        F.col("name"), pos, F.when(pos == 0, "title").otherwise("text"), F.col("line"),
        F.floor(pos / LINES_PER_PAGE) + 1,
    ))


def page_elements(pages: DataFrame, name: str = "page_id", html: str = "html") -> DataFrame:
    """HTML: titles, headings, paragraphs, list items, preformatted text and tables, stripped of
    their tags, and images by their alternative text."""
    blocks = pages.select(
        F.col(name).alias("name"),
        F.posexplode(F.regexp_extract_all(html, F.lit(PAGE_TAGS), F.lit(0))).alias("pos", "block"),
    )
    tag = F.lower(F.regexp_extract("block", r"^<(\w+)", 1))
    label = F.when(tag == "img", "picture")
    for known, kind in PAGE_LABELS.items():
        label = label.when(tag == known, kind)
    text = F.when(tag == "img", F.regexp_extract("block", r'(?i)\salt\s*=\s*"([^"]*)"', 1)).otherwise(
        F.regexp_replace("block", "<[^>]+>", ""))
    return blocks.select(_elements(F.col("name"), F.col("pos"), label, text, F.lit(None)))


def markdown_elements(documents: DataFrame, name: str = "doc_id", text: str = "text") -> DataFrame:
    """Markdown: headings, fenced code, table rows, images, list items and lines of text."""
    blocks = documents.select(
        F.col(name).alias("name"),
        F.posexplode(F.regexp_extract_all(text, F.lit(MARKDOWN_BLOCKS), F.lit(0)))
        .alias("pos", "block"),
    )
    block = F.col("block")
    label = (
        F.when(block.rlike(r"^```"), "code")
        .when(block.rlike(r"^#\s"), "title")
        .when(block.rlike(r"^#{2,6}\s"), "section_header")
        .when(block.rlike(r"^\|"), "table")
        .when(block.rlike(r"^!\["), "picture")
        .when(block.rlike(r"^\s*(?:[-*+]|\d+\.)\s"), "list_item")
        .otherwise("text")
    )
    content = F.regexp_replace(block, r"^#{1,6}\s+|^```[^\n]*\n|\n```[^\n]*\z", "")
    return blocks.select(_elements(F.col("name"), F.col("pos"), label, content, F.lit(None)))


def turn_elements(conversations: DataFrame) -> DataFrame:
    """Conversations: one element per turn; a system or user turn opens a section."""
    turn = F.col("turn")
    label = F.when(F.col("role").isin("system", "user"), "section_header").otherwise("text")
    return conversations.select(_elements(F.col("conv_id"), turn, label, F.col("text"), turn + 1))


def sanitized(elements: DataFrame) -> DataFrame:
    return elements.withColumn("text", X.sanitize_text(F.col("text")))


def parsed_elements(
    files: DataFrame, parser: Callable[[bytes], Iterable[tuple]], partitions: int | None = None
) -> DataFrame:
    """Elements from a user's parser of binary files, called once per file.

    ``parser(content)`` yields ``(label, text, page_no)`` in reading order. Files are spread by
    path first, since a scan packs many small ones into few tasks. An error in the parser fails
    the job and names the file.
    """
    files = files.select("document_name", "content")
    spread = files.repartition("document_name") if partitions is None else (
        files.repartition(partitions, "document_name"))

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch["document_name"], batch["content"]):
                try:
                    found = list(parser(bytes(content)))
                except Exception as cause:
                    raise RuntimeError(f"cannot parse {name}: {cause}") from cause
                if found:
                    label, text, page = zip(*found)
                    yield pd.DataFrame({
                        "document_name": name, "pos": range(len(found)), "label": label,
                        "text": text, "page_no": pd.array(page, dtype="Int32"),
                    })

    return spread.mapInPandas(parse, schema.ELEMENTS)


BUILT_IN = {"text": line_elements, "markdown": markdown_elements, "html": page_elements}


def to_elements(
    files: DataFrame, parsers: dict[str, Callable[[bytes], Iterable[tuple]]] | None = None
) -> DataFrame:
    """Route files (``document_name, document_type, content``) by type to their element builder.

    Text, Markdown and HTML are read by built-in expressions; ``parsers`` maps further types,
    such as ``pdf``, to a user's parser. Files of any other type are left to the caller: see
    ``unsupported_files``.
    """
    parsers = parsers or {}
    parts = []
    for kind, build in BUILT_IN.items():
        if kind not in parsers:
            texts = files.filter(F.col("document_type") == kind).select("document_name", F.decode("content", "UTF-8").alias("text"))
            parts.append(build(texts, "document_name", "text"))
    for kind, parser in parsers.items():
        parts.append(parsed_elements(files.filter(F.col("document_type") == kind), parser))
    elements = parts[0]
    for part in parts[1:]:
        elements = elements.unionByName(part)
    return elements


def unsupported_files(files: DataFrame, parsers: dict | None = None) -> DataFrame:
    known = set(BUILT_IN) | set(parsers or {})
    return files.filter(~F.col("document_type").isin(*known))
