"""Section-aware chunking of ordered elements into overlapping chunks.

Elements are cut into blocks of ``span`` consecutive positions and each block is folded by one
task. A document that fits one block, which nearly all do, needs a single shuffle. A longer one
is folded block by block in parallel as well: ``carry.entry_states`` first works out what each
block inherits from the ones before it, so no task ever holds more than a block of elements.
"""

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions import text as X
from leafmill.operators.carry import entry_states

# Labels that open a section or set a flag.
HEADERS = ["section_header", "title"]
TABLES = ["table"]
IMAGES = ["picture", "figure"]
CODE = ["code"]

KEYS = ["document_name", "block"]
PARTS = "array<struct<no:int,first:int,last:int,tail:int,page:int,section:string>>"


def _name() -> Column:
    return F.coalesce(F.col("document_name"), F.lit("unknown"))


def element_blocks(elements: DataFrame, span: int) -> DataFrame:
    """Non-blank elements as one sorted array per (document, block).

    Both keys are made non-null so that every join on them reads this one exchange.
    """
    kept = elements.filter(X.has_text(F.col("text"))).select(
        _name().alias("document_name"),
        F.coalesce(F.floor(F.col("pos") / span).cast("int"), F.lit(0)).alias("block"),
        F.struct(
            "pos",
            X.word_count(F.col("text")).alias("n_words"),
            F.col("label").isin(HEADERS).alias("is_header"),
            "page_no",
            "label",
            "text",
        ).alias("element"),
    )
    return kept.groupBy(*KEYS).agg(F.sort_array(F.collect_list("element")).alias("elements"))


def _fold(elements: Column, size: int, overlap: int, entry: dict[str, Column]) -> Column:
    """Chunk parts of a block as index ranges into ``elements``.

    ``pending`` counts the words held back so far, including those inherited at entry; ``tail``
    is the element whose last words open the current chunk, 0 if none.
    """
    start = F.struct(
        entry["pending"].cast("int").alias("pending"),
        entry["no"].cast("int").alias("no"),
        F.lit(1).alias("first"),
        F.lit(0).alias("tail"),
        F.lit(0).alias("seen"),
        entry["page"].cast("int").alias("page"),
        entry["section"].cast("string").alias("section"),
        F.array().cast(PARTS).alias("parts"),
    )

    def part(no, first, last, tail, page, section):
        return F.array(F.struct(
            no.alias("no"), first.alias("first"), last.alias("last"), tail.alias("tail"),
            page.alias("page"), section.alias("section"),
        ))

    def close(state):
        # Nothing of the chunk lies in this block when all its text was inherited.
        local = (state.first <= state.seen) | (state.tail > 0)
        return F.when(local, F.concat(state.parts, part(
            state.no, state["first"], state.seen, state.tail, state.page, state.section,
        ))).otherwise(state.parts)

    def step(state, e):
        index = state.seen + 1
        at_header = e.is_header & (state.pending > 0)
        parts = F.when(at_header, close(state)).otherwise(state.parts)
        no = F.when(at_header, state.no + 1).otherwise(state.no)
        first = F.when(at_header, index).otherwise(state["first"])
        tail = F.when(at_header, 0).otherwise(state.tail)
        page = F.coalesce(e.page_no, state.page)
        section = F.when(e.is_header, e.text).otherwise(state.section)
        pending = F.when(at_header, e.n_words).otherwise(state.pending + e.n_words)
        full = pending >= size
        kept_words = F.least(e.n_words, F.lit(overlap)) if overlap > 0 else F.lit(0)
        return F.struct(
            F.when(full, kept_words).otherwise(pending).alias("pending"),
            F.when(full, no + 1).otherwise(no).alias("no"),
            F.when(full, index + 1).otherwise(first).alias("first"),
            F.when(full, index if overlap > 0 else F.lit(0)).otherwise(tail).alias("tail"),
            index.alias("seen"),
            page.alias("page"),
            section.alias("section"),
            F.when(full, F.concat(parts, part(no, first, index, tail, page, section)))
            .otherwise(parts).alias("parts"),
        )

    return F.aggregate(elements, start, step, close)


def _chunk_parts(blocks: DataFrame, size: int, overlap: int, entry: dict[str, Column]) -> DataFrame:
    """One row per chunk part: the whole chunk unless it crosses a block boundary."""
    elements = F.col("elements")

    def render(p):
        inner = F.slice(elements, p["first"], F.greatest(p["last"] - p["first"] + 1, F.lit(0)))
        tail = F.element_at(elements, F.greatest(p.tail, F.lit(1)))
        tail_text = F.when(
            tail.n_words > overlap,
            F.array_join(F.slice(X.words(tail.text), -max(overlap, 1), max(overlap, 1)), " "),
        ).otherwise(tail.text)
        none = F.array().cast("array<string>")
        texts = F.concat(
            F.when(p.tail > 0, F.array(tail_text)).otherwise(none),
            F.transform(inner, lambda e: e.text),
        )
        types = F.concat(
            F.when(p.tail > 0, F.array(tail.label)).otherwise(none),
            F.transform(inner, lambda e: e.label),
        )
        return F.struct(
            p.no.alias("chunk_index"),
            p.page.alias("page_number"),
            p.section.alias("section_title"),
            F.array_join(texts, " ").alias("chunk_text"),
            # Known from the elements, so the joined text is not split again.
            F.aggregate(
                inner,
                F.when(p.tail > 0, F.least(tail.n_words, F.lit(max(overlap, 0)))).otherwise(0),
                lambda n, e: n + e.n_words,
            ).alias("word_count"),
            F.array_distinct(types).alias("element_types"),
        )

    return blocks.select(*KEYS, F.inline(F.transform(_fold(elements, size, overlap, entry), render)))


def _merge_parts(parts: DataFrame) -> DataFrame:
    """Chunks from parts. A part holds a word or more, so a chunk has at most ``size`` of them."""
    fields = ["page_number", "section_title", "chunk_text", "word_count", "element_types"]
    merged = parts.groupBy("document_name", "chunk_index").agg(
        F.sort_array(F.collect_list(F.struct("block", *fields))).alias("parts")
    )
    last = F.element_at("parts", -1)
    return merged.select(
        "document_name",
        "chunk_index",
        last.page_number.alias("page_number"),
        last.section_title.alias("section_title"),
        F.array_join(F.transform("parts", lambda p: p.chunk_text), " ").alias("chunk_text"),
        F.aggregate("parts", F.lit(0), lambda n, p: n + p.word_count).alias("word_count"),
        F.array_distinct(F.flatten(F.transform("parts", lambda p: p.element_types)))
        .alias("element_types"),
    )


def describe_chunks(chunks: DataFrame, id_mode: str = "stem") -> DataFrame:
    """Add id, length and flags to chunks that carry text, words, page, section, index and types."""
    name, text, types = F.col("document_name"), F.col("chunk_text"), F.col("element_types")
    index, page = F.col("chunk_index"), F.col("page_number")
    if id_mode == "md5":
        chunk_id = X.content_id(name, page, index, text)
    elif id_mode == "path":
        chunk_id = X.chunk_id(F.regexp_replace(name, r"(?s)(?<=[^/])\.[^./]+\z", ""), index)
    elif id_mode == "stem":
        chunk_id = X.chunk_id(X.file_stem(name), index)
    else:
        raise ValueError(f"unknown id_mode {id_mode!r}")

    def flag(labels):
        return F.coalesce(F.arrays_overlap(types, F.array(*map(F.lit, labels))), F.lit(False))

    return chunks.select(
        chunk_id.alias("chunk_id"),
        "chunk_text",
        "document_name",
        "page_number",
        F.coalesce(F.nullif(F.col("section_title"), F.lit("")), F.lit("Unknown")).alias("section_title"),
        "chunk_index",
        "word_count",
        F.char_length(text).alias("char_count"),
        flag(TABLES).alias("has_table"),
        flag(IMAGES).alias("has_image"),
        flag(CODE).alias("has_code"),
        F.array_sort(types).alias("element_types"),
    )


def chunk_elements(
    elements: DataFrame, size: int = 512, overlap: int = 50, span: int = 256, id_mode: str = "stem"
) -> DataFrame:
    """Chunks of at least ``size`` words, split at headers, repeating ``overlap`` words.

    ``elements`` has the columns of ``schema.ELEMENTS``; ``pos`` is unique within a document.
    ``id_mode`` is ``stem`` (file stem and index), ``path`` (the same with its folder, for
    equal file names in several folders) or ``md5`` (of name, page, index and text).
    """
    blocks = element_blocks(elements, span)
    long_documents = elements.filter(F.col("pos") >= span).select(
        _name().alias("document_name")).distinct()
    inherited = entry_states(blocks, long_documents, size, overlap)

    fresh = {
        "pending": F.lit(0), "no": F.lit(0), "page": F.lit(1), "section": F.lit(None),
    }
    alone = _chunk_parts(blocks.join(inherited, KEYS, "left_anti"), size, overlap, fresh)
    spanning = _chunk_parts(
        blocks.join(inherited, KEYS), size, overlap,
        {name: F.col(f"entry_{name}") for name in fresh},
    )
    columns = ["document_name", "chunk_index", "page_number", "section_title", "chunk_text",
               "word_count", "element_types"]
    chunks = alone.select(columns).unionByName(_merge_parts(spanning).select(columns))
    return describe_chunks(chunks, id_mode)
