"""The chunking rules in plain Python, one document at a time, to compare the operator with."""


def chunk(elements, size, overlap):
    """``elements``: (label, text, page or None) in order -> (text, page, section, types) list."""
    held, section, page, chunks = [], None, 1, []

    def close():
        text = " ".join(t for _, t in held)
        chunks.append((text, page, section or "Unknown", sorted({label for label, _ in held})))

    for label, text, page_no in elements:
        if not text.strip():
            continue
        if label in ("title", "section_header"):
            if held:
                close()
            held, section = [], text
        held.append((label, text))
        page = page if page_no is None else page_no
        if sum(len(t.split()) for _, t in held) >= size:
            close()
            words = text.split()
            tail = " ".join(words[-overlap:]) if len(words) > overlap else text
            held = [(label, tail)] if overlap > 0 else []
    if held:
        close()
    return chunks
