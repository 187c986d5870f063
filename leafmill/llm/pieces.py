"""SentencePiece encoding and decoding by a table of distinct chunks.

A chunk is a run of whitespace markers with the characters up to the next marker. Where no piece
has a marker after another character, segmentation never crosses a chunk's start, so each distinct
chunk a task meets is segmented once, and the ids of a text are those of its chunks, put
together by position. Characters that occur in no piece but as bytes (here the line feed) are
chunks of their own for the same reason.

The table is one per task: a join of every word of the corpus with one global table would move
more bytes than the input has, and a global table has no size bound to broadcast it by.
"""

import re
from itertools import accumulate, chain, pairwise

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from leafmill.llm.common import appended

MARK = "▁"
#: Entries of a task's table in its two halves, and the longest chunk kept in it; longer ones are segmented where they stand.
TABLE_SIZE, TABLE_CHUNK = 250_000, 64
#: Characters of texts that are cut into chunks at once.
BLOCK = 1 << 18


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ChunkTable:
    """Ids (little-endian unsigned 32-bit) of the chunks met so far; a text is decoded from its ids, a block at a time."""

    def __init__(self, proto: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_byte(i)]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("this model has pieces across whitespace markers")
        if [sp.id_to_piece(i) for i in sp.encode("a b")][:1] != [MARK + "a"] or sp.encode("a  b ") == sp.encode("a b"):
            raise ValueError("this model rewrites whitespace")
        alone = "" if any("\n" in p for p in pieces) else "\n"
        self.chunk = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|{alone}" if alone else ""))
        self.cut = re.compile(f"(?<=[^{MARK}]){MARK}")
        self.mark = sp.piece_to_id(MARK)
        self.more = self.mark.to_bytes(4, "little")
        self.begin, self.end = (i.to_bytes(4, "little") if i >= 0 else b"" for i in (sp.bos_id(), sp.eos_id()))
        self.lead = len(sp.encode("\n"))
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """The encoder puts one marker before what it gets: leave one away, or take it off again."""
        whole = [c[1:] if c[0] == MARK else "\n" + c for c in chunks]
        out = []
        for chunk, ids in zip(chunks, self.sp.encode(whole, num_threads=1), strict=True):
            out.append((ids or [self.mark]) if chunk[0] == MARK else ids[self.lead:])
        stops = list(accumulate(map(len, out), initial=0))
        data = np.fromiter(chain.from_iterable(out), "<u4", stops[-1]).tobytes()
        return [data[4 * a:4 * b] for a, b in pairwise(stops)]

    def _look_up(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.ids.get, chunks))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            # What was met again since the table was last full stays; the rest is forgotten when it is full again.
            wanted = {c: self.older.get(c) for c in map(chunks.__getitem__, missing)}
            new = [c for c, ids in wanted.items() if ids is None]
            for at in range(0, len(new), 4096):
                part = new[at:at + 4096]
                wanted.update(zip(part, self._segment(part), strict=True))
            for k in missing:
                found[k] = wanted[chunks[k]]
            kept = {c: ids for c, ids in wanted.items() if len(c) <= TABLE_CHUNK}
            if len(self.ids) + len(kept) > TABLE_SIZE // 2:
                self.older, self.ids = self.ids, {}
            self.ids.update(kept)
        return found

    def _blocks(self, texts: list[str | None]):
        """Row and chunks of each block, so that no block but one of a long chunk is much over ``BLOCK`` characters."""
        for row, text in enumerate(texts):
            marked = MARK + text.replace(" ", MARK) if text else ""
            at = 0
            while at < len(marked):
                after = self.cut.search(marked, at + BLOCK) if at + BLOCK < len(marked) else None
                stop = after.start() if after else len(marked)
                yield row, stop - at, self.chunk.findall(marked, at, stop)
                at = stop

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """Ids with begin and end of each text, and what they decode to."""
        ids, decoded = [[self.begin] for _ in texts], [[] for _ in texts]
        held, chunks, size = [], [], 0

        def done():
            found = self._look_up(chunks)
            for row, start, stop in held:
                part = b"".join(found[start:stop])
                ids[row].append(part)
                # One marker more in front, since the decoder drops the first.
                decoded[row].append(self.sp.decode(np.frombuffer(self.more + part, "<i4")))

        # New chunks of many short texts are segmented in one call.
        for row, length, block in self._blocks(texts):
            if held and size + length > BLOCK:
                done()
                held, chunks, size = [], [], 0
            held.append((row, len(chunks), len(chunks) + len(block)))
            chunks += block
            size += length
        if held:
            done()
        return [b"".join([*parts, self.end]) for parts in ids], ["".join(parts)[1:] for parts in decoded]


def encode(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit, with begin and end ids) and ``decoded``.

    ``ids`` are those the library gives for the whole text, and ``decoded`` what it decodes them
    to. Null is encoded as the empty text: begin and end alone. ``model`` is a path on the driver;
    the file travels with the tasks.
    """
    with open(model or default_model(), "rb") as file:
        proto = file.read()

    def start():
        table = ChunkTable(proto)

        return table.encode

    return appended(docs, "ids binary, decoded string", start, [text])
