"""Hashed counts of three-byte windows, many texts at a time."""

from dataclasses import dataclass

import numpy as np

#: Bytes of text, and cells of a matrix of counts, that a task holds at once.
SLICE = 1 << 20
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


@dataclass(frozen=True)
class Grams:
    """``bins`` is a power of two; ``letters`` lowers the case and makes all else a space."""

    bins: int
    letters: bool

    def _bytes(self, text: str | None) -> bytes:
        text = text or ""
        if self.letters:
            text = text.lower()
        data = text.encode("utf-8", "surrogatepass")
        return b"  " + (data.translate(_LETTERS) if self.letters else data) + b"  "

    def _codes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Bins of the windows, and which windows are not blank."""
        a = np.frombuffer(data, np.uint8).astype(np.uint32)
        whole = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
        bins = (whole * np.uint32(2654435761)) >> np.uint32(33 - self.bins.bit_length())
        return bins.astype(np.int64), whole != 0x202020

    def counts(self, texts: list[str | None]):
        """Yield (first row, matrix of rows by bins) until all ``texts`` are counted."""
        first, held, size, most = 0, [], 0, max(1, SLICE // self.bins)
        for row, text in enumerate(texts):
            data = self._bytes(text)
            if held and (size + len(data) > SLICE or len(held) >= most):
                yield first, self._count(held)
                first, held, size = row, [], 0
            held.append(data)
            size += len(data)
        if held:
            yield first, self._count(held)

    def _count(self, held: list[bytes]) -> np.ndarray:
        if len(held) == 1 and len(held[0]) > SLICE:
            total = np.zeros((1, self.bins))
            for at in range(0, len(held[0]) - 2, SLICE):
                bins, keep = self._codes(held[0][at:at + SLICE + 2])
                total[0] += np.bincount(bins[keep], minlength=self.bins)
            return total
        bins, keep = self._codes(b"".join(held))
        rows = np.repeat(np.arange(len(held)) * self.bins, [len(x) for x in held])[:len(bins)]
        return np.bincount((bins + rows)[keep], minlength=len(held) * self.bins).reshape(len(held), self.bins)
