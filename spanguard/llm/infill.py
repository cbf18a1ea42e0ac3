"""Fill-in-the-middle: each text is cut at two random places, and its parts are put in another order.

Places are ranks of units, and units begin where two adjacent bytes say so: a code point begins at
every byte that doesn't continue one, a word at a byte behind white space, a line behind its end. A text is
therefore decomposed into chunks of ``CHUNK`` bytes that overlap by one byte. Each chunk
counts the units that begin in it, prefix sums of the counts send both ranks to the chunks that own them, and only
those are scanned again for the byte. Nothing but one chunk's flags is ever held besides the text, whatever its length.

Random numbers are groups of 8 hexadecimal digits of the sha256 of ``seed:id``, so every row is decided alone.
Prefix, middle and suffix lie between the smaller and the larger of two ranks. A text is left
plain if it is empty, contains a marker, or by chance; else the order is suffix-prefix-middle or
prefix-suffix-middle. A plain text stands for itself, and in others the markers are found again, as no marker
stands in a part and none can begin in a part and end in a marker: the exact text can be rebuilt (``restore``).

Defined results: a null text is taken as empty (n 0, plain); a null id draws as the empty string;
rows of equal ids have equal draws; an empty table gives an empty one; columns of the input named as those that are added are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of a chunk.
CHUNK = 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Whether a unit begins at a byte, by the byte before and the byte itself. Every text's first byte begins one.
UNITS = {
    "chars": lambda before, at: (at & 0xC0) != 0x80,
    "words": lambda before, at: _SPACE[before] & ~_SPACE[at],
    "lines": lambda before, at: before == 0x0A,
}


class Chunks:
    """The units of one text (UTF-8 bytes), counted by chunk."""

    def __init__(self, data: np.ndarray, unit: str = "chars", chunk: int = CHUNK):
        self.data, self.begins, self.chunk = data, UNITS[unit], chunk
        self.ends = np.cumsum([np.count_nonzero(self._flags(a)) for a in range(0, len(data), chunk)], dtype=np.int64)

    def _flags(self, start: int) -> np.ndarray:
        """Where units begin in the chunk at ``start``, which is read from a byte before it on."""
        part = self.data[max(start - 1, 0) : start + self.chunk]
        flags = self.begins(part[:-1], part[1:])
        return flags if start else np.concatenate(([True], flags))

    @property
    def n(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def place(self, rank: int) -> int:
        """The byte at which unit ``rank`` begins; of the rank behind the last unit, the text's length."""
        if rank >= self.n:
            return len(self.data)
        owner = int(np.searchsorted(self.ends, rank, "right"))
        before = int(self.ends[owner - 1]) if owner else 0
        return owner * self.chunk + int(np.flatnonzero(self._flags(owner * self.chunk))[rank - before])


def draws(doc_id, seed: int) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def infill(doc_id, text: bytes, seed: int = 1, rate: int = 90, spm_rate: int = 20, unit: str = "chars", chunk: int = CHUNK) -> tuple[int, str, int | None, int | None, list[bytes]]:
    """Units, form, units of prefix and middle (None if plain), and the pieces whose concatenation is the output."""
    chunks, (h1, h2, h3, h4) = Chunks(np.frombuffer(text, np.uint8), unit, chunk), draws(doc_id, seed)
    n = chunks.n
    if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, [text]
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j, view = chunks.place(a), chunks.place(b), memoryview(text)
    prefix, middle, suffix = view[:i], view[i:j], view[j:]
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle]
    return n, "psm", a, b - a, [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]


def restore(output: bytes, form: str) -> bytes:
    """The text that ``output`` was made of."""
    if form == "plain":
        return output
    second, third = (SUFFIX, MIDDLE) if form == "psm" else (PREFIX, MIDDLE)
    at = output.index(second)
    end = output.index(third, at)
    one, two, three = output[3:at], output[at + 3 : end], output[end + 3 :]
    return one + three + two if form == "psm" else two + three + one


def _digest(pieces) -> str:
    h = hashlib.sha256()
    for p in pieces:
        h.update(p)
    return h.hexdigest()


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20, unit: str = "chars", digests: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n, form, prefix_chars, middle_chars (units; null if plain) and output; with ``digests`` of output and restored text instead.

    ``rate`` of 100 texts are cut, ``spm_rate`` of 100 of those begin with the suffix.
    """
    last = ("output_sha256 string, restored_sha256 string", "output string")[not digests]
    fields = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), *([("output_sha256", pa.string()), ("restored_sha256", pa.string())] if digests else [("output", pa.string())])]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                *facts, pieces = infill(doc_id, text, seed, rate, spm_rate, unit)
                if digests:
                    output = b"".join(pieces)
                    rows.append((*facts, _digest([output]), _digest([restore(output, facts[1])])))
                else:
                    rows.append((*facts, b"".join(pieces).decode()))
            columns = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *(name for name, _ in fields)])

        return step

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, {last}"
    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")), make, schema)
