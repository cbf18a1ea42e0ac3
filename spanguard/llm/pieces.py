"""SentencePiece BPE encoding and decoding with a table of each prefix's last token.

For merge-type models the encoding of a text's prefix ends in one token that depends on the
prefix alone: the only vocabulary match ending there that can stand beside the last token of
the prefix before it. So one pass over the text fills a table (an automaton lists the matches
that end at each character, a memo answers whether two tokens can be neighbours), and the ids
are read from the table backwards.

Texts are cut before white-space marks first, as no piece holds a mark behind another character,
and the ids of a cut are kept in a bounded memo.

Defined results: a null text is taken as empty and has no ids; repeated and very long texts are
encoded like any other; further input columns are ignored by ``encode_documents``.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keep, map_batches

MARK = "▁"
#: Entries of a worker's memo of cuts, and of its memo of neighbouring tokens (some 200 and 100 bytes each).
MEMO = 600_000
_CUTS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class PieceModel:
    """The pieces of a SentencePiece BPE model with byte fallback, identity rules and a dummy prefix."""

    def __init__(self, model: bytes):
        import sentencepiece  # reads the vocabulary; encoding and decoding are done here

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        self.pieces = [sp.id_to_piece(i) for i in ids]
        self.special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i)}
        self.byte_id = {int(_BYTE.fullmatch(self.pieces[i])[1], 16): i for i in ids if sp.is_byte(i)}
        plain = [i for i in ids if not (i in self.special or sp.is_byte(i) or sp.is_unused(i))]
        self.id_of = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            piece = self.pieces[i]
            # every piece that ends where this one does, the longest first
            ends = [(len(piece) - k, self.id_of[piece[k:]]) for k in range(len(piece)) if piece[k:] in self.id_of]
            self.automaton.add_word(piece, ends)
        self.automaton.make_automaton()
        self.whole = {i: self.merged(self.pieces[i]) == [self.pieces[i]] for i in plain}
        self.beside: dict[int, bool] = {}
        self.cuts = _Cuts(self)
        unknown = " ⁇ ".encode()
        # control tokens have no text; what stands for them here isn't UTF-8, so they take the longer way
        self.out = [b"\xff" if i in self.special and not sp.is_unknown(i) else unknown if sp.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        for b, i in self.byte_id.items():
            self.out[i] = bytes([b])
        self.silent = {str(i) for i in self.special if sp.is_control(i)}
        self.bytes_ids = set(self.byte_id.values())
        self.out_of = {str(i): x for i, x in enumerate(self.out)}

    def merged(self, text: str) -> list[str]:
        """Highest score first, then leftmost: the definition, for the few characters of two tokens."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when they stand side by side."""
        key = left << 20 | right
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) >= MEMO:
                self.beside.clear()
            a, b = self.pieces[left], self.pieces[right]
            known = self.beside[key] = self.merged(a + b) == [a, b]
        return known

    def cut_ids(self, cut: str) -> list[int]:
        """Ids of one cut; a character without a piece becomes its bytes."""
        n = len(cut)
        #: id of the last token of each prefix, or -1 for a character without a piece
        last, begins = [-1] * (n + 1), list(range(-1, n))
        beside, whole = self.beside, self.whole
        for end, found in self.automaton.iter(cut):
            if last[end + 1] >= 0:
                continue
            for length, piece in found:
                j = end + 1 - length
                if j == 0:
                    known = whole[piece]
                elif last[j] < 0:
                    known = whole[piece]  # nothing merges with what stands before
                else:
                    known = beside.get(last[j] << 20 | piece)
                    if known is None:
                        known = self.fits(last[j], piece)
                if known:
                    last[end + 1], begins[end + 1] = piece, j
                    break
        out, i = [], n
        while i:
            if last[i] >= 0:
                out.append(last[i])
            else:
                out += [self.byte_id[b] for b in reversed(cut[i - 1].encode())]
            i = begins[i]
        return out[::-1]

    def joined(self, text: str | None) -> str:
        """The decimal ids of a whole text, joined by commas."""
        if not text:
            return ""
        return ",".join(map(self.cuts.__getitem__, _CUTS.findall(MARK + text.replace(" ", MARK))))

    def encode(self, text: str | None) -> list[int]:
        return [int(x) for x in self.joined(text).split(",") if x]

    def decode_joined(self, ids: str) -> str:
        """The library's text of comma-joined decimal ids."""
        if not ids:
            return ""
        parts = ids.split(",")
        raw = b"".join(map(self.out_of.__getitem__, parts))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_runs([int(x) for x in parts])
        first = next((int(x) for x in parts if x not in self.silent), 0)
        return text[1:] if self.pieces[first].startswith(MARK) else text

    def _decode_runs(self, ids: list[int]) -> str:
        """Byte tokens that aren't UTF-8 become a replacement character for each byte."""
        out, run = [], b""
        for i in [*ids, None]:
            if i in self.bytes_ids:
                run += self.out[i]
                continue
            while run:
                for n in range(1, min(4, len(run)) + 1):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    run = run[1:]
            if i is not None and str(i) not in self.silent:
                out.append(self.out[i].decode())
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.decode_joined(",".join(map(str, ids)))


class _Cuts(dict):
    def __init__(self, model: PieceModel):
        self.model = model

    def __missing__(self, cut: str) -> str:
        ids = ",".join(map(str, self.model.cut_ids(cut)))
        if len(cut) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[cut] = ids
        return ids


def held_model(model: bytes) -> PieceModel:
    """The model with its memos, kept from task to task until the Python worker does something else."""
    return keep(owner_of(model), lambda: PieceModel(model))


def owner_of(model: bytes) -> str:
    return f"pieces {hashlib.sha256(model).hexdigest()}"


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Rows doc_id, ids array<int>, decoded string; with ``digests`` their count and SHA-256 instead.

    ``model`` holds the bytes of the model's file, so executors need no copy of it.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def plain():
        m = held_model(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            joined = [m.joined(t) for t in batch.column("text").to_pylist()]
            ids = pa.array([[int(x) for x in j.split(",")] if j else [] for j in joined], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array([m.decode_joined(j) for j in joined], pa.string())], names=["doc_id", "ids", "decoded"])

        return step

    def digest():
        m = held_model(model)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, a, b = [], [], []
            for t in batch.column("text").to_pylist():
                ids = m.joined(t)
                n.append(ids.count(",") + 1 if ids else 0)
                a.append(sha(ids))
                b.append(sha(m.decode_joined(ids)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    if digests:
        return map_batches(rows, digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", owner_of(model))
    return map_batches(rows, plain, "doc_id long, ids array<int>, decoded string", owner_of(model))
