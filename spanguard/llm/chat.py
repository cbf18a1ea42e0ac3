"""Chat formatting with a loss mask that is aligned by offsets.

A whole conversation is rendered once, its turns' spans are noted as it is written, the rendered
text is encoded once with offsets, and the mask of the tokens comes from a binary search of the
sorted spans among the sorted token offsets.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline for each turn. A control
string inside a role or text gets a backslash behind its ``<`` (one more where there are some
already), so no text holds a marker and the escape can be undone. In a role, backslashes and
newlines are escaped too.

Defined results: null role or text is empty; turns are ordered by turn, then role, then text,
nulls first, so ties and repeated rows have one order; a null conversation id is a conversation
of its own; an empty table gives an empty result; other columns of the input are ignored.
Conversations are streamed through sorted partitions, one at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, run_batches

START, END = "<|im_start|>", "<|im_end|>"
_RAISE, _LOWER = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _RAISE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _LOWER.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]]]:
    """The formatted text, and start, end and whether it is learned of each turn's text."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        out += [head, body, END, "\n"]
        at += len(head)
        spans.append((at, at + len(body), role == "assistant"))
        at += len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest[: -len(END) - 1])))
    return turns


def token_mask(offsets, spans: list[tuple[int, int, bool]]) -> np.ndarray:
    """Whether a token shares a character with a learned span; both lists are sorted."""
    at = np.asarray(offsets, np.int64).reshape(-1, 2)
    mask = np.zeros(len(at), bool)
    learned = np.array([(a, b) for a, b, on in spans if on and a < b], np.int64).reshape(-1, 2)
    first, stop = np.searchsorted(at[:, 1], learned[:, 0], "right"), np.searchsorted(at[:, 0], learned[:, 1], "left")
    for i, j in zip(first.tolist(), stop.tolist()):
        mask[i:j] = True
    return mask


def masked_text(formatted: str, offsets, mask, spans: list[tuple[int, int, bool]]) -> list[str]:
    """The text under the mask within each learned span, by the tokens' offsets."""
    at = np.asarray(offsets, np.int64).reshape(-1, 2)
    begin, end, on = np.ascontiguousarray(at[:, 0]), np.ascontiguousarray(at[:, 1]), np.asarray(mask, bool)
    starts, ends, out = [], [], []
    for a, b, learned in spans:
        if not learned:
            continue
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(begin, b, "left")
        if i < j and on[i:j].all() and (begin[i + 1 : j] <= end[i : j - 1]).all():  # no gap between the tokens
            out.append(formatted[max(a, begin[i]) : min(b, end[j - 1])])
            continue
        starts, ends = starts or begin.tolist(), ends or end.tolist()
        parts, done = [], a
        k = max(0, bisect_right(starts, a) - 1)
        while k < len(starts) and starts[k] < b:
            if on[k] and ends[k] > done:  # the tokens of one character share its offsets
                parts.append(formatted[max(done, starts[k]) : min(b, ends[k])])
                done = min(b, ends[k])
            k += 1
        out.append("".join(parts))
    return out


def chat_tokenizer(definition: bytes):
    """A tokenizer of the ``tokenizers`` library with the template's markers as further tokens."""
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_buffer(definition)
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets cover white space too
    t.add_special_tokens([AddedToken(m, normalized=False) for m in (START, END)])
    return t


#: Splits a text before the merges, in byte-level definitions without a pattern of their own (fixed value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_ranks(definition: dict) -> dict[bytes, int] | None:
    """The tokens' bytes and ids of a plain byte-level BPE whose ids follow its merges; None of any other kind."""
    split, model = definition.get("pre_tokenizer") or {}, definition.get("model") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and definition.get("normalizer") is None
    if not plain or model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    # printable bytes stand for themselves, the others for the characters from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {t["content"] for t in definition.get("added_tokens", [])}
    if any(not byte.keys() >= set(t) for t in model["vocab"] if t not in added):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [ranks.get(bytes(byte[c] for c in x + y)) for x, y in merges]
    whole = len(ranks) == len(made) + 256 and None not in made and all(x < y for x, y in zip(made, made[1:])) and (not made or made[0] >= 256)
    return ranks if whole else None


class Encoder:
    """Ids and character offsets of a formatted text.

    A plain byte-level BPE goes by ``tiktoken``: its tokens' lengths in bytes add up to the offsets.
    Any other definition goes by the ``tokenizers`` library, and so does a text with a run of white
    space that is too long for the other's pattern; the results are the same.
    """

    def __init__(self, definition: bytes):
        self.definition, self._library, self.fast = definition, None, None
        ranks = _byte_ranks(json.loads(definition))
        if ranks:
            import tiktoken

            known = self.library.get_vocab(with_added_tokens=True)
            marks = {m: known[m] for m in (START, END)}
            self.fast = tiktoken.Encoding("chat", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=marks)
            self.lengths = np.zeros(max(known.values()) + 1, np.int64)
            for token, i in (ranks | {m.encode(): i for m, i in marks.items()}).items():
                self.lengths[i] = len(token)

    @property
    def library(self):
        if self._library is None:
            self._library = chat_tokenizer(self.definition)
        return self._library

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        if self.fast:
            try:
                ids = self.fast.encode(text, allowed_special="all")
            except ValueError:
                pass
            else:
                sizes = self.lengths[ids]
                end = np.cumsum(sizes)
                if text.isascii():
                    return ids, np.column_stack([end - sizes, end])
                char = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1  # of each byte
                return ids, np.column_stack([char[end - sizes], char[end - 1] + 1])
        enc = self.library.encode(text, add_special_tokens=False)
        return enc.ids, np.array(enc.offsets, np.int64).reshape(-1, 2)


SCHEMA = "conv_id long, turns array<struct<role: string, text: string>>, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_texts array<string>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _sha(parts) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p.encode())
    return h.hexdigest()


def format_conversations(rows: DataFrame, tokenizer: bytes, digests: bool = False) -> DataFrame:
    """One row a conversation: its formatted text, ids, mask and the texts under the mask.

    With ``digests``, the columns of ``DIGESTS`` instead, read back from the formatted text.
    """
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = DIGESTS if digests else SCHEMA

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        if not digests:
            kinds = [pa.int64(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f.split()[0] for f in re.sub("<.*?>+", "", schema).split(", ")])

    def run(batches):
        encoder = Encoder(tokenizer)

        def finish(conv, turns):
            formatted, spans = render(turns)
            ids, offsets = encoder.encode(formatted)
            mask = token_mask(offsets, spans)
            texts = [unescape(x) for x in masked_text(formatted, offsets, mask, spans)]
            if not digests:
                return conv, [{"role": r, "text": x} for r, x in turns], formatted, ids, mask.tolist(), texts
            back = parse(formatted)
            return conv, len(back), _sha(p for r, x in back for p in (r, "\n", x, "\n")), sum(map(len, texts)), _sha(texts), len(formatted)

        conv, turns, begun, out = None, [], False, []
        for batch in batches:
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if begun and c != conv:
                    out.append(finish(conv, turns))
                    turns = []
                    if len(out) >= BATCH_ROWS:
                        yield batch_of(out)
                        out = []
                conv, begun = c, True
                turns.append((role, text))
        if begun:
            out.append(finish(conv, turns))
        if out:
            yield batch_of(out)

    return run_batches(rows, run, schema)
