"""Packing of examples into training sequences: vector bin packing by the dot-product heuristic.

A sequence is a bin with three limits: tokens, segments (pieces of examples) and tokens that bear
loss. A bin takes, of the examples that still fit, the one whose demands have the largest
weighted dot product with what the bin has left; weights are the mean demands. Every task packs
the rows of its own partition from a pool of bounded size, so nothing is shuffled."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Examples that a task chooses from.
POOL = 1024

# Two readers of one vocabulary: `tokenizers` reads any text, `tiktoken` is about four times as fast.
# The second gets texts of characters whose class has been the same in every Unicode version of
# either library, and without the special token, which only the first knows.
_PLAIN = re.compile("[\\t\\n -~À-ɏЀ-ӿ\u2010-\u2027\u4e00-\u9fa5]*")
# A byte-level token never reaches from one of these characters into a blank or line feed after
# it, so a text may be encoded in pieces that end there.
_EDGE = re.compile("(?<=[!-~À-ɏ])(?=[ \\n])")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


class Encoder:
    """Texts to the ids of a byte-level tokenizer file, as little-endian unsigned 32-bit, without
    special tokens added. `ranks` is a file of the same vocabulary for plain texts, or None."""

    def __init__(self, path: str, ranks: str | None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if any(special in text for special in self.special):
            return self._any(text)
        if _PLAIN.fullmatch(text):
            return self._some(text)
        return b"".join(map(self._some, _EDGE.split(text)))

    def _some(self, text: str) -> bytes:
        if self.plain is None or not _PLAIN.fullmatch(text):
            return self._any(text)
        return self.plain.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def _any(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class Item:
    """The ids [start, end) of an example; loss[i] counts its loss-bearing ids before i."""

    __slots__ = ("row", "ids", "loss", "start", "end")

    def __init__(self, row: int, ids: np.ndarray, loss: np.ndarray, start: int, end: int) -> None:
        self.row, self.ids, self.loss, self.start, self.end = row, ids, loss, start, end

    def tokens(self) -> int:
        return self.end - self.start

    def losses(self) -> int:
        return int(self.loss[self.end] - self.loss[self.start])

    def fitting(self, tokens: int, loss: int) -> int:
        """Leading ids that stay within these limits."""
        most = int(np.searchsorted(self.loss, self.loss[self.start] + loss, side="right")) - 1
        return min(self.end, self.start + tokens, most) - self.start

    def part(self, start: int, end: int) -> Item:
        return Item(self.row, self.ids, self.loss, start, end)


class Packer:
    """Packs items as they come. With `cut`, examples are divided wherever a bin has room left, and
    a bin that cannot be filled ends at a power of two, the rest going to later bins; so no
    sequence is padded. Without, only examples beyond a limit are divided."""

    def __init__(self, limits: Limits, cut: bool) -> None:
        self.limits, self.cut = limits, cut
        self.whole = np.array([limits.tokens, limits.loss, limits.segments], float)
        self.items: list[Item] = []
        self.demands = np.zeros((0, 3))

    def add(self, items: list[Item]) -> Iterator[list[Item]]:
        """Takes items; gives the bins that these fill alone."""
        kept = []
        for item in items:
            while item.tokens():
                size = item.fitting(self.limits.tokens, self.limits.loss)
                if size == item.tokens() < self.limits.tokens:
                    kept.append(item)
                    break
                first = item.part(item.start, item.start + size)
                if size == self.limits.tokens:
                    yield [first]
                else:
                    kept.append(first)
                item = item.part(first.end, item.end)
        self._push(kept)

    def _push(self, items: list[Item]) -> None:
        if items:
            self.items += items
            new = np.array([(i.tokens(), i.losses(), 1) for i in items]) / self.whole
            self.demands = np.concatenate([self.demands, new])

    def _pop(self, at: int) -> Item:
        """Takes an item out; the last one gets its place."""
        item, last = self.items[at], self.items.pop()
        if at < len(self.items):
            self.items[at], self.demands[at] = last, self.demands[-1]
        self.demands = self.demands[:-1]
        return item

    def bins(self, leave: int) -> Iterator[list[Item]]:
        """Bins, until at most `leave` items are left."""
        while len(self.items) > leave:
            yield self._bin()

    def _bin(self) -> list[Item]:
        limits, weights = self.limits, self.demands.mean(axis=0)
        tokens, loss, held = limits.tokens, limits.loss, []
        while self.items and tokens and len(held) < limits.segments:
            left = np.array([tokens, loss, limits.segments - len(held)]) / self.whole
            score = self.demands @ (weights * left)
            fits = np.all(self.demands <= left + 1e-9, axis=1)
            if fits.any():
                item = self._pop(int(np.argmax(np.where(fits, score, -1.0))))
            elif self.cut:
                at = int(np.argmax(score))
                size = self.items[at].fitting(tokens, loss)
                if not size:
                    break
                whole = self._pop(at)
                item = whole.part(whole.start, whole.start + size)
                self._push([whole.part(item.end, whole.end)])
            else:
                break
            held.append(item)
            tokens, loss = tokens - item.tokens(), loss - item.losses()
        size = limits.tokens - tokens
        return self._shorten(held, 1 << (size.bit_length() - 1)) if self.cut and tokens else held

    def _shorten(self, held: list[Item], size: int) -> list[Item]:
        out, back = [], []
        for item in held:
            kept = min(size, item.tokens())
            if kept:
                out.append(item.part(item.start, item.start + kept))
            if kept < item.tokens():
                back.append(item.part(item.start + kept, item.end))
            size -= kept
        self._push(back)
        return out


def pack_examples(
    examples: DataFrame,
    limits: Limits | None = None,
    cut: bool = True,
    tokenizer: str = TOKENIZER,
    ranks: str | None = RANKS,
    end_id: int | None = 1,
) -> DataFrame:
    """Packs examples (doc_id, parts array<struct<text, loss>>) into sequences: one row per piece
    (doc_id, start, length, doc_tokens, loss_tokens, sequence_id, offset long, ids binary). The ids of
    an example are those of its parts in turn, without special tokens, then `end_id`, which
    bears loss if the last part does; `ids` holds the piece's as little-endian unsigned 32-bit.

    Each id lies in one piece; pieces of a sequence follow each other without gap and stay within the
    limits together. A null or empty text has no ids, a null part or parts none, a null loss
    counts as false; an example without any id gives no row. Repeated rows and null doc_ids are
    packed each for itself. Other columns are not read. What lies in one sequence depends on the
    partitions and their order, so store the result before it is used twice."""
    limits = limits or Limits()
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("every limit must be at least 1")
    kind = dict(examples.dtypes)["doc_id"]
    work = _packing_task(limits, cut, partial(Encoder, tokenizer, ranks), end_id)
    rows = examples.select("doc_id", F.col("parts.text").alias("texts"), F.col("parts.loss").alias("losses"))
    longs = "start long, length long, doc_tokens long, loss_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(work, f"doc_id {kind}, {longs}, ids binary")


def _packing_task(limits: Limits, cut: bool, encoder: Callable[[], Encoder], end_id: int | None) -> Callable:
    def examples_of(batch: pa.RecordBatch, encode: Encoder) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, loss sums) of each row."""
        texts, losses = batch.column("texts").to_pylist(), batch.column("losses").to_pylist()
        for texts_of, losses_of in zip(texts, losses, strict=True):
            parts = [encode(t or "") for t in texts_of or []]
            flags = [bool(flag) for flag in losses_of or []]
            if end_id is not None:
                parts, flags = [*parts, np.array([end_id], "<u4").tobytes()], [*flags, flags[-1] if flags else False]
            ids = np.frombuffer(b"".join(parts), "<u4")
            loss = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(np.repeat(np.array(flags, np.int64), [len(p) // 4 for p in parts]), out=loss[1:])
            yield ids, loss

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(), Packer(limits, cut)
        ids_of: dict[int, object] = {}
        next_row = 0
        sequence = TaskContext.get().partitionId() << 33
        out: list[tuple] = []

        def note(pieces: list[Item]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                ids = p.ids[p.start : p.end].tobytes()
                out.append((ids_of[p.row], p.start, p.tokens(), len(p.ids), p.losses(), sequence, offset, ids))
                offset += p.tokens()
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.binary())]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, NAMES)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids = batch.column("doc_id").to_pylist()
            for doc_id, (tokens, loss) in zip(ids, examples_of(batch, encode), strict=True):
                ids_of[next_row] = doc_id
                for full in packer.add([Item(next_row, tokens, loss, 0, len(tokens))]):
                    note(full)
                next_row += 1
                if len(packer.items) >= 2 * POOL:
                    for full in packer.bins(POOL):
                        note(full)
                    waiting = {item.row for item in packer.items}
                    ids_of = {row: ids_of[row] for row in waiting}
                if len(out) >= 2 * POOL:
                    yield flush()
        for full in packer.bins(0):
            note(full)
            if len(out) >= 2 * POOL:
                yield flush()
        if out:
            yield flush()

    return work


NAMES = ["doc_id", "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "offset", "ids"]


def documents_as_examples(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, text) as examples of one part, all of which bears loss."""
    part = F.struct(F.col("text").alias("text"), F.lit(True).alias("loss"))
    return documents.select("doc_id", F.array(part).alias("parts"))


def conversations_as_examples(conversations: DataFrame, answers: str = "assistant") -> DataFrame:
    """Conversations (conv_id, turn, role, text) as examples whose doc_id is the conv_id, with the
    turns in order; those of the role `answers` bear loss. A conversation is one row, as a model
    reads it whole."""
    turn = F.struct("turn", F.col("text"), (F.col("role") == answers).alias("loss"))
    turns = conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select("doc_id", F.transform("turns", lambda t: F.struct(t["text"].alias("text"), t["loss"].alias("loss"))).alias("parts"))
