"""Language-model scores: the likelihood of a text over all its segmentations into pieces."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored
from spendlens.llm.text import SPACED, Words, prefix_hashes, slices, span_hashes

#: The piece vocabulary; only its pieces and their order are used.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Longer pieces (0.3 % of a usual vocabulary, mostly runs of one sign) are left out.
PIECE_BYTES = 16
#: The most frequent words, whose scores are broadcast (some 8 MB); all others are joined.
FREQUENT = 200_000
_SLOTS = 1 << 20
_LOG10 = np.log(10.0)


@dataclass
class Pieces:
    """Pieces as bytes, a leading space marking the start of a word, and their log probabilities."""

    log_p: np.ndarray
    hashes: np.ndarray
    #: Slot of a hash -> piece, or -1; pieces that share a slot are in `more`, sorted by hash.
    slots: np.ndarray
    more: np.ndarray

    @staticmethod
    def of(texts: list[bytes], log_p: np.ndarray) -> Pieces:
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        hashes = span_hashes(prefix_hashes(data, False), ends - [len(t) for t in texts], ends)
        slots = np.full(_SLOTS, -1, np.int32)
        at = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        slots[at] = np.arange(len(texts))
        more = np.flatnonzero(slots[at] != np.arange(len(texts)))
        slots[at[more]] = -2
        crowded = np.flatnonzero(slots[at] == -2)
        return Pieces(log_p, hashes, slots, crowded[np.argsort(hashes[crowded])])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        found = self.slots[(hashes & np.uint64(_SLOTS - 1)).astype(np.int64)]
        crowded = np.flatnonzero(found == -2)
        if len(crowded):
            keys = self.hashes[self.more]
            place = np.minimum(np.searchsorted(keys, hashes[crowded]), len(keys) - 1)
            found[crowded] = np.where(keys[place] == hashes[crowded], self.more[place], -1)
        found[(found >= 0) & (self.hashes[found] != hashes)] = -1
        return found


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces of a vocabulary file in lower case, weighted by rank (Zipf) until they are fitted.
    Every byte is a piece of small weight, so that every word has a segmentation."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if piece == piece.lower() and b" " not in piece[1:] and len(piece) <= PIECE_BYTES:
                texts.setdefault(piece, 1.0 / (10 + len(texts)))
    for b in range(256):
        texts.setdefault(bytes([b]), 1e-6)
    weights = np.array(list(texts.values()))
    return Pieces.of(list(texts), np.log(weights / weights.sum()))


def _groups(words: list[bytes], limit: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words by length, each with a leading space: (their indexes, bytes [n, length])."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        length = int(lengths[order[start]])
        stop = int(np.searchsorted(lengths[order], length, "right"))
        stop = min(stop, start + max(1, limit // (length + 1)))
        at = order[start:stop]
        data = np.frombuffer(b"".join(b" " + words[i] for i in at.tolist()), np.uint8)
        yield at, data.reshape(len(at), length + 1)
        start = stop


def _edges(pieces: Pieces, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each end j: (j, pieces [n, k], log probabilities), column k being the piece that starts
    at j - 1 - k."""
    n, length = data.shape
    flat = np.ascontiguousarray(data).ravel()
    prefix = prefix_hashes(flat, False)
    base = np.arange(n) * length
    for j in range(1, length + 1):
        reach = min(j, PIECE_BYTES)
        starts = base[:, None] + j - 1 - np.arange(reach)
        ends = np.broadcast_to((base + j)[:, None], starts.shape)
        found = pieces.find(span_hashes(prefix, starts.ravel(), ends.ravel())).reshape(n, reach)
        yield j, found, np.where(found >= 0, pieces.log_p[found], -np.inf)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - safe[:, None]).sum(axis=1)) + safe


def lattice_log_probability(pieces: Pieces, words: list[bytes]) -> np.ndarray:
    """The log probability of each word, summed over all segmentations by the forward recursion."""
    out = np.zeros(len(words))
    for at, data in _groups(words):
        forward = np.zeros((len(at), data.shape[1] + 1))
        for j, found, log_p in _edges(pieces, data):
            forward[:, j] = _log_sum(forward[:, j - 1 :: -1][:, : found.shape[1]] + log_p)
        out[at] = forward[:, -1]
    return out


def expected_counts(pieces: Pieces, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """How often each piece occurs in the words, over all segmentations by their probability."""
    out = np.zeros(len(pieces.log_p))
    for at, data in _groups(words):
        n, length = data.shape
        forward = np.zeros((n, length + 1))
        kept = list(_edges(pieces, data))
        for j, found, log_p in kept:
            forward[:, j] = _log_sum(forward[:, j - 1 :: -1][:, : found.shape[1]] + log_p)
        backward = np.full((n, length + 1), -np.inf)
        backward[:, -1] = 0
        for j, found, log_p in reversed(kept):
            through = log_p + backward[:, j][:, None]
            part = backward[:, max(0, j - PIECE_BYTES) : j][:, ::-1]
            part[:] = np.logaddexp(part, through)
            share = np.exp(forward[:, j - 1 :: -1][:, : found.shape[1]] + through - forward[:, -1:])
            some = found >= 0
            out += np.bincount(found[some], (share * counts[at][:, None])[some], len(out))
    return out


def word_counts(documents: DataFrame) -> DataFrame:
    """(word binary, n long, n_all long) of documents (text, train boolean): occurrences in the
    training texts and in all texts. Words are what ASCII white space divides, A-Z lower-cased."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = np.asarray(batch.column("train").to_pylist(), bool)
            seen, sums, firsts = [np.zeros(0, np.uint64)], [np.zeros((2, 0), np.int64)], []
            for first, texts in slices(batch.column("text").to_pylist()):
                words = Words(texts, SPACED)
                of = np.repeat(train[first : first + len(texts)], words.counts)
                some, at, back, n_all = np.unique(words.hashes, return_index=True, return_inverse=True, return_counts=True)
                n = np.bincount(back, of, len(some)).astype(np.int64)
                seen.append(some)
                sums.append(np.stack((n, n_all)))
                firsts.extend(map(words.word, at.tolist()))
            some, at, back = np.unique(np.concatenate(seen), return_index=True, return_inverse=True)
            n, n_all = (np.bincount(back, x, len(some)).astype(np.int64) for x in np.concatenate(sums, axis=1))
            word = pa.array([firsts[i] for i in at.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([word, pa.array(n), pa.array(n_all)], ["word", "n", "n_all"])

    rows = documents.select(F.col("text").cast("binary").alias("text"), F.coalesce("train", F.lit(False)).alias("train"))
    return rows.mapInArrow(count, "word binary, n long, n_all long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def fit_pieces(counts: DataFrame, pieces: Pieces, rounds: int = 2, smoothing: float = 0.01) -> Pieces:
    """The probabilities of the pieces by expectation maximisation over the distinct training
    words, once each: that is what absolute discounting leaves of each word for its segmentations.
    A round sums expected counts on the executors; the driver gets one number per piece."""
    rows = counts.filter("n > 0").select("word", F.lit(1).cast("long").alias("n"))
    for _ in range(rounds):
        held = counts.sparkSession.sparkContext.broadcast(pieces)

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(held.value.log_p))
            for batch in batches:
                sums += expected_counts(held.value, batch.column("word").to_pylist(), np.asarray(batch.column("n")))
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["piece", "n"])

        found = rows.mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        sums = np.full(len(pieces.log_p), smoothing)
        sums[found["piece"].to_numpy(np.int64)] += found["n"].to_numpy(float)
        pieces = Pieces(np.log(sums / sums.sum()), pieces.hashes, pieces.slots, pieces.more)
    return pieces


def score_texts(
    documents: DataFrame,
    vocabulary: str = VOCABULARY,
    rounds: int = 2,
    discount: float = 0.75,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Scores documents (doc_id, text, train boolean), learning from those with train: one row
    (doc_id, train, n_tokens long, n_known long, train_tokens long, base_score double, score
    double) per row. A null text is the empty one; a null train is false. Other columns are
    ignored; repeated rows each get their scores.

    Tokens are words and one end per text. base_score is the smoothed unigram score of whole
    words: the sum of log10((c + 0.5) / (N + 0.5 * (V + 1))). score is the log10 probability of
    the text under the lattice: each word is followed through all segmentations into the pieces of
    `vocabulary`, whose probabilities are fitted on the training words, and as one more edge the
    whole word, if it occurs in training, with its count less `discount`. What the discount leaves
    is the weight of the segmentations, so that the words' probabilities sum to one. The text ends
    after each word with the share of ends among the training tokens.

    Every distinct word is segmented once. The scores of the most frequent words, `frequent` of them
    at most, are broadcast; the other words of each text are joined with the table of words by hash."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("train", F.lit(False)).alias("train"))
    counts = stored(word_counts(docs), "word-counts")
    ends = docs.filter("train").count()
    n_words, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    total, distinct = n_words + ends, kinds + (ends > 0)
    end = (ends + 0.5) / (total + 1)
    pieces = spark.sparkContext.broadcast(fit_pieces(counts, load_pieces(vocabulary), rounds))

    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
            log_p = lattice_log_probability(pieces.value, words)
            if n_words:
                left = discount * kinds / n_words
                whole = np.log(np.maximum(n - discount, 1e-300) / n_words)
                log_p = np.logaddexp(log_p + np.log(left), np.where(n > 0, whole, -np.inf))
            score = log_p / _LOG10 + np.log10(1 - end)
            hashes = Words([w + b" " for w in words], SPACED).hashes.view(np.int64)
            columns = [hashes, n, np.asarray(batch.column("n_all")), score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "n", "n_all", "score"])

    table = stored(counts.mapInArrow(segment, "word long, n long, n_all long, score double"), "word-scores")
    # Words by eighths of a power of two of their count, as many classes from the top as have room.
    size = F.floor(F.log2(F.col("n_all").cast("double")) * 8).cast("int")
    room, least = frequent, None
    for row in table.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["size"]
    top = table.filter(size >= least if least is not None else F.lit(False)).select("word", "n", "score").toPandas()
    top = top.assign(word=top["word"].to_numpy(np.int64).view(np.uint64)).sort_values("word")
    known = spark.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("word", "n", "score")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n_of, score_of = known.value
        base_of = base(n_of)
        for batch in batches:
            parts = [[], [], [], [], []]
            for _, texts in slices(batch.column("text").to_pylist()):
                words = Words(texts, SPACED)
                owner = np.repeat(np.arange(len(texts)), words.counts)
                place = np.minimum(np.searchsorted(keys, words.hashes), max(0, len(keys) - 1))
                hit = keys[place] == words.hashes if len(keys) else np.zeros(len(owner), bool)
                at, to = place[hit], owner[hit]
                parts[0].append(words.counts + 1)
                parts[1].append(np.bincount(to, n_of[at] > 0, len(texts)).astype(np.int64) + (ends > 0))
                parts[2].append(np.bincount(to, base_of[at], len(texts)) + base(ends))
                parts[3].append(np.bincount(to, score_of[at], len(texts)) + np.log10(end))
                rest = words.hashes[~hit].view(np.int64)
                bounds = np.append(0, np.cumsum(np.bincount(owner[~hit], minlength=len(texts))))
                parts[4].extend(rest[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))
            columns = [pa.array(np.concatenate(p)) for p in parts[:4]] + [pa.array(parts[4], pa.list_(pa.int64()))]
            names = ["n_tokens", "n_known", "base_score", "score", "rest"]
            kept = [batch.column("doc_id"), batch.column("train")]
            yield pa.RecordBatch.from_arrays(kept + columns, ["doc_id", "train", *names])

    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, train boolean, n_tokens long, n_known long, base_score double, score double, rest array<long>"
    found = stored(docs.mapInArrow(look_up, schema).withColumn("row", F.monotonically_increasing_id()), "looked-up")
    rest = found.select("row", F.explode("rest").alias("word")).join(table.select("word", "n", "score"), "word")
    floor = total + 0.5 * (distinct + 1)
    sums = rest.groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("more_known"),
        F.sum(F.log10((F.col("n") + 0.5) / F.lit(float(floor)))).alias("more_base"),
        F.sum("score").alias("more_score"),
    )
    return found.drop("rest").join(sums, "row", "left").select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
