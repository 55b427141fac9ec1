"""Whitening, periodic runs and packing against brute force, on rows with nulls, empty and long texts,
ties, repeated rows and clashing column names; and on empty tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SMALL, llm, words  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlens.llm.packing import (
    RANKS,
    TOKENIZER,
    Encoder,
    Limits,
    conversations_as_examples,
    documents_as_examples,
    pack_examples,
)
from spendlens.llm.periodic import compared_runs, find_runs, periodic_runs
from spendlens.llm.queries import QUERIES, planted_repetition
from spendlens.llm.whitening import (
    _limbs,
    _products,
    characteristic_polynomial,
    largest_roots,
    null_space,
    roots_above,
    whiten,
)

# 11: whitening


def reference_whitening(rows, scale=64):
    """By width: n, sums, eigenvalues, vectors as columns, trace, from doubles."""
    x = {}
    for i, e in rows:
        if e and None not in e and np.isfinite(e).all():
            x.setdefault(len(e), []).append((i, np.floor(scale * np.array(e, float))))
    out = {}
    for width, own in x.items():
        fit = np.unique(np.stack([v for _, v in own]), axis=0)
        centred = fit - fit.mean(axis=0)
        values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
        out[width] = (own, len(fit), fit, values[::-1], vectors[:, ::-1])
    return out


def same_up_to_sign(found, want, tolerance):
    found, want = np.asarray(found), np.asarray(want)
    for c in range(want.shape[1]):
        a, b = found[:, c], want[:, c]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < tolerance, c


def test_whitening_query(llm):
    table = llm.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in table.collect()]
    own, n, fit, values, vectors = reference_whitening(rows)[64]
    found = QUERIES["op11_whitening"](llm, SMALL).collect()
    assert len(found) == 16 * len(rows)
    by_row = defaultdict(dict)
    for r in found:
        by_row[r.vec_id][r.component] = r
    want, got = [], []
    for i, x in own:
        r = by_row[i]
        assert sorted(r) == list(range(1, 17))
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, fit.sum(axis=0), strict=True))
        assert all((c.n, c.deviation) == (n, deviation) and c.identity_error < 1e-9 for c in r.values())
        assert all(abs(r[k].explained / (values[k - 1] / values.sum()) - 1) < 1e-9 for k in r)
        want.append((x - fit.mean(axis=0)) @ vectors[:, :16] / np.sqrt(values[:16]))
        got.append([r[k].whitened for k in range(1, 17)])
    same_up_to_sign(got, want, 1e-6)


def test_whitening_of_unusual_rows(llm):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=5) * [3, 2, 1, 0.5, 0]).tolist()) for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(40)] + [(None, rows[4][1]), (7, rows[7][1])]
    rows += [(300 + i, [float(i % 3), 1e12 * (i % 4)]) for i in range(24)]  # another width, large entries
    rows += [(400, [2.5]), (401, [2.5]), (402, None), (403, []), (404, [1.0, None]), (405, [math.nan] * 5), (406, [math.inf] * 5), (407, [1e300] * 5)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("width", F.lit("w")).repartition(3)
    found = whiten(frame, n_components=4).collect()
    usable = [r for r in rows if r[0] not in (402, 403, 404, 405, 406, 407)]
    assert Counter(r.vec_id for r in found) == Counter(r[0] for r in usable)
    for width, (own, n, fit, values, vectors) in reference_whitening(usable).items():
        mine = [r for r in found if r.width == width]
        rank = min(4, int((values > 1e-6).sum()))
        assert {r.n for r in mine} == {n} and {len(r.whitened) for r in mine} == {rank}
        assert {r.identity_error is None or r.identity_error < 1e-9 for r in mine} == {True}
        if width == 1:
            assert all(r.identity_error is None and r.deviation == 0 for r in mine)
        else:
            assert np.allclose(mine[0].eigenvalues, values[:rank], rtol=1e-9)
        sums = [sum(int(v) for v in column) for column in fit.T]
        exact = Counter((i, sum((n * int(a) - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in own)
        assert Counter((r.vec_id, int(r.deviation)) for r in mine) == exact


def test_whitening_of_equal_eigenvalues_and_empty_tables(llm):
    # The corners of a cube: one eigenvalue three times, so only the space is determined.
    corners = [[float(i >> k & 1) for k in range(3)] + [0.0] for i in range(8)]
    found = whiten(llm.createDataFrame(list(enumerate(corners)), "vec_id int, embedding array<float>")).collect()
    w = np.array([r.whitened for r in found])
    assert w.shape == (8, 3) and np.abs(w.T @ w / 8 - np.eye(3)).max() < 1e-12
    assert all(abs(v / 1024 - 1) < 1e-12 for v in found[0].eigenvalues)
    assert whiten(llm.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert whiten(llm.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_exact_parts_of_whitening(llm):
    rng = np.random.default_rng(2)
    for top in (3, 1 << 24, 1 << 38, 1 << 50, 1 << 60):
        x = rng.integers(-top, top, (9, 4))
        assert (_products(x) == x.astype(object).T @ x.astype(object)).all()
    for v in (0, -1, 7 << 80, -(3 << 150)):
        assert sum(limb << (40 * k) for k, limb in enumerate(_limbs(v))) == v
    a = rng.integers(-50, 50, (7, 7)).astype(object)
    scatter = a.T @ a
    poly = characteristic_polynomial(llm, scatter)
    assert poly[-1] == 1 and poly[-2] == -int(np.trace(scatter)) and abs(poly[0] / np.linalg.det(a.astype(float)) ** 2 + 1) < 1e-6
    values = np.linalg.eigvalsh(scatter.astype(float))[::-1]
    assert np.allclose([r / 2**s for r, s in largest_roots(poly, 7)], values, rtol=1e-9)
    assert [roots_above(poly, int(v)) for v in values] == list(range(1, 8))
    # Roots that nearly agree are told apart, and those that agree are counted.
    near = np.diag([10**30 + 1, 10**30, 10**30, 5]).astype(object)
    roots = largest_roots(characteristic_polynomial(llm, near), 4)
    assert [(r + (1 << s) // 2) >> s for r, s in roots] == [10**30 + 1, 10**30, 10**30, 5]
    vector = null_space(near, *roots[0], 1, 101)
    assert np.abs(np.abs(vector[0]) - [1, 0, 0, 0]).max() < 1e-15


# 12: periodic runs


def runs_of(w, min_length=6, min_exponent=4):
    found = {}
    for p in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(min_length, min_exponent * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapse(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_texts(count):
    rng = random.Random(8)
    for _ in range(count):
        kinds, n = rng.choice([1, 2, 3, 40]), rng.choice([0, 1, 5, 6, 30, 90, 300])
        w = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        for _ in range(rng.randrange(4) if n > 10 else 0):
            p, a = rng.randint(1, n // 5), rng.randrange(n)
            for i in range(a + p, min(n, a + p * rng.randint(3, 7) + rng.randint(0, p))):
                w[i] = w[i - p]
        yield w


def test_periodic_runs(llm):
    texts = [" ".join(w) for w in random_texts(400)]
    texts += ["", "  \n ", "A a A a A a A a", "é é é é é é é", " ".join(["x"] * 3000 + ["y", "z"] * 4000), "one"]
    rows = [(n, t) for n, t in enumerate(texts)] + [(None, None), (None, "b " * 6), (3, texts[3]), (3, texts[3])]
    frame = llm.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("r")).withColumn("start", F.lit(1)).repartition(3)
    for min_length, min_exponent in ((6, 4), (1, 4), (20, 6)):
        want = Counter()
        for i, t in rows:
            w = (t or "").split()
            runs = runs_of(w, min_length, min_exponent)
            want[i, len(w), tuple(runs), collapse(w, runs)] += 1
        found = periodic_runs(frame, min_length, min_exponent).collect()
        assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in found) == want


def test_periodic_runs_where_hashes_mislead():
    # Texts whose words all hash alike are caught as one run, which comparison then corrects.
    alike = np.zeros(40, np.uint64)
    assert find_runs([alike], 6, 4) == [(0, 0, 40, 1)]
    w = [str(i % 3) if i < 20 else str(i) for i in range(40)]
    assert compared_runs(w, 6, 4) == runs_of(w) == [(0, 20, 3)]


def test_periodic_query(llm):
    found = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](llm, SMALL).collect()}
    planted = 0
    for d in llm.read.parquet(f"{SMALL}/documents.parquet").collect():
        w = d.text.encode().split()
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = runs_of(w)
        r = found[d.doc_id]
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if runs else (None,) * 3
        milli = best[1] * 1000 // best[2] if runs else None
        digest = hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest()
        gone = {i for s, m, p in runs for i in range(s + p, s + m)}
        kept = hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, milli)
        assert (r.runs_sha256, r.collapsed_sha256) == (digest, kept)
    assert planted > 5 and planted_repetition(1, 0) is None
    assert periodic_runs(llm.createDataFrame([], "doc_id long, text string")).count() == 0


# 13: packing


def check_packed(pieces, ids_of, limits):
    """Each id lies in one piece; sequences are gapless and within the limits. Gives their lengths."""
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        per_doc[p.doc_id].append(p)
        per_sequence[p.sequence_id].append(p)
    assert set(per_doc) == set(ids_of)
    for i, own in per_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert np.frombuffer(b"".join(bytes(p.ids) for p in own), "<u4").tolist() == ids_of[i]
        assert {p.doc_tokens for p in own} == {len(ids_of[i])}
    for own in per_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert sum(p.length for p in own) <= limits.tokens and len(own) <= limits.segments
        assert sum(p.loss_tokens for p in own) <= limits.loss
    return [sum(p.length for p in own) for own in per_sequence.values()]


def test_packing_query(llm):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    found = QUERIES["op13_packing"](llm, SMALL).collect()
    lengths, n = defaultdict(int), 0
    spans = defaultdict(list)
    for p in found:
        lengths[p.sequence_id] += p.length
        spans[p.doc_id].append(p)
    for d in llm.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(d.text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(spans[d.doc_id], key=lambda p: p.start)
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]] and sum(p.length for p in own) == len(ids)
        for p in own:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
        n += len(ids)
    assert all(size <= 2048 and size & (size - 1) == 0 for size in lengths.values())
    assert sum(size == 2048 for size in lengths.values()) * 2048 > 0.95 * n


def test_packing_of_unusual_documents(llm, words):
    texts = ["", None, "<|endoftext|> x", "é漢  \x1c t'es", words(1, 5000), "a" * 9000, "\n\n  \n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, words(i, i % 7)) for i in range(700)] + [(None, "null id")]
    frame = llm.createDataFrame(rows, "doc_id long, text string").withColumn("parts", F.lit(1)).withColumn("ids", F.lit(1)).repartition(2)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids_of = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    for limits in (Limits(), Limits(tokens=96, segments=3, loss=50), Limits(1, 1, 1)):
        sizes = check_packed(pack_examples(documents_as_examples(frame), limits).collect(), ids_of, limits)
        assert all(size == limits.tokens or size & (size - 1) == 0 for size in sizes)
    same = pack_examples(documents_as_examples(frame), ranks=None).select("doc_id", "start", "ids").collect()
    assert Counter(map(str, same)) == Counter(map(str, pack_examples(documents_as_examples(frame)).select("doc_id", "start", "ids").collect()))
    twice = pack_examples(documents_as_examples(frame.filter("doc_id = 4").union(frame.filter("doc_id = 4"))))
    assert twice.agg(F.sum("length")).first()[0] == 2 * len(ids_of[4])
    assert pack_examples(documents_as_examples(frame.limit(0))).count() == 0
    with pytest.raises(ValueError):
        pack_examples(documents_as_examples(frame), Limits(segments=0))


def test_packing_of_conversations(llm):
    """Whole examples under three limits, against the bound that no packing can beat."""
    table = llm.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    limits = Limits(tokens=1024, segments=6, loss=400)
    pieces = pack_examples(conversations_as_examples(table), limits, cut=False).collect()
    tokenizer, turns = Tokenizer.from_file(TOKENIZER), defaultdict(list)
    for r in table.collect():
        turns[r.conv_id].append((r.turn, r.text or "", r.role == "assistant"))
    ids_of, losses = {}, {}
    for i, own in turns.items():
        encoded = [(tokenizer.encode(t, add_special_tokens=False).ids, loss) for _, t, loss in sorted(own)]
        ids_of[i] = [x for ids, _ in encoded for x in ids] + [1]
        losses[i] = sum(len(ids) for ids, loss in encoded if loss) + encoded[-1][1]
    sizes = check_packed(pieces, ids_of, limits)
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.loss_tokens
    assert {i: got[i] for i in losses} == losses
    small = {i for i in ids_of if len(ids_of[i]) <= 1024 and losses[i] <= 400}
    assert all(n == 1 for i, n in Counter(p.doc_id for p in pieces).items() if i in small)
    bound = max(sum(map(len, ids_of.values())) / 1024, sum(losses.values()) / 400, len(ids_of) / 6)
    assert len(sizes) <= 1.1 * bound + 4
    none = llm.createDataFrame([(1, None), (2, [])], "doc_id long, parts array<struct<text: string, loss: boolean>>")
    assert sorted((r.doc_id, r.length, r.loss_tokens) for r in pack_examples(none).collect()) == [(1, 1, 0), (2, 1, 0)]
    assert pack_examples(none, end_id=None).count() == 0


def test_encoder_agrees_with_the_tokenizer():
    tokenizer, encode = Tokenizer.from_file(TOKENIZER), Encoder(TOKENIZER, RANKS)
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice(" \n\t'.,-aAzZ09éßжЖ漢“”— \x1c\x85　😀́क\r") for _ in range(rng.randrange(30)))
        text = text if rng.random() < 0.9 else text[:5] + "<|endoftext|>" + text[5:]
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
