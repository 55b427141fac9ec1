"""Each operator against a brute-force version on rows with nulls, empty and long texts, ties,
repeated rows and columns whose names clash; and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import llm, words  # noqa: F401
from pyspark.sql import functions as F

from spendlens.llm import decontamination, lattice, mixing, neardup, suffixes
from spendlens.llm.common import components, id_hash_mod, stored
from spendlens.llm.decontamination import find_benchmark, items_digest
from spendlens.llm.language import fit_languages, predict_languages
from spendlens.llm.lattice import lattice_log_probability, load_pieces, score_texts
from spendlens.llm.mixing import mix_sources, pfair_period, root_weights
from spendlens.llm.neardup import near_duplicates
from spendlens.llm.paragraphs import (
    estimated_recall,
    removal_summary,
    repeated_paragraphs,
    tune_bands,
    without_paragraphs,
)
from spendlens.llm.quality import fit_quality, hierarchical_quality, score_documents, site_posteriors
from spendlens.llm.signatures import minhash, superminhash
from spendlens.llm.similarity import similar_vectors
from spendlens.llm.suffixes import difference_cover, kept_text, remove_repeats, repeated_starts
from spendlens.llm.text import mix
from spendlens.llm.toxicity import fit_severity, score_severity

DOCS = "doc_id long, text string, lang string, source string, band string, score double, spans string, _id string"


def docs(spark, rows):
    """(doc_id, text[, lang, source]) with columns whose names the operators use themselves."""
    full = [(*r, *("en", "s")[len(r) - 2 :], "b", 0.5, "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(llm):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 9), (20, 20), (30, 31)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r.id: r.component for r in components(llm.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots({x for p in pairs for x in p}, pairs)
    assert {i: found.get(i, i) for i in want} == want
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


# 1: vectors


def test_similar_vectors(llm):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(240):
        x = centres[i % 6] + rng.normal(size=8) * (0.12 if i % 3 else 0.3)
        rows.append((i, x.tolist(), i % 2 if i % 11 else None))
    rows += [(300 + i, [1.0] * 8, 1) for i in range(30)]  # copies
    rows += [
        (400, None, 1), (401, [0.0] * 8, 1), (402, [1.0, None] + [0.0] * 6, 1), (403, [math.nan] + [1.0] * 7, 1),
        (404, [math.inf] + [1.0] * 7, 1), (405, [], 1), (406, [1.0] * 4, 1), (407, [2.0] * 8, 1), (None, [1.0] * 8, 1),
    ]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(1))
    found = {r.vec_id: r for r in similar_vectors(frame, 0.93).collect()}
    unit = {}
    for i, e, label in rows:
        ok = i is not None and label is not None and e and None not in e and np.isfinite(e).all() and any(e)
        if ok:
            unit[i] = (label, np.array(e) / np.linalg.norm(e))
    links = [
        (a, b) for a in unit for b in unit
        if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.93
    ]
    degree, want = Counter(x for p in links for x in p), roots([r[0] for r in rows if r[0] is not None], links)
    assert len(found) == len(rows) and found[None].component_id is None and found[None].kept
    for i, root in want.items():
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (degree[i], root, i == root), i


def test_similar_vectors_of_an_empty_table(llm):
    assert similar_vectors(llm.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# 2: mixing


def test_mix_sources(llm):
    sizes = {"a": 500, "b": 90, None: 40, "c": 3}
    rows = [(n, None, "en", s) for n, s in enumerate(s for s, k in sizes.items() for _ in range(k))]
    rows.append(rows[0])
    weights = {r.source: r.weight for r in root_weights(docs(llm, rows)).collect()}
    assert set(weights) == {"a", "b", "", "c"} and sum(weights.values()) == 1000
    found = sorted(mix_sources(docs(llm, rows).withColumn("_run", F.lit(1)), block_rows=4).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(len(rows)))
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert all(r.release <= r.slot < r.deadline and r._id == "y" for r in found)
    blocks = {}
    for r in found:
        assert blocks.setdefault((r.source, r.block), r.slot) == r.slot
    slots = sorted({(r.slot, r.source) for r in found if r.in_balance})
    assert [s for s, _ in slots] == list(range(len(slots))) and slots
    had = Counter()
    for n, (_, source) in enumerate(slots, 1):
        had[source] += 1
        assert all(abs(had[s] - n * w / 1000) < 1 for s, w in weights.items())


def test_pfair_period_meets_every_deadline(llm):
    weights = [("a", 7), ("b", 1), ("c", 5), ("d", 5), ("e", 2)]
    rows = pfair_period(llm.createDataFrame(weights, "source string, weight int")).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(20))
    had = Counter()
    for r in rows:
        assert r.nth == had[r.source] and r.taken == [had[s] for s, _ in weights]
        had[r.source] += 1
        assert all(abs(had[s] - (r.slot + 1) * w / 20) < 1 for s, w in weights)


def test_mix_refuses_sources_without_weight_and_takes_empty_tables(llm):
    with pytest.raises(ValueError):
        mix_sources(docs(llm, [(1, "x")]), llm.createDataFrame([("t", 1)], "source string, weight int"))
    assert mix_sources(docs(llm, [])).count() == 0


def test_root_weights_are_proportional_for_any_number_of_sources(llm):
    for n, period in ((20, 1000), (200, 2000), (900, 9000)):
        sizes = llm.range(n).select(F.col("id").cast("string").alias("source"), F.when(F.col("id") == 0, n * 8).otherwise(16).alias("k"))
        rows = sizes.withColumn("k", F.explode(F.sequence(F.lit(1), "k"))).union(llm.createDataFrame([("tiny", 1)], "source string, k int"))
        weights = {r.source: r.weight for r in root_weights(rows).collect()}
        period = 1000 * -(-(n + 1) // 100)
        roots = {str(i): (n * 8 if i == 0 else 16) ** 0.5 for i in range(n)} | {"tiny": 1.0}
        total = sum(roots.values())
        assert sum(weights.values()) == period
        assert all(abs(w - period * roots[s] / total) < 1 for s, w in weights.items())
    # 1 is a minimum that takes nothing from the proportions of the others
    rows = llm.range(400_000).select(F.when(F.col("id") < 5, F.col("id").cast("string")).otherwise("big").alias("source"))
    weights = {r.source: r.weight for r in root_weights(rows, 100).collect()}
    assert weights == {"big": 95, **dict.fromkeys("01234", 1)}


def test_pfair_slots_are_those_of_the_period(llm, monkeypatch):
    monkeypatch.setattr(mixing, "SPAN", 13)
    monkeypatch.setattr(mixing, "STEP", 5)
    weights = llm.createDataFrame([("d", 5), ("a", 7), ("b", 1), ("c", 5), ("e", 2), ("f", 5), ("z", 0)], "source string, weight int")
    expected = {(r.source, r.nth, r.slot, r.period) for r in pfair_period(weights).collect()}
    assert {tuple(r) for r in mixing.pfair_slots(weights).collect()} == expected
    assert len(expected) == 25


@pytest.mark.parametrize("broadcast", [0, 250_000])
def test_mix_of_more_than_a_thousand_sources(llm, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_BLOCKS", broadcast)
    monkeypatch.setattr(mixing, "_RUN_SLOTS", 64)
    n = 1_100
    sizes = llm.range(n).select(F.col("id").cast("string").alias("source"), (F.lit(1) + F.col("id") % 7 + F.when(F.col("id") == 0, 600).otherwise(0)).cast("int").alias("k"))
    rows = stored(sizes.select("source", F.explode(F.sequence(F.lit(1), "k")).alias("k")).select(F.xxhash64("source", "k").alias("doc_id"), "source"), "many")
    weights = {r.source: r.weight for r in root_weights(rows).collect()}
    found = sorted(mix_sources(rows, block_rows=4).collect(), key=lambda r: r.position)
    assert Counter((r.doc_id, r.source) for r in found) == Counter(tuple(r) for r in rows.collect())
    assert [r.position for r in found] == list(range(len(found)))
    assert [r.slot for r in found] == sorted(r.slot for r in found)
    period = sum(weights.values())
    for r in found:
        assert r.release <= r.slot < r.deadline
        assert (r.release, r.deadline) == (r.block * period // weights[r.source], -(-(r.block + 1) * period // weights[r.source]))
    assert len({(r.source, r.block) for r in found}) == len({r.slot for r in found})


# 3: quality


def test_site_posteriors_shrink_sparse_sites(llm):
    rows = [("big", "p", 0.9)] * 200 + [("big", "q", 0.7)] * 50 + [("bad", "p", 0.1)] * 100 + [("new", None, 0.1), (None, "p", 0.9)]
    found = {(r.host, r.path): r for r in site_posteriors(llm.createDataFrame(rows, "host string, path string, evidence double")).collect()}
    prior = sum(r[2] for r in rows) / len(rows)
    assert len(found) == 5 and all(abs(r.prior - prior) < 1e-12 for r in found.values())
    assert found["bad", "p"].host_posterior < found["new", None].host_posterior < prior < found["big", "p"].host_posterior
    assert found["big", "q"].path_posterior < found["big", "q"].host_posterior
    assert found[None, "p"].n_host == 1 and found["big", "p"].n_host == 250


def test_quality(llm, words):
    good = [(i, words(i, 120), 1) for i in range(60)]
    bad = [(100 + i, " ".join(["spam!!"] * 40) + f" {i}", 0) for i in range(60)]
    labelled = llm.createDataFrame([(t, q) for _, t, q in good[:40] + bad[:40]] + [(None, 1), ("x y", None)], "text string, quality int")
    model = fit_quality(labelled)
    rows = [(i, t, f"h{i % 3}") for i, t, _ in good + bad] + [(500, None, "h0"), (501, "", None), (501, "", None)]
    frame = llm.createDataFrame(rows, "doc_id long, text string, host string").withColumns({"path": F.lit(None).cast("string"), "keep": F.lit("old")})
    found = hierarchical_quality(score_documents(frame, model)).collect()
    assert len(found) == len(rows) and {"doc_id", "host", "path", "quality", "keep"} <= set(found[0].asDict())
    for r in found:
        assert r.keep == (r.doc_id < 100), r
    empty = hierarchical_quality(score_documents(frame.limit(0), fit_quality(labelled.limit(0))))
    assert empty.count() == 0


# 4: near duplicates


def shingles(text, size=5, least=1):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if len(w) >= least else set()


def near_rows(words):
    rows = []
    for i in range(12):
        base = words(i, 150).split()
        rows.append((i * 10, " ".join(base)))
        for k in range(1, 7):
            copy = list(base)
            for j in range(k):
                copy[(j * 37 + i) % len(copy)] = f"edit{k}"
            rows.append((i * 10 + k, "\n".join(copy).upper() if k == 2 else " ".join(copy)))
    rows += [(200, None), (201, ""), (202, " \t "), (203, "one two"), (204, "One  two"), (205, "one two three"), (206, words(99, 30_000))]
    return rows + [(207, rows[0][1]), (207, rows[0][1])]


def test_near_duplicates(llm, words, monkeypatch):
    monkeypatch.setattr(neardup, "PART_ROWS", 3)  # groups meet in parts
    rows = near_rows(words)
    found = near_duplicates(docs(llm, [*rows, (None, rows[0][1])]), 85, 100).collect()
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    assert len(found) == len(rows) + 1
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_duplicates(docs(llm, [])).count() == 0


def test_near_duplicates_of_repeated_rows(llm, words, monkeypatch):
    """Ids with several texts have the links of each; a text comes once, however many rows repeat it."""
    monkeypatch.setattr(neardup, "PART_ROWS", 3)
    base = [words(300 + i, 120) for i in range(4)]
    rows = [(1, base[0]), (1, base[1]), (1, base[0] + " end"), (2, base[1] + " more"), (3, base[2]), (3, base[3] + " x"), (9, base[3])]
    rows += [(7, base[2] + " y"), (7, base[2] + " y"), (-4, base[3] + " z"), (1, base[0]), (6, None), (6, ""), (6, base[0].upper())]
    found = near_duplicates(docs(llm, rows), 85, 100).collect()
    sets = [shingles(t or "") for _, t in rows]
    ids = sorted({i for i, _ in rows})
    links = [
        (rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    want = roots(ids, links)
    assert {i: want[i] for i in ids} == {1: 1, 2: 1, 3: -4, 6: 1, 7: -4, 9: -4, -4: -4}
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == sorted(
        (i, len(s), want[i], want[i] == i) for (i, _), s in zip(rows, sets, strict=True)
    )


def test_near_duplicates_of_one_id_repeated_very_often(llm, words):
    text = words(350, 400)
    many = llm.range(50_000).selectExpr("5L AS doc_id", f"'{text}' AS text")
    found = near_duplicates(many.union(docs(llm, [(8, text + " more")]).select("doc_id", "text")))
    assert sorted(map(tuple, found.groupBy("doc_id", "component_id", "kept").count().collect())) == [(5, 5, True, 50_000), (8, 5, False, 1)]


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(5)
    for signature in (superminhash, minhash):
        for n, shared in ((1000, 900), (60, 48), (3, 2)):
            errors = []
            for _ in range(20):
                x = rng.integers(0, 1 << 62, 2 * n - shared).astype(np.uint64)
                values = np.concatenate((np.sort(x[:n]), np.sort(x[n - shared :])))
                made = signature(values, np.array([0, n, 2 * n, 2 * n]), 128)
                errors.append((made[0] == made[1]).mean() - shared / (2 * n - shared))
            assert abs(np.mean(errors)) < 0.04 and (made[2] == np.iinfo(np.uint64).max).all()


# 5: decontamination


@pytest.mark.parametrize("pass_windows", [1000, 5])
def test_find_benchmark(llm, words, pass_windows):
    items = [(1, words(1, 30, 50)), (2, words(2, 12, 50)), (3, "alpha beta"), (4, None), (5, "..."), (None, "unnamed item"), (7, words(1, 15, 50)), (8, "solo")]
    texts = [
        words(1, 30, 50), "x " + words(1, 11, 50).replace(" ", ", ") + " y", "ALPHA-beta alpha beta", None, "", "no hit here",
        words(50, 3000, 50) + " " + words(2, 12, 50), "an unnamed  item", "solo", "ümlaut solo é", words(1, 9, 50),
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    frame = docs(llm, rows).withColumn("n_words", F.lit("old"))
    found = find_benchmark(frame, llm.createDataFrame(items, "item_id long, text string"), 10, pass_windows).collect()
    assert len(found) == len(rows)

    def tokens(text):
        out = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").encode())
        return out.split()

    for r in found:
        w, hit, named = tokens(r.text), set(), set()
        for item, text in items:
            v = tokens(text)
            for k in range(max(1, len(v) - 9) if v else 0):
                gram = v[k : k + 10]
                for j in range(len(w) - len(gram) + 1):
                    if w[j : j + len(gram)] == gram:
                        hit.update(range(j, j + len(gram)))
                        named.add("" if item is None else str(item))
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(named)), r.doc_id
        assert sorted(k for s in r.spans for k in range(s.first, s.last + 1)) == sorted(hit)
    assert items_digest([]) == hashlib.sha256(b"").hexdigest()
    nothing = llm.createDataFrame([], "item_id long, text string")
    assert find_benchmark(frame, nothing).filter("n_hit > 0").count() == 0
    assert find_benchmark(frame.limit(0), nothing).count() == 0


def test_shifts_skip_most_positions():
    patterns = decontamination._Patterns({b" ".join(b"p%d" % (k + j) for j in range(10)): ["x"] for k in range(50)}, 10)
    assert (patterns.shifts == 9).mean() > 0.99 and patterns.shifts.min() == 0


# 6: lattice


def test_lattice_sums_over_all_segmentations():
    pieces = load_pieces()
    table = {}
    for b in {w[i:j] for w in (b" there", b" h") for i in range(len(w)) for j in range(i + 1, len(w) + 1)}:
        at = pieces.find(lattice.span_hashes(lattice.prefix_hashes(np.frombuffer(b, np.uint8), False), np.array([0]), np.array([len(b)])))[0]
        if at >= 0:
            table[b] = math.exp(pieces.log_p[at])

    def total(word):
        return 1.0 if not word else sum(p * total(word[len(b) :]) for b, p in table.items() if word.startswith(b))

    for word in (b"the", b"there", b"h"):
        assert lattice_log_probability(pieces, [word])[0] == pytest.approx(math.log(total(b" " + word)))
    assert np.isfinite(lattice_log_probability(pieces, [b"\xff\xfe", "日本".encode(), b"x" * 500])).all()


def test_score_texts(llm, words):
    rows = [(i, words(i, 40 + i, 60)) for i in range(40)] + [(100, None), (101, ""), (102, words(9, 5000, 3000)), (3, words(3, 43, 60)), (None, "w1 é")]
    frame = docs(llm, rows).withColumn("train", id_hash_mod("doc_id", 5) != 1)
    found = score_texts(frame, frequent=20).collect()
    end, counts = object(), Counter()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    for i, t in rows:
        if not held(i):
            counts.update((t or "").encode().lower().split())
            counts[end] += 1
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), end]
        base = sum(math.log10((counts[k] + 0.5) / (n + 0.5 * (v + 1))) for k in w)
        want[i, not held(i), len(w), sum(counts[k] > 0 for k in w), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    all_at_once = {(r.doc_id, r.n_tokens): r.score for r in score_texts(frame).collect()}
    for r in found:
        assert r.score < 0 and r.score == pytest.approx(all_at_once[r.doc_id, r.n_tokens])
    assert score_texts(frame.limit(0)).count() == 0


# 7: toxicity


def test_severity(llm, words):
    rows = [(words(i, 60), 0) for i in range(300)]
    rows += [(words(900 + i, 60) + " vile" * (1 + i % 4) + (" foul" if i % 2 else ""), 1) for i in range(60)]
    labelled = llm.createDataFrame(rows + [(None, 1), ("a", None)], "text string, grade int")
    model = fit_severity(labelled)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 2 and len(model.features) >= 1
    test = [(0, words(5000, 80)), (1, words(5001, 80) + " VILE!"), (2, words(5002, 4000) + " vile vile vile vile foul"), (3, None), (4, ""), (4, ""), (5, "?!")]
    frame = docs(llm, test).withColumn("grade", F.lit("old"))
    found = {r.doc_id: r for r in score_severity(frame, model).collect()}
    assert [found[i].grade > 0 for i in range(6)] == [False, True, True, False, False, False]
    assert found[2].severity > found[1].severity > found[0].severity and found[3].p_toxic == 0 == found[5].p_toxic
    assert score_severity(frame.limit(0), fit_severity(labelled.limit(0))).count() == 0
    assert score_severity(frame, fit_severity(labelled.filter("grade = 0"))).filter("grade > 0").count() == 0


def test_severity_orders_given_grades(llm, words):
    marks = ["", " bad", " bad worse", " bad worse worst"]
    rows = [(words(i, 40) + marks[i % 4], i % 4) for i in range(400)]
    model = fit_severity(llm.createDataFrame(rows, "text string, grade int"))
    assert len(model.thresholds) == 3
    found = score_severity(docs(llm, [(k, words(7000 + k, 50) + m) for k, m in enumerate(marks)]), model).orderBy("doc_id").collect()
    assert [r.grade for r in found] == [0, 1, 2, 3]


# 8: language


def test_languages(llm):
    texts = {"en": "the quick brown fox jumps over the lazy dog and then the rest of them ", "fr": "le renard brun saute par dessus le chien été français où ", "ja": "日本語のテキストです これは例文 "}
    rows = [(t[i % 9 :] * (1 + i % 3), lang) for lang, t in texts.items() for i in range(40)]
    model = fit_languages(llm.createDataFrame(rows + [(None, "en"), ("x", None)], "text string, lang string"))
    assert model.languages == ["en", "fr", "ja"]
    test = [(0, "then the dog jumps"), (1, "le chien français"), (2, "これは日本語"), (3, None), (4, ""), (5, "12 34 !!"), (6, texts["fr"] * 3000), (6, texts["fr"] * 3000)]
    found = predict_languages(docs(llm, test), model).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in found) == [(0, "en"), (1, "fr"), (2, "ja"), (3, "und"), (4, "und"), (5, "und"), (6, "fr"), (6, "fr")]
    assert all(0 <= r.score <= 1 and "text" not in r.asDict() for r in found)
    none = fit_languages(llm.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in predict_languages(docs(llm, test), none).collect()} == {"und"}
    assert predict_languages(docs(llm, []), model).count() == 0


# 9: suffixes


def test_difference_cover_and_sorting():
    for period in (8, 32, 64):
        cover = difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:2400] = data[:900]
    ranks = suffixes.SuffixRanks(data, 200)
    at = np.flatnonzero(data[:2700] == 97)
    got = ranks.sort(at.copy())
    text = data.tobytes()
    keys = [text[k : k + 200] for k in got.tolist()]
    assert keys == sorted(keys)
    assert (ranks.same_as_next(got, 200)[:-1] == [a == b for a, b in zip(keys, keys[1:])]).all()
    pieces = [text[:400], text[1500:1900], text[100:390]]
    hits = repeated_starts(pieces, [201, 201, 91], np.array([1, 1, 1]), 200)
    counts = Counter(p[i : i + 200] for p, n in zip(pieces, (201, 201, 91)) for i in range(n))
    assert [list(h) for h in hits] == [[counts[p[i : i + 200]] > 1 for i in range(n)] for p, n in zip(pieces, (201, 201, 91))]


@pytest.mark.parametrize("large", [16_384, 2])
def test_remove_repeats(llm, words, monkeypatch, large):
    monkeypatch.setattr(suffixes, "GROUP_PIECES", large)
    monkeypatch.setattr(suffixes, "_SEGMENT", 5_000)
    passage = words(1, 90)
    rows = [(i, words(10 + i, 30) + " " + passage[i : 500 - i] + " " + words(40 + i, 30)) for i in range(8)]
    rows += [(20, "For " * 300), (21, None), (22, ""), (23, "é" * 120 + passage[:250]), (24, words(77, 9000)), (25, "ü" * 99), (26, words(3, 100)), (26, words(3, 100)), (None, words(5, 80))]
    found = remove_repeats(docs(llm, rows).withColumn("kept", F.lit("old")), 200)
    text_of = Counter((t or "").encode()[i : i + 200] for _, t in rows for i in range(len((t or "").encode()) - 199))
    got = defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append((bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans))
        assert (r.spans, r._id) == ("x", "y")
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 199):
            if text_of[data[k : k + 200]] > 1:
                gone[k : k + 200] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want = (bytes(np.frombuffer(data, np.uint8)[~gone]), len(data), int(gone.sum()), runs)
        assert want in got[i], i
    assert sum(map(len, got.values())) == len(rows)
    assert kept_text(found).count() == len(rows)


def test_remove_repeats_of_thousands_of_equal_rows(llm, words):
    rows = [(1, words(4, 800, 5000))] * 2000 + [(None, words(5, 800, 5000))] * 2000 + [(2, words(4, 800, 5000)[900:]), (3, words(6, 300, 5000))]
    found = remove_repeats(llm.createDataFrame(rows, "doc_id long, text string"), 200)
    counts = Counter((r.doc_id, r.n_removed, r.n_spans, len(r.kept)) for r in found.collect())
    whole = [len(words(seed, 800, 5000)) for seed in (4, 5)]
    assert counts == {(1, whole[0], 1, 0): 2000, (None, whole[1], 1, 0): 2000, (2, whole[0] - 900, 1, 0): 1, (3, 0, 0, len(rows[-1][1])): 1}


def test_remove_repeats_of_an_empty_table(llm):
    assert remove_repeats(docs(llm, [])).count() == 0


# 10: paragraphs


def paragraphs_of(text):
    """Line by line, each cut after a sentence end and a blank."""
    return [p for line in text.split("\n") for p in line.replace(". ", ". \n").replace("! ", "! \n").replace("? ", "? \n").split("\n")]


def test_paragraphs(llm, words):
    base = [words(i, 60) for i in range(6)]
    rows = [
        (5, "\n".join([base[0], "short line", base[1]])), (2, "\n".join([words(90, 40), base[0] + " more", "", base[2]])),
        (7, "\n".join([base[2], base[2], "short line"])), (8, None), (9, ""), (10, words(91, 8000)), (-3, base[1]), (None, base[1]), (2**50, base[3]), (11, base[3]),
        (12, "Before.  " + base[4] + "! " + base[5].replace("w", "v") + "?"), (13, "Other words of another line. " + base[4] + "!\nlast"), (-9, base[4] + "!"),
    ]
    removed = repeated_paragraphs(docs(llm, rows))
    items = [(i, k, shingles(p, 5, 20)) for i, t in rows if i is not None for k, p in enumerate(paragraphs_of(t or ""))]
    items = [x for x in items if x[2]]
    links = [(a, b) for a, x in enumerate(items) for b, y in enumerate(items) if a < b and 100 * len(x[2] & y[2]) >= 80 * len(x[2] | y[2])]
    groups = defaultdict(list)
    for n, root in roots(range(len(items)), links).items():
        groups[root].append(items[n][:2])
    found = {(r.doc_id, r.number) for r in removed.collect()}
    for group in groups.values():
        assert len(found & set(group)) == len(group) - 1
        assert min(group) not in found
    lists = {r.doc_id: r for r in removal_summary(docs(llm, rows), removed).collect()}
    assert len(lists) == len(rows) and lists[8].n_paragraphs == 0 and lists[None].n_removed == 0
    assert lists[7].removed == [0, 1] and lists[7].n_paragraphs == 3
    left = {r.doc_id: r.text for r in without_paragraphs(docs(llm, rows), removed).collect()}
    assert left[7] == "short line" and left[8] is None and left[10] == rows[5][1]
    assert left[12] == "Before. " + base[5].replace("w", "v") + "?" and left[13] == "Other words of another line. \nlast"
    assert repeated_paragraphs(docs(llm, [])).count() == 0


def test_bands_reach_the_recall():
    for similarity in (0.7, 0.8, 0.9):
        bands, rows = tune_bands(similarity, 0.9999, 128)
        assert bands * rows <= 128 and estimated_recall(similarity, bands, rows) >= 0.9999


def _posteriors(rows, text, sizes=(1, 3), buckets=1 << 15, alpha=0.1):
    """Naive Bayes by the book: {language: log evidence of the text}."""
    def grams(value):
        out = []
        spaced = re.sub(r"\s+", " ", " " + "".join(c if c.isalpha() else " " for c in value.lower()) + " ")
        for n in sizes:
            for i in range(len(spaced) - n + 1):
                gram = spaced[i : i + n]
                if n == 1 and gram == " ":
                    continue
                packed = 0
                for c in gram:
                    packed = ((packed << 21) ^ (packed >> 43) ^ ord(c)) & (2**64 - 1)
                out.append(int(mix(np.array([packed + (n << 58)], np.uint64))[0]) % buckets)
        return out

    counts, documents = {}, Counter()
    for value, lang in rows:
        counts.setdefault(lang, Counter()).update(grams(value))
        documents[lang] += 1
    found = {}
    for lang, of in counts.items():
        total = sum(of.values()) + alpha * buckets
        found[lang] = math.log(documents[lang] / len(rows)) + sum(math.log((of[g] + alpha) / total) for g in grams(text))
    return found


def test_languages_beyond_one_block_match_brute_force(llm):
    letters = "abcdefghijklmnopqrst"
    names = [f"l{i:03d}" for i in range(300)]
    words = {name: f"{letters[i // 20]}{letters[i % 20]}x {letters[i % 20]}{letters[i // 20]}zq" for i, name in enumerate(names)}
    rows = [(w, n) for n, w in words.items()] * 2 + [(words["l007"], "l007")] * 5
    table = llm.createDataFrame(rows, "text string, lang string")
    tests = [(i, words[n]) for i, n in enumerate(names[::10])] + [(900, None), (901, "12 3"), (902, "tie")]
    many = {r.doc_id: r for r in predict_languages(docs(llm, tests), fit_languages(table, block=64)).collect()}
    one = {r.doc_id: r for r in predict_languages(docs(llm, tests), fit_languages(table, block=512)).collect()}
    assert {i: r.lang_pred for i, r in many.items()} == {i: r.lang_pred for i, r in one.items()}
    for i, text in tests:
        assert abs(many[i].score - one[i].score) < 1e-9
        if i in (900, 901):
            assert (many[i].lang_pred, many[i].score) == ("und", 0.0)
            continue
        expected = _posteriors(rows, text)
        top = max(expected.values())
        scale = math.log2(len(text) + 1)
        assert abs(many[i].score - 1 / sum(math.exp((v - top) / scale) for v in expected.values())) < 1e-3
        assert expected[many[i].lang_pred] > top - 1e-4
    assert all(many[i].lang_pred == n for i, n in enumerate(names[::10]))


def test_language_sample_keeps_rare_languages(llm):
    rows = [(f"common word number {i}", "big") for i in range(3000)] + [("zyx wvu", "rare")]
    model = fit_languages(llm.createDataFrame(rows, "text string, lang string"), rows_per_language=50)
    assert model.languages == ["big", "rare"]
    found = predict_languages(docs(llm, [(1, "wvu zyx"), (2, "a common number")]), model).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "rare", 2: "big"}
