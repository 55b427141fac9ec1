"""The registered queries against SQL and the pipeline against brute force, on the smallest tables."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_fixtures import SMALL, llm, words  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from spendlens.checks.compare import difference, duckdb_tables
from spendlens.llm.common import stored
from spendlens.llm.queries import ORACLES, QUERIES
from spendlens.llm.suffixes import kept_text, remove_repeats, text_without_repeats


@pytest.fixture(scope="module")
def duck():
    return duckdb_tables(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(llm, duck, name):
    assert difference(duck.sql(ORACLES[name]).df(), QUERIES[name](llm, SMALL).toPandas()) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_language_of_held_out_documents(llm):
    rows = QUERIES["op8_language"](llm, "/root/testdata/sf0.01").filter("held_out")
    lang = llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = rows.join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


@pytest.mark.parametrize(("name", "label", "positive"), [("op7_toxicity", "toxic", "toxic"), ("op3_quality", "quality", "keep")])
def test_classifiers_agree_with_the_labels(llm, name, label, positive):
    found = QUERIES[name](llm, "/root/testdata/sf0.1").select("doc_id", F.col(positive).cast("int").alias("said"))
    labels = llm.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", label)
    n = Counter((r[label], r.said) for r in found.join(labels, "doc_id").collect())
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.85 and n[0, 0] / (n[0, 0] + n[0, 1]) > 0.98


def _shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_pipeline_stages(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(llm, docs, SMALL), f"test-{name}")
        after = {r.doc_id: r for r in docs.collect()}
        kept.append(name)
        if name != "mixing":
            assert docs.columns == columns
        assert set(after) <= set(before)
        if name == "toxicity":
            scored = {r.doc_id: r.toxic for r in QUERIES["op7_toxicity"](llm, SMALL).collect()}
            assert set(after) == {i for i in before if not scored[i]}
        elif name == "near_duplicates":
            sets = {i: _shingles(r.text) for i, r in before.items()}
            root = {i: i for i in sets}
            ids = sorted(sets)
            for b in ids:
                for a in ids[: ids.index(b)]:
                    if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        low, high = sorted((root[a], root[b]))
                        root = {k: low if v == high else v for k, v in root.items()}
            assert set(after) == set(root.values())
        elif name == "suffix_repeats":
            counts = Counter(d[k : k + 200] for d in (r.text.encode() for r in before.values()) for k in range(len(d) - 199))
            for i, r in before.items():
                data = r.text.encode()
                gone = np.zeros(len(data), bool)
                for k in range(len(data) - 199):
                    if counts[data[k : k + 200]] > 1:
                        gone[k : k + 200] = True
                left = bytes(np.frombuffer(data, np.uint8)[~gone]).decode("utf-8", "ignore")
                assert (after[i].text, after[i].n_chars) == (left, len(left))
        elif name == "decontamination":
            hits = corpus_pipeline.find_benchmark(
                llm.createDataFrame(list(before.values())), llm.read.parquet(f"{SMALL}/benchmark.parquet")
            )
            assert set(before) - set(after) == {r.doc_id for r in hits.filter("n_hit > 0").collect()}
        else:
            assert set(after) == set(before)
            assert sorted(r.position for r in after.values()) == list(range(len(after)))
    assert kept == ["toxicity", "near_duplicates", "suffix_repeats", "decontamination", "mixing"]


def test_pipeline_stages_take_empty_and_null_documents(llm):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "a few words", "en", "s", 11)]
    for given in ([], rows):
        docs = llm.createDataFrame(given, kinds)
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(llm, docs, SMALL), "test")
            assert docs.count() == len(given)


def test_pipeline_keeps_one_of_repeated_rows_and_null_ids(llm, words):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _key string"
    a, b, c, d, e = (words(seed, 120, 4000) for seed in range(1, 6))
    given = [(7, a), (7, a), (7, a), (None, b), (9, b), (None, c), (None, c), (3, d), (3, e), (5, e), (4, ""), (4, ""), (None, None)]
    docs = llm.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in given], kinds).repartition(3)
    once = stored(corpus_pipeline.drop_near_duplicates(llm, docs, SMALL), "once")
    assert once.columns == docs.columns and {r._key for r in once.collect()} == {"x"}
    expected = Counter([(7, a), (9, b), (None, c), (3, d), (3, e), (4, ""), (4, ""), (None, None)])
    assert Counter((r.doc_id, r.text) for r in once.collect()) == expected
    cut = corpus_pipeline.cut_repeats(llm, once, SMALL)
    assert Counter((r.doc_id, r.text or None) for r in cut.collect()) == Counter({(i, t or None): n for (i, t), n in expected.items()})


def test_mixing_sql_on_sources_of_unequal_size(llm, tmp_path):
    sizes = {f"s{i:02d}": int(10 ** (i * 5 / 19)) for i in range(20)}
    rows = [(source, n) for source, n in sizes.items()]
    table = llm.createDataFrame(rows, "source string, n int").selectExpr("source", "explode(sequence(1, n)) AS at")
    table = table.selectExpr("CAST(abs(xxhash64(source, at)) AS BIGINT) AS doc_id", "source", "'x' AS text")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op2_pfair_mix"](llm, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(ORACLES["op2_pfair_mix"]).fetchdf()
    assert len(found) == sum(sizes.values()) and set(found.columns) == set(expected.columns)
    columns = sorted(found.columns)
    found, expected = (f[columns].sort_values("doc_id").reset_index(drop=True) for f in (found, expected))
    for c in columns:
        assert (found[c] == expected[c]).all(), c


def _chained(node, above=False):
    """Whether a stage of the plan passes rows from one Python worker to another."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _chained(node.executedPlan())
    here = "MapInArrow" in name
    if here and above:
        return True
    below = node.children()
    return any(_chained(below.apply(k), "Exchange" not in name and (here or above)) for k in range(below.size()))


def test_pipeline_stages_hold_one_python_worker_per_core(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").limit(50)
    twice = docs.mapInArrow(lambda b: b, docs.schema).mapInArrow(lambda b: b, docs.schema)
    assert _chained(twice._jdf.queryExecution().executedPlan())
    for name, stage in corpus_pipeline.STAGES:
        assert not _chained(stage(llm, docs, SMALL)._jdf.queryExecution().executedPlan()), name


def test_text_without_repeats(llm, words):
    passage = "é" * 60 + words(1, 90) + "ü" * 60
    rows = [(i, words(10 + i, 30) + "ü" + passage[i : 500 - i] + " " + words(40 + i, 30)) for i in range(6)]
    rows += [(20, None), (21, ""), (22, "é" * 300), (23, words(3, 80)), (23, words(3, 80)), (None, words(5, 80))]
    docs = llm.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x"))
    expected = kept_text(remove_repeats(docs))
    found = text_without_repeats(docs)
    assert found.columns == expected.columns and Counter(found.collect()) == Counter(expected.collect())
