"""The operators' queries against their SQL, and the pipeline stage by stage."""

from pathlib import Path

import pytest

import corpus_pipeline
from checks.compare import connect, differences
from simmart.llm import packing
from simmart.llm.common import table
from simmart.llm.queries import ORACLE, QUERIES, tokenizer_file
from tests.llm.conftest import DOCS, prose
from tests.llm.test_texts import WORDS, brute_classes, brute_cut

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    if name in ORACLE:
        assert differences(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) is None
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns
    language, quality, single, cut = (d.collect() for d in kept[1:])

    assert len(language) == docs.count()  # every text has letters, in a known language
    left = {r.doc_id for r in quality}
    rated = [(q == 1, k in left) for k, q in labels.items()]
    assert sum(good == stays for good, stays in rated) >= 0.97 * len(rated)

    classes = brute_classes([(r.doc_id, r.text) for r in quality])
    assert sorted(r.doc_id for r in single) == sorted(k for (k, _), c in classes.items() if c == k)

    expected = {row[0]: row[1:] for row in brute_cut([(r.doc_id, r.text) for r in single])}
    texts = {r.doc_id: r.text for r in single}
    assert len(cut) == len(single)
    for r in cut:
        n_words, n_removed, _ = expected[r.doc_id]
        assert len(WORDS.findall(r.text)) == n_words - n_removed and r.n_chars == len(r.text)
        assert n_removed or r.text == texts[r.doc_id]

    words = packing.Words(open(tokenizer_file("word_bpe_49k.json")).read())
    rows = corpus_pipeline.run(spark, SF).collect()
    sizes = {}
    for r in rows:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {r.doc_id: len(words.ids(r.text)) // 4 + 1 for r in cut}


def test_pipeline_of_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    """Null and empty texts go at the first stage; null ids stay apart."""
    from pyspark.sql import functions as F

    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            if name == "language":
                docs = stage(spark, docs.withColumn("lang", F.coalesce("lang", F.lit("en"))), SF)
                assert docs.where("text is null or trim(text) = ''").count() == 0
            elif name != "quality":  # fitted on other documents' labels
                docs = stage(spark, docs, SF)
        assert docs.count() >= 0


def test_pipeline_keeps_unlike_texts_of_one_id(spark):
    """Each row goes or stays by its own text, also where ids repeat."""
    a, b, c, d = (prose(i * 31, 60) for i in range(1, 5))
    near = a + " more"
    rows = [(1, a), (5, near), (5, b), (5, b), (7, c), (7, d), (9, d), (None, a), (None, a)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], DOCS).repartition(3)
    found = corpus_pipeline.one_of_each_group(spark, docs, SF)
    assert found.columns == docs.columns
    expected = [(1, a), (5, b), (7, c), (7, d), (None, a), (None, a)]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(expected, key=str)
