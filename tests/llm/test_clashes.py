"""Every operator carries columns that are named like its own internal ones."""

import pytest
from siltworks.llm.byte_bpe import digests
from siltworks.llm.decontamination import decontaminate
from siltworks.llm.html_text import main_text
from siltworks.llm.line_dedup import line_dedup
from siltworks.llm.ngram_join import first_of_components, ngram_jaccard_join
from siltworks.llm.personal_data import find_personal_data
from siltworks.llm.quality_rules import quality_rules
from siltworks.llm.queries import URL_RULES, vocabulary
from siltworks.llm.sharding import external_shuffle
from siltworks.llm.substring_dedup import substring_dedup
from siltworks.llm.url_filter import url_filter

NAMES = "_row _number _own _key _k _h _hash _text _html _lines runs row key n h1 h2 doc block bucket place offset which _suffix _share _known _x _host _path _rule _said _score _asks _h1 _h2 r patterns mentions base seen hit items a.b".split()
BENCHMARK = [(1, "some words that are asked for"), (None, "and others")]


@pytest.mark.parametrize(
    "operator",
    [
        line_dedup, find_personal_data, ngram_jaccard_join, first_of_components, external_shuffle, substring_dedup, quality_rules,
        lambda d: url_filter(d.withColumnRenamed("text", "url"), URL_RULES).withColumnRenamed("url", "text"), lambda d: digests(d, *vocabulary()),
        lambda d: decontaminate(d, d.sparkSession.createDataFrame(BENCHMARK, "item_id long, text string")), lambda d: decontaminate(d, d.sparkSession.createDataFrame(BENCHMARK, "item_id long, text string"), block_bytes=40),
        lambda d: main_text(d.withColumnRenamed("text", "html"), key="doc_id").withColumnRenamed("html", "other").withColumnRenamed("text", "main").withColumnRenamed("other", "text"),
    ],
    ids="lines personal join first shuffle substring quality url bpe benchmark blocks html".split(),
)
def test_columns_stay_as_they_are(spark, operator):
    texts = ["http://a.com/en/1 mail a@b.cd now", "some words that are asked for", "some words\nthat nobody\nasked for", None, "", "<p>text</p>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", *(f"{k} AS `{n}`" for k, n in enumerate(NAMES)))
    rows = operator(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        assert [r[n] for n in NAMES] == list(range(len(NAMES)))
