"""The pipeline against a plain re-statement of each stage's decision."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

from tidelog.llm import pieces, setsketch, shingles, tiling  # noqa: E402
from tidelog.llm.common import DOCUMENT_COLUMNS, materialize, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
        seen.append((name, docs))
        if name != "sentencepiece":
            assert tuple(docs.columns) == DOCUMENT_COLUMNS
    rows = {n: {r["doc_id"]: r.asDict() for r in d.collect()} for n, d in seen}
    everything = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    # Near-duplicates: of what the stage got, the smallest of each component.
    before, after = rows["toxicity"], rows["near_duplicates"]
    sets = {d: set(shingles.shingle_set(r["text"]).tolist()) for d, r in before.items()}
    linked = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    smallest = {d: d for d in sets}
    for _ in range(20):
        for a, b in linked:
            smallest[a] = smallest[b] = min(smallest[a], smallest[b])
    assert set(after) == {d for d, s in smallest.items() if d == s}
    # Decontamination: no kept text covers half of an item, every dropped one does.
    items = [shingles.token_hashes(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    for d, r in after.items():
        own = shingles.token_hashes(r["text"])
        covered = max(sum(n for *_, n in tiling.tile(i, own)) / len(i) for i in items)
        assert (covered >= tiling.COVERAGE) == (d not in rows["decontamination"])
    # Redaction keeps all rows; encoding gives back the redacted text.
    assert set(rows["personal_data"]) == set(rows["decontamination"]) == set(rows["sentencepiece"])
    assert any(r["text"] != everything[d] for d, r in rows["personal_data"].items())
    model = pieces.load()
    assert all(model.decode(list(r["ids"])) == rows["personal_data"][d]["text"] for d, r in rows["sentencepiece"].items())


def test_empty_and_null_rows(spark, tmp_path):
    odd = spark.createDataFrame([(None, "a b", "en", "s", 3), (1, None, None, None, None), (2, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    empty = odd.limit(0)
    for given, left in ((odd, 3), (empty, 0)):
        docs = given
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() == left


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_bands_meet_the_bound(threshold):
    assert (1 - threshold**setsketch.ROWS_PER_BAND) ** setsketch.bands_for(threshold) <= setsketch.MISS
