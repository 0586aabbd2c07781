"""The pipeline's stages, each on what the one before kept, against plain versions."""

import numpy as np
from test_llm_operators import SF, library_ids, slow_leaks
from test_near_copies import slow_kept

import corpus_pipeline
from vacancia.llm.common import stored


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {"documents": docs}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept[name] = stored(stage(spark, before, SF), name)
    names = list(kept)
    assert [n for n, _ in corpus_pipeline.STAGES] == names[1:] and len(names) == 6
    texts = {n: {r.doc_id: r.text for r in kept[n].select("doc_id", "text").collect()} for n in names[:-1]}
    for a, b in zip(names, names[1:-1]):
        assert kept[b].columns == columns and texts[b].items() <= texts[a].items() and texts[b]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    went = texts["language_id"].keys() - texts["quality_classifier"].keys()
    good = [d for d in texts["language_id"] if quality.get(d) == 1]
    assert sum(d in went for d in good) <= 0.1 * len(good)
    assert texts["simhash_dedup"].keys() == slow_kept(list(texts["quality_classifier"].items()))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, _, _ in slow_leaks(list(texts["simhash_dedup"].items()), items)}
    assert texts["decontamination"].keys() == texts["simhash_dedup"].keys() - leaked and leaked
    pieces = {}
    for r in sorted(kept["packing"].collect(), key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    last = texts["decontamination"]
    assert pieces == {d: np.array([*i, 1], "<u4").tobytes() for d, i in zip(last, library_ids(list(last.values())))}
    assert corpus_pipeline.run(spark, SF).count() == kept["packing"].count()
