"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline as pipeline
from tessera.llm import quality
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_neardup import brute_components
from tests.llm.test_packing import FILE, pieces_of

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(spark):
    from tessera.session import Scratch

    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    done = {}
    for name, stage in pipeline.STAGES:
        done[name] = (docs, docs := scratch.write(stage(spark, docs, SF), name))
        assert docs.columns == columns or name == "best_fit_packing"
    text = {name: [(r.doc_id, r.text) for r in frame.collect()] for name, (frame, _) in done.items()}
    left = {name: {r.doc_id: r.text for r in frame.collect()} for name, (_, frame) in done.items() if name != "best_fit_packing"}

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality.quality(done["quality_rules"][0], labels).where("kept").collect()
    assert set(left["quality_rules"]) == {r.doc_id for r in kept}

    gone, *_ = brute_lines(text["line_dedup"])
    for doc_id, whole in text["line_dedup"]:
        want = "\n".join(x for k, x in enumerate(whole.split("\n")) if k not in gone[doc_id, whole])
        assert left["line_dedup"].get(doc_id, "") == (want if want.strip() else "")

    judged = brute_components(text["minhash_near_dedup"])
    assert set(left["minhash_near_dedup"]) == {d for d, _, c in judged if d == c}

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute_hits(text["benchmark_decontamination"], items)
    assert set(left["benchmark_decontamination"]) == {r[0] for r in hits if not r[5]}

    got = sorted((tuple(r)[:5] for r in done["best_fit_packing"][1].collect()), key=repr)
    assert got == pieces_of(text["best_fit_packing"])
