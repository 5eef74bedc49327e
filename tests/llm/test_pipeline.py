import random

import corpus_pipeline
from barloom.llm import queries
from barloom.llm.store import stored

ORDER = ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "byte_bpe"]


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        body = text(60)
        if i % 4 == 0:
            body += " nastyword " + text(5) + " nastyword"
        rows.append((i, body))
        labels.append((i, int(i % 4 == 0)))
    item, passage, copy = text(30), text(60), text(100)
    rows += [(1000, text(40) + " " + item), (1001, text(30) + " " + passage), (1002, passage + " " + text(30))]
    rows += [(1003, copy), (1004, copy + " " + word()), (1005, None), (1006, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, at, str(tmp_path)), name)
        if name != ORDER[-1]:
            assert out.columns == docs.columns
        seen[name], at = {r.doc_id: r for r in out.collect()}, out
    toxic = {i for i, t in labels if t}
    assert len(toxic & set(seen["toxicity"])) <= 12 and len(set(seen["toxicity"]) - toxic) >= 300
    assert 1003 in seen["minhash_near_dedup"] and 1004 not in seen["minhash_near_dedup"]
    assert passage not in seen["suffix_array_dedup"][1001].text and passage not in seen["suffix_array_dedup"][1002].text
    assert 1000 in seen["suffix_array_dedup"] and 1000 not in seen["benchmark_decontamination"]
    assert {1005, 1006} <= set(seen["byte_bpe"])
    assert set(seen["byte_bpe"]) == set(seen["benchmark_decontamination"])
    same = corpus_pipeline.run(spark, str(tmp_path))
    assert {tuple(r) for r in same.collect()} == {tuple(r) for r in seen["byte_bpe"].values()}


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
