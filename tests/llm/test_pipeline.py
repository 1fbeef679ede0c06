import hashlib

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

from tallyweir.llm.catalog import tokenizer_path
from tests.llm.common import awkward, clashing, sentence
from tests.llm.test_simhash import brute_components, reference


def test_every_stage_keeps_clean_documents_and_takes_effect(spark, tmp_path):
    clean = [sentence(i, 120 + i) for i in range(60)]
    leak = sentence(900, 30)
    special = {
        1000: " ".join(w + "***" for w in sentence(1, 100).split()),
        1001: clean[5],
        1002: clean[6].replace(clean[6].split()[50], "replaced"),
        1003: sentence(77, 100) + " " + leak,
        1004: "too short",
    }
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(clean)]
    rows += [(i, t, "en", "s1", len(t)) for i, t in special.items()]
    rows += [(2000 + i, sentence(3000 + i, 100) + "\nSubscribe to our letter today", "en", f"t{i}", 1) for i in range(8)]
    docs = spark.createDataFrame(rows, awkward(spark).schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    ids, texts = {}, {}
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = corpus_pipeline.materialize(stage(spark, current, str(tmp_path)), name)
        assert current.columns == docs.columns
        texts[name] = {r["doc_id"]: r["text"] for r in current.collect()}
        ids[name] = set(texts[name])
    text = texts["decontamination"]
    everything = {r[0] for r in rows}
    assert ids["quality_rules"] == everything - {1000, 1004}
    assert ids["line_dedup"] == ids["quality_rules"]
    prints = [(i, reference(t)) for i, t in texts["line_dedup"].items()]
    assert ids["near_dedup"] == {c for _, c in brute_components(prints, 3)}
    assert 1001 not in ids["near_dedup"] and ids["near_dedup"] > set(range(60)) - {5, 6}
    assert ids["decontamination"] == ids["near_dedup"] - {1003}
    assert [i for i in range(8) if "Subscribe" in text[2000 + i]] == [0]

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    made = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in made} == ids["decontamination"]
    for r in made:
        packed = np.array(library.encode(text[r["doc_id"]], add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert r["ids_sha256"] == hashlib.sha256(packed).hexdigest()


def test_awkward_rows_and_columns_pass_every_stage(spark, tmp_path):
    table = clashing(awkward(spark))
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (table, table.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, str(tmp_path))
            assert made.columns == docs.columns and made.count() <= docs.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
