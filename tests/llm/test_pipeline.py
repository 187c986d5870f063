"""The pipeline's stages on a small corpus."""

import random

import corpus_pipeline
from tests.llm import models


def test_stages(spark, tmp_path):
    rnd = random.Random(8)
    stock = ["".join(rnd.choice(["the", "ing", "er", "on", "and"]) for _ in range(rnd.randint(1, 4))) for _ in range(600)]
    prose = lambda n: " ".join(rnd.choice(stock) for _ in range(n))
    items = [prose(25) for _ in range(3)]
    texts = [prose(rnd.randint(30, 120)) for _ in range(40)]
    texts += [texts[3], texts[4] + " more", prose(20) + " " + items[1] + " " + prose(20), prose(30) + " password=0123456789abcdef " + prose(9), None, "12 34", "Кириллица совсем другая речь " * 5]
    docs = spark.createDataFrame([(k, t, None if k == 46 else "en", "s", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(found) == {*range(40), 43}
    assert found[7]["decoded"] == texts[7]
    assert "[SECRET]" in found[43]["decoded"] and not models.secrets(found[43]["decoded"])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "secrets", "pieces"]
