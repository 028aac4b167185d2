"""Train, resume in place, and complete from the saved folder alone."""

import pytest

from spindle import api
from spindle.plans.generate import GenConfig
from spindle.sources import sinks

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_train_resume_complete(spark, tmpdir_path):
    path = f"{tmpdir_path}/gpt_x"
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    assert api.train(docs, path, vocab_size=500) == 1
    one = sinks.load_model(spark, path).counts.agg({"cnt": "sum"}).first()[0]
    # another corpus is encoded with the saved vocabulary and added
    assert api.train(docs, path, epochs=2, vocab_size=7) == 2
    assert sinks.load_model(spark, path).counts.agg({"cnt": "sum"}).first()[0] == 3 * one
    prompts = spark.createDataFrame([("a", "The and"), ("b", "")], "seq_id string, text string")
    words = spark.createDataFrame([("th",)], "word string")
    out = {r.seq_id: r for r in api.complete(prompts, path, GenConfig(max_new=3, seed=1), words).collect()}
    assert out["a"].n_new == 3 and out["a"].text.startswith("The and") and "th" not in out["a"].continuation.lower()
    assert (out["b"].n_new, out["b"].reason) == (0, "empty_prompt")
    with pytest.raises(FileNotFoundError):
        api.complete(prompts, f"{tmpdir_path}/none")


@pytest.mark.parametrize("choice,path", [
    ("tiny-shakespeare", "./gpt_tinyshakes"), ("/data/book.txt", "./gpt_book"), ("/data/texts", "/data/texts/gpt_texts"),
    ("/data/texts/", "/data/texts/gpt_texts")])
def test_model_path(choice, path):
    assert api.model_path(choice) == path
